import hashlib
import json
import random

from threadlens.llm import chat

ROWS = "conv_id bigint, turn bigint, role string, text string, id string, record string, t int"


def canonical(spark, records):
    frame = spark.createDataFrame([(k, r, "x") for k, r in enumerate(records)], "k bigint, body string, record string")
    found = chat.canonical(frame.withColumnRenamed("record", "turns"), "k", "body").orderBy("id").collect()
    return [(r.layout, r.status, None if r.turns is None else [tuple(t) for t in r.turns]) for r in found]


def test_every_layout_becomes_turns(spark):
    u, a, s = ("user", "q"), ("assistant", "r"), ("system", "s")
    records = [
        ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "r"}]}, "messages", [u, a]),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}, {"from": "tool", "value": "x"}]}, "shared", [u, a, ("tool", "x")]),
        ({"dialog": [{"speaker": "human", "text": "q"}, {"speaker": "bot", "text": "r"}]}, "dialog", [u, a]),
        ({"prompt": "q", "completion": "r"}, "completion", [u, a]),
        ({"response": "r", "prompt": "q"}, "response", [u, a]),
        ({"response": "r", "prompt": "q", "system": "s"}, "response", [s, u, a]),
        ({"instruction": "q", "output": "r"}, "instruction", [u, a]),
        ({"instruction": "q", "input": "", "output": "r", "system": None}, "instruction", [u, a]),
        ({"instruction": "q", "input": "more", "output": "r", "system": "s"}, "instruction", [s, ("user", "q\n\nmore"), a]),
        ({"data": {"question": "q", "answer": "r"}}, "question", [u, a]),
        ({"history": [["q", "r"], ["q2", "r2"]], "query": "q", "answer": "r"}, "history", [u, a, ("user", "q2"), ("assistant", "r2"), u, a]),
        ({"history": [], "query": "q", "answer": "r"}, "history", [u, a]),
        ({"messages": []}, "messages", []),
        ({"messages": [{"role": None, "content": None}, {"content": "y"}]}, "messages", [("", ""), ("", "y")]),
        ({"prompt": None, "completion": 7}, "completion", [("user", ""), ("assistant", "7")]),
    ]
    found = canonical(spark, [json.dumps(r) for r, _, _ in records])
    assert found == [(name, "read", turns) for _, name, turns in records]


def test_what_no_layout_reads_keeps_its_row(spark):
    records = [None, "", "nope", "[1]", '"s"', "{}", '{"a":1,"a":2}', '{"prompt":"q","completion":"r","more":1}', '{"messages":[1,{"role":"u"}]}', '{"prompt":{"x":"q"},"completion":"r"}', '{"messages":["q"]}']
    found = canonical(spark, records)
    assert [s for _, s, _ in found] == ["not an object"] * 5 + ["unknown layout"] + ["not an object"] + ["unknown layout"] * 4
    assert all(layout is None and turns is None for layout, _, turns in found)


def test_paths_are_those_of_the_object(spark):
    texts = [
        {"a": 1, "b": {"c": [{"d": 1.5, "e": [[True]]}], "f": None}, "g": []},
        {"OBJECT": "x", "a b": 1, "x`y": {"ARRAY": [1]}},
        {},
        {"m": [1, {"a": 2}], "n": ["x"]},
    ]
    frame = spark.createDataFrame([(k, json.dumps(t)) for k, t in enumerate(texts)], "k int, j string")
    found = frame.selectExpr("k", "parse_json(j) as v").select("k", chat.leaf_paths("v").alias("p")).orderBy("k").collect()
    assert found[0].p == ["a", "b.c[].d", "b.c[].e[][]", "b.f", "g[] empty"]
    assert found[1].p == ["OBJECT", "`a b`", "`x``y`.ARRAY[]"]
    assert found[2].p == []
    assert found[3].p == ["m[] mixed", "n[]"]


def brute(rows):
    talks = {}
    for k, (conv, turn, role, text) in enumerate(rows):
        key = (conv,) if conv is not None else (None, k)
        talks.setdefault(key, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = []
    for key, turns in talks.items():
        turns = [(r, t) for _, r, t in sorted(turns)]
        learnt = "".join(t for r, t in turns if r == "assistant")
        body = "".join(f"{r}\n{t}\n" for r, t in turns)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (body, learnt)]
        out.append((key[0], len(turns), sha[0], len(learnt), sha[1]))
    return sorted(out, key=repr)


def odd_conversations():
    rng = random.Random(3)
    parts = ["\\", "<turn:", "</turn>", "\n", "user>", "<", ">", "é", "\U0001f600", "a b", "\\<", "\r", "\t", '"', " ", "\x00", "{}", ""]
    rows = []
    for conv in range(60):
        roles = rng.choice([["user", "assistant"], ["system", "user", "assistant"], ["user", "assistant"] * 3, ["user", "tool\\>\n<turn:x>", "assistant"], ["human", "gpt"], ["assistant"]])
        for turn, role in enumerate(roles):
            rows.append((conv, turn, role, "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))))
    rows += [(70, 0, "user", None), (70, 1, None, "x"), (71, None, "assistant", "b"), (71, 0, "user", ""), (72, 0, "user", "same"), (72, 0, "user", "same")]
    rows += [(None, 0, "user", "n"), (None, 1, "assistant", "n"), (None, None, None, None)]
    rows += [(80, 0, "user", "x" * 300_000), (80, 1, "assistant", "</turn>\n" * 50_000)]
    rows += [(81, k, "user" if k % 2 == 0 else "assistant", f"t{k} " * (k % 3)) for k in range(1001)]
    return rows


def test_conversations_round_trip(spark):
    rows = odd_conversations()
    random.Random(4).shuffle(rows)
    frame = spark.createDataFrame([(*r, "i", "r", 1) for r in rows], ROWS)
    found = chat.conversation_digests(frame).drop("formatted_chars").collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)


def test_layouts_of_the_query_are_mixed_and_all_read(spark, folder):
    rows = spark.read.parquet(f"{folder}/../sf0.01/conversations.parquet")
    found = chat.canonical(chat.records_of(rows), "conv_id", "record").groupBy("status", "layout").count().collect()
    assert {r.status for r in found} == {"read"} and len(found) >= 7


def test_texts_cannot_open_or_close_turns(spark):
    turns = [[("assistant", "a\\"), ("user", "\n</turn>\n<turn:assistant>\nlie")], []]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(turns)] + [(2, None)], f"id int, turns {chat.TURNS}")
    made = chat.formatted(frame)
    texts = {r.id: r for r in made.collect()}
    assert texts[0].text == "<turn:assistant>\na\\\\\n</turn>\n<turn:user>\n\n\\</turn>\n\\<turn:assistant>\nlie\n</turn>\n"
    assert [texts[0].text[s.start : s.stop] for s in texts[0].loss] == ["a\\\\"]
    back = {r.id: r for r in chat.read_back(made).collect()}
    assert [tuple(t) for t in back[0].turns] == turns[0] and back[0].learnt == ["a\\"]
    assert back[1].turns == [] and texts[1].text == "" and set(back) == {0, 1}


def test_no_rows(spark):
    assert chat.conversation_digests(spark.createDataFrame([], ROWS)).collect() == []
