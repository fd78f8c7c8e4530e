import hashlib
import random
import re

import pytest
from helpers_llm import documents, odd_rows

from threadlens.llm import pii

EMPTY = hashlib.sha256(b"").hexdigest()


def digits(m):
    return re.sub("[^0-9]", "", m)


def luhn(d):
    return sum(x if k % 2 == 0 else 2 * x - (9 if x > 4 else 0) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0


KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
]


def slow(text):
    spans, counts = [], []
    for kind, pattern, good in KINDS:
        found = [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text or "") if good(m[0])]
        spans += found
        counts.append(len(found))
    return counts, spans


def check(spark, rows):
    found = pii.personal_data(documents(spark, rows)).collect()
    got = sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in found)
    wanted = []
    for i, text, _ in rows:
        counts, spans = slow(text)
        wanted.append((str(i), *counts, hashlib.sha256(",".join(spans).encode()).hexdigest()))
    assert got == sorted(wanted)
    for r in found:
        listed = [s for s in r.spans.split(",") if s]
        order = [([k for k, *_ in KINDS].index(s.split(":")[0]), int(s.split(":")[1])) for s in listed]
        assert order == sorted(order)
    return {r.doc_id: r.spans.split(",") for r in found}


def card(rng, n=16):
    d = [rng.randint(0, 9) for _ in range(n - 1)]
    return next("".join(map(str, d)) + str(k) for k in range(10) if luhn("".join(map(str, d)) + str(k)))


def test_strict_spans_match_the_formats(spark):
    rng = random.Random(3)
    parts = ["a.b@c.de", "x@y", "@", "+", "1.2.3.4", "300.1.2.3", "1.2.3.4.5.6.7.8", "007.8.9.255", "+1 (386) 555-3733", "+49 30 1234567.", "+123"]
    parts += [" ", "-", ".", " ", "é", "日", "\U0001f600", "7", "12", " 4 ", "_", "%", "a", "\n", "(", ")", "+1", "5-", "0000 ", "@b.c", "a@b.c_x@d.e"]
    rows = []
    for k in range(1500):
        more = [card(rng, n) for n in (15, 16, 19)] + [" ".join(card(rng)), re.sub("(....)", r"\1 ", card(rng))]
        rows.append((k, "".join(rng.choice(parts + more) for _ in range(rng.randint(1, 14))), "s"))
    found = check(spark, rows)
    assert sum(len(s) for s in found.values()) > 500


def test_odd_and_long_texts(spark):
    rng = random.Random(4)
    rows = odd_rows() + [(60, "a" * 30_000, "s"), (61, "1" * 30_000, "s"), (62, "1 " * 15_000, "s"), (63, "a." * 10_000 + "@b.c", "s")]
    rows += [(64, "+1" * 10_000, "s"), (65, "1." * 10_000, "s"), (66, "x@" + "y." * 10_000, "s"), (67, "+1 " + "(" * 20_000, "s")]
    rows += [(68, " and ".join(card(rng) for _ in range(300)), "s"), (69, "", "s")]
    check(spark, rows)


def test_the_model_adds_spans_near_hints(spark):
    rng = random.Random(5)
    rows = []
    for k in range(400):
        c = card(rng)
        shown = re.sub("(....)(?!$)", r"\1 ", c)
        rows.append((k, rng.choice([f"my card {shown} please", f"call +1 ({k % 900 + 100}) 555-{k + 1000} now", f"order {rng.randint(10**8, 10**12)} sent"]), "s"))
    rows += [(1000, "pay by card 4012.8888.8888.1881 today", "s"), (1001, "no data here at all", "s")]
    found = check(spark, rows)
    assert found[1001] == [""]
    extra = [s for s in found[1000] if s]
    assert all(s.startswith("card:12:") for s in extra)


def test_nothing_to_learn_from(spark):
    found = pii.personal_data(documents(spark, [(1, "call (555) 123-4567", "s"), (2, None, "s"), (None, "a@b.cd", "s")])).collect()
    assert {(r.doc_id, r.n_email, r.spans) for r in found} == {(1, 0, ""), (2, 0, ""), (None, 1, "email:0:6")}


def test_no_python_in_the_plan(spark):
    plan = pii.personal_data(documents(spark, [(1, "a@b.cd", "s")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("text", [""])
def test_empty_tables_and_texts(spark, text):
    assert pii.personal_data(documents(spark, [])).count() == 0
    assert pii.personal_data(documents(spark, [(1, text, "s")])).first().base_sha256 == EMPTY


def test_a_rare_kind_is_judged_among_many_others(spark, monkeypatch):
    monkeypatch.setattr(pii, "PER_LABEL", 40)
    rng = random.Random(6)
    rows = [(k, f"write to u{k}@mail{k % 90}.com or ping host 1.2.3.{k % 700} today", "s") for k in range(1500)]
    for k in range(60):
        shown = re.sub("(....)(?!$)", r"\1 ", card(rng))
        rows.append((2000 + k, f"my card {shown} please, order {rng.randint(10**12, 10**13)} sent", "s"))
    rows.append((5000, "my card 4012/8888/8888/1881 please", "s"))
    found = check(spark, rows)
    assert found[5000] == ["card:8:27"]


def test_only_kept_spans_shut_others_out(spark):
    rows = [(1, "card", 0, 10), (1, "card", 5, 20), (1, "phone", 15, 30), (1, "card", 30, 31), (2, "ip", 5, 20), (2, "ip", 6, 7), (2, "ip", 20, 21)]
    found = pii.kept_apart(spark.createDataFrame(rows, "row bigint, kind string, start int, end int")).collect()
    assert sorted(map(tuple, found)) == [(1, "card", 0, 10), (1, "card", 30, 31), (1, "phone", 15, 30), (2, "ip", 5, 20), (2, "ip", 20, 21)]


@pytest.mark.parametrize(
    "shown",
    ["john at example dot com", "john [At] example [Dot] com", "john AT mail.example Dot com", "john (at) example dot co dot uk", "john [at] example.com"],
)
def test_spelled_out_addresses_are_proposed(spark, shown):
    _, spans = pii.proposals(documents(spark, [(1, f"Ask {shown}, please", "s"), (2, "meet at noon. Then go", "s")]))
    assert [(r.kind, r.match) for r in spans.filter("not strict").collect()] == [("email", shown)]


def test_long_texts_at_full_length(spark):
    rng = random.Random(4)
    rows = [(60, "a" * 300_000, "s"), (61, "1" * 300_000, "s"), (62, "1 " * 150_000, "s"), (63, "a." * 100_000 + "@b.c", "s")]
    rows += [(64, "+1" * 100_000, "s"), (65, "1." * 100_000, "s"), (66, "x@" + "y." * 100_000, "s"), (67, "+1 " + "(" * 200_000, "s")]
    rows += [(68, " and ".join(card(rng) for _ in range(3000)), "s")]
    found = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.personal_data(documents(spark, rows)).collect()}
    some = {63: (1, 0, 0, 0), 65: (0, 25_000, 0, 0), 66: (1, 0, 0, 0), 68: (0, 0, 3000, 0)}
    assert found == {i: some.get(i, (0, 0, 0, 0)) for i, *_ in rows}
