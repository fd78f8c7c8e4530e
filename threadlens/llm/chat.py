"""Chat records of many layouts as turns of one kind, and turns as marked texts with a loss mask.

A record is a JSON object. Its fingerprint is a hash of its nested field paths, and a table
of known fingerprints tells which mapping reads it; a mapping is a declaration of paths
and roles, compiled to one column. Records of no known fingerprint, or that are no JSON
objects, come out with a status and their fingerprint instead of turns.

A turn is written as ``<turn:role>``, a line feed, its text, a line feed, ``</turn>`` and a
line feed. Inside texts a backslash is doubled and one is put before either mark, so that
no text can end or begin a turn, and what is read back is what was written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.sources.tables import stage

TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Layout:
    """How records of certain field paths read.

    ``parts`` are turns in order, each a role and the path of its text. ``each`` is the path
    of a list of objects with a field for the role and one for the text; ``pairs`` that of a
    list of pairs of texts, which come before the parts and have the parts' roles. Paths in
    ``optional`` may be absent or null, which gives no turn. ``also`` joins the text of a further
    path to that of a part, two line feeds between. ``names`` maps role names; others stay.
    """

    name: str
    parts: tuple[tuple[str, str], ...] = ()
    each: str | None = None
    role_field: str = "role"
    text_field: str = "content"
    pairs: str | None = None
    optional: tuple[str, ...] = ()
    also: Mapping[str, str] = field(default_factory=dict)
    names: Mapping[str, str] = field(default_factory=dict)


# Field and role names of the layouts that instruction and chat tables have.
LAYOUTS = (
    Layout("messages", each="messages"),
    Layout("shared", each="conversations", role_field="from", text_field="value", names={"human": "user", "gpt": "assistant"}),
    Layout("dialog", each="dialog", role_field="speaker", text_field="text", names={"human": "user", "bot": "assistant"}),
    Layout("completion", parts=(("user", "prompt"), ("assistant", "completion"))),
    Layout("response", parts=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Layout(
        "instruction",
        parts=(("system", "system"), ("user", "instruction"), ("assistant", "output")),
        optional=("system", "input"),
        also={"instruction": "input"},
    ),
    Layout("question", parts=(("user", "data.question"), ("assistant", "data.answer"))),
    Layout("history", pairs="history", parts=(("user", "query"), ("assistant", "answer"))),
)

#: Roles whose texts a model learns to write.
LEARNT = ("assistant",)
OPEN, HEAD_END, CLOSE = "<turn:", ">\n", "</turn>"
TAIL = f"\n{CLOSE}\n"


#: What marks the path of a list's items where there are none (or only nulls), or of several kinds.
EMPTY, MIXED = " empty", " mixed"


def known_paths(layout: Layout) -> list[tuple[str, ...]]:
    """The sets of leaf paths that records of a layout may have, each in order."""
    fixed = [path for _, path in layout.parts if path not in layout.optional]
    fixed += [path for path in layout.also.values() if path not in layout.optional]
    sets = [tuple(fixed)]
    if layout.each:
        items = tuple(f"{layout.each}[].{name}" for name in (layout.role_field, layout.text_field))
        sets = [(*fixed, *items), (*fixed, f"{layout.each}[]{EMPTY}")]
    if layout.pairs:
        sets = [(*fixed, f"{layout.pairs}{end}") for end in ("[][]", f"[][]{EMPTY}", f"[]{EMPTY}")]
    return [
        tuple(sorted((*some, *more)))
        for some in sets
        for n in range(len(layout.optional) + 1)
        for more in combinations(layout.optional, n)
    ]


def leaf_paths(record: str) -> Column:
    """The leaf paths of a variant column in order, ``a.b[].c``; none where it is no object.

    They are read off the schema of the value: a name goes one step down, a list adds
    ``[]``, and the end of a leaf, list or object goes one step up again. The kind of a leaf is not
    looked at, except that lists without items and items of several kinds are marked; names
    that are no plain identifiers stay in back-quotes.
    """
    pieces = r"(?:`(?:[^`]|``)*+`|\\w+): |OBJECT<|ARRAY<|>|[A-Z_]+(?:\\([0-9,]+\\))?"
    up = "named_struct('at', slice(s.at, 1, size(s.at) - 1), 'found', s.found)"
    found = f"""aggregate(regexp_extract_all(schema_of_variant({record}), '{pieces}', 0),
      named_struct('at', array(''), 'found', cast(array() as array<string>)),
      (s, x) -> case
        when endswith(x, ': ') then named_struct('at', s.at || array(concat_ws('.',
          nullif(element_at(s.at, -1), ''), left(x, length(x) - 2))), 'found', s.found)
        when x = 'ARRAY<' then named_struct('at', s.at || array(element_at(s.at, -1) || '[]'), 'found', s.found)
        when x = 'OBJECT<' then s
        when x = '>' then {up}
        else named_struct('at', slice(s.at, 1, size(s.at) - 1), 'found', s.found || array(element_at(s.at, -1) || case
          when x = 'VARIANT' then '{MIXED}'
          when x = 'VOID' and endswith(element_at(s.at, -1), '[]') then '{EMPTY}' else '' end)) end,
      s -> array_sort(s.found))"""
    return F.expr(f"case when startswith(schema_of_variant({record}), 'OBJECT<') then {found} end")


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _at(record: str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col(record), f"$.{path}", kind)


def turns_of(layout: Layout, record: str) -> Column:
    """The turns of a variant column that has the layout's paths."""
    lists = []
    if layout.each:
        names = F.create_map(*[F.lit(x) for pair in layout.names.items() for x in pair]) if layout.names else None
        items = _at(record, layout.each, f"array<struct<`{layout.role_field}`: string, `{layout.text_field}`: string>>")

        def item(x: Column) -> Column:
            role = F.coalesce(x[layout.role_field], F.lit(""))
            return _turn(role if names is None else F.coalesce(names[role], role), x[layout.text_field])

        lists.append(F.transform(items, item))
    if layout.pairs:
        roles = [F.lit(role) for role, _ in layout.parts]
        pairs = _at(record, layout.pairs, "array<array<string>>")
        lists.append(F.flatten(F.transform(pairs, lambda p: F.array(*[_turn(r, F.get(p, F.lit(k))) for k, r in enumerate(roles)]))))
    for role, path in layout.parts:
        text = _at(record, path)
        more = layout.also.get(path)
        if more:
            # An empty further text adds nothing.
            text = F.concat_ws("\n\n", F.coalesce(text, F.lit("")), F.nullif(_at(record, more), F.lit("")))
        one = F.array(_turn(F.lit(role), text))
        lists.append(F.when(text.isNotNull(), one).otherwise(F.array().cast(TURNS)) if path in layout.optional else one)
    return F.concat(*lists).cast(TURNS)


def canonical(records: DataFrame, ident: str, json: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """(id, layout, status, fingerprint, turns) per record, as a written table.

    ``status`` is ``read``, ``unknown layout`` or ``not an object`` (also null, empty and malformed
    JSON and repeated field names); turns are null unless read. A null or missing text inside a
    list is empty, a null role is the empty role. Repeated ids are separate records, an id may be null. Other
    columns are not looked at. An empty table gives an empty result.
    """
    parsed = records.select(F.col(ident).alias("id"), F.try_parse_json(F.col(json).cast("string")).alias("record"))
    marked = parsed.withColumn("fingerprint", fingerprint(leaf_paths("record")))
    marked = marked.withColumn("fingerprint", F.expr("case when startswith(schema_of_variant(record), 'OBJECT<') then fingerprint end"))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for one in reversed(layouts):
        same = F.col("fingerprint").isin([F.xxhash64(F.lit("\n".join(paths))) for paths in known_paths(one)])
        layout = F.when(same, one.name).otherwise(layout)
        turns = F.when(F.col("layout") == one.name, turns_of(one, "record")).otherwise(turns)
    status = (
        F.when(F.col("layout").isNotNull(), "read").when(F.col("fingerprint").isNotNull(), "unknown layout").otherwise("not an object")
    )
    found = marked.withColumn("layout", layout)
    return stage(found.select("id", "layout", status.alias("status"), "fingerprint", turns.alias("turns")), "turns")


def escaped(text: Column) -> Column:
    """A text in which neither mark of a turn stands without a backslash before it."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in (OPEN, CLOSE):
        doubled = F.replace(doubled, F.lit(mark), F.lit("\\" + mark))
    return doubled


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\<>])", "$1")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


#: Numbers that are added up one by one; longer lists are added up by blocks first.
CHUNK = 256


def starts(sizes: Column) -> Column:
    """The sum of all sizes before each one, in time that grows with the list and not with its square."""
    zero = F.lit(0)

    def total(some: Column) -> Column:
        return F.aggregate(some, zero, lambda a, b: a + b)

    def before(own: Column) -> Column:
        firsts = F.sequence(zero, F.size(own) - 1, F.lit(CHUNK))
        sums = F.transform(firsts, lambda k: total(F.slice(own, k + 1, CHUNK)))
        none = F.array().cast("array<int>")
        offsets = F.aggregate(
            sums,
            F.struct(none.alias("all"), zero.alias("sum")),
            lambda s, x: F.struct(F.concat(s["all"], F.array(s["sum"])).alias("all"), (s["sum"] + x).alias("sum")),
            lambda s: s["all"],
        )
        return bound(
            offsets,
            lambda o: F.transform(
                own, lambda _, i: F.get(o, (i / CHUNK).cast("int")) + total(F.slice(own, i - i % CHUNK + 1, i % CHUNK))
            ),
        )

    return F.when(F.size(sizes) > 0, bound(sizes, before)).otherwise(F.array().cast("array<int>"))


def formatted(turns: DataFrame) -> DataFrame:
    """(id, text, loss) of (id, turns), as a written table: marked texts, and the spans that are learnt.

    A span (start, stop) counts code points of ``text`` and covers the text of one turn of a
    role in ``LEARNT``, marks left out. A record is one text and has to fit in a row. Rows whose turns are
    null are left out; a record without turns is the empty text.
    """
    def piece(turn: Column) -> Column:
        role = F.replace(escaped(turn["role"]), F.lit(">"), F.lit("\\>"))
        return F.struct(
            F.concat(F.lit(OPEN), role, F.lit(HEAD_END)).alias("head"),
            escaped(turn["text"]).alias("body"),
            turn["role"].isin(*LEARNT).alias("learnt"),
        )

    def spans(pieces: Column) -> Column:
        sizes = F.transform(pieces, lambda p: F.length(p["head"]) + F.length(p["body"]) + len(TAIL))
        placed = F.transform(
            F.arrays_zip(pieces.alias("p"), starts(sizes).alias("s")),
            lambda x: F.struct(
                (x["s"] + F.length(x["p"]["head"])).alias("start"),
                (x["s"] + F.length(x["p"]["head"]) + F.length(x["p"]["body"])).alias("stop"),
                x["p"]["learnt"].alias("learnt"),
            ),
        )
        learnt = F.filter(placed, lambda x: x["learnt"])
        text = F.array_join(F.transform(pieces, lambda p: F.concat(p["head"], p["body"], F.lit(TAIL))), "")
        return F.struct(
            text.alias("text"), F.transform(learnt, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"))).alias("loss")
        )

    made = turns.filter("turns is not null").select("id", bound(F.transform("turns", piece), spans).alias("made"))
    return stage(made.select("id", "made.text", "made.loss"), "chats")


def read_back(texts: DataFrame) -> DataFrame:
    """(id, turns, learnt, chars) from (id, text, loss): the turns, the texts under the mask, the text's length."""
    header = r"^<turn:((?s:[^\\>]*+(?:\\.[^\\>]*+)*+))>\n"

    def turn(piece: Column) -> Column:
        role = F.regexp_extract(piece, header, 1)
        return bound(
            role,
            lambda r: F.struct(
                unescaped(r).alias("role"),
                unescaped(F.substring(piece, F.length(r) + len(OPEN) + len(HEAD_END) + 1, F.length(piece))).alias("text"),
            ),
        )

    pieces = F.split("text", TAIL)
    # Four bytes a code point, so that a span is found without counting from the start.
    under = bound(
        F.encode("text", "UTF-32"),
        lambda raw: F.transform(
            "loss", lambda x: unescaped(F.decode(F.substring(raw, x["start"] * 4 + 1, (x["stop"] - x["start"]) * 4), "UTF-32"))
        ),
    )
    turns = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)
    return texts.select("id", turns.alias("turns"), under.alias("learnt"), F.length("text").cast("bigint").alias("chars"))


def records_of(rows: DataFrame) -> DataFrame:
    """(conv_id, record) of rows (conv_id, turn, role, text): conversations as JSON in the layout that suits them.

    Turns ascend by number (null first), role and text. A null text is empty, as is a null role. Rows without a
    conv_id are conversations of one turn each. A conversation with a hidden role name keeps
    plain messages; the others take turns among the layouts that can hold them.
    """
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("alone")
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    talks = rows.select("conv_id", alone, turn.alias("t")).groupBy("conv_id", "alone").agg(F.array_sort(F.collect_list("t")).alias("t"))
    deal = F.pmod(F.coalesce(F.col("conv_id"), F.lit(0)), F.lit(4))
    roles, plain = F.col("t.role"), F.forall("t", lambda x: x["role"].isin("user", "assistant", "system"))

    def like(*names: str) -> Column:
        return roles == F.array(*[F.lit(n) for n in names])

    def text(k: int) -> Column:
        return F.get("t", F.lit(k))["text"]

    def named(list_name: str, role: str, body: str, human: str, other: str) -> Column:
        def shown(x: Column) -> Column:
            name = F.when(x["role"] == "user", human).when(x["role"] == "assistant", other).otherwise(x["role"])
            return F.struct(name.alias(role), x["text"].alias(body))

        return F.to_json(F.struct(F.transform("t", shown).alias(list_name)))

    last = F.size("t")
    alternate = F.forall(
        F.transform("t", lambda x, k: x["role"] == F.when(k % 2 == 0, "user").otherwise("assistant")), lambda ok: ok
    )
    pairs = F.transform(
        F.sequence(F.lit(1), last - 3, F.lit(2)),
        lambda k: F.array(F.element_at("t", k)["text"], F.element_at("t", k + 1)["text"]),
    )
    history = F.to_json(
        F.struct(
            pairs.alias("history"),
            F.element_at("t", -2)["text"].alias("query"),
            F.element_at("t", -1)["text"].alias("answer"),
        )
    )
    record = (
        F.when(like("user", "assistant") & (deal == 0), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))))
        .when(
            like("user", "assistant") & (deal == 1),
            F.to_json(F.struct(F.struct(text(0).alias("question"), text(1).alias("answer")).alias("data"))),
        )
        .when(
            like("system", "user", "assistant") & (deal == 0),
            F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output"))),
        )
        .when(
            like("system", "user", "assistant") & (deal == 1),
            F.to_json(F.struct(text(0).alias("system"), text(1).alias("prompt"), text(2).alias("response"))),
        )
        .when(alternate & (last >= 4) & (last % 2 == 0) & (deal == 2), history)
        .when(plain & (deal == 1), named("conversations", "from", "value", "human", "gpt"))
        .when(plain & (deal == 3), named("dialog", "speaker", "text", "human", "bot"))
        .otherwise(named("messages", "role", "content", "user", "assistant"))
    )
    return talks.select("conv_id", record.alias("record"))


def conversation_digests(rows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of conversations, read back."""
    found = read_back(formatted(canonical(records_of(rows), "conv_id", "record")))
    shown = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("learnt", "")
    return found.select(
        F.col("id").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"), F.sha2(shown, 256).alias("turns_sha256"),
        F.length(learnt).cast("bigint").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"), F.col("chars").alias("formatted_chars"),
    )
