"""Personal data: generators propose spans, boosted trees and calibrated thresholds choose.

Spans that a strict format proves (an address, four numbers up to 255, a card number that
passes its check, an international number of telephone length) always stand. Looser
generators propose more, overlapping each other and the strict ones. Boosted trees learn
from the proposals that the formats decide, by the shape of the span and the words around
it, and score those that they leave open; per kind, the least score at which all its held-out
proposals together are nearly all right is the threshold to be added.

Everything here is a Spark SQL function or an MLlib stage: no row is handled by Python.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.operators.ranks import running_totals
from threadlens.sources.tables import stage

KINDS = ["email", "ip", "card", "phone"]

# The strict formats. Runs are possessive where nothing could be given back,
# so long runs are gone through once; \G stands for the place after the match before.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}

_AT = r" ?[\[({] ?(?:(?i:at)|@) ?[\])}] ?"
_DOT = r"(?: ?[\[({] ?(?:(?i:dot)|\.) ?[\])}] ?| +(?i:dot) +)"
# Without brackets, "at" is a word like others, unless a "dot" follows.
_BARE_AT = r" +(?i:at) +"
_NAME, _HOST, _PART = r"[A-Za-z0-9._%+-]{1,64}", r"[A-Za-z0-9-]{1,63}", r"[A-Za-z0-9-]{2,63}"
_TAIL = rf"(?:{_DOT}|\.){_PART}"
#: Looser proposals: kind and pattern. Numbers in general are proposed as cards and as telephones.
LOOSE = [
    (
        "email",
        rf"(?<![A-Za-z0-9._%+-]){_NAME}(?:{_AT}{_HOST}(?:{_TAIL}){{1,4}}"
        rf"|{_BARE_AT}{_HOST}(?:\.{_PART}){{0,3}}{_DOT}{_PART}(?:{_TAIL}){{0,3}})",
    ),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:(?: ?\. ?| ?[\[(]\.[\])] ?)[0-9]{1,3}){3}(?![0-9.])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[ ._/-]{1,3}[0-9]{4}){3}(?![0-9])"),
    ("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,14}+(?![ -]?[0-9])"),
    ("phone", r"(?<![0-9+])\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
]
NUMBER = r"(?<![0-9])[0-9](?:[ .()/-]{0,2}[0-9]){6,40}+(?![0-9])"

# Words that speak for or against a kind when they stand nearby.
HINTS = {
    "email": "mail|contact|write to|reach",
    "ip": "ip|server|host|addr|ping",
    "card": "card|visa|credit|debit|payment|master",
    "phone": "call|phone|tel|mobile|fax|whatsapp",
    "other": "token|key|passw|secret|hash|isbn|version|order|total",
}
AROUND = 24

#: Different decided proposals of each kind and label that the trees learn from at most, those of smallest hash.
PER_LABEL = 5_000
TREES = 20
DEPTH = 3
#: Share of held-out proposals above a threshold that must be right.
PRECISION = 0.99


#: Cheap patterns that a text must hold before a generator is run on it.
POSSIBLE = {"email": "@", "ip": "[0-9][.]", "card": "[0-9](?:[ -]?[0-9]){15}", "phone": r"\+[0-9]"}
POSSIBLE_LOOSE = {
    "email": r"[\[({] ?(?:(?i:at)|@) ?[\])}]| (?i:at) +[A-Za-z0-9.-]{1,255} *[\[({ ] ?(?i:dot|\.)", "ip": r"[0-9] ?[.\[(]", "card": "[0-9]{4}|[0-9][ -][0-9]",
    "phone": "[0-9]{4}", "number": "[0-9](?:[ .()/-]{0,2}[0-9]){6}",
}


def _parts(text: Column, pattern: str, possible: Column) -> Column:
    """Per match: its text, how far it is from the match before, and what stands around it."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    whole = F.struct(pieces.alias("pieces"), found.alias("found"))
    listed = F.transform(
        F.array(whole),
        lambda w: F.transform(
            w["found"],
            lambda m, i: F.struct(
                m.alias("match"),
                F.length(w["pieces"][i]).alias("gap"),
                F.right(w["pieces"][i], F.lit(AROUND)).alias("before"),
                F.left(w["pieces"][i + 1], F.lit(AROUND)).alias("after"),
            ),
        ),
    )[0]
    return F.when(possible & text.rlike(pattern), listed)


def proposals(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id) of all documents, and the spans (row, kind, strict, number, start, end, match,
    before, after) that the generators propose; start and end count code points.

    Positions are running sums over the matches of one text and generator.
    """
    text = F.col("text").cast("string")
    generators = [(kind, STRICT[kind], True, False) for kind in KINDS]
    generators += [(kind, pattern, False, False) for kind, pattern in LOOSE] + [("number", NUMBER, False, True)]
    columns = []
    for k, (kind, pattern, strict, _) in enumerate(generators):
        possible = text.rlike((POSSIBLE if strict else POSSIBLE_LOOSE)[kind])
        columns.append(_parts(text, pattern, possible).alias(f"g{k}"))
    names = [f"g{k}" for k in range(len(generators))]
    # All texts are gone through once; what follows reads the matches only.
    wanted = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", *columns)
    rows = stage(wanted, "matches")
    some = rows.filter(reduce(lambda a, b: a | b, [F.size(n) > 0 for n in names]))
    every = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(k).alias("generator"), F.lit(kind).alias("kind"), F.lit(strict).alias("strict"),
                    F.lit(number).alias("number"), F.col(f"g{k}").alias("parts"),
                )
                for k, (kind, _, strict, number) in enumerate(generators)
            ]
        )
    )
    each = some.select("row", every.alias("g")).select("row", "g.*")
    each = each.select("row", "generator", "kind", "strict", "number", F.posexplode("parts").alias("at", "m"))
    before = Window.partitionBy("row", "generator").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("m.gap") + F.length("m.match")).over(before)
    spans = each.withColumn("end", end).select(
        "row", "kind", "strict", "number", (F.col("end") - F.length("m.match")).alias("start"), "end",
        "m.match", "m.before", "m.after",
    )
    return rows.select("row", "doc_id"), spans


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """From the right, every second digit doubled, with nine taken off above nine; the sum ends in 0."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    return (F.length(digits) > 0) & (F.aggregate(each, F.lit(0), lambda t, d: t + F.coalesce(d, F.lit(0))) % 10 == 0)


def _small_parts(match: Column) -> Column:
    """All numbers of a dotted span are at most 255, whatever their length."""
    stripped = F.transform(F.split(match, "[^0-9]+"), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(stripped, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))


def holds(kind: Column, match: Column) -> Column:
    """Whether a strict match passes the check of its kind."""
    n = F.length(digits_of(match))
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", _small_parts(match))
        .when(kind == "card", n.between(16, 19) & passes_luhn(digits_of(match)))
        .otherwise(n.between(8, 15))
    )


def _features() -> list[Column]:
    kind, match = F.col("kind"), F.col("match")
    digits = digits_of(match)
    n, size = F.length(digits), F.length(match)
    near = F.lower(F.concat_ws(" ", "before", "after"))

    def flag(test: Column) -> Column:
        return F.coalesce(test, F.lit(False)).cast("double")

    return [
        *[flag(kind == k) for k in KINDS],
        F.least(n, F.lit(64)).cast("double"),
        F.least(size, F.lit(256)).cast("double"),
        (n / F.greatest(size, F.lit(1))).cast("double"),
        F.least(F.regexp_count(match, F.lit("[0-9]+")), F.lit(64)).cast("double"),
        F.least(F.regexp_count(match, F.lit("[.]")), F.lit(64)).cast("double"),
        F.least(F.regexp_count(match, F.lit("[ -]")), F.lit(64)).cast("double"),
        flag(match.rlike("[()]")),
        flag(match.rlike("[A-Za-z]")),
        flag(passes_luhn(digits)),
        flag(_small_parts(match)),
        flag(F.right("before", F.lit(1)).rlike("[A-Za-z0-9]")),
        flag(F.left("after", F.lit(1)).rlike("[A-Za-z0-9]")),
        flag(F.right("before", F.lit(2)).rlike("[\"'=#:/$]")),
        *[flag(near.rlike(words)) for words in HINTS.values()],
    ]


def decided(spans: DataFrame) -> DataFrame:
    """Distinct proposals with ``base`` (a strict span that holds) and ``label``: 1 for base spans,
    0 for those that a check refuses or that overlap a base span of another kind, and for
    numbers in general; null where the formats leave it open.
    """
    as_kind = F.explode(F.when(F.col("number"), F.array(F.lit("card"), F.lit("phone"))).otherwise(F.array("kind")))
    named = spans.withColumn("kind", as_kind)
    one = named.groupBy("row", "kind", "start", "end").agg(
        F.max("strict").alias("strict"), F.min("number").alias("number"),
        F.first("match").alias("match"), F.first("before").alias("before"), F.first("after").alias("after"),
    )
    one = one.withColumn("base", F.col("strict") & holds(F.col("kind"), F.col("match")))
    # Running values in both directions; a frame that looks ahead would be worked out anew for each row.
    reach, back = ["start", "end", "kind"], [F.desc("start"), F.desc("end"), F.desc("kind")]
    earlier, later = (
        Window.partitionBy("row").orderBy(*o).rowsBetween(Window.unboundedPreceding, -1) for o in (reach, back)
    )
    base_end, base_start = F.when(F.col("base"), F.col("end")), F.when(F.col("base"), F.col("start"))
    touched = F.coalesce(F.max(base_end).over(earlier) > F.col("start"), F.lit(False)) | F.coalesce(
        F.min(base_start).over(later) < F.col("end"), F.lit(False)
    )
    label = F.when(F.col("base"), 1.0).when(F.col("strict") | F.col("number") | F.col("touched"), 0.0)
    return one.withColumn("touched", touched).withColumn("label", label)


def kept_apart(chosen: DataFrame) -> DataFrame:
    """Of spans (row, kind, start, end), in order, those that overlap none kept before them.

    Spans are folded by runs, which end where no span before reaches over the next start.
    """
    order = Window.partitionBy("row").orderBy("start", "end", "kind")
    free = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)) <= F.col("start")
    opened = chosen.withColumn("opens", F.coalesce(free, F.lit(True)).cast("int"))
    run = F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    span = F.struct(*[F.col(c).alias(c) for c in ("start", "end", "kind")])
    runs = opened.withColumn("run", run).groupBy("row", "run").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    kept = F.aggregate(
        "spans",
        F.slice("spans", 1, 1),
        lambda kept, s: F.when(s["start"] >= F.element_at(kept, -1)["end"], F.concat(kept, F.array(s))).otherwise(kept),
    )
    each = runs.select("row", F.explode(kept).alias("s"))
    return each.select("row", "s.kind", "s.start", "s.end")


def additions(marked: DataFrame) -> DataFrame:
    """The open proposals that the model adds: (row, kind, start, end).

    Without both labels to learn from, nothing is added. One proposal that overlaps an
    earlier one that is added is left out; those that overlap base spans are labelled already.
    """
    nothing = marked.select("row", "kind", "start", "end").filter(F.lit(False))
    scored = marked.select("row", "kind", "start", "end", "label", F.array(*_features()).alias("f"))
    # Equal proposals are folded; a fifth of each fold, rounded by its hash, is held out.
    known = scored.filter("label is not null").groupBy("kind", "label", "f").agg(F.count(F.lit(1)).alias("n"))
    known = known.withColumn("h", F.xxhash64("kind", "f", "label"))
    held = F.floor((F.col("n") + F.pmod("h", F.lit(5))) / 5)
    known = known.withColumn("held", held).withColumn("features", array_to_vector("f")).drop("f")
    folded = stage(known, "decided")
    some = None
    for kind in KINDS:
        for label in (0.0, 1.0):
            fits = folded.filter((F.col("kind") == kind) & (F.col("label") == label) & (F.col("n") > F.col("held")))
            part = fits.orderBy("h").limit(PER_LABEL)
            some = part if some is None else some.unionAll(part)
    # Kinds weigh the same, however many proposals they have. The rows are a bounded number.
    share = F.col("n") - F.col("held")
    learnt = some.withColumn("w", share / F.sum(share).over(Window.partitionBy("kind")) * F.count(F.lit(1)).over(Window.partitionBy("kind")))
    learnt = stage(learnt.select("label", "features", F.col("w").cast("double").alias("w")), "learnt")
    if learnt.select("label").distinct().count() < 2:
        return nothing
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=11, weightCol="w").fit(learnt)
    right = vector_to_array("probability")[1]
    # Per kind the least held-out score from which on nearly all are right; never below a half.
    judged = model.transform(folded.filter("held > 0")).select("kind", "label", "held", (-right).alias("falling"))
    per_score = judged.groupBy("kind", "falling").agg(F.sum("held").alias("n"), F.sum(F.col("held") * F.col("label")).alias("ones"))
    totals = running_totals(stage(per_score, "scores"), ["kind"], "falling", ["n", "ones"])
    precision = (F.col("before_ones") + F.col("ones")) / (F.col("before_n") + F.col("n"))
    limits = (
        totals.filter((precision >= PRECISION) & (F.col("falling") <= -0.5))
        .groupBy("kind")
        .agg((-F.max("falling")).alias("limit"))
    )
    open_ = scored.filter("label is null").select("row", "kind", "start", "end", array_to_vector("f").alias("features"))
    chosen = model.transform(open_).select("row", "kind", "start", "end", right.alias("p"))
    chosen = chosen.join(F.broadcast(limits), "kind").filter("p >= limit")  # a row per kind
    return kept_apart(chosen.select("row", "kind", "start", "end"))


def _joined(spans: Column) -> Column:
    """``kind:start:end`` by kind and start, separated by commas."""
    listed = F.transform(F.array_sort(F.coalesce(spans, F.array())), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(listed, ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row of ``docs`` (doc_id, text).

    The counts and the hash are of the strict spans, ``spans`` lists these and the ones the
    model adds, as ``kind:start:end`` in code points, end exclusive, by kind, then start.
    Null and empty texts hold nothing. Rows that repeat a doc_id stay rows. Other columns are
    not looked at. An empty table gives an empty result.
    """
    rows, spans = proposals(docs)
    marked = stage(decided(spans), "proposals")
    base = marked.filter("base").select("row", "kind", "start", "end", F.lit(True).alias("base"))
    found = base.unionAll(additions(marked).withColumn("base", F.lit(False)))
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct(number.alias("number"), "start", "end", "kind")
    is_base = F.col("base")
    per_row = found.groupBy("row").agg(
        *[F.sum(F.when(is_base & (F.col("kind") == k), 1).otherwise(0)).alias(f"n_{k}") for k in KINDS],
        F.collect_list(F.when(is_base, span)).alias("strict"),
        F.collect_list(span).alias("listed"),
    )
    return rows.join(per_row, "row", "left").select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.col("strict")), 256).alias("base_sha256"),
        _joined(F.col("listed")).alias("spans"),
    )
