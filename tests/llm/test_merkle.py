import hashlib
import random
import zlib

from helpers_llm import DOCUMENTS, documents, odd_rows

from threadlens.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def small_letters(text):
    return text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([digest("".join(now[k : k + 16])) for k in range(0, len(now), 16)])
    return levels


def flanks(levels, at):
    found = []
    for level in levels[:-1]:
        low = at // 16 * 16
        found.append(("".join(level[low:at]), "".join(level[at + 1 : low + 16])))
        at //= 16
    return found


def brute(rows):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    sources = {}
    for doc_id, source, lang, n_chars, text in rows:
        leaf = digest("".join(map(enc, (doc_id, source, lang, n_chars, text))))
        start = leaf
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
            start = digest("".join(map(enc, (doc_id, source, lang, n_chars, small_letters(text)))))
        sources.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, start))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf for _, _, leaf, _ in sorted(sources[s])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, source in enumerate(names):
        for at, (known, doc_id, leaf, start) in enumerate(sorted(sources[source])):
            path = flanks(trees[source], at) + flanks(top, k)
            folded = start
            for left, right in path:
                folded = digest(left + folded + right)
            root = top[-1][0]
            proof = digest("".join(left + right for left, right in path))
            out.append((doc_id if known else None, leaf, trees[source][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def found(frame):
    return sorted(map(tuple, merkle.proofs(frame).collect()), key=repr)


def test_odd_rows(spark):
    frame = documents(spark, odd_rows())
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in frame.collect()]
    assert found(frame) == brute(rows)
    assert any(not r[-1] for r in brute(rows)) and any(r[-1] for r in brute(rows))


def test_group_sizes_at_the_edges_of_runs_and_blocks(spark):
    rng = random.Random(5)
    sizes = (1, 2, 15, 16, 17, 255, 256, 257, 600)
    rows = [(1000 * n + k, f"T{k}", f"s{n}") for n in sizes for k in range(n)]
    rng.shuffle(rows)
    frame = documents(spark, rows)
    assert found(frame) == brute([(i, s, "en", len(t), t) for i, t, s in rows])


def test_one_leaf_is_the_root(spark):
    rows = [(2, "A", "s")]
    assert found(documents(spark, rows)) == brute([(2, "s", "en", 1, "A")])


def test_more_sources_than_a_block_holds(spark):
    rows = [(k, "Aa", None if k == 7 else f"é{k}") for k in range(300)]
    assert found(documents(spark, rows)) == brute([(i, s, "en", 2, t) for i, t, s in rows])


def test_three_rounds(spark):
    """More than 65,536 leaves of one source; copies of a row are leaves of their own."""
    n = 66_000
    frame = spark.range(n).selectExpr(
        "id div 2 as doc_id", "'Same' as text", "'en' as lang", "'hot' as source", "cast(4 as bigint) as n_chars"
    )
    rows = [(k // 2, "hot", "en", 4, "Same") for k in range(n)]
    assert found(frame) == brute(rows)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], DOCUMENTS)) == []


def test_a_hot_source_is_dealt_by_ranges_of_its_rows(spark):
    rows = [(k, "x", "hot") for k in range(4000)]
    placed = merkle.numbered(merkle.leaves(documents(spark, rows)).repartition(8), "source", ["doc_id", "leaf", "row"])
    written = spark.read.parquet(placed.staged_at)
    assert "text" not in written.columns
    assert [r.pos for r in placed.orderBy("doc_id").collect()] == list(range(4000))
