import hashlib
import random

import numpy as np
from helpers_llm import documents, groups, odd_rows, sentences

from threadlens.llm import lines


def slow(rows):
    """What is kept of each row, comparing all distinct lines."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    first = {}
    for k in order:
        for n, line in enumerate((rows[k][1] or "").split("\n")):
            if line.strip(" "):
                first.setdefault(line, (order.index(k), n))
    names = sorted(first, key=first.get)
    links = [(a, b) for a in range(len(names)) for b in range(a) if lines.similarity(names[a], names[b]) >= 0.8]
    root = groups(links, range(len(names)))
    kept = {first[names[k]] for k in range(len(names)) if root[k] == k}
    out = []
    for k, (i, text, _) in enumerate(rows):
        if text is None:
            out.append((i, 0, 0, hashlib.sha256(b"").hexdigest()))
            continue
        every = text.split("\n")
        stay = [x for n, x in enumerate(every) if not x.strip(" ") or (order.index(k), n) in kept]
        out.append((i, len(every), len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return out


def edited(rng, line, k):
    letters = list(line)
    for _ in range(k):
        letters[rng.randrange(len(letters))] = rng.choice("xyz")
    return "".join(letters)


def check(spark, rows):
    found = lines.line_digests(documents(spark, rows)).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, slow(rows)))


def test_fuzzy_lines_match_brute_force(spark):
    rng = random.Random(9)
    base = sentences(12, 25)
    rows = []
    for k in range(60):
        text = "\n".join(edited(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 3, 8, 30])) for _ in range(rng.randint(1, 6)))
        rows.append((k, text, "s"))
    check(spark, rows)


def test_chains_of_changes_join(spark):
    rng = random.Random(2)
    line, rows = sentences(13, 1)[0], []
    for k in range(40):
        rows.append((100 - k, line, "s"))
        line = edited(rng, line, 2)
    check(spark, rows)


def test_lines_half_alike_match_brute_force(spark):
    rng = random.Random(5)
    common, own = sentences(41, 1)[0][:150], sentences(42, 30)
    every = [common + rng.choice(own)[: rng.randint(90, 160)] for _ in range(150)]
    rows = [(k, edited(rng, line, rng.choice([0, 1, 2, 5])), "s") for k, line in enumerate(every)]
    check(spark, rows)


def test_lines_alike_share_a_prefix():
    rng = random.Random(3)
    base = sentences(43, 40)
    for line in base:
        lead = rng.choice([line, rng.choice(base), line[: len(line) // 2] + rng.choice(base)])
        for k in (1, 2, 4, 6):
            other = edited(rng, line, k) + "z" * rng.randint(0, 12)
            if lines.similarity(line, other) >= 0.8:
                assert set(lines.prefix(line, lead)[1]) & set(lines.prefix(other, lead)[1])


def test_odd_rows_match_brute_force(spark):
    rows = [(i, t, s) for i, t, s in odd_rows() if i != 26]
    check(spark, rows + [(50, "short\n\n \nshort\nshort2\n\tx", "s"), (51, "short\r\nshort", "s"), (52, "\n", "s")])


def test_a_long_line(spark):
    long = " ".join(sentences(21, 300))
    check(spark, [(1, long, "s"), (2, long[:-5] + "other", "s"), (3, long[: len(long) // 2], "s")])


def test_bands_find_alike_lines():
    rng = random.Random(1)
    a, b = [], []
    for line in sentences(31, 300):
        for k in (1, 2, 4, 6):
            other = edited(rng, line, k)
            if 0.8 <= lines.similarity(line, other) < 1:
                a.append(line)
                b.append(other)
    met = (lines.band_keys(a) == lines.band_keys(b)).any(axis=1)
    assert len(a) > 300 and met.mean() > 0.995


def test_keys_do_not_depend_on_neighbours():
    some = sentences(32, 30) + ["abcdefgh", "日本語" * 5, "\U0001f600" * 9]
    together = lines.band_keys(some)
    assert [lines.band_keys([x])[0].tolist() for x in some] == together.tolist()


def test_empty_table(spark):
    assert lines.line_digests(documents(spark, [])).count() == 0


def test_shared_shingles_are_counted_for_all_pairs_of_a_unit():
    rng = random.Random(8)
    base = sentences(44, 3)
    every = [[edited(rng, line, rng.choice([0, 2, 9])) for _ in range(n)] for line, n in zip(base, (2, 7, 60))]
    some = [x for unit in every for x in unit] + ["abcdefgh", "abcdefgh", "a" * 30]
    units = np.repeat(np.arange(4), [2, 7, 60, 3])
    found = {(a, b): (both, either) for a, b, both, either in zip(*map(np.ndarray.tolist, lines.shared_shingles(some, units)))}
    for a in range(len(some)):
        for b in range(a + 1, len(some)):
            x, y = lines.shingles(some[a]), lines.shingles(some[b])
            wanted = (len(x & y), len(x | y)) if units[a] == units[b] and x & y else None
            assert found.get((a, b)) == wanted
    near = set(zip(*map(np.ndarray.tolist, lines.alike(some, units))))
    assert near == {pair for pair in found if lines.similarity(some[pair[0]], some[pair[1]]) >= 0.8}


def test_lines_of_a_large_band_all_meet(spark):
    members = {1: range(300), 2: range(300), 3: [5, 900], 4: [5, 900], 5: [7], 6: [1, 2, 3]}
    rows = [(key, i, 100) for key, ids in members.items() for i in ids]
    found = lines.in_units(spark.createDataFrame(rows, "key bigint, id bigint, chars bigint"), block=50)
    units = {}
    for unit, i in found.collect():
        units.setdefault(unit, []).append(i)
    assert all(len(set(ids)) == len(ids) <= 200 for ids in units.values())
    met = {(a, b) for ids in units.values() for a in ids for b in ids if a < b}
    assert met == {(a, b) for ids in members.values() for a in ids for b in ids if a < b}
    # Bands of the same lines are worked on once: 6 blocks make 15 units.
    assert len(units) == 15 + 2


def test_many_near_copies_match_brute_force(spark):
    rng = random.Random(6)
    line = sentences(45, 1)[0]
    check(spark, [(k, edited(rng, line, rng.choice([1, 2, 4, 6])), "s") for k in range(150)])
