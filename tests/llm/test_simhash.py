import random
import re

import numpy as np
import xxhash
from helpers_llm import documents, groups, odd_rows, sentences

from threadlens.llm import simhash


def slow_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(a, b):
    return (a ^ b).bit_count() <= 4


def test_rows_match_brute_force(spark):
    rows = odd_rows()
    found = simhash.near_duplicates(documents(spark, rows)).collect()
    prints = sorted({slow_fingerprint(t) for _, t, _ in rows})
    linked = groups([(a, b) for a in prints for b in prints if a < b and near(a, b)], prints)
    first = {}
    for i, t, _ in rows:
        if i is not None:
            c = linked[slow_fingerprint(t)]
            first[c] = min(first.get(c, i), i)
    wanted = [(i, f"{slow_fingerprint(t):016x}", first.get(linked[slow_fingerprint(t)])) for i, t, _ in rows]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))
    assert {r.component_id for r in found if r.fingerprint == "0" * 16} == {22}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def links_match(spark, prints):
    links = simhash.near_links(spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")).collect()
    mask = (1 << 64) - 1
    got = groups([(a & mask, b & mask) for a, b in links], prints)
    assert got == groups([(a, b) for k, a in enumerate(prints) for b in prints[:k] if near(a, b)], prints)
    assert all(a != b for a, b in links)


def clouds(seed, centres, per):
    rng = random.Random(seed)
    found = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(per):
            p = centre
            for b in rng.sample(range(64), rng.randint(0, 7)):
                p ^= 1 << b
            found.add(p)
    return sorted(found)


def test_links_join_what_brute_force_joins(spark):
    links_match(spark, clouds(1, 60, 12))
    links_match(spark, sorted({0, (1 << 64) - 1, 1, 1 << 63, 0b11111, 0b1111, 1 << 40}))


def test_hot_blocks_are_cut_by_deeper_nodes(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 20)
    monkeypatch.setattr(simhash, "LEAF", 2)
    rng = random.Random(5)
    hot = {(0x123 << 51) | rng.getrandbits(12) << 30 | rng.getrandbits(3) for _ in range(400)}
    links_match(spark, sorted(hot | set(clouds(2, 10, 10))))


def test_walk_in_small_steps_finds_the_same(monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 1)
    monkeypatch.setattr(simhash, "FRONTIER", 8)
    code = np.array(clouds(4, 20, 15), dtype=np.uint64)
    tries = simhash.Subtries(code, np.zeros(len(code), dtype=np.int64))
    tries.walk({0: [(0, len(code), 0, len(code), 0)]})
    plain = groups([(i, j) for i in range(len(code)) for j in range(i) if near(int(code[i]), int(code[j]))], range(len(code)))
    assert tries.label.tolist() == [plain[i] for i in range(len(code))]


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.keep_first(documents(spark, [])).count() == 0


def test_stage_keeps_one_of_each_group(spark):
    rows = odd_rows()
    docs = documents(spark, rows)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    named = [i for i in ids if i is not None]
    classes = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect() if r.doc_id is not None}
    assert sorted(named) == sorted(set(classes.values()))
    assert ids.count(None) == 2


def test_rows_that_share_an_id_stay_unless_they_are_copies(spark):
    a, b = sentences(9, 2)
    rows = [(1, a, "s"), (1, b, "s"), (2, a, "s"), (1, a, "t"), (3, b, "s"), (4, "", "s"), (4, None, "s")]
    kept = simhash.keep_first(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == [(1, min(a, b)), (1, max(a, b)), (4, "")]


def test_columns_without_an_order(spark):
    a, b = sentences(10, 2)
    rows = [(1, a, {"k": 1}, [(1, {"x": 2})]), (1, a, {"k": 2}, None), (2, a, None, None), (3, b, {}, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, m map<string,int>, l array<struct<a: int, b: map<string,int>>>")
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
