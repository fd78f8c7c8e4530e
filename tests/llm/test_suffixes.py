import hashlib
import random

import numpy as np
import pytest
from helpers_llm import documents, odd_rows, sentences

from threadlens.llm import suffixes


def slow(raws):
    """Removed bytes, spans and what is left of each text."""
    where = {}
    for k, raw in enumerate(raws):
        for p in range(len(raw) - 199):
            where[raw[p : p + 200]] = where.get(raw[p : p + 200], 0) + 1
    out = []
    for raw in raws:
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for p in range(len(raw) - 199):
            if where[raw[p : p + 200]] > 1:
                gone[p : p + 200] = True
        spans = int((np.diff(np.append([False], gone).astype(int)) == 1).sum())
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()))
    return out


def check(spark, rows):
    found = suffixes.repeat_digests(documents(spark, rows)).collect()
    wanted = slow([(t or "").encode() for _, t, _ in rows])
    assert sorted(map(str, map(tuple, found))) == sorted(str((i, *w)) for (i, _, _), w in zip(rows, wanted))


def repeats(seed, n):
    """Texts that share passages of many lengths around 200 bytes, at their ends too, and overlap themselves."""
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdefg é") for _ in range(rng.randint(150, 420))) for _ in range(8)]
    rows = []
    for k in range(n):
        text = ""
        for _ in range(rng.randint(0, 5)):
            passage = rng.choice(passages)
            a, b = rng.randint(0, 60), rng.randint(0, 60)
            text += rng.choice(["", "".join(rng.choice("hijkl") for _ in range(rng.randint(0, 250)))]) + passage[a : len(passage) - b]
        rows.append((k, text, "s"))
    return rows + [(n, "ab" * 300, "s"), (n + 1, "q" * 201, "s"), (n + 2, "z" * 200, "s"), (n + 3, "z" * 200, "s")]


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_passages_match_brute_force(spark, seed):
    check(spark, repeats(seed, 40))


def test_odd_rows_match_brute_force(spark):
    check(spark, odd_rows())


def test_one_changed_byte_in_long_copies(spark):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefghij ") for _ in range(3000))
    rows = [(0, text, "s")]
    rows += [(k + 1, text[:p] + "#" + text[p + 1 :], "s") for k, p in enumerate([0, 150, 199, 200, 201, 1500, 2800, 2999])]
    check(spark, rows + [(99, text[700:1000], "s"), (98, text[1000:1199], "s")])


def test_texts_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 1000)
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdef") for _ in range(2500))
    rows = [(k, "".join(rng.choice("ghijkl") for _ in range(700 * k)) + passage + "end", "s") for k in range(4)]
    raws = [t.encode() for _, t, _ in rows] + [("x" * 999 + passage[:400]).encode()]
    found = {}
    for raw, real, parts in suffixes.pieces(list(enumerate(raws))):
        got = suffixes.anchors(raw, real)
        for (start, row, begin, low, high), (first, last, at) in (
            (max(p for p in parts if p[0] <= f), (f, x, a)) for f, x, a in zip(got["first"], got["last"], got["at"])
        ):
            shift = begin - start
            if low <= first + shift < high:
                for p in range(first + shift, last + shift + 1):
                    assert (row, p) not in found
                    found[row, p] = at + shift
    assert set(found) == {(k, p) for k, raw in enumerate(raws) for p in range(len(raw) - 199)}
    same = {}
    for (row, p), at in found.items():
        assert p <= at <= p + 168
        assert same.setdefault(raws[row][p : p + 200], at - p) == at - p


def test_ids_tell_strings_apart():
    raw = "".join(sentences(3, 20)).encode()
    buckets = suffixes.Buckets(raw)
    for width in (8, 32, 179, 200, 221):
        ids = buckets.ids(width)
        assert len(ids) == len(raw) - width + 1
        assert len(set(ids.tolist())) == len({raw[p : p + width] for p in range(len(ids))})


def test_empty_table(spark):
    assert suffixes.repeat_digests(documents(spark, [])).count() == 0
