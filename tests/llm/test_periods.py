import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers_llm import DOCUMENTS, documents, odd_rows

from threadlens.llm import periods


def brute(words):
    """Every run, period by period."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                smaller = any(all(words[k] == words[k + d] for k in range(i, i + length - d)) for d in range(1, q))
                if not smaller:
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return [w for k, w in enumerate(words) if k not in gone]


def searched(texts):
    out = periods._searched([[w.encode() for w in words] for words in texts])
    return [([(r["start"], r["length"], r["period"]) for r in x["runs"]], x["collapsed"].split()) for x in out]


def some_text(rng):
    words = []
    for _ in range(rng.randint(0, 4)):
        kind = rng.random()
        alphabet = [f"w{k}" for k in range(rng.choice([1, 2, 2, 3, 10, 500]))]
        if kind < 0.3:
            words += rng.choices(alphabet, k=rng.randint(0, 60))
        else:
            one = rng.choices(alphabet, k=rng.choice([1, 2, 3, 5, 8, 9, 12, 15, 16, 17, 24, 31, 32, 33, 40, 64]))
            if kind < 0.5:  # a period that nearly repeats itself
                one = one * 3 + [rng.choice(alphabet)]
            words += (one * 9)[: rng.randint(1, 7 * len(one))]
    return words


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_those_found_period_by_period(seed):
    rng = random.Random(seed)
    texts = [some_text(rng) for _ in range(60)]
    for words, (found, left) in zip(texts, searched(texts)):
        want = brute(words)
        assert found == want, words
        assert left == collapsed(words, want)


def test_one_word_many_times_and_a_long_period():
    rng = random.Random(1)
    long = [f"v{rng.randint(0, 10**6)}" for _ in range(3001)]
    texts = [["x"] * 200_000, long * 5 + long[:17], [], ["a"] * 5, ["a"] * 6]
    (one, left), (far, rest), none, five, six = searched(texts)
    assert one == [(0, 200_000, 1)] and left == ["x"]
    assert far == [(0, 3001 * 5 + 17, 3001)] and rest == long
    assert none == ([], []) and five == ([], ["a"] * 5) and six == ([(0, 6, 1)], ["a"])


def test_runs_end_with_their_text():
    found = searched([["a", "b"] * 3, ["a", "b"] * 4, ["a", "b"] * 9])
    assert [f for f, _ in found] == [[], [(0, 8, 2)], [(0, 18, 2)]]


def shape(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def digests(doc_id, text):
    words = shape(doc_id, text)
    found = brute(words)
    best = min(((-n, s, q) for s, n, q in found), default=None)
    top = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, " ".join(collapsed(words, found)))]
    return (doc_id, len(found), *top, *sha)


def test_odd_rows(spark):
    rows = [(i, t, s) for i, t, s in odd_rows() if i != 26]
    rows += [(k, " ".join(f"w{k}_{j}" for j in range(k % 90)), "s") for k in range(100, 400)]
    rows += [(500, "a b\x1cc \x0b\x0c\r a\x85b \xa0 " * 9, "s"), (501, "ab " * 40 + " x" * 30, "s")]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _, _ in rows if i is not None) > 10
    found = periods.run_digests(periods.planted(documents(spark, rows))).collect()
    assert sorted(map(tuple, found), key=repr) == sorted((digests(i, t) for i, t, _ in rows), key=repr)


def test_other_columns_stay(spark):
    found = periods.with_runs(documents(spark, [(1, "a b " * 5, "s")])).first()
    assert found.row == "r" and found.text == "a b " * 5 and found.collapsed == "a b"
    assert [tuple(r) for r in found.runs] == [(0, 10, 2)]


def test_empty_table(spark):
    assert periods.run_digests(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_seeds_lie_in_every_run_of_their_scale():
    rng = np.random.default_rng(3)
    for period in range(9, 70):
        one = rng.integers(0, 3, period)
        ids = np.append(np.tile(one, 4), -1)
        words = [str(x) for x in ids[:-1]]
        assert [(s, n) for s, n, q in periods.runs(ids, np.array([len(ids)])) if q == period] == [
            (s, n) for s, n, q in brute(words) if q == period
        ]
