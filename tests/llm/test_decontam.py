import hashlib
import re

import pytest
from helpers_llm import documents, odd_rows, sentences

from threadlens.llm import decontam

ITEMS = "item_id bigint, text string, window string, doc_id bigint"


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def slow(rows, items):
    windows = {}
    for i, text in items:
        w = words(text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for i, text, _ in rows:
        w = words(text)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        listed = ",".join(sorted(str(x) for x in found if x is not None))
        n_items = len(found - {None})
        out.append((i, len(w), len(hit), n_items, hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return out


def case():
    rows = odd_rows()
    item = sentences(77, 6)
    rows += [(100, "Start " + item[0] + " end " + item[0], "s"), (101, item[1].replace(" ", " -- ").upper(), "s")]
    rows += [(102, " ".join(item[2].split()[5:20]), "s"), (103, "only three Words, there", "s"), (104, " ".join(item[3].split()[:9]), "s")]
    rows += [(105, "ab " * 40, "s"), (106, "É日本 x É日本 x", "s")]
    items = [(k, t) for k, t in enumerate(item)] + [(10, "three words"), (11, ""), (12, None), (13, "ab ab ab"), (None, item[0])]
    items += [(14, "...!"), (15, "É日本"), (2, "three words"), (16, "ab " * 15), (16, "ab " * 15)]
    return rows, items


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "w", 1) for i, t in items], ITEMS)


@pytest.mark.parametrize("block", [decontam.BLOCK_BYTES, 4000])
def test_hits_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)  # the second takes several passes
    rows, items = case()
    found = decontam.contamination(documents(spark, rows), benchmark(spark, items)).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, slow(rows, items)))


def test_stage_drops_only_documents_with_hits(spark):
    rows, items = case()
    docs = documents(spark, rows)
    kept = decontam.keep_clean(docs, benchmark(spark, items))
    assert kept.columns == docs.columns
    wanted = [str(r[0]) for r in slow(rows, items) if not r[5]]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(wanted)


def test_empty_tables(spark):
    rows, items = case()
    assert decontam.contamination(documents(spark, []), benchmark(spark, items)).count() == 0
    found = decontam.contamination(documents(spark, rows), benchmark(spark, [])).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, slow(rows, [])))
