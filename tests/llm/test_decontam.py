"""Decontamination against a search for every window."""

import re

import pytest

from anaquel.llm import decontam
from tests.llm import corpus

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def expected(rows, items, window):
    windows = {}
    for item, text in items:
        words = WORDS.findall(corpus.lowered(text))
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add("" if item is None else str(item))
    out = {}
    for doc, text in rows:
        words = WORDS.findall(corpus.lowered(text))
        hit, found = set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if (key := tuple(words[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[key]
        out[doc] = (len(words), len(hit), sorted(found))
    return out


@pytest.mark.parametrize("window,block_bytes", [(10, 1 << 20), (10, 100), (3, 1 << 20)])
def test_hits(spark, docs, items, window, block_bytes):
    rows, benchmark = corpus.documents()
    rows = [r[:2] for r in rows] + [(5000, "so ALONE-word it is"), (5001, "alone words"), (5002, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = decontam.contamination(df, items, window, block_bytes).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found} == expected(rows, benchmark, window)
    assert any(r.longest >= 15 for r in found) and all((r.longest >= 0) and (r.longest_at >= 0) == (r.n_hit > 0) for r in found)


def test_longest_match_and_place(spark):
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30)))], "item_id bigint, text string")
    text = "a b " + " ".join(f"w{i}" for i in range(5, 22)) + " c " + " ".join(f"w{i}" for i in range(11))
    row = decontam.contamination(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), items).first()
    assert (row.n_hit, row.longest, row.longest_at) == (28, 17, 2)


def test_affected_documents_go_and_others_keep_all_columns(docs, edges, items):
    kept = decontam.remove_contaminated(docs, items)
    rows, benchmark = corpus.documents()
    want = expected([r[:2] for r in rows], benchmark, 10)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, v in want.items() if v[1] == 0)
    assert decontam.remove_contaminated(edges, items).columns == edges.columns
    assert decontam.remove_contaminated(edges, items).count() == edges.count()
