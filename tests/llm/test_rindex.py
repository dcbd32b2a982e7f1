"""Repeated 100-byte strings against a table of all of them."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from anaquel.llm import rindex
from tests.llm import corpus


def expected(rows, length):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        raw, spans = (text or "").encode(), []
        for i in range(len(raw) - length + 1):
            if raw[i : i + length] in seen:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
            seen.add(raw[i : i + length])
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + raw[at:a], b
        kept += raw[at:]
        out[doc] = (len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
    return out


def check(spark, rows, length=100, **limits):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = rindex.find_repeats(df, length, **limits).select("*", F.sha2("kept", 256).alias("digest")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.digest) for r in found} == expected(rows, length)


@pytest.mark.parametrize("limits", [{}, {"max_segments": 2, "bucket_bytes": 3000}])
def test_planted_copies_and_passages(spark, limits):
    check(spark, [r[:2] for r in corpus.documents()[0]], **limits)


def test_runs_and_repeats_inside_a_text(spark):
    rng = random.Random(3)
    part = corpus.sentence(rng, "bb", 40)
    rows = [(1, "é" * 300), (2, "ab" * 400 + "é" * 80), (3, part + " x " + part + part), (4, "z" * 99), (5, "z" * 100), (6, "z" * 101), (7, part[7:150] + "ab" * 60)]
    check(spark, rows)


def test_long_text_in_pieces(spark, monkeypatch):
    rng = random.Random(5)
    passage = corpus.sentence(rng, "aa", 40)
    text = " ".join([corpus.sentence(rng, "aa", 300), passage, corpus.sentence(rng, "bb", 300), passage, corpus.sentence(rng, "aa", 200)])
    data = np.frombuffer(text.encode(), np.uint8)
    whole = rindex.segments(data, np.array([0, len(data)]))
    covered = {x: a for s, e, a in zip(*whole[1:4]) for x in range(s, e - 99)}
    cut = 1000
    for low, high in ((0, cut + 99), (cut, len(data))):
        part = rindex.segments(data[low:high], np.array([0, high - low]))
        assert all(covered[low + x] == a for s, e, a in zip(*part[1:4]) for x in range(s, e - 99))
    check(spark, [(1, text), (2, text[500:2500])])


def test_index_against_all_strings():
    rng = random.Random(2)
    for _ in range(200):
        letters = rng.choice(["ab", "abcd"])
        base = "".join(rng.choices(letters, k=60))
        pieces = []
        for _ in range(rng.randint(1, 8)):
            at = rng.randint(0, 40)
            own = list(base[at : at + rng.randint(1, 40)])
            own[rng.randrange(len(own))] = rng.choice(letters)
            pieces.append("".join(own).encode())
        length = rng.choice([3, 5, 8, 12])
        seen, want, start = set(), [], 0
        for piece in pieces:
            for i in range(len(piece) - length + 1):
                if piece[i : i + length] in seen:
                    want.append(start + i)
                seen.add(piece[i : i + length])
            start += len(piece) + 1
        index = rindex.RunIndex(pieces)
        assert index.repeats(length).tolist() == want
        assert index.lengths.sum() == index.size and len(index.heads) == len(index.sampled)


def test_index_of_a_repetitive_bucket_is_short():
    rng = random.Random(6)
    base = corpus.sentence(rng, "aa", 30).encode()
    pieces = []
    for _ in range(200):
        own = bytearray(base)
        own[rng.randrange(len(own))] = 120
        pieces.append(bytes(own))
    index = rindex.RunIndex(pieces)
    assert len(index.heads) < index.size / 8


def test_texts_without_repeats_keep_their_columns(spark, edges):
    cleaned = rindex.remove_repeats(edges)
    assert cleaned.columns == edges.columns
    by_id = {r.doc_id: r for r in cleaned.collect()}
    assert by_id[3].text is None and by_id[6].text == corpus.edge_rows()[8][1][: len(by_id[6].text)] or by_id[6].n_chars == len(by_id[6].text)
    assert by_id[2].text == "" and by_id[2].n_chars == 0 and by_id[8].key == "own key"
