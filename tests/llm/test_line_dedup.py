"""Lines against brute force, the index through loads and deletions, the filter against a multiset."""

import random
from collections import Counter

import numpy as np
import pytest

from anaquel.llm.line_dedup import CuckooFilter, LineIndex, dedup_lines
from tests.llm import corpus


def key(line):
    return corpus.lowered(line.strip(" \t\n\v\f\r"))


def plain(rows):
    """Per row: id, lines, dropped lines, kept text."""
    holders = {}
    for doc, text, *_ in rows:
        if doc is not None:
            for line in (text or "").split("\n"):
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [l for l in lines if doc is None or len(key(l)) < 10 or min(holders[key(l)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def shared_lines(seed, documents=120):
    rng = random.Random(seed)
    pool = [corpus.sentence(rng, "bb", 6) for _ in range(40)] + ["Ten chars!", "nine char", "  \v spaced out line \f"]
    rows = []
    for i in range(documents):
        lines = [rng.choice(pool) if rng.random() < 0.5 else corpus.sentence(rng, "aa", 4) for _ in range(rng.randint(1, 12))]
        rows.append((7 * (i * 37 % documents), "\n".join(l.upper() if rng.random() < 0.2 else " " * rng.randrange(3) + l for l in lines), "aa", "s", 0))
    return rows


def frame(spark, rows):
    return corpus.with_extras(spark.createDataFrame(rows, corpus.SCHEMA).repartition(3))


def got(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect()), key=str)


@pytest.mark.parametrize("loads", [1, 3])
def test_equal_to_brute_force(spark, loads):
    rows = shared_lines(2)
    assert got(dedup_lines(frame(spark, rows), loads)) == plain(rows)


def test_awkward_rows(spark, empty):
    rows = corpus.edge_rows()
    docs = frame(spark, rows)
    found = dedup_lines(docs)
    assert got(found) == plain(rows)
    assert set(corpus.CLASHING) < set(found.columns)
    assert dedup_lines(empty).collect() == []


def test_deletions_undo_insertions(spark, tmp_path):
    rows = shared_lines(5)
    first, second = rows[:70], rows[70:]
    before = LineIndex.create(spark, str(tmp_path / "lines")).insert(frame(spark, first))
    both = before.insert(frame(spark, second))
    assert got(both.strip(frame(spark, rows))) == plain(rows)
    gone = spark.createDataFrame([(r[0],) for r in second], "doc_id bigint")
    back = both.delete(gone)
    assert sorted(back.counts().collect()) == sorted(before.counts().collect())
    assert got(back.strip(frame(spark, first))) == plain(first)
    # The filters hold exactly the keys that are held.
    held = Counter(r.high % back.shards for r in back.counts().collect())
    for r in back._filters().collect():
        assert int(CuckooFilter.read(r.buckets, r.slots).filled.sum()) == held.get(r.shard, 0)
    # The smallest holders go, and others take their place; then they come again.
    smallest = sorted(r[0] for r in first)[:20]
    less = back.delete(spark.createDataFrame([(i,) for i in smallest], "doc_id bigint"))
    left = [r for r in first if r[0] not in smallest]
    assert got(less.strip(frame(spark, left))) == plain(left)
    again = LineIndex.open(spark, str(tmp_path / "lines")).insert(frame(spark, [r for r in first if r[0] in smallest]))
    assert got(again.strip(frame(spark, first))) == plain(first)


def test_filters_that_take_keys_for_others_lose_nothing(spark, tmp_path):
    """With fingerprints of one bit most new keys look known; the exact table tells."""
    rows = shared_lines(8)
    index = LineIndex.create(spark, str(tmp_path / "lines"), print_bits=1)
    for part in (rows[:40], rows[40:80], rows[80:]):
        index = index.insert(frame(spark, part))
    assert got(index.strip(frame(spark, rows))) == plain(rows)
    less = index.delete(spark.createDataFrame([(r[0],) for r in rows[20:100]], "doc_id bigint"))
    left = rows[:20] + rows[100:]
    assert got(less.strip(frame(spark, left))) == plain(left)


def test_filter_holds_what_is_added_and_not_removed():
    rng = np.random.default_rng(4)
    values = rng.integers(-(1 << 63), 1 << 63, 30_000)
    own = CuckooFilter.sized(1000)  # has to widen
    for part in np.array_split(values, 7):
        own.add(part)
    own.add(values[:500])
    assert own.contains(values).all() and int(own.filled.sum()) == 30_500
    strangers = rng.integers(-(1 << 63), 1 << 63, 20_000)
    assert own.contains(strangers).mean() < 0.02
    read = CuckooFilter.read(len(own.slots), own.slots.tobytes())
    read.remove(values[:20_000])
    assert read.contains(values[:500]).all() and read.contains(values[20_000:]).all()
    read.remove(np.concatenate([values[:500], values[20_000:]]))
    assert not read.slots.any()
    with pytest.raises(ValueError):
        read.remove(values[:1])


def test_equal_fingerprints_beyond_two_buckets():
    own = CuckooFilter.sized(10)
    own.add(np.full(40, 12345))
    assert int(own.filled.sum()) == 40
    own.remove(np.full(40, 12345))
    assert not own.slots.any()
