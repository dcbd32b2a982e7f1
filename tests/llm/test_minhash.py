"""Near duplicates against all pairs of full shingle sets."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from anaquel.llm import minhash
from anaquel.llm.components import components
from tests.llm import corpus


def full_set(text):
    words = corpus.spaced_words(corpus.lowered(text))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def reachable(links, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def expected(rows):
    sets = {d: full_set(t) for d, t in rows}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return sets, reachable(links, ids)


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    sets, component = expected(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()}
    assert got == {d: (len(sets[d]), component[d], component[d] == d) for d in sets}


def test_planted_copies(spark):
    check(spark, [r[:2] for r in corpus.documents()[0]])


def test_large_group_chains_and_common_passage(spark):
    rng = random.Random(4)
    base = corpus.sentence(rng, "aa", 80).split()
    rows = []
    for i in range(120):  # copies with one word changed each: most are similar, not all
        own = list(base)
        own[rng.randrange(80)] = f"x{i}"
        rows.append((500 - i, " ".join(own)))
    chain = corpus.sentence(rng, "bb", 60).split()
    for i in range(25):  # each like the next, the ends unlike
        chain[2 * i] = f"y{i}"
        rows.append((1000 + 7 * i, " ".join(chain)))
    passage = corpus.sentence(rng, "aa", 25)
    rows += [(2000 + i, passage + " " + corpus.sentence(rng, "bb", 20)) for i in range(60)]
    rows += [(3000 + i, "one two three") for i in range(5)] + [(3100, "ONE two\tthree"), (3101, "one two"), (3102, None), (3103, " ")]
    check(spark, rows)


def test_an_id_with_two_texts(spark):
    """Each text is linked for itself, and the rows that stay are one of each group."""
    rng = random.Random(12)
    first, second = corpus.sentence(rng, "aa", 40), corpus.sentence(rng, "bb", 40)
    near = " ".join(second.split()[:39] + ["zz"])
    rows = [(1, first), (1, second), (2, first), (3, near), (4, corpus.sentence(rng, "aa", 30)), (4, first), (None, first), (None, "one"), (None, "one"), (5, ""), (5, "")]
    docs = corpus.with_extras(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    got = sorted(((r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (4, 1), (None, None), (None, None), (None, None), (5, 5), (5, 5)], key=str)
    left = minhash.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([rows[0], rows[1], rows[4], (None, "one"), (5, ""), (5, "")], key=str)


def test_threshold_is_inclusive(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(words[:11])), (2, " ".join(words[:9] + ["z"])), (3, " ".join(words[:8])), (4, " ".join(words[:7]))]
    check(spark, rows)


def test_estimate_follows_the_similarity(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for shared in (1000, 2400, 3600):
        other = np.concatenate([base[:shared], rng.integers(0, 1 << 63, 4000 - shared, dtype=np.uint64)])
        bits = minhash.packed_bits(minhash.minima([np.sort(base), np.sort(other)]))
        row = spark.createDataFrame([(bits[0].tolist(), bits[1].tolist())], "a array<bigint>, b array<bigint>")
        got = row.select(minhash.estimate(row.a, row.b)).first()[0]
        assert abs(got - shared / (8000 - shared)) < 0.13


def test_long_text_in_chunks_has_the_same_minima():
    own = np.unique(np.random.default_rng(2).integers(0, 1 << 63, 20_000, dtype=np.uint64))
    whole = minhash.minima([own])
    direct = ((own[:, None] * minhash._A + minhash._B) >> np.uint64(32)).min(axis=0).astype(np.uint32)
    assert (whole[0] == direct).all()
    assert minhash.shingle_sets(pa.array([None, "", "a b"]))[0].size == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, 6000 + i) for i in range(50)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == reachable([(a, b) for a, b in links if a != b], nodes)
    assert Counter(got.values())[1000] == 61


def test_hashes_of_a_step_fit_the_cache_of_a_core():
    """The values of a step are read three times; beyond a core's cache that costs three times the seconds."""
    assert minhash.CHUNK * minhash.HASHES * 8 <= 1 << 20
    own = np.sort(np.random.default_rng(3).integers(0, 1 << 64, 3 * minhash.CHUNK + 5, dtype=np.uint64))
    hashed = (own[:, None] * minhash._A + minhash._B) >> np.uint64(32)
    assert (minhash.minima([own, own[:0], own[:1]]) == np.stack([hashed.min(0), hashed[0] * 0 + 0xFFFFFFFF, hashed[0]])).all()


def test_kept_documents_meet_their_ids_over_a_shuffle_at_every_size(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "g h"), (None, "i j")], "doc_id BIGINT, text STRING")
    kept = minhash.one_of_each(docs)
    assert "rightHint=(strategy=merge)" in kept._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.text for r in kept.collect()) == ["a b c d e f", "g h", "i j"]
