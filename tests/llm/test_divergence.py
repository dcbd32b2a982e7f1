"""The audit against plain counting, run lengths against dense columns."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from anaquel.llm import divergence
from tests.llm import corpus


def plain(rows, least, top):
    """lang, source, part, item, value, rank by dictionaries."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", corpus.lowered(text))) for _, text, lang, source, _ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [(s, terms) for l, s, terms in docs if l == lang]
        holding = Counter(t for _, terms in own for t in set(terms))
        kept = sorted(t for t, n in holding.items() if n >= least)
        counts = {s: Counter(t for source, terms in own if source == s for t in terms if holding[t] >= least) for s in {s for s, _ in own}}
        whole = sum(counts.values(), Counter())

        def share(counter, t):
            return 1 + 10**9 * (counter[t] + 2) // (sum(counter.values()) + 2 * len(kept))

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        for source, counter in counts.items():
            pairs = [(-sum(f(share(counter, t), share(other, t)) for t in kept), s.encode(), s) for s, other in counts.items() if s != source]
            terms = [(-f(share(counter, t), share(whole, t)), t.encode(), t) for t in kept if counter[t] and share(counter, t) > share(whole, t)]
            out += [(lang, source, "pair", item, -value, i + 1) for i, (value, _, item) in enumerate(sorted(pairs))]
            out += [(lang, source, "term", item, -value, i + 1) for i, (value, _, item) in enumerate(sorted(terms)[:top])]
    return sorted(out)


def sourced(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(150):
        lang = rng.choice(["aa", "bb"])
        rows.append((i, corpus.text(rng, lang, rng.randint(5, 60)).title(), lang, f"s{min(rng.randrange(14), 8)}", 0))
    return [*rows, (900, None, "aa", "silent", 0), (901, "x", "cc", "alone", 0), (902, "", None, None, 0), (903, "ba ko", None, "s1", 0)]


def found(spark, rows, *parameters):
    docs = corpus.with_extras(spark.createDataFrame(rows, corpus.SCHEMA).repartition(3))
    return sorted(tuple(r) for r in divergence.audit(docs, *parameters).collect())


@pytest.mark.parametrize("block, tile", [(1 << 15, 32), (7, 2)])
def test_equal_to_plain_counting(spark, block, tile):
    rows = sourced(4)
    assert found(spark, rows, 10, 10, block, tile) == plain(rows, 10, 10)


def test_awkward_rows(spark):
    rows = corpus.edge_rows()
    assert found(spark, rows, 2, 3) == plain(rows, 2, 3)
    assert found(spark, []) == []


def test_a_language_without_kept_terms_has_pairs_of_no_difference(spark):
    rows = [(1, "ba", "aa", "x", 0), (2, "ko", "aa", "y", 0)]
    assert found(spark, rows) == [("aa", "x", "pair", "y", 0, 1), ("aa", "y", "pair", "x", 0, 1)]


def test_run_lengths_are_the_dense_columns():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 3, (2, 500)).repeat(4, axis=1)
    columns = []
    for dense in (a, b):
        places = np.flatnonzero(dense)
        starts, counts = divergence.run_lengths(places, dense[places], len(dense))
        assert np.repeat(counts, np.diff(starts, append=len(dense))).tolist() == dense.tolist()
        columns.append((starts, np.array([divergence.share(c, 4000, 2000) for c in counts.tolist()])))
    p, q = ([divergence.share(int(c), 4000, 2000) for c in dense] for dense in (a, b))
    assert divergence.summed_difference(*columns, len(a)) == sum((x - y) ** 2 // (x + y) for x, y in zip(p, q))


def test_counts_beyond_64_bits_of_shares():
    assert divergence.share(10**12, 10**13, 10) == 1 + 10**9 * (10**12 + 2) // (10**13 + 20)
