"""Clustering against plain Lloyd rounds in Python integers, and the heaps' work."""

import hashlib
import math

import numpy as np
import pytest

from anaquel.llm import centroids

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, ids string"


def plain(rows, clusters, rounds):
    """Every vector against every centroid, every round."""
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:clusters]
    centers = [v for _, v in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for n in range(len(centers)):
            own = [v for (_, v), (_, m) in zip(kept, found) if m == n]
            if own:
                centers[n] = [sum(column) // len(own) for column in zip(*own)]
    return sorted(((i, n, d) for (i, _), (d, n) in zip(kept, assign())), key=str), centers


def vectors(seed, n, groups=6):
    random_ = np.random.default_rng(seed)
    middles = random_.normal(0, 1, (groups, 64))
    return [(i, [float(x) for x in (middles[i % groups] + random_.normal(0, 0.3, 64)).astype(np.float32)]) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "own", "own") for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("clusters, rounds, block", [(16, 3, 8192), (5, 6, 40), (1, 2, 8192)])
def test_equal_to_plain_rounds(spark, clusters, rounds, block):
    rows = vectors(3, 400) + vectors(3, 20) + [(i, [0.5] * 64) for i in range(900, 920)]
    found = centroids.cluster(centroids.whole_vectors(frame(spark, rows)), clusters, rounds, block)
    want, centers = plain(rows, clusters, rounds)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in found.members().collect()), key=str) == want
    assert found.centroids.tolist() == centers


def test_only_expired_vectors_are_compared_again(spark):
    found = centroids.cluster(centroids.whole_vectors(frame(spark, vectors(5, 600))), 6, 8)
    assert found.scanned[0] == 600 and found.scanned[-1] < 100


def test_awkward_vectors(spark):
    good = vectors(7, 30)
    bad = [(100, None), (101, []), (102, [1.0] * 63), (103, [None] + [1.0] * 63), (104, [float("nan")] * 64), (105, [float("inf")] * 64), (106, [3.0e38] * 64)]
    tied = [(200, [0.0] * 64), (200, [0.0] * 64), (None, [0.0] * 64)]
    found = centroids.cluster(centroids.whole_vectors(frame(spark, good + bad + tied)))
    got = sorted(((r.vec_id, r.cluster, r.distance) for r in found.members().collect()), key=str)
    assert got == plain(good + tied, 16, 3)[0]
    assert len({c for i, c, _ in got if i in (200, None)}) == 1


def test_large_components_are_exact():
    random_ = np.random.default_rng(2)
    big = random_.integers(-centroids.LARGEST, centroids.LARGEST, (20, 64))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in big[:3]] for v in big]
    assert centroids.squared(big, big[:3]).tolist() == want


def test_few_and_no_vectors(spark, tmp_path):
    found = centroids.cluster(centroids.whole_vectors(frame(spark, vectors(1, 3))))
    assert len(found.centroids) == 3 and {r.distance for r in found.members().collect()} == {0}
    assert centroids.cluster(centroids.whole_vectors(frame(spark, [(None, [1.0] * 64)]))) is None
    frame(spark, []).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert centroids.op11_centroids(spark, str(tmp_path)).collect() == []
