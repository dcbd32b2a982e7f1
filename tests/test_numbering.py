"""Dense ids and ranks against a plain sort."""

import random

import pytest
from pyspark.sql import functions as F

from anaquel.operators import numbering
from anaquel.operators.numbering import number_rows, rank_by_sequence


@pytest.fixture
def no_coalescing(spark):
    """Keep all partitions of the range shuffle, so that offsets between them matter."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ids_follow_the_order_nulls_first(spark, no_coalescing):
    keys = [f"k{i:03d}" for i in range(500)] + [None]
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k STRING").repartition(5)
    numbered = number_rows(df, ["k"], "id")
    got = {r.k: r.id for r in numbered.collect()}
    want = {k: i for i, k in enumerate(sorted(keys, key=lambda k: (k is not None, k)), 1)}
    assert got == want
    assert numbered.columns == ["k", "id"]


def test_ids_of_an_empty_table(spark):
    assert number_rows(spark.createDataFrame([], "k STRING"), ["k"], "id").count() == 0


@pytest.mark.parametrize("chunk", [3, 1 << 16])
def test_copies_get_their_own_ids(spark, no_coalescing, monkeypatch, chunk):
    # One group of copies holds more than a third of the rows.
    monkeypatch.setattr(numbering, "COPY_CHUNK", chunk)
    counts = {f"k{i:02d}": 1 + i % 3 for i in range(40)} | {"k17": 60}
    df = spark.createDataFrame(list(counts.items()), "k STRING, _n BIGINT").repartition(5)
    numbered = number_rows(df, ["k"], "id", copies="_n")
    got = sorted((r.id, r.k) for r in numbered.collect())
    want = [k for k in sorted(counts) for _ in range(counts[k])]
    assert got == list(enumerate(want, 1))
    assert numbered.columns == ["k", "id"]


@pytest.mark.parametrize("step", [1, 1_000_003])
def test_rank_by_group_with_hot_group(spark, no_coalescing, step):
    rng = random.Random(2)
    data = [(step * s, rng.choice(["hot", "hot", "a", "b", None]), rng.random() < 0.7) for s in rng.sample(range(10_000), 400)]
    df = spark.createDataFrame(data, "s BIGINT, g STRING, c BOOLEAN")
    got = {r.s: r.rank for r in rank_by_sequence(df, "s", "rank", "g", F.col("c")).collect()}
    seen, want = {}, {}
    for s, g, c in sorted(data, key=lambda d: d[0]):
        want[s] = None
        if c and g is not None:
            seen[g] = want[s] = seen.get(g, 0) + 1
    assert got == want


@pytest.mark.parametrize("step", [1, 1_000_003])
def test_rank_without_group(spark, no_coalescing, step):
    values = [step * v for v in random.Random(3).sample(range(-500, 500), 300)]
    df = spark.createDataFrame([(v,) for v in values], "s BIGINT").repartition(4)
    ranked = rank_by_sequence(df, "s", "rank")
    assert {r.s: r.rank for r in ranked.collect()} == {v: i for i, v in enumerate(sorted(values), 1)}
    assert "Window" not in ranked._jdf.queryExecution().optimizedPlan().toString()
