import zlib
from collections import Counter

import duckdb
from pyarrow import parquet
from pyspark.sql import functions as F

from anaquel.llm.sharding import ORACLE, assign_shards, jumps, shard_of


def jump(key, buckets):
    """The published function, on unsigned 64-bit numbers."""
    key, b, j = key % (1 << 64), -1, 0
    while j < buckets:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_walk_gives_the_published_shards(spark):
    keys = [*range(300), -1, -(1 << 63), (1 << 63) - 1, 10**15, 2**40 + 7]
    rows = spark.createDataFrame([(k,) for k in keys], "k bigint").withColumn("w", jumps(F.col("k"), 101))
    for r in rows.select("k", *[shard_of(F.col("w"), n).alias(str(n)) for n in (1, 2, 8, 9, 100, 101)]).collect():
        assert {n: r[str(n)] for n in (1, 2, 8, 9, 100, 101)} == {n: jump(r.k, n) for n in (1, 2, 8, 9, 100, 101)}


def test_slots_sizes_and_growth(spark):
    hot = spark.range(400).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("é"), F.col("id").cast("string")).alias("text"))
    rows = assign_shards(hot.repartition(5)).collect()
    assert len(rows) == 400
    for shard, count in Counter(r.shard for r in rows).items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(count))
    assert all(r.grown_shard in (r.shard, 8) and r.shard == jump(r.doc_id, 8) and r.grown_shard == jump(r.doc_id, 9) for r in rows)
    want = Counter((len(t.encode()) + 1, zlib.crc32(t.encode())) for t in (f"é{i}" for i in range(400)))
    assert Counter((r["size"], r.text_crc32) for r in rows) == want


def test_sql_gives_the_same_shards(spark, edges, tmp_path):
    """Ids that are null, negative or repeated; equal rows may take each other's slots."""
    far = spark.createDataFrame([(-1, "x"), (-(1 << 63), ""), ((1 << 63) - 1, "ñ"), (2**40 + 7, "\n")], "doc_id bigint, text string")
    docs = edges.select("doc_id", "text").unionByName(far)
    parquet.write_table(docs.toArrow(), tmp_path / "documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet')")
    columns = "doc_id, size, text_crc32, shard, grown_shard"
    want = connection.execute(f"SELECT {columns} FROM ({ORACLE})").fetchall()
    assert Counter(want) == Counter(tuple(r) for r in assign_shards(docs).select(*columns.split(", ")).collect())
    slots = connection.execute(f"SELECT shard, slot FROM ({ORACLE})").fetchall()
    assert Counter(slots) == Counter((r.shard, r.slot) for r in assign_shards(docs).collect())
