"""Tables whose row groups are larger than what a task should hold."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from anaquel.session import tune
from anaquel.sources import star
from anaquel.sources.staging import staging_area

ROWS = 60_000


@pytest.fixture()
def folder(tmp_path, monkeypatch):
    monkeypatch.setattr(star, "LARGE_TABLE", 1000)
    monkeypatch.setattr(star, "ROWS_OF_A_TASK", 25_000)
    monkeypatch.setattr(star, "GROUP_BYTES", 32 << 10)
    keys = pa.array(range(ROWS), pa.int64())
    lines = {
        "l_orderkey": keys,
        "l_partkey": pa.array([None if i % 11 == 0 else i * 7919 % 4001 for i in range(ROWS)], pa.int64()),
        "l_suppkey": keys,
        "l_linenumber": pa.array([i % 7 for i in range(ROWS)], pa.int32()),
        "l_quantity": pa.array([i / 4 for i in range(ROWS)]),
        "l_returnflag": pa.array(["R" if i % 3 else "N" for i in range(ROWS)]),
    }
    pq.write_table(pa.table(lines), tmp_path / "lineitem.parquet", row_group_size=ROWS)
    return str(tmp_path)


def _session(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    own.conf.set("spark.sql.files.openCostInBytes", "1")
    return own


def _most(df):
    return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_a_task_reads_a_share_of_a_large_row_group(spark, folder):
    own = _session(spark)
    plain = own.read.schema(star.STAR["lineitem"]).parquet(f"{folder}/lineitem.parquet")
    table = star.star_table(own, folder, "lineitem")
    assert _most(plain) == ROWS and _most(table) <= 25_000
    assert table.schema == plain.schema and table.exceptAll(plain).isEmpty() and plain.exceptAll(table).isEmpty()


def test_a_table_is_written_once_and_again_when_that_was_deleted(spark, folder):
    own = _session(spark)
    with staging_area(own) as paths:
        first, second = (star.star_table(own, folder, "lineitem") for _ in range(2))
        assert len(paths) == 1 and first.inputFiles() == second.inputFiles()
    assert star.star_table(own, folder, "lineitem").count() == ROWS


def test_small_row_groups_are_read_where_they_are(spark, folder, monkeypatch):
    monkeypatch.setattr(star, "ROWS_OF_A_TASK", ROWS)
    own = _session(spark)
    assert [f.split("/")[-1] for f in star.star_table(own, folder, "lineitem").inputFiles()] == ["lineitem.parquet"]


def test_a_million_rows_of_a_row_group_are_more_than_a_task_reads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(star, "LARGE_TABLE", 1000)
    keys = pa.array(range(1 << 20), pa.int64())
    events = {"event_id": keys, "user_id": keys, "event_type": pa.array(["view"] * len(keys)), "value": pa.array(range(len(keys)), pa.float64())}
    pq.write_table(pa.table(events), tmp_path / "events.parquet", row_group_size=len(keys))
    own = tune(spark)
    table = star.star_table(own, str(tmp_path), "events")
    assert _most(table) <= star.ROWS_OF_A_TASK < len(keys)
    assert table.agg(F.count(F.lit(1)), F.sum("event_id"), F.sum("value")).first()[:2] == (len(keys), len(keys) * (len(keys) - 1) // 2)
