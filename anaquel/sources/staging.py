"""Materialised intermediate tables in the shared folder of the cluster.

A staged table cuts lineage: it survives the loss of executors, its real size is known to the
optimizer (which is what decides a broadcast), and reading it twice gives the same rows in the
same partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Where the setting is absent (tests, a notebook) it is the session's own checkpoint folder, or a
    folder beside the tables of the warehouse, which is shared as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged")
    return context.getCheckpointDir().rstrip("/")


# Frees the shuffle files of a query when it ends; nothing reads them again once the table is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_areas: list[list[str]] = []


@contextmanager
def staging_area(spark: SparkSession) -> Iterator[list[str]]:
    """Delete, at the end, the tables staged meanwhile, each by the path it was written to.

    The list of these paths is given; what is taken out of it stays.
    """
    paths: list[str] = []
    _areas.append(paths)
    try:
        yield paths
    finally:
        _areas[:] = [area for area in _areas if area is not paths]
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in paths:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)


# Per session: the writes under way, and what the setting was before the first of them.
_writing: dict[str, tuple[int, str | None]] = {}
_lock = Lock()


@contextmanager
def _freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Have the setting on as long as any thread writes, and put it back after the last."""
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        count, before = _writing.get(session, (0, None))
        if count == 0:
            before = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _writing[session] = (count + 1, before)
    try:
        yield
    finally:
        with _lock:
            count, before = _writing.pop(session)
            if count > 1:
                _writing[session] = (count - 1, before)
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


def stage(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet, with the ``options`` of its writer, and return the written table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _areas:
        paths.append(path)
    with _freeing_shuffles(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
