"""Dense surrogate keys and ranks, without ever putting a whole table in one task.

* ``number_rows`` numbers rows 1..n in the order of any columns. The rows are range-partitioned,
  sorted inside each partition and staged together with their place; the id is the place plus the
  number of rows in the partitions before. Only one row count per partition reaches the driver, and
  goes back as a small table.
* ``rank_by_sequence`` ranks rows by a sequence number, per group or over all: the rows are numbered by
  group and sequence, and a group starts at its smallest number. A large group lies across as many
  tasks as its rows fill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anaquel.operators.lookup import attach
from anaquel.sources.staging import stage

# monotonically_increasing_id holds the partition number above 33 bits of position.
POSITION_BITS = 33
POSITION_MASK = (1 << POSITION_BITS) - 1

COPY_CHUNK = 1 << 16


def _placed(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` sorted over its partitions and staged with ``_part`` and ``_place``, the position in it from 0."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    staged = stage(rows, name)
    return staged.withColumn("_part", F.shiftright("_place", POSITION_BITS).cast("int")).withColumn(
        "_place", F.col("_place").bitwiseAND(F.lit(POSITION_MASK))
    )


def _with_rows_before(placed: DataFrame, weight: Column) -> tuple[DataFrame, int]:
    """``placed`` with ``_before``, the weight of the partitions before; and the largest weight of a row."""
    # One row per partition of the range shuffle.
    sizes = placed.groupBy("_part").agg(F.sum(weight).alias("n"), F.max(weight).alias("most")).collect()
    running, total = [], 0
    for row in sorted(sizes, key=lambda row: row[0]):
        running.append((row[0], total))
        total += row.n
    offsets = placed.sparkSession.createDataFrame(running, "_part INT, _before BIGINT")
    return placed.join(offsets, "_part").drop("_part"), max((row.most for row in sizes), default=0)


def number_rows(df: DataFrame, order: list[str], id_column: str, copies: str | None = None) -> DataFrame:
    """Add ``id_column`` = 1..n in ascending order of ``order``, nulls first.

    ``order`` must tell rows apart, or leave only rows that are interchangeable. With ``copies``,
    that column holds how many identical rows each row stands for: the result has every copy again,
    each with its own id, and no longer the column.
    """
    placed = _placed(df, order, f"numbered_{id_column}")
    if copies is None:
        numbered, _ = _with_rows_before(placed, F.lit(1))
        return numbered.withColumn(id_column, F.col("_before") + F.col("_place") + 1).drop("_before", "_place")
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    weighed = placed.withColumn("_inside", F.coalesce(F.sum(copies).over(inside), F.lit(0)))
    numbered, most = _with_rows_before(weighed, F.col(copies))
    first = numbered.withColumn("_first", F.col("_before") + F.col("_inside") + 1).drop("_before", "_inside", "_place")
    if most <= 1:
        return first.withColumn(id_column, F.col("_first")).drop("_first", copies)
    return _expand_copies(first, id_column, copies)


def _expand_copies(df: DataFrame, id_column: str, copies: str) -> DataFrame:
    """One row per copy. A row with many copies is cut in chunks, which are spread before expanding."""
    last = F.col("_first") + F.col(copies) - 1
    few = df.filter(F.col(copies) <= COPY_CHUNK).withColumn("_from", F.col("_first")).withColumn("_to", last)
    many = (
        df.filter(F.col(copies) > COPY_CHUNK)
        .withColumn("_from", F.explode(F.sequence(F.col("_first"), last, F.lit(COPY_CHUNK).cast("bigint"))))
        .withColumn("_to", F.least(F.col("_from") + COPY_CHUNK - 1, last))
        .repartition("_from")
    )
    return (
        few.unionByName(many)
        .withColumn(id_column, F.explode(F.sequence("_from", "_to")))
        .drop("_first", "_from", "_to", copies)
    )


def rank_by_sequence(
    df: DataFrame,
    sequence: str,
    rank_column: str,
    group: str | None = None,
    counted: Column | None = None,
    per_group: DataFrame | None = None,
) -> DataFrame:
    """Add the rank (1, 2, ...) of each row by the column ``sequence``, per ``group``.

    Only rows where ``counted`` holds take part; the others, and rows without a group, rank as null.
    ``per_group`` has one row per group; its columns are attached to all rows of the group.
    """
    counted = F.lit(True) if counted is None else F.coalesce(counted, F.lit(False))
    keys = [group, sequence] if group else [sequence]
    # Rows that don't take part sort behind the others of their group, so ranks are places.
    marked = df.withColumn("_out", (~counted).cast("int"))
    placed = _placed(marked, [*([group] if group else []), "_out", sequence], f"ranked_{'_'.join(keys)}")
    numbered, _ = _with_rows_before(placed, F.lit(1))
    numbered = numbered.withColumn("_number", F.col("_before") + F.col("_place")).drop("_before", "_place")
    first = F.lit(0)
    if group:
        starts = numbered.groupBy(group).agg(F.min("_number").alias("_first"))
        if per_group is not None:
            starts = starts.join(per_group, group, "left")
        numbered = attach(numbered, starts, group)
        first = F.col("_first")
    takes_part = F.col("_out") == 0 if group is None else (F.col("_out") == 0) & F.col(group).isNotNull()
    return numbered.withColumn(rank_column, F.when(takes_part, F.col("_number") - first + 1)).drop("_out", "_number", "_first")
