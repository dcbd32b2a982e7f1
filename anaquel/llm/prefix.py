"""Prefix sums inside groups of any size, spread over tasks.

The rows are sorted by range, so a large group lies across several tasks, and staged with their place.
Sums inside one task's share of a group are windows bounded by the task; one row per task and group
gives what the earlier tasks have of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anaquel.sources.staging import stage


def prefix_sums(
    rows: DataFrame, group: str, order: list[Column], sums: dict[str, Column], firsts: dict[str, Column] | None = None
) -> DataFrame:
    """``rows`` with, for each name of ``sums``, the sum over the earlier rows of its ``group``.

    ``order`` sorts all rows; ties are broken by position. ``firsts`` are values of the first row of
    the group. Added besides: ``task`` and ``place``, which sort the rows of a group.
    """
    placed = (
        rows.withColumn("position", F.monotonically_increasing_id())
        .repartitionByRange(*order, F.col("position").asc())
        .sortWithinPartitions(*order, F.col("position").asc())
        .drop("position")
        .withColumn("place", F.monotonically_increasing_id())
    )
    staged = stage(placed, "prefix").withColumn("task", F.shiftright("place", 33))
    earlier = Window.partitionBy(group).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group).orderBy("task").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = staged.groupBy(group, "task").agg(
        *[F.sum(column).alias(f"share_{name}") for name, column in sums.items()],
        *[F.min_by(F.struct(column), "place").alias(f"share_{name}") for name, column in (firsts or {}).items()],
    )
    before = shares.select(
        F.col(group).alias("before_group"),
        F.col("task").alias("before_task"),
        *[F.coalesce(F.sum(f"share_{name}").over(earlier), F.lit(0)).alias(f"before_{name}") for name in sums],
        *[F.first(f"share_{name}").over(whole).getField("col1").alias(name) for name in firsts or {}],
    )
    inside = Window.partitionBy("task", group).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    summed = staged.withColumns({f"inside_{name}": F.coalesce(F.sum(column).over(inside), F.lit(0)) for name, column in sums.items()})
    same = (F.col("task") == F.col("before_task")) & F.col(group).eqNullSafe(F.col("before_group"))
    return (
        summed.join(before, same)
        .withColumns({name: F.col(f"before_{name}") + F.col(f"inside_{name}") for name in sums})
        .drop("before_group", "before_task", *[f"{kind}_{name}" for kind in ("before", "inside") for name in sums])
    )
