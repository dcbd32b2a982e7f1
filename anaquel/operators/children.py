"""Lists of children per parent, in pages of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anaquel.sources.staging import stage

PAGE = 100_000
# Children of one parent are ranked in so many groups, a power of two; a group of the hottest parent is one task's share.
# The number of a group is never null by its type, so that ranks and counts have the same plan up to their shuffle.
GROUPS = 4096
# Hashes of the parent by which links are counted before any list is made.
BUCKETS = 1 << 16


def collect_children(
    links: DataFrame,
    parent: str,
    child: str,
    element: Column,
    list_column: str,
    page: int = PAGE,
    children: DataFrame | None = None,
    repeated: bool = False,
) -> DataFrame:
    """One list of ``element`` per parent and page: columns ``parent``, ``parte``, ``list_column``.

    ``children`` has one row per ``child`` with what ``element`` reads; links to other children are left out.
    Then only the keys are ranked: the ranks and the counts read one shuffle of them, and the rows of
    ``children`` come after it. With ``repeated`` a link may occur more than once and counts once.

    Links are counted by ``BUCKETS`` hashes of the parent first. Where a bucket has no more links than a page, none of its
    parents has, and their lists are one page without any ranks. Only the parents of the other buckets are ranked.
    """
    links = links.filter(F.col(parent).isNotNull())
    crowded = _crowded(links, parent, page)
    if crowded.isEmpty():
        return _single_pages(links, parent, child, element, list_column, children, repeated)
    bucketed = links.withColumn("_bucket", _bucket(parent))
    few = bucketed.join(crowded, "_bucket", "left_anti").drop("_bucket")
    many = bucketed.join(crowded, "_bucket", "left_semi").drop("_bucket")
    single = _single_pages(few, parent, child, element, list_column, children, repeated)
    return single.unionByName(_ranked_pages(many, parent, child, element, list_column, page, children, repeated))


def _bucket(parent: str) -> Column:
    return F.pmod(F.xxhash64(parent), F.lit(BUCKETS)).cast("int")


def _crowded(links: DataFrame, parent: str, page: int) -> DataFrame:
    """The buckets with more links than a page; at most ``BUCKETS`` rows a task are shuffled."""
    counted = links.groupBy(_bucket(parent).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    return stage(counted.filter(F.col("_n") > page).select("_bucket"), "crowded")


def _single_pages(
    links: DataFrame, parent: str, child: str, element: Column, list_column: str, children: DataFrame | None, repeated: bool
) -> DataFrame:
    """Lists of parents that have at most a page of children each."""
    found = links.select(parent, child).join(children, child) if children is not None else links
    if repeated:
        # A repeated link has the same child; different children may have equal elements.
        collected = F.transform(F.collect_set(F.struct(F.col(child).alias("c"), element.alias("e"))), lambda pair: pair["e"])
    else:
        collected = F.collect_list(element)
    lists = found.groupBy(parent).agg(F.sort_array(collected).alias(list_column))
    return lists.select(parent, F.lit(0).alias("parte"), list_column)


def _ranked_pages(
    links: DataFrame,
    parent: str,
    child: str,
    element: Column,
    list_column: str,
    page: int,
    children: DataFrame | None,
    repeated: bool,
) -> DataFrame:
    """Every parent's children are ranked, and ``parte`` is the page of the rank: 0, 1, ... with ``page``
    children each but the last. So no row and no task holds an unbounded group and no child is lost.
    The rank is exact without a window over a parent: it goes by the group of the child's hash, then
    by ``child``, and the groups' counts give what comes before. A page's list is sorted.
    """
    links = links.distinct() if repeated else links
    keys = links if children is None else links.select(parent, child).join(children.select(child), child, "left_semi")
    grouped = keys.withColumn("_group", F.hash(child).bitwiseAND(F.lit(GROUPS - 1)))
    ranked = grouped.withColumn("_inside", F.row_number().over(Window.partitionBy(parent, "_group").orderBy(child)))
    # At most GROUPS rows per parent. The largest rank is the count, and shares the shuffle of the ranks.
    before = (
        ranked.groupBy(parent, "_group")
        .agg(F.max("_inside").alias("_n"))
        .withColumn("_before", F.sum("_n").over(Window.partitionBy(parent).orderBy("_group")) - F.col("_n"))
        .drop("_n")
    )
    paged = ranked.join(before, [parent, "_group"]).withColumn(
        "parte", F.floor((F.col("_before") + F.col("_inside") - 1) / F.lit(page)).cast("int")
    )
    if children is not None:
        paged = paged.join(children, child)
    return paged.groupBy(parent, "parte").agg(F.sort_array(F.collect_list(element)).alias(list_column))
