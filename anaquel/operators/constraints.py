"""Key, reference and length checks as aggregate reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.schema import FOREIGN_KEYS, MAX_LENGTHS, PRIMARY_KEYS, Reference
from anaquel.sources.staging import stage

MULTIPLICITY = "_n"
# The part of a key with few values, as branches and categories have: 64 neighbouring ones are one row of the grouping.
FOLDED = {"libro_categoria": "id_categoria", "inventario": "id_sede"}


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def primary_key_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows, rows with a null in the key, and keys that occur more than once.

    A table may carry its rows pre-counted in the column ``_n``.
    """
    return _union(primary_key_check(tables[t], t, PRIMARY_KEYS[t]) for t in tables)


def primary_key_check(df: DataFrame, table: str, key: tuple[str, ...]) -> DataFrame:
    rows = F.sum(MULTIPLICITY) if MULTIPLICITY in df.columns else F.count(F.lit(1))
    if len(key) > 1 and FOLDED.get(table) in key:
        return _folded_key_check(df, table, key, rows)
    incomplete = _incomplete(key)
    return (
        df.groupBy(*key)
        .agg(rows.alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("filas"),
            F.coalesce(F.sum(F.when(incomplete, F.col("n"))), F.lit(0)).alias("nulos"),
            F.count_if((F.col("n") > 1) & ~incomplete).alias("duplicados"),
        )
        .select(F.lit(table).alias("tabla"), F.lit(",".join(key)).alias("clave"), "filas", "nulos", "duplicados")
    )


def _incomplete(key: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])


def _folded_key_check(df: DataFrame, table: str, key: tuple[str, ...], rows: Column) -> DataFrame:
    """The check with one row of the grouping for 64 values of the folded column, each a bit.

    As many rows as bits are as many keys, each once. Only the keys of the other blocks are counted one by one.
    """
    folded = F.col(FOLDED[table]).cast("bigint")
    others = [c for c in key if c != FOLDED[table]]
    block = [*others, "_block"]
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), folded.bitwiseAND(F.lit(63)).cast("int"))
    placed = df.withColumn("_block", F.shiftright(folded, 6))
    blocks = stage(placed.groupBy(*block).agg(rows.alias("n"), F.bit_or(bit).alias("seen")), f"key_blocks_{table}")
    totals = blocks.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("filas"),
        F.coalesce(F.sum(F.when(_incomplete(block), F.col("n"))), F.lit(0)).alias("nulos"),
    )
    crowded = blocks.filter(~_incomplete(block) & (F.col("n") > F.bit_count("seen"))).select(*block)
    if crowded.isEmpty():
        totals = totals.withColumn("duplicados", F.lit(0).cast("bigint"))
    else:
        again = placed.join(crowded, block, "left_semi").groupBy(*key).agg(rows.alias("n"))
        totals = totals.crossJoin(again.agg(F.count_if(F.col("n") > 1).alias("duplicados")))
    return totals.select(F.lit(table).alias("tabla"), F.lit(",".join(key)).alias("clave"), "filas", "nulos", "duplicados")


def foreign_key_report(
    tables: Mapping[str, DataFrame], references: Iterable[Reference] = FOREIGN_KEYS
) -> DataFrame:
    """Per reference: rows with a value, and rows whose value has no parent. Null refers to nothing.

    Every table is read once, for all references from and to it, and all values meet in one grouping
    instead of a join per reference: a value held by many rows is one row per map task, and a parent
    that occurs twice does no harm. References to one parent share its values, so a parent row is one
    row of the grouping however many references there are, with a count for each.
    """
    references = list(references)
    # The values of a parent's column, each with the references to it.
    domains: dict[tuple[str, str], list[int]] = {}
    for number, reference in enumerate(references):
        domains.setdefault((reference.parent, reference.column), []).append(number)
    places = {n: (d, slot) for d, numbers in enumerate(domains.values()) for slot, n in enumerate(numbers)}
    counts = [f"n{slot}" for slot in range(max(map(len, domains.values()), default=0))]

    read: dict[str, list[Column]] = {}

    def value(table: str, column: str, domain: int, slot: int | None) -> None:
        held = [F.lit(1 if i == slot else None).cast("bigint").alias(n) for i, n in enumerate(counts)]
        known = F.lit(True if slot is None else None).cast("boolean").alias("known")
        key = F.lit(domain).alias("domain"), F.col(column).cast("bigint").alias("value")
        read.setdefault(table, []).append(F.struct(*key, known, *held))

    for n, reference in enumerate(references):
        value(reference.child, reference.column, *places[n])
    for d, (parent, column) in enumerate(domains):
        value(parent, column, d, None)
    sides = [tables[t].select(F.inline(F.array(*values))).filter(F.col("value").isNotNull()) for t, values in read.items()]
    met = _union(sides).groupBy("domain", "value").agg(F.max("known").alias("known"), *[F.sum(n).alias(n) for n in counts])
    totals = met.groupBy("domain").agg(
        F.array(*[F.sum(n) for n in counts]).alias("filas"),
        F.array(*[F.sum(F.when(F.col("known").isNull(), F.col(n))) for n in counts]).alias("huerfanas"),
    )
    names = [
        F.struct(*[F.lit(v).alias(k) for k, v in zip(("domain", "slot", "tabla", "columna", "padre"), (*places[n], *reference))])
        for n, reference in enumerate(references)
    ]
    every = totals.sparkSession.range(1).select(F.inline(F.array(*names)))
    return every.join(totals, "domain", "left").select(
        "tabla",
        "columna",
        "padre",
        F.coalesce(F.get("filas", "slot"), F.lit(0)).alias("filas"),
        F.coalesce(F.get("huerfanas", "slot"), F.lit(0)).alias("huerfanas"),
    )


def length_report(
    tables: Mapping[str, DataFrame], limits: Mapping[tuple[str, str], int] = MAX_LENGTHS
) -> DataFrame:
    """Per text column with a limit: longest value and rows over the limit. One pass per table."""
    by_table: dict[str, list[tuple[str, int]]] = {}
    for (table, column), limit in limits.items():
        by_table.setdefault(table, []).append((column, limit))
    return _union(length_check(tables[t], t, limited) for t, limited in by_table.items())


def length_check(df: DataFrame, table: str, limits: list[tuple[str, int]]) -> DataFrame:
    measures = []
    for column, limit in limits:
        size = F.length(column)
        measures += [F.max(size).alias(f"{column}_max"), F.count_if(size > limit).alias(f"{column}_over")]
    lines = [
        F.struct(
            F.lit(table).alias("tabla"),
            F.lit(column).alias("columna"),
            F.lit(limit).alias("limite"),
            F.coalesce(f"{column}_max", F.lit(0)).alias("maximo"),
            F.col(f"{column}_over").alias("excedidas"),
        )
        for column, limit in limits
    ]
    return df.agg(*measures).select(F.inline(F.array(*lines)))
