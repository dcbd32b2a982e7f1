"""The stock gate: which loan requests the stock of a book can serve, and what is left of it.

Requests of a book are served in the order of their sequence number. The gate reads one row of the
book's stock, that of the lowest branch id, and each loan takes one from every branch row of the
book. So request n of a book is accepted exactly when n is at most the gate quantity, and no state
has to be carried from request to request.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anaquel.operators.lookup import attach
from anaquel.operators.numbering import rank_by_sequence
from anaquel.sources.staging import stage

ACCEPTED = "aceptado"
UNKNOWN_BOOK = "no_existe"
NO_STOCK = "sin_stock"

# Ranges a span of sequence numbers is counted by, and the requests of a book that are ranked instead of counted again.
RANGES, SETTLED = 1024, 10_000


class RequestRefused(RuntimeError):
    """A request was refused under the policy ``abort``."""


def gate_quantity(inventory: DataFrame) -> DataFrame:
    """The quantity the gate reads, per book."""
    return inventory.groupBy("id_libro").agg(F.min_by("cantidad", "id_sede").alias("disponible"))


def stock_gate(requests: DataFrame, inventory: DataFrame, counted: Column | None = None) -> DataFrame:
    """Add ``turno`` (place among the requests of the book), ``disponible`` and ``resultado``.

    ``requests`` has ``secuencia``, unique per book, and ``id_libro``. Requests where
    ``counted`` does not hold take no place and get no result.
    """
    ranked = rank_by_sequence(
        requests, "secuencia", "turno", group="id_libro", counted=counted, per_group=gate_quantity(inventory)
    )
    served = (
        F.when(F.col("disponible").isNull(), UNKNOWN_BOOK)
        .when(F.col("turno") > F.greatest("disponible", F.lit(0)), NO_STOCK)
        .otherwise(ACCEPTED)
    )
    if counted is not None:
        served = F.when(F.coalesce(counted, F.lit(False)), served)
    return ranked.withColumn("resultado", served)


def thresholds(requests: DataFrame, inventory: DataFrame, counted: Column | None = None) -> DataFrame:
    """``id_libro``, ``disponible`` and ``ultima`` of every book with stock rows: the last sequence it can serve, null for any.

    The sequence is selected, not sorted: requests are counted per book and range of sequence numbers, running totals over
    the ranges tell in which one the stock of a book runs out, and only the requests inside that range are
    counted again by finer ranges, until it holds at most ``SETTLED`` requests, which are ranked. Books whose requests
    the stock covers, or that have none, drop out after the first count.
    """
    wanted = requests.filter(F.col("id_libro").isNotNull() & F.coalesce(counted if counted is not None else F.lit(True), F.lit(False)))
    wanted = wanted.select("id_libro", "secuencia")
    quantity = gate_quantity(inventory)
    limits = wanted.agg(F.min("secuencia").alias("low"), F.max("secuencia").alias("high")).first()
    if limits.low is None:
        return quantity.withColumn("ultima", F.lit(None).cast("bigint"))
    # The whole range of every book with some stock, as the first to look into.
    span = quantity.filter("disponible > 0").select("id_libro", F.col("disponible").cast("bigint").alias("resto"))
    cuts = span.withColumns({"desde": F.lit(limits.low).cast("bigint"), "ancho": F.lit(_parts_of(limits.high - limits.low + 1)).cast("bigint")})
    settled: list[DataFrame] = []
    while True:
        cuts = stage(_narrowed(wanted, cuts), "cuts")
        settled.append(cuts.filter((F.col("n") <= SETTLED) | (F.col("hasta") == F.col("desde"))))
        cuts = cuts.filter((F.col("n") > SETTLED) & (F.col("hasta") > F.col("desde")))
        if cuts.isEmpty():
            break
        cuts = cuts.select("id_libro", "resto", "desde", F.ceil((F.col("hasta") - F.col("desde") + 1) / RANGES).cast("bigint").alias("ancho"))
    inside = _inside(wanted, reduce(DataFrame.unionByName, settled))
    # At most SETTLED rows of a book, or requests that share one sequence number.
    turn = F.row_number().over(Window.partitionBy("id_libro").orderBy("secuencia"))
    last = inside.withColumn("turno", turn).filter(F.col("turno") == F.col("resto")).select("id_libro", F.col("secuencia").alias("ultima"))
    return quantity.join(last, "id_libro", "left")


def _parts_of(width: int) -> int:
    return -(-width // RANGES)


def _inside(wanted: DataFrame, cuts: DataFrame) -> DataFrame:
    ends = cuts.select(F.col("id_libro"), "resto", "desde", "hasta")
    return wanted.join(ends, "id_libro").filter(F.col("secuencia").between(F.col("desde"), F.col("hasta")))


def _narrowed(wanted: DataFrame, cuts: DataFrame) -> DataFrame:
    """Per book the range of width ``ancho`` from ``desde`` on in which request ``resto`` lies, with what is left to count in it.

    The result has ``id_libro``, ``resto``, ``desde``, ``hasta`` and ``n``, the requests in the range.
    """
    ends = cuts.withColumn("hasta", F.col("desde") + F.col("ancho") * F.lit(RANGES) - 1)
    part = F.floor((F.col("secuencia") - F.col("desde")) / F.col("ancho")).cast("bigint")
    inside = wanted.join(ends, "id_libro").filter(F.col("secuencia").between(F.col("desde"), F.col("hasta")))
    counted = inside.groupBy("id_libro", part.alias("tramo")).agg(
        F.count(F.lit(1)).alias("n"), F.first("resto").alias("resto"), F.first("desde").alias("desde"), F.first("ancho").alias("ancho")
    )
    # At most RANGES rows of a book.
    until = F.sum("n").over(Window.partitionBy("id_libro").orderBy("tramo"))
    found = counted.withColumn("hasta_aqui", until).filter((F.col("hasta_aqui") >= F.col("resto")) & (F.col("hasta_aqui") - F.col("n") < F.col("resto")))
    start = F.col("desde") + F.col("tramo") * F.col("ancho")
    return found.select(
        "id_libro", (F.col("resto") - F.col("hasta_aqui") + F.col("n")).alias("resto"), start.alias("desde"), (start + F.col("ancho") - 1).alias("hasta"), "n"
    )


def threshold_gate(requests: DataFrame, inventory: DataFrame, counted: Column | None = None) -> DataFrame:
    """Add ``disponible`` and ``resultado``, as ``stock_gate`` does, without giving every request its place.

    The thresholds, a row a book, are joined as they come out of the counts: a small result is broadcast, and
    otherwise adaptive execution splits the hot books.
    """
    cut = requests.join(thresholds(requests, inventory, counted), "id_libro", "left")
    late = F.coalesce(F.col("secuencia") > F.col("ultima"), F.lit(False))
    served = (
        F.when(F.col("id_libro").isNull() | F.col("disponible").isNull(), UNKNOWN_BOOK)
        .when((F.col("disponible") <= 0) | late, NO_STOCK)
        .otherwise(ACCEPTED)
    )
    if counted is not None:
        served = F.when(F.coalesce(counted, F.lit(False)), served)
    return cut.withColumn("resultado", served).select(*requests.columns, "disponible", "resultado")


def accepted_per_book(requests: DataFrame, inventory: DataFrame) -> DataFrame:
    """Requests the gate accepts per book: as many as there are, up to the quantity."""
    asked = requests.groupBy("id_libro").agg(F.count(F.lit(1)).alias("pedidos"))
    served = F.least("pedidos", F.greatest("disponible", F.lit(0)))
    return asked.join(gate_quantity(inventory), "id_libro").select("id_libro", served.cast("bigint").alias("aceptados"))


def stock_after(requests: DataFrame, inventory: DataFrame) -> DataFrame:
    """The inventory with the accepted requests taken off every branch row of their book."""
    accepted = accepted_per_book(requests, inventory)
    return take_off(inventory, accepted)


def take_off(inventory: DataFrame, accepted: DataFrame) -> DataFrame:
    left = F.col("cantidad") - F.coalesce("aceptados", F.lit(0))
    return attach(inventory, accepted, "id_libro").select(
        "id_sede", "id_libro", left.alias("cantidad")
    )


def refuse_any(results: DataFrame) -> DataFrame:
    """Policy ``abort``: raise when a request was not accepted, else pass the results on."""
    refused = results.filter(F.col("resultado") != ACCEPTED)
    if not refused.isEmpty():
        raise RequestRefused(f"first refused request: {refused.first()['resultado']}")
    return results
