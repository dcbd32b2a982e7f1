"""Random links between two numbered tables: drawn by skips, where the work follows the links, or pair by pair."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.sources.staging import stage

# The largest number of links a loan may be expected to have.
MOST_EXPECTED = 1000
# Hexadecimal digits of a digest that make a random number: all of them fit the fraction of a double.
DIGITS = 13
# The draws of pairs are remainders of this prime, so that a product of two fits a BIGINT.
PRIME = (1 << 31) - 1
# Pairs that one task draws.
PAIRS_OF_A_TASK = 1 << 28


def bernoulli_links(loans: DataFrame, books: Column, expected: float, seed: str = "") -> DataFrame:
    """``id_prestamo`` and ``id_libro``: every loan and every book id 1..``books`` are linked independently with one probability.

    The probability is ``expected`` / ``books``, so a loan has ``expected`` links on average however many books there are, or all
    books if there are fewer. From one link of a loan to the next, the books left out follow a geometric
    distribution, whose inverse is taken of a digest of seed, loan and draw; so nothing is drawn for pairs that are not linked, and a
    rerun gives the same links. Each loan draws a little more than it is expected to need; the rare ones
    whose draws have not passed the last book go on in a further round. Null ids and no books give no links.
    """
    if not 0 < expected <= MOST_EXPECTED:
        raise ValueError(f"expected must be above 0 and at most {MOST_EXPECTED}")
    draws = math.ceil(expected + 6 * math.sqrt(expected) + 8)
    going = loans.filter(F.col("id_prestamo").isNotNull()).select(
        "id_prestamo", F.lit(0).cast("bigint").alias("at"), F.lit(0).alias("drawn"), books.cast("bigint").alias("books")
    )
    going = going.filter("books > 0")
    rounds: list[DataFrame] = []
    while True:
        placed = stage(going.select("id_prestamo", "books", "drawn", _places(draws, expected, seed).alias("places")), "links")
        linked = F.filter("places", lambda at: at <= F.col("books"))
        rounds.append(placed.select("id_prestamo", F.explode(linked).alias("id_libro")))
        last = F.element_at("places", -1)
        going = placed.filter(last < F.col("books")).select("id_prestamo", last.alias("at"), (F.col("drawn") + draws).alias("drawn"), "books")
        if going.isEmpty():
            return reduce(DataFrame.unionByName, rounds)


def _places(draws: int, expected: float, seed: str) -> Column:
    """The next places of a loan, each the one before and a geometric skip."""
    chance = F.lit(float(expected)) / F.col("books")

    def skip(j: Column) -> Column:
        digest = F.md5(F.concat_ws("|", F.lit(seed), F.col("id_prestamo").cast("string"), j.cast("string")).cast("binary"))
        uniform = (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("bigint") + 1) / F.lit(float(16**DIGITS))
        # With a probability of one or more every book is linked.
        return F.when(chance >= 1, F.lit(1).cast("bigint")).otherwise(1 + F.floor(F.log(uniform) / F.log1p(-chance)).cast("bigint"))

    places = F.aggregate(
        F.sequence(F.col("drawn") + 1, F.col("drawn") + draws),
        F.struct(F.col("at").alias("at"), F.array().cast("array<bigint>").alias("all")),
        lambda s, j: F.struct((s["at"] + skip(j)).alias("at"), F.concat(s["all"], F.array(s["at"] + skip(j))).alias("all")),
        lambda s: s["all"],
    )
    return places


def drawn_pairs(loans: DataFrame, books: DataFrame, probability: float, seed: str = "") -> DataFrame:
    """``id_prestamo`` and ``id_libro``: every loan is joined with every book, and each pair is kept with ``probability``.

    The draw of a pair is arithmetic in its ids, so a rerun gives the same links: a digest of seed and loan gives a line on which
    the book has its place, and the fifth power, which permutes the remainders of ``PRIME``, leaves nothing of the line. Work and result grow
    with loans times books. Loans are dealt by the number of pairs, so that a task's share does not grow. Null ids have no links.
    """
    if not 0 < probability <= 1:
        raise ValueError("probability must be above 0 and at most 1")
    # Written, the ids of the books have a known size, which decides how the pairs are made.
    books = stage(books.select("id_libro"), "books")
    tasks = max(1, -(-loans.count() * books.count() // PAIRS_OF_A_TASK))
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col("id_prestamo").cast("string")).cast("binary"))

    def number(first: int) -> Column:
        return F.conv(F.substring(digest, first, DIGITS), 16, 10).cast("bigint")

    placed = loans.filter(F.col("id_prestamo").isNotNull()).select("id_prestamo", (1 + number(1) % (PRIME - 1)).alias("factor"), (number(1 + DIGITS) % PRIME).alias("shift"))
    pairs = placed.repartition(tasks).crossJoin(books)
    pairs = pairs.withColumn("at", (F.col("factor") * F.pmod("id_libro", F.lit(PRIME)) + F.col("shift")) % PRIME)
    pairs = pairs.withColumn("square", F.col("at") * F.col("at") % PRIME)
    draw = F.col("square") * F.col("square") % PRIME * F.col("at") % PRIME
    return pairs.filter(draw < round(probability * PRIME)).select("id_prestamo", "id_libro")
