"""Links drawn from all pairs of a loan and a book, against draws in plain Python, and the query that draws them."""

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from anaquel.operators import links
from anaquel.plans.elt import COMPATIBLE, LINK_PROBABILITY, STRICT, Migration
from anaquel.sources.synthetic import synthetic_legacy

P = links.PRIME


def is_drawn(loan, book, probability, seed=""):
    digest = hashlib.md5(f"{seed}|{loan}".encode()).hexdigest()
    factor, shift = 1 + int(digest[: links.DIGITS], 16) % (P - 1), int(digest[links.DIGITS : 2 * links.DIGITS], 16) % P
    return pow((factor * book + shift) % P, 5, P) < round(probability * P)


@pytest.mark.parametrize("probability, seed", [(0.3, ""), (0.01, "s"), (1, "")])
def test_every_pair_is_drawn(spark, rows, monkeypatch, probability, seed):
    monkeypatch.setattr(links, "PAIRS_OF_A_TASK", 1000)
    books = [1, 2, 3, 40, P - 1, P, P + 5, 1 << 62]
    loans = spark.range(1, 301).select(F.when(F.col("id") < 300, F.col("id")).alias("id_prestamo"), F.lit("x").alias("estado"))
    listed = spark.createDataFrame([(b,) for b in [*books, None]], "id_libro bigint")
    got = rows(links.drawn_pairs(loans, listed, probability, seed))
    assert got == sorted((i, b) for i in range(1, 300) for b in books if is_drawn(i, b, probability, seed))


def test_pairs_are_drawn_independently(spark):
    loans, books = spark.range(1, 2001).withColumnRenamed("id", "id_prestamo"), spark.range(1, 301).withColumnRenamed("id", "id_libro")
    found = links.drawn_pairs(loans, books, 0.3).cache()
    assert abs(found.count() / 600_000 - 0.3) < 0.003 and found.distinct().count() == found.count()
    assert all(abs(r["count"] - 600) < 110 for r in found.groupBy("id_libro").count().collect())
    assert all(abs(r["count"] - 90) < 42 for r in found.groupBy("id_prestamo").count().collect())
    # Two books have a loan in common as often as by chance, also where they are neighbours.
    for gap in (1, 2, 50):
        both = found.join(found.select("id_prestamo", (F.col("id_libro") + gap).alias("id_libro")), ["id_prestamo", "id_libro"]).count()
        assert abs(both / (2000 * (300 - gap)) - 0.09) < 0.003
    assert links.drawn_pairs(loans.limit(0), books, 0.3).count() == links.drawn_pairs(loans, books.limit(0), 0.3).count() == 0
    for wrong in (0, -0.1, 1.1):
        with pytest.raises(ValueError):
            links.drawn_pairs(loans, books, wrong)


@pytest.mark.parametrize("mode", [COMPATIBLE, STRICT])
def test_migration_that_draws_its_links(spark, rows, mode):
    raw = synthetic_legacy(spark)
    m = Migration({**raw, "prestamos_crudos": raw["prestamos_crudos"].drop("libros_prestados")}, mode, link_probability=0.3)
    loans, books = (rows(m.table(t), i) for t, i in (("prestamos", "id_prestamo"), ("libros", "id_libro")))
    assert rows(m.table("prestamo_libro")) == [(i, b) for (i,) in loans for (b,) in books if is_drawn(i, b, 0.3)]
    with pytest.raises(ValueError):
        Migration(raw, mode, links_per_loan=2, link_probability=0.3)


def test_query_draws_the_share_of_the_established_migration(spark):
    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        pytest.skip("no test data")
    queries = entry.queries()
    loans, books = (queries[f"elt_{t}"](spark, folder).count() for t in ("prestamos", "libros"))
    assert abs(queries["elt_prestamo_libro"](spark, folder).count() / (loans * books) - LINK_PROBABILITY) < 0.005
