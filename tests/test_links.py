"""Random links against draws in plain Python, their number and spread, and a collection that survives failed exports."""

import hashlib
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from anaquel.operators import links
from anaquel.plans.elt import STRICT, Migration
from anaquel.sources.collection import MANIFESTS, NoCollection, read_collection, replace_collection
from anaquel.sources.synthetic import synthetic_legacy


def drawn(loan, books, expected, seed=""):
    at, j, found, chance = 0, 0, [], expected / books
    while at < books:
        j += 1
        u = (int(hashlib.md5(f"{seed}|{loan}|{j}".encode()).hexdigest()[: links.DIGITS], 16) + 1) / 16**links.DIGITS
        at += 1 if chance >= 1 else 1 + math.floor(math.log(u) / math.log1p(-chance))
        if at <= books:
            found.append((loan, at))
    return found


@pytest.mark.parametrize("books, expected, seed", [(500, 3, ""), (40, 12.5, "s"), (7, 7, ""), (5, 60, ""), (1, 0.5, "")])
def test_links_are_those_drawn(spark, rows, books, expected, seed):
    loans = spark.range(1, 301).select(F.when(F.col("id") < 300, F.col("id")).alias("id_prestamo"), F.lit("x").alias("books"))
    got = rows(links.bernoulli_links(loans, F.lit(books), expected, seed))
    assert got == sorted(p for loan in range(1, 300) for p in drawn(loan, books, expected, seed))


def test_further_rounds_lose_nothing(spark, rows, monkeypatch):
    """Few draws a round: most loans need several."""
    monkeypatch.setattr(links.math, "ceil", lambda n: 2)
    loans = spark.range(1, 51).withColumnRenamed("id", "id_prestamo")
    assert rows(links.bernoulli_links(loans, F.lit(30), 5)) == sorted(p for i in range(1, 51) for p in drawn(i, 30, 5))


def test_number_and_spread(spark):
    loans = spark.range(1, 4001).withColumnRenamed("id", "id_prestamo")
    found = links.bernoulli_links(loans, F.lit(100), 5).cache()
    assert abs(found.count() / 4000 - 5) < 0.2
    counts = [r["count"] for r in found.groupBy("id_libro").count().collect()]
    assert len(counts) == 100 and all(abs(c - 200) < 75 for c in counts)
    assert links.bernoulli_links(loans, F.lit(0), 5).count() == 0
    assert links.bernoulli_links(loans.limit(0), F.lit(9), 5).count() == 0
    for wrong in (0, -1, links.MOST_EXPECTED + 1):
        with pytest.raises(ValueError):
            links.bernoulli_links(loans, F.lit(9), wrong)


def test_migration_with_expected_links(spark):
    m = Migration(synthetic_legacy(spark), STRICT, expected_links=2)
    lines, loans, books = m.table("prestamo_libro"), m.table("prestamos").count(), m.table("libros").count()
    assert 0 < lines.count() < 4 * loans and lines.filter(~F.col("id_libro").between(1, books)).isEmpty()
    with pytest.raises(ValueError):
        Migration(synthetic_legacy(spark), STRICT, links_per_loan=2, expected_links=2)


SCHEMA = "_id BIGINT, titulo STRING, autores ARRAY<STRUCT<nombre: STRING>>"


def collection(spark, numbers):
    listed = F.transform(F.sequence(F.lit(1), F.col("_id") % 3 + 1), lambda i: F.struct(F.concat(F.lit("a\n"), i.cast("string")).alias("nombre")))
    title = F.when(F.col("_id") != 2, F.concat(F.lit("tí\"tulo "), F.col("_id").cast("string")))
    return spark.range(*numbers).withColumnRenamed("id", "_id").select("_id", title.alias("titulo"), listed.alias("autores")).repartition(3)


def test_collection_is_replaced_or_left(spark, rows, tmp_path):
    folder = tmp_path / "c"
    with pytest.raises(NoCollection):
        read_collection(spark, str(folder), SCHEMA)
    first = collection(spark, (1, 8))
    replace_collection(first, str(folder))
    want = rows(first.select("_id", "titulo", F.to_json("autores")))
    read = lambda: rows(read_collection(spark, str(folder), SCHEMA).select("_id", "titulo", F.to_json("autores")))
    assert read() == want
    # One task fails after others have written: the old documents stay and nothing of the new ones is left.
    before = {p.name for p in folder.iterdir()}
    broken = collection(spark, (10, 40)).withColumn("titulo", F.when(F.col("_id") == 39, F.raise_error(F.lit("broken"))).otherwise(F.col("titulo")))
    with pytest.raises(PySparkException):
        replace_collection(broken, str(folder))
    assert read() == want and {p.name for p in folder.iterdir()} == before
    # A manifest that was never finished is skipped.
    (folder / MANIFESTS / "000000000009-version-x").write_text("{\"vers")
    assert read() == want
    replace_collection(first.limit(0), str(folder))
    assert read() == []
    replace_collection(collection(spark, (5, 6)), str(folder))
    assert len(read()) == 1 and len(list((folder / MANIFESTS).iterdir())) == 2
