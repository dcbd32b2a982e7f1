import datetime as dt
import json
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from anaquel.operators.children import collect_children
from anaquel.plans import documents
from anaquel.plans.mapping import DEFAULT_MAPPING, load_mapping
from anaquel.schema import NORMALISED

DAY, MIDNIGHT = dt.date(2026, 1, 2), dt.datetime(2026, 1, 2)

DATA = {
    "editoriales": [(1, "E")],
    "libros": [(1, "uno", DAY, 1), (2, "dos", None, 1), (3, "tres", DAY, None)],
    "autores": [(1, "B"), (2, "A")],
    "libro_autor": [(1, 1), (1, 2)],
    "categorias": [(1, "c", "x"), (2, "c", None)],
    "libro_categoria": [(1, 1), (1, 2), (2, 1)],
    "usuarios": [(1, "Ana", "a@x.c"), (2, None, None)],
    "prestamos": [(1, 1, DAY, "Activo"), (2, 2, None, "Devuelto"), (3, None, DAY, "Activo")],
    "prestamo_libro": [(1, 1), (1, 2)],
    "sedes": [(1, "S", "calle")],
    "inventario": [(1, 1, 5), (1, 2, None)],
}


@pytest.fixture(scope="module")
def tables(spark):
    return {name: spark.createDataFrame(data, NORMALISED[name]) for name, data in DATA.items()}


def as_dicts(df):
    return {r["_id"]: r.asDict(recursive=True) for r in df.collect()}


def test_books(tables):
    got = as_dicts(documents.build_collection(tables, "Libros"))
    # The book without publisher has no document; lists are sorted, and empty without links.
    assert got.keys() == {1, 2}
    assert got[1] == {
        "_id": 1, "titulo": "uno", "fecha": MIDNIGHT, "editorial": {"nombre": "E"},
        "autores": [{"nombre": "A"}, {"nombre": "B"}],
        "categorias": [{"nombre": "c", "descripcion": None}, {"nombre": "c", "descripcion": "x"}], "parte": 0,
    }
    assert got[2]["autores"] == [] and got[2]["fecha"] is None


def test_loans(tables):
    got = as_dicts(documents.build_collection(tables, "Prestamos"))
    assert got.keys() == {1, 2}
    assert got[1]["libros"] == [{"titulo": "dos"}, {"titulo": "uno"}]
    assert got[2]["libros"] == [] and got[2]["usuario"] == {"nombre": None, "correo": None}


def test_users_and_inventory(tables, rows):
    assert rows(documents.build_collection(tables, "Usuarios")) == [(1, "Ana", "a@x.c"), (2, None, None)]
    got = documents.build_collection(tables, "Inventario").orderBy("libro._id").collect()
    assert [r.asDict(recursive=True) for r in got] == [
        {"stock": 5, "sede": {"nombre": "S", "ubicacion": "calle"}, "libro": {"_id": 1, "titulo": "uno"}},
        {"stock": None, "sede": {"nombre": "S", "ubicacion": "calle"}, "libro": {"_id": 2, "titulo": "dos"}},
    ]


def test_counts(tables, rows):
    got = rows(documents.count_documents(documents.build_documents(tables)))
    assert rows(documents.count_parents(tables)) == got
    assert got == [("inventario", 2), ("libros", 2), ("prestamos", 2), ("usuarios", 2)]


@pytest.mark.parametrize("factor", [1, 10, 1024])
def test_hot_parent_is_paged_without_loss(spark, factor):
    links = [(1, factor * c) for c in range(1000)] + [(p, c) for p in range(2, 30) for c in range(p % 4)]
    df = spark.createDataFrame(links, "p BIGINT, c BIGINT")
    got = collect_children(df, "p", "c", F.col("c"), "l", page=100).collect()
    assert all(r.l == sorted(r.l) for r in got)
    assert sorted((r.parte, len(r.l)) for r in got if r.p == 1) == [(i, 100) for i in range(10)]
    assert all(r.parte == 0 for r in got if r.p != 1)
    assert Counter((r.p, c) for r in got for c in r.l) == Counter(links)


def test_children_without_a_row_take_no_place_and_links_are_read_once(spark, tmp_path):
    spark.createDataFrame([(1, c) for c in range(300)] + [(2, 3), (2, 3), (3, 299)], "p BIGINT, c BIGINT").write.parquet(f"{tmp_path}/links")
    known = spark.range(0, 300, 2).select(F.col("id").alias("c"), F.concat(F.lit("n"), "id").alias("name"), F.lit("x").alias("p"))
    links = spark.read.parquet(f"{tmp_path}/links")
    df = collect_children(links, "p", "c", F.col("name"), "l", page=100, children=known.drop("p"))
    got = {(r.p, r.parte): r.l for r in df.collect()}
    assert {k: len(v) for k, v in got.items()} == {(1, 0): 100, (1, 1): 50}
    assert sorted(n for v in got.values() for n in v) == sorted(f"n{c}" for c in range(0, 300, 2))
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


@pytest.mark.parametrize("page", [4, 100])
def test_repeated_links_count_once_and_equal_elements_stay(spark, page):
    links = spark.createDataFrame([(1, c % 9) for c in range(90)] + [(2, 3), (2, 3), (None, 5)], "p BIGINT, c BIGINT")
    named = spark.createDataFrame([(c, f"n{c // 2}") for c in range(8)], "c BIGINT, name STRING")
    got = collect_children(links, "p", "c", F.col("name"), "l", page, named, repeated=True).collect()
    found = sorted((r.p, n) for r in got for n in r.l)
    assert found == sorted([(1, f"n{c // 2}") for c in range(8)] + [(2, "n1")])
    assert sorted((r.p, r.parte) for r in got) == ([(1, 0), (1, 1), (2, 0)] if page == 4 else [(1, 0), (2, 0)])


def test_lists_of_one_page_need_no_ranks(spark):
    links = spark.range(500).select((F.col("id") % 50).alias("p"), F.col("id").alias("c"))
    plan = lambda page: collect_children(links, "p", "c", F.col("c"), "l", page)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan(100) and "Window" in plan(5)


def test_paged_documents(tables, spark, tmp_path):
    books = spark.createDataFrame([(i, f"t{i:02d}", DAY, 1) for i in range(1, 26)], NORMALISED["libros"])
    lines = spark.createDataFrame([(1, i) for i in range(1, 26)], NORMALISED["prestamo_libro"])
    hot = {**tables, "libros": books, "prestamo_libro": lines}
    df = documents.build_collection(hot, "Prestamos", page=10)
    parts = {(r["_id"], r.parte): [b.titulo for b in r.libros] for r in df.collect()}
    assert parts.keys() == {(1, 0), (1, 1), (1, 2), (2, 0)}
    assert sorted(t for v in parts.values() for t in v) == [f"t{i:02d}" for i in range(1, 26)]
    collections = documents.build_documents(hot, page=10)
    assert {r.coleccion: r.documentos for r in documents.count_documents(collections).collect()}["prestamos"] == 2
    documents.write_documents(collections, str(tmp_path))
    assert spark.read.json(str(tmp_path / "prestamos")).count() == 4
    assert documents.write_documents(collections, str(tmp_path)) == {r.coleccion: r.documentos for r in documents.count_documents(collections).collect()}
    counted = documents.count_written(spark, collections, str(tmp_path)).collect()
    assert {r.coleccion: r.documentos for r in counted}["prestamos"] == 2


def test_written_json_keeps_nulls_and_shape(tables, spark, tmp_path):
    documents.write_documents(documents.build_documents(tables), str(tmp_path))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "libros")).collect()]
    by_id = {d["_id"]: d for d in lines}
    assert list(by_id[2]) == ["_id", "titulo", "fecha", "editorial", "autores", "categorias", "parte"]
    assert by_id[2]["fecha"] is None and by_id[2]["autores"] == []
    # Written again, the collection is replaced.
    documents.write_documents(documents.build_documents(tables), str(tmp_path))
    assert spark.read.text(str(tmp_path / "libros")).count() == 2


def test_mapping_from_file(tables, tmp_path, rows):
    path = tmp_path / "mapping.json"
    path.write_text(json.dumps({"Usuarios": {"collection": "u", "fields": {"id_usuario": "_id"}}}), encoding="utf-8")
    mapping = load_mapping(str(path))
    assert rows(documents.build_documents(tables, mapping)["u"]) == [(1,), (2,)]
    assert set(DEFAULT_MAPPING) == {"Libros", "Usuarios", "Prestamos", "Inventario"}


def test_committed_collections(tables, spark, tmp_path, rows):
    """The same documents and counts through the sink with commit, and the old ones after a failed export."""
    collections = documents.build_documents(tables)
    counts = {r.coleccion: r.documentos for r in documents.count_documents(collections).collect()}
    for _ in range(2):
        assert documents.write_documents(collections, str(tmp_path), "coleccion") == counts
    broken = {"libros": collections["libros"].withColumn("titulo", F.raise_error(F.lit("broken")).cast("string"))}
    with pytest.raises(PySparkException):
        documents.write_documents(broken, str(tmp_path), "coleccion")
    assert rows(documents.count_written(spark, collections, str(tmp_path), "coleccion")) == sorted(counts.items())
