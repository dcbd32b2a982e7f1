"""The migration on small raw tables: what each mode makes of untidy keys."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest

from anaquel.operators.constraints import MULTIPLICITY, foreign_key_report, primary_key_report
from anaquel.plans.elt import COMPATIBLE, STRICT, InvalidValue, Migration, simulated_links
from anaquel.plans import elt, load
from anaquel.plans.load import LoadRefused, current_tables, publish
from anaquel.schema import LEGACY, NORMALISED
from anaquel.sources.synthetic import synthetic_legacy
from pyspark.sql import functions as F

DAY = dt.date(2026, 1, 2)


@pytest.fixture(scope="module")
def legacy(spark):
    def tables(books=(), loans=(), stock=(), reviews=()):
        data = dict(zip(LEGACY, (books, loans, stock, reviews)))
        return {name: spark.createDataFrame(list(data[name]), schema) for name, schema in LEGACY.items()}

    return tables


def book(key, title, author="A", category="c / d", publisher="X", date="2024-01-05"):
    return (key, title, author, category, publisher, date)


def joined(m, bridge, left, right):
    """A bridge as pairs of names, to be independent of ids."""
    (left_table, left_id, left_name), (right_table, right_id, right_name) = left, right
    pairs = (
        m.table(bridge)
        .join(m.table(left_table).select(left_id, F.col(left_name).alias("l")), left_id)
        .join(m.table(right_table).select(right_id, F.col(right_name).alias("r")), right_id)
    )
    return sorted((r.l, r.r) for r in pairs.collect())


def test_publishers_distinct_before_trim(legacy, rows):
    raw = legacy(books=[book(1, "t1"), book(2, "t2", publisher=" X"), book(3, "t3", publisher=None)])
    m = Migration(raw)
    assert rows(m.table("editoriales"), "id_editorial", "nombre") == [(1, None), (2, " X"), (3, "X")]
    assert rows(m.table("libros"), "titulo") == [("t1",), ("t1",), ("t2",), ("t2",)]
    strict = Migration(raw, STRICT)
    assert rows(strict.table("editoriales")) == [(1, "X")]
    assert rows(strict.table("libros"), "titulo", "id_editorial") == [("t1", 1), ("t2", 1), ("t3", None)]


def test_users_sharing_a_mail(legacy, rows):
    raw = legacy(loans=[(7, "Ana", "m@x.c", None, DAY, "Activo"), (8, "Eva", "m@x.c ", None, DAY, "Activo")])
    m = Migration(raw)
    assert m.table("usuarios").count() == 2
    assert rows(m.table("prestamos"), "id_prestamo", "id_usuario") == [(1, 1), (2, 2), (3, 1), (4, 2)]
    strict = Migration(raw, STRICT)
    assert rows(strict.table("prestamos"), "id_prestamo", "id_usuario") == [(1, 1), (2, 2)]


def test_categories_are_matched_by_name(legacy, rows):
    raw = legacy(books=[book(1, "t1", category="n / x"), book(2, "t2", category="n / y")])
    left, right = ("libros", "id_libro", "titulo"), ("categorias", "id_categoria", "descripcion")
    assert joined(Migration(raw), "libro_categoria", left, right) == [("t1", "x"), ("t1", "y"), ("t2", "x"), ("t2", "y")]
    assert joined(Migration(raw, STRICT), "libro_categoria", left, right) == [("t1", "x"), ("t2", "y")]


def test_category_split(legacy, rows):
    raw = legacy(books=[book(1, "t1", category="abc"), book(2, "t2", category="a/b/c"), book(3, "t3", category=None)])
    assert rows(Migration(raw).table("categorias"), "nombre", "descripcion") == [(None, None), ("a", "b"), ("abc", "")]


def test_branch_with_two_addresses(legacy, rows):
    raw = legacy(books=[book(1, "t")], stock=[("S", "one", "t", 5), ("S", "two", " t", 3)])
    m = Migration(raw)
    assert rows(m.table("inventario"), "id_sede", "cantidad") == [(1, 3), (1, 5), (2, 3), (2, 5)]
    broken = primary_key_report({"inventario": m.raw("inventario")}).first()
    assert broken.duplicados == 2
    assert rows(Migration(raw, STRICT).table("inventario"), "id_sede", "cantidad") == [(1, 5), (2, 3)]


def test_duplicate_title_with_two_authors(legacy):
    raw = legacy(books=[book(1, "t", "A"), book(2, "t", "B")])
    left, right = ("libros", "id_libro", "id_libro"), ("autores", "id_autor", "nombre")

    def pairs(m):
        return m.table("libro_autor").join(m.table("autores"), "id_autor").select("id_libro", "nombre").collect()

    assert sorted(tuple(r) for r in pairs(Migration(raw))) == [(1, "A"), (1, "B"), (2, "A"), (2, "B")]
    assert sorted(tuple(r) for r in pairs(Migration(raw, STRICT))) == [(1, "A"), (2, "B")]


def test_duplicate_title_and_author_breaks_the_key(legacy, tmp_path):
    raw = legacy(books=[book(1, "t"), book(2, "t")])
    m = Migration(raw)
    report = primary_key_report({"libro_autor": m.raw("libro_autor")}).first()
    assert (report.filas, report.duplicados) == (4, 2)
    with pytest.raises(LoadRefused, match="libro_autor|libro_categoria"):
        publish(m.tables(), str(tmp_path / "n"))
    assert not (tmp_path / "n").exists()


def test_copies_of_a_raw_loan_are_loans_of_their_own(legacy, rows):
    raw = legacy(loans=[(7, "Ana", "m@x.c", None, DAY, "Activo")] * 5 + [(1, "Eva", "e@x.c", None, DAY, "Activo")])
    assert rows(Migration(raw).table("prestamos"), "id_prestamo", "id_usuario") == [(1, 2)] + [(i, 1) for i in range(2, 7)]


def test_reviews_match_the_new_user_id(legacy, rows):
    raw = legacy(
        books=[book(1, "t")],
        loans=[(7, "Ana", "m@x.c", None, DAY, "Activo")],
        reviews=[(1, " t ", "good", "4"), (2, "t", "nobody", "4"), (1, "u", "no book", "4"), (1, "t", "odd", "cinco")],
    )
    assert rows(Migration(raw).table("resenas"), "comentario", "calificacion") == [("good", 4), ("odd", None)]
    assert rows(Migration(raw, invalid="drop").table("resenas"), "comentario", "calificacion") == [("good", 4)]
    assert rows(Migration(raw).quarantine(), "columna", "valor", "filas") == [("calificacion", "cinco", 1)]
    with pytest.raises(InvalidValue, match="cinco"):
        Migration(raw, invalid="abort")


def test_bad_dates(legacy, rows):
    raw = legacy(books=[book(1, "t1", date="2024-02-30"), book(2, "t2", date=None), book(3, "t3", date="2024-1-5")])
    assert rows(Migration(raw).table("libros"), "titulo", "fecha_publicacion") == [
        ("t1", None), ("t2", None), ("t3", dt.date(2024, 1, 5)),
    ]
    assert rows(Migration(raw, invalid="drop").table("libros"), "titulo") == [("t2",), ("t3",)]


def test_links_come_from_the_list_and_its_further_pages(legacy, rows, spark):
    raw = legacy(
        books=[book(1, "one"), book(2, "two"), book(3, "two")],
        loans=[(7, "Ana", "m@x.c", "one, two ,none, one", DAY, "Activo"), (8, "Ana", "m@x.c", None, DAY, "Activo")],
    )
    assert rows(Migration(raw).table("prestamo_libro")) == [(1, 1), (1, 2), (1, 3)]
    pages = spark.createDataFrame([(8, 1, "two"), (9, 1, "one")], "id_prestamo BIGINT, parte INT, libros_prestados STRING")
    more = {**raw, "prestamos_crudos_paginas": pages}
    assert rows(Migration(more).table("prestamo_libro")) == [(1, 1), (1, 2), (1, 3), (2, 2), (2, 3)]
    assert rows(Migration(more, STRICT).table("prestamo_libro")) == [(1, 1), (1, 2), (2, 2)]
    assert Migration(raw, links_per_loan=3).table("prestamo_libro").count() > 0


def test_loans_that_repeat_a_raw_id_keep_their_own_lists(legacy, rows):
    lists = ["one", "two", "one,two", None, "one", ""]
    raw = legacy(
        books=[book(1, "one"), book(2, "two")],
        loans=[(key, "Ana", "m@x.c", listed, DAY, "Activo") for key in (7, None) for listed in lists],
    )
    for mode in (COMPATIBLE, STRICT):
        m = Migration(raw, mode)
        loans, links = m.table("prestamos"), m.table("prestamo_libro")
        per_loan = loans.join(links, "id_prestamo", "left").groupBy("id_prestamo").agg(F.sort_array(F.collect_list("id_libro")).alias("books"))
        assert rows(loans, "id_prestamo") == [(i,) for i in range(1, 13)]
        assert sorted(r.books for r in per_loan.collect()) == sorted(2 * [[1], [2], [1, 2], [], [1], []])


def test_loans_without_lists_need_none(legacy, rows):
    raw = legacy(loans=[(8, "Ana", "m@x.c", "b", DAY, "Activo"), (7, "Ana", "m@x.c", "a", DAY, "Activo")])
    bare = {**raw, "prestamos_crudos": raw["prestamos_crudos"].drop("libros_prestados")}
    assert rows(Migration(bare).table("prestamos")) == rows(Migration(raw).table("prestamos"))


def test_page_size_changes_no_result(spark, rows):
    from anaquel.plans import quality
    from anaquel.sources.star import legacy_tables

    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        pytest.skip("no test data")
    paged, whole = (legacy_tables(spark, folder, page=page) for page in (3, 100_000))
    assert paged["prestamos_crudos_paginas"].count() > 0 and whole["prestamos_crudos_paginas"].count() == 0
    assert rows(Migration(paged).table("prestamos")) == rows(Migration(whole).table("prestamos"))
    assert rows(Migration(paged).table("prestamo_libro")) == rows(Migration(whole).table("prestamo_libro"))
    report = [rows(quality.quality_report(t, "legacy"), "orden", "filas", "errores") for t in (paged, whole)]
    assert report[0] == report[1]


def test_strict_links_come_from_the_list(legacy, rows):
    raw = legacy(
        books=[book(1, "one"), book(2, "two"), book(3, "two")],
        loans=[(7, "Ana", "m@x.c", "one, two ,none, one", DAY, "Activo"), (8, "Ana", "m@x.c", None, DAY, "Activo")],
    )
    assert rows(Migration(raw, STRICT).table("prestamo_libro")) == [(1, 1), (1, 2)]


def test_simulated_links(spark, rows):
    loans = spark.range(1, 201).withColumnRenamed("id", "id_prestamo")
    got = rows(simulated_links(loans, F.lit(50), 4))
    want = sorted({(i, (i * 7919 + j * 104729) % 50 + 1) for i in range(1, 201) for j in range(4)})
    assert got == want
    assert simulated_links(loans, F.lit(0), 4).count() == 0


@pytest.mark.parametrize("mode", [COMPATIBLE, STRICT])
def test_synthetic_load_is_clean_and_published(spark, tmp_path, mode):
    m = Migration(synthetic_legacy(spark), mode, invalid="abort")
    publish(m.tables(), str(tmp_path))
    tables = current_tables(spark, str(tmp_path))
    assert tables.keys() == NORMALISED.keys()
    assert tables["libros"].count() == 250
    assert all(r.nulos == r.duplicados == 0 for r in primary_key_report(tables).collect())
    assert all(r.huerfanas == 0 for r in foreign_key_report(tables).collect())


def test_second_load_replaces_the_first(spark, tmp_path):
    for n in (20, 30):
        publish(Migration(synthetic_legacy(spark, n)).tables(), str(tmp_path))
        assert current_tables(spark, str(tmp_path))["prestamos"].count() == n


def test_unknown_mode_and_policy(legacy):
    with pytest.raises(ValueError):
        Migration({}, mode="other")
    with pytest.raises(ValueError):
        Migration({}, invalid="other")


def test_two_publishers_get_two_numbers(spark, tmp_path, monkeypatch):
    """A publisher that read the pointers before another one added its own goes on to the next number."""
    folder, tables = str(tmp_path), Migration(synthetic_legacy(spark, 20)).tables()
    loads = [publish(tables, folder)]
    whole = load._newest
    monkeypatch.setattr(load, "_newest", lambda spark, folder: (0, None))
    loads.append(publish(tables, folder))
    monkeypatch.setattr(load, "_newest", whole)
    assert load._newest(spark, folder) == (2, loads[1])
    with ThreadPoolExecutor(4) as pool:
        claimed = list(pool.map(lambda n: load._claim(spark, folder, 3, f"carga-{n}"), range(4)))
    assert any(claimed) and not load._claim(spark, folder, 3, "late")
    # A pointer that was never finished is skipped, and its number stays taken.
    (tmp_path / load.CURRENT / "000000000004").write_text("half a path")
    assert load._newest(spark, folder)[0] == 4 and load._newest(spark, folder)[1].startswith("carga-")
    assert publish(tables, folder) == load._newest(spark, folder)[1]
    assert current_tables(spark, folder)["libros"].count() == tables["libros"].count()


def test_nothing_published(spark, tmp_path):
    with pytest.raises(load.NoLoad):
        current_tables(spark, str(tmp_path))


def test_fanout_is_the_size_of_the_joins(spark):
    legacy = synthetic_legacy(spark, 30)
    books, loans = legacy["biblioteca_data"], legacy["prestamos_crudos"]
    # Titles shared by many books, authors that differ in blanks, users without mail.
    legacy["biblioteca_data"] = books.withColumns(
        {
            "titulo_libro": F.concat(F.lit("t"), (F.hash("titulo_libro") % 4).cast("string")),
            "autor_nombre": F.when(F.hash("titulo_libro") % 3 != 0, F.concat(F.lit(" "), "autor_nombre")).otherwise(F.col("autor_nombre")),
        }
    )
    legacy["prestamos_crudos"] = loans.withColumn("correo_usuario", F.when(F.hash("id_prestamo") % 5 != 0, F.col("correo_usuario")))
    migration = Migration(legacy, COMPATIBLE)
    found = {r.paso: r.filas for r in migration.fanout().collect()}
    tables = migration.tables()

    for step in ("libros", "prestamos", "resenas"):
        assert found[step] == tables[step].count()
    for step in ("libro_autor", "libro_categoria", "inventario"):
        assert found[step] == (tables[step].agg(F.sum(MULTIPLICITY)).first()[0] or 0)
    assert found["libro_categoria"] > 30
    with pytest.raises(ValueError):
        Migration(legacy, STRICT).fanout()


def test_titles_travel_once_with_the_id_of_their_loan(legacy, rows, monkeypatch):
    """Lists are cut after their loan took them, so links need no further join; copies of a raw loan hold one list."""
    keys, read = [], []
    cut = elt.listed_links
    monkeypatch.setattr(elt, "listed_links", lambda lists, titles, *key: keys.append(key) or read.append(lists) or cut(lists, titles, *key))
    loan = (1, "Ana", "a@x", "t1, t2, t1", dt.date(2024, 1, 1), "Activo")
    m = Migration(legacy(books=[book(1, "t1"), book(2, "t2")], loans=[loan, loan]))
    assert rows(m.table("prestamo_libro"), "id_prestamo", "id_libro") == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert keys == [("id_prestamo",)] and read[0].count() == 2


def test_small_lookups_are_written_before_they_are_joined(legacy, monkeypatch):
    """A numbered table joins a local one, so its size is not known to a plan before it is written."""
    staged = []
    write = elt.stage
    monkeypatch.setattr(elt, "stage", lambda df, name: staged.append(name) or write(df, name))
    Migration(legacy(books=[book(1, "t")], stock=[("S", "one", "t", 5)])).table("inventario")
    assert {"lookup_publishers", "lookup_branches"} <= set(staged)
