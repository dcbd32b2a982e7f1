import datetime as dt

from anaquel.operators import constraints
from anaquel.plans.load import violations
from anaquel.schema import MAX_LENGTHS, NORMALISED, Reference


def test_primary_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "a INT, b INT")
    row = constraints.primary_key_check(df, "t", ("a", "b")).first()
    assert (row.filas, row.nulos, row.duplicados) == (5, 2, 1)


def test_primary_key_of_counted_rows(spark):
    df = spark.createDataFrame([(1, 1), (2, 3)], "a INT, _n BIGINT")
    row = constraints.primary_key_check(df, "t", ("a",)).first()
    assert (row.filas, row.duplicados) == (4, 1)


def test_empty_table(spark):
    row = constraints.primary_key_check(spark.createDataFrame([], "a INT"), "t", ("a",)).first()
    assert (row.filas, row.nulos, row.duplicados) == (0, 0, 0)


def test_foreign_keys(spark):
    # One orphan value held by many rows, nulls that refer to nothing, a parent that occurs twice.
    child = spark.createDataFrame([(9,)] * 40 + [(1,)] * 3 + [(2,), (None,), (None,)], "k BIGINT")
    parent = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k BIGINT")
    references = [Reference("c", "k", "p"), Reference("d", "k", "p"), Reference("empty", "k", "p")]
    tables = {"c": child, "p": parent, "d": parent, "empty": parent.limit(0)}
    got = {r.tabla: (r.padre, r.filas, r.huerfanas) for r in constraints.foreign_key_report(tables, references).collect()}
    assert got == {"c": ("p", 44, 40), "d": ("p", 4, 0), "empty": ("p", 0, 0)}


def test_lengths(spark):
    df = spark.createDataFrame([("abc",), ("abcdef",), ("ñññ",), (None,)], "v STRING")
    row = constraints.length_check(df, "t", [("v", 3)]).first()
    assert (row.limite, row.maximo, row.excedidas) == (3, 6, 1)


def test_violations_of_a_load(spark):
    tables = {name: spark.createDataFrame([], schema) for name, schema in NORMALISED.items()}
    assert violations(tables).count() == 0
    long = "x" * (MAX_LENGTHS[("prestamos", "estado")] + 1)
    tables["prestamos"] = spark.createDataFrame(
        [(1, 77, dt.date(2026, 1, 1), "ok"), (1, None, None, long)], NORMALISED["prestamos"]
    )
    got = {(r.restriccion, r.tabla, r.columnas): r.infracciones for r in violations(tables).collect()}
    assert got == {
        ("clave primaria", "prestamos", "id_prestamo"): 1,
        ("clave foranea", "prestamos", "id_usuario"): 1,
        ("longitud", "prestamos", "estado"): 1,
    }


def test_a_parent_row_is_one_row_of_the_grouping(spark, monkeypatch):
    """Three references to one parent: its values are held once, not once a reference."""
    references = [Reference(child, "id", "p") for child in ("a", "b", "c")]
    tables = {name: spark.range(5).toDF("id") for name in ("p", "a", "b")} | {"c": spark.range(3, 9).toDF("id")}
    met = []
    union = constraints._union
    monkeypatch.setattr(constraints, "_union", lambda frames: met.append(union(frames)) or met[0])
    report = constraints.foreign_key_report(tables, references).select("tabla", "filas", "huerfanas").collect()
    assert sorted(tuple(r) for r in report) == [("a", 5, 0), ("b", 5, 0), ("c", 6, 4)]
    assert met[0].count() == 5 + 5 + 5 + 6


def test_keys_of_a_branch_are_folded(spark, monkeypatch):
    """All branches of a book are one row of the grouping; repeated and incomplete keys count as before."""
    staged = []
    monkeypatch.setattr(constraints, "stage", lambda df, name: staged.append(df) or df)
    rows = [(sede, libro, 1) for sede in range(-3, 60) for libro in range(20)]
    df = spark.createDataFrame(rows, "id_sede BIGINT, id_libro BIGINT, _n BIGINT")
    row = constraints.primary_key_check(df, "inventario", ("id_sede", "id_libro")).first()
    assert (row.filas, row.nulos, row.duplicados) == (1260, 0, 0)
    assert staged[0].count() == 40  # negative ids are a block of their own
    odd = [(5, 3, 1), (5, 3, 1), (6, 3, 1), (70, 3, 4), (None, 3, 2), (1, None, 1), (1, None, 1), (-1, 4, 1)]
    odd = spark.createDataFrame(odd, df.schema)
    row = constraints.primary_key_check(odd, "inventario", ("id_sede", "id_libro")).first()
    assert (row.filas, row.nulos, row.duplicados) == (12, 4, 2)
