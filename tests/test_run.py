"""The whole process, and the streams, on small data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from anaquel.operators import movements, stock
from anaquel.plans.rules import DEFAULT_RULES
from anaquel.plans.run import run
from anaquel.schema import NORMALISED
from anaquel.sources import tables as io
from anaquel.sources.synthetic import synthetic_legacy
from anaquel.streaming.checks import check_stream, flag_errors
from anaquel.streaming.loans import register_batch, register_stream
from tests.test_quality import GOLDEN

REQUESTS = "secuencia BIGINT, correo STRING, id_libro BIGINT, estado STRING"

# The part of the log about the normalised tables.
GOLDEN_NORMALISED = [
    "[VALIDACION] Tabla: Libros | Columna: fecha_publicacion | Tipo: formato_fecha | Errores: 0",
    "[VALIDACION] Tabla: Reseñas | Columna: calificacion | Tipo: rango_numerico | Errores: 0",
    "[VALIDACION] Tabla: Usuarios | Columna: correo | Tipo: regex | Errores: 0",
]


def test_whole_run(spark, rows, tmp_path):
    moment = dt.datetime(2026, 12, 1, 9)
    for times in (1, 2):
        counts = run(spark, synthetic_legacy(spark), str(tmp_path), moment.date(), moment, links_per_loan=3)
        got = {r.coleccion: r.documentos for r in counts.collect()}
        assert got == {"libros": 250, "usuarios": 250, "prestamos": 250, "inventario": 250}
        log = sorted(r.value for r in spark.read.text(str(tmp_path / "errores")).collect())
        assert log == sorted(GOLDEN + GOLDEN_NORMALISED)
        audit = spark.read.parquet(str(tmp_path / "log_prestamos"))
        assert audit.count() == audit.select("id_log").distinct().count() == 250 * times
    assert spark.read.json(str(tmp_path / "documentos" / "prestamos")).count() == 250
    assert spark.read.parquet(str(tmp_path / "informes" / "top_multas")).count() == 10
    assert spark.read.parquet(str(tmp_path / "informes" / "libros_mas_prestados")).count() == 200


@pytest.fixture
def shop(spark):
    return {
        "usuarios": spark.createDataFrame([(1, "Ana", "a@x.c")], NORMALISED["usuarios"]),
        "inventario": spark.createDataFrame([(1, 1, 3), (2, 1, 9)], NORMALISED["inventario"]),
        "prestamos": spark.createDataFrame([(10, 1, None, "Activo")], NORMALISED["prestamos"]),
    }


def test_streamed_requests_equal_one_batch(spark, shop, rows, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    day = F.lit(dt.date(2026, 3, 1))
    every = []
    for n in range(3):
        batch = [(10 * n + i, "a@x.c" if i else "nobody", 1, "Activo") for i in range(3)]
        every += batch
        io.write_table(spark.createDataFrame(batch, REQUESTS).coalesce(1), str(source), mode="append")
        stream = spark.readStream.schema(REQUESTS).parquet(str(source))
        query = register_stream(stream, shop, target, str(tmp_path / "checkpoint"), day)
        query.awaitTermination(120)
        assert query.exception() is None
    got = spark.read.parquet(target)
    want = movements.register_loans(
        spark.createDataFrame(every, REQUESTS), shop["usuarios"], shop["inventario"], shop["prestamos"], day
    )
    columns = ["secuencia", "id_prestamo", "id_usuario", "id_libro", "resultado"]
    assert rows(got, *columns) == rows(want, *columns)
    assert got.filter(F.col("resultado") == stock.ACCEPTED).count() == 3
    assert got.select("batch").distinct().count() == 3


def test_batch_that_runs_again_changes_nothing(spark, shop, rows, tmp_path):
    target, day = str(tmp_path / "out"), F.lit(dt.date(2026, 3, 1))
    batches = [spark.createDataFrame([(n, "a@x.c", 1, "Activo")], REQUESTS) for n in range(5)]
    for n, df in enumerate(batches):
        register_batch(df, n, shop, target, day)
    before = rows(spark.read.parquet(target), "secuencia", "id_prestamo", "resultado")
    assert [r[1] for r in before] == [11, 12, 13, None, None]
    register_batch(batches[1], 1, shop, target, day)
    register_batch(batches[4], 4, shop, target, day)
    assert rows(spark.read.parquet(target), "secuencia", "id_prestamo", "resultado") == before


def test_work_of_a_batch_does_not_grow_with_the_batches(spark, shop, tmp_path):
    target, day = str(tmp_path / "out"), F.lit(dt.date(2026, 3, 1))
    for n in range(4):
        register_batch(spark.createDataFrame([(n, "a@x.c", 1, "Activo")], REQUESTS), n, shop, target, day)
        state = spark.read.parquet(f"{target}_estado/batch={n}").collect()
        assert [(r.id_libro, r.aceptados, r.ultimo) for r in state] == [(1, min(n + 1, 3), 10 + min(n + 1, 3))]


def test_checked_stream(spark, rows, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id_prestamo BIGINT, correo_usuario STRING, libros_prestados STRING"
    data = [(1, "a@b.c", "x"), (2, "bad", "x"), (3, None, "x, y")]
    spark.createDataFrame(data, schema).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    query = check_stream(stream, "Prestamos_Crudos", "legacy", target, str(tmp_path / "cp"), DEFAULT_RULES)
    query.awaitTermination(120)
    # Folder names are text, so the reader declares the type.
    marked = spark.read.schema(f"{schema}, errores ARRAY<STRING>, rechazada BOOLEAN").parquet(target)
    got = {r.id_prestamo: (r.errores, r.rechazada) for r in marked.collect()}
    assert got == {
        1: ([], False),
        2: (["correo_usuario:regex"], True),
        3: (["correo_usuario:regex", "libros_prestados:multivalor"], True),
    }


def test_flags_without_rules(spark):
    row = flag_errors(spark.range(1), "sin_reglas", "legacy").first()
    assert (row.errores, row.rechazada) == ([], False)


def test_files_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k BIGINT, v STRING")
    for fmt in ("parquet", "json", "orc"):
        io.write_table(df, str(tmp_path / fmt / "t"), fmt=fmt)
        io.write_table(df, str(tmp_path / fmt / "t"), fmt=fmt)
        back = io.read_files(spark, str(tmp_path / fmt), "t", fmt, schema="k BIGINT, v STRING")
        assert rows(back) == [(1, "a"), (2, None)]


def test_jdbc_options():
    options = io.jdbc_options("jdbc:x", "t", "id", 1, 1000, 8, user="u")
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "id" and options["user"] == "u"
    assert "numPartitions" not in io.jdbc_options("jdbc:x", "t", partitions=1)
    with pytest.raises(ValueError):
        io.jdbc_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        io.jdbc_options("jdbc:x", "t", partitions=4)
