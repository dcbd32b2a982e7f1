from pathlib import Path

import pytest

from anaquel.plans import quality
from anaquel.plans.rules import DEFAULT_RULES
from anaquel.sources.star import legacy_tables
from anaquel.sources.synthetic import synthetic_legacy

# The log of a run over 250 generated rows per table, legacy part.
GOLDEN = [
    "[VALIDACION] Tabla: Biblioteca_Data | Columna: fecha_publicacion | Tipo: formato_fecha | Errores: 0",
    "[VALIDACION] Tabla: Biblioteca_Data | Columna: categoria_y_descripcion | Tipo: campo_combinado | Errores: 250",
    "[VALIDACION] Tabla: Prestamos_Crudos | Columna: correo_usuario | Tipo: regex | Errores: 0",
    "[VALIDACION] Tabla: Prestamos_Crudos | Columna: libros_prestados | Tipo: multivalor | Errores: 250",
    "[VALIDACION] Tabla: Reseñas_Usuarios | Columna: calificacion | Tipo: rango_numerico | Errores: 0",
]


def test_golden_log(spark):
    lines = quality.log_lines(quality.quality_report(synthetic_legacy(spark), "legacy")).orderBy("orden")
    assert [r.linea for r in lines.collect()] == GOLDEN


def test_report_has_rule_attributes(spark):
    report = {r.columna: r for r in quality.quality_report(synthetic_legacy(spark, 20), "legacy").collect()}
    assert report["libros_prestados"].accion == "log_warning"
    assert report["libros_prestados"].mensaje == "Campo multivalor detectado"
    assert all(r.conocida and r.filas == 20 for r in report.values())


def test_report_schema_is_declared(spark):
    report = quality.quality_report(synthetic_legacy(spark, 5), "legacy")
    empty = quality.quality_report({}, "no such context")
    assert [(f.name, f.dataType) for f in report.schema] == [(f.name, f.dataType) for f in empty.schema]
    assert empty.count() == 0


def test_unknown_kind_is_flagged_and_counts_nothing(spark):
    rules = {"T": [{"columna": "v", "tipo_validacion": "nuevo", "contexto": "legacy"}]}
    row = quality.quality_report({"t": spark.createDataFrame([("x",)], "v STRING")}, "legacy", rules).first()
    assert (row.conocida, row.errores) == (False, 0)


def test_empty_table_has_no_errors(spark):
    rules = {"T": [{"columna": "v", "tipo_validacion": "formato_fecha", "contexto": "legacy"}]}
    row = quality.quality_report({"t": spark.createDataFrame([], "v STRING")}, "legacy", rules).first()
    assert (row.filas, row.errores) == (0, 0)


@pytest.mark.parametrize("tables", [{}, {"t": "w STRING"}])
def test_unknown_table_or_column_is_refused_before_any_job(spark, tables):
    frames = {name: spark.createDataFrame([], schema) for name, schema in tables.items()}
    rules = {"T": [{"columna": "v", "tipo_validacion": "regex", "patron": "x", "contexto": "legacy"}]}
    with pytest.raises(ValueError, match="unknown"):
        quality.quality_report(frames, "legacy", rules)


def test_rejected_values(spark, rows):
    tables = {"biblioteca_data": spark.createDataFrame(
        [("2024-01-05", "a / b"), ("x", "c"), (None, None)], "fecha_publicacion STRING, categoria_y_descripcion STRING"
    )}
    rules = {"Biblioteca_Data": DEFAULT_RULES["Biblioteca_Data"]}
    got = rows(quality.rejected_values(tables, "legacy", rules), "columna", "valor")
    assert got == [("categoria_y_descripcion", "a / b"), ("fecha_publicacion", None), ("fecha_publicacion", "x")]


def test_rules_of_a_table_take_one_scan(spark):
    df = spark.range(10).selectExpr("cast(id as string) v")
    rules = {"T": [
        {"columna": "v", "tipo_validacion": kind, "contexto": "legacy", "patron": "1", "min": 1, "max": 5, "separador": ","}
        for kind in quality.KINDS
    ]}
    plan = quality.quality_report({"t": df}, "legacy", rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 10") == 1


def test_log_starts_with_legacy_and_grows(spark, tmp_path):
    tables = synthetic_legacy(spark, 10)
    later = {"T": [{"columna": "calificacion", "tipo_validacion": "rango_numerico", "min": 1, "max": 5, "contexto": "normalizada"}]}
    path = str(tmp_path / "log")
    for _ in range(2):
        quality.write_log(quality.quality_report(tables, "legacy"), path, starts=True)
        quality.write_log(quality.quality_report({"t": tables["resenas_usuarios"]}, "normalizada", later), path)
    assert spark.read.text(path).count() == 6


def test_log_without_a_rule_of_the_starting_context(spark, tmp_path):
    tables = {"t": synthetic_legacy(spark, 10)["resenas_usuarios"]}
    later = {"T": [{"columna": "calificacion", "tipo_validacion": "rango_numerico", "min": 1, "max": 5, "contexto": "normalizada"}]}
    path = str(tmp_path / "log")
    for _ in range(2):
        quality.write_log(quality.quality_report(tables, "legacy", later), path, starts=True)
        quality.write_log(quality.quality_report(tables, "normalizada", later), path)
    assert spark.read.text(path).count() == 1


def test_compare_contexts(spark):
    schema = "contexto STRING, tipo STRING, errores BIGINT"
    before = spark.createDataFrame([("legacy", "regex", 3), ("legacy", "multivalor", 5)], schema)
    after = spark.createDataFrame([("normalizada", "regex", 1)], schema)
    got = {r.tipo: (r.errores_legacy, r.errores_normalizada) for r in quality.compare_contexts(before, after).collect()}
    assert got == {"regex": (3, 1), "multivalor": (5, 0)}


def test_observed_report_is_the_counted_one(spark, tmp_path):
    tables = synthetic_legacy(spark)
    observed = quality.ObservedReport(tables, "legacy")
    for name, df in tables.items():
        observed.watch(name, df).write.parquet(str(tmp_path / name))
    assert sorted(observed.report(spark).collect()) == sorted(quality.quality_report(tables, "legacy").collect())
    assert observed.report(spark).count() == 5


def test_titles_are_read_only_for_rules_on_them(spark):
    """The plan of the rule on e-mails has no scan of the lines; that of the rule on lists has."""
    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        pytest.skip("no test data")
    assert quality.asks_for("Prestamos_Crudos", "libros_prestados", "legacy") and not quality.asks_for("Prestamos_Crudos", "libros_prestados", "normalizada")
    for kind, lines in (("regex", False), ("multivalor", True)):
        titles = quality.asks_for("prestamos_crudos", "libros_prestados", "legacy", kind=kind)
        report = quality.quality_report(legacy_tables(spark, folder, titles=titles), "legacy", kind=kind)
        assert ("lineitem" in "".join(report.inputFiles())) == lines == titles
