"""The registered queries: every operator over the whole star-schema tables of a folder.

Nested results are flattened to text here, and only here, so that they can be compared as rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.operators import constraints, movements, stock
from anaquel.operators.links import bernoulli_links
from anaquel.operators.numbering import number_rows
from anaquel.plans import documents, elt, load, quality, reports
from anaquel.session import tune
from anaquel.sources.staging import stage
from anaquel.sources.star import legacy_tables, library_tables, star_bytes, star_table

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-08-01"
RUN_TIME = "2001-08-01 12:00:00"
CATEGORY = "NATION_3"
EXPECTED_LINKS = 3


def _as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def _legacy(table: str) -> Query:
    return lambda spark, folder: legacy_tables(spark, folder)[table]


def _library(build: Callable[[Mapping[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, folder: build(library_tables(spark, folder))


def _migration(
    build: Callable[[elt.Migration], DataFrame], mode: str = elt.COMPATIBLE, titles: bool = True, link_probability: float | None = None
) -> Query:
    return lambda spark, folder: build(
        elt.Migration(legacy_tables(spark, folder, written=True, titles=titles), mode, link_probability=link_probability)
    )


def _step(table: str, mode: str = elt.COMPATIBLE) -> Query:
    # The established migration draws the links of the loans from all pairs; only links that follow the lists read the titles.
    links = table == "prestamo_libro"
    drawn = elt.LINK_PROBABILITY if links and mode == elt.COMPATIBLE else None
    return _migration(lambda m: m.table(table), mode, titles=links and drawn is None, link_probability=drawn)


# -- quality --------------------------------------------------------------------------------------


def _rule_kind(kind: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        # The lists of titles are put together from the lines; only a rule on them needs that.
        titles = quality.asks_for("Prestamos_Crudos", "libros_prestados", "legacy", kind=kind)
        report = quality.quality_report(legacy_tables(spark, folder, titles=titles), "legacy", kind=kind)
        return report.select("tabla", "columna", "tipo", "filas", "errores")

    return run


def _legacy_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(legacy_tables(spark, folder), "legacy")


def _unknown_kind(spark: SparkSession, folder: str) -> DataFrame:
    """A rule set with a kind that nobody knows: the rule is reported and counts nothing."""
    rules = {"Inventario_Sedes": [{"columna": "sede_nombre", "tipo_validacion": "fonetica", "contexto": "legacy", "accion": "log_error"}]}
    return quality.quality_report(legacy_tables(spark, folder), "legacy", rules).select("tabla", "columna", "tipo", "conocida", "filas", "errores")


def _normalised_report(spark: SparkSession, folder: str) -> DataFrame:
    migration = elt.Migration(legacy_tables(spark, folder))
    migration.prepare("libros", "usuarios", "resenas")
    loaded = {table: migration.staged(table) for table in ("libros", "usuarios", "resenas")}
    return quality.quality_report(loaded, "normalizada")


def _observed_report(spark: SparkSession, folder: str) -> DataFrame:
    """Rule counts observed while the normalised tables are written, beside those counted from them afterwards."""
    migration = elt.Migration(legacy_tables(spark, folder))
    names = ("libros", "usuarios", "resenas")
    migration.prepare(*names)
    built = {name: migration.table(name) for name in names}
    observed = quality.ObservedReport(built, "normalizada")
    written = {name: stage(observed.watch(name, df), name) for name, df in built.items()}
    key = ["tabla", "columna", "tipo"]
    again = quality.quality_report(written, "normalizada").select(*key, F.col("filas").alias("filas_contadas"), F.col("errores").alias("errores_contados"))
    return observed.report(spark).select(*key, "filas", "errores").join(again, key)


def _compare(spark: SparkSession, folder: str) -> DataFrame:
    return quality.compare_contexts(_legacy_report(spark, folder), _normalised_report(spark, folder))


# -- documents ------------------------------------------------------------------------------------


def _names(array: str, *fields: str) -> Column:
    """The elements of a list of documents as one text."""
    return F.array_join(F.transform(array, lambda d: F.concat_ws("|", *[d[f] for f in fields])), ",")


def _books(tables: Mapping[str, DataFrame]) -> DataFrame:
    return documents.build_collection(tables, "Libros").select(
        "_id",
        "parte",
        "titulo",
        "fecha",
        F.col("editorial.nombre").alias("editorial"),
        _names("autores", "nombre").alias("autores"),
        _names("categorias", "nombre", "descripcion").alias("categorias"),
    )


def _loans(tables: Mapping[str, DataFrame]) -> DataFrame:
    return documents.build_collection(tables, "Prestamos").select(
        "_id",
        "parte",
        "fecha",
        "estado",
        F.col("usuario.nombre").alias("nombre"),
        F.col("usuario.correo").alias("correo"),
        F.size("libros").alias("n_libros"),
        _names("libros", "titulo").alias("libros"),
    )


def _inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    return documents.build_collection(tables, "Inventario").select(
        "stock",
        F.col("sede.nombre").alias("sede"),
        F.col("sede.ubicacion").alias("ubicacion"),
        F.col("libro._id").alias("id_libro"),
        F.col("libro.titulo").alias("titulo"),
    )


# -- movements ------------------------------------------------------------------------------------


def _line_requests(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Each loan line as a request for its book, in loan order."""
    return tables["prestamo_libro"].withColumn("secuencia", F.col("id_prestamo"))


def _gate(tables: Mapping[str, DataFrame]) -> DataFrame:
    gated = stock.stock_gate(_line_requests(tables), tables["inventario"])
    return gated.select("secuencia", "id_libro", "turno", "disponible", "resultado")


def _threshold(tables: Mapping[str, DataFrame]) -> DataFrame:
    gated = stock.threshold_gate(_line_requests(tables), tables["inventario"])
    return gated.select("secuencia", "id_libro", "disponible", "resultado")


def _loan_requests(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A request for every distinct part of every order, numbered in this order; some e-mails belong to nobody."""
    mail = F.when(F.col("id_usuario") % 59 == 0, F.concat(F.lit("sin."), "correo")).otherwise(F.col("correo"))
    loans = tables["prestamos"].join(tables["usuarios"], "id_usuario").select("id_prestamo", mail.alias("correo"), "estado")
    wanted = loans.join(tables["prestamo_libro"], "id_prestamo")
    return number_rows(wanted, ["id_prestamo", "id_libro"], "secuencia").select("secuencia", "correo", "id_libro", "estado")


def _register_loans(spark: SparkSession, folder: str) -> DataFrame:
    tables = library_tables(spark, folder)
    requests = _loan_requests(tables)
    return movements.register_loans(
        requests, tables["usuarios"], tables["inventario"], tables["prestamos"], _as_of()
    )


def _returns(spark: SparkSession, folder: str) -> DataFrame:
    """Each returned line returns its loan; line 7 of an order names a loan that does not exist."""
    lines = star_table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R")
    unknown = F.when(F.col("l_linenumber") == 7, F.lit(1_000_000_000_000)).otherwise(F.lit(0))
    return lines.select((F.col("l_orderkey") + unknown).alias("id_prestamo"))


def _return_loans(spark: SparkSession, folder: str) -> DataFrame:
    return movements.return_loans(library_tables(spark, folder)["prestamos"], _returns(spark, folder))


def _unknown_returns(spark: SparkSession, folder: str) -> DataFrame:
    return movements.unknown_returns(library_tables(spark, folder)["prestamos"], _returns(spark, folder))


def _register_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """One review request per event; some name a book or user past the last one."""
    tables = library_tables(spark, folder)
    event = F.col("event_id")
    books = tables["libros"].select(F.count(F.lit(1))).scalar()
    requests = star_table(spark, folder, "events").select(
        event.alias("secuencia"),
        F.when(event % 61 == 0, event + 1_000_000_000_000).otherwise(F.col("user_id")).alias("id_usuario"),
        (event % (books + 5)).alias("id_libro"),
        F.col("event_type").alias("comentario"),
        F.when(event % 67 != 0, F.col("value").cast("int") % 7).alias("calificacion"),
    )
    return movements.register_reviews(requests, tables["usuarios"], tables["libros"], tables["resenas"])


def _fine_by_loan(spark: SparkSession, folder: str) -> DataFrame:
    """The fine of every loan, and of the unknown loans that returned lines name."""
    loans = library_tables(spark, folder)["prestamos"]
    asked = loans.select("id_prestamo").unionByName(_returns(spark, folder)).distinct()
    reports.register_fine_by_loan(spark, loans, _as_of())
    fined = asked.select("id_prestamo", F.call_function("calcular_multa", "id_prestamo").alias("multa"))
    return fined.withColumn("existe", F.col("multa").isNotNull())


def _books_by_category(spark: SparkSession, folder: str) -> DataFrame:
    reports.register_books_by_category(spark, library_tables(spark, folder))
    return spark.sql("SELECT titulo, categoria FROM obtener_libros_por_categoria(:categoria)", {"categoria": CATEGORY})


def _random_links(tables: Mapping[str, DataFrame]) -> DataFrame:
    return bernoulli_links(tables["prestamos"], tables["libros"].select(F.count(F.lit(1))).scalar(), EXPECTED_LINKS)


# -- registry -------------------------------------------------------------------------------------

REGISTRY: dict[str, Query] = {
    **{f"legacy_{t}": _legacy(t) for t in ("biblioteca_data", "prestamos_crudos", "inventario_sedes", "resenas_usuarios")},
    **{f"dq_{kind}": _rule_kind(kind) for kind in quality.KINDS},
    "dq_report_legacy": _legacy_report,
    "dq_report_normalizada": _normalised_report,
    "dq_observado": _observed_report,
    "dq_compare_contexts": _compare,
    "dq_log_lines": lambda spark, folder: quality.log_lines(_legacy_report(spark, folder)),
    "dq_rejects": lambda spark, folder: quality.rejected_values(legacy_tables(spark, folder), "legacy"),
    **{f"elt_{t}": _step(t) for t in elt.STEPS},
    **{f"elt_estricto_{t}": _step(t, elt.STRICT) for t in elt.STEPS},
    "elt_listas_prestamo_libro": _migration(lambda m: m.table("prestamo_libro")),
    "elt_enlaces_azar": _library(_random_links),
    "elt_fanout": _migration(lambda m: m.fanout(), titles=False),
    "elt_cuarentena": _migration(lambda m: m.quarantine(), titles=False),
    "dq_tipo_desconocido": _unknown_kind,
    "chk_carga": _library(lambda t: load.violations(t)),
    "chk_pk": _migration(lambda m: constraints.primary_key_report(m.tables())),
    "chk_fk": _migration(lambda m: constraints.foreign_key_report(m.tables())),
    "chk_varchar_len": _migration(lambda m: constraints.length_report(m.tables())),
    "chk_pk_biblioteca": _library(constraints.primary_key_report),
    "chk_fk_biblioteca": _library(constraints.foreign_key_report),
    "doc_libros": _library(_books),
    "doc_usuarios": _library(lambda t: documents.build_collection(t, "Usuarios")),
    "doc_prestamos": _library(_loans),
    "doc_inventario": _library(_inventory),
    "doc_counts": _library(documents.count_parents),
    "rpt_libros_mas_prestados": _library(lambda t: reports.most_borrowed(t)),
    "rpt_vista_prestados": _library(lambda t: reports.borrow_counts(t)),
    "rpt_vista_consulta": _library(lambda t: reports.view_most_borrowed(t)),
    "rpt_prestados_texto": _library(lambda t: reports.borrowed_text(reports.most_borrowed(t))),
    "rpt_top_multas": _library(lambda t: reports.top_fines(t, _as_of())),
    "rpt_multas_texto": _library(lambda t: reports.fines_text(reports.top_fines(t, _as_of()))),
    "fn_calcular_multa": _fine_by_loan,
    "fn_libros_por_categoria": _books_by_category,
    "op_control_inventario": _library(_gate),
    "op_control_umbral": _library(_threshold),
    "op_stock_after": _library(lambda t: stock.stock_after(_line_requests(t), t["inventario"])),
    "op_registrar_prestamo": _register_loans,
    "op_devolver_libro": _return_loans,
    "op_devolver_rechazos": _unknown_returns,
    "op_registrar_resena": _register_reviews,
    "log_prestamos": _library(
        lambda t: movements.audit_log(t["prestamos"], t["usuarios"], F.lit(RUN_TIME).cast("timestamp_ntz"))
    ),
}


def registered() -> dict[str, Query]:
    def tuned(query: Query) -> Query:
        return lambda spark, folder: query(tune(spark, star_bytes(spark, folder)), folder)

    return {name: tuned(query) for name, query in REGISTRY.items()}
