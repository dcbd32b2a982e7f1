"""The whole process: check raw tables, migrate, check again, export documents, report, audit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.operators.movements import audit_log
from anaquel.plans import documents, elt, load, quality, reports
from anaquel.plans.mapping import DEFAULT_MAPPING
from anaquel.plans.rules import DEFAULT_RULES, RuleSet
from anaquel.schema import AUDIT_LOG
from anaquel.sources.staging import stage, staging_area
from anaquel.sources.tables import write_table

LOG, TABLES, DOCUMENTS, REPORTS, AUDIT = "errores", "normalizada", "documentos", "informes", "log_prestamos"


def run(
    spark: SparkSession,
    legacy: Mapping[str, DataFrame],
    folder: str,
    as_of: dt.date | None = None,
    run_time: dt.datetime | None = None,
    mode: str = elt.STRICT,
    invalid: str = "abort",
    rules: RuleSet = DEFAULT_RULES,
    mapping: Mapping[str, dict] = DEFAULT_MAPPING,
    copy_sources: bool = False,
    links_per_loan: int | None = None,
    expected_links: float | None = None,
) -> DataFrame:
    """Run every stage into ``folder`` and return the number of documents per collection.

    A stage that fails ends the run; no stage works on the leftovers of an earlier run. The raw
    tables are read by several steps: ``copy_sources`` reads them once into the shared folder, which
    is what a remote database wants. ``links_per_loan`` or ``expected_links`` simulates the loan-book links, for
    raw tables without lists of titles.
    """
    # What the steps stage is needed no longer when the results are written.
    with staging_area(spark):
        if copy_sources:
            legacy = {name: stage(legacy[name], name) for name in legacy}
        folder = folder.rstrip("/")
        today = F.current_date() if as_of is None else F.lit(as_of)
        now = F.current_timestamp() if run_time is None else F.lit(run_time)

        quality.write_log(quality.quality_report(legacy, "legacy", rules), f"{folder}/{LOG}", starts=True)

        migration = elt.Migration(legacy, mode, invalid, links_per_loan, expected_links)
        # The rules are counted, and the documents below, while they are written.
        migrated = migration.tables()
        observed = quality.ObservedReport(migrated, "normalizada", rules)
        load.publish(migrated, f"{folder}/{TABLES}", observed.watch)
        tables = load.current_tables(spark, f"{folder}/{TABLES}")

        quality.write_log(observed.report(spark), f"{folder}/{LOG}")

        collections = documents.build_documents(tables, mapping)
        counts = documents.write_documents(collections, f"{folder}/{DOCUMENTS}")

        write_table(reports.most_borrowed(tables), f"{folder}/{REPORTS}/libros_mas_prestados")
        write_table(reports.top_fines(tables, today), f"{folder}/{REPORTS}/top_multas")

        append_audit_log(spark, tables, f"{folder}/{AUDIT}", now)
        return spark.createDataFrame(list(counts.items()), "coleccion STRING, documentos BIGINT")


def append_audit_log(spark: SparkSession, tables: Mapping[str, DataFrame], path: str, run_time) -> None:
    """Add the active loans to the audit log at ``path``, with ids that follow the ones in it."""
    log = read_if_present(spark, path, AUDIT_LOG)
    write_table(audit_log(tables["prestamos"], tables["usuarios"], run_time, log), path, mode="append")


def read_if_present(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
