"""Declarative data-quality rules over tables.

A rule names a column and a kind of check. All rules of a table become conditional counts of one
aggregate, so a table is read once and nothing but one row per task is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from anaquel.functions import predicates
from anaquel.functions.text import log_line
from anaquel.plans.rules import DEFAULT_RULES, RuleSet
from anaquel.schema import canonical
from anaquel.sources.tables import write_table

REPORT_SCHEMA = (
    "orden INT, contexto STRING, tabla STRING, columna STRING, tipo STRING, accion STRING, mensaje STRING, "
    "conocida BOOLEAN, filas BIGINT, errores BIGINT"
)

KINDS = {
    "regex": lambda c, r: predicates.pattern_error(c, r["patron"]),
    "rango_numerico": lambda c, r: predicates.range_error(c, r["min"], r["max"]),
    "multivalor": lambda c, r: predicates.separator_error(c, r["separador"]),
    "campo_combinado": lambda c, r: predicates.separator_error(c, r["separador"]),
    "formato_fecha": lambda c, r: predicates.date_error(c),
}


class Check(NamedTuple):
    order: int
    context: str
    table: str
    rule: dict

    @property
    def known(self) -> bool:
        return self.rule["tipo_validacion"] in KINDS

    def error(self) -> Column:
        """True for a value the rule counts. A rule of an unknown kind counts nothing."""
        kind = KINDS.get(self.rule["tipo_validacion"])
        return kind(F.col(self.rule["columna"]), self.rule) if kind else F.lit(False)


def select_checks(
    tables: Mapping[str, DataFrame], context: str, rules: RuleSet = DEFAULT_RULES, kind: str | None = None
) -> dict[str, list[Check]]:
    """The rules of a context by table, in configured order. Unknown tables and columns are refused."""
    chosen: dict[str, list[Check]] = {}
    order = 0
    for table, table_rules in rules.items():
        for rule in table_rules:
            if rule.get("contexto") != context or kind not in (None, rule["tipo_validacion"]):
                continue
            name = canonical(table)
            if name not in tables:
                raise ValueError(f"rule for unknown table {table}")
            if rule["columna"] not in tables[name].columns:
                raise ValueError(f"rule for unknown column {table}.{rule['columna']}")
            order += 1
            chosen.setdefault(name, []).append(Check(order, context, table, rule))
    return chosen


def asks_for(table: str, column: str, context: str, rules: RuleSet = DEFAULT_RULES, kind: str | None = None) -> bool:
    """Whether a rule of the context (and of one ``kind``, if given) reads a column, so that a source can do without it."""
    named = [r for t, table_rules in rules.items() if canonical(t) == canonical(table) for r in table_rules]
    return any(r.get("contexto") == context and r["columna"] == column and kind in (None, r["tipo_validacion"]) for r in named)


def quality_report(
    tables: Mapping[str, DataFrame], context: str, rules: RuleSet = DEFAULT_RULES, kind: str | None = None
) -> DataFrame:
    """Rows and errors per rule, for the rules of ``context`` (and of one ``kind``, if given)."""
    checks = select_checks(tables, context, rules, kind)
    reports = [_table_report(tables[name], table_checks) for name, table_checks in checks.items()]
    if not reports:
        return SparkSession.active().createDataFrame([], REPORT_SCHEMA)
    return reduce(DataFrame.unionByName, reports)


def _table_report(df: DataFrame, checks: list[Check]) -> DataFrame:
    counts = [F.count_if(check.error()).alias(f"e{check.order}") for check in checks]
    lines = [
        F.struct(
            F.lit(check.order).alias("orden"),
            F.lit(check.context).alias("contexto"),
            F.lit(check.table).alias("tabla"),
            F.lit(check.rule["columna"]).alias("columna"),
            F.lit(check.rule["tipo_validacion"]).alias("tipo"),
            F.lit(check.rule.get("accion")).cast("string").alias("accion"),
            F.lit(check.rule.get("mensaje")).cast("string").alias("mensaje"),
            F.lit(check.known).alias("conocida"),
            F.col("filas"),
            F.col(f"e{check.order}").alias("errores"),
        )
        for check in checks
    ]
    return df.agg(F.count(F.lit(1)).alias("filas"), *counts).select(F.inline(F.array(*lines)))


class ObservedReport:
    """The quality report of tables that are about to be written, counted by the writes themselves.

    ``watch`` adds the counts of a table's rules to the frame that is written; ``report`` is there after every
    watched frame was written. The counts are taken at the top of the plan, in the tasks that write, so a task
    that is run again counts once, and no table is read for its report.
    """

    def __init__(self, tables: Mapping[str, DataFrame], context: str, rules: RuleSet = DEFAULT_RULES):
        self._checks = select_checks(tables, context, rules)
        self._seen = {name: Observation() for name in self._checks}

    def watch(self, name: str, df: DataFrame) -> DataFrame:
        if name not in self._checks:
            return df
        counts = [F.count_if(check.error()).alias(f"e{check.order}") for check in self._checks[name]]
        return df.observe(self._seen[name], F.count(F.lit(1)).alias("filas"), *counts)

    def report(self, spark: SparkSession) -> DataFrame:
        rows = []
        for name, checks in self._checks.items():
            counts = self._seen[name].get
            for check in checks:
                rule = check.rule
                given = (rule["columna"], rule["tipo_validacion"], rule.get("accion"), rule.get("mensaje"))
                rows.append((check.order, check.context, check.table, *given, check.known, counts["filas"], counts[f"e{check.order}"]))
        return spark.createDataFrame(rows, REPORT_SCHEMA)  # one row a rule


def rejected_values(
    tables: Mapping[str, DataFrame], context: str, rules: RuleSet = DEFAULT_RULES
) -> DataFrame:
    """Every failing value, one row per rule it fails, from one pass per table."""
    rejects = []
    for name, checks in select_checks(tables, context, rules).items():
        failed = F.filter(F.array(*[_failure(check) for check in checks]), lambda f: f.isNotNull())
        rejects.append(tables[name].select(F.inline(failed)))
    return reduce(DataFrame.unionByName, rejects)


def _failure(check: Check) -> Column:
    return F.when(
        check.error(),
        F.struct(
            F.lit(check.table).alias("tabla"),
            F.lit(check.rule["columna"]).alias("columna"),
            F.lit(check.rule["tipo_validacion"]).alias("tipo"),
            F.col(check.rule["columna"]).cast("string").alias("valor"),
        ),
    )


def compare_contexts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Errors by kind of rule in both contexts, side by side; 0 where a context has no such rule."""
    both = before.unionByName(after)
    return both.groupBy("tipo").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("contexto") == context, F.col("errores"))), F.lit(0)).alias(f"errores_{context}")
            for context in ("legacy", "normalizada")
        ]
    )


def log_lines(report: DataFrame) -> DataFrame:
    """The report as text lines, with their order."""
    return report.select("orden", log_line(F.col("tabla"), F.col("columna"), F.col("tipo"), F.col("errores")).alias("linea"))


def write_log(report: DataFrame, path: str, starts: bool = False) -> None:
    """Write the log lines as text. The context that ``starts`` the log replaces it, others add to it."""
    # One line per rule, so one file.
    lines = log_lines(report).coalesce(1).sortWithinPartitions("orden").select(F.col("linea").alias("value"))
    write_table(lines, path, mode="overwrite" if starts else "append", fmt="text")
