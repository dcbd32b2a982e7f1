"""Quality rules on a stream: every row is marked with the rules it fails, without any state."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from anaquel.plans.quality import select_checks
from anaquel.plans.rules import DEFAULT_RULES, RuleSet
from anaquel.schema import canonical


def flag_errors(df: DataFrame, table: str, context: str, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Add ``errores``, the failed rules as ``columna:tipo``, and ``rechazada``. For tables and streams."""
    name = canonical(table)
    own = {t: r for t, r in rules.items() if canonical(t) == name}
    checks = select_checks({name: df}, context, own).get(name, [])
    marks = [
        F.when(check.error(), F.lit(f"{check.rule['columna']}:{check.rule['tipo_validacion']}")) for check in checks
    ]
    failed = F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")
    return df.withColumn("errores", failed).withColumn("rechazada", F.size("errores") > 0)


def check_stream(
    rows: DataFrame,
    table: str,
    context: str,
    target: str,
    checkpoint: str,
    rules: RuleSet = DEFAULT_RULES,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Write the marked rows to ``target``, kept and rejected ones in folders of their own.

    ``trigger`` is that of the query, by default what is there now and no more.
    """
    return (
        flag_errors(rows, table, context, rules)
        .writeStream.format("parquet")
        .partitionBy("rechazada")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
