"""Days late and fines."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Days a loan may last, fine per day after that.
GRACE_DAYS = 7
FINE_PER_DAY = 1000


def days_late(loan_date: Column, as_of: Column) -> Column:
    """Days past the grace period; negative while the loan is in time."""
    return F.datediff(as_of, loan_date) - F.lit(GRACE_DAYS)


def fine(loan_date: Column, as_of: Column) -> Column:
    """Fine of a loan at a date, never negative; null for an unknown date."""
    late = days_late(loan_date, as_of)
    return F.when(late.isNotNull(), F.greatest(late, F.lit(0)) * F.lit(FINE_PER_DAY)).cast("int")


def register_fine(spark: SparkSession, name: str = "calcular_multa") -> None:
    """SQL function over the loan date and the day to compute for; it is inlined into the plan."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(fecha_salida DATE, al DATE) RETURNS INT "
        f"RETURN IF(fecha_salida IS NULL OR al IS NULL, NULL, "
        f"GREATEST(DATEDIFF(al, fecha_salida) - {GRACE_DAYS}, 0) * {FINE_PER_DAY})"
    )
