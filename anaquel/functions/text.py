"""Display formatting of report lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad(value: Column, width: int) -> Column:
    """Left-aligned text in a field of ``width``; longer text is kept whole."""
    text = value.cast("string")
    return F.when(F.length(text) < width, F.rpad(text, width, " ")).otherwise(text)


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def log_line(table: Column, column: Column, kind: Column, errors: Column) -> Column:
    # Fixed format of a line of the quality log.
    return F.format_string("[VALIDACION] Tabla: %s | Columna: %s | Tipo: %s | Errores: %d", table, column, kind, errors)
