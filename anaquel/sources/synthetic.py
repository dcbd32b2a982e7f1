"""Synthetic raw tables of any size, for trials and tests: the same rows for the same seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = ["river", "stone", "garden", "winter", "letter", "market", "silver", "harbor", "bridge", "candle"]
NAMES = ["Ana", "Bruno", "Carla", "Diego", "Elena", "Felipe", "Gloria", "Hugo"]


def synthetic_legacy(spark: SparkSession, rows: int = 250, seed: int = 0) -> dict[str, DataFrame]:
    """The four raw tables with ``rows`` rows each: combined categories, book lists, dates as text."""

    def draw(n: int, tag: str) -> Column:
        """0..n-1 from the row number."""
        return F.pmod(F.xxhash64("id", F.lit(seed), F.lit(tag)), F.lit(n)).cast("int")

    def pick(values: list[str], tag: str) -> Column:
        return F.lit(values)[draw(len(values), tag)]

    number = F.col("id").cast("string")
    title = F.concat_ws(" ", pick(WORDS, "t1"), pick(WORDS, "t2"), pick(WORDS, "t3"), number)
    day = F.format_string("%04d-%02d-%02d", draw(25, "y") + 2000, draw(12, "m") + 1, draw(28, "d") + 1)
    base = spark.range(rows)
    return {
        "biblioteca_data": base.select(
            (F.col("id") + 1).alias("id_registro"),
            title.alias("titulo_libro"),
            F.concat_ws(" ", pick(NAMES, "a"), number).alias("autor_nombre"),
            F.concat_ws(" / ", pick(WORDS, "c"), F.concat(pick(WORDS, "d1"), F.lit(" "), pick(WORDS, "d2"))).alias(
                "categoria_y_descripcion"
            ),
            F.concat(pick(WORDS, "e"), F.lit(" & Co")).alias("editorial_info"),
            day.alias("fecha_publicacion"),
        ),
        "prestamos_crudos": base.select(
            F.col("id").alias("id_prestamo"),
            F.concat_ws(" ", pick(NAMES, "u"), number).alias("nombre_usuario"),
            F.concat(F.lower(pick(NAMES, "u")), number, F.lit("@example.com")).alias("correo_usuario"),
            F.concat_ws(", ", pick(WORDS, "l1"), pick(WORDS, "l2"), pick(WORDS, "l3")).alias("libros_prestados"),
            F.date_add(F.lit("2026-01-01").cast("date"), draw(300, "s")).alias("fecha_salida"),
            F.lit("Activo").alias("estado_prestamo"),
        ),
        "inventario_sedes": base.select(
            F.concat(F.lit("Sede "), number).alias("sede_nombre"),
            F.concat(F.lit("Calle "), number).alias("ubicacion_sede"),
            title.alias("libro_asociado"),
            (draw(50, "q") + 1).alias("cantidad_total"),
        ),
        "resenas_usuarios": base.select(
            (draw(100, "r") + 1).cast("bigint").alias("usuario_id"),
            title.alias("libro_titulo"),
            F.concat_ws(" ", pick(WORDS, "k1"), pick(WORDS, "k2")).alias("comentario"),
            (draw(5, "n") + 1).cast("string").alias("calificacion"),
        ),
    }
