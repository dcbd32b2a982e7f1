"""Loading the normalised tables as a whole: checked first, published together or not at all."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.operators import constraints
from anaquel.schema import NORMALISED, columns
from anaquel.session import concurrently
from anaquel.sources.tables import write_table

CURRENT = "vigente"


class LoadRefused(ValueError):
    """The tables break a key, a reference or a length limit; nothing was published."""


def violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every broken constraint with the number of rows or keys that break it."""
    keys = constraints.primary_key_report(tables)
    references = constraints.foreign_key_report(tables)
    lengths = constraints.length_report(tables)
    found = keys.select(
        F.lit("clave primaria").alias("restriccion"),
        "tabla",
        F.col("clave").alias("columnas"),
        (F.col("nulos") + F.col("duplicados")).alias("infracciones"),
    )
    found = found.unionByName(
        references.select(
            F.lit("clave foranea").alias("restriccion"),
            "tabla",
            F.col("columna").alias("columnas"),
            F.col("huerfanas").alias("infracciones"),
        )
    )
    found = found.unionByName(
        lengths.select(
            F.lit("longitud").alias("restriccion"),
            "tabla",
            F.col("columna").alias("columnas"),
            F.col("excedidas").alias("infracciones"),
        )
    )
    return found.filter(F.col("infracciones") > 0)


def publish(
    tables: Mapping[str, DataFrame], folder: str, watch: Callable[[str, DataFrame], DataFrame] = lambda name, df: df
) -> str:
    """Check the tables, write them to a new folder under ``folder``, then make that the current load.

    ``tables`` are written tables (see ``Migration.tables``), as they are read by every check. ``watch`` may add
    observed counts to each frame that is written.
    """
    broken = violations(tables).first()
    if broken is not None:
        raise LoadRefused(f"{broken.restriccion} {broken.tabla}({broken.columnas}): {broken.infracciones}")
    spark = next(iter(tables.values())).sparkSession
    load = f"{folder.rstrip('/')}/carga-{uuid.uuid4().hex}"
    concurrently(lambda name: write_table(watch(name, tables[name].select(*columns(name))), f"{load}/{name}"), tables)
    # A pointer per load, added when all its tables are there; readers follow the newest, so they see the old load
    # or the new one, never none and never a mixture.
    number = _newest(spark, folder)[0] + 1
    while not _claim(spark, folder, number, load):
        number += 1
    return load


def _pointer_files(spark: SparkSession, folder: str):
    """The file system of ``folder`` and the path of its pointers."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{CURRENT}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _claim(spark: SparkSession, folder: str, number: int, load: str) -> bool:
    """Make ``load`` the load of this number, unless another publisher has the number already.

    The file is created only if it is absent, which the file system decides for one of several writers, so every
    number has one load. A publisher that dies before the line is whole leaves a number that readers skip.
    """
    files, path = _pointer_files(spark, folder)
    pointer = spark._jvm.org.apache.hadoop.fs.Path(path, f"{number:012d}")
    try:
        out = files.create(pointer, False)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException" or files.exists(pointer):
            return False
        raise
    try:
        out.write(bytearray(f"{load}\n".encode()))
    finally:
        out.close()
    return True


def _newest(spark: SparkSession, folder: str) -> tuple[int, str | None]:
    """The largest number in use, and the load of the largest whole pointer."""
    files, path = _pointer_files(spark, folder)
    if not files.exists(path):
        return 0, None
    numbers = sorted((int(f.getPath().getName()) for f in files.listStatus(path) if f.getPath().getName().isdigit()), reverse=True)
    for number in numbers:
        stream = files.open(spark._jvm.org.apache.hadoop.fs.Path(path, f"{number:012d}"))
        try:
            line = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        if line.endswith("\n"):
            return numbers[0], line.strip()
    return max(numbers, default=0), None


class NoLoad(ValueError):
    """Nothing has been published to the folder."""


def current_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the current load."""
    load = _newest(spark, folder)[1]
    if load is None:
        raise NoLoad(folder)
    return {name: spark.read.schema(schema).parquet(f"{load}/{name}") for name, schema in NORMALISED.items()}
