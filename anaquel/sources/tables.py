"""Reading and writing tables: files, JDBC databases and document collections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from anaquel.sources.collection import FORMAT, replace_collection


def read_files(spark: SparkSession, folder: str, name: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Table ``name`` of a folder with one file or sub-folder per table."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(f"{folder.rstrip('/')}/{name}")


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC scan, split over ``partitions`` ranges of a numeric or date column.

    A scan in one task has to be asked for, with ``partitions=1``.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partitions is None:
        raise ValueError("name a column and a number of partitions to split the scan by, or partitions=1")
    if partitions > 1:
        if partition_column is None or lower is None or upper is None:
            raise ValueError("a split JDBC scan needs partition_column, lower and upper")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, options: Mapping[str, str], columns: list[str] | None = None) -> DataFrame:
    """Remote table; Catalyst pushes the column list and the filters into the remote query."""
    df = spark.read.format("jdbc").options(**options).load()
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet", **options) -> None:
    """Load a table: ``overwrite`` replaces it whole, ``append`` adds rows."""
    df.write.format(fmt).options(**options).mode(mode).save(path)


def write_collection(df: DataFrame, folder: str, name: str, fmt: str = "json", **options) -> None:
    """Replace the document collection ``name``. Fields that are null stay present, as null.

    Files go to ``folder``/``name``. With ``fmt="mongodb"`` (a connector the session has to bring)
    ``folder`` is the database. With ``fmt="coleccion"`` a failed export leaves the old documents
    (see ``sources/collection.py``).
    """
    if fmt == FORMAT:
        replace_collection(df, f"{folder.rstrip('/')}/{name}")
        return
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "mongodb":
        writer.options(database=folder, collection=name, **options).save()
        return
    if fmt == "json":
        options = {"ignoreNullFields": "false", **options}
    writer.options(**options).save(f"{folder.rstrip('/')}/{name}")
