"""Nested documents from normalised tables, as a declarative mapping says."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anaquel.operators.children import PAGE, collect_children
from anaquel.plans.mapping import DEFAULT_MAPPING
from anaquel.schema import PRIMARY_KEYS, canonical
from anaquel.sources.collection import FORMAT, read_collection
from anaquel.sources.tables import write_collection


def build_collection(
    tables: Mapping[str, DataFrame], table: str, mapping: Mapping[str, dict] = DEFAULT_MAPPING, page: int = PAGE
) -> DataFrame:
    """The documents of one table.

    A row whose ``local_key`` refers to nothing has no document. Lists are sorted, and empty where a
    row has no links. A collection with lists has the column ``parte``: 0, and 1, 2, ... for the further
    pages of lists with more than ``page`` children.
    """
    spec = mapping[table]
    embedded = spec.get("embebidos", {})
    parents = tables[canonical(table)]
    single = {name: e for name, e in embedded.items() if "local_key" in e}
    lists = {name: e for name, e in embedded.items() if "via" in e}

    documents = parents
    for name, e in single.items():
        source = tables[canonical(e["source"])]
        one = source.select(F.col(e["local_key"]), _document(source, e["fields"]).alias(f"_doc_{name}"))
        documents = documents.join(one, e["local_key"])

    columns = [_field(parents, column).alias(target) for column, target in spec["fields"].items()]
    columns += [F.col(f"_doc_{name}").alias(name) for name in single]
    if not lists:
        return documents.select(*columns)

    key = PRIMARY_KEYS[canonical(table)][0]
    children = [_children(tables, key, lists[name], f"_list_{name}", page) for name in lists]
    # The pages of all lists of a parent meet in one row per page; a parent without any has page 0.
    pages = children[0]
    for child in children[1:]:
        pages = pages.join(child, [key, "parte"], "full")
    documents = documents.join(pages, key, "left").withColumn("parte", F.coalesce("parte", F.lit(0)))
    columns += [F.coalesce(f"_list_{name}", F.array()).alias(name) for name in lists]
    return documents.select(*columns, "parte")


def _field(df: DataFrame, column: str) -> Column:
    """A column as a document field; a date becomes its midnight."""
    is_date = isinstance(df.schema[column].dataType, T.DateType)
    return F.col(column).cast("timestamp_ntz") if is_date else F.col(column)


def _document(df: DataFrame, fields: Mapping[str, str]) -> Column:
    return F.struct(*[_field(df, column).alias(target) for column, target in fields.items()])


def _children(
    tables: Mapping[str, DataFrame], key: str, embedded: dict, list_column: str, page: int
) -> DataFrame:
    source_name = canonical(embedded["source"])
    source = tables[source_name]
    child = PRIMARY_KEYS[source_name][0]
    links = tables[canonical(embedded["via"])].select(key, child)
    documents = source.select(child, _document(source, embedded["fields"]).alias("_child"))
    return collect_children(links, key, child, F.col("_child"), list_column, page, documents)


def build_documents(
    tables: Mapping[str, DataFrame], mapping: Mapping[str, dict] = DEFAULT_MAPPING, page: int = PAGE
) -> dict[str, DataFrame]:
    """All collections by name."""
    return {spec["collection"]: build_collection(tables, table, mapping, page) for table, spec in mapping.items()}


def count_documents(collections: Mapping[str, DataFrame]) -> DataFrame:
    """Number of documents per collection; later parts of a document are not counted again."""
    counts = [
        (df.filter(F.col("parte") == 0) if "parte" in df.columns else df)
        .agg(F.count(F.lit(1)).alias("documentos"))
        .select(F.lit(name).alias("coleccion"), "documentos")
        for name, df in collections.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def count_parents(tables: Mapping[str, DataFrame], mapping: Mapping[str, dict] = DEFAULT_MAPPING) -> DataFrame:
    """Number of documents per collection, before any is built: a row has one unless a ``local_key`` refers to nothing.

    Lists neither add nor remove documents, so their tables are not read.
    """
    counts = []
    for table, spec in mapping.items():
        parents = tables[canonical(table)]
        for embedded in spec.get("embebidos", {}).values():
            if "local_key" in embedded:
                parents = parents.join(tables[canonical(embedded["source"])], embedded["local_key"], "left_semi")
        counts.append(parents.agg(F.count(F.lit(1)).alias("documentos")).select(F.lit(spec["collection"]).alias("coleccion"), "documentos"))
    return reduce(DataFrame.unionByName, counts)


def count_written(spark: SparkSession, collections: Mapping[str, DataFrame], folder: str, fmt: str = "json") -> DataFrame:
    """Number of documents per collection, counted from what ``write_documents`` has written."""
    root = folder.rstrip("/")
    if fmt == FORMAT:
        return count_documents({n: read_collection(spark, f"{root}/{n}", df.schema) for n, df in collections.items()})
    return count_documents({n: spark.read.schema(df.schema).format(fmt).load(f"{root}/{n}") for n, df in collections.items()})


def write_documents(collections: Mapping[str, DataFrame], folder: str, fmt: str = "json", **options) -> dict[str, int]:
    """Replace the collections; the number of documents of each, counted while they are written.

    The pages of a document's lists are documents with the same ``_id`` and are not counted again.
    """
    seen = {}
    for name, df in collections.items():
        first = F.col("parte") == 0 if "parte" in df.columns else F.lit(True)
        seen[name] = Observation()
        write_collection(df.observe(seen[name], F.count_if(first).alias("documentos")), folder, name, fmt, **options)
    return {name: observed.get["documentos"] for name, observed in seen.items()}
