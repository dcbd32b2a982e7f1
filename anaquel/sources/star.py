"""Adapters from a star schema (orders, line items, parts, customers, ...) to the library tables.

``legacy_tables`` gives the four denormalised tables with their defects; ``library_tables`` gives
the twelve normalised tables with the keys the star schema already has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.operators.children import PAGE, collect_children
from anaquel.sources.staging import stage


class LazyTables(Mapping[str, DataFrame]):
    """Tables by name, each built when it is first asked for."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders, self._built = builders, {}
        self._locks = {name: Lock() for name in builders}

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._built:
                self._built[name] = self._builders[name]()
            return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


# The columns that are read; a declared schema spares a pass over the file footers.
STAR = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "customer": "c_custkey BIGINT, c_name STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_returnflag STRING",
    "events": "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE",
}


# A row group is read by one task, however large it is. Tables of so many bytes, in which a task reads more than so many
# rows, are written once in row groups of the third size.
LARGE_TABLE, ROWS_OF_A_TASK, GROUP_BYTES = 16 << 20, 3 << 18, 2 << 20

# By session and files of a table: the table in small row groups, or None where its own are small enough.
_regrouped: dict[tuple, DataFrame | None] = {}
_regrouping: dict[tuple, Lock] = {}


def star_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table, in shares a task can hold: what is grouped or shuffled in the task that reads it follows its row groups."""
    path = f"{folder}/{name}.parquet"
    table = spark.read.schema(STAR[name]).parquet(path)
    files = _files(spark, path)
    if sum(size for _, size, _ in files) < LARGE_TABLE:
        return table
    key = (spark._jsparkSession.sessionUUID(), *files)
    with _regrouping.setdefault(key, Lock()):
        staged = _regrouped.get(key)
        if key not in _regrouped or (staged is not None and not _files(spark, staged.inputFiles()[0])):
            # Without columns this reads nothing but the footers.
            shares = table.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("rows"))
            most = shares.agg(F.max("rows")).first()[0] or 0
            _regrouped[key] = stage(table, name, **{"parquet.block.size": GROUP_BYTES}) if most > ROWS_OF_A_TASK else None
        staged = _regrouped[key]
    return table if staged is None else staged


def _files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Path, bytes and time of the files under ``path``; none where there is no such path."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    if fs.exists(root):
        listed = fs.listFiles(root, True)
        while listed.hasNext():
            file = listed.next()
            found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return sorted(found)


def star_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of the star-schema files of a folder."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet") for name in STAR]
    systems = [path.getFileSystem(conf) for path in paths]
    return sum(fs.getContentSummary(path).getLength() for fs, path in zip(systems, paths) if fs.exists(path))


def _title() -> Column:
    return F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string"))


def _mail() -> Column:
    plain = F.replace("c_name", F.lit("#"), F.lit("."))
    return F.when(F.col("c_custkey") % 53 == 0, plain).otherwise(F.concat(F.lower(plain), F.lit("@example.com")))


def _status() -> Column:
    return F.when(F.col("o_orderstatus") == "O", "Activo").otherwise("Devuelto")


def _raw_date(key: Column) -> Column:
    """Publication date as text, with defects."""
    parts = [F.lit(2000) + key % 25, F.lit(1) + key % 12, F.lit(1) + key % 28]
    plain = F.concat_ws("-", *[p.cast("string") for p in parts])
    return F.when(key % 97 == 0, "N/A").when(key % 89 == 0, "2024-02-30").when(key % 83 != 0, plain)


def _stock(spark: SparkSession, folder: str) -> DataFrame:
    """Quantity per nation and part. Where the suppliers are broadcast, the lines are shuffled once, added up before."""
    lines = star_table(spark, folder, "lineitem").dropna(subset=["l_partkey"])
    supplier = star_table(spark, folder, "supplier")
    return (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "l_partkey")
        .agg(F.sum("l_quantity").cast("bigint").alias("q"))
    )


def _places(spark: SparkSession, folder: str) -> DataFrame:
    nation = star_table(spark, folder, "nation")
    region = star_table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", F.concat("r_name", F.lit(", "), "n_name").alias("address")
    )


def biblioteca_data(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return star_table(spark, folder, "part").select(
        key.cast("bigint").alias("id_registro"),
        _title().alias("titulo_libro"),
        F.concat(F.lit("Autor "), (key % 50).cast("string")).alias("autor_nombre"),
        F.when(key % 43 == 0, F.col("p_type"))
        .otherwise(F.concat("p_type", F.lit(" / "), "p_brand"))
        .alias("categoria_y_descripcion"),
        F.when(key % 41 == 0, F.concat(F.lit(" "), "p_brand")).otherwise(F.col("p_brand")).alias("editorial_info"),
        _raw_date(key).alias("fecha_publicacion"),
    )


def _title_pages(spark: SparkSession, folder: str, page: int) -> DataFrame:
    """The titles of each order's parts, in pages."""
    lines = star_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    titles = star_table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), _title().alias("title"))
    return collect_children(lines, "l_orderkey", "l_partkey", F.col("title"), "titles", page, titles, repeated=True)


def prestamos_crudos(
    spark: SparkSession, folder: str, page: int = PAGE, titles: bool = True, pages: DataFrame | None = None
) -> DataFrame:
    """Raw loans from the orders, one row each, with the first page of its titles in one text.

    Without ``titles`` that column is missing, and the lines are not read. ``pages`` are the titles in pages, if they are written already.
    """
    orders = star_table(spark, folder, "orders")
    customer = star_table(spark, folder, "customer")
    loans = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    listed = []
    if titles:
        first = (_title_pages(spark, folder, page) if pages is None else pages).filter(F.col("parte") == 0)
        loans = loans.join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        listed = [F.array_join("titles", ", ").alias("libros_prestados")]
    return loans.select(
        F.col("o_orderkey").cast("bigint").alias("id_prestamo"),
        F.col("c_name").alias("nombre_usuario"),
        _mail().alias("correo_usuario"),
        *listed,
        F.col("o_orderdate").cast("date").alias("fecha_salida"),
        _status().alias("estado_prestamo"),
    )


def prestamos_crudos_paginas(
    spark: SparkSession, folder: str, page: int = PAGE, pages: DataFrame | None = None
) -> DataFrame:
    """The further pages of the titles of raw loans: ``id_prestamo``, ``parte`` from 1, ``libros_prestados``."""
    later = (_title_pages(spark, folder, page) if pages is None else pages).filter(F.col("parte") > 0)
    return later.select(
        F.col("l_orderkey").cast("bigint").alias("id_prestamo"), "parte", F.array_join("titles", ", ").alias("libros_prestados")
    )


def inventario_sedes(spark: SparkSession, folder: str) -> DataFrame:
    part = star_table(spark, folder, "part")
    return (
        _stock(spark, folder)
        .join(_places(spark, folder), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("n_name").alias("sede_nombre"),
            F.col("address").alias("ubicacion_sede"),
            _title().alias("libro_asociado"),
            F.col("q").alias("cantidad_total"),
        )
    )


def _with_part_key(events: DataFrame, part: DataFrame) -> DataFrame:
    """Spread the events over the parts: key = event id modulo the number of parts."""
    return events.withColumn("key", F.col("event_id") % part.select(F.count(F.lit(1))).scalar())


def _rating() -> Column:
    return F.col("value").cast("int") % 7


def resenas_usuarios(spark: SparkSession, folder: str) -> DataFrame:
    part = star_table(spark, folder, "part")
    event = F.col("event_id")
    return (
        _with_part_key(star_table(spark, folder, "events"), part)
        .join(part, F.col("key") == F.col("p_partkey"))
        .select(
            F.col("user_id").cast("bigint").alias("usuario_id"),
            _title().alias("libro_titulo"),
            F.col("event_type").alias("comentario"),
            F.when(event % 101 == 0, F.lit(None))
            .when(event % 103 == 0, "cinco")
            .otherwise(_rating().cast("string"))
            .alias("calificacion"),
        )
    )


def legacy_tables(
    spark: SparkSession, folder: str, written: bool = False, page: int = PAGE, titles: bool = True
) -> Mapping[str, DataFrame]:
    """The raw tables. ``written`` loads the stock and the loans with their lists, which are grouped from the lines, when they are
    first used; that pays for the migration, where several steps read them. Without ``titles`` the loans come without their lists."""
    # Titles by page, for the loans and the table of further pages. Staged loans read them once, and further pages are few.
    listed = LazyTables({"pages": lambda: _title_pages(spark, folder, page)})

    def loans() -> DataFrame:
        table = prestamos_crudos(spark, folder, page, titles, listed["pages"] if titles else None)
        return stage(table, "prestamos_crudos") if written and titles else table

    def stock() -> DataFrame:
        table = inventario_sedes(spark, folder)
        return stage(table, "inventario_sedes") if written else table

    return LazyTables(
        {
            "biblioteca_data": lambda: biblioteca_data(spark, folder),
            "prestamos_crudos": loans,
            "prestamos_crudos_paginas": lambda: prestamos_crudos_paginas(spark, folder, page, listed["pages"]),
            "inventario_sedes": stock,
            "resenas_usuarios": lambda: resenas_usuarios(spark, folder),
        }
    )


def library_tables(spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    """The normalised tables: parts are books, suppliers authors, nations branches and categories."""

    def star(name: str) -> DataFrame:
        return star_table(spark, folder, name)

    key = F.col("p_partkey")
    brand = F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2)).cast("bigint")
    published = F.make_date(F.lit(2000) + (key % 25).cast("int"), (key % 12 + 1).cast("int"), (key % 28 + 1).cast("int"))
    book, loan = F.col("l_partkey").alias("id_libro"), F.col("l_orderkey").alias("id_prestamo")

    def line_pairs(*columns: str) -> DataFrame:
        """Distinct pairs of line keys. A bridge row is a key, so neither side is null."""
        return star("lineitem").select(*columns).dropna().distinct()

    def places(id_column: str, name: str, text: str) -> DataFrame:
        return _places(spark, folder).select(
            F.col("n_nationkey").cast("bigint").alias(id_column), F.col("n_name").alias(name), F.col("address").alias(text)
        )

    def book_categories() -> DataFrame:
        # Distinct by supplier first: it leaves less to join and a hot part is reduced map-side.
        supplied = line_pairs("l_partkey", "l_suppkey")
        nations = supplied.join(star("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        return nations.select(book, F.col("s_nationkey").cast("bigint").alias("id_categoria")).distinct()

    return LazyTables(
        {
            "editoriales": lambda: star("part").select(brand.alias("id_editorial"), F.col("p_brand").alias("nombre")).distinct(),
            "libros": lambda: star("part").select(
                key.alias("id_libro"),
                _title().alias("titulo"),
                published.alias("fecha_publicacion"),
                brand.alias("id_editorial"),
            ),
            "autores": lambda: star("supplier").select(F.col("s_suppkey").alias("id_autor"), F.col("s_name").alias("nombre")),
            "libro_autor": lambda: line_pairs("l_partkey", "l_suppkey").select(
                book, F.col("l_suppkey").alias("id_autor")
            ),
            "categorias": lambda: places("id_categoria", "nombre", "descripcion"),
            "libro_categoria": book_categories,
            "usuarios": lambda: star("customer").select(
                F.col("c_custkey").alias("id_usuario"), F.col("c_name").alias("nombre"), _mail().alias("correo")
            ),
            "prestamos": lambda: star("orders").select(
                F.col("o_orderkey").alias("id_prestamo"),
                F.col("o_custkey").alias("id_usuario"),
                F.col("o_orderdate").cast("date").alias("fecha_salida"),
                _status().alias("estado"),
            ),
            "prestamo_libro": lambda: line_pairs("l_orderkey", "l_partkey").select(loan, book),
            "sedes": lambda: places("id_sede", "nombre", "ubicacion"),
            "inventario": lambda: _stock(spark, folder).select(
                F.col("s_nationkey").cast("bigint").alias("id_sede"),
                book,
                F.when(F.col("l_partkey") % 37 != 0, F.col("q")).alias("cantidad"),
            ),
            "resenas": lambda: _with_part_key(star("events"), star("part")).select(
                F.col("event_id").alias("id_resena"),
                F.col("user_id").alias("id_usuario"),
                F.col("key").alias("id_libro"),
                F.col("event_type").alias("comentario"),
                F.when(F.col("event_id") % 101 != 0, _rating()).alias("calificacion"),
            ),
        }
    )
