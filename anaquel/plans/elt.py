"""From four denormalised tables to twelve normalised ones.

Two modes:

* ``compatible`` keeps the matching rules of the established migration: dimensions are distinct on
  the text as it stands, but matched on trimmed text; categories, users and branches are matched on
  part of their key; bridges go through the book title. Several matches give several rows.
* ``strict`` trims before it removes duplicates, matches whole keys, follows the raw row instead of
  the title where the raw row is known, and keeps rows without dimension with a null reference.

In both, loan-book links follow the lists in the raw loans: the first page of a list is in the loan itself, further
ones in ``prestamos_crudos_paginas``, if there is such a table. Simulated links are a choice; those of the established
migration join every loan with every book and keep three pairs of ten (``LINK_PROBABILITY``).

Raw rows are reduced to the distinct keys of a step, with their number in ``_n``, before any join.
That keeps copies of a row out of the shuffles and leaves the multiplicity to the key check.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from threading import RLock

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.functions.predicates import strict_date, strict_int
from anaquel.operators.constraints import MULTIPLICITY
from anaquel.operators.links import bernoulli_links, drawn_pairs
from anaquel.operators.numbering import number_rows
from anaquel.schema import columns
from anaquel.session import concurrently
from anaquel.sources.staging import stage

COMPATIBLE, STRICT = "compatible", "strict"

# Separators in the raw fields.
CATEGORY_SEPARATOR = "/"
LIST_SEPARATOR = ","

# Multipliers of the simulated links; primes, so that draws of one loan differ.
LOAN_FACTOR, DRAW_FACTOR = 7919, 104729
# The share of all pairs of a loan and a book that the established migration links.
LINK_PROBABILITY = 0.3


class InvalidValue(ValueError):
    """A raw date or number cannot be converted, under the policy ``abort``."""


class Migration:
    """The twelve steps over one set of raw tables. Tables are built on demand, each once.

    ``invalid`` says what becomes of a row whose date or rating cannot be converted: ``null`` loads
    the row without it, ``drop`` leaves the row to ``quarantine``, ``abort`` refuses the load.
    ``links_per_loan`` draws so many simulated loan-book links per loan instead of reading the lists; with
    ``expected_links`` every loan and book are linked with the same probability, which gives so many on average;
    ``link_probability`` is that probability itself, and all pairs are drawn.
    """

    def __init__(
        self,
        legacy: Mapping[str, DataFrame],
        mode: str = COMPATIBLE,
        invalid: str = "null",
        links_per_loan: int | None = None,
        expected_links: float | None = None,
        link_probability: float | None = None,
    ):
        drawn = [choice for choice in (links_per_loan, expected_links, link_probability) if choice is not None]
        if len(drawn) > 1:
            raise ValueError("links are drawn by number or by probability, not by both")
        if mode not in (COMPATIBLE, STRICT):
            raise ValueError(f"unknown mode {mode}")
        if invalid not in ("null", "drop", "abort"):
            raise ValueError(f"unknown policy {invalid}")
        self.legacy, self.mode, self.invalid, self.links_per_loan = legacy, mode, invalid, links_per_loan
        self.expected_links, self.link_probability = expected_links, link_probability
        # Whether the links follow the lists in the raw loans.
        self.listed = not drawn
        self._built: dict[str, DataFrame] = {}
        self._staged: dict[str, DataFrame] = {}
        # A step is built once, by the first thread that asks; the others wait for it.
        self._locks = {table: RLock() for table in STEPS}
        if invalid == "abort":
            self._refuse_invalid()

    @property
    def strict(self) -> bool:
        return self.mode == STRICT

    # -- access ---------------------------------------------------------------------------------

    def raw(self, table: str) -> DataFrame:
        """A table with the columns the steps need beside the declared ones."""
        with self._locks[table]:
            if table not in self._built:
                self._built[table] = STEPS[table](self)
            return self._built[table]

    def prepare(self, *tables: str) -> None:
        """Build tables that do not need each other at the same time."""
        concurrently(self.raw, tables)

    def table(self, table: str) -> DataFrame:
        """A table with its declared columns."""
        return self.raw(table).select(*columns(table))

    def staged(self, table: str) -> DataFrame:
        """A table written to the shared folder, with multiplicities where a step counts them."""
        with self._locks[table]:
            if table not in self._staged:
                raw = self.raw(table)
                extra = [MULTIPLICITY] if MULTIPLICITY in raw.columns else []
                # Numbered tables are read back from a staged table already.
                narrow = raw.select(*columns(table), *extra)
                self._staged[table] = narrow if table in NUMBERED else stage(narrow, table)
            return self._staged[table]

    def tables(self) -> dict[str, DataFrame]:
        """All twelve tables, written to the shared folder; steps that do not need each other together."""
        return dict(zip(STEPS, concurrently(self.staged, STEPS)))

    # -- size ------------------------------------------------------------------------------------

    def fanout(self) -> DataFrame:
        """Rows that each join on part of a key has, before any of them runs: ``paso``, ``filas_crudas``, ``filas``.

        A raw key with n rows that finds a and b rows in two lookups gives n times a times b. So the sizes are exact
        from counts per key, and the work follows the raw tables, however large the joins would be. For
        the compatible migration; the strict one does not fan out.
        """
        if self.strict:
            raise ValueError("only the compatible migration fans out")
        self.prepare("editoriales", "autores", "categorias", "usuarios", "sedes", "libros")

        def keys(table: str, column: str) -> DataFrame:
            return self.raw(table).select(F.trim(column).alias("clave"))

        books, title = keys("libros", "titulo"), F.trim("titulo_libro")
        users = self.raw("usuarios").select(F.col("id_usuario").alias("clave"))
        steps = [
            ("libros", "biblioteca_data", [(F.trim("editorial_info"), keys("editoriales", "nombre"))]),
            ("libro_autor", "biblioteca_data", [(F.trim("autor_nombre"), keys("autores", "nombre")), (title, books)]),
            ("libro_categoria", "biblioteca_data", [(_category(1), keys("categorias", "nombre")), (title, books)]),
            ("prestamos", "prestamos_crudos", [(F.trim("correo_usuario"), keys("usuarios", "correo"))]),
            ("resenas", "resenas_usuarios", [(F.col("usuario_id"), users), (F.trim("libro_titulo"), books)]),
            ("inventario", "inventario_sedes", [(F.trim("sede_nombre"), keys("sedes", "nombre")), (F.trim("libro_asociado"), books)]),
        ]
        return reduce(DataFrame.unionByName, [_fanned_out(step, self._convertible(raw), found) for step, raw, found in steps])

    # -- raw values -----------------------------------------------------------------------------

    def quarantine(self) -> DataFrame:
        """Raw dates and ratings that cannot be converted, with the number of rows of each value."""
        found = []
        for table, column, convert in CONVERSIONS:
            value = F.col(column)
            found.append(
                self.legacy[table]
                .filter(value.isNotNull() & convert(value).isNull())
                .groupBy(value.alias("valor"))
                .agg(F.count(F.lit(1)).alias("filas"))
                .select(F.lit(table).alias("tabla"), F.lit(column).alias("columna"), "valor", "filas")
            )
        return found[0].unionByName(found[1])

    def _refuse_invalid(self) -> None:
        first = self.quarantine().first()
        if first is not None:
            raise InvalidValue(f"{first.tabla}.{first.columna}: {first.valor!r} in {first.filas} rows")

    def _convertible(self, table: str) -> DataFrame:
        df = self.legacy[table]
        if self.invalid != "drop":
            return df
        for name, column, convert in CONVERSIONS:
            if name == table:
                df = df.filter(F.col(column).isNull() | convert(F.col(column)).isNotNull())
        return df


def _counted(df: DataFrame, **keys: Column) -> DataFrame:
    """Distinct combinations of ``keys`` with their number of rows."""
    named = df.select(*[expression.alias(name) for name, expression in keys.items()])
    return named.groupBy(*keys).agg(F.count(F.lit(1)).alias(MULTIPLICITY))


def _fanned_out(step: str, raw: DataFrame, lookups: list[tuple[Column, DataFrame]]) -> DataFrame:
    """One row: how many rows ``raw`` has, and how many its joins with the lookups by their ``clave`` would have."""
    sized = _counted(raw, **{f"clave_{i}": key for i, (key, _) in enumerate(lookups)})
    rows = F.col(MULTIPLICITY).cast("decimal(38,0)")
    for i, (_, lookup) in enumerate(lookups):
        per_key = lookup.groupBy(F.col("clave").alias(f"clave_{i}")).agg(F.count(F.lit(1)).alias(f"hallados_{i}"))
        sized = sized.join(per_key, f"clave_{i}", "left")
        rows = (rows * F.coalesce(f"hallados_{i}", F.lit(0))).cast("decimal(38,0)")
    return sized.agg(
        F.lit(step).alias("paso"),
        F.coalesce(F.sum(MULTIPLICITY), F.lit(0)).alias("filas_crudas"),
        F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("filas"),
    )


def _dimension(m: Migration, source: str, id_column: str, **attributes: Column) -> DataFrame:
    """Distinct attribute rows, numbered in their order. Strict mode leaves out the all-null row."""
    rows = m.legacy[source].select(*[expression.alias(name) for name, expression in attributes.items()]).distinct()
    if m.strict:
        rows = rows.dropna(how="all")
    return number_rows(rows, list(attributes), id_column)


def _text(m: Migration, column: str) -> Column:
    return F.trim(column) if m.strict else F.col(column)


def _lookup(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written, so that their size is known before the join and decides a broadcast: then the other side stays where it is."""
    return stage(rows, f"lookup_{name}")


def _category(part: int) -> Column:
    return F.trim(F.split_part("categoria_y_descripcion", F.lit(CATEGORY_SEPARATOR), F.lit(part)))


# -- dimensions -----------------------------------------------------------------------------------


def editoriales(m: Migration) -> DataFrame:
    return _dimension(m, "biblioteca_data", "id_editorial", nombre=_text(m, "editorial_info"))


def autores(m: Migration) -> DataFrame:
    return _dimension(m, "biblioteca_data", "id_autor", nombre=_text(m, "autor_nombre"))


def categorias(m: Migration) -> DataFrame:
    return _dimension(m, "biblioteca_data", "id_categoria", nombre=_category(1), descripcion=_category(2))


def usuarios(m: Migration) -> DataFrame:
    return _dimension(
        m, "prestamos_crudos", "id_usuario", nombre=_text(m, "nombre_usuario"), correo=_text(m, "correo_usuario")
    )


def sedes(m: Migration) -> DataFrame:
    return _dimension(
        m, "inventario_sedes", "id_sede", nombre=_text(m, "sede_nombre"), ubicacion=_text(m, "ubicacion_sede")
    )


# -- books ----------------------------------------------------------------------------------------


def libros(m: Migration) -> DataFrame:
    raw = m._convertible("biblioteca_data").select(
        "id_registro",
        F.col("titulo_libro").alias("titulo"),
        strict_date(F.col("fecha_publicacion")).alias("fecha_publicacion"),
        F.trim("editorial_info").alias("key"),
    )
    publishers = _lookup(m.raw("editoriales").select("id_editorial", F.trim("nombre").alias("key")), "publishers")
    joined = raw.join(publishers, "key", "left" if m.strict else "inner").drop("key")
    return number_rows(joined, ["id_registro", "id_editorial", "titulo", "fecha_publicacion"], "id_libro")


def _titles(m: Migration) -> DataFrame:
    return m.raw("libros").select("id_libro", F.trim("titulo").alias("title"))


def _one_book_per_title(m: Migration) -> DataFrame:
    return _titles(m).groupBy("title").agg(F.min("id_libro").alias("id_libro"))


def libro_autor(m: Migration) -> DataFrame:
    m.prepare("autores", "libros")
    if m.strict:
        raw = m.legacy["biblioteca_data"].select("id_registro", F.trim("autor_nombre").alias("author"))
        authors = m.raw("autores").select("id_autor", F.col("nombre").alias("author"))
        books = m.raw("libros").select("id_registro", "id_libro")
        return raw.join(authors, "author").join(books, "id_registro").select("id_libro", "id_autor").distinct()
    pairs = _counted(m.legacy["biblioteca_data"], title=F.trim("titulo_libro"), author=F.trim("autor_nombre"))
    authors = _lookup(m.raw("autores").select("id_autor", F.trim("nombre").alias("author")), "authors")
    return pairs.join(authors, "author").join(_titles(m), "title").select("id_libro", "id_autor", MULTIPLICITY)


def libro_categoria(m: Migration) -> DataFrame:
    m.prepare("categorias", "libros")
    if m.strict:
        raw = m.legacy["biblioteca_data"].select(
            "id_registro", _category(1).alias("nombre"), _category(2).alias("descripcion")
        )
        books = m.raw("libros").select("id_registro", "id_libro")
        categories = m.raw("categorias")
        same = (raw.nombre == categories.nombre) & raw.descripcion.eqNullSafe(categories.descripcion)
        return raw.join(categories, same).join(books, "id_registro").select("id_libro", "id_categoria").distinct()
    # The description takes no part in the match, so the books are joined first and the several
    # categories of a name come last, after which nothing is shuffled.
    pairs = _counted(m.legacy["biblioteca_data"], title=F.trim("titulo_libro"), name=_category(1))
    categories = _lookup(m.raw("categorias").select("id_categoria", F.trim("nombre").alias("name")), "categories")
    return pairs.join(_titles(m), "title").join(categories, "name").select("id_libro", "id_categoria", MULTIPLICITY)


# -- loans ----------------------------------------------------------------------------------------


def prestamos(m: Migration) -> DataFrame:
    raw = m.legacy["prestamos_crudos"]
    kept = {
        "raw_id": F.col("id_prestamo"),
        "fecha_salida": F.col("fecha_salida"),
        "estado": F.col("estado_prestamo"),
        "mail": F.trim("correo_usuario"),
    }
    order = ["raw_id", "id_usuario", "fecha_salida", "estado"]
    if m.listed and "libros_prestados" in raw.columns:
        # Tells loans of one raw id apart; the list itself stays in the raw loan until its links are read.
        kept["lista"] = F.xxhash64("libros_prestados")
        order.append("lista")
    if m.strict:
        loans = _counted(raw, **kept, name=F.trim("nombre_usuario"))
        users = _lookup(m.raw("usuarios"), "users")
        same = loans.name.eqNullSafe(users.nombre) & loans.mail.eqNullSafe(users.correo)
        joined = loans.join(users, same, "left").drop("mail", "name", "nombre", "correo")
    else:
        users = _lookup(m.raw("usuarios").select("id_usuario", F.trim("correo").alias("mail")), "users")
        joined = _counted(raw, **kept).join(users, "mail").drop("mail")
    return number_rows(joined, order, "id_prestamo", copies=MULTIPLICITY)


def prestamo_libro(m: Migration) -> DataFrame:
    m.prepare("prestamos", "libros")
    loans = m.raw("prestamos")
    if m.link_probability is not None:
        return drawn_pairs(loans, m.raw("libros"), m.link_probability)
    if not m.listed:
        books = m.raw("libros").select(F.count(F.lit(1))).scalar()
        if m.expected_links is not None:
            return bernoulli_links(loans.select("id_prestamo"), books, m.expected_links)
        return simulated_links(loans.select("id_prestamo"), books, m.links_per_loan)
    loans = loans.select("raw_id", "lista", "id_prestamo")
    # A loan takes its list before the list is cut in titles, so titles travel once, with the loan's id. Copies of a
    # raw loan hold one list. The keys are never null, so that copies go and loans are met over one shuffle.
    number, unnumbered = F.coalesce("raw_id", F.lit(0)).alias("number"), F.col("raw_id").isNull().alias("unnumbered")
    key = ["number", "unnumbered", "lista"]
    raw = m.legacy["prestamos_crudos"].withColumn("raw_id", F.col("id_prestamo"))
    listed = raw.select(number, unnumbered, F.xxhash64("libros_prestados").alias("lista"), "libros_prestados").dropDuplicates(key)
    lists = loans.select(number, unnumbered, "lista", "id_prestamo").join(listed, key).select("id_prestamo", "libros_prestados")
    if "prestamos_crudos_paginas" in m.legacy:
        pages = m.legacy["prestamos_crudos_paginas"].select(F.col("id_prestamo").alias("raw_id"), "libros_prestados")
        lists = lists.unionByName(loans.join(pages, "raw_id").select("id_prestamo", "libros_prestados"))
    return listed_links(lists, _one_book_per_title(m) if m.strict else _titles(m), "id_prestamo")


def simulated_links(loans: DataFrame, books: Column, links_per_loan: int) -> DataFrame:
    """Simulated loan-book links: ``links_per_loan`` draws per loan from book ids 1..``books``.

    The draws are arithmetic in the loan id, so a rerun gives the same links. Equal draws of one loan
    count once. Each loan is handled on its own: no join, no shuffle, and the number of links grows
    with the loans, not with loans times books.
    """

    def draw(j: Column) -> Column:
        return (F.col("id_prestamo") * LOAN_FACTOR + j.cast("bigint") * DRAW_FACTOR) % F.col("_books") + 1

    drawn = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(links_per_loan - 1)), draw))
    return (
        loans.withColumn("_books", books)
        .filter(F.col("_books") > 0)
        .select("id_prestamo", F.explode(drawn).alias("id_libro"))
    )


def listed_links(lists: DataFrame, titles: DataFrame, *key: str) -> DataFrame:
    """The books that the lists in ``libros_prestados`` name by title: ``key`` and ``id_libro``, each pair once."""
    entry = F.explode(F.split("libros_prestados", f"\\Q{LIST_SEPARATOR}\\E"))
    entries = lists.select(*key, entry.alias("entry")).select(*key, F.trim("entry").alias("title"))
    # A book has one title, so pairs are distinct with it, and are together by title after the join already.
    return entries.join(titles, "title").select(*key, "title", "id_libro").distinct().drop("title")


# -- reviews and inventory ------------------------------------------------------------------------


def resenas(m: Migration) -> DataFrame:
    m.prepare("usuarios", "libros")
    reviews = _counted(
        m._convertible("resenas_usuarios"),
        id_usuario=F.col("usuario_id"),
        title=F.trim("libro_titulo"),
        comentario=F.col("comentario"),
        calificacion=strict_int(F.col("calificacion")),
    )
    titles = _one_book_per_title(m) if m.strict else _titles(m)
    joined = reviews.join(m.raw("usuarios").select("id_usuario"), "id_usuario").join(titles, "title")
    order = ["id_usuario", "title", "comentario", "calificacion", "id_libro"]
    return number_rows(joined, order, "id_resena", copies=MULTIPLICITY)


def inventario(m: Migration) -> DataFrame:
    m.prepare("sedes", "libros")
    raw = m.legacy["inventario_sedes"]
    kept = {"branch": F.trim("sede_nombre"), "title": F.trim("libro_asociado"), "cantidad": F.col("cantidad_total")}
    if m.strict:
        stock = _counted(raw, **kept, address=F.trim("ubicacion_sede"))
        branches = _lookup(m.raw("sedes"), "branches")
        same = stock.branch.eqNullSafe(branches.nombre) & stock.address.eqNullSafe(branches.ubicacion)
        joined = stock.join(branches, same).join(_one_book_per_title(m), "title")
    else:
        branches = _lookup(m.raw("sedes").select("id_sede", F.trim("nombre").alias("branch")), "branches")
        joined = _counted(raw, **kept).join(_titles(m), "title").join(branches, "branch")
    return joined.select("id_sede", "id_libro", "cantidad", MULTIPLICITY)


# In the order of their dependencies.
STEPS: dict[str, Callable[[Migration], DataFrame]] = {
    "editoriales": editoriales,
    "libros": libros,
    "autores": autores,
    "libro_autor": libro_autor,
    "categorias": categorias,
    "libro_categoria": libro_categoria,
    "usuarios": usuarios,
    "prestamos": prestamos,
    "prestamo_libro": prestamo_libro,
    "resenas": resenas,
    "sedes": sedes,
    "inventario": inventario,
}

NUMBERED = {"editoriales", "libros", "autores", "categorias", "usuarios", "prestamos", "resenas", "sedes"}

CONVERSIONS = (
    ("biblioteca_data", "fecha_publicacion", strict_date),
    ("resenas_usuarios", "calificacion", strict_int),
)
