"""Batches of loans, returns and reviews, and the audit log.

Each operator takes a table of requests and returns new rows or a new version of a table, with a
reason for every request it does not carry out. Nothing is updated in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anaquel.operators.numbering import rank_by_sequence
from anaquel.operators.stock import ACCEPTED, threshold_gate
from anaquel.sources.staging import stage

UNKNOWN_USER = "usuario_no_encontrado"
UNKNOWN_BOOK = "libro_no_encontrado"
BAD_RATING = "calificacion_invalida"

# States of a loan, limits of a rating.
ACTIVE = "Activo"
RETURNED = "Devuelto"
LOWEST_RATING, HIGHEST_RATING = 1, 5


def last_id(table: DataFrame, id_column: str) -> Column:
    """Highest id given so far, 0 for an empty table."""
    return table.select(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint")).scalar()


def register_loans(
    requests: DataFrame, users: DataFrame, inventory: DataFrame, loans: DataFrame, as_of: Column
) -> DataFrame:
    """Loans for requests (``secuencia``, ``correo``, ``id_libro``, ``estado``), in sequence order.

    The user is found by exact e-mail, the lowest id where several share it. A request without user
    takes no stock. Accepted requests get the next loan ids; the others have a reason and no id.
    """
    wanted = users.join(requests.select("correo").distinct(), "correo", "left_semi")
    by_mail = wanted.groupBy("correo").agg(F.min("id_usuario").alias("id_usuario"))
    # Read several times from here on, without the e-mails.
    found = stage(requests.join(by_mail, "correo", "left").select("secuencia", "id_usuario", "id_libro", "estado"), "requests")
    has_user = F.col("id_usuario").isNotNull()
    gated = threshold_gate(found, inventory, counted=has_user).withColumn(
        "resultado", F.when(has_user, F.col("resultado")).otherwise(UNKNOWN_USER)
    )
    accepted = F.col("resultado") == ACCEPTED
    numbered = rank_by_sequence(gated, "secuencia", "_new", counted=accepted)
    return numbered.select(
        "secuencia",
        (F.col("_new") + last_id(loans, "id_prestamo")).alias("id_prestamo"),
        "id_usuario",
        "id_libro",
        F.when(accepted, as_of).alias("fecha_salida"),
        "estado",
        "resultado",
    )


def new_loans(results: DataFrame) -> DataFrame:
    """Rows to append to the loans."""
    return results.filter(F.col("resultado") == ACCEPTED).select("id_prestamo", "id_usuario", "fecha_salida", "estado")


def new_loan_lines(results: DataFrame) -> DataFrame:
    """Rows to append to the loan-book links."""
    return results.filter(F.col("resultado") == ACCEPTED).select("id_prestamo", "id_libro")


def return_loans(loans: DataFrame, returns: DataFrame) -> DataFrame:
    """The loans with the returned ones marked. The stock stays as it is."""
    returned = returns.select("id_prestamo").distinct().withColumn("_back", F.lit(True))
    return loans.join(returned, "id_prestamo", "left").select(
        "id_prestamo",
        "id_usuario",
        "fecha_salida",
        F.when(F.col("_back"), RETURNED).otherwise(F.col("estado")).alias("estado"),
    )


def unknown_returns(loans: DataFrame, returns: DataFrame) -> DataFrame:
    """Returned loan ids that do not exist, with the number of requests for each."""
    asked = returns.groupBy("id_prestamo").agg(F.count(F.lit(1)).alias("solicitudes"))
    return asked.join(loans.select("id_prestamo"), "id_prestamo", "left_anti")


def register_reviews(requests: DataFrame, users: DataFrame, books: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews for requests (``secuencia``, ``id_usuario``, ``id_libro``, ``comentario``, ``calificacion``).

    A rating outside the limits is refused, a missing one is not. A user or book must exist if given.
    """
    known_users = users.select("id_usuario", F.lit(True).alias("_user"))
    known_books = books.select("id_libro", F.lit(True).alias("_book"))
    off = (F.col("calificacion") < LOWEST_RATING) | (F.col("calificacion") > HIGHEST_RATING)
    checked = (
        requests.join(known_users, "id_usuario", "left")
        .join(known_books, "id_libro", "left")
        .withColumn(
            "resultado",
            F.when(off, BAD_RATING)
            .when(F.col("id_usuario").isNotNull() & F.col("_user").isNull(), UNKNOWN_USER)
            .when(F.col("id_libro").isNotNull() & F.col("_book").isNull(), UNKNOWN_BOOK)
            .otherwise(ACCEPTED),
        )
    )
    numbered = rank_by_sequence(checked, "secuencia", "_new", counted=F.col("resultado") == ACCEPTED)
    return numbered.select(
        "secuencia",
        (F.col("_new") + last_id(reviews, "id_resena")).alias("id_resena"),
        "id_usuario",
        "id_libro",
        "comentario",
        "calificacion",
        "resultado",
    )


def audit_log(loans: DataFrame, users: DataFrame, run_time: Column, log: DataFrame | None = None) -> DataFrame:
    """Log rows of all active loans, one time stamp per run, to append to the log."""
    active = loans.filter(F.col("estado") == ACTIVE).select("id_prestamo", "id_usuario", "fecha_salida")
    # Names come after the numbering, which sorts and writes its rows.
    numbered = rank_by_sequence(active.join(users.select("id_usuario"), "id_usuario", "left_semi"), "id_prestamo", "_new")
    start = last_id(log, "id_log") if log is not None else F.lit(0).cast("bigint")
    return numbered.join(users.select("id_usuario", "nombre"), "id_usuario").select(
        (F.col("_new") + start).alias("id_log"),
        "id_prestamo",
        F.col("nombre").alias("usuario"),
        "fecha_salida",
        run_time.cast("timestamp_ntz").alias("fecha_log"),
    )
