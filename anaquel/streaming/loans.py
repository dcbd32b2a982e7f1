"""Loan requests as a stream.

Every micro-batch runs the batch operator against the stock that earlier batches left. It writes its
results to a folder of its own, and beside them the state after it: per book the requests accepted so
far and the highest loan id. The next batch reads only that state, so its work does not grow with
the number of batches. A batch that is run again starts from the same state and rewrites its own
folders, so a restart repeats nothing and loses nothing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from anaquel.operators.movements import register_loans
from anaquel.operators.stock import ACCEPTED, take_off
from anaquel.plans.run import read_if_present
from anaquel.sources.staging import stage
from anaquel.sources.tables import write_table

RESULTS = (
    "secuencia BIGINT, id_prestamo BIGINT, id_usuario BIGINT, id_libro BIGINT, fecha_salida DATE, estado STRING, "
    "resultado STRING"
)
STATE = "id_libro BIGINT, aceptados BIGINT, ultimo BIGINT"


def state_folder(folder: str, batch: int) -> str:
    return f"{folder.rstrip('/')}_estado/batch={batch}"


def register_batch(
    requests: DataFrame, batch: int, tables: Mapping[str, DataFrame], folder: str, as_of: Column
) -> None:
    """Register the loans of one micro-batch into ``folder``/batch=n."""
    spark = requests.sparkSession
    inventory, loans = tables["inventario"], tables["prestamos"].select(F.max("id_prestamo").alias("id_prestamo"))
    before = read_if_present(spark, state_folder(folder, batch - 1), STATE)
    if before is not None:
        inventory = take_off(inventory, before.select("id_libro", "aceptados"))
        loans = loans.unionByName(before.select(F.max("ultimo").alias("id_prestamo")))
    # The requests are read several times; the source only once.
    results = register_loans(stage(requests, "microbatch"), tables["usuarios"], inventory, loans, as_of)
    written = f"{folder.rstrip('/')}/batch={batch}"
    write_table(results, written)
    accepted = spark.read.schema(RESULTS).parquet(written).filter(F.col("resultado") == ACCEPTED)
    state = accepted.groupBy("id_libro").agg(F.count(F.lit(1)).alias("aceptados"), F.max("id_prestamo").alias("ultimo"))
    if before is not None:
        both = state.unionByName(before)
        state = both.groupBy("id_libro").agg(F.sum("aceptados").alias("aceptados"), F.max("ultimo").alias("ultimo"))
    write_table(state, state_folder(folder, batch))


def register_stream(
    requests: DataFrame,
    tables: Mapping[str, DataFrame],
    folder: str,
    checkpoint: str,
    as_of: Column,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Register a stream of requests (``secuencia``, ``correo``, ``id_libro``, ``estado``).

    ``trigger`` is that of the query, by default what is there now and no more.
    """
    folder = folder.rstrip("/")
    return (
        requests.writeStream.foreachBatch(lambda df, batch: register_batch(df, batch, tables, folder, as_of))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
