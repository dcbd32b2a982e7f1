"""The stock gate as keyed state: one value a book, what is left of the quantity its gate reads.

The state begins with the inventory and lives in the state store of the query, changed where a book has requests and
nowhere else; a batch reads and writes no state of other books. Decisions go to a table with exactly-once commits.

All requests of a book in a batch meet in one task, which holds no more of them than the book has copies left. Where single
books get a large share of a batch, ``loans.register_stream`` is the other way: it counts before it shuffles.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator, Mapping

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StringType, StructType

from anaquel.operators.stock import ACCEPTED, NO_STOCK, UNKNOWN_BOOK, gate_quantity

# Keyed state needs this state store.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class StockOfBook(StatefulProcessor):
    """Serves the requests of a book in the order of ``secuencia``, as far as its stock goes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.left = handle.getValueState("queda", "queda BIGINT")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.left.update((initialState.disponible,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if not self.left.exists():
            yield from (self._answered(row, UNKNOWN_BOOK) for row in rows)
            return
        left = self.left.get()[0]
        # The requests with the smallest numbers so far, the largest of them first; one that is pushed out is refused.
        served: list[tuple[int, int, Row]] = []
        for place, row in enumerate(rows):
            entry = (-row.secuencia, -place, row)
            refused = row
            if len(served) < left:
                heapq.heappush(served, entry)
                continue
            if served and entry[:2] > served[0][:2]:
                refused = heapq.heapreplace(served, entry)[2]
            yield self._answered(refused, NO_STOCK)
        if served:
            self.left.update((left - len(served),))
        yield from (self._answered(row, ACCEPTED) for _, _, row in served)

    def close(self) -> None:
        pass

    @staticmethod
    def _answered(row: Row, result: str) -> Row:
        return Row(**row.asDict(), resultado=result)


def gated(requests: DataFrame, inventory: DataFrame) -> DataFrame:
    """A stream of requests (``secuencia``, ``id_libro`` and any others) with ``resultado``.

    Over batches whose numbers grow it answers as ``stock.stock_gate`` does over all requests at once; a later batch never takes
    back what an earlier one was given. A request without a book, or for one without stock rows, is for an unknown book.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    answered = StructType([*requests.schema.fields]).add("resultado", StringType())
    known = gate_quantity(inventory).filter(F.col("id_libro").isNotNull() & F.col("disponible").isNotNull())
    first = known.select("id_libro", F.col("disponible").cast("bigint").alias("disponible"))
    return requests.groupBy("id_libro").transformWithState(
        StockOfBook(), answered, outputMode="Append", timeMode="None", initialState=first.groupBy("id_libro")
    )


def gate_stream(
    requests: DataFrame, inventory: DataFrame, folder: str, checkpoint: str, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Write the answers to a stream of requests to ``folder``; by default those to what is there now and no more.

    The query takes the state store it needs from the session's settings as it starts; they are put back then.
    """
    conf = requests.sparkSession.conf
    before = conf.get(PROVIDER, None)
    conf.set(PROVIDER, ROCKSDB)
    try:
        writer = gated(requests, inventory).writeStream.format("parquet").outputMode("append")
        return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start(folder)
    finally:
        if before is None:
            conf.unset(PROVIDER)
        else:
            conf.set(PROVIDER, before)
