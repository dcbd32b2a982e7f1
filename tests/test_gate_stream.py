"""The stock gate as keyed state: a stream with restarts against one batch over all requests."""

import random

from pyspark.sql import functions as F

from anaquel.operators import stock
from anaquel.schema import NORMALISED
from anaquel.sources import tables as io
from anaquel.streaming.gate import PROVIDER, gate_stream

REQUESTS = "secuencia BIGINT, id_libro BIGINT, estado STRING"


def test_stream_with_restarts_equals_one_batch(spark, rows, tmp_path):
    """Every round starts the query anew from its checkpoint; book 3 gets a third of all requests."""
    rng = random.Random(6)
    inventory = spark.createDataFrame(
        [(1, 1, 5), (2, 1, 50), (1, 2, 0), (1, 3, 40), (1, 4, -2), (1, 5, None), (2, 5, 7), (1, 6, 1 << 40)], NORMALISED["inventario"]
    )
    source, target, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    before, every = spark.conf.get(PROVIDER), []
    for n in range(3):
        sequences = rng.sample(range(1000 * n, 1000 * n + 900), 90)
        batch = [(s, rng.choice([3, 3, 3, 1, 2, 4, 5, 6, 9, None]), "Activo") for s in sequences]
        every += batch
        io.write_table(spark.createDataFrame(batch, REQUESTS).repartition(2), source, mode="append")
        query = gate_stream(spark.readStream.schema(REQUESTS).parquet(source), inventory, target, checkpoint)
        query.awaitTermination(120)
        assert query.exception() is None
        want = stock.stock_gate(spark.createDataFrame(every, REQUESTS), inventory)
        got = spark.read.parquet(target)
        assert got.columns == ["secuencia", "id_libro", "estado", "resultado"]
        columns = ["secuencia", F.coalesce("id_libro", F.lit(-1)).alias("id_libro"), "estado", "resultado"]
        assert rows(got.select(*columns)) == rows(want.select(*columns))
    # Nothing new: nothing changes.
    query = gate_stream(spark.readStream.schema(REQUESTS).parquet(source), inventory, target, checkpoint)
    query.awaitTermination(120)
    assert spark.read.parquet(target).count() == len(every)
    assert spark.conf.get(PROVIDER) == before
    served = {r.id_libro: r["count"] for r in got.filter(F.col("resultado") == stock.ACCEPTED).groupBy("id_libro").count().collect()}
    assert served[3] == 40 and served[1] == 5 and not served.keys() & {2, 4, 5, 9, None}
