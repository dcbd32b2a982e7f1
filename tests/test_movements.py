"""Stock gate, loans, returns and reviews against a request-by-request simulation."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from anaquel.operators import movements, stock
from anaquel.schema import NORMALISED

DAY = dt.date(2026, 3, 1)
AS_OF = F.lit


def simulate(requests, inventory):
    """Serve (sequence, book) one after another, as a row trigger would."""
    left = {(s, b): q for s, b, q in inventory}
    gate = {}
    for s, b in sorted(left):
        gate.setdefault(b, (s, b))
    results = {}
    for sequence, book in sorted(requests, key=lambda r: r[0]):
        row = gate.get(book)
        if row is None or left[row] is None:
            results[(sequence, book)] = stock.UNKNOWN_BOOK
        elif left[row] <= 0:
            results[(sequence, book)] = stock.NO_STOCK
        else:
            results[(sequence, book)] = stock.ACCEPTED
            for key in left:
                if key[1] == book and left[key] is not None:
                    left[key] -= 1
    return results, left


def random_case(seed):
    rng = random.Random(seed)
    inventory = [
        (s, b, rng.choice([None, -1, 0, 1, 2, 5, 30])) for b in range(1, 12) for s in range(1, 6) if rng.random() < 0.5
    ]
    books = [rng.choice([3, 3, 3, *range(1, 14), None]) for _ in range(300)]
    return list(zip(rng.sample(range(5000), 300), books)), inventory


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_gate_matches_simulation(spark, seed):
    requests, inventory = random_case(seed)
    reqs = spark.createDataFrame(requests, "secuencia BIGINT, id_libro BIGINT")
    inv = spark.createDataFrame(inventory, NORMALISED["inventario"])
    want, left = simulate(requests, inventory)
    got = {(r.secuencia, r.id_libro): r.resultado for r in stock.stock_gate(reqs, inv).collect()}
    assert got == want
    after = {(r.id_sede, r.id_libro): r.cantidad for r in stock.stock_after(reqs, inv).collect()}
    assert after == left


@pytest.mark.parametrize("seed, ranges, settled", [(1, 1024, 10_000), (2, 4, 3), (3, 2, 1)])
def test_threshold_gate_matches_simulation(spark, monkeypatch, seed, ranges, settled):
    """Also with so few ranges that the one where the stock runs out is narrowed down several times."""
    monkeypatch.setattr(stock, "RANGES", ranges)
    monkeypatch.setattr(stock, "SETTLED", settled)
    requests, inventory = random_case(seed)
    reqs = spark.createDataFrame(requests, "secuencia BIGINT, id_libro BIGINT")
    inv = spark.createDataFrame(inventory, NORMALISED["inventario"])
    want, _ = simulate(requests, inventory)
    gated = stock.threshold_gate(reqs, inv)
    assert gated.columns == ["secuencia", "id_libro", "disponible", "resultado"]
    assert {(r.secuencia, r.id_libro): r.resultado for r in gated.collect()} == want
    # Requests that do not count take no stock.
    even = F.col("secuencia") % 2 == 0
    want, _ = simulate([r for r in requests if r[0] % 2 == 0], inventory)
    got = {(r.secuencia, r.id_libro): r.resultado for r in stock.threshold_gate(reqs, inv, even).collect()}
    assert {k: v for k, v in got.items() if v is not None} == want and all(k[0] % 2 for k, v in got.items() if v is None)


def test_thresholds_without_requests_and_with_a_hot_book(spark):
    inventory = spark.createDataFrame([(1, 1, 700), (1, 2, 5), (1, 3, 0)], NORMALISED["inventario"])
    none = spark.createDataFrame([], "secuencia BIGINT, id_libro BIGINT")
    assert stock.threshold_gate(none, inventory).collect() == []
    hot = spark.range(3000).select((F.col("id") * 1_000_003 - 9).alias("secuencia"), F.when(F.col("id") % 3 < 2, 1).otherwise(2).alias("id_libro"))
    found = {r.id_libro: r.ultima for r in stock.thresholds(hot, inventory).collect()}
    order = sorted(r.secuencia for r in hot.filter("id_libro = 1").collect())
    assert found == {1: order[699], 2: 4 * 3 * 1_000_003 + 2 * 1_000_003 - 9, 3: None}


def test_hot_book_and_large_quantity(spark):
    huge = 1 << 33
    inventory = spark.createDataFrame([(s, 1, huge) for s in range(1, 4)] + [(1, b, 5) for b in range(2, 300)], NORMALISED["inventario"])
    requests = spark.range(900).select(F.col("id").alias("secuencia"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 299 + 1).alias("id_libro"))
    left = {(r.id_sede, r.id_libro): r.cantidad for r in stock.stock_after(requests, inventory).collect()}
    asked = requests.filter("id_libro = 1").count()
    assert asked > 300 and all(left[(s, 1)] == huge - asked for s in range(1, 4))


def test_policy_abort(spark):
    reqs = spark.createDataFrame([(1, 1), (2, 1)], "secuencia BIGINT, id_libro BIGINT")
    enough = spark.createDataFrame([(1, 1, 2)], NORMALISED["inventario"])
    assert stock.refuse_any(stock.stock_gate(reqs, enough)).count() == 2
    with pytest.raises(stock.RequestRefused, match=stock.NO_STOCK):
        stock.refuse_any(stock.stock_gate(reqs, enough.withColumn("cantidad", F.lit(1))))


def test_register_loans(spark, rows):
    users = spark.createDataFrame([(5, "x", "a@x.c"), (2, "y", "a@x.c"), (3, "z", None)], NORMALISED["usuarios"])
    inventory = spark.createDataFrame([(1, 1, 1), (2, 1, 9), (1, 2, 0)], NORMALISED["inventario"])
    loans = spark.createDataFrame([(40, 5, DAY, "Activo")], NORMALISED["prestamos"])
    requests = spark.createDataFrame(
        [
            (10, "b@x.c", 1, "Activo"), (20, "a@x.c", 1, "Activo"), (30, "a@x.c", 1, "Otro"), (40, "a@x.c ", 1, "Activo"),
            (50, "a@x.c", 2, "Activo"), (60, "a@x.c", 3, "Activo"), (70, None, 1, "Activo"),
        ],
        "secuencia BIGINT, correo STRING, id_libro BIGINT, estado STRING",
    )
    results = movements.register_loans(requests, users, inventory, loans, F.lit(DAY))
    got = rows(results, "secuencia", "id_prestamo", "id_usuario", "resultado")
    assert got == [
        (10, None, None, movements.UNKNOWN_USER),
        (20, 41, 2, stock.ACCEPTED),
        (30, None, 2, stock.NO_STOCK),
        (40, None, None, movements.UNKNOWN_USER),
        (50, None, 2, stock.NO_STOCK),
        (60, None, 2, stock.UNKNOWN_BOOK),
        (70, None, None, movements.UNKNOWN_USER),
    ]
    assert rows(movements.new_loans(results)) == [(41, 2, DAY, "Activo")]
    assert rows(movements.new_loan_lines(results)) == [(41, 1)]


def test_register_loans_with_hot_book_and_user(spark):
    rng = random.Random(4)
    requests = [
        (s, rng.choice(["hot", "hot", "u1", "u2", "nobody"]), rng.choice([1, 1, 1, 2, 3])) for s in rng.sample(range(9000), 400)
    ]
    users = {"hot": 1, "u1": 2, "u2": 3}
    inventory = [(1, 1, 120), (1, 2, 20), (1, 3, None)]
    results = movements.register_loans(
        spark.createDataFrame([(*r, "Activo") for r in requests], "secuencia BIGINT, correo STRING, id_libro BIGINT, estado STRING"),
        spark.createDataFrame([(i, m, m) for m, i in users.items()], NORMALISED["usuarios"]),
        spark.createDataFrame(inventory, NORMALISED["inventario"]),
        spark.createDataFrame([], NORMALISED["prestamos"]),
        F.lit(DAY),
    )
    served, _ = simulate([(s, b) for s, m, b in requests if m in users], inventory)
    want, next_id = {}, 0
    for s, m, b in sorted(requests):
        result = served[(s, b)] if m in users else movements.UNKNOWN_USER
        next_id += result == stock.ACCEPTED
        want[s] = (result, next_id if result == stock.ACCEPTED else None)
    assert {r.secuencia: (r.resultado, r.id_prestamo) for r in results.collect()} == want


def test_returns(spark, rows):
    loans = spark.createDataFrame([(1, 1, DAY, "Activo"), (2, 1, DAY, "Devuelto"), (3, 1, DAY, "Otro")], NORMALISED["prestamos"])
    returns = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "id_prestamo BIGINT")
    assert rows(movements.return_loans(loans, returns), "id_prestamo", "estado") == [(1, "Devuelto"), (2, "Devuelto"), (3, "Otro")]
    assert rows(movements.unknown_returns(loans, returns)) == [(None, 1), (9, 2)]


def test_reviews(spark, rows):
    users = spark.createDataFrame([(1, "x", "m")], NORMALISED["usuarios"])
    books = spark.createDataFrame([(1, "t", DAY, 1)], NORMALISED["libros"])
    reviews = spark.createDataFrame([(7, 1, 1, "c", 5)], NORMALISED["resenas"])
    requests = spark.createDataFrame(
        [(1, 1, 1, "c", 1), (2, 1, 1, "c", 5), (3, 1, 1, "c", 0), (4, 1, 1, "c", 6), (5, 1, 1, "c", None), (6, 2, 1, "c", 3),
         (7, 1, 2, "c", 3), (8, None, None, "c", 3)],
        "secuencia BIGINT, id_usuario BIGINT, id_libro BIGINT, comentario STRING, calificacion INT",
    )
    got = rows(movements.register_reviews(requests, users, books, reviews), "secuencia", "id_resena", "resultado")
    assert got == [
        (1, 8, stock.ACCEPTED), (2, 9, stock.ACCEPTED), (3, None, movements.BAD_RATING), (4, None, movements.BAD_RATING),
        (5, 10, stock.ACCEPTED), (6, None, movements.UNKNOWN_USER), (7, None, movements.UNKNOWN_BOOK), (8, 11, stock.ACCEPTED),
    ]


def test_audit_log_appends_without_removing_duplicates(spark, rows, tmp_path):
    from anaquel.plans.run import append_audit_log

    tables = {
        "usuarios": spark.createDataFrame([(1, "Ana", "m")], NORMALISED["usuarios"]),
        "prestamos": spark.createDataFrame(
            [(5, 1, DAY, "Activo"), (6, 1, DAY, "Devuelto"), (7, None, DAY, "Activo"), (9, 1, None, "Activo")],
            NORMALISED["prestamos"],
        ),
    }
    first, second = dt.datetime(2026, 3, 1, 8), dt.datetime(2026, 3, 2, 8)
    for moment in (first, second):
        append_audit_log(spark, tables, str(tmp_path / "log"), F.lit(moment))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert rows(log, "id_log", "id_prestamo", "usuario", "fecha_log") == [
        (1, 5, "Ana", first), (2, 9, "Ana", first), (3, 5, "Ana", second), (4, 9, "Ana", second),
    ]
