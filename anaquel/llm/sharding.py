"""Shards by jump consistent hashing of a stable key, in built-in expressions only.

The walk of Lamping and Veach needs no table: a key draws jumps 0 = j0 < j1 < j2 ... from its own
generator, and its shard among n is the last jump below n. So one walk up to the largest count gives
the shard under every count, and with one more shard a key either stays or moves to the new one.

Slots number the rows of a shard from 0 without gaps, in order of the key, by prefix counts that are
spread over tasks.

Defined results: a null text has no bytes and checksum 0; a null key has the walk of key 0 and the
first slots of its shard; repeated rows are rows of their own, on the same shard, in neighbouring slots
(a key that holds many rows is still spread over tasks, by position); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.llm.common import table, text_or_empty
from anaquel.llm.prefix import prefix_sums

SHARDS = 8
# Multiplier of the published generator.
MULTIPLIER = 2862933555777941757
_M1, _M0 = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
_LOW32 = 0xFFFFFFFF


def _next(key: Column) -> Column:
    """``key * MULTIPLIER + 1`` modulo 2^64, in halves that never overflow a signed BIGINT."""

    def low(column: Column, mask: int) -> Column:
        return column.bitwiseAND(F.lit(mask).cast("bigint"))

    k0, k1 = low(key, _LOW32), F.shiftrightunsigned(key, 32)
    middle = F.shiftright(k0, 16) * F.lit(_M0)
    bottom = low(k0, 0xFFFF) * F.lit(_M0) + F.shiftleft(low(middle, 0xFFFF), 16) + F.lit(1)
    top = (
        F.shiftright(bottom, 32)
        + F.shiftright(middle, 16)
        + low(k0 * F.lit(_M1), _LOW32)
        + low(low(k1, 0xFFFF) * F.lit(_M0), _LOW32)
        + F.shiftleft(low(F.shiftright(k1, 16) * F.lit(_M0), 0xFFFF), 16)
    )
    return F.shiftleft(low(top, _LOW32), 32).bitwiseOR(low(bottom, _LOW32))


def jumps(key: Column, most: int) -> Column:
    """The jumps of a BIGINT key that are below ``most``, ascending; the first is 0."""
    start = F.struct(
        F.coalesce(key.cast("bigint"), F.lit(0)).alias("key"),
        F.lit(0).cast("bigint").alias("at"),
        F.array(F.lit(0).cast("bigint")).alias("seen"),
    )

    def step(state: Column, _: Column) -> Column:
        drawn = F.transform(F.array(_next(state["key"])), lambda k: F.struct(k.alias("key"), _jump(state["at"], k).alias("at")))[0]
        moved = F.transform(
            F.array(drawn),
            lambda d: F.struct(
                d["key"].alias("key"),
                d["at"].alias("at"),
                F.when(d["at"] < most, F.concat(state["seen"], F.array(d["at"]))).otherwise(state["seen"]).alias("seen"),
            ),
        )[0]
        return F.when(state["at"] < most, moved).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, step, lambda state: state["seen"])


def _jump(at: Column, key: Column) -> Column:
    fraction = (F.shiftrightunsigned(key, 33) + F.lit(1)).cast("double")
    return F.floor((at + 1).cast("double") * (F.lit(float(1 << 31)) / fraction)).cast("bigint")


def shard_of(walk: Column, shards: int) -> Column:
    """Shard among ``shards`` of a key with the jumps ``walk``."""
    return F.array_max(F.filter(walk, lambda at: at < shards)).cast("int")


def assign_shards(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """``key``, ``size``, ``text_crc32``, ``shard``, ``slot`` and ``grown_shard`` (with one more) of every row."""
    text = text_or_empty()
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        jumps(F.col(key), shards + 1).alias("walk"),
    ).select("doc_id", "size", "text_crc32", shard_of(F.col("walk"), shards).alias("shard"), shard_of(F.col("walk"), shards + 1).alias("grown_shard"))
    numbered = prefix_sums(rows, "shard", [F.col("doc_id").asc_nulls_first()], {"slot": F.lit(1).cast("bigint")})
    return numbered.select("doc_id", "size", "text_crc32", "shard", "slot", "grown_shard")


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return assign_shards(table(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


# The checksum goes byte by byte through the remainders of its polynomial; the walk of a key is a recursion over its jumps.
ORACLE = f"""
WITH RECURSIVE remainders AS (
    SELECT list(list_reduce([k] || range(8), lambda r, _: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END) ORDER BY k) AS steps
    FROM range(256) t(k)),
keys AS (SELECT DISTINCT doc_id FROM documents),
walk AS (
    SELECT doc_id, (coalesce(doc_id, 0)::HUGEINT + 18446744073709551616) % 18446744073709551616 AS key, 0::BIGINT AS jump FROM keys
    UNION ALL
    SELECT doc_id, drawn, floor((jump + 1) * (2147483648::DOUBLE / (drawn // 8589934592 + 1)::DOUBLE))::BIGINT
    FROM (SELECT doc_id, jump, (key * {MULTIPLIER} + 1) % 18446744073709551616 AS drawn FROM walk WHERE jump <= {SHARDS})),
placed AS (
    SELECT doc_id, max(jump) FILTER (jump < {SHARDS})::INT AS shard, max(jump) FILTER (jump <= {SHARDS})::INT AS grown_shard
    FROM walk GROUP BY doc_id),
bytes AS (
    SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b
    FROM documents)
SELECT b.doc_id, len(b) + 1 AS size,
       xor(list_reduce([4294967295] || b, lambda r, x: xor(r // 256, steps[xor(r % 256, x) + 1])), 4294967295) AS text_crc32,
       'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY b.doc_id NULLS FIRST) - 1 AS slot, grown_shard
FROM bytes b JOIN placed p ON b.doc_id IS NOT DISTINCT FROM p.doc_id, remainders"""
