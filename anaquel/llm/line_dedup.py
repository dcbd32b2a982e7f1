"""Line dedup that can be undone: sharded cuckoo filters in front of exact reference counts.

An index of lines lives in a folder and grows by generations; each inserts or deletes documents. The key of a
line (stripped, A-Z lower-cased, known by 128 bits of hash) belongs to one of the index's shards. A shard has a
cuckoo filter of 16-bit fingerprints, one for every distinct key that some document holds. Behind the filters
stands the exact table: per key its reference count and the smallest document that holds it, as a log in which
the newest row of a key counts.

Inserting documents probes the filters, shard by shard, with the distinct keys of the load. A key the filter does not
have is new for certain: it is appended to the counts without looking anything up, and its fingerprint is added. Only
the others are joined with the exact table, which says whether they are known, and then their count goes up, or were
taken for another key with the same fingerprint, and then they get a fingerprint of their own. So a key has exactly one
fingerprint as long as its count is above zero. Deleting documents recounts the keys they held from the
holdings that are left, and takes the fingerprint of a key away when its count falls to zero.

A filter that fills up gets more slots in every bucket. Fingerprints that agree in value and buckets are
interchangeable, so a deletion never hides another key.

A key held by several documents keeps its lines in the smallest ``doc_id`` only. Defined results: a null or empty text
is one empty line; rows that repeat a ``doc_id`` are one document for the verdict, and each row counts as a
reference; rows without id hold nothing and lose nothing; an empty table gives no rows and an index without keys; other
columns are ignored by ``holdings`` and kept by ``strip``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.llm.common import rows_by_bytes, schema_of, table, with_arrays
from anaquel.llm.words import mix
from anaquel.sources.staging import shared_dir, stage

# What is stripped from a line, and the shortest key in code points.
BLANK = " \t\n\v\f\r"
LEAST = 10
GROUP_BYTES = 4 << 20
# Distinct keys a shard is laid out for, and the fewest shards of an index.
SHARD_KEYS, LEAST_SHARDS = 1 << 16, 256
# The registered query loads the corpus in so many parts, by a hash of the id.
LOADS = 4

SLOTS, LOAD, PRINT_BITS = 4, 0.85, 16
ROUNDS = 200


class CuckooFilter:
    """Fingerprints of 64-bit values in buckets; each value has two buckets and may be in either.

    ``slots`` has a row per bucket, filled from the left, 0 where it is free. All operations work on arrays of values.
    """

    def __init__(self, slots: np.ndarray, bits: int = PRINT_BITS):
        self.slots, self.bits = slots, bits
        self.filled = (slots != 0).sum(axis=1)

    @classmethod
    def sized(cls, keys: int, bits: int = PRINT_BITS) -> CuckooFilter:
        buckets = 1 << max(4, int(np.ceil(keys / (SLOTS * LOAD))).bit_length())
        return cls(np.zeros((buckets, SLOTS), np.uint16), bits)

    @classmethod
    def read(cls, buckets: int, data: bytes, bits: int = PRINT_BITS) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(buckets, -1).copy(), bits)

    def _places(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint and first bucket of each value."""
        bits = values.astype(np.int64, copy=False).view(np.uint64)
        prints = (bits & np.uint64((1 << self.bits) - 1)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, ((bits >> np.uint64(16)) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _other(self, prints: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The other bucket of a fingerprint that is in, or meant for, the bucket ``at``."""
        return at ^ (mix(prints.astype(np.uint64)) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def contains(self, values: np.ndarray) -> np.ndarray:
        prints, at = self._places(values)
        first = (self.slots[at] == prints[:, None]).any(axis=1)
        return first | (self.slots[self._other(prints, at)] == prints[:, None]).any(axis=1)

    def _widen(self) -> None:
        self.slots = np.hstack([self.slots, np.zeros((len(self.slots), SLOTS), np.uint16)])

    def _settle(self, prints: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Put fingerprints into free slots of their buckets; which of them found no room."""
        by = np.argsort(at, kind="stable")
        ordered = at[by]
        rank = np.arange(len(by)) - np.searchsorted(ordered, ordered)
        place = self.filled[ordered] + rank
        fits = place < self.slots.shape[1]
        self.slots[ordered[fits], place[fits]] = prints[by[fits]]
        np.add.at(self.filled, ordered[fits], 1)
        return np.sort(by[~fits])

    def add(self, values: np.ndarray) -> None:
        """One more fingerprint for each value; equal values get one each."""
        prints, at = self._places(values)
        while int(self.filled.sum()) + len(prints) > LOAD * self.slots.size:
            self._widen()
        random = np.random.default_rng(len(prints))
        for turn in range(1, 1 << 30):
            for _ in range(2):  # either bucket
                left = self._settle(prints, at)
                prints, at = prints[left], at[left]
                if not len(prints):
                    return
                at = self._other(prints, at)
            if turn % ROUNDS == 0:
                self._widen()
                continue
            # One of those who wait at a full bucket takes the slot of another, which goes on to its other bucket.
            bucket, who = np.unique(at, return_index=True)
            victim = random.integers(0, self.slots.shape[1], len(who))
            out = self.slots[bucket, victim]
            self.slots[bucket, victim] = prints[who]
            prints[who], at[who] = out, self._other(out, bucket)

    def remove(self, values: np.ndarray) -> None:
        """Take away one fingerprint of each value, which must be there."""
        prints, at = self._places(values)
        while len(prints):
            _, who = np.unique(np.minimum(at, self._other(prints, at)), return_index=True)  # one of a pair of buckets at a time
            print_, here = prints[who], at[who]
            there = self._other(print_, here)
            here = np.where((self.slots[here] == print_[:, None]).any(axis=1), here, there)
            hit = self.slots[here] == print_[:, None]
            if not hit.any(axis=1).all():
                raise ValueError("a value to remove is not in the filter")
            # Two pairs can share a bucket: those that come second wait for the next turn.
            _, alone = np.unique(here, return_index=True)
            here, slot = here[alone], hit[alone].argmax(axis=1)
            last = self.filled[here] - 1
            self.slots[here, slot] = self.slots[here, last]
            self.slots[here, last] = 0
            self.filled[here] = last
            gone = who[alone]
            prints, at = np.delete(prints, gone), np.delete(at, gone)


def line_keys(text: str | None) -> list[bytes | None]:
    """Per line of a text the hash of its key, None where the key is too short to count."""
    keys = [line.strip(BLANK) for line in (text or "").split("\n")]
    return [xxhash.xxh3_128_digest(key.encode("utf-8").lower()) if len(key) >= LEAST else None for key in keys]


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), ">i8").reshape(-1, 2).astype(np.int64)


def holdings(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``high``, ``low``: one row per row with an id and distinct key of its lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in rows_by_bytes(batch, "text", GROUP_BYTES):
                held = [{key for key in line_keys(text) if key} for text in group.column("text").to_pylist()]
                rows = np.repeat(np.arange(len(held)), [len(keys) for keys in held])
                halves = _halves([key for keys in held for key in keys])
                yield pa.RecordBatch.from_arrays(
                    [group.column("doc_id").take(pa.array(rows)), pa.array(halves[:, 0]), pa.array(halves[:, 1])], names=["doc_id", "high", "low"]
                )

    rows = docs.filter("doc_id is not null").select("doc_id", "text")
    return rows.mapInArrow(run, schema_of(rows.drop("text"), high="bigint", low="bigint"))


KEY = ["high", "low"]
FILTERS = "shard int, buckets bigint, slots binary"
PROBED = "high bigint, low bigint, refs bigint, first {id}, maybe boolean, " + FILTERS


def _filter_of(rows: pa.Table, keys: int, bits: int) -> CuckooFilter:
    return CuckooFilter.read(rows["buckets"][0].as_py(), rows["slots"][0].as_py(), bits) if rows.num_rows else CuckooFilter.sized(keys, bits)


def _low(rows: pa.Table) -> np.ndarray:
    return rows["low"].combine_chunks().to_numpy(zero_copy_only=False) if rows.num_rows else np.zeros(0, np.int64)


def _probe(bits: int):
    """The keys with the filter's answer, and one row with the filter after the new ones were added."""

    def run(key: tuple, keys: pa.Table, filters: pa.Table) -> pa.Table:
        own, low = _filter_of(filters, keys.num_rows, bits), _low(keys)
        maybe = own.contains(low)
        own.add(low[~maybe])
        n = len(low)
        columns = {name: pa.concat_arrays([*keys[name].chunks, pa.nulls(1, keys[name].type)]) for name in (*KEY, "refs", "first")}
        columns |= {
            "maybe": pa.array([*maybe.tolist(), None], pa.bool_()),
            "shard": pa.array([key[0].as_py()] * (n + 1), pa.int32()),
            "buckets": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array([len(own.slots)])]),
            "slots": pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array([own.slots.tobytes()], pa.binary())]),
        }
        return pa.table(columns)

    return run


def _adjust(bits: int, removing: bool):
    def run(key: tuple, keys: pa.Table, filters: pa.Table) -> pa.Table:
        own = _filter_of(filters, keys.num_rows, bits)
        (own.remove if removing else own.add)(_low(keys))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "buckets": pa.array([len(own.slots)]), "slots": pa.array([own.slots.tobytes()], pa.binary())})

    return run


class LineIndex:
    """An index of lines in a folder, as of one generation. ``insert`` and ``delete`` return the next one."""

    def __init__(self, spark: SparkSession, folder: str, shards: int, log: list[tuple[int, str, str]], id_type: str, print_bits: int):
        self.spark, self.folder, self.shards, self.log, self.id_type = spark, folder.rstrip("/"), shards, log, id_type
        self.print_bits = print_bits

    @classmethod
    def create(cls, spark: SparkSession, folder: str | None = None, keys: int = 0, id_type: str = "bigint", print_bits: int = PRINT_BITS) -> LineIndex:
        """A new index, laid out for about so many distinct keys; more only make its shards larger."""
        folder = folder or f"{shared_dir(spark)}/lines-{uuid.uuid4().hex}"
        return cls(spark, folder, max(LEAST_SHARDS, -(-keys // SHARD_KEYS)), [], id_type, print_bits)

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> LineIndex:
        """The index in ``folder`` as of its last whole generation."""
        heads = spark.read.parquet(f"{folder.rstrip('/')}/heads").orderBy("generation").collect()  # one row a load
        return cls(spark, folder, heads[-1].shards, [(r.generation, r.kind, r.path) for r in heads], heads[-1].id_type, heads[-1].print_bits)

    # -- tables ----------------------------------------------------------------------------------

    def _schema(self, name: str) -> str:
        return {
            "holdings": f"doc_id {self.id_type}, high bigint, low bigint",
            "removed": f"doc_id {self.id_type}",
            "counts": f"high bigint, low bigint, refs bigint, first {self.id_type}, fresh boolean",
            "filters": FILTERS,
        }[name]

    def _read(self, path: str, name: str) -> DataFrame:
        return self.spark.read.schema(self._schema(name)).parquet(f"{path}/{name}")

    def _logged(self, name: str, *kinds: str) -> DataFrame:
        """A table of all generations of some kinds, with their number as ``generation``."""
        parts = [self._read(path, name).withColumn("generation", F.lit(g)) for g, kind, path in self.log if kind in kinds]
        empty = self.spark.createDataFrame([], f"{self._schema(name)}, generation int")
        return reduce(DataFrame.unionByName, parts) if parts else empty

    def _filters(self) -> DataFrame:
        return self._read(self.log[-1][2], "filters") if self.log else self.spark.createDataFrame([], FILTERS)

    def _begin(self) -> tuple[int, str]:
        generation = self.log[-1][0] + 1 if self.log else 1
        return generation, f"{self.folder}/generation-{generation}-{uuid.uuid4().hex}"

    def _commit(self, generation: int, kind: str, path: str) -> LineIndex:
        """The row in ``heads`` makes a generation part of the index, after all its tables are written."""
        head = self.spark.range(1).select(
            F.lit(generation).alias("generation"), F.lit(kind).alias("kind"), F.lit(path).alias("path"), F.lit(self.shards).alias("shards"), F.lit(self.id_type).alias("id_type"), F.lit(self.print_bits).alias("print_bits")
        )
        head.coalesce(1).write.mode("append").parquet(f"{self.folder}/heads")
        return LineIndex(self.spark, self.folder, self.shards, [*self.log, (generation, kind, path)], self.id_type, self.print_bits)

    def _sharded(self, keys: DataFrame) -> DataFrame:
        return keys.withColumn("shard", F.pmod("high", F.lit(self.shards)).cast("int"))

    def _adjusted(self, filters: DataFrame, keys: DataFrame, removing: bool) -> DataFrame:
        grouped = self._sharded(keys.select(*KEY)).groupBy("shard").cogroup(filters.groupBy("shard"))
        return grouped.applyInArrow(_adjust(self.print_bits, removing), FILTERS)

    def live_holdings(self) -> DataFrame:
        """``doc_id``, ``high``, ``low`` of the documents that are in the index."""
        held = self._logged("holdings", "insert")
        if all(kind == "insert" for _, kind, _ in self.log):
            return held.drop("generation")
        removed = self._logged("removed", "delete").groupBy(F.col("doc_id").alias("gone")).agg(F.max("generation").alias("until"))
        return held.join(removed, (F.col("doc_id") == F.col("gone")) & (F.col("generation") < F.col("until")), "left_anti").drop("generation")

    def _states(self, rows: DataFrame) -> DataFrame:
        """The newest count of every key among rows of the log."""
        newest = rows.groupBy(*KEY).agg(F.max(F.struct("generation", "refs", "first")).alias("state"))
        return newest.select(*KEY, F.col("state.refs").alias("refs"), F.col("state.first").alias("first"))

    def counts(self) -> DataFrame:
        """``high``, ``low``, ``refs``, ``first`` of every key that is held."""
        return self._states(self._logged("counts", "insert", "delete")).filter("refs > 0")

    def repeated(self) -> DataFrame:
        """The keys with several references: only those were ever counted above one when new, or looked up again."""
        return self._states(self._logged("counts", "insert", "delete").filter("refs > 1 or not fresh")).filter("refs > 1")

    # -- loads -----------------------------------------------------------------------------------

    def insert(self, docs: DataFrame) -> LineIndex:
        return self.insert_holdings(holdings(docs))

    def insert_holdings(self, held: DataFrame) -> LineIndex:
        """The index with more documents. Their ids must not be in it already."""
        generation, path = self._begin()
        held.select(F.col("doc_id").cast(self.id_type), *KEY).write.parquet(f"{path}/holdings")
        batch = self._read(path, "holdings").groupBy(*KEY).agg(F.count(F.lit(1)).alias("refs"), F.min("doc_id").alias("first"))
        grouped = self._sharded(batch).groupBy("shard").cogroup(self._filters().groupBy("shard"))
        probed = stage(grouped.applyInArrow(_probe(self.print_bits), PROBED.format(id=self.id_type)), "probed")
        filters, keys = probed.filter("slots is not null").select("shard", "buckets", "slots"), probed.filter("slots is null")
        maybe = keys.filter("maybe").select(*KEY, "refs", "first")
        log = self._logged("counts", "insert", "delete")
        known = self._states(log.join(maybe.select(*KEY), KEY, "left_semi")).select(*KEY, F.col("refs").alias("old_refs"), F.col("first").alias("old_first"))
        looked_up = stage(maybe.join(known, KEY, "left").withColumn("held", F.coalesce(F.col("old_refs") > 0, F.lit(False))), "looked_up")
        total = looked_up.select(
            *KEY,
            (F.col("refs") + F.when(F.col("held"), F.col("old_refs")).otherwise(0)).alias("refs"),
            F.when(F.col("held"), F.least("first", "old_first")).otherwise(F.col("first")).alias("first"),
            F.lit(False).alias("fresh"),
        )
        fresh = keys.filter("not maybe").select(*KEY, "refs", "first", F.lit(True).alias("fresh"))
        fresh.unionByName(total).write.parquet(f"{path}/counts")
        mistaken = looked_up.filter("not held")
        if not mistaken.isEmpty():
            filters = self._adjusted(filters, mistaken, removing=False)
        filters.write.parquet(f"{path}/filters")
        return self._commit(generation, "insert", path)

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents of the column ``doc_id`` of ``ids``."""
        generation, path = self._begin()
        ids.filter("doc_id is not null").select(F.col("doc_id").cast(self.id_type)).distinct().write.parquet(f"{path}/removed")
        gone = self._read(path, "removed")
        live = self.live_holdings()
        affected = stage(live.join(gone, "doc_id", "left_semi").select(*KEY).distinct(), "affected")
        left = live.join(gone, "doc_id", "left_anti").join(affected, KEY, "left_semi").groupBy(*KEY).agg(F.count(F.lit(1)).alias("refs"), F.min("doc_id").alias("first"))
        recounted = affected.join(left, KEY, "left").select(*KEY, F.coalesce("refs", F.lit(0)).cast("bigint").alias("refs"), "first", F.lit(False).alias("fresh"))
        recounted.write.parquet(f"{path}/counts")
        lost = self._read(path, "counts").filter("refs = 0")
        self._adjusted(self._filters(), lost, removing=True).write.parquet(f"{path}/filters")
        return self._commit(generation, "delete", path)

    # -- verdict ---------------------------------------------------------------------------------

    def dropped(self) -> DataFrame:
        """``doc_id`` and ``keys``, the array of the keys whose lines it loses; documents that lose none are left out."""
        verdict = self.live_holdings().join(stage(self.repeated(), "repeated"), KEY).filter("doc_id > first")
        lost = stage(verdict.select("doc_id", *KEY), "lost_lines")
        return lost.groupBy("doc_id").agg(F.collect_set(F.struct(*KEY)).alias("lost_keys"))

    def strip(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs`` with the lines they keep as ``text``, and ``n_lines`` and ``n_dropped``."""
        names = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
        lost = stage(self.dropped().withColumnRenamed("doc_id", "lost_id"), "dropped")
        rows = docs.select(*names, "text").join(lost, F.col("doc_id") == F.col("lost_id"), "left").select(*names, "text", "lost_keys")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for group in rows_by_bytes(batch, "text", GROUP_BYTES):
                    kept, lines, gone = [], [], []
                    for text, keys in zip(group.column("text").to_pylist(), group.column("lost_keys").to_pylist()):
                        text = text or ""
                        lines.append(text.count("\n") + 1)
                        if keys:
                            away = {k["high"].to_bytes(8, "big", signed=True) + k["low"].to_bytes(8, "big", signed=True) for k in keys}
                            stay = [line for line, key in zip(text.split("\n"), line_keys(text)) if key not in away]
                            gone.append(lines[-1] - len(stay))
                            text = "\n".join(stay)
                        else:
                            gone.append(0)
                        kept.append(text)
                    yield with_arrays(group, names, text=pa.array(kept, pa.string()), n_lines=pa.array(lines, pa.int64()), n_dropped=pa.array(gone, pa.int64()))

        return rows.mapInArrow(run, schema_of(docs.select(*names), text="string", n_lines="bigint", n_dropped="bigint"))


def dedup_lines(docs: DataFrame, loads: int = LOADS, folder: str | None = None) -> DataFrame:
    """``docs`` without the lines that a smaller ``doc_id`` holds, through an index that takes them in ``loads`` parts."""
    held = stage(holdings(docs), "holdings")
    index = LineIndex.create(docs.sparkSession, folder, held.count(), held.schema["doc_id"].dataType.simpleString())
    for part in range(loads):
        index = index.insert_holdings(held.filter(F.pmod(F.xxhash64("doc_id"), F.lit(loads)) == part))
    return index.strip(docs)


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLE = f"""
    WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    l AS (SELECT doc_id, i, ls[i] AS line,
                 translate(trim(ls[i], {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
          FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
    held AS (SELECT k, min(doc_id) AS first FROM l WHERE length(k) >= {LEAST} GROUP BY k HAVING count(DISTINCT doc_id) > 1),
    judged AS (SELECT l.*, coalesce(l.doc_id > held.first, false) AS gone FROM l LEFT JOIN held ON l.k = held.k)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY doc_id"""
