"""Near duplicates by b-bit MinHash.

A text is the set of its distinct 5-word shingles. Equal sets are one class, numbered by its smallest
document and its key; everything after works on classes. A class has ``HASHES`` minima; rows of five of them are
the keys of 51 bands, and of each minimum the two lowest bits are kept, packed in eight 64-bit words.

Candidates share a band. They come in three rounds, none of which emits the pairs of a group:

1. every class is paired with the smallest class it shares a band with;
2. links confirmed so far give components; where different ones still meet in a bucket, the smallest class
   of each is paired with the smallest of the bucket;
3. members of different components that meet even so are compared inside the join, down to their full sets; what
   comes out of it are links. The comparisons of this round are still those of all members of different
   components in a bucket.

A candidate passes if its sizes allow the similarity and if the agreement of the packed bits, corrected for
accidental collisions (a quarter for two bits), is within five standard deviations of it. Then it is
confirmed on the full sets. Two sets at the threshold share no band with probability
(1 - 0.75^5)^51, one in a million.

Defined results: texts without words have an empty set and are linked with nothing; fewer than five words
are one shingle; rows without id are linked with nothing, have no component and are kept; rows that
repeat an id belong each to the class of its own text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.llm.common import rows_by_bytes, schema_of, table, with_arrays
from anaquel.llm.components import components
from anaquel.llm.words import NOT_SPACE, chain_hashes, find_words, mix, utf8, word_hashes
from anaquel.operators.numbering import number_rows
from anaquel.sources.staging import stage, staging_area

SHINGLE = 5
PERCENT = 75
ROWS, BANDS, HASHES = 5, 51, 256
PACKED = HASHES * 2 // 64
# Five standard deviations of the two-bit estimate at the threshold.
SLACK = 5 * (0.8125 * 0.1875 / HASHES) ** 0.5 / 0.75
GROUP_BYTES = 2 << 20
# Shingles hashed at a time: their values stay in the cache of a core.
CHUNK = 1 << 8

_RANDOM = np.random.default_rng(7)
_A = _RANDOM.integers(0, 1 << 64, HASHES, dtype=np.uint64) | np.uint64(1)
_B = _RANDOM.integers(0, 1 << 64, HASHES, dtype=np.uint64)
_ROW = _RANDOM.integers(0, 1 << 64, ROWS, dtype=np.uint64) | np.uint64(1)


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, rows = utf8(column)
    begin, end, first = find_words(data, rows, NOT_SPACE)
    words = word_hashes(data, begin, end)
    chains = chain_hashes(words, SHINGLE)
    out = []
    for start, stop in zip(first[:-1].tolist(), first[1:].tolist()):
        if stop - start >= SHINGLE:
            out.append(np.unique(chains[start : stop - SHINGLE + 1]))
        elif stop > start:
            out.append(chain_hashes(words[start:stop], stop - start) + np.uint64(stop - start))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(shingles: np.ndarray) -> bytes | None:
    """A 128-bit hash of a set, None for an empty one."""
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """``HASHES`` minima of each set, 32 bits each; the largest value for an empty one."""
    out = np.full((len(sets), HASHES), 0xFFFFFFFF, np.uint32)
    queue, size = [], 0
    for row, own in enumerate(sets):
        for at in range(0, len(own), CHUNK):
            part = own[at : at + CHUNK]
            queue.append((row, part))
            size += len(part)
            if size >= CHUNK:
                _reduce(queue, out)
                queue, size = [], 0
    if queue:
        _reduce(queue, out)
    return out


def _reduce(queue: list[tuple[int, np.ndarray]], out: np.ndarray) -> None:
    parts = [p for _, p in queue]
    starts = np.cumsum([0, *map(len, parts)])[:-1]
    values = np.concatenate(parts)[:, None] * _A
    values += _B
    # The upper half of the smallest value is the smallest upper half.
    least = (np.minimum.reduceat(values, starts, axis=0) >> np.uint64(32)).astype(np.uint32)
    for (row, _), low in zip(queue, least):
        np.minimum(out[row], low, out=out[row])


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    grouped = signature[:, : ROWS * BANDS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    return mix((mix(grouped * _ROW) * _ROW[::-1]).sum(axis=2, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _A[0]).view(np.int64)


def packed_bits(signature: np.ndarray) -> np.ndarray:
    """The two lowest bits of every minimum, 32 minima a word."""
    low = (signature & np.uint32(3)).astype(np.uint64).reshape(-1, PACKED, 32)
    return (low << (2 * np.arange(32, dtype=np.uint64))).sum(axis=2, dtype=np.uint64).view(np.int64)


def _rows_of(values: np.ndarray) -> pa.Array:
    ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_key`` (null for an empty set), ``bands`` and ``bits`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in rows_by_bytes(batch, "text", GROUP_BYTES):
                sets = shingle_sets(group.column("text"))
                low = minima(sets)
                yield with_arrays(
                    group,
                    ["doc_id"],
                    n_shingles=pa.array([len(s) for s in sets], pa.int64()),
                    set_key=pa.array([set_key(s) for s in sets], pa.binary()),
                    bands=_rows_of(band_keys(low)),
                    bits=_rows_of(packed_bits(low)),
                )

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(
        run, schema_of(rows.drop("text"), n_shingles="bigint", set_key="binary", bands="array<bigint>", bits="array<bigint>")
    )


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``name`` and ``shingles`` of the classes ``wanted`` (``name``, ``id``, ``set_key``), from the rows with their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in rows_by_bytes(batch, "text", GROUP_BYTES):
                sets = shingle_sets(group.column("text"))
                ends = np.cumsum([0, *map(len, sets)])
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_key(s) for s in sets], pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                    names=["set_key", "shingles"],
                )

    # By a shuffle at every size: the ids grow with the corpus.
    ids = wanted.select("id").distinct().hint("shuffle_merge")
    rows = docs.select(F.col("doc_id").alias("id"), "text").join(ids, "id", "left_semi").select("text")
    found = rows.mapInArrow(run, "set_key binary, shingles array<bigint>")
    return found.join(wanted.select("set_key", "name"), "set_key").dropDuplicates(["name"]).select("name", "shingles")


def estimate(bits: Column, other: Column) -> Column:
    """Similarity by the share of equal two-bit fields, less the accidental ones."""
    differ = None
    for k in range(PACKED):
        x = F.get(bits, F.lit(k)).bitwiseXOR(F.get(other, F.lit(k)))
        count = F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
        differ = count if differ is None else differ + count
    return (1 - differ / HASHES - 0.25) / 0.75


def _plausible(percent: int) -> Column:
    """Sizes and packed bits of the classes ``a`` and ``b`` allow the similarity."""
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return sizes & (estimate(F.col("bits_a"), F.col("bits_b")) >= percent / 100 - SLACK)


def _similar(percent: int) -> Column:
    """The full sets of ``a`` and ``b`` are as similar as asked."""
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return 100 * shared >= percent * (F.size("set_a") + F.size("set_b") - shared)


def _confirm(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets are as similar as asked."""
    left = sets.select(F.col("name").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("name").alias("b"), F.col("shingles").alias("set_b"))
    return stage(pairs.join(right, "b").join(left, "a").filter(_similar(percent)).select("a", "b"), "links")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row."""
    return judge(docs, percent).drop("set_key")


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of near duplicates, with all their columns.

    Of rows that repeat an id and a set one stays. A row without id goes if a row with one has its set, and
    of several such rows with a set one stays. Rows without words all stay.
    """
    with staging_area(docs.sparkSession) as staged:
        judged = stage(judge(docs, percent), "judged")
        staged.pop()  # only this table is read from here on
    by_id = stage(judged.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("n_kept")), "kept_ids")
    # By a shuffle at every size, as in full_sets: a broadcast would have to hold the ids of the corpus.
    once = by_id.filter("doc_id is not null and n = 1 and n_kept = 1").hint("shuffle_merge")
    single = docs.join(once, "doc_id", "left_semi")
    odd = by_id.filter("doc_id is null or n > 1 and n_kept > 0").select(F.col("doc_id").alias("odd_id"))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in rows_by_bytes(batch, "text", GROUP_BYTES):
                yield with_arrays(group, names, own_set=pa.array([set_key(s) for s in shingle_sets(group.column("text"))], pa.binary()))

    repeated = docs.join(odd, F.col("doc_id").eqNullSafe(F.col("odd_id")), "left_semi").mapInArrow(run, schema_of(docs, own_set="binary"))
    stays = judged.filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("set_key").alias("kept_set")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & F.col("own_set").eqNullSafe(F.col("kept_set"))
    left = stage(repeated.join(stays, same, "left_semi"), "repeated_ids")
    with_id = judged.filter("doc_id is not null and set_key is not null").select("set_key").distinct()
    worded = left.filter("own_set is not null").dropDuplicates(["doc_id", "own_set"])
    anonymous = worded.filter("doc_id is null").join(with_id, F.col("own_set") == F.col("set_key"), "left_anti")
    parts = [worded.filter("doc_id is not null"), anonymous, left.filter("own_set is null")]
    return reduce(DataFrame.unionByName, [part.select(*names) for part in parts], single.select(*names))


def judge(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``set_key``, ``n_shingles``, ``component_id`` and ``kept`` of every row."""
    signed = stage(signatures(docs), "signatures")
    # A class is named by its place in order of its smallest document, so the smallest name has the smallest document.
    sets_seen = signed.filter("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("id"))
    classes = stage(number_rows(sets_seen, ["id", "set_key"], "name"), "classes")
    members = stage(
        signed.select("doc_id", "set_key", "n_shingles", "bands", "bits")
        .join(classes, "set_key")
        .filter(F.col("id") == F.col("doc_id"))
        .dropDuplicates(["name"])
        .select("name", "n_shingles", "bands", "bits"),
        "class_signatures",
    )
    banded = members.select("name", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("name").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("band", "hub")
    meeting = stage(banded.join(stage(shared, "buckets"), "band"), "met")
    light = members.select("name", "n_shingles", "bits")
    # The full sets of all classes that share a band with another one, from one more pass over the texts.
    wanted = stage(classes.join(meeting.select("name").distinct(), "name", "left_semi"), "wanted")
    sets = stage(full_sets(docs, wanted), "shingle_sets")

    def side(of: str) -> DataFrame:
        return light.select(F.col("name").alias(of), F.col("n_shingles").alias(f"n_{of}"), F.col("bits").alias(f"bits_{of}"))

    def plausible(pairs: DataFrame, table_name: str) -> DataFrame:
        return stage(pairs.join(side("b"), "b").join(side("a"), "a").filter(_plausible(percent)).select("a", "b"), table_name)

    def still_open(links: DataFrame) -> DataFrame:
        """The classes, with labels, sizes and bits, in buckets where different components meet."""
        labels = components(links).withColumnRenamed("node", "name")
        labelled = stage(meeting.select("band", "name").join(labels, "name", "left").withColumn("label", F.coalesce("component", "name")), "labelled")
        mixed = labelled.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high").select("band")
        return stage(labelled.join(stage(mixed, "mixed"), "band").join(light, "name"), "open_rows")

    # Round 1: each class with the smallest class it shares a band with.
    nearest = meeting.filter("name != hub").groupBy(F.col("name").alias("b")).agg(F.min("hub").alias("a"))
    links = _confirm(sets, plausible(nearest, "nearest_pairs"), percent)
    # Round 2: where components still meet, the smallest class of each with the smallest of the bucket.
    smallest = F.min(F.struct("name", "n_shingles", "bits"))
    fronts = still_open(links).groupBy("band", "label").agg(smallest.alias("f"))
    fronts = stage(fronts.select("band", F.col("f.name").alias("b"), F.col("f.n_shingles").alias("n_b"), F.col("f.bits").alias("bits_b")), "fronts")
    hubs = fronts.groupBy("band").agg(F.min(F.struct("b", "n_b", "bits_b")).alias("h"))
    hubs = stage(hubs.select("band", F.col("h.b").alias("a"), F.col("h.n_b").alias("n_a"), F.col("h.bits_b").alias("bits_a")), "hubs")
    to_hub = stage(fronts.join(hubs, "band").filter((F.col("a") != F.col("b")) & _plausible(percent)).select("a", "b").distinct(), "hub_pairs")
    links = stage(links.unionByName(_confirm(sets, to_hub, percent)), "links")
    # Round 3: members of different components that meet even so, judged on their full sets inside the join, so
    # that only links come out of it.
    open_rows = stage(still_open(links).join(sets, "name"), "open_sets")

    def half(of: str) -> DataFrame:
        return open_rows.select(
            "band",
            *[F.col(c).alias(f"{short}_{of}") for c, short in (("label", "label"), ("n_shingles", "n"), ("bits", "bits"), ("shingles", "set"))],
            F.col("name").alias(of),
        )

    tested = (F.col("label_a") < F.col("label_b")) & _plausible(percent) & _similar(percent)
    across = half("a").join(half("b"), "band").filter(tested).select("a", "b").distinct()
    labels = components(links.unionByName(stage(across, "cross_links")))
    smallest_id = classes.select(F.col("name").alias("component"), F.col("id").alias("component_id"))
    linked = stage(labels.join(smallest_id, "component").select(F.col("node").alias("name"), "component_id"), "linked")
    by_key = stage(classes.join(linked, "name", "left").select("set_key", F.coalesce("component_id", "id").alias("component_id")), "class_labels")
    in_class = F.col("doc_id").isNotNull() & (F.col("set_key") == F.col("class_key"))
    judged = signed.select("doc_id", "n_shingles", "set_key").join(by_key.withColumnRenamed("set_key", "class_key"), in_class, "left")
    return judged.select(
        "doc_id",
        "set_key",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == F.coalesce("component_id", "doc_id"))).alias("kept"),
    )


def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x20\x09-\x0D]+')"
)
ORACLE = f"""
    WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(ws) >= {SHINGLE} THEN
                 list_distinct([array_to_string(ws[i:i + {SHINGLE - 1}], ' ') FOR i IN range(1, len(ws) - {SHINGLE - 2})])
                 WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS shingles FROM w),
    e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS g FROM s),
    pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) + any_value(b.n) AS n, count(*) AS c
              FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
    links AS (SELECT a, b FROM pairs WHERE 100 * c >= {PERCENT} * (n - c) UNION SELECT b, a FROM pairs WHERE 100 * c >= {PERCENT} * (n - c)),
    reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
    SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) ON a = doc_id"""
