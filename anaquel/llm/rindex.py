"""Suffix-array dedup with a run-length index.

Removed is every byte that lies in a 100-byte string which also starts earlier: in a document with a smaller
id, or earlier in the same one. The work of one query over the whole corpus is divided by anchors.

* The anchor of a 100-byte string is the 24 bytes of it with the smallest hash (the first such). Equal strings
  have equal anchors, so only strings with the same anchor need to meet. Consecutive strings of a text
  that share an anchor form a segment; only anchors that occur again anywhere go on.
* Equal segments are grouped to the first of them; in the others, every byte is covered.
* Segments that differ but share an anchor meet in a bucket of bounded size. There they are indexed: a
  Burrows-Wheeler transform, kept as runs, with samples where runs begin. Between two samples, the place and the
  length of a position's match with its neighbour in suffix order change by one from symbol to symbol,
  so matching statistics of all positions are streamed from the samples alone. Matches of 100 bytes link a
  position to its neighbour; followed to the end, links join all equal strings, and all but the first
  of them are marked.
* An anchor with more than ``MAX_SEGMENTS`` different segments is not indexed: its strings are grouped one by
  one by their hash to the first, which is exact too and needs no task to hold them.

Documents are ordered by id, those without first; rows that repeat an id with another text are ordered by a
hash of both. Rows equal in id and text are the same document and get the same result.

Defined results: null and empty texts stay as they are; an empty table gives no rows; other columns are
ignored, and kept by ``remove_repeats``. Very long texts are read in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.llm.common import rows_by_bytes, schema_of, table, with_arrays
from anaquel.llm.words import _BASE, _CODES_EXACT, mix, power_of, times_powers, utf8
from anaquel.sources.staging import stage, staging_area

LENGTH, GRAM = 100, 24
PIECE = 1 << 20
BUCKET_BYTES, MAX_SEGMENTS = 2 << 20, 20_000
_LOW = np.uint64((1 << 24) - 1)


class Hashes:
    """Hashes of any stretch of some bytes, from prefix sums."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(times_powers(_CODES_EXACT[data]), out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * power_of(start, len(self.sums)) + (stop - start).astype(np.uint64))


def segments(data: np.ndarray, rows: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Row, start, stop, anchor hash and own hash of every segment of the rows of bytes."""
    empty = np.zeros(0, np.int64)
    count = len(data) - length + 1
    if count <= 0:
        return empty, empty, empty, empty, empty
    hashes = Hashes(data)
    at = np.arange(len(data) - gram + 1)
    grams = hashes.of(at, at + gram)
    # The hash above the place: the smallest is the first of the smallest hashes.
    least = (grams & ~_LOW) | at.astype(np.uint64)
    width, wide = 1, length - gram + 1
    while 2 * width <= wide:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (wide - width)], least[wide - width :])[:count]
    anchor = (least & _LOW).astype(np.int64)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))[:count]
    start = np.flatnonzero(np.arange(count) + length <= rows[1:][row])
    if not len(start):
        return empty, empty, empty, empty, empty
    opens = np.ones(len(start), bool)
    opens[1:] = (anchor[start[1:]] != anchor[start[:-1]]) | (row[start[1:]] != row[start[:-1]])
    first = start[opens]
    last = start[np.concatenate([np.flatnonzero(opens)[1:] - 1, [len(start) - 1]])]
    owner = row[first]
    return owner, first - rows[owner], last + length - rows[owner], grams[anchor[first]].view(np.int64), hashes.of(first, last + length).view(np.int64)


def merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals sorted by start, as disjoint ones; touching ones are one."""
    if not len(start):
        return start, stop
    reach = np.maximum.accumulate(stop)
    opens = np.ones(len(start), bool)
    opens[1:] = start[1:] > reach[:-1]
    return start[opens], reach[np.concatenate([np.flatnonzero(opens)[1:] - 1, [len(start) - 1]])]


class RunIndex:
    """Run-compressed transform of some segments, with samples at the beginnings of runs.

    ``heads`` and ``lengths`` are the runs. For the sampled positions, ``neighbour`` is the position before
    them in suffix order and ``match`` how far the two agree, not beyond a segment's end.
    """

    def __init__(self, pieces: list[bytes]):
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        text = np.frombuffer(b"\xff".join([*pieces, b""]), np.uint8)  # no UTF-8 text has this byte
        self.size = len(text)
        ends = np.cumsum(sizes + 1) - 1
        segment = np.repeat(np.arange(len(pieces)), sizes + 1)
        self.left = ends[segment] - np.arange(self.size)  # bytes to the segment's end
        rank = self._suffix_ranks(text, segment)
        order = np.empty(self.size, np.int64)
        order[rank] = np.arange(self.size)
        before = np.where(order > 0, text[order - 1], 0xFF)
        run = np.ones(self.size, bool)  # ends of segments are all different symbols
        run[1:] = (before[1:] != before[:-1]) | (before[1:] == 0xFF)
        at = np.flatnonzero(run)
        self.heads, self.lengths = before[at], np.diff(np.append(at, self.size))
        sampled = np.sort(order[at])  # the first position is one: it follows no symbol
        place = rank[sampled]
        self.sampled, self.neighbour = sampled, np.where(place > 0, order[place - 1], sampled)
        self.match = np.where(place > 0, self._agree(text, sampled, self.neighbour), 0)

    def _suffix_ranks(self, text: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Place of every suffix, compared to the end of its segment and then by the segment's number."""
        pack = 7
        padded = np.concatenate([text, np.full(pack, 0xFF, np.uint8)])
        key = np.zeros(self.size, np.int64)
        for k in range(pack):
            key = key << 9 | np.where(k < self.left, padded[k : k + self.size].astype(np.int64) + 1, 0)
        tie = np.where(self.left < pack, segment + 1, 0)
        by = np.lexsort((tie, key))
        new = np.ones(self.size, bool)
        new[1:] = (key[by[1:]] != key[by[:-1]]) | (tie[by[1:]] != tie[by[:-1]])
        rank = np.empty(self.size, np.int64)
        rank[by] = np.flatnonzero(new)[np.cumsum(new) - 1]
        depth = pack
        active = np.flatnonzero(np.bincount(rank, minlength=self.size)[rank] > 1)
        while len(active):
            both = rank[active] * self.size + rank[active + depth]
            by = np.argsort(both, kind="stable")
            active, both = active[by], both[by]
            group = both // self.size
            opens = np.ones(len(active), bool)
            opens[1:] = group[1:] != group[:-1]
            first = np.flatnonzero(opens)[np.cumsum(opens) - 1]
            new = np.ones(len(active), bool)
            new[1:] = both[1:] != both[:-1]
            inside = np.flatnonzero(new)[np.cumsum(new) - 1]
            rank[active] = group + inside - first
            tied = np.bincount(inside, minlength=len(inside))[inside] > 1
            active = active[tied]
            depth *= 2
        return rank

    def _agree(self, text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes in which two positions agree, up to the end of either segment."""
        most = np.minimum(self.left[a], self.left[b])
        same, open_ = np.zeros(len(a), np.int64), np.arange(len(a))
        wide = np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.zeros(16, np.uint8)]), 8)
        for step in (8, 1):
            open_ = np.flatnonzero(same < most)
            while len(open_):
                i, j = a[open_] + same[open_], b[open_] + same[open_]
                equal = (wide[i] == wide[j]).all(axis=1) if step == 8 else wide[i, 0] == wide[j, 0]
                open_ = open_[equal]
                same[open_] += step
                open_ = open_[same[open_] < most[open_]]
            np.minimum(same, most, out=same)
        return same

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For all positions in turn: the place and the length of the match with the neighbour, from the samples."""
        which = np.zeros(self.size, np.int64)
        which[self.sampled[1:]] = 1
        which = np.cumsum(which)
        ahead = np.arange(self.size) - self.sampled[which]
        return self.neighbour[which] + ahead, np.maximum(self.match[which] - ahead, 0)

    def repeats(self, length: int) -> np.ndarray:
        """Positions whose next ``length`` bytes, inside their segment, also start at an earlier position."""
        place, match = self.statistics()
        link = np.where((match >= length) & (self.left >= length), place, np.arange(self.size))
        while True:
            further = link[link]
            if np.array_equal(further, link):
                break
            link = further
        first = np.arange(self.size)
        np.minimum.at(first, link, np.arange(self.size))
        return np.flatnonzero((self.left >= length) & (first[link] < np.arange(self.size)))


def mark_bucket(starts: np.ndarray, pieces: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of segments in order: which one, start and stop (in its document) of each stretch that occurs earlier among them."""
    index = RunIndex(pieces)
    found = index.repeats(length)
    begin = np.cumsum([0, *(len(p) + 1 for p in pieces)])[:-1]
    which = np.searchsorted(begin, found, side="right") - 1
    start, stop = merged(found, found + length)  # segments are apart by one byte, so they don't touch
    which = np.searchsorted(begin, start, side="right") - 1
    shift = starts[which] - begin[which]
    return which, start + shift, stop + shift


def _key(doc_id: str = "doc_id", text: str = "text") -> Column:
    return F.xxhash64(F.col(doc_id), F.col(text))


def _candidates(docs: DataFrame, length: int) -> DataFrame:
    """Segments (``anchor`` not null) and stretches already known to repeat inside their document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in rows_by_bytes(batch, "text", PIECE):
                data, rows = utf8(group.column("text"))
                for low in range(0, max(len(data), 1), PIECE) if group.num_rows == 1 else (0,):
                    high = min(len(data), low + PIECE + length - 1) if group.num_rows == 1 else len(data)
                    bounds = np.array([0, high - low]) if group.num_rows == 1 else rows
                    row, start, stop, anchor, own = segments(data[low:high], bounds, length)
                    start, stop = start + low, stop + low
                    # The same segment again in the same text is a repeat already.
                    kind = mix((mix(anchor.view(np.uint64)) ^ own.view(np.uint64)) + row.astype(np.uint64) * np.uint64(_BASE))
                    _, first = np.unique(kind, return_index=True)
                    again = np.ones(len(row), bool)
                    again[first] = False
                    anchors = pa.array(anchor, mask=again)
                    yield pa.RecordBatch.from_arrays(
                        [group.column("doc_id").take(pa.array(row)), group.column("key").take(pa.array(row)), anchors, pa.array(own), pa.array(start), pa.array(stop)],
                        names=["doc_id", "key", "anchor", "own", "start", "stop"],
                    )

    rows = docs.select("doc_id", _key().alias("key"), "text")
    return rows.mapInArrow(run, schema_of(rows.drop("text"), anchor="bigint", own="bigint", start="bigint", stop="bigint"))


def _bytes_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted segments with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in rows_by_bytes(batch, "text", PIECE):
                data, rows = utf8(group.column("text"))
                lists, raw = group.column("parts"), data.tobytes()
                owner = np.repeat(np.arange(group.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                parts = lists.flatten()
                start, stop = (parts.field(f).to_numpy() + rows[owner] for f in ("start", "stop"))
                pieces = [raw[a:b] for a, b in zip(start.tolist(), stop.tolist())]
                names = ["doc_id", "key"]
                yield pa.RecordBatch.from_arrays(
                    [*[group.column(c).take(pa.array(owner)) for c in names], parts.field("anchor"), parts.field("own"), parts.field("start"), pa.array(pieces, pa.binary())],
                    names=[*names, "anchor", "own", "start", "bytes"],
                )

    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("anchor", "own", "start", "stop")).alias("parts"))
    rows = docs.select("doc_id", _key().alias("key"), "text").join(lists, "key")
    kinds = {"anchor": "bigint", "own": "bigint", "start": "bigint", "bytes": "binary"}
    return rows.mapInArrow(run, schema_of(rows.select("doc_id", "key"), **kinds)).dropDuplicates(["anchor", "own"])


def _indexed(pieces: DataFrame, buckets: int, length: int) -> DataFrame:
    """``key``, ``start``, ``stop`` of stretches that repeat, by the index of each bucket."""

    def run(bucket: pa.Table) -> pa.Table:
        bucket = bucket.sort_by([(c, "ascending") for c in ("known", "doc_id", "key", "start")])
        which, start, stop = mark_bucket(bucket.column("start").to_numpy(), bucket.column("bytes").to_pylist(), length)
        keys = bucket.column("key").to_numpy()[which]
        return pa.table({"key": pa.array(keys, pa.int64()), "start": pa.array(start, pa.int64()), "stop": pa.array(stop, pa.int64())})

    rows = pieces.select(F.pmod(F.hash("anchor"), F.lit(buckets)).alias("bucket"), F.col("doc_id").isNotNull().alias("known"), "doc_id", "key", "start", "bytes")
    return rows.groupBy("bucket").applyInArrow(run, "key bigint, start bigint, stop bigint")


def _grouped(pieces: DataFrame, length: int) -> DataFrame:
    """The same for anchors with too many segments: string by string, to the first of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 10):
                part = batch.slice(at, 1 << 10)
                raw = part.column("bytes").to_pylist()
                sizes = np.fromiter(map(len, raw), np.int64, len(raw))
                count = sizes - length + 1
                row = np.repeat(np.arange(len(raw)), count)
                inside = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                begin = (np.cumsum(sizes) - sizes)[row] + inside
                string = Hashes(np.frombuffer(b"".join(raw), np.uint8)).of(begin, begin + length).view(np.int64)
                names = ["anchor", "doc_id", "key"]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c).take(pa.array(row)) for c in names], pa.array(part.column("start").to_numpy()[row] + inside), pa.array(string)],
                    names=[*names, "start", "string"],
                )

    rows = pieces.select("anchor", "doc_id", "key", "start", "bytes")
    strings = stage(rows.mapInArrow(run, schema_of(rows.drop("bytes"), string="bigint")), "strings")
    place = F.struct("doc_id", "key", "start")
    firsts = stage(strings.groupBy("anchor", "string").agg(F.min(place).alias("first")).filter("first is not null"), "first_strings")
    return strings.join(firsts, ["anchor", "string"]).filter(place > F.col("first")).select("key", "start", (F.col("start") + length).alias("stop"))


def repeated_stretches(docs: DataFrame, length: int = LENGTH, bucket_bytes: int = BUCKET_BYTES, max_segments: int = MAX_SEGMENTS) -> DataFrame:
    """``key`` (hash of id and text) and ``spans``, the stretches of bytes to remove, of documents that have any."""
    found = stage(_candidates(docs, length), "segments")
    inside = found.filter("anchor is null").select("key", "start", "stop")
    anchored = found.filter("anchor is not null")
    again = stage(anchored.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "anchors")
    met = stage(anchored.join(again, "anchor"), "met_segments")
    place = F.struct("doc_id", "key", "start")
    # One row per different segment, the first of its kind.
    kinds = stage(met.groupBy("anchor", "own").agg(F.min(F.struct("doc_id", "key", "start", "stop")).alias("f")).select("anchor", "own", "f.*"), "kinds")
    firsts = kinds.select("anchor", "own", place.alias("first"))
    copies = met.join(firsts, ["anchor", "own"]).filter(place > F.col("first")).select("key", "start", "stop")
    counts = stage(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "kind_counts")
    pieces = stage(_bytes_of(docs, kinds.join(counts, "anchor").select("anchor", "own", "key", "start", "stop")), "pieces").join(counts, "anchor")
    few, many = pieces.filter(F.col("n") <= max_segments), pieces.filter(F.col("n") > max_segments)
    size = few.agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0))).first()[0]
    buckets = max(1, -(-size // bucket_bytes))
    marks = inside.unionByName(copies).unionByName(_indexed(few, buckets, length)).unionByName(_grouped(many, length))
    return marks.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def _cut(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """The columns ``doc_id``, ``text`` and any others of ``rows`` with ``kept`` (bytes), ``left`` (text), ``n_removed`` and ``n_spans``."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in rows_by_bytes(batch, "text", PIECE):
                data, bounds = utf8(group.column("text"))
                raw, kept, removed, counts = data.tobytes(), [], [], []
                for low, high, own in zip(bounds[:-1].tolist(), bounds[1:].tolist(), group.column("spans")):
                    parts, at, n = [], low, 0
                    if own.is_valid:
                        start, stop = (own.values.field(f).to_numpy() + low for f in ("start", "stop"))
                        for a, b in zip(*(x.tolist() for x in merged(start, stop))):
                            parts.append(raw[at:a])
                            at, n = b, n + 1
                    parts.append(raw[at:high])
                    kept.append(b"".join(parts))
                    removed.append(high - low - len(kept[-1]))
                    counts.append(n)
                yield with_arrays(
                    group,
                    names,
                    kept=pa.array(kept, pa.binary()),
                    left=pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()),
                    n_removed=pa.array(removed, pa.int64()),
                    n_spans=pa.array(counts, pa.int64()),
                )

    joined = rows.withColumn("key", _key()).join(spans, "key", "left").select(*names, "spans")
    return joined.mapInArrow(run, schema_of(rows, kept="binary", left="string", n_removed="bigint", n_spans="bigint"))


def find_repeats(docs: DataFrame, length: int = LENGTH, **limits) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the bytes that are left."""
    rows = docs.select("doc_id", "text")
    cut = _cut(rows, stage(repeated_stretches(rows, length, **limits), "stretches"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    return cut.select("doc_id", size.alias("n_bytes"), "n_removed", "n_spans", "kept")


def remove_repeats(docs: DataFrame, length: int = LENGTH, **limits) -> DataFrame:
    """``docs`` with what is left of each text, and its length in ``n_chars`` if that is a column.

    A character that a cut goes through is dropped; null texts stay null.
    """
    with staging_area(docs.sparkSession) as staged:
        spans = stage(repeated_stretches(docs.select("doc_id", "text"), length, **limits), "stretches")
        staged.pop()  # only this table is read from here on
    cut = _cut(docs.select("doc_id", "text", F.struct(*docs.columns).alias("row")), spans)
    left = F.when(F.col("text").isNull() | (F.col("n_removed") == 0), F.col("text")).otherwise(F.col("left"))
    own = {"text": left, "n_chars": F.when(F.col("n_removed") == 0, F.col("row")["n_chars"]).otherwise(F.length(left)).cast("bigint")} if "n_chars" in docs.columns else {"text": left}
    return cut.select(*[own.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = find_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
