"""Benchmark decontamination with suffix arrays of the training texts.

The documents are read in shards of bounded size. A shard's words become numbers: the place of the word
among the words of the benchmark, or 0 for any other, where every match ends. The suffix array holds the
positions of the shard that start enough benchmark words in a row to contain a window, sorted by what
follows, as far as the longest item reaches. Every suffix of every benchmark item is then binary-searched,
word by word: the interval of the array that agrees with it gives all places of its first window, and
the last interval that is not empty its longest verbatim match in the shard.

The benchmark is the query set. It reaches the tasks in blocks of ``BLOCK_BYTES``, each broadcast by itself,
and each shard is searched for one block after the other, so neither side has to fit as a whole.

Defined results: null and empty texts have no words and no hits, and null or empty items no windows; a null
item_id counts as an empty text; rows that repeat an item_id are one item; repeated documents and null
ids are rows like others; empty tables give no rows or no hits; other columns are ignored, and kept by
``remove_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.llm.common import rows_by_bytes, schema_of, table, with_arrays
from anaquel.llm.words import ALNUM, find_words, utf8, word_hashes

WINDOW = 10
SHARD_BYTES = 2 << 20
BLOCK_BYTES = 8 << 20


class Queries:
    """The suffixes of a block of benchmark items over the numbers of their words."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        data, rows = utf8(pa.array(texts, pa.large_string()))
        begin, end, first = find_words(data, rows, ALNUM)
        self.vocabulary, numbers = np.unique(word_hashes(data, begin, end), return_inverse=True)
        self.words = numbers.astype(np.int64) + 1
        self.ids = ids
        counts = np.diff(first)
        item = np.repeat(np.arange(len(ids)), counts)
        stop = first[1:][item]
        at = np.arange(len(self.words))
        # The words a match must have: a window, or the whole of a shorter item.
        need = np.minimum(window, counts)[item]
        whole = stop - at >= need
        self.at, self.stop, self.need, self.item = at[whole], stop[whole], need[whole], item[whole]
        self.shortest = int(self.need.min()) if len(self.need) else 0
        self.longest = int(counts.max()) if len(counts) else 0
        self.bits = max(1, int(len(self.vocabulary)).bit_length())

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Place from 1 of each word among the benchmark's, or 0."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[place] == hashes, place + 1, 0)


def suffix_array(words: np.ndarray, starts: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """``starts`` in the order of the words that follow, compared up to ``depth`` words.

    Several words are packed in one number; only starts that are still tied are sorted further.
    ``words`` ends with zeros enough for any look-ahead.
    """
    order, pack = starts.copy(), max(1, 62 // bits)
    active, group = np.arange(len(order)), np.zeros(len(order), np.int64)
    for offset in range(0, depth, pack):
        if not len(active):
            break
        at = np.minimum(order[active] + offset, len(words) - pack)
        key = np.zeros(len(active), np.int64)
        for k in range(pack):
            key = key << bits | words[at + k]
        by = np.lexsort((key, group))
        order[active] = order[active][by]
        key = key[by]
        new = np.ones(len(active), bool)
        new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        group = np.flatnonzero(new)[np.cumsum(new) - 1]
        tied = np.bincount(group, minlength=len(group))[group] > 1
        active, group = active[tied], active[group[tied]]
    return order


def _first_at_least(words: np.ndarray, order: np.ndarray, offset: int, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Per query the first place in [low, high) of ``order`` whose word at ``offset`` is at least ``value``."""
    low, high = low.copy(), high.copy()
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) // 2
        less = words[order[middle] + offset] < value[open_]
        low[open_[less]] = middle[less] + 1
        high[open_[~less]] = middle[~less]
    return low


def search(queries: Queries, words: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, ...]:
    """For every suffix of the benchmark: the interval of its first window, and of its longest match with its length."""
    count = len(queries.at)
    low, high = np.zeros(count, np.int64), np.full(count, len(order))
    hit_low, hit_high, length = np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros(count, np.int64)
    alive = np.arange(count if len(order) else 0)
    for offset in range(queries.longest):
        alive = alive[queries.at[alive] + offset < queries.stop[alive]]
        if not len(alive):
            break
        value = queries.words[queries.at[alive] + offset]
        left = _first_at_least(words, order, offset, low[alive], high[alive], value)
        right = _first_at_least(words, order, offset, left, high[alive], value + 1)
        alive, left, right = alive[left < right], left[left < right], right[left < right]
        low[alive], high[alive], length[alive] = left, right, offset + 1
        full = alive[queries.need[alive] == offset + 1]
        hit_low[full], hit_high[full] = low[full], high[full]
    return hit_low, hit_high, low, high, length


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every place of the intervals, and which interval it is of."""
    size = high - low
    owner = np.repeat(np.arange(len(low)), size)
    return np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + low[owner], owner


def examine(texts: pa.Array, blocks: list, load=lambda block: block) -> tuple[np.ndarray, np.ndarray, list[set[str]], np.ndarray, np.ndarray]:
    """Per text: words, hit words, items found, longest match in words and the word it starts at."""
    data, rows = utf8(texts)
    begin, end, first = find_words(data, rows, ALNUM)
    hashes = word_hashes(data, begin, end)
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    hits = np.zeros(len(hashes) + 1, np.int64)
    items: list[set[str]] = [set() for _ in counts]
    longest, where = np.zeros(len(counts), np.int64), np.full(len(counts), -1)
    for block in blocks:
        queries = load(block)
        if not len(queries.at):
            continue
        # One 0 after each text, so that no match spans two, and some at the end to look ahead.
        words = np.zeros(len(hashes) + len(counts) + queries.longest + 64, np.int64)
        place = np.arange(len(hashes)) + text
        words[place] = queries.number(hashes)
        known = words > 0
        ends = np.flatnonzero(~known)
        run = ends[np.searchsorted(ends, place)] - place  # benchmark words in a row from here
        fits = np.flatnonzero(run >= queries.shortest)
        order = suffix_array(words, place[fits], queries.longest, queries.bits)
        word_of = np.zeros(len(words), np.int64)
        word_of[place] = np.arange(len(hashes))
        hit_low, hit_high, low, high, length = search(queries, words, order)
        found = np.flatnonzero(hit_high > hit_low)
        if not len(found):
            continue
        spans = np.unique(np.stack([hit_low[found], hit_high[found], queries.need[found]]), axis=1)
        at, owner = _spread(spans[0], spans[1])
        covered = np.zeros(len(hashes) + 1, np.int64)
        start = word_of[order[at]]
        np.add.at(covered, start, 1)
        np.add.at(covered, start + spans[2][owner], -1)
        hits[: len(hashes)] |= np.cumsum(covered)[:-1] > 0
        at, owner = _spread(hit_low[found], hit_high[found])
        pairs = np.unique(text[word_of[order[at]]] * len(queries.ids) + queries.item[found][owner])
        for pair in pairs.tolist():
            items[pair // len(queries.ids)].add(queries.ids[pair % len(queries.ids)])
        at, owner = _spread(low[found], high[found])
        start, size = word_of[order[at]], length[found][owner]
        by = np.argsort(size, kind="stable")
        better = size[by] > longest[text[start[by]]]
        best = by[better]
        longest[text[start[best]]], where[text[start[best]]] = size[best], start[best] - first[text[start[best]]]
    sums = np.concatenate([[0], np.cumsum(hits[: len(hashes)])])
    return counts, sums[first[1:]] - sums[first[:-1]], items, longest, where


def _blocks(benchmark: DataFrame, block_bytes: int, window: int) -> list:
    """Broadcasts of the benchmark, each of about ``block_bytes`` of text."""
    context, out, ids, texts, size = benchmark.sparkSession.sparkContext, [], [], [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").filter("text != ''")
    for row in rows.toLocalIterator():  # one partition of the query set at a time
        ids.append(row.item_id)
        texts.append(row.text)
        size += len(row.text)
        if size >= block_bytes:
            out.append(context.broadcast(Queries(ids, texts, window)))
            ids, texts, size = [], [], 0
    if ids:
        out.append(context.broadcast(Queries(ids, texts, window)))
    return out


def _loader(blocks: list):
    """Reads one block; of several, only the last read stays in memory."""

    def load(block):
        for other in blocks:
            if other is not block and len(blocks) > 1:
                other.__dict__.pop("_value", None)
        return block.value

    return load


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_hit``, ``items`` (sorted), ``longest`` and ``longest_at`` (in words)."""
    blocks = _blocks(benchmark, block_bytes, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in rows_by_bytes(batch, "text", SHARD_BYTES):
                counts, hit, items, longest, where = examine(shard.column("text"), blocks, _loader(blocks))
                yield with_arrays(
                    shard,
                    ["doc_id"],
                    n_words=pa.array(counts, pa.int64()),
                    n_hit=pa.array(hit, pa.int64()),
                    items=pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                    longest=pa.array(longest, pa.int64()),
                    longest_at=pa.array(where, pa.int64()),
                )

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(
        run, schema_of(rows.drop("text"), n_words="bigint", n_hit="bigint", items="array<string>", longest="bigint", longest_at="bigint")
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns."""
    blocks = _blocks(benchmark, block_bytes, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in rows_by_bytes(batch, "text", SHARD_BYTES):
                _, hit, *_ = examine(shard.column("text"), blocks, _loader(blocks))
                yield shard.filter(pa.array(hit == 0))

    return docs.mapInArrow(run, docs.schema)


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
ORACLE = f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
    i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS ws FROM benchmark),
    sized AS (SELECT item, ws, least({WINDOW}, len(ws)) AS k FROM i WHERE len(ws) > 0),
    windows AS (SELECT DISTINCT item, k, array_to_string(ws[s:s + k - 1], ' ') AS w
                FROM (SELECT *, unnest(range(1, len(ws) - k + 2)) AS s FROM sized)),
    places AS (SELECT doc_id, k, s, array_to_string(ws[s:s + k - 1], ' ') AS w
               FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM windows))),
    found AS (SELECT doc_id, k, s, item FROM places JOIN windows USING (k, w)),
    hits AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(s, s + k)) AS pos FROM found) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
              FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
    SELECT d.doc_id, len(ws) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN hits h ON h.doc_id = d.doc_id LEFT JOIN items t ON t.doc_id = d.doc_id"""
