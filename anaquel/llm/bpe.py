"""Byte-level BPE: texts to ids and ids back to bytes.

A pre-token is resolved in two tiers. First a minimal perfect hash over the vocabulary sends each of the
n known byte strings to its own slot of n, so a probe and one comparison tell whether the whole
pre-token is a token. Only a miss is merged: its bytes form a
linked list, and a heap of adjacent pairs by rank (leftmost first) merges until no known pair is left.

Every task builds the hash from the vocabulary file (its size is that of the file), keeps a bounded
memory of resolved pre-tokens (the worker's next task finds it), and streams its Arrow batches in groups of bytes, so memory does not
grow with the table. Very long texts are cut where no pre-token spans the cut.

Defined results: a null or empty text has no ids, and no ids decode to no bytes; repeated rows and null
ids are rows like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from unicodedata import category

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.llm.common import rows_by_bytes, safe_pieces, schema_of, table, tokenizer_file, with_arrays

VOCABULARY = "byte_bpe_50k.tiktoken"
GROUP_BYTES = 1 << 20
# Pre-tokens of up to so many characters are remembered: so many recent ones, and as many from before.
SHORT, MEMORY = 48, 250_000
POSITION = (1 << 40) - 1
# Below this code point all tables of letters and numbers agree.
BEYOND = regex.compile("[\u0558-\U0010ffff]").search


class PerfectHash:
    """Minimal perfect hash: n distinct keys to the slots 0 .. n-1, each used once.

    Every level has two bits a key left. Keys alone on their bit stay there, the others go on to the
    next level; the slot of a key is the number of set bits before its own.
    """

    def __init__(self, keys: list[bytes]):
        self.size = len(keys)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, before = self._hashes(keys), 0
        while len(left):
            at = self._positions(left, len(self.levels), 2 * len(left))
            bits = np.bincount(at, minlength=2 * len(left)) == 1
            self.levels.append((bits, before + np.cumsum(bits) - 1))
            before += int(bits.sum())
            left = left[~bits[at]]

    @staticmethod
    def _hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    @staticmethod
    def _positions(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
        mixed = (hashes ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
        return ((mixed >> np.uint64(32)) % np.uint64(bits)).astype(np.int64)

    def slots(self, keys: list[bytes]) -> np.ndarray:
        """The slot each key would have, or -1; whether it is there is for the caller to compare."""
        hashes, out = self._hashes(keys), np.full(len(keys), -1)
        left = np.arange(len(keys))
        for level, (bits, slots) in enumerate(self.levels):
            at = self._positions(hashes[left], level, len(bits))
            out[left[bits[at]]] = slots[at[bits[at]]]
            left = left[~bits[at]]
        return out


def _later_letters() -> str:
    """Letters and numbers that this machine's ``regex`` knows and the encoder's own tables don't, as a class body.

    Only code points without a category in Python's older tables can differ; the encoder itself, given
    single bytes as its vocabulary and the class as its pattern, says which of them it matches.
    """
    import tiktoken

    young = "".join(c for c in regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, chain(range(0x558, 0xD800), range(0xE000, 0x110000))))) if category(c) == "Cn")
    single = {bytes([i]): i for i in range(256)}
    known = tiktoken.Encoding("classes", pat_str=r"[\p{L}\p{N}]", mergeable_ranks=single, special_tokens={})
    same = set(bytes(known.encode_ordinary(young)).decode("utf-8"))
    return "".join(c for c in young if c not in same)


class Codec:
    """One vocabulary: ranks by token bytes, with its perfect hash and tables for decoding."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.ranks = ranks
        later = _later_letters()
        self.split_common = regex.compile(pattern).findall
        self.split_exact = regex.compile(
            pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{later}])")
            .replace(r"\p{L}+", rf"[^\P{{L}}{later}]+")
            .replace(r"\p{N}+", rf"[^\P{{N}}{later}]+")
        ).findall
        self.hash = PerfectHash(list(ranks))
        self.keys: list[bytes] = [b""] * len(ranks)
        self.ids = np.zeros(len(ranks), np.int32)
        for slot, (token, rank) in zip(self.hash.slots(list(ranks)).tolist(), ranks.items()):
            self.keys[slot], self.ids[slot] = token, rank
        top = max(ranks.values(), default=-1) + 1
        by_id: list[bytes] = [b""] * top
        for token, rank in ranks.items():
            by_id[rank] = token
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.lengths = np.fromiter(map(len, by_id), np.int64, top)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        # Ids (as bytes) of short pre-tokens met lately, and of those met before them.
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        return self.split_common(text) if text.isascii() or not BEYOND(text) else self.split_exact(text)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token that is not a token: merge the lowest-ranked pair, leftmost first.

        The bytes are linked: a part goes from its start to ``following``, where the next one starts.
        """
        ranks, rank_of, n = self.ranks, self.ranks.get, len(piece)
        following, before = list(range(1, n + 1)), list(range(-1, n))
        # Rank of the pair that starts at each place, -1 without one. A heap entry is the rank above the place.
        pair = [rank_of(piece[i : i + 2], -1) for i in range(n - 1)]
        pair.append(-1)
        heap = [r << 40 | i for i, r in enumerate(pair) if r >= 0]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            i = entry & POSITION
            if pair[i] != entry >> 40:
                continue  # either part has changed since
            j = following[i]
            following[i] = k = following[j]
            pair[i] = pair[j] = -1
            if k < n:
                before[k] = i
                if (r := rank_of(piece[i : following[k]], -1)) >= 0:
                    pair[i] = r
                    heapq.heappush(heap, r << 40 | i)
            if (p := before[i]) >= 0:
                pair[p] = r = rank_of(piece[p:k], -1)
                if r >= 0:
                    heapq.heappush(heap, r << 40 | p)
        out, i = [], 0
        while i < n:
            j = following[i]
            out.append(ranks[piece[i:j]])
            i = j
        return out

    def resolve(self, pieces: set[str]) -> list[str]:
        """Have the ids of every pre-token in ``recent``; those that are too long to stay are returned."""
        if len(self.recent) > MEMORY:
            self.older, self.recent = self.recent, {}
        recent, older, new = self.recent, self.older, []
        for piece in pieces:
            if piece not in recent:
                if (ids := older.get(piece)) is not None:
                    recent[piece] = ids
                else:
                    new.append(piece)
        raw = [piece.encode("utf-8") for piece in new]
        keys, single = self.keys, self.ids
        for piece, token, slot in zip(new, raw, self.hash.slots(raw).tolist()):
            known = slot >= 0 and keys[slot] == token
            recent[piece] = single[slot].tobytes() if known else np.array(self.merge(token), np.int32).tobytes()
        return [piece for piece in new if len(piece) > SHORT]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and where each text's ids start (one more for the end)."""
        parts, sizes = [], np.zeros(len(texts) + 1, np.int64)
        split: list[tuple[int, list[str]]] = []
        waiting = 0

        def encode_split() -> None:
            # The distinct pre-tokens of many pieces at once.
            long = self.resolve(set(chain.from_iterable(found for _, found in split)))
            ids_of = self.recent.__getitem__
            for row, found in split:
                parts.append(b"".join(map(ids_of, found)))
                sizes[row + 1] += len(parts[-1]) // 4
            for piece in long:
                del self.recent[piece]
            split.clear()

        for row, text in enumerate(texts):
            for piece in safe_pieces(text) if text else ():
                split.append((row, self.split(piece)))
                waiting += len(piece)
                if waiting >= GROUP_BYTES:
                    encode_split()
                    waiting = 0
        encode_split()
        return np.frombuffer(b"".join(parts), np.int32), np.cumsum(sizes)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids in one array, and where each text's bytes start."""
        sizes = self.lengths[ids]
        at = np.concatenate([[0], np.cumsum(sizes)])
        source = np.repeat(self.starts[ids] - at[:-1], sizes) + np.arange(at[-1])
        return self.bytes[source], at[ends]


@lru_cache(maxsize=2)
def codec(path: str | None = None, pattern: str | None = None) -> Codec:
    import public_tokenizers

    return Codec(path or tokenizer_file(VOCABULARY), pattern or public_tokenizers.PATTERN)


def encode(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for batch in batches:
            for group in rows_by_bytes(batch, "text", GROUP_BYTES):
                ids, ends = own.encode(group.column("text").to_pylist())
                yield with_arrays(group, ["doc_id"], ids=pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)))

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, schema_of(rows.drop("text"), ids="array<int>"))


def decode(encoded: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """The columns of ``encoded`` and ``decoded``, the bytes of its ``ids``; null ids count as none."""
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for batch in batches:
            lists = batch.column("ids")
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(counts)])
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            start = 0
            while start < batch.num_rows:  # groups of bounded size
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + GROUP_BYTES // 4, side="right")) - 1)
                raw, at = own.decode(ids[ends[start] : ends[stop]], ends[start : stop + 1] - ends[start])
                column = pa.Array.from_buffers(pa.binary(), stop - start, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw)])
                yield with_arrays(batch.slice(start, stop - start), names, decoded=column)
                start = stop

    return encoded.mapInArrow(run, schema_of(encoded, decoded="binary"))


def round_trip(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` of every row of ``docs``: both ways in one pass, so that ids travel once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        for batch in batches:
            for group in rows_by_bytes(batch, "text", GROUP_BYTES):
                ids, ends = own.encode(group.column("text").to_pylist())
                raw, at = own.decode(ids.astype(np.int64), ends)
                yield with_arrays(
                    group,
                    ["doc_id"],
                    ids=pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                    decoded=pa.Array.from_buffers(pa.binary(), group.num_rows, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw)]),
                )

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, schema_of(rows.drop("text"), ids="array<int>", decoded="binary"))


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents"))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the digests of the ids and of what they decode to."""
    return round_trip(docs).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
