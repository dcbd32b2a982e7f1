"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained here, in numpy, by backpropagation through time, on a bounded sample: at most about
``PER_LANGUAGE`` labelled documents a language, drawn by a hash, and of each ``WINDOWS`` windows of ``STEPS``
bytes spread over the text. Gates are clipped to 0 .. 1 and the candidate state is a softsign, which need
no exponentials. Every byte gets a probability per language from the states of both directions; a document's
probabilities are the means over all of its bytes. Texts are read whole, in windows of the same length.

Only text and language of the training fold are learned from, and only the text is used to predict. Trained
weights are a few kilobytes and travel with the function.

Defined results: a null text, or one without a letter, is ``und`` with score 0; with nothing to learn from,
all are. Null and repeated ids and null languages are allowed, and ties go to the first language by name;
an empty table gives no rows; other columns are ignored, and kept by ``keep_identified``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.llm.common import crc_fold, rows_by_bytes, schema_of, table, with_arrays
from anaquel.llm.words import utf8

FOLDS, HELD_OUT = 4, 2
PER_LANGUAGE, WINDOWS = 600, 6
STEPS, HIDDEN = 64, 8
BATCH, UPDATES, RATE = 256, 400, 0.02
UNDETERMINED = "und"
GROUP_BYTES = 2 << 20
BLOCK = 4096
LETTER = regex.compile(r"\p{L}").search


class Direction:
    """A gated recurrent layer. Update gate, reset gate and candidate each have a row of ``inputs`` per byte
    and a square matrix in ``recurrent``; gates are clipped to 0 .. 1, the candidate is a softsign."""

    def __init__(self, random: np.random.Generator):
        self.inputs = [(random.standard_normal((256, HIDDEN)) * 0.2 + middle).astype(np.float32) for middle in (0.5, 0.5, 0)]
        self.recurrent = [(random.standard_normal((HIDDEN, HIDDEN)) * scale / HIDDEN**0.5).astype(np.float32) for scale in (0.3, 0.3, 1)]
        self.bias = np.zeros(HIDDEN, np.float32)

    def weights(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, self.bias]

    def add_scores(self, steps: np.ndarray, out: np.ndarray, scores: np.ndarray, keep: list | None = None) -> None:
        """Read ``steps`` (time by batch) and add the states times ``out`` to ``scores``; ``keep`` collects what training needs."""
        h = np.zeros((steps.shape[1], HIDDEN), np.float32)
        for x, score in zip(steps, scores):
            z, r, g = (table.take(x, axis=0) for table in self.inputs)
            c = h @ self.recurrent[2]
            c += self.bias
            r += h @ self.recurrent[1]
            np.clip(r, 0, 1, out=r)
            z += h @ self.recurrent[0]
            np.clip(z, 0, 1, out=z)
            if keep is None:
                c *= r
                g += c
                np.abs(g, out=c)
                c += 1
                g /= c
                h -= g
                h *= z
                h += g
            else:
                scale = 1 / (1 + np.abs(g + r * c))
                n = (g + r * c) * scale
                keep.append((h, z, r, c, scale, n))
                h = n + z * (h - n)
            score += h @ out
        if keep is not None:
            keep.append((h, None, None, None, None, None))

    def backward(self, steps: np.ndarray, kept: list, errors: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weights, given the errors of the states: backpropagation through time."""
        d_recurrent, d_bias = [np.zeros_like(u) for u in self.recurrent], np.zeros_like(self.bias)
        d_own = np.empty((3, *steps.shape, HIDDEN), np.float32)
        d_h = np.zeros_like(errors[0])
        for t in range(len(steps) - 1, -1, -1):
            h, z, r, c, scale, n = kept[t]
            d = errors[t] + d_h
            d_g = d * (1 - z) * scale * scale
            d_z = d * (h - n) * ((z > 0) & (z < 1))
            d_r = d_g * c * ((r > 0) & (r < 1))
            d_h = d * z
            for k, through in enumerate((d_z, d_r, d_g * r)):
                d_h += through @ self.recurrent[k].T
                d_recurrent[k] += h.T @ through
            d_bias += (d_g * r).sum(axis=0)
            d_own[0, t], d_own[1, t], d_own[2, t] = d_z, d_r, d_g
        by = np.argsort(steps.ravel(), kind="stable")
        values, first = np.unique(steps.ravel()[by], return_index=True)
        d_inputs = [np.zeros_like(table) for table in self.inputs]
        for total, own in zip(d_inputs, d_own.reshape(3, -1, HIDDEN)):
            total[values] = np.add.reduceat(own[by], first, axis=0)
        return [*d_inputs, *d_recurrent, d_bias]


class Network:
    def __init__(self, languages: list[str], seed: int = 11):
        random = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.back = Direction(random), Direction(random)
        self.out = (random.standard_normal((2 * HIDDEN, len(languages))) * 0.3).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)

    def label(self, steps: np.ndarray, keep: tuple[list, list] | None = None) -> np.ndarray:
        """Probabilities (time, batch, language) of every byte of ``steps`` (time by batch)."""
        scores = np.empty((*steps.shape, len(self.languages)), np.float32)
        scores[:] = self.out_bias
        self.ahead.add_scores(steps, self.out[:HIDDEN], scores, None if keep is None else keep[0])
        self.back.add_scores(steps[::-1], self.out[HIDDEN:], scores[::-1], None if keep is None else keep[1])
        np.exp(scores, out=scores)  # states are within -1 .. 1, so scores are small
        scores /= scores.sum(axis=-1, keepdims=True)
        return scores

    def train(self, windows: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> None:
        """Adam on the cross-entropy of every byte's label, in batches with equal shares of the languages."""
        random = np.random.default_rng(5)
        weights = [*self.ahead.weights(), *self.back.weights(), self.out, self.out_bias]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        by_language = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        share = max(1, BATCH // len(by_language))
        for update in range(1, UPDATES + 1):
            rows = np.concatenate([random.choice(own, share) for own in by_language])
            steps = np.ascontiguousarray(windows[rows].T)
            mask = (np.arange(STEPS)[:, None] < sizes[rows]).astype(np.float32)
            kept: tuple[list, list] = ([], [])
            errors = self.label(steps, kept)
            errors[:, np.arange(len(rows)), labels[rows]] -= 1
            errors *= mask[:, :, None] / mask.sum()
            d_states = errors @ self.out.T
            ahead = np.stack([k[0] for k in kept[0][1:]])
            back = np.stack([k[0] for k in kept[1][1:]])[::-1]
            gradients = [
                *self.ahead.backward(steps, kept[0], d_states[..., :HIDDEN]),
                *self.back.backward(steps[::-1], kept[1], d_states[::-1, :, HIDDEN:]),
                np.concatenate([ahead, back], axis=-1).reshape(-1, 2 * HIDDEN).T @ errors.reshape(-1, len(self.languages)),
                errors.sum(axis=(0, 1)),
            ]
            rate = RATE * min(1.0, 2 * (1 - (update - 1) / UPDATES))
            norm = sum(float((g * g).sum()) for g in gradients) ** 0.5
            for w, g, m, v in zip(weights, gradients, first, second):
                g = g * np.float32(min(1.0, 1 / (norm + 1e-9)))
                m += np.float32(0.1) * (g - m)
                v += np.float32(0.01) * (g * g - v)
                w -= np.float32(rate) * (m / np.float32(1 - 0.9**update)) / (np.sqrt(v / np.float32(1 - 0.99**update)) + np.float32(1e-7))

    def documents(self, data: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Mean probabilities over the bytes of each row of a string column."""
        sizes = np.diff(rows)
        counts = -(-sizes // STEPS)
        owner = np.repeat(np.arange(len(sizes)), counts)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = rows[:-1][owner] + within * STEPS
        size = np.minimum(rows[1:][owner] - start, STEPS)
        padded = np.concatenate([data, np.zeros(STEPS, np.uint8)])
        totals = np.zeros((len(sizes), len(self.languages)))
        for at in range(0, len(start), BLOCK):
            part = slice(at, at + BLOCK)
            mask = np.arange(STEPS)[:, None] < size[part]
            steps = padded[start[part] + np.arange(STEPS)[:, None]]
            steps[~mask] = 0
            np.add.at(totals, owner[part], np.einsum("tbl,tb->bl", self.label(steps), mask.astype(np.float32)))
        return totals / np.maximum(sizes, 1)[:, None]


def _training_windows(docs: DataFrame, per_language: int) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """A bounded sample of the labelled rows, as windows of bytes."""
    counts = {row.lang: row.n for row in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    languages = sorted(counts)
    if not languages:
        return [], np.zeros((0, STEPS), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = F.coalesce(*[F.when(F.col("lang") == name, draw < min(1.0, per_language / counts[name])) for name in languages], F.lit(False))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, pieces = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                raw = text.encode("utf-8") if LETTER(text) else b""
                for start in sorted({int(s) for s in np.linspace(0, max(0, len(raw) - STEPS), WINDOWS)}) if raw else ():
                    langs.append(lang)
                    pieces.append(raw[start : start + STEPS])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(pieces, pa.binary())], names=["lang", "piece"])

    sample = docs.filter(chosen).select("lang", "text").mapInArrow(cut, "lang string, piece binary").toArrow()
    place = {name: k for k, name in enumerate(languages)}
    rows = sorted({(place[lang], piece) for lang, piece in zip(sample.column("lang").to_pylist(), sample.column("piece").to_pylist())})
    windows = np.zeros((len(rows), STEPS), np.uint8)
    for row, (_, piece) in zip(windows, rows):
        row[: len(piece)] = np.frombuffer(piece, np.uint8)
    return languages, windows, np.array([len(p) for _, p in rows], np.int64), np.array([k for k, _ in rows], np.int64)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    """A network for the languages of ``docs`` (``doc_id``, ``text``, ``lang``) outside the held-out fold."""
    usable = (crc_fold("doc_id", FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    languages, windows, sizes, labels = _training_windows(docs.select("doc_id", "text", "lang").filter(usable), per_language)
    present = sorted(set(labels.tolist()))
    if not present:
        return None
    network = Network([languages[k] for k in present])
    network.train(windows, sizes, np.searchsorted(present, labels))
    return network


def _predict(network: Network | None, column: pa.Array) -> tuple[list[str], np.ndarray]:
    texts = column.to_pylist()
    letters = np.array([bool(text) and LETTER(text) is not None for text in texts], bool)
    if network is None:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    means = network.documents(*utf8(column))
    best = means.argmax(axis=1)
    names = [network.languages[k] if ok else UNDETERMINED for k, ok in zip(best.tolist(), letters.tolist())]
    return names, np.where(letters, np.clip(means[np.arange(len(best)), best], 0, 1), 0.0)


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in rows_by_bytes(batch, "text", GROUP_BYTES):
                names, score = _predict(network, group.column("text"))
                yield with_arrays(group, ["doc_id"], lang_pred=pa.array(names, pa.string()), score=pa.array(score, pa.float64()))

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, schema_of(rows.drop("text"), lang_pred="string", score="double"))


def keep_identified(docs: DataFrame, network: Network | None, least: float) -> DataFrame:
    """The rows of ``docs``, with all columns, that have a language with a score of ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in rows_by_bytes(batch, "text", GROUP_BYTES):
                names, score = _predict(network, group.column("text"))
                yield group.filter(pa.array([n != UNDETERMINED and s >= least for n, s in zip(names, score.tolist())], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    named = identify(docs, train(docs))
    return named.select("doc_id", (crc_fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
