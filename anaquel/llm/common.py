"""Helpers shared by the operators over training data."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Where a text can be cut without changing its pre-tokens: in front of white space that follows
# anything else, and between a letter and an ASCII digit or sign. No pre-token of the byte-level
# pattern spans such a place, nor does a special string ('|' is left out for that).
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏЀ-ҁぁ-ゖァ-ヺ一-龥가-힣"
_SAFE = regex.compile(
    rf"(?<=[^\s\x1c-\x1f\x85])(?=[ \n\t\r])|(?<=[{_LETTER}])(?=[0-9!-&(-/:;=?@\[-`~])|(?<=[0-9])(?=[{_LETTER}])"
)
PIECE_CHARS = 1 << 16


def find_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package from where the driver has it.

    On a cluster the package is installed on the executors or passed with ``--py-files``.
    """
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, environment.get("PYTHONPATH")]))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the corpus. Any path Spark reads is fine."""
    find_package(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def crc_fold(doc_id: str, folds: int) -> Column:
    """Fold of a document: crc32 of its id as text, modulo ``folds``. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in pieces of about ``size`` characters, cut only where pre-tokens end.

    A run without such a place (a word of a million letters) stays whole.
    """
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def schema_of(df: DataFrame, **added: str) -> str:
    """DDL of the named columns of ``df`` followed by ``added`` ones."""
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"`{n}` {t}" for n, t in added.items()])


def with_arrays(batch: pa.RecordBatch, keep: list[str], **added: pa.Array) -> pa.RecordBatch:
    """A record batch with the columns ``keep`` of ``batch`` and the arrays ``added``."""
    names = [*keep, *added]
    return pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], *added.values()], names=names)


def rows_by_bytes(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a record batch with about ``most`` bytes of ``column`` each, one row at least."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, end - start)
        start = end


@lru_cache(maxsize=None)
def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
