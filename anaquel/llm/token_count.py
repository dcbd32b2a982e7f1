"""Token counts of whole texts.

The texts stream through an Arrow function. Each Arrow batch is cut into groups of about the same
number of bytes, whatever the number of rows. Texts are cut where no token can span the cut, and the
distinct pieces of a group go to the library as one batch; only lengths come back, never ids.

Defined results: a null or empty text has 0 bytes and 0 tokens; rows may repeat and ids may be null,
each row is counted by itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
from collections import ChainMap
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.llm.common import rows_by_bytes, safe_pieces, schema_of, table, tokenizer_file, with_arrays

VOCABULARY = "byte_bpe_50k.json"
GROUP_BYTES = 4 << 20
# Pieces of up to so many characters are remembered, so many of them.
SHORT, MEMORY = 64, 500_000
WORDS = regex.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+").findall
RARE_SPACE = regex.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
OVER_LIMIT = 512


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)], False
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], True


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces with whole tokens: words with the white space before them.

    Texts with rare kinds of white space, and words without end, are cut more carefully.
    """
    for part in safe_pieces(text):
        if RARE_SPACE(part):
            yield part
        else:
            for word in WORDS(part):
                if len(word) <= SHORT:
                    yield word
                else:
                    yield from safe_pieces(word, SHORT)


def count_group(texts: list[str | None], path: str, lengths: dict[str, int]) -> list[int]:
    """Tokens of each text of one group; null counts as empty.

    Every distinct piece that ``lengths`` doesn't know yet is encoded once, in one batch. Lengths of
    short pieces are remembered there, up to a bounded number.
    """
    count, splits = _tokenizer(path)
    pieces = [list(_pieces(text) if splits else (text,)) if text else [] for text in texts]
    new = [p for p in set(chain.from_iterable(pieces)) if p not in lengths]
    counted = dict(zip(new, count(new))) if new else {}
    long = {p: n for p, n in counted.items() if len(p) > SHORT}
    lengths.update((p, n) for p, n in counted.items() if len(p) <= SHORT)
    get = (ChainMap(lengths, long) if long else lengths).__getitem__
    totals = [sum(map(get, own)) for own in pieces]
    if len(lengths) > MEMORY:
        lengths.clear()
    return totals


def count_tokens(docs: DataFrame, vocabulary: str | None = None, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of every row of ``docs``.

    ``vocabulary`` is the path of a tokenizer file on the executors; by default the installed public one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, lengths = vocabulary or tokenizer_file(VOCABULARY), {}
        for batch in batches:
            for group in rows_by_bytes(batch, "text", group_bytes):
                totals = count_group(group.column("text").to_pylist(), path, lengths)
                yield with_arrays(group, ["doc_id", "n_bytes"], n_tokens=pa.array(totals, pa.int64()))

    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), "text")
    return rows.mapInArrow(count, schema_of(rows.drop("text"), n_tokens="bigint"))


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = count_tokens(table(spark, folder, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > OVER_LIMIT)
