"""Registered queries of this subpackage and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from anaquel.llm import centroids, decontam, divergence, line_dedup, minhash, sharding
from anaquel.llm.bpe import op7_byte_bpe
from anaquel.llm.centroids import op11_centroids
from anaquel.llm.chat import op3_chat_format
from anaquel.llm.decontam import op5_decontamination
from anaquel.llm.divergence import op12_divergence
from anaquel.llm.lang_id import op2_language_id
from anaquel.llm.line_dedup import op13_line_dedup
from anaquel.llm.lm_score import op4_lm_score
from anaquel.llm.minhash import op9_minhash
from anaquel.llm.quality import op10_quality
from anaquel.llm.rindex import op6_suffix_dedup
from anaquel.llm.sharding import op8_sharding
from anaquel.llm.token_count import op1_token_counts

QUERIES = (op1_token_counts, op2_language_id, op3_chat_format, op4_lm_score, op5_decontamination, op6_suffix_dedup, op7_byte_bpe, op8_sharding, op9_minhash, op10_quality, op11_centroids, op12_divergence, op13_line_dedup)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """Those that SQL can express; the others are tested against brute force or the public libraries."""
    return {"op5_decontamination": decontam.ORACLE, "op8_sharding": sharding.ORACLE, "op9_minhash": minhash.ORACLE, "op11_centroids": centroids.ORACLE, "op12_divergence": divergence.ORACLE, "op13_line_dedup": line_dedup.ORACLE}
