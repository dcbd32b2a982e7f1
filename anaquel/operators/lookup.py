"""Joining facts to a derived table with one row per key, when a key may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame

from anaquel.sources.staging import stage


def attach(facts: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join ``facts`` to ``lookup``, which has one row per ``key``.

    The lookup is staged: as a written table its size is known, which decides whether it is broadcast, and
    otherwise both sides come straight from a shuffle, so that adaptive execution splits hot keys by
    what they hold.
    """
    return facts.join(stage(lookup, f"lookup_{key}"), key, how)
