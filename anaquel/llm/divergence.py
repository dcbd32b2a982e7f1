"""How far the sources of a language differ in their words: run-length columns over a reordered vocabulary.

A language keeps the terms that enough of its documents use. A group is a language and source; it gives each kept term
a share ``p`` that depends on the term's count alone, and so does the difference of two groups. Terms are therefore numbered so
that equal counts stand together: by their total, then by a signature of their counts in all groups, so that terms with the same
counts everywhere are neighbours. A group's column of counts is then a few runs, most of them of zeros.

The numbered vocabulary is cut in blocks, and the groups of a language in tiles. A task takes one block for two
tiles: it run-length encodes the columns of both, intersects the run boundaries of every pair of groups, and adds up the
difference of the two shares times the length of the piece. Sums over blocks give the value of a pair. So neither
a vocabulary nor the number of sources of a language has to fit a task, and no pair of groups meets term by term.

Counts and documents are added up per group of texts before the shuffle. All arithmetic is on integers of
any size in the tasks and on decimals in the plan.

Defined results: null text, language or source count as empty ones; a text without terms adds only its group; a group
without kept terms has the shares of zero counts; a language without kept terms has pairs of value 0 and no
terms; one with a single source has no pairs; equal values rank by the item's bytes; repeated rows are documents
of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anaquel.llm.common import rows_by_bytes, table
from anaquel.operators.numbering import number_rows
from anaquel.sources.staging import stage

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
UNIT = 1_000_000_000
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
GROUP_BYTES = 4 << 20
# Terms of a block, and groups of a tile.
BLOCK, TILE = 1 << 15, 32


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``count`` and ``documents``, added up per group of texts only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in rows_by_bytes(batch, "text", GROUP_BYTES):
                counts: dict[tuple, Counter] = {}
                holding: dict[tuple, Counter] = {}
                texts = group.column("text").cast(pa.binary()).to_pylist()
                for lang, source, text in zip(group.column("lang").to_pylist(), group.column("source").to_pylist(), texts):
                    found = Counter(TERM.findall(text.lower()))  # of bytes: only A-Z
                    counts.setdefault((lang, source), Counter()).update(found)
                    holding.setdefault((lang, source), Counter()).update(found.keys())
                for (lang, source), found in counts.items():
                    n = len(found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(pa.scalar(lang, pa.string()), n),
                            pa.repeat(pa.scalar(source, pa.string()), n),
                            pa.array(list(found), pa.binary()).cast(pa.string()),
                            pa.array(list(found.values()), pa.int64()),
                            pa.array([holding[lang, source][term] for term in found], pa.int64()),
                        ],
                        names=["lang", "source", "term", "count", "documents"],
                    )

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, count bigint, documents bigint")


def share(count: int, total: int, size: int) -> int:
    """The share of a term with ``count`` of ``total`` occurrences, among ``size`` kept terms."""
    return 1 + UNIT * (count + 2) // (total + 2 * size)


def _share(count: Column, total: Column, size: Column) -> Column:
    above = F.lit(UNIT).cast("decimal(10,0)") * (count + F.lit(2)).cast("decimal(19,0)")
    return F.call_function("div", above, (total + 2 * size).cast("decimal(19,0)")) + F.lit(1)


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Of two shares; at most one more than a billion each, so the square fits 64 bits."""
    return (p - q) * (p - q) // (p + q)


def run_lengths(places: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal counts start, and their counts, of a column that is 0 where no place says otherwise."""
    column = np.zeros(length, np.int64)
    column[places] = counts
    starts = np.flatnonzero(np.diff(column, prepend=-1)) if length else np.zeros(0, np.int64)
    return starts, column[starts]


def summed_difference(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], length: int) -> int:
    """Sum of the differences of two columns of runs (starts, shares): once per piece between the boundaries of both."""
    bounds = np.union1d(a[0], b[0])
    if not len(bounds):
        return 0
    p = a[1][np.searchsorted(a[0], bounds, side="right") - 1]
    q = b[1][np.searchsorted(b[0], bounds, side="right") - 1]
    return int((difference(p, q) * np.diff(bounds, append=length)).sum())


def _comparer(block_size: int):
    """Compares the groups of two tiles over one block of a vocabulary. Rows without a place name the groups."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        block, left, right = (k.as_py() for k in key[1:])
        named = rows.filter(pc.is_null(rows["place"])).select(["number", "tile", "total", "size"]).to_pylist()
        counted = rows.filter(pc.is_valid(rows["place"]))
        owner, place, count = (counted[c].to_numpy() for c in ("number", "place", "count"))
        by = np.argsort(owner, kind="stable")
        owner, place, count = owner[by], place[by], count[by]
        columns, length = {}, 0
        for group in named:
            length = max(0, min(block_size, group["size"] - block * block_size))
            own = slice(*np.searchsorted(owner, [group["number"], group["number"] + 1]))
            starts, counts = run_lengths(place[own], count[own], length)
            known, which = np.unique(counts, return_inverse=True)
            shares = np.array([share(c, group["total"], group["size"]) for c in known.tolist()], np.int64)
            columns[group["number"]] = (starts, shares[which])
        firsts = sorted(g["number"] for g in named if g["tile"] == left)
        seconds = sorted(g["number"] for g in named if g["tile"] == right)
        pairs = [(a, b, summed_difference(columns[a], columns[b], length)) for a in firsts for b in seconds if a < b]
        a, b, value = (list(c) for c in zip(*pairs)) if pairs else ([], [], [])
        return pa.table({"number": pa.array(a + b, pa.int64()), "other": pa.array(b + a, pa.int64()), "value": pa.array(value + value, pa.int64())})

    return run


class Audit:
    """The staged tables of an audit.

    ``groups``: lang, source, number (from 1, those of a language together), tile, tiles, total, size, lang_total.
    ``kept``: lang, source, term, count, lang_count, place (of the term in its language's vocabulary, from 0).
    """

    def __init__(self, docs: DataFrame, least: int = LEAST_DOCUMENTS, block: int = BLOCK, tile_size: int = TILE):
        self.block = block
        whole = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
        summed = term_counts(whole).groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("documents").alias("documents"))
        counts = stage(summed, "term_counts")
        # Terms with the same counts in all groups have the same total and signature.
        terms = counts.groupBy("lang", "term").agg(
            F.sum("documents").alias("documents"), F.sum("count").alias("lang_count"), F.bit_xor(F.xxhash64("source", "count")).alias("signature")
        )
        vocabulary = terms.filter(F.col("documents") >= least).drop("documents")
        numbered = stage(number_rows(vocabulary, ["lang", "lang_count", "signature", "term"], "at").drop("signature"), "vocabulary")
        languages = numbered.groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.min("at").alias("low"), F.sum("lang_count").alias("lang_total"))
        languages = stage(languages, "languages")
        placed = numbered.join(languages.select("lang", "low"), "lang").select("lang", "term", "lang_count", (F.col("at") - F.col("low")).alias("place"))
        self.kept = stage(counts.select("lang", "source", "term", "count").join(placed, ["lang", "term"]), "kept_terms")
        totals = self.kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
        groups = stage(number_rows(whole.select("lang", "source").distinct(), ["lang", "source"], "number"), "groups")
        tiles = groups.groupBy("lang").agg(F.min("number").alias("start"), F.max("number").alias("stop"))
        tile = F.floor((F.col("number") - F.col("start")) / tile_size).cast("int")
        of_lang = tiles.join(languages.drop("low"), "lang", "left")
        self.groups = stage(
            groups.join(of_lang, "lang").join(totals, ["lang", "source"], "left").select(
                "lang",
                "source",
                "number",
                tile.alias("tile"),
                (F.floor((F.col("stop") - F.col("start")) / tile_size) + 1).cast("int").alias("tiles"),
                *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("total", "size", "lang_total")],
            ),
            "sized_groups",
        )

    def pairs(self) -> DataFrame:
        """``lang``, ``source``, ``item`` (another source of the language) and ``value``."""
        other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
        key = ["lang", "block", F.least("tile", "other").alias("left"), F.greatest("tile", "other").alias("right")]
        blocks = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("size") / self.block) - 1, F.lit(0).cast("bigint")))
        names = self.groups.withColumn("block", F.explode(blocks)).select("*", other).select(
            *key, "number", "tile", "total", "size", F.lit(None).cast("int").alias("place"), F.lit(0).cast("bigint").alias("count")
        )
        inside = self.kept.join(self.groups.select("lang", "source", "number", "tile", "tiles"), ["lang", "source"])
        columns = inside.withColumn("block", F.floor(F.col("place") / self.block)).select("*", other).select(
            *key, "number", "tile", F.lit(0).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("size"), (F.col("place") % self.block).cast("int").alias("place"), "count"
        )
        parts = names.unionByName(columns).groupBy("lang", "block", "left", "right").applyInArrow(_comparer(self.block), "number bigint, other bigint, value bigint")
        values = stage(parts.groupBy("number", "other").agg(F.sum("value").alias("value")), "pair_values")
        others = self.groups.select(F.col("number").alias("other"), F.col("source").alias("item"))
        return values.join(self.groups.select("number", "lang", "source"), "number").join(others, "other").select("lang", "source", "item", "value")

    def terms(self) -> DataFrame:
        """``lang``, ``source``, ``item`` (a term the group has more of than its language) and ``value``."""
        p = _share(F.col("count"), F.col("total"), F.col("size"))
        q = _share(F.col("lang_count"), F.col("lang_total"), F.col("size"))
        sized = self.kept.join(self.groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
        value = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("p") + F.col("q"))
        return sized.filter("p > q").select("lang", "source", "item", value.alias("value"))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: all pairs of sources, and the ``top`` terms of each."""
    found = Audit(docs, least, block, tile)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = found.pairs().withColumn("rank", F.row_number().over(order))
    terms = found.terms().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(terms.withColumn("part", F.lit("term")).select(*columns))


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"))


_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
)
ORACLE = f"""
    WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS ts FROM documents),
    g AS (SELECT DISTINCT lang, source FROM d),
    e AS (SELECT id, lang, source, unnest(ts) AS t FROM d),
    v AS (SELECT lang, t FROM e GROUP BY lang, t HAVING count(DISTINCT id) >= {LEAST_DOCUMENTS}),
    k AS (SELECT lang, source, t, count(*) AS c FROM e JOIN v USING (lang, t) GROUP BY lang, source, t),
    size AS (SELECT lang, count(*) AS n FROM v GROUP BY lang),
    shares AS (SELECT g.lang, g.source, v.t, coalesce(k.c, 0) AS c,
                      1 + {UNIT} * (coalesce(k.c, 0) + 2)::HUGEINT // (sum(coalesce(k.c, 0)) OVER (PARTITION BY g.lang, g.source) + 2 * size.n) AS p
               FROM g JOIN v USING (lang) JOIN size USING (lang) LEFT JOIN k ON k.lang = g.lang AND k.source = g.source AND k.t = v.t),
    lt AS (SELECT lang, t, sum(c) AS c FROM k GROUP BY lang, t),
    ls AS (SELECT lang, t, 1 + {UNIT} * (c + 2)::HUGEINT // (sum(c) OVER (PARTITION BY lang) + 2 * size.n) AS q FROM lt JOIN size USING (lang)),
    pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
              FROM shares a JOIN shares b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
    whole AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
              FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
              UNION ALL
              SELECT lang, source, 'term', t, (p - q) * (p - q) // (p + q) FROM shares JOIN ls USING (lang, t) WHERE c > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS r FROM whole)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR r <= {TOP_TERMS}"""
