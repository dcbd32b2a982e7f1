r"""Quality rules with robust multivariate outliers, in built-in expressions only.

Every text has base statistics: words (runs of anything but ASCII white space), their characters, symbols,
lines that repeat an earlier line, and words inside 8-word windows that occur again in the text. A document
fails the base rules if it has too few words or too many of them in repeated windows.

The others are judged by the minimum covariance determinant, per language and source: each document is a
vector of transformed statistics; from each of three starts, the share ``SUPPORT`` of the group's documents with the
smallest distances gives a mean and a covariance, these give new distances, and so on; the start whose covariance has the
smallest determinant goes on until the determinant falls no more. All documents near that estimate then give the one that
judges. Documents whose squared Mahalanobis distance is beyond ``CUTOFF`` are rejected. A variance below a small floor, as that of a statistic that is nearly always 0, is the
floor; all others are as estimated.

Medians and shares come from mergeable sketches and moments from sums, so a group of any size is combined
before the shuffle and never gathered; each step's estimates, one row a group, are staged, and their written
size decides how they are joined.

Defined results: a null text has no words and fails; null languages and sources are values of their own;
documents of groups under ``LEAST`` are judged by an estimate over all documents of their language, and if that
has too few as well, over the whole corpus; the cut-off widens with the few documents an estimate rests on; repeated rows count as often as they come; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.llm.common import table, text_or_empty
from anaquel.sources.staging import stage

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, MAX_REPEATED_PERCENT = 20, 30

SUPPORT, STEPS, SETTLED, LEAST = 0.75, 2, 1e-3, 50
# Chi-square with five degrees of freedom exceeds it once in ten thousand.
CUTOFF = 25.74
# Makes the covariance of the inner 75 % of a normal sample in five dimensions that of the whole.
CONSISTENCY = 1.412
# Chi-square with five degrees of freedom stays below it in 97.5 % of cases, and the like factor for that share.
NEAR, NEAR_CONSISTENCY = 12.83, 1.0555
# Transformed statistics with the least standard deviation each can have.
FEATURES = {
    "f_length": 0.2,
    "f_word": 0.1,
    "f_symbols": 0.05,
    "f_lines": 0.07,
    "f_repeats": 0.08,
}
ACCURACY = 2000


def base_statistics(docs: DataFrame, *also: str) -> DataFrame:
    """``doc_id``, the columns ``also`` and the base statistics of every row."""
    split = docs.select("doc_id", *also, text_or_empty().alias("t")).select(
        "doc_id",
        *also,
        F.filter(F.split("t", SPACE), lambda w: w != "").alias("words"),
        F.length(F.translate("t", SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.filter(F.split("t", "\n", -1), lambda line: F.translate(line, SPACES, "") != "").alias("lines"),
    )
    hashed = split.select(
        "doc_id",
        *also,
        F.size("words").alias("n"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    none = F.array().cast("array<bigint>")
    windows = hashed.withColumn(
        "w",
        F.when(
            F.col("n") > WINDOW,
            F.transform(F.sequence(F.lit(0), F.col("n") - WINDOW), lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)])),
        ).otherwise(none),
    ).drop("h")
    counted = windows.withColumn("again", F.size(F.array_distinct("w")) < F.size("w"))
    # Windows in order of their hash, each beside the ones before and after it; only for texts that repeat any.
    placed = F.array_sort(F.transform("w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    sorted_windows = counted.withColumn("s", F.when(F.col("again"), placed))
    missing = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    beside = F.arrays_zip(
        F.col("s").alias("a"), F.concat(missing, F.col("s")).alias("b"), F.concat(F.slice("s", 2, F.greatest(F.size("s"), F.lit(1))), missing).alias("c")
    )
    found = F.filter(beside, lambda z: (z["a"]["h"] == z["b"]["h"]) | (z["a"]["h"] == z["c"]["h"]))
    starts = sorted_windows.withColumn("r", F.when(F.col("again"), F.sort_array(F.transform(found, lambda z: z["a"]["i"]))))
    covered = F.aggregate(
        "r",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("to")),
        lambda s, at: F.struct((s["n"] + (at + WINDOW) - F.greatest(at, s["to"])).alias("n"), (at + WINDOW).alias("to")),
        lambda s: s["n"],
    )
    return starts.select(
        "doc_id",
        *also,
        F.col("n").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.when(F.col("again"), covered).otherwise(F.lit(0).cast("bigint")).alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))


def _vectors(statistics: DataFrame) -> DataFrame:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return statistics.withColumns(
        {
            "f_length": F.log1p("n_words"),
            "f_word": F.log(chars / words),
            "f_symbols": F.sqrt(F.col("n_symbols") / chars),
            "f_lines": F.log1p("n_dup_lines") / F.log1p(words),
            "f_repeats": F.sqrt(F.col("n_repeat_words") / words),
        }
    )


def _named(column: str) -> Column:
    """A value that tells null from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))


def _small(estimates: DataFrame, name: str) -> DataFrame:
    """A staged table with one row a group, in few files: its size on disk then tells whether it can be broadcast."""
    return stage(estimates.coalesce(4), name)


def _grouped(vectors: DataFrame) -> DataFrame:
    """The rows with ``key``, the group they are judged by, and ``feeds``, all groups they are part of the estimate of."""
    own = F.concat(_named("lang"), F.lit("\x01"), _named("source"))
    rows = vectors.withColumn("own", own).withColumn("pool", F.concat(_named("lang"), F.lit("\x02")))
    # One row per language and source, then one per language.
    sizes = _small(rows.filter(~F.col("base_failed")).groupBy("own", "pool").agg(F.count(F.lit(1)).alias("n")), "mcd_sizes")
    pools = sizes.groupBy("pool").agg(F.sum("n").alias("pooled"), F.min("n").alias("least"))
    # Estimates that judge nobody are not made.
    whole = F.when(F.lit(pools.filter(F.col("pooled") < LEAST).limit(1).count() > 0), F.lit("\x03"))
    large, known = F.col("n") >= LEAST, F.col("pooled") >= LEAST
    pool = F.when(known & (F.col("least") < LEAST), F.col("pool"))
    keys = sizes.join(pools, "pool").select(
        "own",
        F.when(large, F.col("own")).when(known, F.col("pool")).otherwise(whole).alias("key"),
        F.array_compact(F.array(F.when(large, F.col("own")), pool, whole)).alias("feeds"),
    )
    return rows.drop("pool").join(_small(keys, "mcd_keys"), "own", "left").drop("own")


def _distance(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    """``d``: the squared distance by the mean ``m_i`` and the lower Cholesky factor ``l_i_j`` of each estimate of the row's group."""
    names = list(FEATURES)
    joined = rows.join(estimates, "key", how)
    for i, name in enumerate(names):
        rest = F.col(name) - F.col(f"m_{i}")
        for j in range(i):
            rest = rest - F.col(f"l_{i}_{j}") * F.col(f"y_{j}")
        joined = joined.withColumn(f"y_{i}", rest / F.col(f"l_{i}_{i}"))
    squares = sum((F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(1, len(names))), F.col("y_0") * F.col("y_0"))
    return joined.withColumn("d", squares).drop("logdet", *[c for c in estimates.columns if c[:2] in ("m_", "l_")], *[f"y_{i}" for i in range(len(names))])


def _factored(frame: DataFrame, covariance: Callable[[int, int], Column]) -> DataFrame:
    """Add the lower Cholesky factor of a covariance, its variances no smaller than the floors, and ``logdet``, the logarithm of its determinant."""
    for i, floor in enumerate(FEATURES.values()):
        for j in range(i + 1):
            rest = covariance(i, j)
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            frame = frame.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(rest, F.lit(floor * floor))) if i == j else rest / F.col(f"l_{j}_{j}"))
    return frame.withColumn("logdet", 2 * sum((F.log(f"l_{i}_{i}") for i in range(1, len(FEATURES))), F.log("l_0_0")))


def _starts(rows: DataFrame) -> DataFrame:
    """Three first estimates of every group, all around its medians and scaled by its absolute deviations.

    They differ in shape: none (a diagonal), that of the directions from the median, each document counting alike however
    far it lies, and the correlation of the values drawn in by a hyperbolic tangent.
    """
    names, p = list(FEATURES), len(FEATURES)
    medians = _small(rows.groupBy("key").agg(*[F.percentile_approx(n, 0.5, ACCURACY).alias(f"m_{i}") for i, n in enumerate(names)]), "mcd_medians")
    deviations = rows.join(medians, "key").groupBy("key").agg(
        *[F.first(f"m_{i}").alias(f"m_{i}") for i in range(p)],
        *[
            F.greatest(1.4826 * F.percentile_approx(F.abs(F.col(n) - F.col(f"m_{i}")), 0.5, ACCURACY), F.lit(floor)).alias(f"s_{i}")
            for i, (n, floor) in enumerate(FEATURES.items())
        ],
    )
    scales = _small(deviations, "mcd_scales")
    scaled = rows.join(scales, "key").withColumns({f"z_{i}": (F.col(n) - F.col(f"m_{i}")) / F.col(f"s_{i}") for i, n in enumerate(names)})
    length = sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(1, p)), F.col("z_0") * F.col("z_0"))
    lower = [(i, j) for i in range(p) for j in range(i + 1)]
    shapes = scaled.withColumn("length", length).groupBy("key").agg(
        *[F.first(f"{c}_{i}").alias(f"{c}_{i}") for c in "ms" for i in range(p)],
        *[F.avg(F.when(F.col("length") > 0, F.col(f"z_{i}") * F.col(f"z_{j}") / F.col("length")).otherwise(0.0)).alias(f"a_{i}_{j}") for i, j in lower],
        *[F.avg(F.tanh(f"z_{i}") * F.tanh(f"z_{j}")).alias(f"b_{i}_{j}") for i, j in lower],
    )
    shapes = _small(shapes, "mcd_shapes")

    def correlation(i: int, j: int) -> Column:
        both = F.col(f"b_{i}_{i}") * F.col(f"b_{j}_{j}")
        return F.lit(1.0) if i == j else F.when(both > 0, F.col(f"b_{i}_{j}") / F.sqrt(both)).otherwise(0.0)

    kinds: list[Callable[[int, int], Column]] = [lambda i, j: F.lit(float(i == j)), lambda i, j: p * F.col(f"a_{i}_{j}"), correlation]
    starts = []
    for start, shape in enumerate(kinds):
        made = _factored(shapes, lambda i, j, shape=shape: F.col(f"s_{i}") * F.col(f"s_{j}") * shape(i, j))
        starts.append(made.withColumn("start", F.lit(start)).drop(*[c for c in shapes.columns if c[:2] in ("s_", "a_", "b_")]))
    return reduce(DataFrame.unionByName, starts)


def _moments(rows: DataFrame, consistency: float) -> DataFrame:
    """An estimate of every group and start from its rows: their mean and covariance, and ``inner``, their number."""
    names, p = list(FEATURES), len(FEATURES)
    # Sums around the last mean, for accuracy, would need it again; the statistics are of the order of 1.
    moments = rows.groupBy("key", "start").agg(
        F.count(F.lit(1)).alias("inner"),
        *[F.avg(n).alias(f"m_{i}") for i, n in enumerate(names)],
        *[F.covar_pop(names[i], names[j]).alias(f"c_{i}_{j}") for i in range(p) for j in range(i + 1)],
    )
    made = _factored(moments, lambda i, j: F.col(f"c_{i}_{j}") * consistency)
    return made.drop(*[c for c in moments.columns if c.startswith("c_")])


def _concentrate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One step: mean and covariance of the share of each group that is nearest by each of its ``estimates``."""
    near = _distance(rows, estimates.drop("inner"))
    limits = _small(near.groupBy("key", "start").agg(F.percentile_approx("d", SUPPORT, ACCURACY).alias("limit")), "mcd_limits")
    return _moments(near.join(limits, ["key", "start"]).filter(F.col("d") <= F.col("limit")), CONSISTENCY)


def _smallest(estimates: DataFrame) -> DataFrame:
    """The estimate with the smallest determinant of every group."""
    rest = [c for c in estimates.columns if c != "key"]
    found = estimates.groupBy("key").agg(F.min_by(F.struct(*rest), F.struct("logdet", "start")).alias("best"))
    return found.select("key", "best.*")


def minimum_determinant(rows: DataFrame) -> DataFrame:
    """Per ``key`` the mean, covariance and determinant of the ``SUPPORT`` of its rows for which the determinant is smallest.

    All starts get ``STEPS`` steps; the best of each group goes on as long as a step makes its determinant smaller by more
    than ``SETTLED`` (as a logarithm; the floors bound it from below), and the smallest ever seen is the result.
    """
    estimates = _small(_starts(rows), "mcd_estimates")
    for _ in range(STEPS):
        estimates = _small(_concentrate(rows, estimates), "mcd_estimates")
    falling = _small(_smallest(estimates), "mcd_estimates")
    seen = [falling]
    while True:
        stepped = _small(_concentrate(rows, falling), "mcd_estimates")
        seen.append(stepped)
        before = falling.select("key", F.col("logdet").alias("before"))
        falling = stepped.join(before, "key").filter(F.col("logdet") < F.col("before") - SETTLED).drop("before")
        if falling.isEmpty():
            return _smallest(reduce(DataFrame.unionByName, seen))


def reweighted(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Mean and covariance, per ``key``, of all rows within ``NEAR`` of the estimate of the smallest determinant."""
    return _moments(_distance(rows, estimates.drop("inner")).filter(F.col("d") <= NEAR), NEAR_CONSISTENCY)


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed``, ``distance`` (null if not judged) and ``kept``."""
    staged = stage(_grouped(_vectors(stage(base_statistics(docs, "lang", "source"), "quality_base"))), "quality_rows")
    # A document counts in every group it feeds.
    feeding = staged.filter(~F.col("base_failed")).withColumn("key", F.explode("feeds")).select("key", *FEATURES)
    estimates = _small(reweighted(feeding, _small(minimum_determinant(feeding), "mcd_estimates")), "mcd_estimates")
    distances = _distance(staged, estimates, "left")
    distance = F.when(~F.col("base_failed"), F.col("d"))
    # Distances to an estimate from few documents are larger; as many as there are dimensions tell nothing.
    p = len(FEATURES)
    cutoff = F.when(F.col("inner") > p, CUTOFF * F.col("inner") / (F.col("inner") - p)).otherwise(float("inf"))
    return distances.withColumn("distance", distance).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("distance") <= cutoff)).alias("kept"),
        "distance",
    )


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents"))
