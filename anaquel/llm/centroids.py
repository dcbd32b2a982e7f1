"""Centroid clustering with heaps of bounds, exact in integers.

Every vector has an upper bound on the distance to its own centroid and a lower bound on the distance to any
other. When centroids move, the gap between the two shrinks by at most the drift of its own centroid plus the
largest drift of the others. So instead of adjusting bounds, each cluster keeps a running total of its drift,
and a heap of its vectors by the total at which their gap will have expired. After an update only the vectors at the
top of the heaps are popped, namely those whose expiry lies at or below the total; they are compared with all centroids exactly
and pushed into the heap of the nearest. All others keep their cluster without being looked at.

Vectors live in blocks of bounded size, a row each: ids, components in the narrowest integer type, and one heap
per cluster in heap order. A round maps the blocks and returns, beside the new heaps, what moved: per cluster the sums
of the components that came less those that went. The driver adds these up, ``k`` rows whatever the number of
vectors, and knows the next centroids. Each round is staged, so a lost executor costs one round at most.

Distances and means are integers and exact. Bounds are floating point and widened by more than their rounding
error, so a vector that is left alone has one nearest centroid and only one.

Defined results: vectors with another number of components, a null, a NaN or an infinity are left out, and so are those with
an integer component beyond ``LARGEST``, whose squared distances do not fit a long; a null ``vec_id`` is never
a first centroid but is assigned like others; repeated rows are vectors of their own, and equal
centroids leave their vectors to the smaller number; fewer vectors than centroids give as many
centroids as vectors with an id; an empty table, or one without such vectors, gives no rows; a sum of distances
that does not fit a long is null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anaquel.llm.common import schema_of, table
from anaquel.sources.staging import stage

DIMENSION = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
LARGEST = 1 << 27
BLOCK = 8192
# Relative widening of a bound, far above the rounding of a square root and a few sums.
MARGIN = 1e-9


def whole_vectors(embeddings: DataFrame, dimension: int = DIMENSION, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``vector``, the scaled and floored components, of the vectors that are kept."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit((LARGEST - 1) / scale)))
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("int"))
    return embeddings.filter((F.size("embedding") == dimension) & whole).select("vec_id", scaled.alias("vector"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: str = "1") -> np.ndarray:
    """The vectors with the smallest hashes of seed and id, in order of the hash; of equal ids the smaller vector."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    chosen = vectors.filter("vec_id is not null").orderBy(key, "vector").limit(clusters).select("vector").collect()
    return np.array([r.vector for r in chosen], np.int64).reshape(len(chosen), len(chosen[0].vector) if chosen else 0)


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of every vector to every centroid."""
    most = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    # In doubles where every sum is below 2^53 and therefore exact: that is a matrix product.
    kind = np.float64 if 4 * most * most * vectors.shape[1] < 1 << 53 else np.int64
    v, c = vectors.astype(kind), centroids.astype(kind)
    return ((v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)).astype(np.int64)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, the smaller number of equals, and a safe lower bound of the gap to the next."""
    distances = squared(vectors, centroids)
    own = distances.argmin(axis=1)
    upper = np.sqrt(distances[np.arange(len(own)), own].astype(np.float64))
    distances[np.arange(len(own)), own] = np.iinfo(np.int64).max
    lower = np.sqrt(distances.min(axis=1).astype(np.float64)) if len(centroids) > 1 else np.full(len(own), np.inf)
    return own, lower * (1 - MARGIN) - upper * (1 + MARGIN)


def drifts(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Per cluster a safe upper bound of what the update takes off the gap of its vectors."""
    moved = np.sqrt(((new - old) ** 2).sum(axis=1).astype(np.float64)) * (1 + MARGIN)
    others = [max((m for j, m in enumerate(moved) if j != c), default=0.0) for c in range(len(moved))]
    return moved + np.array(others)


class Heaps:
    """The vectors of a block by cluster: a heap of (expiry, place) each."""

    def __init__(self, heaps: list[list[tuple[float, int]]]):
        self.heaps = heaps

    @classmethod
    def read(cls, sizes: list[int], expiry: bytes, places: bytes) -> Heaps:
        pairs = list(zip(np.frombuffer(expiry, np.float64).tolist(), np.frombuffer(places, np.int32).tolist()))
        ends = np.cumsum([0, *sizes]).tolist()
        return cls([pairs[a:b] for a, b in zip(ends, ends[1:])])  # heap order is kept by the list

    def written(self) -> dict:
        pairs = [pair for heap in self.heaps for pair in heap]
        return {
            "sizes": [len(heap) for heap in self.heaps],
            "expiry": np.array([e for e, _ in pairs], np.float64).tobytes(),
            "places": np.array([p for _, p in pairs], np.int32).tobytes(),
        }

    def expired(self, totals: np.ndarray) -> tuple[list[int], list[int]]:
        """Pop the vectors whose gap may be gone: their places, and the clusters they were in."""
        places, before = [], []
        for cluster, (heap, total) in enumerate(zip(self.heaps, totals.tolist())):
            while heap and heap[0][0] <= total * (1 + MARGIN):
                places.append(heappop(heap)[1])
                before.append(cluster)
        return places, before

    def push(self, places: list[int], clusters: np.ndarray, gaps: np.ndarray, totals: np.ndarray) -> None:
        for place, cluster, expiry in zip(places, clusters.tolist(), (gaps + totals[clusters]).tolist()):
            heappush(self.heaps[cluster], (expiry, place))

    def clusters(self, n: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        for cluster, heap in enumerate(self.heaps):
            out[[place for _, place in heap]] = cluster
        return out


STATE = "ids array<{id}>, width int, vectors binary, sizes array<int>, expiry binary, places binary, sums array<bigint>, counts array<bigint>, scanned bigint"


def _vectors(row: dict, dimension: int) -> np.ndarray:
    return np.frombuffer(row["vectors"], f"<i{row['width']}").reshape(-1, dimension).astype(np.int64)


def _moved(vectors: np.ndarray, clusters: np.ndarray, before: np.ndarray | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per cluster the sums of components and the number of vectors that came, less those that went."""
    sums, counts = np.zeros((k, vectors.shape[1]), np.int64), np.zeros(k, np.int64)
    np.add.at(sums, clusters, vectors)
    np.add.at(counts, clusters, 1)
    if before is not None:
        np.subtract.at(sums, before, vectors)
        np.subtract.at(counts, before, 1)
    return sums, counts


def _batch(rows: list[dict], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = {
        "ids": pa.list_(id_type), "width": pa.int32(), "vectors": pa.binary(), "sizes": pa.list_(pa.int32()), "expiry": pa.binary(),
        "places": pa.binary(), "sums": pa.list_(pa.int64()), "counts": pa.list_(pa.int64()), "scanned": pa.int64(),
    }
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kind) for n, kind in kinds.items()], names=list(kinds))


def build_blocks(vectors: DataFrame, centroids: np.ndarray, block: int = BLOCK) -> DataFrame:
    """Blocks with every vector in the heap of its nearest centroid."""
    k, dimension = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
            for start in range(0, batch.num_rows, block):
                part = flat[start : start + block].astype(np.int64)
                width = next(w for w in (1, 2, 4) if np.abs(part).max() < 1 << 8 * w - 1)
                own, gaps = nearest(part, centroids)
                heaps = Heaps([list(zip(gaps[at].tolist(), at.tolist())) for at in (np.flatnonzero(own == c) for c in range(k))])
                for heap in heaps.heaps:
                    heapify(heap)
                sums, counts = _moved(part, own, None, k)
                ids = batch.column("vec_id").slice(start, block)
                yield _batch(
                    [{"ids": ids.to_pylist(), "width": width, "vectors": part.astype(f"<i{width}").tobytes(), "sums": sums.ravel(), "counts": counts, "scanned": len(part)} | heaps.written()],
                    ids.type,
                )

    return vectors.mapInArrow(run, STATE.format(id=vectors.schema["vec_id"].dataType.simpleString()))


def update_blocks(blocks: DataFrame, centroids: np.ndarray, totals: np.ndarray) -> DataFrame:
    """Blocks after the centroids moved: only vectors with an expired gap are compared again."""
    k, dimension = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                vectors, heaps = _vectors(row, dimension), Heaps.read(row["sizes"], row["expiry"], row["places"])
                places, before = heaps.expired(totals)
                sums, counts = np.zeros((k, dimension), np.int64), np.zeros(k, np.int64)
                if places:
                    own, gaps = nearest(vectors[places], centroids)
                    heaps.push(places, own, gaps, totals)
                    sums, counts = _moved(vectors[places], own, np.array(before), k)
                yield _batch([row | {"sums": sums.ravel(), "counts": counts, "scanned": len(places)} | heaps.written()], batch.schema.field("ids").type.value_type)

    return blocks.mapInArrow(run, blocks.schema)


def _totals(blocks: DataFrame, name: str, size: int) -> list[int]:
    """The arrays of all blocks added up, exactly: one number per place of the array."""
    at = blocks.select(F.posexplode(name).alias("at", "value")).groupBy("at").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value"))
    out = [0] * size
    for r in at.collect():  # as many rows as clusters times components
        out[r["at"]] = int(r["value"])
    return out


def members(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id``, ``cluster`` and the exact squared ``distance`` of every vector."""
    _, dimension = centroids.shape
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                row = one.to_pylist()[0]
                vectors = _vectors(row, dimension)
                own = Heaps.read(row["sizes"], row["expiry"], row["places"]).clusters(len(vectors))
                distance = ((vectors - centroids[own]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([one.column("ids").flatten(), pa.array(own, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return blocks.mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint")


class Clustering:
    """The result: ``centroids`` (integers), ``blocks``, and how many vectors each pass compared with all centroids."""

    def __init__(self, centroids: np.ndarray, blocks: DataFrame, scanned: list[int]):
        self.centroids, self.blocks, self.scanned = centroids, blocks, scanned

    def members(self) -> DataFrame:
        return members(self.blocks, self.centroids)


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, block: int = BLOCK) -> Clustering | None:
    """Lloyd's rounds with floored means over ``vec_id`` and ``vector``; None if there is no vector with an id."""
    centroids = first_centroids(vectors, clusters)
    if not len(centroids):
        return None
    k, dimension = centroids.shape
    totals, scanned = np.zeros(k), []
    blocks = stage(build_blocks(vectors, centroids, block), "blocks")
    sums, counts = [0] * (k * dimension), [0] * k
    for _ in range(rounds):
        sums = [a + b for a, b in zip(sums, _totals(blocks, "sums", k * dimension))]
        counts = [a + b for a, b in zip(counts, _totals(blocks, "counts", k))]
        scanned.append(blocks.agg(F.sum("scanned")).first()[0])
        moved = centroids.copy()
        for c, n in enumerate(counts):
            if n:
                moved[c] = [s // n for s in sums[c * dimension : (c + 1) * dimension]]
        totals = totals + drifts(centroids, moved)
        centroids = moved
        blocks = stage(update_blocks(blocks, centroids, totals), "blocks")
    scanned.append(blocks.agg(F.sum("scanned")).first()[0])
    return Clustering(centroids, blocks, scanned)


RESULT = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    vectors = stage(whole_vectors(table(spark, folder, "embeddings").select("vec_id", "embedding")), "vectors")
    found = cluster(vectors)
    if found is None:
        return spark.createDataFrame([], schema_of(vectors.select("vec_id")) + ", " + RESULT)
    rows = found.members()
    parts = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("own")).collect()  # a row a cluster
    whole = sum(int(r.own) for r in parts)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids.tolist()]
    known = [(r.cluster, *[n if n < 1 << 63 else None for n in (int(r.own), whole)], digests[r.cluster]) for r in parts]
    sums = spark.createDataFrame(known, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    distance = f"list_sum([(v[i] - c[i]) * (v[i] - c[i]) FOR i IN range(1, {DIMENSION + 1})])"
    steps = [
        f"""k AS (SELECT row_number() OVER () AS id, vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
             FROM embeddings WHERE len(embedding) = {DIMENSION} AND len([x FOR x IN embedding IF isfinite(x)]) = {DIMENSION})""",
        f"""c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS n, v AS c
              FROM (SELECT v, sha256('1:' || CAST(vec_id AS VARCHAR)) AS h FROM k ORDER BY h LIMIT {CLUSTERS}))""",
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"a{r} AS (SELECT id, any_value(vec_id) AS vec_id, any_value(v) AS v, min((d, n)) AS best FROM (SELECT id, vec_id, v, n, {distance} AS d FROM k, c{r}) GROUP BY id)")
        if r < ROUNDS:
            steps.append(
                f"""s{r} AS (SELECT n, i, sum(x) AS s, count(*) AS m FROM (SELECT best[2] AS n, unnest(v) AS x, unnest(range(1, {DIMENSION + 1})) AS i FROM a{r}) GROUP BY n, i),
                    m{r} AS (SELECT n, list(CAST((s - ((s % m) + m) % m) // m AS BIGINT) ORDER BY i) AS c FROM s{r} GROUP BY n),
                    c{r + 1} AS (SELECT n, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (n))"""
            )
    last = f"c{ROUNDS}"
    steps.append(f"f AS (SELECT vec_id, best[2] AS n, best[1] AS distance FROM a{ROUNDS})")
    return f"""
    WITH {", ".join(steps)}
    SELECT vec_id, CAST(f.n AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
           CAST(sum(distance) OVER (PARTITION BY f.n) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string({last}.c, ',')) AS centroid_sha256
    FROM f JOIN {last} ON {last}.n = f.n"""


ORACLE = _oracle()
