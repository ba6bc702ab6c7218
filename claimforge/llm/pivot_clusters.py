"""Centroid clustering of vectors with a table of pivot distances (LAESA).

Components become whole numbers, so distances, sums and centroids are exact and don't
depend on the order of rows. A few spread-out vectors are the pivots. Every vector's
distances to them are computed once and stored beside it. By the triangle inequality a
centroid c is at least |d(x, p) - d(c, p)| away from x, for every pivot p: a round
gives exact distances only to centroids whose bound does not exceed the best distance
found so far. A task returns one sum and count per centroid; no vector is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimforge.llm.shared import stored, table

SIZE, SCALE, CENTROIDS, ROUNDS, PIVOTS = 64, 64, 16, 3, 8
# Vectors that pivots are chosen from, by the same hash as the first centroids.
PIVOT_SAMPLE = 256
# Whole-number components lie within this bound, so that a squared distance fits 64 bits.
LIMIT = 2**27


def whole_numbers(column: pa.Array, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors of a list column are usable, and their components as floor(scale * x).

    Usable: exactly ``size`` components, none null or non-finite. A component beyond
    ``LIMIT`` fails the job, since its distances would not fit their type.
    """
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), size), False)
    values = column.filter(fits).flatten().cast(pa.float64())
    vectors = values.to_numpy(zero_copy_only=False).reshape(-1, size)
    finite = np.isfinite(vectors).all(axis=1)
    usable = fits.to_numpy(zero_copy_only=False).copy()
    usable[usable] = finite
    whole = np.floor(vectors[finite] * scale)
    if whole.size and not np.abs(whole).max() < LIMIT:
        raise ValueError(f"a component lies beyond {LIMIT / scale:.0f}")
    return usable, whole.astype(np.int64)


def squared(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of every vector to every point."""
    return np.stack([((vectors - point) ** 2).sum(axis=1) for point in points], axis=1)


def spread_out(vectors: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` distinct vectors, each the farthest from those before it."""
    chosen = vectors[:1]
    while 0 < len(chosen) < count:
        nearest = squared(vectors, chosen).min(axis=1)
        if nearest.max() == 0:
            break
        chosen = np.concatenate((chosen, vectors[[nearest.argmax()]]))
    return chosen


def nearest(
    vectors: np.ndarray, known: np.ndarray, centroids: np.ndarray, pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid, and how many exact distances that took.

    ``known`` has the squared distances to the pivots. Of equally near centroids the
    smaller number wins: bounds are lowered by more than their rounding error, so no
    tie is pruned.
    """
    reach, to = np.sqrt(known), np.sqrt(squared(centroids, pivots))
    bound = np.zeros((len(vectors), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(reach[:, [p]] - to[None, :, p]), out=bound)
    bound -= 1e-9 * (1 + reach.max(initial=0) + to.max(initial=0))
    cluster = bound.argmin(axis=1)
    best = ((vectors - centroids[cluster]) ** 2).sum(axis=1)
    first, spent = cluster.copy(), len(vectors)
    for j, centroid in enumerate(centroids):
        rows = np.nonzero((first != j) & (bound[:, j] <= np.sqrt(best)))[0]
        found = ((vectors[rows] - centroid) ** 2).sum(axis=1)
        spent += len(rows)
        wins = (found < best[rows]) | ((found == best[rows]) & (j < cluster[rows]))
        cluster[rows[wins]], best[rows[wins]] = j, found[wins]
    return cluster, best, spent


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width).astype(np.int64)


def _binary(rows: np.ndarray, kind: str) -> pa.Array:
    return pa.array([row.tobytes() for row in rows.astype(kind)], pa.binary())


def kept_vectors(df: DataFrame, key: str, vector: str, size: int, scale: int) -> DataFrame:
    """``id, data`` of the usable vectors, components as little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usable, whole = whole_numbers(batch.column(1), size, scale)
            ids = batch.column(0).filter(pa.array(usable))
            yield pa.record_batch([ids, _binary(whole, "<i4")], names=["id", "data"])

    return df.select(F.col(key).cast("long"), vector).mapInArrow(run, "id long, data binary")


def pivot_table(kept: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``kept`` with the squared distances to the pivots, stored once for all rounds."""
    size = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = squared(_matrix(batch.column(1), "<i4", size), pivots)
            yield pa.record_batch([*batch.columns, _binary(known, "<i8")], names=["id", "data", "known"])

    return stored(kept.mapInArrow(run, "id long, data binary, known binary"), "pivots")


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray, pivots: np.ndarray):
    vectors = _matrix(batch.column("data"), "<i4", centroids.shape[1])
    known = _matrix(batch.column("known"), "<i8", len(pivots))
    cluster, distance, _ = nearest(vectors, known, centroids, pivots)
    return vectors, cluster, distance


def moved(rows: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One round: assign all vectors, floor each cluster's mean; empty clusters stay.

    A task returns at most one row per centroid, and so does the sum over tasks.
    """
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            vectors, cluster, _ = _assigned(batch, centroids, pivots)
            for j in np.unique(cluster):
                own = vectors[cluster == j]
                sums[j] += own.sum(axis=0)
                counts[j] += len(own)
        used = np.nonzero(counts)[0]
        yield pa.record_batch(
            [pa.array(used), pa.array(counts[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    parts = rows.mapInArrow(run, "cluster long, n long, sums array<long>")
    totals = [F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(size)]
    after = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*totals).alias("sums")).collect():
        after[row.cluster] = [int(x) // row.n for x in row.sums]
    return after


def cluster(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    size: int = SIZE,
    scale: int = SCALE,
    count: int = CENTROIDS,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, np.ndarray]:
    """``id, cluster, distance`` of every usable vector, and the final centroids.

    The first centroids are the ``count`` vectors with the smallest SHA-256 of
    ``1:<id>`` (``1:`` for a null id), then by id and components; fewer usable vectors
    make fewer centroids, none an empty result. Rows that repeat an id or a vector are
    vectors of their own; other columns are ignored. To the driver come at most
    ``PIVOT_SAMPLE`` vectors and, per round, one sum per centroid.
    """
    kept = kept_vectors(df, key, vector, size, scale)
    place = F.sha2(F.concat_ws("", F.lit("1:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(place, "id", "data").limit(max(count, PIVOT_SAMPLE)).select("data").collect()
    sample = np.array([np.frombuffer(row.data, "<i4") for row in first], np.int64).reshape(-1, size)
    if not len(sample):
        return kept.sparkSession.createDataFrame([], "id long, cluster int, distance long"), sample
    centroids, fixed = sample[:count], spread_out(sample, pivots)
    rows = pivot_table(kept, fixed)
    for _ in range(rounds):
        centroids = moved(rows, centroids, fixed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, found, distance = _assigned(batch, centroids, fixed)
            yield pa.record_batch(
                [batch.column("id"), pa.array(found.astype(np.int32)), pa.array(distance)],
                names=["id", "cluster", "distance"],
            )

    return stored(rows.mapInArrow(run, "id long, cluster int, distance long"), "clusters"), centroids


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def op11_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(table(spark, sf_dir, "embeddings"))
    sums = {row.cluster: row.inertia for row in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    rows = [(j, total, sum(sums.values()), centroid_digest(centroids[j])) for j, total in sums.items()]
    kinds = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # One row per centroid.
    per_cluster = F.broadcast(spark.createDataFrame(rows, kinds))
    return found.join(per_cluster, "cluster").select(F.col("id").alias("vec_id"), *found.columns[1:], *per_cluster.columns[1:])


def _assignment(name: str, centroids: str) -> str:
    return f"""
{name} AS (
  SELECT vec_id, x, cluster, distance FROM (
    SELECT v.vec_id, v.x, c.cluster,
           list_sum(list_transform(range(1, {SIZE + 1}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))::BIGINT AS distance
    FROM v CROSS JOIN {centroids} c)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) = 1)"""


def _means(name: str, assignment: str, before: str) -> str:
    # Whole division rounds towards zero, so the remainder is taken off first.
    return f"""
{name}_sums AS (
  SELECT cluster, i, sum(x[i])::BIGINT AS s, count(*) AS n
  FROM {assignment} CROSS JOIN range(1, {SIZE + 1}) AS t(i) GROUP BY cluster, i),
{name} AS (
  SELECT cluster, coalesce(m.x, b.x) AS x FROM {before} b LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM {name}_sums GROUP BY cluster) m USING (cluster))"""


def _sql() -> str:
    parts = [
        f"""
v AS (
  SELECT vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, x FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id)) <= {CENTROIDS})"""
    ]
    for r in range(ROUNDS):
        parts += [_assignment(f"a{r}", f"c{r}"), _means(f"c{r + 1}", f"a{r}", f"c{r}")]
    parts.append(_assignment("a", f"c{ROUNDS}"))
    return "WITH" + ",".join(parts) + f"""
SELECT vec_id, cluster::INT AS cluster, distance,
       sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a JOIN c{ROUNDS} c USING (cluster)
"""


OP11_SQL = _sql()
