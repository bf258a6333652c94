"""Operator 11: centroid clustering by equal-average equal-variance search.

With S the sum of a vector's d components and V the norm of what is left when
their mean is taken away, |x - c|^2 >= (Sx - Sc)^2 / d + (Vx - Vc)^2.
Centroids are sorted by sum, that is by mean; from a vector's own place the
search goes outward, the nearer mean first.  It ends when the next mean alone is
too far (the rest is farther), passes over a centroid whose mean and deviation
together are too far, and measures the others exactly in whole numbers.  Bounds
are floats widened by more than their rounding, and only a bound above the best
distance rejects, so results are exact and ties go to the smaller number.

A round is one narrow map over the table: a task adds up its vectors by centroid
and sends one row for each; Spark adds those in decimals, by centroid and
component.  Only centroids travel to the tasks and their sums to the driver (k
times d numbers, fixed by the parameters).  A cluster that holds a third of all
rows, or all of them, costs what any other costs.  The table is read once a
round, its two columns only; the last assignment is written once.

Cases: vectors that are null, of another dimension, or hold null or non-finite
components take no part, nor do those too large for 64-bit distances (see
``whole_vectors``).  A null id is clustered, but never starts a centroid.  Equal
ids start in the order of their components.  Repeated rows count row by row.
Fewer vectors than ``k``: as many centroids.  No vectors: an empty result.
Inertia beyond 64 bits is null.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import core
from .whole_vectors import whole

K, ROUNDS, DIM, SEED = 8, 10, 64, "3"
#: Relative widening of the float bounds, far above their rounding error.
_SLACK = 1e-9
_FAR = np.iinfo(np.int64).max


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance, exact distances computed) of whole-number vectors."""
    n, d = vectors.shape
    k = len(centroids)
    by_mean = np.argsort(centroids.sum(axis=1), kind="stable")
    sorted_centroids = centroids[by_mean]
    c_sum, c_spread, c_norm = _measures(sorted_centroids)
    x_sum, x_spread, x_norm = _measures(vectors)
    best, who = np.full(n, _FAR), np.full(n, k)
    right = np.searchsorted(c_sum, x_sum)
    left = right - 1
    busy = np.arange(n)
    measured = 0
    while len(busy):
        low, high = left[busy], right[busy]
        down = np.where(low >= 0, x_sum[busy] - c_sum[np.maximum(low, 0)], _FAR)
        up = np.where(high < k, c_sum[np.minimum(high, k - 1)] - x_sum[busy], _FAR)
        to_left = down <= up
        at, gap = np.where(to_left, low, high), np.minimum(down, up)
        limit = best[busy].astype(np.float64) * (1 + _SLACK)
        by_gap = gap.astype(np.float64) ** 2 / d
        go_on = (gap < _FAR) & (by_gap <= limit)  # the mean inequality: what lies farther out is rejected with it
        busy, at, to_left, by_gap, limit = busy[go_on], at[go_on], to_left[go_on], by_gap[go_on], limit[go_on]
        apart = np.abs(x_spread[busy] - c_spread[at]) - _SLACK * (x_norm[busy] + c_norm[at])
        near = by_gap * (1 - _SLACK) + np.maximum(apart, 0) ** 2 <= limit  # the deviation inequality
        row, col = busy[near], at[near]
        if len(row):
            exact = ((vectors[row] - sorted_centroids[col]) ** 2).sum(axis=1)
            number = by_mean[col]
            better = (exact < best[row]) | ((exact == best[row]) & (number < who[row]))
            best[row[better]], who[row[better]] = exact[better], number[better]
            measured += len(row)
        left[busy[to_left]] -= 1
        right[busy[~to_left]] += 1
    return who, best, measured


def _measures(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sum, norm around the mean, norm) by row."""
    total, floats = x.sum(axis=1), x.astype(np.float64)
    return total, np.linalg.norm(floats - floats.mean(axis=1, keepdims=True), axis=1), np.linalg.norm(floats, axis=1)


def _start(table: DataFrame, k: int, dim: int, seed: str) -> np.ndarray:
    """The vectors of the ``k`` smallest id hashes, in their order."""
    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows, matrix in whole(batch.column(1), dim):
                flat = pa.array(matrix.ravel())
                offsets = pa.array(np.arange(0, matrix.size + 1, dim), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.ListArray.from_arrays(offsets, flat)], names=["id", "v"])

    kept = table.where("id IS NOT NULL").mapInArrow(integers, "id long, v array<long>")
    first = kept.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), "v").limit(k)
    return np.array([r.v for r in first.collect()], dtype=np.int64).reshape(-1, dim)


def _moved(table: DataFrame, centroids: np.ndarray, dim: int) -> np.ndarray:
    """The centroids after one round: exact floors of their vectors' means."""
    k = len(centroids)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, _, matrix in whole(batch.column(1), dim):
                if len(matrix):
                    who = nearest(matrix, centroids)[0]
                    order = np.argsort(who, kind="stable")
                    head = np.flatnonzero(np.diff(who[order], prepend=-1))
                    sums[who[order][head]] += np.add.reduceat(matrix[order], head, axis=0)
                    counts += np.bincount(who, minlength=k)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    parts = table.mapInArrow(add_up, "cluster int, n long, sums array<long>")
    whole_sums = parts.select("cluster", "n", F.posexplode("sums").alias("at", "s")).groupBy("cluster", "at").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    out = centroids.copy()
    for r in whole_sums.collect():  # k times dim rows
        out[r.cluster, r["at"]] = int(r.s) // r.n
    return out


def cluster(table: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, seed: str = SEED, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every usable vector, written; the centroids)."""
    spark = table.sparkSession
    table = table.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    centroids = _start(table, k, dim, seed)
    shape = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return spark.createDataFrame([], shape), centroids
    for _ in range(rounds):
        moved = _moved(table, centroids, dim)
        if (moved == centroids).all():  # every further round gives the same
            break
        centroids = moved

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows, matrix in whole(batch.column(1), dim):
                who, distance, _ = nearest(matrix, centroids)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(who, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return core.write_stage(table.mapInArrow(assign, shape), "clusters"), centroids


def op11_variance_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(core.read(spark, sf_dir, "embeddings"))
    inertia = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda v: v if v <= _FAR else None
    each = [(c, fits(s), fits(sum(inertia.values())), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sorted(inertia.items())]
    about = spark.createDataFrame(each, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # at most K rows


def sql(k: int = K, rounds: int = ROUNDS, dim: int = DIM) -> str:
    """DuckDB: every vector against every centroid in every round."""
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS INTEGER) AS cluster, v AS c FROM kept WHERE vec_id IS NOT NULL QUALIFY cluster < {k}
)"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, min(CAST(t.distance AS HUGEINT) * 1000 + t.cluster) AS m
  FROM (SELECT r, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance FROM kept, c{i}) t GROUP BY r
)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT o.cluster, coalesce(n.c, o.c) AS c FROM c{i} o LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS c
    FROM (SELECT m % 1000 AS cluster, place, sum(v[place]) AS s, count(*) AS n FROM a{i} JOIN kept USING (r), (SELECT unnest(range(1, {dim + 1})) AS place) GROUP BY ALL)
    GROUP BY cluster) n ON n.cluster = o.cluster
)""")
    return ",\n".join(steps) + f"""
SELECT vec_id, CAST(m % 1000 AS INTEGER) AS cluster, CAST(m // 1000 AS BIGINT) AS distance,
       CAST(sum(m // 1000) OVER (PARTITION BY m % 1000) AS BIGINT) AS cluster_inertia, CAST(sum(m // 1000) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} ON c{rounds}.cluster = m % 1000
"""


SQL = sql()
