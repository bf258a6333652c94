"""Operator 6: nearest neighbours by a block matrix join.

Vectors are quantised to int8 with one scale each; the norm of what rounding
lost is kept.  Queries and candidates are dealt to blocks, and every query block
meets every candidate block in one tile: the int8 product gives each inner
product up to a bound, |x.y - x'.y'| <= |x||y - y'| + |x - x'||y'|.  A pair
survives if its upper bound reaches the query's k-th best lower bound so far;
survivors are recomputed from the original floats in double precision, and the
tiles' lists are merged per query with a heap.  The result is exact.

The query set (ids divisible by ``every``) meets all rows, block by block: a
tile's size is fixed, whatever the table.  Blocks are dealt by a hash of the
id, so equal vectors spread.

Cases: null ids, null or zero vectors and vectors with null or non-finite
components take no part.  Vectors of different dimension do not meet.  A query
never meets rows of its own id; other repeated ids count row by row.  Ties go
to the smaller id.  Fewer candidates than ``k``: all of them.  An empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import core

K, EVERY = 20, 20
#: Rows of a query block, of a candidate block, and of the pieces multiplied at a time.
QUERY_BLOCK, CANDIDATE_BLOCK = 4096, 32768
_ROWS, _COLS, _SLICE = 256, 4096, 256

_BLOCK = "role string, dim int, qb int, cb int, payload binary"
RESULT = "query_id long, rank int, vec_id long, score double"


def vectors(ids: pa.Array, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, ids, matrix) of the usable vectors of a batch."""
    column = column.cast(pa.list_(pa.float64()))
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    known = pc.is_valid(ids).to_numpy(zero_copy_only=False)
    for dim in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero((size == dim) & known)
        flat = column.take(pa.array(rows)).flatten()
        matrix = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)  # null components become NaN
        good = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
        yield dim, ids.take(pa.array(rows)).to_numpy()[good], matrix[good]


def quantise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 values, scale, norm of the original, norm of the rounding loss), by row."""
    scale = np.abs(matrix).max(axis=1) / 127
    scale = np.maximum(scale, np.finfo(float).tiny)
    small = np.rint(matrix / scale[:, None])
    loss = np.linalg.norm(matrix - small * scale[:, None], axis=1)
    return small.astype(np.int8), scale, np.linalg.norm(matrix, axis=1), loss


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, summed in order of the components."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, candidates: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the query, candidate id, score): the ``k`` nearest of one tile for each query, nearest first."""
    kind = np.float32 if queries.shape[1] * 127 * 127 < 1 << 24 else np.float64  # whole numbers stay exact
    q8, q_scale, q_norm, q_loss = quantise(queries)
    c8, c_scale, c_norm, c_loss = quantise(candidates)
    c_near = c_norm + c_loss  # bounds the norm of the rounded vector
    q8, c8 = q8.astype(kind), c8.astype(kind)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a in range(0, len(queries), _ROWS):
        rows = slice(a, a + _ROWS)
        m = len(q8[rows])
        best = np.full((m, k), -np.inf)
        found_row, found_col = [], []
        for b in range(0, len(candidates), _COLS):
            cols = slice(b, b + _COLS)
            near = (q8[rows] @ c8[cols].T).astype(np.float64) * q_scale[rows, None] * c_scale[None, cols]
            slack = q_norm[rows, None] * c_loss[None, cols] + q_loss[rows, None] * c_near[None, cols]
            slack += 1e-12 * (1 + q_norm[rows, None] * c_norm[None, cols])
            own = query_ids[rows, None] == ids[None, cols]
            near[own] = -np.inf
            best = np.partition(np.concatenate([best, near - slack], axis=1), -k, axis=1)[:, -k:]
            row, col = np.nonzero((near + slack >= best.min(axis=1)[:, None]) & ~own)
            found_row.append(row)
            found_col.append(col + b)
        row, col = np.concatenate(found_row), np.concatenate(found_col)
        score = inner(queries[rows][row], candidates[col])
        order = np.lexsort((ids[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        top = place < k
        out.append((row[top] + a, ids[col[top]], score[top]))
    return tuple(np.concatenate(x) for x in zip(*out))


def nearest(table: DataFrame, k: int = K, every: int = EVERY, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest inner product for each row whose id is divisible by ``every``."""
    rows, asked = table.agg(F.count("*"), F.count_if(F.col(key) % every == 0)).first()
    spare = table.sparkSession.sparkContext.defaultParallelism
    query_blocks = max(1, math.ceil(asked / QUERY_BLOCK))
    blocks = max(1, math.ceil(rows / CANDIDATE_BLOCK), min(spare, math.ceil(rows / _COLS)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for dim, ids, matrix in vectors(batch.column(0).cast(pa.int64()), batch.column(1)):
                spread = core.mix(ids.astype(np.uint64))
                query = ids % every == 0
                for role, part, count, pick in (("c", spread, blocks, np.ones(len(ids), bool)), ("q", spread >> np.uint64(20), query_blocks, query)):
                    block = (part % np.uint64(count)).astype(np.int64)
                    for b in np.unique(block[pick]).tolist():
                        mine = pick & (block == b)
                        out.append((role, dim, b if role == "q" else None, b if role == "c" else None, pickle.dumps((ids[mine], matrix[mine].astype(np.float32) if single else matrix[mine]), 5)))
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            columns = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["role", "dim", "qb", "cb", "payload"])

    single = "float" in table.schema[vector].dataType.simpleString()
    dealt = table.select(F.col(key), F.col(vector)).mapInArrow(deal, _BLOCK)
    # both sides go to every block of the other side: the grid of tiles
    grid = dealt.select(
        "role", "dim", "payload",
        F.explode(F.when(F.col("role") == "c", F.sequence(F.lit(0), F.lit(query_blocks - 1))).otherwise(F.array("qb"))).alias("qb"), "cb",
    ).select("role", "dim", "payload", "qb", F.explode(F.when(F.col("role") == "q", F.sequence(F.lit(0), F.lit(blocks - 1))).otherwise(F.array("cb"))).alias("cb"))

    def multiply(_key: tuple, table: pa.Table) -> pa.Table:
        sides = {"q": [], "c": []}
        for role, payload in zip(table.column("role").to_pylist(), table.column("payload").to_pylist()):
            sides[role].append(pickle.loads(payload))
        out = []
        if sides["q"] and sides["c"]:
            (query_ids, queries), (ids, candidates) = ([np.concatenate(x) for x in zip(*sides[r])] for r in "qc")
            turn = np.argsort(query_ids, kind="stable")  # the same order in every tile of the block
            query_ids, queries = query_ids[turn], queries[turn]
            row, near, score = tile(query_ids, queries.astype(np.float64), ids, candidates.astype(np.float64), k)
            for a in range(0, len(query_ids), _SLICE):
                at = slice(*np.searchsorted(row, [a, a + _SLICE]))
                out.append((a // _SLICE, pickle.dumps((query_ids[a:a + _SLICE], row[at] - a, near[at], score[at]), 5)))
        return pa.table({
            "dim": pa.array([_key[0].as_py()] * len(out), pa.int32()), "qb": pa.array([_key[1].as_py()] * len(out), pa.int32()),
            "part": pa.array([x for x, _ in out], pa.int32()), "payload": pa.array([x for _, x in out], pa.binary()),
        })

    def merge(_key: tuple, table: pa.Table) -> pa.Table:
        lists: list[list] = []
        for payload in table.column("payload").to_pylist():
            query_ids, row, near, score = pickle.loads(payload)
            cut = np.searchsorted(row, np.arange(len(query_ids) + 1))
            lists = lists or [[] for _ in query_ids]
            for i in range(len(query_ids)):
                at = slice(cut[i], cut[i + 1])
                lists[i].append(list(zip((-score[at]).tolist(), near[at].tolist())))
        found = []
        for query, own in zip(query_ids.tolist(), lists):
            for rank, (score, vec) in enumerate(heapq.nsmallest(k, heapq.merge(*own)), 1):
                found.append((query, rank, vec, -score))
        columns = list(zip(*found)) if found else [[]] * 4
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.float64())], names=["query_id", "rank", "vec_id", "score"])

    tiles = grid.groupBy("dim", "qb", "cb").applyInArrow(multiply, "dim int, qb int, part int, payload binary")
    return tiles.groupBy("dim", "qb", "part").applyInArrow(merge, RESULT)


def op6_block_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(core.read(spark, sf_dir, "embeddings"))


#: DuckDB: every query against every row, summed in order of the components.
SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_reduce(list_prepend(0.0::DOUBLE, list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), lambda a, b: a + b) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""
