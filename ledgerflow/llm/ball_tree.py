"""Operator 12: exact top-k inner products by ball trees, branch and bound.

Candidates are dealt to shards; each shard builds one ball tree, which is written.
For a query q and a ball of centre c and radius r no point scores above
q.c + |q| r.  A block of queries walks a shard's tree together: nodes are taken
in the order of their largest upper bound, a query leaves a node whose bound is
below its k-th score so far, a node without queries is not opened, and leaves
are scored in whole numbers.

The current k-th score is shared across shards: shards are searched in waves of
1, 8, 64, ... ; after a wave the best of each query are merged, and the next wave
starts from their k-th score.  So all waves but the first mostly confirm, and
send back only what may still enter a list.  There are about log8 of the shards
waves, each written, which is also what a lost executor goes back to.

Every query block must meet every shard, so both are repeated once for each block
of the other side, as any exact search over all pairs must; block and shard sizes
are fixed.  Bounds are floats widened by more than their rounding; only a bound
below the k-th score rejects, so ties are decided by id and results are exact.

Cases: vectors that are null or hold null or non-finite components, null ids and
vectors too large for 64-bit scores (see ``whole_vectors``) take no part; zero
vectors do.  Vectors of different dimension do not meet; empty ones meet each
other with score 0.  A query never meets rows of its own id.  Equal rows (id and
numbers) are one query and as many candidates as there are (of which a list can
hold ``k``), and are put together before they are dealt, so a row repeated
without end is one entry a batch.  Other rows of one id spread by their numbers.
Fewer candidates than ``k``: all; none: no row.  An empty table gives an empty
result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import core
from .whole_vectors import whole

K, EVERY = 10, 100
#: Bytes of a shard's vectors, rows of a query block, queries that walk a tree together, points of a leaf, growth of a wave.
SHARD_BYTES, QUERY_BLOCK, WALK, LEAF, GROW = 4 << 20, 4096, 64, 64, 8

_U = np.uint64
_SLACK = 1e-9
_NONE = np.iinfo(np.int64).min + 1  # its negative is a number, too
_EXACT = float(1 << 53)


class Tree:
    """Ball tree over whole-number points; arrays only, nodes in the order in which they were split."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        self.low, self.high, self.child, centres, self.radius = [], [], [], [], []
        todo = [(0, len(ids), -1)]
        while todo:
            low, high, parent = todo.pop()
            mine = points[order[low:high]].astype(np.float64)
            centre = mine.mean(axis=0)
            far = np.linalg.norm(mine - centre, axis=1)
            node = len(self.low)
            if parent >= 0:
                self.child[parent] = (*self.child[parent], node)
            self.low.append(low), self.high.append(high), self.child.append(()), centres.append(centre), self.radius.append(far.max())
            if high - low > leaf:
                a = mine[far.argmax()]
                b = mine[np.linalg.norm(mine - a, axis=1).argmax()]
                middle = (high - low) // 2
                order[low:high] = order[low:high][np.argpartition(mine @ (b - a), middle)]
                todo += [(low, low + middle, node), (low + middle, high, node)]
        self.ids = ids[order]
        self.points = points[order]
        if not self.points.size or np.abs(self.points).max() < 1 << 31:
            self.points = self.points.astype(np.int32)
        self.centre, self.radius = np.array(centres), np.array(self.radius)
        # what float rounding may take from a bound, for a query of norm 1
        self.reach = self.radius + _SLACK * (np.linalg.norm(self.centre, axis=1) + self.radius)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores of each row, ties to smaller ids."""
    order = np.lexsort((ids, -scores), axis=-1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def search(tree: Tree, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row of the query, candidate id, score) of all that may be among a query's ``k`` best, and the points scored.

    ``floor``: the k-th score known from elsewhere; lower scores are not returned.
    """
    out, scored = [], 0
    norms = np.linalg.norm(queries.astype(np.float64), axis=1)
    biggest = np.linalg.norm(tree.points.astype(np.float64), axis=1).max(initial=0) * norms.max(initial=0)
    kind = np.float64 if biggest < _EXACT else np.int64  # floats add whole numbers exactly below 2**53
    points = tree.points.astype(kind)
    for a in range(0, len(queries), WALK):
        own, q, norm = query_ids[a:a + WALK], queries[a:a + WALK].astype(kind), norms[a:a + WALK]
        qf = q.astype(np.float64)
        least = floor[a:a + WALK].copy()
        scores, near = np.full((len(q), k), _NONE), np.zeros((len(q), k), np.int64)

        def bound(node: int, rows: np.ndarray) -> np.ndarray:
            return qf[rows] @ tree.centre[node] + norm[rows] * tree.reach[node]

        every = np.arange(len(q))
        first = bound(0, every)
        heap = [(-first.max(), 0, every, first)]
        while heap:
            _, node, rows, limit = heapq.heappop(heap)
            rows = rows[limit >= least[rows]]
            if not len(rows):
                continue
            if tree.child[node]:
                for child in tree.child[node]:
                    limit = bound(child, rows)
                    keep = limit >= least[rows]
                    if keep.any():
                        heapq.heappush(heap, (-limit[keep].max(), child, rows[keep], limit[keep]))
                continue
            part = slice(tree.low[node], tree.high[node])
            got = (q[rows] @ points[part].T).astype(np.int64)
            scored += got.size
            got[(own[rows][:, None] == tree.ids[None, part]) | (got < least[rows][:, None])] = _NONE
            some = (got > _NONE).any(axis=1)
            rows, got = rows[some], got[some]
            if len(rows):
                ids = np.broadcast_to(tree.ids[part], got.shape)
                scores[rows], near[rows] = _best(np.concatenate([scores[rows], got], axis=1), np.concatenate([near[rows], ids], axis=1), k)
                least[rows] = np.maximum(least[rows], scores[rows, -1])
        row, col = np.nonzero(scores > _NONE)
        out.append((row + a, near[row, col], scores[row, col]))
    return (*(np.concatenate(x) for x in zip(*out)), scored)


def _dealt(table: DataFrame, shards: int, blocks: int, every: int) -> DataFrame:
    """(role, dim, part, payload): distinct rows of each batch with their counts, by shard and by query block."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            known = batch.filter(batch.column(0).is_valid())
            ids = known.column(0).to_numpy()
            for dim, rows, matrix in whole(known.column(1)):
                own, count = np.unique(np.column_stack([ids[rows], matrix]), axis=0, return_counts=True)
                spread = np.zeros(len(own), dtype=_U)
                for j in range(dim + 1):
                    spread = core.mix(spread * _U(31) + own[:, j].astype(_U) + _U(j + 1))
                for role, parts, pick in (("c", shards, np.ones(len(own), bool)), ("q", blocks, own[:, 0] % every == 0)):
                    part = ((spread if role == "c" else core.mix(spread + _U(1))) % _U(parts)).astype(np.int64)
                    for p in np.unique(part[pick]).tolist():
                        mine = pick & (part == p)
                        out.append((role, dim, p, pickle.dumps((own[mine], count[mine]), 5)))
            columns = zip(*out) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int32(), pa.binary()))], names=["role", "dim", "part", "payload"])

    return table.mapInArrow(deal, "role string, dim int, part int, payload binary")


def top(table: DataFrame, k: int = K, every: int = EVERY, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each row whose id is divisible by ``every``."""
    table = table.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    rows, size, asked = table.agg(F.count("*"), F.sum(F.size("v").cast("long")), F.count_if(F.col("id") % every == 0)).first()
    spare = table.sparkSession.sparkContext.defaultParallelism
    shards = max(1, math.ceil(4 * max(size or 0, 0) / SHARD_BYTES), min(spare, math.ceil(rows / (16 * LEAF))))
    blocks = max(1, math.ceil(asked / QUERY_BLOCK))

    def pack(_key: tuple, part: pa.Table) -> pa.Table:
        held = [pickle.loads(p) for p in part.column("payload").to_pylist()]
        own, inverse = np.unique(np.concatenate([h[0] for h in held]), axis=0, return_inverse=True)
        count = np.bincount(inverse.ravel(), weights=np.concatenate([h[1] for h in held])).astype(np.int64)
        role, dim, number = (x.as_py() for x in _key)
        if role == "c":
            own = np.repeat(own, np.minimum(count, k), axis=0)  # a list has room for k of equal rows
            made = Tree(own[:, 0], own[:, 1:])
        else:
            made = (own[:, 0], own[:, 1:])
        return pa.table({"role": [role], "dim": pa.array([dim], pa.int32()), "part": pa.array([number], pa.int32()), "payload": pa.array([pickle.dumps(made, 5)], pa.binary())})

    packed = core.write_stage(_dealt(table, shards, blocks, every).groupBy("role", "dim", "part").applyInArrow(pack, "role string, dim int, part int, payload binary"), "ball-trees")
    trees = packed.where("role = 'c'").select("dim", F.col("part").alias("shard"), "payload")
    queries = packed.where("role = 'q'").select("dim", F.col("part").alias("block"), "payload")

    def look(_key: tuple, pair: pa.Table) -> pa.Table:
        at = {r: i for i, r in enumerate(pair.column("role").to_pylist())}
        found: tuple = ([],) * 4
        if len(at) == 2:
            tree = pickle.loads(pair.column("payload")[at["c"]].as_py())
            query_ids, matrix = pickle.loads(pair.column("payload")[at["q"]].as_py())
            floor = np.full(len(query_ids), _NONE)
            known = pair.column("known")[at["q"]].as_py() or []
            floor[[x["row"] for x in known]] = [x["kth"] for x in known]
            row, near, score, _ = search(tree, query_ids, matrix, floor, k)
            found = (row, query_ids[row], near, score)
        n = len(found[0])
        head = {"dim": pa.array([_key[0].as_py()] * n, pa.int32()), "block": pa.array([_key[2].as_py()] * n, pa.int32())}
        return pa.table(head | {c: pa.array(v, pa.int32() if c == "row" else pa.int64()) for c, v in zip(("row", "query_id", "vec_id", "score"), found)})

    hits = "dim int, block int, row int, query_id long, vec_id long, score long"
    rank = F.row_number().over(Window.partitionBy("dim", "block", "row").orderBy(F.desc("score"), "vec_id"))
    best = None
    done, wave = 0, 1
    while done < shards:
        end = min(shards, done + wave)
        known = queries.withColumn("known", F.lit(None).cast("array<struct<row:int,kth:long>>"))
        if best is not None:
            full = best.groupBy("dim", "block", "row").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") == k)
            floors = full.groupBy("dim", "block").agg(F.collect_list(F.struct("row", "kth")).alias("known"))  # a block's rows at most
            known = queries.join(floors, ["dim", "block"], "left")
        asks = known.select(F.lit("q").alias("role"), "dim", F.explode(F.sequence(F.lit(done), F.lit(end - 1))).alias("shard"), "block", "payload", "known")
        opened = trees.where(F.col("shard").between(done, end - 1)).select(
            F.lit("c").alias("role"), "dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "payload", F.lit(None).cast("array<struct<row:int,kth:long>>").alias("known"))
        found = asks.unionByName(opened).groupBy("dim", "shard", "block").applyInArrow(look, hits)
        found = found if best is None else best.unionByName(found)
        best = core.write_stage(found.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank"), "ball-best")
        done, wave = end, wave * GROW
    return best.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score")


def op12_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top(core.read(spark, sf_dir, "embeddings"))


#: DuckDB: every query against every row.
SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, q.e, c.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 100 = 0) q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, e ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""
