import hashlib
import math

import duckdb
import numpy as np
import pytest

from ledgerflow.llm import ball_tree, core, variance_kmeans

DIM = 64


def rows_of(seed=1, n=200, extra=True):
    """Vectors in bunches, ties, equal rows, odd ones; columns with clashing names."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(5, DIM))
    rows = [(i, (middle[i % 5] + 0.2 * rng.normal(size=DIM)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)]
    if extra:
        rows += [(300, None), (400, [0.0] * DIM), (500, [1.0, None] * 32), (600, [math.nan] * DIM), (700, [math.inf] * DIM), (800, [1.0, 2.0]), (801, [3.0, -4.0])]
        rows += [(900, []), (901, []), (None, rows[0][1]), (5, rows[7][1]), (100, rows[9][1]), (100, rows[100][1]), (1100, [1e30] * DIM), (1200, [-0.5] * DIM)]
        rows += [(7, rows[7][1])] * 15
    return rows


def table(spark, rows):
    clash = ["id", "v", "cluster", "distance", "role", "part", "payload", "rank", "score", "shard", "block"]
    return spark.createDataFrame([(*r, *["x"] * len(clash)) for r in rows], "vec_id long, embedding array<float>, " + ", ".join(f"{c} string" for c in clash)).repartition(3)


def integers(v, dim=None):
    if v is None or None in v or (dim is not None and len(v) != dim) or not all(map(math.isfinite, v)):
        return None
    e = [math.floor(1024 * float(np.float32(x))) for x in v]
    return e if sum(x * x for x in e) < 2**60 else None


def brute_clusters(rows, k=8, rounds=10):
    kept = [(i, e) for i, v in rows if (e := integers(v, DIM)) is not None]
    start = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), e) for i, e in kept if i is not None)[:k]
    centroids = [e for _, e in start]
    near = lambda e: min((sum((a - b) ** 2 for a, b in zip(e, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups = [[] for _ in centroids]
        for _, e in kept:
            groups[near(e)[1]].append(e)
        centroids = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, centroids)]
    last = [(i, *near(e)) for i, e in kept]
    total = sum(d for _, d, _ in last)
    return sorted(((i, j, d, sum(d2 for _, d2, j2 in last if j2 == j), total, hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for i, d, j in last), key=str)


@pytest.mark.parametrize("n", [0, 3, 200])
def test_clusters_equal_brute_force(spark, tmp_path, n):
    rows = rows_of(n=200)[:n] if n < 200 else rows_of()
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = variance_kmeans.op11_variance_kmeans(spark, str(tmp_path))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] or n == 0
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_clusters(rows)


def test_search_is_exact_and_rejects():
    rng = np.random.default_rng(2)
    for spread in (1, 50, 2000, 2**24):
        c = rng.integers(-spread, spread + 1, (40, DIM)) + rng.integers(-spread, spread + 1, (40, 1)) * 3
        c[7] = c[3]
        x = np.concatenate([c[rng.integers(0, 40, 300)] + rng.integers(-spread // 4 - 1, spread // 4 + 2, (300, DIM)), c])
        who, best, measured = variance_kmeans.nearest(x, c)
        every = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        assert (best == every.min(axis=1)).all() and (who == every.argmin(axis=1)).all()
        assert measured < every.size / 2


def brute_top(rows, k=10, every=100):
    usable = [(i, e) for i, v in rows if i is not None and (e := integers(v)) is not None]
    out = []
    for q, a in sorted({(i, tuple(e)) for i, e in usable if i % every == 0}):
        near = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q and len(b) == len(a))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(near[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_top_equals_brute_force(spark, monkeypatch, tmp_path, small):
    if small:  # many shards, waves, blocks and nodes
        for name, value in (("SHARD_BYTES", 4000), ("QUERY_BLOCK", 2), ("GROW", 3), ("EVERY", 100)):
            monkeypatch.setattr(ball_tree, name, value)
    rows = rows_of(seed=3, n=420)
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert sorted(tuple(r) for r in ball_tree.op12_ball_tree(spark, str(tmp_path)).collect()) == brute_top(rows)


def test_top_of_nothing(spark):
    core.ship(spark)
    assert ball_tree.top(table(spark, [])).count() == 0
    assert ball_tree.top(table(spark, [(100, [1.0, 2.0])])).count() == 0
    assert [tuple(r) for r in ball_tree.top(table(spark, [(100, [1.0, 2.0]), (1, [1.0, 0.0])])).collect()] == [(100, 1, 1, 1024 * 1024)]


def test_balls_bound_and_prune():
    rng = np.random.default_rng(5)
    for scale in (300, 2**27):  # floats stay exact for the first; the second is scored in integers
        middle = rng.integers(-scale, scale, (20, 16))
        points = middle[rng.integers(0, 20, 3000)] + rng.integers(-scale // 50, scale // 50, (3000, 16))
        ids = rng.permutation(3000)
        tree = ball_tree.Tree(ids, points)
        for node in range(len(tree.low)):
            inside = tree.points[tree.low[node]:tree.high[node]]
            assert (np.linalg.norm(inside - tree.centre[node], axis=1) <= tree.reach[node]).all()
        queries = points[:100]
        row, near, score, scored = ball_tree.search(tree, ids[:100], queries, np.full(100, ball_tree._NONE), 10)
        every = queries.astype(object) @ points.T.astype(object)
        for q in range(100):
            want = sorted((-int(s), int(i)) for s, i in zip(every[q], ids) if i != ids[q])[:10]
            assert sorted((-int(s), int(i)) for r, i, s in zip(row, near, score) if r == q) == want
        assert scored < every.size / 2
        floor = np.array([sorted(map(int, every[q]))[-10] for q in range(100)])
        assert ball_tree.search(tree, ids[:100], queries, floor, 10)[3] < scored


def test_statements_equal_duckdb(spark, tmp_path):
    rows = [r for r in rows_of(seed=6, n=320) if r[0] != 1100]
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    for query, statement in ((variance_kmeans.op11_variance_kmeans, variance_kmeans.SQL), (ball_tree.op12_ball_tree, ball_tree.SQL)):
        got = query(spark, str(tmp_path))
        want = duck.execute(statement).fetchall()
        assert got.columns == [c[0] for c in duck.description]
        assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
