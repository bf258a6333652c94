import hashlib
import random
import time
import zlib

import numpy as np
import pytest

from ledgerflow.llm import core, periodic_runs

from .helpers import awkward_texts, table, words


def brute_runs(w):
    """Every lag, every maximal stretch; a stretch keeps its smallest period."""
    n, best = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(12, 2 * q):
                best.setdefault((i, length), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in best.items())


def brute_row(doc_id, text, alter=True):
    w = words(text)
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if alter and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4),
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def sequences(seed):
    """Word sequences with runs of many kinds: nested, touching, broken by one word, of two letters, Thue-Morse, Fibonacci."""
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdefgh"
    some = lambda n: [rng.choice(letters) for _ in range(n)]
    out = [some(rng.randint(0, 300))]
    for p in (1, 2, 5, 13, 15, 16, 17, 31, 32, 33, 50, 64, 100):
        u = some(p)
        out.append(some(rng.randint(0, 20)) + u * rng.randint(2, 5) + u[: rng.randint(0, p)] + some(rng.randint(0, 20)))
    inner = (some(3) * 12 + some(2)) * 3
    out += [inner, inner + some(1) + inner, ["a"] * 400, ["a"] * 90 + ["b"] + ["a"] * 90 + ["b"] + ["a"] * 200]
    out += [["a", "b"] * 40 + ["a"] + ["a", "b"] * 40, ["a", "b", "c"] * 30 + ["a"] + ["a", "b", "c"] * 45 + some(30)]
    x, y = ["a"], ["a", "b"]
    while len(y) < 300:
        x, y = y, y + x
    out.append(y)
    out.append([("a", "b")[bin(i).count("1") % 2] for i in range(512)])
    out.append(some(40) * 6 + ["z"] + some(70) * 3)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    documents = [[w.encode() for w in d] for d in sequences(seed)]
    got = [[tuple(r) for r in runs.tolist()] for runs in periodic_runs.runs_of(documents)]
    assert got == [sorted(brute_runs(d), key=lambda r: (r[0], r[2])) for d in documents]


def test_marks_are_window_minima():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 9, 200).astype(np.uint64)
    for width in (1, 2, 7, 30):
        want = {i for a in range(len(h) - width + 1) for i in range(a, a + width) if h[i] == h[a:a + width].min()}
        assert set(periodic_runs.marks(h, width).tolist()) == want


def test_unequal_words_of_one_hash_are_seen(monkeypatch):
    """With a hash that says 'equal' too often every run is still a real one, and none that a seed touches is lost."""
    real = periodic_runs._extend
    monkeypatch.setattr(periodic_runs, "_extend", lambda items, total, x, lag: tuple(
        np.minimum(v + 5, room) for v, room in zip(real(items, total, x, lag), (x, len(items) - x - lag))))
    documents = [[w.encode() for w in d] for d in sequences(4)]
    got = [[tuple(r) for r in runs.tolist()] for runs in periodic_runs.runs_of(documents)]
    assert got == [sorted(brute_runs(d), key=lambda r: (r[0], r[2])) for d in documents]


def test_one_word_a_million_times_is_cheap():
    begin = time.perf_counter()
    one, broken = [b"a"] * 1_000_000, ([b"a"] * 999 + [b"b"]) * 300
    runs = periodic_runs.runs_of([one, broken])
    assert runs[0].tolist() == [[0, 1_000_000, 1]]
    assert [0, 300_000, 1000] in runs[1].tolist() and len(runs[1]) == 301
    assert time.perf_counter() - begin < 60


def test_query_on_awkward_table(spark, tmp_path):
    texts = awkward_texts() + [" ".join(d) for d in sequences(2)[:12]] + ["la " * 500, None]
    ids = [None, *range(len(texts) - 3), 5, 5]
    docs = table(spark, texts, ids)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in periodic_runs.op13_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((brute_row(i, t) for i, t in zip(ids, texts)), key=str)
    assert any(r[1] for r in got) and any(zlib.crc32(str(i).encode()) % 10 == 0 for i in ids)
    plain = sorted((tuple(r) for r in periodic_runs.detect(docs).collect()), key=str)
    assert plain == sorted((brute_row(i, t, alter=False) for i, t in zip(ids, texts)), key=str)
    assert periodic_runs.detect(table(spark, [])).count() == 0


def test_batches_do_not_change_results(spark, monkeypatch):
    core.ship(spark)
    texts = [" ".join(d) for s in (1, 2) for d in sequences(s)]
    docs = table(spark, texts, extra=False).coalesce(1)
    whole = sorted(map(tuple, periodic_runs.detect(docs, alter=periodic_runs.respell).collect()))
    each = sorted(map(tuple, periodic_runs.detect(docs.repartition(len(texts)), alter=periodic_runs.respell).collect()))
    assert whole == each and len(whole) == len(texts)
