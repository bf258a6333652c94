import numpy as np
import pytest

from ledgerflow.llm import core, trie_join

from .helpers import LOWER, awkward_texts, table, words


def brute(texts, ids, n, percent):
    sets = []
    for t in texts:
        w = words((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in zip(ids, sets):
        for j, b in zip(ids, sets):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in zip(ids, sets)}


def family(seed, copies, length=60):
    rng = np.random.default_rng(seed)
    base = [f"w{x}" for x in rng.integers(0, 10**6, length)]
    out = []
    for _ in range(copies):
        w = list(base)
        for at in rng.integers(0, length, rng.integers(0, 5)):
            w[at] = f"e{rng.integers(0, 10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (1, 50)])
def test_components_match_brute_force(spark, monkeypatch, n, percent):
    monkeypatch.setattr(core, "GROUP_BYTES", 6000)
    monkeypatch.setattr(core, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(trie_join, "BLOCK", 8)  # clusters are cut into blocks
    core.ship(spark)
    texts = awkward_texts() + family(1, 40) + family(2, 25, 15) + ["ONE", "a B C d"]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in trie_join.join(table(spark, texts), n, percent).collect()}
    assert got == brute(texts, list(range(len(texts))), n, percent)


def test_empty_table_null_and_repeated_ids(spark):
    core.ship(spark)
    assert trie_join.join(table(spark, [])).count() == 0
    rows = trie_join.join(table(spark, ["a b c d e", "a b c d e", "p q r s", "a b c d e"], ids=[7, None, 7, 3])).collect()
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in rows)
    assert got == [(-1, -1), (3, 3), (7, 3), (7, 3)]


def test_tree_walk_finds_all_links():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(60):
        base = np.arange(100, dtype=np.uint64) if rng.random() < 0.5 else np.arange(50, 130, dtype=np.uint64)
        s = set(rng.permutation(base)[: rng.integers(60, len(base) + 1)].tolist())
        sets.append(np.array(sorted(s), dtype=np.uint64))
    sets = list({s.tobytes(): s for s in sets}.values())
    tree = trie_join.PrefixTree(sets)
    for q in range(len(sets)):
        a = set(sets[tree.rows[q]].tolist())
        expect = {r for r in range(len(sets)) if r != q and 100 * len(a & (b := set(sets[tree.rows[r]].tolist()))) >= 80 * len(a | b)}
        assert set(tree.walk(q, 80).tolist()) == expect
