import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerflow.llm import core, cover_dedup, suffix_dedup

from .helpers import awkward_texts, table, words


@pytest.fixture(autouse=True)
def small_groups(monkeypatch, spark):
    core.ship(spark)
    monkeypatch.setattr(core, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(core, "GROUP_BYTES", 4000)


def test_windows_match_brute_force(spark):
    texts = awkward_texts()
    got = {r.doc_id: r for r in cover_dedup.remove_repeats(table(spark, texts)).collect()}
    first = {}
    for i, t in enumerate(texts):
        w = words(t)
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k:k + 13]), i)
    for i, t in enumerate(texts):
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < i:
                gone[k:k + 13] = [True] * 13
        assert (got[i].n_words, got[i].n_removed) == (len(w), sum(gone)), i
        assert got[i].kept_text == " ".join(x for x, g in zip(w, gone) if not g)
    assert sum(r.n_removed for r in got.values()) > 100


def test_bytes_match_brute_force(spark):
    texts = awkward_texts()
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(table(spark, texts)).collect()}
    seen = set()
    for i, t in enumerate(texts):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            if b[k:k + 100] in seen:
                gone[k:k + 100] = b"\1" * 100
            seen.add(b[k:k + 100])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, bytes(got[i].kept)) == (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept), i


def test_rewrite_keeps_columns_and_whole_characters(spark):
    texts = ["é" * 80, "é" * 80 + "x", "a" + "日本" * 40]
    docs = table(spark, texts)
    out = {r.doc_id: r for r in suffix_dedup.rewrite(docs).collect()}
    assert out[0].asDict().keys() == dict(zip(docs.columns, docs.columns)).keys() and out[0].kept == "x"
    assert all("�" not in r.text for r in out.values()) and out[1].text.endswith("x")


@pytest.mark.parametrize("operator", [cover_dedup.remove_repeats, suffix_dedup.remove_repeats])
def test_empty_table_and_repeated_or_null_ids(spark, operator):
    assert operator(table(spark, [])).count() == 0
    long = " ".join(f"w{i}" for i in range(40))
    rows = operator(table(spark, [long, long, long], ids=[5, 5, None])).collect()
    assert len(rows) == 3
    assert sorted(r.n_removed > 0 for r in rows if r.doc_id is None) == [False]  # a null id comes first
    assert all(r.n_removed > 0 for r in rows if r.doc_id == 5)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab", max_size=60))
def test_longest_previous_factor(text):
    data = text.encode()
    expect = [max((next((k for k in range(len(data) - i + 1) if k == len(data) - i or data[i + k] != data[j + k]), 0) for j in range(i)), default=0) for i in range(len(data))]
    assert suffix_dedup.lpf(data).tolist() == expect


def test_suffix_ranks_order_by_prefix():
    data = np.frombuffer(b"banana$bandana", dtype=np.uint8)
    rank = suffix_dedup.suffix_ranks(data, np.full(len(data), len(data)), 3)
    keys = [bytes(data[i:i + 3]) for i in range(len(data))]
    assert [sorted(set(keys)).index(k) for k in keys] == (rank - 1).tolist()


def test_hash_of_digest_columns(spark):
    out = cover_dedup.remove_repeats(table(spark, [None, "a  b"])).collect()
    assert {hashlib.sha256(r.kept_text.encode()).hexdigest() for r in out} == {hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"a b").hexdigest()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=30), min_size=1, max_size=4), st.integers(1, 12))
def test_previous_factors_are_the_lpf_array(texts, length):
    """What the main path takes for 'occurs earlier' is the longest previous factor cut at the length, over all texts in turn."""
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *map(len, texts)])
    ends = np.repeat(offsets[1:], np.diff(offsets))
    whole = np.flatnonzero(np.arange(len(data)) + length <= ends) if len(data) else np.empty(0, np.int64)
    rank = suffix_dedup.suffix_ranks(np.frombuffer(data, np.uint8), ends, length)
    lead, group, later = suffix_dedup.previous_factors(rank[whole])
    windows = [data[i:i + length] for i in whole]
    assert later.tolist() == [w in windows[:k] for k, w in enumerate(windows)]
    assert sorted(lead.tolist()) == [k for k, gone in enumerate(later) if not gone]
    assert all(windows[lead[g]] == w for g, w in zip(group, windows))
    if len(texts) == 1:
        assert later.tolist() == (suffix_dedup.lpf(data, length)[whole] >= length).tolist()


def test_ranks_of_long_repeats_and_zero_bytes():
    rng = np.random.default_rng(1)
    data = np.concatenate([rng.integers(0, 3, 500), np.zeros(300), np.tile(rng.integers(0, 256, 60), 9)]).astype(np.uint8)
    for ends in (np.full(len(data), len(data)), np.repeat([400, 900, len(data)], [400, 500, len(data) - 900])):
        for length in (1, 7, 8, 50, 100):
            keys = [(bytes(data[i:min(i + length, e)])) for i, e in enumerate(ends.tolist())]
            rank = suffix_dedup.suffix_ranks(data, ends, length)
            assert [sorted(set(keys)).index(k) + 1 for k in keys] == rank.tolist()


def test_rewrite_of_columns_that_cannot_be_null(spark):
    from pyspark.sql import functions as F
    docs = spark.range(3).select(F.col("id").alias("doc_id"), F.lit(" ".join(f"w{i}" for i in range(60))).alias("text"), F.lit(7).alias("n"), F.array(F.lit(1)).alias("list"), F.struct(F.lit(2).alias("a")).alias("inner"))
    rows = sorted(suffix_dedup.rewrite(docs).collect())
    assert [(r.doc_id, len(r.text), r.n, r.list, r.inner.a) for r in rows] == [(0, 229, 7, [1], 2), (1, 0, 7, [1], 2), (2, 0, 7, [1], 2)]
