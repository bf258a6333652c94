import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerflow.llm import bloom_lm, bpe, core, fingerprint, weak_labels

from .helpers import LOWER, awkward_texts, table, words

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    with open(RANKS, "rb") as f:
        return bpe.encoder(f.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference_encoder(encoder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.transducer.ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=80))
def test_encoding_equals_the_library_and_round_trips(encoder, reference_encoder, text):
    ids = encoder(text)
    assert ids.tolist() == reference_encoder.encode_ordinary(text)
    assert "".join(bpe.decode_stream(ids, encoder.transducer.token, block=1)) == text


def test_encoding_of_merge_heavy_pieces(encoder, reference_encoder, monkeypatch):
    monkeypatch.setattr(bpe, "KEEP", 500)  # the stores start anew in between
    rng = random.Random(5)
    for _ in range(400):
        text = " " + "".join(rng.choice(["ing", "tion", "aaa", "the", "XQ", "==", "  ", "\n", "'s", "é", "日本"]) for _ in range(rng.randint(0, 40)))
        assert encoder(text).tolist() == reference_encoder.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(data=st.binary(max_size=30), cut=st.integers(0, 30))
def test_utf8_stream_equals_whole_decoding(data, cut):
    stream = bpe.Utf8Stream()
    assert stream.feed(data[:cut]) + stream.feed(data[cut:]) + stream.finish() == data.decode("utf-8", "replace")


def test_bpe_query_columns(spark, reference_encoder):
    core.ship(spark)
    texts = awkward_texts()
    for r in bpe.digests(table(spark, texts)).collect():
        ids = reference_encoder.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    assert bpe.digests(table(spark, [])).count() == 0
    assert [r.token_ids for r in bpe.encode(table(spark, [None, "hi"]), RANKS, public_tokenizers.PATTERN).orderBy("doc_id").collect()][0] == []


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def test_fingerprints_of_texts_and_edited_texts(spark, monkeypatch):
    monkeypatch.setattr(core, "GROUP_BYTES", 3000)
    core.ship(spark)
    texts = awkward_texts()
    ids = [3 * i - 10 for i in range(len(texts))]
    got = {r.doc_id: r for r in fingerprint.edited_pairs(table(spark, texts, ids)).collect()}
    assert len(got) == len(texts)
    like = lambda a, b: 1.0 if not a and not b else len(a & b) / len(a | b)
    for k, i in enumerate(ids):
        own, nxt = texts[k] or "", texts[(k + 1) % len(texts)] or ""
        half = len(own) // 2
        edited = own[:len(own) - half] + nxt[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        tolerance = 0.15 if max(len(shingles(own)), len(shingles(nxt)), len(shingles(edited))) > fingerprint.K / 2 else 1e-9
        assert abs(r.near_edited - like(shingles(own), shingles(edited))) <= tolerance
        assert abs(r.near_next - like(shingles(own), shingles(nxt))) <= tolerance
    assert len({r.fingerprint for r in got.values()}) == len({frozenset(shingles(t or "")) for t in texts})


def test_fingerprints_merge_and_estimate(spark):
    core.ship(spark)
    rng = random.Random(2)
    make = lambda k: " ".join(str(rng.randint(0, 10**9)) for _ in range(k))
    a, b = make(3000), make(2000)
    docs = spark.createDataFrame([(1, "x", a), (2, "x", b), (3, "y", None)], "doc_id long, part string, text string")
    marks = fingerprint.fingerprints(docs).join(docs.select("doc_id", "part"), "doc_id")
    total = {r.part: fingerprint.parse(r.fingerprint) for r in fingerprint.merged(marks, ["part"]).collect()}
    assert abs(fingerprint.distinct(total["x"]) - 4992) < 1000 and fingerprint.distinct(total["y"]) == 0
    one = {r.doc_id: fingerprint.parse(r.fingerprint) for r in marks.collect()}
    assert abs(fingerprint.containment(one[1], total["x"]) - 1) < 0.25
    assert np.array_equal(fingerprint.merge(one[1], one[2]), total["x"])
    assert fingerprint.resemblance(one[3], one[3]) == 1 and fingerprint.resemblance(one[3], one[1]) == 0
    assert fingerprint.edited_pairs(docs.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [bloom_lm.MAX_FILTER_BYTES, 0])  # with the filter, and beyond its size bound
def test_lm_scores(spark, monkeypatch, limit):
    monkeypatch.setattr(core, "GROUP_BYTES", 4000)
    core.ship(spark)
    texts = awkward_texts()
    got = {r.doc_id: r for r in bloom_lm.score(table(spark, texts), max_filter_bytes=limit).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(texts))}
    token = {i: words((t or "").translate(LOWER)) + [""] for i, t in enumerate(texts)}
    count = collections.Counter(x for i, t in token.items() if not held[i] for x in t)
    pairs = collections.Counter(p for i, t in token.items() if not held[i] for p in zip([None, *t], t))
    total, size = sum(count.values()), len(count)
    quantised = lambda c: 0 if not c else (2 ** (k := c.bit_length()) / 2 + 2**k - 1) / 2
    near = 0
    for i, t in token.items():
        base = sum(math.log10((count[x] + 0.5) / (total + 0.5 * (size + 1))) for x in t)
        model = 0.0
        for h, x in zip([None, *t], t):
            own = quantised(count[x])
            before = quantised(count[""]) if h is None else quantised(count[h])
            both = min(quantised(pairs[h, x]) if pairs[h, x] >= bloom_lm.MIN_BIGRAM else 0, own, before)
            model += math.log10(bloom_lm.BIGRAM_WEIGHT * (both / before if before else 0) + (1 - bloom_lm.BIGRAM_WEIGHT) * (own + 0.5) / (total + 0.5 * (size + 1)))
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(count[x] > 0 for x in t), total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        near += abs(r.score - model) < 1e-6 * abs(model)
    assert near >= (0.5 if limit else 1) * len(texts)  # about one probe in a hundred is a false hit, and a text has dozens


def test_lm_knows_bigrams_seen_once(spark):
    core.ship(spark)
    held = next(i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1)
    train = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 != 1][:4]
    texts = ["sun moon", "moon", "sun", "star"]
    got = {r.doc_id: r for r in bloom_lm.score(table(spark, [*texts, "sun moon"], [*train, held]), max_filter_bytes=0).collect()}
    w = bloom_lm.BIGRAM_WEIGHT  # 9 training tokens: sun 2, moon 2, star 1, end 4; 4 distinct
    share = lambda c: (1 - w) * (c + 0.5) / (9 + 0.5 * 5)
    seen = math.log10(w * 2.5 / 5.5 + share(2.5)) + math.log10(w * 1 / 2.5 + share(2.5)) + math.log10(w * 2.5 / 2.5 + share(5.5))
    assert got[held].n_tokens == 3 and got[held].score == pytest.approx(seen, abs=1e-9)
    own = bloom_lm._Tokens(pa.array([t for t in awkward_texts() if t]))
    (words, times), (pairs, pair_times) = (np.unique(key, return_counts=True) for key in (own.word, own.pair & bloom_lm._LOW))
    stored = bloom_lm.build(words, times, pairs, pair_times)
    assert (pair_times == 1).sum() > 500 and (stored.levels(pairs) >= bloom_lm.level(pair_times)).all()


def test_lm_scores_come_from_one_filter_at_every_size(spark, monkeypatch):
    """However many groups ask, and for a filter of any size: the levels of the filter read whole."""
    monkeypatch.setattr(core, "GROUP_BYTES", 4000)
    core.ship(spark)
    texts = awkward_texts()
    docs = table(spark, texts)
    runs = []
    for groups, bound in ((1, bloom_lm.MAX_FILTER_BYTES), (5, bloom_lm.MAX_FILTER_BYTES), (5, 1)):
        monkeypatch.setattr(core, "group_count", lambda *_args, n=groups, **_more: n)
        monkeypatch.setattr(bloom_lm, "MAX_FILTER_BYTES", bound)
        runs.append({r.doc_id: r for r in bloom_lm.score(docs).collect()})
    buckets = bloom_lm.segment_count(core.text_bytes(docs))
    assert buckets > 5
    learned = bloom_lm._Tokens(pa.array([t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 != 1], pa.string()))
    total, size = len(learned.word), len(set(learned.word.tolist()))
    parts = []
    for b in range(buckets):
        inside = [np.unique(key[bloom_lm.bucket_of(key, buckets) == b], return_counts=True) for key in (learned.word, learned.pair)]
        parts.append(bloom_lm.build(*inside[0], inside[1][0] & bloom_lm._LOW, inside[1][1]))
    stored = bloom_lm.Filter(np.concatenate([p.sizes for p in parts]).astype(np.int64), b"".join(p.body.tobytes() for p in parts))
    for i, t in enumerate(texts):
        own = bloom_lm._Tokens(pa.array([t], pa.string()))
        word, pair = (bloom_lm.expected(stored.levels(key)) for key in (own.word, own.pair))
        before = np.r_[word[-1], word[:-1]]
        pair = np.minimum(pair, np.minimum(word, before))
        bigram = np.divide(pair, before, out=np.zeros_like(pair), where=before > 0)
        model = np.log10(bloom_lm.BIGRAM_WEIGHT * bigram + (1 - bloom_lm.BIGRAM_WEIGHT) * (word + 0.5) / (total + 0.5 * (size + 1))).sum()
        assert [r[i].score for r in runs] == pytest.approx([model] * 3, rel=1e-9)


def test_lm_without_training_rows(spark):
    core.ship(spark)
    ids = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    rows = bloom_lm.score(table(spark, ["a b", None, "c"], ids)).collect()
    assert {r.train_tokens for r in rows} == {0} and all(math.isfinite(r.score) for r in rows)
    assert bloom_lm.score(table(spark, [])).count() == 0


def test_weak_labels_agree_with_held_back_gold_labels(spark):
    core.ship(spark)
    sf = "/root/testdata/sf0.01"
    docs = core.read(spark, sf, "documents")
    gold = core.read(spark, sf, "labels").select("doc_id", "quality")
    rows = weak_labels.score(docs, weak_labels.train(docs)).join(gold, "doc_id").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.keep for r in good) >= 0.99 * len(good)
    assert sum(not r.keep for r in bad) >= 0.9 * len(bad)


def test_weak_labels_on_awkward_rows(spark):
    core.ship(spark)
    texts = awkward_texts() + ["$$$ %%% | ### " * 40] * 3
    docs = table(spark, texts)
    model = weak_labels.train(docs)
    rows = {r.doc_id: r for r in weak_labels.score(docs, model).collect()}
    assert len(rows) == len(texts) and not any(rows[i].keep or rows[i].score for i in (0, 1, 2))
    kept = weak_labels.accept(docs, model)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if r.keep}
    none = table(spark, [])
    assert weak_labels.score(none, weak_labels.train(none)).count() == 0


def test_em_recovers_labeller_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(20000) < 0.8
    rates = np.array([[0.9, 0.05], [0.5, 0.01], [0.7, 0.1]])  # P(bad vote | bad), P(bad vote | good)
    votes = np.stack([np.where(rng.random(len(good)) < np.where(good, b, a), 0, 1) for a, b in rates])
    votes[0][rng.random(len(good)) < 0.3] = -1
    code, count = np.unique(((votes + 1) * 3 ** np.arange(3)[:, None]).sum(axis=0), return_counts=True)
    posterior = weak_labels.fit_labellers(code, count.astype(float), labellers=3)
    guess = np.array([posterior[c] for c in ((votes + 1) * 3 ** np.arange(3)[:, None]).sum(axis=0).tolist()]) >= 0.5
    assert (guess == good).mean() > 0.93
