"""Operator 4: language-model scoring with a log-frequency Bloom filter.

The model is a bigram model over lower-cased words (an end token closes each
document).  Counts are quantised: level(c) = 1 + floor(log2 c), and an n-gram of
level L enters the filter L times, as (n-gram, 1) .. (n-gram, L).  A reader
probes (n-gram, 1), (n-gram, 2), ... until the first miss; the number of hits
gives the expected count of that level.  Words and bigrams of any count enter
(``MIN_BIGRAM`` is 1), from every training document.  A bigram is only probed
where both its words are known, and its count is at most theirs.

score = sum of log10( w * c(h, t) / c(h) + (1 - w) * (c(t) + 0.5) / (N + 0.5 (V + 1)) ).

The filter lies in hash-range segments, whose number depends on the bytes of the
texts alone, and stays in them at every size.  Each text group asks every segment
for its distinct words and bigrams and brings their training counts along; a
segment is built from the sums, probed once for each n-gram, and replies with
levels, exact word counts for the base score and its share of N and V.  So a
frequent n-gram costs one entry per group, no task holds more than a segment, and
scores do not depend on the size of the filter or of the cluster.

Cases: null or empty text is the end token alone.  No training document: N = 0,
every score follows the formula with zero counts.  A null id is training.
Repeated rows count and are scored row by row.  Extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import core

_U = np.uint64
#: Filter bits and hash probes per stored entry: about 1 % false hits.
BITS_PER_ENTRY, PROBES = 10, 7
MIN_BIGRAM = 1
BIGRAM_WEIGHT = 0.25
#: A bound for callers that want ``score``'s ``max_filter_bytes``; the query sets none.
MAX_FILTER_BYTES = 256 << 20
_END = _U(0x51ED270B7F4A7C15)
_START = _U(0x2545F4914F6CDD1D)


class _Tokens:
    """Token hashes of a batch of texts: the words of each and one end token."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        data, offsets = core.text_buffers(column)
        words, counts = core.word_hashes(core.LOWER[data], offsets)
        self.n = counts + 1
        doc = np.repeat(np.arange(len(counts)), counts)
        self.token = np.full(len(words) + len(counts), _END, dtype=np.uint64)
        self.token[np.arange(len(words)) + doc] = words
        self.doc = np.repeat(np.arange(len(counts)), self.n)
        before = np.roll(self.token, 1)
        if len(before):
            before[np.cumsum(self.n) - self.n] = _START
        self.word = core.mix(self.token ^ _U(0x632BE59BD9B4E019))
        self.pair = core.mix(before * _U(0x9FB21C651E98DF25) + self.token * _U(0xD6E8FEB86659FD93) + _U(1))
        #: Place of each token's predecessor; the start counts like an end (one per document).
        self.left = np.where(before == _START, -1, np.arange(len(before)) - 1)


def held_out(key: str = "doc_id") -> F.Column:
    """Is crc32(id as text) mod 5 equal to 1?"""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 1, F.lit(False))


# -- the filter ------------------------------------------------------------------------------------------------------

def level(count: np.ndarray) -> np.ndarray:
    return np.where(count > 0, 1 + np.floor(np.log2(np.maximum(count, 1))).astype(np.int64), 0)


def expected(levels: np.ndarray) -> np.ndarray:
    """Middle of the counts of a level (1, 2.5, 5.5, ...); 0 for level 0."""
    top = np.exp2(levels)
    return np.where(levels > 0, (top / 2 + top - 1) / 2, 0.0)


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return (((key >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)


def _probes(low: np.ndarray, rung: int, bits: np.ndarray | int) -> Iterator[np.ndarray]:
    """Bit positions of (n-gram, rung) in its segment."""
    first = core.mix(low ^ _U(rung * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    step = core.mix(first) | _U(1)
    size = np.asarray(bits, dtype=np.uint64)
    for _ in range(PROBES):
        yield first % size
        first = first + step


def segment(low: np.ndarray, levels: np.ndarray) -> tuple[int, bytes]:
    """(bits, packed bits) of one segment holding each n-gram at rungs 1 .. its level."""
    bits = max(64, -(-int(levels.sum()) * BITS_PER_ENTRY // 64) * 64)
    field = np.zeros(bits, dtype=bool)
    for rung in range(1, int(levels.max(initial=0)) + 1):
        for at in _probes(low[levels >= rung], rung, bits):
            field[at.astype(np.int64)] = True
    return bits, np.packbits(field, bitorder="little").tobytes()


class Filter:
    """All segments, side by side."""

    def __init__(self, sizes: np.ndarray, body: bytes):
        self.sizes = sizes.astype(np.uint64)
        self.start = np.r_[0, np.cumsum(sizes)[:-1]].astype(np.uint64)
        self.body = np.frombuffer(body, dtype=np.uint8)

    def levels(self, key: np.ndarray) -> np.ndarray:
        """Rungs hit before the first miss."""
        out = np.zeros(len(key), dtype=np.int64)
        bucket = bucket_of(key, len(self.sizes))
        alive, low = np.arange(len(key)), key & _LOW
        rung = 1
        while len(alive):
            hit = np.ones(len(alive), dtype=bool)
            start = self.start[bucket[alive]]
            for at in _probes(low[alive], rung, self.sizes[bucket[alive]]):
                at = at + start
                hit &= (self.body[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8) & 1).astype(bool)
            alive = alive[hit]
            out[alive] = rung
            rung += 1
        return out


#: Bits by which a segment tells n-grams apart (besides the hash range it covers).
_LOW = _U((1 << 40) - 1)


def build(words: np.ndarray, times: np.ndarray, pairs: np.ndarray, pair_times: np.ndarray) -> Filter:
    """The filter of one segment: distinct words and bigrams (both by their low bits) with their training counts."""
    often = pair_times >= MIN_BIGRAM
    bits, body = segment(np.concatenate([words & _LOW, pairs[often]]), level(np.concatenate([times, pair_times[often]])))
    return Filter(np.array([bits]), body)


# -- scoring ---------------------------------------------------------------------------------------------------------

def segment_count(total: int) -> int:
    """Segments of the filter for ``total`` bytes of text."""
    return max(1, -(-total // core.GROUP_BYTES))


def ask_rows(g: int, words: np.ndarray, times: np.ndarray, pairs: np.ndarray, pair_times: np.ndarray, buckets: int) -> pa.Table:
    """Asks of one group, one row for every segment, for ascending words and bigrams (40 bits of each) with their training counts."""
    out = {"g": [g] * buckets, "b": list(range(buckets)), "payload": []}
    word_cut, pair_cut = (np.searchsorted(bucket_of(key, buckets), np.arange(buckets + 1)) for key in (words, pairs))
    for b in range(buckets):
        own, both = slice(word_cut[b], word_cut[b + 1]), slice(pair_cut[b], pair_cut[b + 1])
        low = pairs[both] & _LOW
        out["payload"].append(pickle.dumps((words[own], core.squeeze(times[own]), (low & _U(0xFFFFFFFF)).astype(np.uint32), (low >> _U(32)).astype(np.uint8), core.squeeze(pair_times[both])), 5))
    return core.ask_table(out)


def look_up(asks: pa.Table, counted: bool) -> pa.Table:
    """Replies of one segment to each ask: (counts of the words, [(levels of the words, of the bigrams)], [bytes, tokens, words of the segment]).

    With ``counted``, levels without false hits follow those of the filter.
    """
    asked = [pickle.loads(p) for p in asks.column("payload").to_pylist()]
    cut, pair_cut = (np.cumsum([0, *(len(a[k]) for a in asked)]) for k in (0, 2))
    words, place = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
    pairs, pair_place = np.unique(np.concatenate([a[2].astype(np.uint64) | a[3].astype(np.uint64) << _U(32) for a in asked]), return_inverse=True)
    times = np.bincount(place, weights=np.concatenate([a[1] for a in asked]), minlength=len(words)).astype(np.int64)
    pair_times = np.bincount(pair_place, weights=np.concatenate([a[4] for a in asked]), minlength=len(pairs)).astype(np.int64)
    stored = build(words, times, pairs, pair_times)
    levels = [(stored.levels(words), stored.levels(pairs))]
    if counted:
        levels.append((level(times), level(np.where(pair_times >= MIN_BIGRAM, pair_times, 0))))
    levels = [(w[place].astype(np.int8), p[pair_place].astype(np.int8)) for w, p in levels]
    about = np.array([len(stored.body), times.sum(), (times > 0).sum()])
    times = times[place]
    payload = [pickle.dumps((core.squeeze(times[a:b]), [(w[a:b], p[c:d]) for w, p in levels], about), 5) for a, b, c, d in zip(cut[:-1], cut[1:], pair_cut[:-1], pair_cut[1:])]
    return pa.table({"g": asks.column("g").cast(pa.int32()), "b": asks.column("b").cast(pa.int32()), "payload": pa.array(payload, pa.binary())})


def replies(said: pa.Table, max_filter_bytes: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """(counts of the words, their levels, levels of the bigrams) in the order in which a group asked, and N and V."""
    rows = sorted(zip(said.column("b").to_pylist(), said.column("payload").to_pylist()))
    counts, levels, about = zip(*(pickle.loads(p) for _, p in rows))
    size, total, vocabulary = np.sum(about, axis=0).tolist()
    kind = int(max_filter_bytes is not None and size > max_filter_bytes)
    return np.concatenate(counts), np.concatenate([x[kind][0] for x in levels]), np.concatenate([x[kind][1] for x in levels]), total, vocabulary


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", weight: float = BIGRAM_WEIGHT, max_filter_bytes: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): learned from all rows not held out.

    ``max_filter_bytes``, if a caller sets it: a larger filter is replaced by exact
    counts, quantised the same (the model without false hits).  The query does not.
    """
    text_size = core.text_bytes(docs, text)
    groups, buckets = core.group_count(docs, text, total=text_size), segment_count(text_size)
    texts = core.text_groups(docs, groups, key, text)

    def sorted_tokens(table: pa.Table) -> tuple[pa.Table, _Tokens, np.ndarray]:
        table = core.sorted_group(table)
        own = _Tokens(table.column("text"))
        ids = table.column("doc_id").to_pylist()
        return table, own, np.array([crc32_mod5(i) for i in ids], dtype=bool)

    def ask_counts(key: tuple, table: pa.Table) -> pa.Table:
        _, own, held = sorted_tokens(table)
        learns = ~held[own.doc]
        count = lambda x: (x[0], np.bincount(x[1], weights=learns, minlength=len(x[0])).astype(np.int64))
        return ask_rows(key[0].as_py(), *count(np.unique(own.word, return_inverse=True)), *count(np.unique(own.pair, return_inverse=True)), buckets)

    def probe(_key: tuple, asks: pa.Table) -> pa.Table:
        return look_up(asks, max_filter_bytes is not None)

    def rate(_key: tuple, table: pa.Table, said: pa.Table) -> pa.Table:
        table, own, held = sorted_tokens(table)
        counts, word_level, pair_level, total, vocabulary = replies(said, max_filter_bytes)
        log_base = np.log10(total + 0.5 * (vocabulary + 1))
        place = np.unique(own.word, return_inverse=True)[1]
        exact, word = counts[place], expected(word_level[place].astype(np.int64))
        pair = expected(pair_level[np.unique(own.pair, return_inverse=True)[1]].astype(np.int64))
        plain = np.log10(exact + 0.5) - log_base
        share = (word + 0.5) / 10**log_base
        closing = word[own.n[0] - 1]
        before = np.where(own.left >= 0, word[own.left], closing)
        pair = np.minimum(pair, np.minimum(word, before))
        bigram = np.divide(pair, before, out=np.zeros_like(pair), where=before > 0)
        model = np.log10(weight * bigram + (1 - weight) * share)
        m = len(own.n)
        add = lambda v: np.bincount(own.doc, weights=v, minlength=m)
        return pa.table({
            "doc_id": table.column("doc_id"), "held_out": pa.array(held), "n_tokens": pa.array(own.n.astype(np.int64)),
            "n_known": pa.array(add(exact > 0).astype(np.int64)), "train_tokens": pa.array(np.full(m, total, dtype=np.int64)),
            "base_score": pa.array(add(plain)), "score": pa.array(add(model)),
        })

    asks = texts.groupBy("g").applyInArrow(ask_counts, core.ASK)
    answers = asks.groupBy("b").applyInArrow(probe, core.ASK)
    return texts.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(
        rate, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def crc32_mod5(doc_id: int | None) -> bool:
    """``held_out`` for one id."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def op4_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(core.read(spark, sf_dir, "documents"))
