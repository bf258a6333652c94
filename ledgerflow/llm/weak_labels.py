"""Operator 1: quality classifier from overlapping heuristic labellers.

Nine labellers look at a whole text and vote good, bad or abstain.
Expectation-maximisation over all documents estimates the class prior and, per
labeller, how often it votes bad or good in each class (abstaining tells
nothing); it runs on the table of vote patterns with their counts, at most 3**9
rows whatever the corpus.  The posterior of a document's pattern is its soft
label.  Soft labels of a bounded sample (``FIT_DOCS`` documents, chosen by a
hash of the id) train a logistic scorer on hashed features of the text's shape:
trigrams of character classes and word repetitions.  The scorer judges every
document; ``keep`` is a score of at least ``THRESHOLD``.

Cases: a text without words (null, empty, white space) has score 0 and is
rejected.  Very short texts get mostly abstentions and then rest on the scorer.
Repeated rows get equal scores.  Null ids are allowed.  Extra columns of any
name pass through ``accept`` untouched; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import core

FIT_DOCS = 8192
DIMENSIONS = 1 << 14
THRESHOLD = 0.3
_EM_ROUNDS, _FIT_ROUNDS, _RATE, _SHRINK = 100, 300, 1.0, 1e-6

# Frequent function words of the four corpus languages.
FUNCTION_WORDS = """
the of and to in is it that for was with on as are be by at this from or an not have
der die und das den von zu mit sich des ist im dem nicht ein eine als auch es an auf
le la les de des et un une du est que en dans pour qui sur au par avec ne se plus
el los las y en que del al con por para una se su como no lo mas
""".split()

# Character classes: a letter's case, digits and white space are folded, other ASCII marks stay themselves.
_CLASS = np.arange(256, dtype=np.int64) & 127
_CLASS[ord("a"):ord("z") + 1] = ord("a")
_CLASS[ord("A"):ord("Z") + 1] = ord("A")
_CLASS[ord("0"):ord("9") + 1] = ord("0")
_CLASS[core.WHITESPACE] = ord(" ")
_CLASS[128:] = ord("a")  # bytes of other letters
_CLASS[ord("\n")] = 1

_MARK = np.zeros(256, dtype=bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:!?'\"-()"]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".,;:?"]] = True
_UPPER, _LOWER = (np.zeros(256, dtype=bool) for _ in range(2))
_UPPER[65:91], _LOWER[97:123] = True, True


def _function_hashes() -> np.ndarray:
    text = " ".join(FUNCTION_WORDS).encode()
    data = np.frombuffer(text, dtype=np.uint8)
    return np.unique(core.word_hashes(data, np.array([0, len(data)]))[0])


class Texts:
    """Byte and word statistics of a batch of texts."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = core.text_buffers(column)
        self.words, self.n = core.word_hashes(core.LOWER[self.data], self.offsets)
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        bounds = [core.words(self.data[self.offsets[i]:self.offsets[j]], self.offsets[i:j + 1] - self.offsets[i])[:2] + (self.offsets[i],) for i, j in core.chunks(self.offsets)]
        self.begin = np.concatenate([b + o for b, _, o in bounds] or [np.empty(0, np.int64)])
        self.end = np.concatenate([e + o for _, e, o in bounds] or [np.empty(0, np.int64)])
        self.same = np.zeros(len(self.words), dtype=bool)
        self.same[1:] = (self.words[1:] == self.words[:-1]) & (self.doc[1:] == self.doc[:-1])

    def per_doc(self, of_words: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, weights=of_words, minlength=len(self.n))

    def bytes_per_doc(self, mask: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(mask)][self.offsets])

    def votes(self) -> np.ndarray:
        """Labeller by document: 1 good, 0 bad, -1 abstain."""
        n = np.maximum(self.n, 1)
        ink = np.maximum(self.bytes_per_doc(~core.WHITESPACE[self.data]), 1)
        upper, lower = self.bytes_per_doc(_UPPER[self.data]), self.bytes_per_doc(_LOWER[self.data])
        last = self.data[self.end - 1] if len(self.end) else np.empty(0, np.uint8)
        before = self.data[np.maximum(self.end - 2, 0)] if len(self.end) else last
        alone = (self.end - self.begin) == 1
        order = np.lexsort((self.words, self.doc))
        w, d = self.words[order], self.doc[order]
        new = np.ones(len(w), dtype=bool)
        new[1:] = (w[1:] != w[:-1]) | (d[1:] != d[:-1])
        distinct = np.bincount(d[new], minlength=len(self.n))

        def vote(value: np.ndarray, bad: np.ndarray, good: np.ndarray, sure: np.ndarray) -> np.ndarray:
            return np.where(sure & bad(value), 0, np.where(sure & good(value), 1, -1))

        some, many = self.n >= 5, self.n >= 50
        return np.stack([
            vote(self.bytes_per_doc(_MARK[self.data]) / ink, lambda v: v > 0.06, lambda v: v < 0.02, some),
            vote(self.per_doc(_MARK[last] & (before == last) & ~alone) / n, lambda v: v > 0.1, lambda v: v < 0.02, some),
            vote(self.per_doc(alone & _MARK[last]) / n, lambda v: v > 0.1, lambda v: v < 0.02, some),
            vote(upper / np.maximum(upper + lower, 1), lambda v: v > 0.4, lambda v: v < 0.2, upper + lower >= 20),
            vote(self.per_doc(last == ord("!")) / n, lambda v: v > 0.2, lambda v: v < 0.05, some),
            vote(self.per_doc(self.same) / n, lambda v: v > 0.2, lambda v: v < 0.05, some),
            vote(distinct / n, lambda v: v < 0.15, lambda v: v > 0.4, many),
            vote(self.per_doc(_STOP[last]) / n, lambda v: v < 0.005, lambda v: v > 0.03, many),
            vote(self.per_doc(np.isin(self.words, _function_hashes())) / n, lambda v: v < 0.02, lambda v: v > 0.1, many),
        ])

    def patterns(self) -> np.ndarray:
        """The votes of each document as one number in base 3."""
        v = self.votes() + 1
        return (v * 3 ** np.arange(len(v))[:, None]).sum(axis=0)

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document, feature, weight) of the batch, piece by piece: shares of the text's trigrams and of its words."""
        for i, j in core.chunks(self.offsets):
            kind = _CLASS[self.data[self.offsets[i]:self.offsets[j]]]
            size = np.diff(self.offsets[i:j + 1])
            if len(kind) > 2:
                code = (kind[:-2] << 14 | kind[1:-1] << 7 | kind[2:]).astype(np.uint64)
                slot = (core.mix(code) >> np.uint64(64 - 14)).astype(np.int64)
                left = np.repeat(self.offsets[i + 1:j + 1] - self.offsets[i], size)[:-2] - np.arange(len(slot))
                ok = left >= 3
                doc = np.repeat(np.arange(i, j), size)[:-2][ok]
                yield doc, slot[ok], 1 / (size[doc - i] - 2)
        again = np.flatnonzero(self.same)
        yield self.doc[again], np.full(len(again), 0), 1 / self.n[self.doc[again]]


def log_odds(texts: Texts, weights: np.ndarray) -> np.ndarray:
    """Linear score of each document; the last weight is the intercept."""
    total = np.full(len(texts.n), weights[-1])
    for doc, slot, share in texts.features():
        total += np.bincount(doc, weights=weights[slot] * share, minlength=len(texts.n))
    return total


# -- the weak-label model --------------------------------------------------------------------------------------------

def fit_labellers(patterns: np.ndarray, counts: np.ndarray, labellers: int = 9) -> dict[int, float]:
    """EM over vote patterns: pattern -> posterior probability of good."""
    votes = patterns[:, None] // 3 ** np.arange(labellers) % 3 - 1
    bad, good = votes == 0, votes == 1
    prior = 0.8
    says_bad = np.array([[0.4] * labellers, [0.02] * labellers])  # P(bad vote | bad), P(bad vote | good)
    for _ in range(_EM_ROUNDS):
        logs = [np.log(q) + bad @ np.log(s) + good @ np.log(1 - s) for q, s in ((1 - prior, says_bad[0]), (prior, says_bad[1]))]
        posterior = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        for c, p in enumerate((1 - posterior, posterior)):
            w = p * counts
            says_bad[c] = (w @ bad + 0.5) / (w @ (bad | good) + 1)
        says_bad = np.clip(says_bad, 1e-4, 1 - 1e-4)
        prior = float(np.clip((posterior @ counts + 1) / (counts.sum() + 2), 1e-3, 1 - 1e-3))
    return dict(zip(patterns.tolist(), posterior.tolist()))


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray) -> np.ndarray:
    """Logistic regression on sparse rows (features, shares) by full-batch steps of adaptive length."""
    row = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
    slot = np.concatenate([f for f, _ in rows]) if rows else np.empty(0, np.int64)
    share = np.concatenate([s for _, s in rows]) if rows else np.empty(0)
    weights, seen = np.zeros(DIMENSIONS + 1), np.full(DIMENSIONS + 1, 1e-12)
    balance = np.where(target < 0.5, 0.5 / max(1, (target < 0.5).sum()), 0.5 / max(1, (target >= 0.5).sum()))
    for _ in range(_FIT_ROUNDS if len(rows) else 0):
        z = weights[-1] + np.bincount(row, weights=weights[slot] * share, minlength=len(rows))
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - target) * balance
        gradient = np.r_[np.bincount(slot, weights=error[row] * share, minlength=DIMENSIONS), error.sum()]
        gradient += _SHRINK * weights
        seen += gradient**2
        weights -= _RATE * gradient / np.sqrt(seen)
    return weights


class Model:
    """Posterior per vote pattern and the scorer's weights: a few hundred KB, whatever the corpus."""

    def __init__(self, posterior: dict[int, float], weights: np.ndarray):
        self.posterior, self.weights = posterior, weights

    def judge(self, texts: Texts) -> np.ndarray:
        """Probability of good; 0 without words."""
        return np.where(texts.n > 0, 1 / (1 + np.exp(-np.clip(log_odds(texts, self.weights), -500, 500))), 0.0)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", fit_docs: int = FIT_DOCS) -> Model:
    """Label with all documents, fit on a sample of about ``fit_docs``."""
    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in core.pieces(batches, 0):
            texts = Texts(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(texts.patterns()[texts.n > 0])], names=["pattern"])

    seen = docs.select(text).mapInArrow(patterns, "pattern long").groupBy("pattern").count().collect()
    posterior = fit_labellers(np.array([r[0] for r in seen]), np.array([r[1] for r in seen], dtype=float)) if seen else {}
    total = sum(r[1] for r in seen)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in core.pieces(batches, 0):
            texts = Texts(batch.column(0))
            doc, slot, share = (np.concatenate(x) for x in zip(*texts.features()))
            code, place = np.unique(doc * DIMENSIONS + slot, return_inverse=True)
            sums = np.bincount(place, weights=share, minlength=len(code))
            cut = np.searchsorted(code // DIMENSIONS, np.arange(len(texts.n) + 1))
            target = [posterior[p] for p in texts.patterns()[texts.n > 0].tolist()]
            some = np.flatnonzero(texts.n > 0)
            yield pa.RecordBatch.from_arrays([
                pa.array([(code[cut[i]:cut[i + 1]] % DIMENSIONS).astype(np.int32) for i in some], pa.list_(pa.int32())),
                pa.array([sums[cut[i]:cut[i + 1]].astype(np.float32) for i in some], pa.list_(pa.float32())), pa.array(target, pa.float64()),
            ], names=["slot", "share", "target"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, target = [], []
        for batch in batches:
            for s, v, t in zip(batch.column("slot"), batch.column("share"), batch.column("target").to_pylist()):
                rows.append((s.values.to_numpy().astype(np.int64), v.values.to_numpy().astype(np.float64)))
                target.append(t)
        yield pa.RecordBatch.from_arrays([pa.array([fit_scorer(rows, np.array(target))], pa.list_(pa.float64()))], names=["weights"])

    chosen = docs.where(F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(1)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, fit_docs / max(1, total))))
    chosen = core.write_stage(chosen.select(text).mapInArrow(sample, "slot array<int>, share array<float>, target double"), "quality-sample")
    weights = chosen.repartition(1).mapInArrow(fit, "weights array<double>").first()
    return Model(posterior, np.array(weights[0]) if weights else np.zeros(DIMENSIONS + 1))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_votes, posterior, score, keep) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in core.pieces(batches, 1):
            texts = Texts(batch.column(1))
            pattern, good = texts.patterns(), shared.value.judge(texts)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array((texts.votes() >= 0).sum(axis=0).astype(np.int32)),
                pa.array([shared.value.posterior.get(p, 0.0) if n else 0.0 for p, n in zip(pattern.tolist(), texts.n.tolist())], pa.float64()),
                pa.array(good), pa.array(good >= THRESHOLD),
            ], names=["doc_id", "n_votes", "posterior", "score", "keep"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), text).mapInArrow(run, "doc_id long, n_votes int, posterior double, score double, keep boolean")


def accept(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents the scorer keeps, all columns untouched; a narrow map."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in core.pieces(batches, at):
            yield batch.filter(pa.array(shared.value.judge(Texts(batch.column(at))) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def op1_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = core.read(spark, sf_dir, "documents")
    return score(docs, train(docs))
