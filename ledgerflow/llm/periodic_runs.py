"""Operator 13: periodic runs of words, found by minimizers at several scales.

A run is a maximal stretch of words with smallest period q that holds at least
two periods.  Periods under ``LAGS`` are found by comparing the words with
themselves q words later.  For longer ones, scale Q looks for the periods in
[Q, 2Q): every window of Q/2 + 1 shingles of Q/2 words marks its smallest
shingle hashes.  A window that lies in the first period of a run occurs again
q words later with the same marks, so each run has a pair of equal marks at its
period's distance.  Such pairs are the seeds; each is extended both ways by
binary lifting over prefix hashes, and what is long enough is compared word by
word.

Marks of one shingle that lie within half its length of each other form a chain:
there the shingle has that gap as its period, so the chain lies in one run of a
smaller period, and pairs within it give multiples of that period only.  Two
chains give one seed for each distance between them instead of one for each pair
of marks.  A text of one repeated word is thus as cheap as any other.

Documents are independent: a narrow map over Arrow batches, no shuffle.  Short
documents are handled together, parted by words that occur once.

Cases: null, empty and blank texts have no words, no run and four nulls; a null
id is kept as it is (its text is not altered by ``respell``); repeated ids and
equal texts are judged row by row; a very long text is a batch of its own and
takes memory in proportion to its words; an empty table gives an empty result;
extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import core

#: A run has at least so many words, and at least two periods.
MIN_LENGTH = 12
#: Periods below are found by lag scans; a power of two.
LAGS = 16

_U = np.uint64
RESULT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def respell(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p) if the document's words from ``a`` on are to repeat its words a .. a+p-1."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _stretches(hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, length) of the stretches of consecutive numbers in ascending ``hits``."""
    cut = np.flatnonzero(np.diff(hits) != 1) + 1
    first = np.concatenate([hits[:1], hits[cut]])
    return first, np.diff(np.concatenate([[0], cut, [len(hits)]]))


def _by_lag(items: np.ndarray, q: int) -> np.ndarray:
    """(start, length, q) of the stretches that repeat ``q`` items later over ``q`` items or more."""
    hits = np.flatnonzero(items[:-q] == items[q:])
    if not len(hits):
        return np.empty((0, 3), np.int64)
    first, same = _stretches(hits)
    good = same >= max(q, MIN_LENGTH - q)
    return np.stack([first[good], same[good] + q, np.full(int(good.sum()), q)], axis=1)


def _slide(values: np.ndarray, width: int, pick: Callable[..., np.ndarray]) -> np.ndarray:
    """Smallest or largest (``pick``) of each window of ``width`` values, by doubling."""
    out, size = values, 1
    while size < width:
        step = min(size, width - size)
        out = pick(out[:-step], out[step:])
        size += step
    return out


def marks(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the smallest hash of some window of ``width`` hashes, equal ones all."""
    if len(hashes) < width:
        return np.empty(0, np.int64)
    low = _slide(hashes, width, np.minimum)
    edge = np.zeros(width - 1, dtype=hashes.dtype)
    return np.flatnonzero(_slide(np.concatenate([edge, low, edge]), width, np.maximum) == hashes)


def chains(places: np.ndarray, hashes: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first place, last place, common gap) of chains of equal hashes at most ``reach`` apart; gap 0: a single place."""
    order = np.argsort(hashes, kind="stable")
    p, h = places[order], hashes[order]
    gap = np.diff(p)
    head = np.concatenate([[True], (h[1:] != h[:-1]) | (gap > reach)])
    at = np.flatnonzero(head)
    last = np.concatenate([at[1:], [len(p)]]) - 1
    steps = np.concatenate([[0], np.where(head[1:], 0, gap)])
    return h[at], p[at], p[last], np.gcd.reduceat(steps, at)


def seeds(places: np.ndarray, hashes: np.ndarray, low: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of equal marks in different chains, one for each lag in [low, 2 low) between two chains."""
    none = np.empty(0, np.int64)
    if not len(places):
        return none, none
    name, first, last, gap = chains(places, hashes, reach)
    xs, lags = [none], [none]
    left = np.arange(len(name) - 1)
    apart = 1
    while len(left):  # chains of one shingle start over reach apart, so a few rounds pass the farthest lag
        left = left[left + apart < len(name)]
        right = left + apart
        near = (name[left] == name[right]) & (first[right] - last[left] < 2 * low)
        left, right = left[near], right[near]
        step = np.gcd(gap[left], gap[right])
        step[step == 0] = 1
        least, most = first[right] - last[left], np.minimum(last[right] - first[left], 2 * low - 1)
        begin = least + np.maximum(0, -(-(low - least) // step)) * step
        count = np.maximum(0, (most - begin) // step + 1)
        each = np.repeat(np.arange(len(left)), count)
        lag = begin[each] + (np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)) * step[each]
        xs.append(np.maximum(first[left][each], first[right][each] - lag))
        lags.append(lag)
        apart += 1
    return np.concatenate(xs), np.concatenate(lags)


def _extend(items: np.ndarray, total: np.ndarray, x: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(left, right): how many items from ``x`` on, and before it, equal those ``lag`` later, under prefix hashes."""
    n = len(items)
    _, down = core._Powers.get(n + 1)

    def same(at: np.ndarray, lags: np.ndarray, size: int) -> np.ndarray:
        to = at + lags
        return (total[at + size] - total[at]) * down[at] == (total[to + size] - total[to]) * down[to]

    right, left = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    size = 1 << max(0, n.bit_length() - 1)
    while size:
        fits = np.flatnonzero(x + lag + right + size <= n)
        if len(fits):
            right[fits[same((x + right)[fits], lag[fits], size)]] += size
        fits = np.flatnonzero(x - left - size >= 0)
        if len(fits):
            left[fits[same((x - left - size)[fits], lag[fits], size)]] += size
        size >>= 1
    return left, right


def _at_scale(items: np.ndarray, low: int) -> np.ndarray:
    """(start, length, period) of the stretches with a period in [low, 2 low); the period need not be the smallest."""
    none = np.empty((0, 3), np.int64)
    n, k = len(items), low // 2
    if n < 2 * low:
        return none
    up, down = core._Powers.get(n + 1)
    total = np.zeros(n + 1, dtype=_U)
    np.cumsum(core.mix(items.astype(_U) + _U(1)) * up[:n], out=total[1:])
    hashes = core.mix((total[k:] - total[:-k]) * down[: n - k + 1])
    places = marks(hashes, low - k + 1)
    x, lag = seeds(places, hashes[places], low, k // 2)
    if not len(x):
        return none
    left, right = _extend(items, total, x, lag)
    long = (left + right >= lag) & (left + right + lag >= MIN_LENGTH)
    x, lag, start, same = x[long], lag[long], (x - left)[long], (left + right)[long]
    _, pick = np.unique(np.stack([start, lag], axis=1), axis=0, return_index=True) if len(x) else (None, np.empty(0, np.int64))
    out = []
    for i in pick.tolist():
        s, q, m, seed = int(start[i]), int(lag[i]), int(same[i]), int(x[i])
        equal = items[s:s + m] == items[s + q:s + q + m]
        if not equal.all():  # unequal words of one hash: take what is equal around the seed
            wrong = np.flatnonzero(~equal) + s
            cut = int(np.searchsorted(wrong, seed))
            end = int(wrong[cut]) if cut < len(wrong) else s + m
            s = int(wrong[cut - 1]) + 1 if cut else s
            m = end - s
            if m < q or m + q < MIN_LENGTH:
                continue
        out.append((s, m + q, q))
    return np.array(out, np.int64).reshape(-1, 3)


def find(items: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs (start, length, period) of a batch of documents, by start, then period.

    ``items``: the word numbers of all documents in turn, each followed by a
    number that occurs once; ``sizes``: the words of each document without it.
    """
    found = [_by_lag(items, q) for q in range(1, min(LAGS, len(items)))]
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    low = LAGS
    while True:
        long = np.flatnonzero(sizes >= 2 * low)
        if not len(long):
            break
        if len(long) == len(sizes):
            found.append(_at_scale(items, low))
        else:  # documents too short for the scale stay out
            part = np.concatenate([items[begin[d]:begin[d + 1]] for d in long.tolist()])
            mine = np.concatenate([[0], np.cumsum(sizes[long] + 1)])
            runs = _at_scale(part, low)
            runs[:, 0] += (begin[long] - mine[:-1])[np.searchsorted(mine, runs[:, 0], side="right") - 1]
            found.append(runs)
        low *= 2
    return _smallest(np.concatenate([np.empty((0, 3), np.int64), *found]))


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Of equal stretches the one with the smallest period (larger ones are its multiples), by start, then period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    head = np.ones(len(runs), dtype=bool)
    head[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[head]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def numbered(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers of all documents, each ended by a number of its own; words of each document)."""
    sizes = np.array([len(d) for d in documents], np.int64)
    known: dict[bytes, int] = {}
    number = known.setdefault
    items = np.empty(int(sizes.sum()) + len(sizes), np.int64)
    at = 0
    for k, document in enumerate(documents):
        items[at:at + len(document)] = [number(w, len(known)) for w in document]
        at += len(document)
        items[at] = -1 - k
        at += 1
    return items, sizes


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def collapsed(document: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(runs):
        return document
    steps = np.zeros(len(document) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(steps[:-1]) == 0
    return [document[i] for i in np.flatnonzero(keep).tolist()]


def summary(document: list[bytes], runs: np.ndarray) -> tuple:
    """(n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of a document and its runs."""
    best: tuple = (None,) * 4
    if len(runs):
        start, length, period = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist()
        best = (start, length, period, 1000 * length // period)
    listing = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist()).encode()
    return len(runs), *best, _digest(listing), _digest(b" ".join(collapsed(document, runs)))


def runs_of(documents: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each document, starts counted in its own words."""
    items, sizes = numbered(documents)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    runs = find(items, sizes)
    cut = np.searchsorted(runs[:, 0], begin)
    return [runs[a:b] - np.array([s, 0, 0]) for a, b, s in zip(cut[:-1], cut[1:], begin[:-1])]


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text", alter: Callable[[int | None, int], tuple[int, int] | None] | None = None) -> DataFrame:
    """``RESULT`` rows, one per document; ``alter(id, words)`` may name words to be repeated first, as ``respell`` does."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in core.pieces(batches, 1):
            ids = batch.column(0).cast(pa.int64()).to_pylist()
            data, offsets = core.text_buffers(batch.column(1))
            documents = []
            for doc_id, a, b in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist()):
                words = data[a:b].tobytes().split()  # splits at 0x20 and 0x09 to 0x0D
                if alter and (how := alter(doc_id, len(words))):
                    first, period = how
                    words[first:] = (words[first:first + period] * (-(-(len(words) - first) // period)))[: len(words) - first]
                documents.append(words)
            rows = [(i, *summary(d, r)) for i, d, r in zip(ids, documents, runs_of(documents))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)

    return docs.select(F.col(key).cast("long"), F.col(text).cast("string")).mapInArrow(judge, RESULT)


_NAMES = [c.split()[0] for c in RESULT.split(", ")]
_TYPES = [pa.int64()] * 6 + [pa.string()] * 2


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(core.read(spark, sf_dir, "documents"), alter=respell)
