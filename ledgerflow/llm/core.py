"""Shared helpers of the operators: Arrow text buffers, word hashes, grouping and the first-seen exchange.

Texts are handled as the flat byte buffer of an Arrow column plus offsets, so
the per-byte work is numpy over whole batches and never a Python loop over
characters.

Many operators ask the same question: *does this hash occur elsewhere, and
where first?*  ``ask`` rows carry the sorted distinct hashes of one text group,
cut by hash range into buckets; ``answer`` resolves one bucket and sends back
one value per asked hash.  A hash is asked at most once per group however many
documents of the group hold it, so a hot hash (a line in a third of all
documents) costs a bucket one entry per group, not one per document.
"""

from __future__ import annotations

import math
import os
import pickle
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_root

#: Target size of a text group; a group is one unit of Python work.
GROUP_BYTES = 6 << 20
#: Bytes hashed at a time inside a group (a single longer document is one chunk).
CHUNK_BYTES = 1 << 20

WHITESPACE = np.zeros(256, dtype=bool)
WHITESPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_NULL_ID = np.iinfo(np.int64).min


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (splitmix64 finaliser); returns a new array."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown on demand."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 20)
            up = np.full(size, _BASE, dtype=np.uint64)
            down = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
            up[0] = down[0] = 1
            cls.up, cls.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return cls.up[:n], cls.down[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span ``data[starts:ends]``, by one prefix sum."""
    up, down = _Powers.get(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_HASH[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width``-byte window of ``data`` (document borders are the caller's business)."""
    if len(data) < width:
        return np.empty(0, dtype=np.uint64)
    starts = np.arange(len(data) - width + 1)
    return span_hashes(data, starts, starts + width)


def sequence_hashes(items: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive item hashes (borders are the caller's business)."""
    if len(items) < n:
        return np.empty(0, dtype=np.uint64)
    m = len(items) - n + 1
    out = np.zeros(m, dtype=np.uint64)
    power = 1
    for j in range(n):
        out += items[j:j + m] * _U(power)
        power = power * _BASE & _MASK
    return mix(out)


def text_buffers(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(what, dtype=np.uint8)[offsets[0]:offsets[-1]] if what is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def id_array(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Integer ids as int64; a null id sorts before all others."""
    return pc.fill_null(column.cast(pa.int64()), int(_NULL_ID)).to_numpy().astype(np.int64)


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of whole documents of at most ``limit`` bytes, one document at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def pieces(batches: Iterator[pa.RecordBatch], column: int | str, limit: int = 2 * CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a text column stays under ``limit`` bytes (a single row at least)."""
    for batch in batches:
        for i, j in chunks(text_buffers(batch.column(column))[1], limit):
            yield batch.slice(i, j - i)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words per document) of the maximal non-white-space runs; none crosses a document border."""
    n = len(offsets) - 1
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(n, np.int64)
    ink = ~WHITESPACE[data]
    border = np.zeros(len(data) + 1, dtype=bool)
    border[offsets] = True
    starts = ink.copy()
    starts[1:] &= ~ink[:-1] | border[1:-1]
    ends = ink.copy()
    ends[:-1] &= ~ink[1:] | border[1:-1]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return begin, end, np.diff(np.searchsorted(begin, offsets))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words per document), chunk by chunk."""
    parts, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for i, j in chunks(offsets):
        piece, own = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        begin, end, n = words(piece, own)
        parts.append(span_hashes(piece, begin, end))
        counts.append(n)
    return np.concatenate(parts), np.concatenate(counts)


def distinct(x: np.ndarray) -> np.ndarray:
    """The ascending distinct values, by one sort."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def within(counts: np.ndarray, n: int) -> np.ndarray:
    """Mask over all positions but the last ``n - 1``: the run of ``n`` items from here ends in the same document."""
    total = int(counts.sum())
    if total < n:
        return np.empty(0, dtype=bool)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(total)
    return left[: total - n + 1] >= n


def cover(starts: np.ndarray, width: int, size: int) -> np.ndarray:
    """Mask of length ``size``: positions covered by a window of ``width`` from any of ``starts``."""
    if not len(starts):
        return np.zeros(size, dtype=bool)
    steps = np.bincount(starts, minlength=size + 1)
    steps -= np.bincount(np.minimum(starts + width, size), minlength=size + 1)
    return np.cumsum(steps[:size]) > 0


# -- groups of whole documents ---------------------------------------------------------------------------------------

def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts; one aggregate over the lengths."""
    return docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0


def group_count(docs: DataFrame, text: str = "text", group_bytes: int = GROUP_BYTES, total: int | None = None) -> int:
    """How many text groups the table needs; ``total``: its ``text_bytes``, if known."""
    total = text_bytes(docs, text) if total is None else total
    spare = docs.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(total / group_bytes), min(spare, math.ceil(total / CHUNK_BYTES)))


def text_groups(docs: DataFrame, groups: int, key: str = "doc_id", text: str = "text", rest: F.Column | None = None) -> DataFrame:
    """(g, doc_id, text), and ``rest`` if given: whole documents dealt to ``groups`` groups by a hash of their id and text.

    Copies of a text differ in id and so spread; the one shuffle of the texts
    is an explicit repartition, so later steps over the same groups reuse it.
    """
    g = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(groups)).cast("int")
    along = [rest.alias("rest")] if rest is not None else []
    return docs.select(g.alias("g"), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *along).repartition(groups, "g")


def sorted_group(table: pa.Table) -> pa.Table:
    """The group's rows in a fixed order: by doc_id, repeated ids by text."""
    order = pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start")
    return table.take(order)


# -- the first-seen exchange -----------------------------------------------------------------------------------------

ASK = "g int, b int, payload binary"


#: The bits of hashes asked with ``short``: five bytes instead of eight are shuffled.
SHORT = _U(0xFFFFFFFFFF000000)


def _pack(hashes: np.ndarray, short: bool) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    return ((hashes >> _U(32)).astype(np.uint32), (hashes >> _U(24)).astype(np.uint8)) if short else hashes


def _unpack(asked: np.ndarray | tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return asked[0].astype(np.uint64) << _U(32) | asked[1].astype(np.uint64) << _U(24) if isinstance(asked, tuple) else asked


def ask_rows(g: int, hashes: np.ndarray, buckets: int, *values: np.ndarray, short: bool = False) -> dict:
    """Columns of the ask rows for ascending ``hashes`` (and aligned values), one row per bucket that has any."""
    owner = ((hashes >> _U(32)) * _U(buckets)) >> _U(32)
    cut = np.searchsorted(owner, np.arange(buckets + 1, dtype=np.uint64))
    out = {"g": [], "b": [], "payload": []}
    for b in np.flatnonzero(np.diff(cut)):
        part = slice(cut[b], cut[b + 1])
        out["g"].append(g)
        out["b"].append(int(b))
        out["payload"].append(pickle.dumps((_pack(hashes[part], short), *(squeeze(v[part]) for v in values)), 5))
    return out


def ask_presence(g: int, hashes: np.ndarray, buckets: int) -> dict:
    """Ask rows that carry ascending distinct ``hashes`` alone, as gaps of 32-bit places inside their bucket.

    Gaps are stored byte plane by byte plane, which the shuffle's compression
    shrinks to under three bytes each.  Two hashes at one place (about one in
    ten thousand for a full bucket, at any number of buckets) count as equal.
    """
    scaled = (hashes >> _U(24)) * _U(buckets)
    owner, place = scaled >> _U(40), (scaled >> _U(8)).astype(np.uint32)
    cut = np.searchsorted(owner, np.arange(buckets + 1, dtype=np.uint64))
    out = {"g": [], "b": [], "payload": []}
    for b in np.flatnonzero(np.diff(cut)):
        gaps = np.diff(place[cut[b]:cut[b + 1]], prepend=np.uint32(0))
        out["g"].append(g)
        out["b"].append(int(b))
        out["payload"].append(gaps.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())
    return out


def answer_presence(asks: DataFrame) -> DataFrame:
    """Reply to ``ask_presence``, one bit per asked hash: does another group ask for its place too?"""
    def bucket(_key: tuple, table: pa.Table) -> pa.Table:
        asked = [np.cumsum(np.frombuffer(p, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel(), dtype=np.uint32) for p in table.column("payload").to_pylist()]
        every = np.concatenate([distinct(a) for a in asked])
        every.sort()
        twice = distinct(every[1:][every[1:] == every[:-1]])
        bits = []
        for a in asked:
            at = np.searchsorted(twice, a)
            hit = np.zeros(len(a), dtype=bool)
            inside = at < len(twice)
            hit[inside] = twice[at[inside]] == a[inside]
            bits.append(pickle.dumps(np.packbits(hit), 5))
        return pa.table({"g": table.column("g").cast(pa.int32()), "b": table.column("b").cast(pa.int32()), "payload": pa.array(bits, pa.binary())})

    return asks.groupBy("b").applyInArrow(bucket, ASK)


def presence_replies(table: pa.Table, g: int, hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The replies to ``ask_presence`` in the order of ``hashes``."""
    cut = np.searchsorted(((hashes >> _U(24)) * _U(buckets)) >> _U(40), np.arange(buckets + 1, dtype=np.uint64))
    out = np.zeros(len(hashes), dtype=bool)
    for b, payload in zip(table.column("b").to_pylist(), table.column("payload").to_pylist()):
        a, z = cut[b % buckets], cut[b % buckets + 1]
        out[a:z] = np.unpackbits(pickle.loads(payload), count=z - a).astype(bool)
    return out


def tagged(replies: DataFrame, tag: int, buckets: int) -> DataFrame:
    """Replies whose bucket numbers are moved by ``tag`` times ``buckets``, to send several kinds together."""
    return replies.withColumn("b", (F.col("b") + tag * buckets).cast("int"))


def of_kind(table: pa.Table, tag: int, buckets: int) -> pa.Table:
    """The replies of one kind."""
    return table.filter(pa.array(np.asarray(table.column("b"), dtype=np.int64) // buckets == tag))


def ask_table(columns: dict) -> pa.Table:
    return pa.table({"g": pa.array(columns["g"], pa.int32()), "b": pa.array(columns["b"], pa.int32()), "payload": pa.array(columns["payload"], pa.binary())})


def squeeze(v: np.ndarray) -> np.ndarray:
    """Booleans as bits, small integers in narrow types: less to shuffle."""
    if v.dtype == bool or not len(v):
        return v
    if v.dtype == np.int64:
        low, high = int(v.min()), int(v.max())
        for kind in (np.int8, np.int16, np.int32):
            if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
                return v.astype(kind)
    return v


def answer(asks: DataFrame, resolve: Callable[..., np.ndarray], positives: bool = False, sparse: bool = False) -> DataFrame:
    """Resolve each bucket: ``resolve(group of each entry, hashes, *values)`` gives one reply value per entry.

    Replies go back as rows of the same shape and order as the asks; with
    ``positives`` the reply is instead the list of hashes whose value is true;
    with ``sparse`` ``resolve`` returns (mask, values) and the reply lists the
    hashes of the mask with their values.
    A bucket is a hash range sized like a text group.
    """
    def bucket(_key: tuple, table: pa.Table) -> pa.Table:
        asked = [(_unpack(h), *values) for h, *values in map(pickle.loads, table.column("payload").to_pylist())]
        sizes = [len(x[0]) for x in asked]
        groups = np.repeat(np.asarray(table.column("g"), dtype=np.int64), sizes)
        said = resolve(groups, *(np.concatenate(parts) for parts in zip(*asked)))
        cut = np.cumsum([0, *sizes])
        if sparse:
            mask, said = said
            payload = [pickle.dumps((x[0][mask[a:b]], squeeze(said[a:b][mask[a:b]])), 5) for x, a, b in zip(asked, cut[:-1], cut[1:])]
        else:
            payload = [pickle.dumps(x[0][said[a:b]] if positives else squeeze(said[a:b]), 5) for x, a, b in zip(asked, cut[:-1], cut[1:])]
        return pa.table({"g": table.column("g").cast(pa.int32()), "b": table.column("b").cast(pa.int32()), "payload": pa.array(payload, pa.binary())})

    return asks.groupBy("b").applyInArrow(bucket, ASK)


def replies(table: pa.Table) -> np.ndarray:
    """The group's replies, in the ascending hash order in which it asked."""
    if not table.num_rows:
        return np.empty(0, dtype=np.int64)
    rows = sorted(zip(table.column("b").to_pylist(), table.column("payload").to_pylist()))
    return np.concatenate([pickle.loads(p) for _, p in rows])


def sparse_replies(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(ascending hashes, values) of a group's sparse replies."""
    if not table.num_rows:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    rows = sorted(zip(table.column("b").to_pylist(), table.column("payload").to_pylist()))
    hashes, values = zip(*(pickle.loads(p) for _, p in rows))
    return np.concatenate(hashes), np.concatenate(values)


def elsewhere(groups: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Reply: does another group ask for the same hash?  (A group asks for a hash once.)"""
    _, inverse, count = np.unique(hashes, return_inverse=True, return_counts=True)
    return count[inverse] > 1


def earlier_elsewhere(groups: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Reply: does another group hold the hash in a document with a smaller id?"""
    return group_min(hashes, first) < first


def group_min(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each entry, the smallest value among entries of the same key."""
    if not len(keys):
        return values
    order = np.argsort(keys, kind="stable")
    k, v = keys[order], values[order]
    head = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    low = np.minimum.reduceat(v, head)
    out = np.empty_like(values)
    out[order] = np.repeat(low, np.diff(np.r_[head, len(k)]))
    return out


def first_of(hashes: np.ndarray, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ascending distinct hashes, index of the first entry of each, class of every entry)."""
    distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    return distinct, first, inverse


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, so that tasks import it wherever they run; once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix=f"{package.name}-package-")
    archive = os.path.join(folder, f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder named by spark.checkpoint.dir and read it back: cuts the lineage."""
    path = f"{scratch_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
