"""Operator 2: bottom-k fingerprints of word-shingle sets.

A fingerprint is the ``k`` smallest distinct 40-bit hashes of a text's shingles
(five words), written in base64 in ascending order.  It is
mergeable: the sketch of a union is the ``k`` smallest of both sketches.  From
two sketches follow resemblance (share of common hashes among the ``k``
smallest of the union), containment, and the distinct shingle count
((k - 1) / the k-th smallest as a fraction of the hash range).  Below ``k``
shingles all three are exact; above, the standard error of the resemblance J is
sqrt(J (1 - J) / k), at most 0.032 for k = 256.

``op2`` also needs every document's successor by id.  Documents are dealt to id
ranges (bounds from an approximate percentile, so of about equal count); the
text that opens a range also goes to the range before it, and the first text of
all to the last.  Within a range rows stream in id order, two texts at a time.
Texts travel compressed.

Cases: null counts as empty.  A text of fewer than five words is one shingle;
without words the sketch is empty.  Two empty sketches have likeness 1, an
empty and another 0.  Repeated ids follow one another in a fixed order, null ids
come first.  A single document is its own successor.  Extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import core

K, SHINGLE = 256, 5
#: Bits of a shingle hash: wide enough for sketches of about 10**10 distinct shingles.
BITS = 40


# -- sketches --------------------------------------------------------------------------------------------------------

def sketches(data: np.ndarray, offsets: np.ndarray, k: int = K, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Bottom-k sketch (ascending hashes) of every text of a buffer."""
    words, counts = core.word_hashes(data, offsets)
    grams = core.sequence_hashes(words, shingle) >> np.uint64(64 - BITS)
    cut = np.r_[0, np.cumsum(counts)]
    out = []
    for a, n in zip(cut[:-1].tolist(), counts.tolist()):
        if n >= shingle:
            own = grams[a:a + n - shingle + 1]
            if len(own) > 8 * k:  # the k smallest distinct lie among these unless repeats crowd them out
                low = np.unique(np.partition(own, 4 * k)[:4 * k])
                if len(low) > k:
                    out.append(low[:k])
                    continue
            out.append(np.unique(own)[:k])
        elif n:
            power = core.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
            out.append(core.mix(np.array([(words[a:a + n] * power).sum()], dtype=np.uint64)) >> np.uint64(64 - BITS))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def merge(*parts: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of the sketched sets."""
    return np.unique(np.concatenate(parts))[:k] if parts else np.empty(0, np.uint64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated |A and B| / |A or B|."""
    if not len(a) and not len(b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    both = np.concatenate([a, b])
    both.sort()
    fresh = np.r_[True, both[1:] != both[:-1]]
    union = np.flatnonzero(fresh)[:k]
    last = both[union[-1]]
    common = int(np.count_nonzero(~fresh & (both <= last)))
    return common / len(union)


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[-1]) + 1) / 2.0**BITS)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of A's shingles that are in B."""
    if not len(a):
        return 1.0
    union = distinct(merge(a, b, k=k), k)
    return min(1.0, resemblance(a, b, k) * union / distinct(a, k))


def write(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8:].tobytes()).decode()


def parse(text: str) -> np.ndarray:
    low = np.frombuffer(base64.b64decode(text), dtype=np.uint8).reshape(-1, BITS // 8)
    wide = np.zeros((len(low), 8), dtype=np.uint8)
    wide[:, 8 - BITS // 8:] = low
    return wide.view(">u8").ravel().astype(np.uint64)


# -- operators -------------------------------------------------------------------------------------------------------

def fingerprints(docs: DataFrame, k: int = K, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint): a narrow map over whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in core.pieces(batches, 1):
            data, offsets = core.text_buffers(batch.column(1))
            marks = [write(s) for s in sketches(data, offsets, k, shingle)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), text).mapInArrow(run, "doc_id long, fingerprint string")


def merged(marks: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """One fingerprint per value of ``by``: the k smallest hashes of its parts.

    Parts are merged inside each input partition first, so a hot value costs one
    sketch per partition.
    """
    schema = ", ".join([*(f"`{c}` {marks.schema[c].dataType.simpleString()}" for c in by), "fingerprint string"])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for *own, mark in zip(*(batch.column(c).to_pylist() for c in [*by, "fingerprint"])):
                own = tuple(own)
                kept[own] = merge(kept[own], parse(mark), k=k) if own in kept else parse(mark)
        columns = list(zip(*((*own, write(s)) for own, s in kept.items()))) if kept else [[]] * (len(by) + 1)
        fields = [batch.schema.field(c).type for c in by] if kept else [pa.null()] * len(by)
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [*fields, pa.string()])], names=[*by, "fingerprint"])

    def total(table: pa.Table) -> pa.Table:
        mark = write(merge(*(parse(m) for m in table.column("fingerprint").to_pylist()), k=k))
        return table.select(by).slice(0, 1).append_column("fingerprint", pa.array([mark], pa.string()))

    return marks.select(*by, "fingerprint").mapInArrow(local, schema).groupBy(*by).applyInArrow(total, schema)


def _in_id_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(part, doc_id, last, body): id ranges, each ended by the text that opens the next one (``last``)."""
    groups = core.group_count(docs, text)
    ids = F.coalesce(F.col(key).cast("long"), F.lit(int(core._NULL_ID)))
    row = docs.select(ids.alias("id")).agg(F.min("id"), F.percentile_approx("id", [i / groups for i in range(1, groups)] or [0.5], 10_000)).first()
    lowest = row[0] if row[0] is not None else 0
    opens = np.unique(np.array([lowest, *[x for x in (row[1] or []) if x > lowest]][: groups + 1], dtype=np.int64))
    if groups == 1:
        opens = opens[:1]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            own = core.id_array(batch.column(0))
            part = np.searchsorted(opens, own, side="right") - 1
            first = opens[part] == own  # may open its range
            body = [pack.compress((t.as_buffer().to_pybytes()) if t.is_valid else b"") for t in batch.column(1).cast(pa.large_binary())]
            where = np.flatnonzero(first)
            before = (part[where] - 1) % len(opens)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.r_[part, before].astype(np.int32)), pa.array(np.r_[np.zeros(len(own), bool), np.ones(len(where), bool)]),
                pa.array(np.r_[own, own[where]]), pa.array([*body, *(body[i] for i in where)], pa.binary()),
            ], names=["part", "last", "id", "body"])

    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dealt = slim.mapInArrow(deal, "part int, last boolean, id long, body binary")
    return dealt.repartition(len(opens), "part").sortWithinPartitions("part", "last", "id", F.md5("body"))


def edited_pairs(docs: DataFrame, k: int = K, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Contract columns of ``op2``: each text, its edited text (second half from the next document) and their likeness."""
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def flush(rows: list[tuple[int, bytes]], following: bytes) -> pa.RecordBatch:
        texts = [b for _, b in rows]
        edited, chars = [], []
        for own, nxt in zip(texts, [*texts[1:], following]):
            whole, other = own.decode(), nxt.decode()
            half = len(whole) // 2
            chars.append(len(whole))
            edited.append((whole[:len(whole) - half] + other[:half]).encode())
        every = [*texts, following, *edited]
        offsets = np.r_[0, np.cumsum([len(b) for b in every])]
        marks = sketches(np.frombuffer(b"".join(every), dtype=np.uint8), offsets, k, shingle)
        own, changed = marks[:len(texts) + 1], marks[len(texts) + 1:]
        return pa.RecordBatch.from_arrays([
            pa.array([None if i == core._NULL_ID else i for i, _ in rows], pa.int64()), pa.array(chars, pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in edited]), pa.array([write(s) for s in own[:-1]], pa.string()),
            pa.array([write(s) for s in changed], pa.string()),
            pa.array([resemblance(a, b, k) for a, b in zip(own, changed)], pa.float64()),
            pa.array([resemblance(a, b, k) for a, b in zip(own, own[1:])], pa.float64()),
        ], names=[c.split()[0] for c in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        rows: list[tuple[int, bytes]] = []
        size, ended = 0, False
        for batch in batches:
            for last, own, packed in zip(batch.column("last").to_pylist(), batch.column("id").to_pylist(), batch.column("body").to_pylist()):
                if last and (ended or not rows):  # of several rows with the opening id only the first ends the range
                    continue
                body = unpack.decompress(packed) if packed else b""
                if last or size > core.CHUNK_BYTES:
                    yield flush(rows, body)
                    rows, size = [], 0
                ended = last
                if not last:
                    rows.append((own, body))
                    size += len(body)

    return _in_id_order(docs, key, text).mapInArrow(run, schema)


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_pairs(core.read(spark, sf_dir, "documents"))
