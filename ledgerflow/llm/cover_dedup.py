"""Operator 8: substring deduplication by difference-cover anchors, on words.

A window is ``width`` consecutive words.  Word positions of a document are
taken modulo ``period``; only positions whose remainder lies in a difference
cover are hashed, over ``width - period + 1`` words.  For any two equal
windows some shift below ``period`` puts both on cover positions, so they share
an anchor hash.  Steps, each over whole text groups (``core``):

1. groups ask which anchor hashes occur in another document;
2. windows around repeated anchors (the extension) are hashed in full and asked
   with the smallest document id of the group that has them;
3. windows that start in an earlier document are removed, word by word.

Per hash and group one entry is shuffled, so a passage shared by a third of all
documents costs its bucket one entry per group.

Cases: null or empty text and texts of fewer than ``width`` words lose nothing;
an empty document's kept text is the empty string.  Rows with the same doc_id
are not earlier than each other; a null doc_id comes before all others.  Extra
columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import core

WINDOW = 13
#: A perfect difference set - every remainder is a difference of two members modulo the period.
PERIOD, COVER = 7, (0, 1, 3)


class _Group:
    """Word hashes of one text group; ``doc`` is the row of each word, ``order`` the id of each row."""

    def __init__(self, table: pa.Table):
        self.table = core.sorted_group(table)
        self.data, self.offsets = core.text_buffers(self.table.column("text"))
        self.order = core.id_array(self.table.column("doc_id"))
        self.words, self.counts = core.word_hashes(self.data, self.offsets)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)

    def anchors(self, width: int, period: int, cover: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the anchors."""
        span = width - period + 1
        place = np.arange(len(self.words)) - np.repeat(np.cumsum(self.counts) - self.counts, self.counts)
        ok = core.within(self.counts, span)
        ok &= np.isin(place[: len(ok)] % period, cover)
        return np.flatnonzero(ok), core.sequence_hashes(self.words, span)[ok]

    def first_seen(self, at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct hashes, id of the first document of each, is the entry in a later document than that)."""
        distinct, first, inverse = core.first_of(hashes)
        ids = self.order[self.doc[at]]
        lead = ids[first]
        return distinct, lead, ids > lead[inverse]


def remove_repeats(docs: DataFrame, width: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): words covered by a window that also starts in an earlier document are gone."""
    if {(a - b) % period for a in cover for b in cover} != set(range(period)) or period > width:
        raise ValueError("not a difference cover of the period")
    groups = core.group_count(docs, text)
    texts = core.text_groups(docs, groups, key, text)
    span = width - period + 1

    def ask_anchors(key: tuple, table: pa.Table) -> pa.Table:
        own = _Group(table)
        _, hashes = own.anchors(width, period, cover)
        return core.ask_table(core.ask_rows(key[0].as_py(), np.unique(hashes), groups))

    def ask_windows(key: tuple, table: pa.Table, said: pa.Table) -> pa.Table:
        own = _Group(table)
        at, hashes = own.anchors(width, period, cover)
        distinct, _, later = own.first_seen(at, hashes)
        which = np.searchsorted(distinct, hashes)
        repeated = core.replies(said).astype(bool)
        repeated[which[later]] = True
        hit = at[repeated[which]]
        ok = core.within(own.counts, width)
        ok &= core.cover(np.maximum(hit - (width - span), 0), width - span + 1, len(own.words))[: len(ok)]
        starts = np.flatnonzero(ok)
        distinct, lead, _ = own.first_seen(starts, core.sequence_hashes(own.words, width)[ok])
        return core.ask_table(core.ask_rows(key[0].as_py(), distinct, groups, lead))

    def strip(_key: tuple, table: pa.Table, said: pa.Table) -> pa.Table:
        own = _Group(table)
        ok = core.within(own.counts, width)
        starts = np.flatnonzero(ok)
        hashes = core.sequence_hashes(own.words, width)[ok]
        _, _, gone = own.first_seen(starts, hashes)
        gone |= np.isin(hashes, core.replies(said).astype(np.uint64))
        removed = core.cover(starts[gone], width, len(own.words))
        n_removed = np.bincount(own.doc[removed], minlength=len(own.counts))
        kept = _join_words(own, removed)
        return pa.table({"doc_id": own.table.column("doc_id"), "n_words": pa.array(own.counts, pa.int64()), "n_removed": pa.array(n_removed.astype(np.int64)), "kept_text": kept})

    anchors = core.answer(texts.groupBy("g").applyInArrow(ask_anchors, core.ASK), core.elsewhere)
    asked = texts.groupBy("g").cogroup(anchors.groupBy("g")).applyInArrow(ask_windows, core.ASK)
    windows = core.answer(asked, core.earlier_elsewhere, positives=True)
    return texts.groupBy("g").cogroup(windows.groupBy("g")).applyInArrow(strip, "doc_id long, n_words long, n_removed long, kept_text string")


def _join_words(own: _Group, removed: np.ndarray) -> pa.Array:
    """The kept words of each document, joined by one space."""
    kept, word = [], 0
    for i, j in core.chunks(own.offsets):
        data = own.data[own.offsets[i]:own.offsets[j]]
        offsets = own.offsets[i:j + 1] - own.offsets[i]
        begin, end, counts = core.words(data, offsets)
        stay = ~removed[word:word + len(begin)]
        word += len(begin)
        begin, end = begin[stay], end[stay]
        last = offsets[1:][np.searchsorted(offsets[1:], begin, side="right")] if len(begin) else begin
        step = np.bincount(begin, minlength=len(data) + 1) - np.bincount(end, minlength=len(data) + 1)
        keep = np.cumsum(step[: len(data)]) > 0
        gap = end[end < last]
        keep[gap] = True
        out = data.copy()
        out[gap] = 0x20
        sizes = np.r_[0, np.cumsum(keep)][offsets]
        flat = out[keep].tobytes()
        kept += [flat[a:b].removesuffix(b" ") for a, b in zip(sizes[:-1], sizes[1:])]
    return pa.array(kept, pa.binary()).cast(pa.string())


def op8_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(core.read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


#: DuckDB: every window of every document, no anchors.
SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)
), earliest AS (
  SELECT k, min(doc_id) AS first_id FROM windows GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN earliest USING (k) WHERE first_id < doc_id
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
