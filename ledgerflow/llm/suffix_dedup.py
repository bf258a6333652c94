"""Operator 3: suffix-array deduplication by longest-previous-factor arrays, on UTF-8 bytes.

A byte goes when a string of ``length`` bytes covering it also starts earlier.
That is a longest previous factor (LPF) of at least ``length``: in suffix order the
previous or the next smaller position shares the first ``length`` bytes.

The suffix array is sparse.  In each run of ``length`` bytes the ``gram`` with
the smallest hash (a minimiser) is an anchor, so equal strings hold equal
anchors at equal places, and only suffixes around anchors that repeat are
sorted.  Steps over whole text groups (``core``):

1. groups ask for each distinct anchor context (all bytes that windows around
   the anchor can reach): does it occur in an earlier document, and does the
   anchor occur with another context anywhere?  Equal context: every window of
   the later one repeats, no sorting needed.
2. anchors with several contexts: the windows around the first of each context
   go into a suffix array by prefix doubling; where the LPF reaches ``length``
   the window is a later copy, the others, the first of their bytes in the group,
   are asked for across groups under a hash of those bytes.
3. covered bytes are removed; the first copy stays.

Per context or window class and group one entry is shuffled, so a hot passage
costs its bucket one entry per group.

Cases: null or empty text and texts shorter than ``length`` bytes lose nothing.
Repeated ids count as separate documents in the order of their texts; a null id
comes before all others.  Extra columns are ignored.  An empty table gives an
empty result.  Kept bytes may cut characters apart, so they are binary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from . import core

LENGTH = 100
GRAM = 32
#: Bytes of text in a group; ranking its suffixes takes about forty times as much memory.
GROUP_BYTES = 4 << 20
_LOW = np.uint64(0xFFFFFFFF)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_HIGH = np.uint64(0xFFFFFFFF00000000)


# -- suffix arrays ---------------------------------------------------------------------------------------------------

_FIRST = 7  # bytes told apart by the first sort: nine bits each in one number


def suffix_ranks(data: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Rank of every suffix of ``data`` by its first ``length`` bytes (prefix doubling).

    ``ends`` holds, for each position, where its string ends; bytes past the end
    sort before all others.  Equal ranks (from 1): equal first ``length`` bytes.
    Until the end a rank is the number of suffixes before its class, so a suffix
    that is alone keeps it, and each doubling sorts only those that share theirs.
    """
    n = len(data)
    have = min(_FIRST, length)
    near = np.flatnonzero(ends - np.arange(n, dtype=ends.dtype) < have)  # bytes past the end are none
    over = (9 * (have - (ends[near] - near))).astype(np.uint64)
    first = np.zeros(n, dtype=np.uint64)
    for j in range(have):
        first <<= np.uint64(9)
        first[: max(0, n - j)] += data[j:]
        first[: max(0, n - j)] += np.uint64(1)
    first[near] = first[near] >> over << over
    order = np.argsort(first).astype(np.int32)
    first = first[order]
    head = np.concatenate([[True], first[1:] != first[:-1]]) if n else np.empty(0, bool)
    del first
    at = np.flatnonzero(head).astype(np.int32)
    size = np.diff(np.concatenate([at, np.array([n], np.int32)]))
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.repeat(at, size)
    active = order[np.repeat(size > 1, size)]
    del order, at, size, head
    while have < length and len(active):
        step = min(have, length - have)
        inside = active + step < ends[active]
        pair = rank[active] * np.int64(n + 2)
        pair[inside] += rank[active[inside] + step] + np.int64(1)
        del inside
        turn = np.argsort(pair)
        active, pair = active[turn], pair[turn]
        del turn
        head = np.concatenate([[True], pair[1:] != pair[:-1]])
        del pair
        at = np.flatnonzero(head).astype(np.int32)
        size = np.diff(np.concatenate([at, np.array([len(active)], np.int32)]))
        old = rank[active[at]]
        opens = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
        start = np.repeat(at[opens], np.diff(np.concatenate([opens, [len(at)]])))
        rank[active] = np.repeat(old + at - start, size)
        active = active[np.repeat(size > 1, size)]
        have += step
    used = np.zeros(n, dtype=bool)
    used[rank] = True
    return np.cumsum(used, dtype=np.int32)[rank]


def lpf(data: bytes, length: int | None = None) -> np.ndarray:
    """Longest previous factor of every position of one string, by previous and next smaller positions in suffix order.

    Values are cut at ``length`` (default: not cut).
    """
    raw = np.frombuffer(data, dtype=np.uint8)
    n = len(raw)
    limit = n if length is None else length
    rank = suffix_ranks(raw, np.full(n, n), max(1, limit))
    order = np.lexsort((np.arange(n), rank))

    def common(i: int, j: int) -> int:
        m = min(limit, n - max(i, j))
        differ = np.flatnonzero(raw[i:i + m] != raw[j:j + m])
        return int(differ[0]) if len(differ) else m

    out = np.zeros(n, dtype=np.int64)
    for walk in (order, order[::-1]):  # previous smaller, then next smaller
        open_positions: list[int] = []
        for p in walk.tolist():
            while open_positions and open_positions[-1] > p:
                open_positions.pop()
            if open_positions:
                out[p] = max(out[p], common(open_positions[-1], p))
            open_positions.append(p)
    return out


def previous_factors(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For suffixes in text order, ranked by their first ``length`` bytes: where the longest previous factor reaches ``length``.

    Suffix order is by rank, then by position.  The previous smaller position of a
    suffix stands right before it if that one has the same rank (shares ``length``
    bytes); if not, neither its previous nor its next smaller position shares them,
    and the suffix is the first of its class.  Returns (index of the first of each
    class, class of each suffix, mask of those with such an earlier factor).
    """
    order = np.argsort(rank, kind="stable").astype(np.int32)
    ranked = rank[order]
    same = np.concatenate([[False], ranked[1:] == ranked[:-1]]) if len(rank) else np.empty(0, bool)
    del ranked
    later = np.empty(len(rank), dtype=bool)
    later[order] = same
    group = np.empty(len(rank), dtype=np.int32)
    group[order] = np.cumsum(~same, dtype=np.int32) - 1
    return order[~same], group, later


def _covered(starts: np.ndarray, ends: np.ndarray, size: int, apart: bool = False) -> np.ndarray:
    """Mask of the positions in any of the spans; ``apart``: no two begin or end at one place."""
    steps = np.zeros(size + 1, dtype=np.int32)
    if apart:
        steps[starts] += 1
        steps[ends] -= 1
    else:
        np.add.at(steps, starts, 1)
        np.subtract.at(steps, ends, 1)
    return np.cumsum(steps[:size], out=steps[:size]) > 0


# -- groups ----------------------------------------------------------------------------------------------------------

def _lowest(h: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each run of ``span`` values, by doubling."""
    have = 1
    while have < span:
        step = min(have, span - have)
        h = np.minimum(h[: len(h) - step], h[step:])
        have += step
    return h


class _Group:
    """Anchors of one text group, in text order: ``gram``, ``context`` hashes and byte position ``at``."""

    def __init__(self, table: pa.Table, length: int, gram: int):
        self.length, self.gram_size = length, gram
        self.table = core.sorted_group(table)
        self.data, self.offsets = core.text_buffers(self.table.column("text"))
        self.order = core.id_array(self.table.column("doc_id"))
        parts = [self._anchors(i, j) for i, j in core.chunks(self.offsets)]
        empty = (np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64))
        self.gram, self.context, self.at = (np.concatenate(x) for x in zip(*parts, empty))
        self.doc = np.searchsorted(self.offsets, self.at, side="right") - 1
        self.from_, self.to = self.offsets[:-1][self.doc], self.offsets[1:][self.doc]

    def _anchors(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        base, top = self.offsets[i], self.offsets[j]
        data, offsets = self.data[base:top], self.offsets[i:j + 1] - self.offsets[i]
        sizes = np.diff(offsets)
        if not (sizes >= self.length).any():
            return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64)
        grams = core.window_hashes(data, self.gram_size)
        low = _lowest((grams & _HIGH) | np.arange(len(grams), dtype=np.uint64), self.length - self.gram_size + 1)
        left = np.repeat(offsets[1:], sizes)[: len(low)] - np.arange(len(low))
        low = (low[left >= self.length] & _LOW).astype(np.int64)
        at = core.distinct(low[np.concatenate([[True], low[1:] != low[:-1]])] if len(low) else low)
        doc = np.searchsorted(offsets, at, side="right") - 1
        lo = np.maximum(at - (self.length - self.gram_size), offsets[:-1][doc])
        hi = np.minimum(at + self.length, offsets[1:][doc])
        shape = (at - lo).astype(np.uint64) << np.uint64(32) | (hi - at).astype(np.uint64)
        # mixed once more: the smallest hashes of their windows would all go to the first hash ranges
        return core.mix(grams[at] ^ _SPREAD), core.mix(core.span_hashes(data, lo, hi) ^ core.mix(shape)), at + base

    def windows(self, of: np.ndarray) -> np.ndarray:
        """Mask over the bytes: a window that holds one of these anchors starts here."""
        lo = np.maximum(self.at[of] - (self.length - self.gram_size), self.from_[of])
        hi = np.minimum(self.at[of], self.to[of] - self.length) + 1
        return _covered(lo, hi, len(self.data))

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """(first anchor of each distinct context, in the order asked; place of each anchor's context in it)."""
        _, first, inverse = np.unique(self.context, return_index=True, return_inverse=True)
        turn = np.argsort(self.gram[first], kind="stable")
        place = np.empty_like(turn)
        place[turn] = np.arange(len(turn))
        return first[turn], place[inverse]

    def edges(self, first: np.ndarray, said: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The windows around anchors that have several contexts, by their previous factors:
        (starts, index of each class's first, class of each, mask of those with an earlier one in the group)."""
        marked = self.windows(first[said == _SEVERAL])
        starts = np.flatnonzero(marked).astype(np.int32)
        region = _covered(starts, starts + np.int32(self.length), len(self.data), apart=True)
        where = np.flatnonzero(region).astype(np.int32)
        if not len(where):
            return starts, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        del region
        runs = np.concatenate([[True], (np.diff(where) > 1) | region_border(self.offsets, where)])
        ends = np.concatenate([np.flatnonzero(runs)[1:], [len(where)]]).astype(np.int32)[np.cumsum(runs, dtype=np.int32) - 1]
        del runs
        marked = marked[where]
        bytes_ = self.data[where]
        del where
        return starts, *previous_factors(suffix_ranks(bytes_, ends, self.length)[marked])

    def hashes(self, starts: np.ndarray) -> np.ndarray:
        """Hash of the ``length`` bytes from each of the ascending ``starts``."""
        out = [np.empty(0, np.uint64)]
        for i, j in core.chunks(self.offsets):
            a, b = np.searchsorted(starts, self.offsets[[i, j]])
            if b > a:
                own = starts[a:b].astype(np.int64) - self.offsets[i]
                out.append(core.span_hashes(self.data[self.offsets[i]:self.offsets[j]], own, own + self.length))
        return np.concatenate(out)


def region_border(offsets: np.ndarray, where: np.ndarray) -> np.ndarray:
    """For each neighbouring pair of ascending byte positions: does a document start at the second?"""
    at = np.searchsorted(where, offsets)
    at = at[(at < len(where)) & (at > 0)]
    at = at[np.isin(where[at], offsets)]
    out = np.zeros(len(where) - 1, dtype=bool)
    out[at - 1] = True
    return out


#: Replies to a context: nothing else, an earlier document has it, or the anchor has other contexts.
_ALONE, _EARLIER, _SEVERAL = 0, 1, 2


def _resolve_contexts(groups: np.ndarray, gram: np.ndarray, context: np.ndarray, doc: np.ndarray) -> np.ndarray:
    earlier = core.group_min(context, doc) < doc
    distinct, first = np.unique(context, return_index=True)
    which, count = np.unique(gram[first], return_counts=True)
    several = count[np.searchsorted(which, gram)] > 1
    return np.where(earlier, _EARLIER, np.where(several, _SEVERAL, _ALONE)).astype(np.int8)


def rewrite(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the kept text in place; bytes of a character cut apart go with it.  Other columns ride along."""
    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text))
    out = remove_repeats(docs, length, gram, key, text, rest)
    return out.select("rest.*", F.col("kept").cast("string").alias(text)).select(*docs.columns)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, key: str = "doc_id", text: str = "text", rest: F.Column | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary): later copies of strings of ``length`` bytes are gone, the first stays.

    A struct column ``rest`` goes along unchanged; then the halves of a cut character are left out too.
    """
    groups = core.group_count(docs, text, GROUP_BYTES)
    texts = core.text_groups(docs, groups, key, text, rest)

    rest_ddl = texts.schema["rest"].dataType.simpleString() if rest is not None else None
    rest_type = to_arrow_schema(StructType.fromDDL(f"rest {rest_ddl}")).field("rest").type if rest is not None else None

    def ask_contexts(key: tuple, table: pa.Table) -> pa.Table:
        own = _Group(table, length, gram)
        first, _ = own.contexts()
        return core.ask_table(core.ask_rows(key[0].as_py(), own.gram[first], groups, own.context[first], own.order[own.doc[first]]))

    def ask_windows(key: tuple, table: pa.Table, said: pa.Table) -> pa.Table:
        own = _Group(table, length, gram)
        first, _ = own.contexts()
        starts, lead, _, _ = own.edges(first, core.replies(said))
        hashes = own.hashes(starts)[lead]
        ids = own.order[np.searchsorted(own.offsets, starts[lead], side="right") - 1]
        turn = np.argsort(hashes, kind="stable")
        return core.ask_table(core.ask_rows(key[0].as_py(), hashes[turn], groups, ids[turn]))

    def strip(_key: tuple, table: pa.Table, said: pa.Table) -> pa.Table:
        own = _Group(table, length, gram)
        phase = np.asarray(said.column("b"), dtype=np.int64) >= groups
        contexts, windows = (core.replies(said.filter(pa.array(m))) for m in (~phase, phase))
        first, place = own.contexts()
        again = np.ones(len(own.at), dtype=bool)
        again[first] = False
        gone = own.windows(np.flatnonzero(again | (contexts == _EARLIER)[place] if len(place) else again))
        starts, lead, group, later = own.edges(first, contexts)
        hashes = own.hashes(starts)[lead]
        turn = np.argsort(hashes, kind="stable")
        taken = np.zeros(len(lead), dtype=bool)
        taken[turn] = windows.astype(bool)
        gone[starts[later | taken[group]]] = True  # an earlier factor in this group or in another one
        gone = np.flatnonzero(gone).astype(np.int32)
        del starts, lead, group, later
        return _cut(own, _covered(gone, gone + length, len(own.data), apart=True), rest_type)

    contexts = core.answer(texts.groupBy("g").applyInArrow(ask_contexts, core.ASK), _resolve_contexts)
    asked = texts.groupBy("g").cogroup(contexts.groupBy("g")).applyInArrow(ask_windows, core.ASK)
    windows = core.answer(asked, core.earlier_elsewhere)
    both = contexts.unionAll(windows.withColumn("b", (F.col("b") + groups).cast("int")))
    along = f", rest {rest_ddl}" if rest is not None else ""
    return texts.groupBy("g").cogroup(both.groupBy("g")).applyInArrow(strip, f"doc_id long, n_bytes long, n_removed long, n_spans long, kept binary{along}")


def _cut(own: _Group, removed: np.ndarray, rest: pa.DataType | None = None) -> pa.Table:
    """The rows without the removed bytes; ``rest``: the type of the columns that go along, all of them nullable."""
    total = np.r_[0, np.cumsum(removed)]
    n_removed = np.diff(total[own.offsets])
    opens = removed.copy()
    opens[1:] &= ~removed[:-1]
    inner = own.offsets[(own.offsets > 0) & (own.offsets < len(removed))]
    opens[inner] = removed[inner]
    n_spans = np.diff(np.r_[0, np.cumsum(opens)][own.offsets])
    flat = own.data[~removed].tobytes()
    at = own.offsets - total[own.offsets]
    kept = [flat[a:b] for a, b in zip(at[:-1], at[1:])]
    if rest is not None:
        kept = [k.decode("utf-8", "ignore").encode() for k in kept]
    return pa.table({
        "doc_id": own.table.column("doc_id"), "n_bytes": pa.array(np.diff(own.offsets)), "n_removed": pa.array(n_removed),
        "n_spans": pa.array(n_spans), "kept": pa.array(kept, pa.binary()),
        **({"rest": own.table.column("rest").cast(rest)} if rest is not None else {}),
    })


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(core.read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
