"""Operator 10: n-gram Jaccard join by a prefix tree, and its connected components.

Documents are sets of distinct word n-grams (64-bit hashes).  Two documents
link when their Jaccard similarity reaches ``percent`` / 100.

*Bringing candidates together.*  Documents with equal sets are one class; only
the class's smallest id goes on.  A set less than ``percent`` of whose n-grams
occur in any other class cannot link and goes no further (groups ask for the
presence of their n-grams, under three bytes each).  Linked sets of sizes up to
``top`` differ in at most ``2 * top * (100 - percent) / (100 + percent)``
elements, so of more parts of the hash space than that at least one holds the
same elements in both.  Each set has one key per part without unshared n-grams,
for its own size band and for the next larger one; some parts more than needed
make it unnecessary to meet on empty parts and let a set leave the clusters that
only few of its keys lead to.  All documents with a common key go
to the cluster of the smallest id that has it, one copy of the set per cluster
however many keys agree.

*Joining a cluster.*  Its sets, in one global order (rare n-grams first, then by
hash), form a prefix tree.  Each set is walked through it: a node's overlap is
computed once for all sets below it, and a subtree is left as soon as its
overlap plus what can still come (the shorter remainder of the two sides) stays
under what the smallest set below needs.  No cap on candidates; a cluster above
``BLOCK`` sets is cut into blocks and every pair of blocks is one task.  Each
task returns a spanning forest of the links it found, never all pairs.

*Components* come from the union of these forests by alternating large-star and
small-star steps on written tables.

Cases: null or empty text is an empty set and links with nothing; fewer words
than ``n`` are one n-gram.  Equal sets always link.  A repeated id is one node:
what links to any of its rows links to it.  A null id never links and has a null
component.  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import core

N, PERCENT = 3, 90
#: Bytes of text in a group.
GROUP_BYTES = 4 << 20
#: Sets joined in one task at most; larger clusters are cut into blocks of this size.
BLOCK = 512
#: N-grams on one edge of the prefix tree.
EDGE = 16
_SPARE = 2  # parts beyond those needed, for empty ones
_U = np.uint64


# -- sets and their keys ---------------------------------------------------------------------------------------------

class _Group:
    """The n-gram sets of one text group: ``sets[lo[i]:lo[i+1]]`` ascending, rows by id."""

    def __init__(self, table: pa.Table, n: int):
        self.table = core.sorted_group(table)
        data, offsets = core.text_buffers(self.table.column("text"))
        self.order = core.id_array(self.table.column("doc_id"))
        words, counts = core.word_hashes(core.LOWER[data], offsets)
        doc = np.repeat(np.arange(len(counts)), counts)
        ok = core.within(counts, n)
        grams, owner = core.sequence_hashes(words, n)[ok], doc[: len(ok)][ok]
        short = np.flatnonzero((counts > 0) & (counts < n))
        if len(short):
            starts = np.cumsum(counts) - counts
            whole = np.array([core.mix(words[starts[i]:starts[i] + counts[i]] * _U(2 * k + 3)).sum() for k, i in zip(counts[short].astype(np.uint64), short)], dtype=np.uint64)
            grams, owner = np.concatenate([grams, whole]), np.concatenate([owner, short])
        cut = np.searchsorted(owner, np.arange(len(counts) + 1)) if not len(short) else None
        if cut is None:
            turn = np.argsort(owner, kind="stable")
            grams, owner = grams[turn], owner[turn]
            cut = np.searchsorted(owner, np.arange(len(counts) + 1))
        own = [core.distinct(grams[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]  # one short sort per document
        self.size = np.array([len(s) for s in own], dtype=np.int64)
        self.lo = np.r_[0, np.cumsum(self.size)]
        self.sets = np.concatenate([*own, np.empty(0, np.uint64)])
        self.owner = np.repeat(np.arange(len(own)), self.size)

    def identity(self) -> np.ndarray:
        """Hash of each whole set."""
        flat = np.r_[_U(0), np.cumsum(core.mix(self.sets ^ _U(0xA5A5A5A5A5A5A5A5)))]
        total = flat[self.lo[1:]] - flat[self.lo[:-1]]
        return core.mix(total ^ self.size.astype(np.uint64) * _U(0x9E3779B97F4A7C15))

    def usable(self) -> np.ndarray:
        return (self.size > 0) & (self.order != core._NULL_ID)


def bands(percent: int) -> np.ndarray:
    """Lower ends of the size bands: sizes of a band and the next hold every size a set can link with."""
    ends = [1]
    while ends[-1] < 1 << 40:
        ends.append(max(ends[-1] + 1, math.floor(ends[-1] * 100 / percent) + 1))
    return np.array(ends)


def differing(band: np.ndarray, ends: np.ndarray, percent: int) -> np.ndarray:
    """Elements in which linked sets of sizes up to the band's largest differ at most."""
    top = ends[band + 1] - 1
    return (2 * top * (100 - percent)) // (100 + percent)


def parts_of(band: np.ndarray, ends: np.ndarray, percent: int) -> np.ndarray:
    """Parts of the hash space for sets of two sizes up to the band's largest; 0 if only equal sets can link.

    Linked sets agree on one part at least, and beyond that on the spare ones
    and on half as many as they may differ in (see ``clusters_of``).
    """
    differ = differing(band, ends, percent)
    return np.where(differ > 0, differ + 1 + _SPARE + differ // 2, 0)


def clusters_of(own: _Group, row: np.ndarray, lead: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, cluster) from the shared keys' rows and leaders, without the clusters that a set can do without.

    Linked sets agree on ``differ // 2`` more parts than needed.  If each of two
    sets gives up keys of at most half that many, one common key is left; so each
    set leaves the clusters that fewest of its keys lead to, within that budget.
    """
    if not len(row):
        return row, lead
    turn = np.lexsort((lead, row))
    pairs = np.stack([row[turn], lead[turn]], axis=1)
    head = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)]))
    pairs, keys_of = pairs[head], np.diff(np.concatenate([head, [len(pairs)]]))
    ends = bands(percent)
    budget = differing(np.searchsorted(ends, own.size[pairs[:, 0]], side="right") - 1, ends, percent) // 2 // 2
    turn = np.lexsort((keys_of, pairs[:, 0]))
    pairs, keys_of, budget = pairs[turn], keys_of[turn], budget[turn]
    run = np.cumsum(keys_of)
    head = np.searchsorted(pairs[:, 0], pairs[:, 0])
    spent = run - (run[head] - keys_of[head])
    stay = spent > budget
    return pairs[stay, 0], pairs[stay, 1]


def keys(own: _Group, rows: np.ndarray, percent: int, shared: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) for each of ``rows``: hashes of the set's parts, in its own size band and the next.

    ``shared`` marks the elements that other sets hold too; a part with any
    other element has no key.
    """
    ends = bands(percent)
    out_key, out_row = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    if not len(rows):
        return out_key[0], out_row[0]
    band = np.searchsorted(ends, own.size[rows], side="right") - 1
    for ahead in (0, 1):
        parts = parts_of(band + ahead, ends, percent)
        row, number = np.repeat(rows, parts), np.repeat(parts, parts)
        if not len(row):
            continue
        part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        # parts are ranges of the upper half of the hash, so each is a slice of the ascending set
        per_row = np.zeros(len(own.size), dtype=np.uint64)
        per_row[rows] = parts
        place = ((own.sets >> _U(32)) * per_row[own.owner]) >> _U(32)
        first = np.zeros(len(own.size), dtype=np.int64)
        first[rows] = np.cumsum(parts) - parts
        has = per_row[own.owner] > 0
        slot = first[own.owner[has]] + place[has].astype(np.int64)
        held = np.bincount(slot, minlength=len(row))
        edge = np.cumsum(held)
        value = np.r_[_U(0), np.cumsum(core.mix(own.sets[has] ^ _U(0x5C5C5C5C5C5C5C5C)))]
        value = value[edge] - value[edge - held]
        whole = np.ones(len(row), dtype=bool)
        if shared is not None:
            whole[slot[~shared[has]]] = False
        empty = held == 0
        empties = np.bincount(np.searchsorted(rows, row), weights=empty, minlength=len(rows))[np.searchsorted(rows, row)]
        send = whole & (~empty | (empties > _SPARE))
        label = ((band[np.searchsorted(rows, row)] + ahead) << 32 | part).astype(np.uint64)
        out_key.append(core.mix(value ^ core.mix(label + _U(1)))[send])
        out_row.append(row[send])
    return np.concatenate(out_key), np.concatenate(out_row)


# -- the prefix tree -------------------------------------------------------------------------------------------------

class PrefixTree:
    """Distinct sets in one global order as a tree whose edges hold ``EDGE`` elements."""

    def __init__(self, sets: list[np.ndarray]):
        flat = np.concatenate(sets)
        size = np.array([len(s) for s in sets])
        element, number, often = np.unique(flat, return_inverse=True, return_counts=True)
        rank = np.empty(len(element), dtype=np.int64)
        rank[np.lexsort((element, often))] = np.arange(len(element))
        self.elements = len(element)
        width = max(1, -(-int(size.max()) // EDGE)) * EDGE
        matrix = np.full((len(sets), width), -1, dtype=np.int64)
        row = np.repeat(np.arange(len(sets)), size)
        value = rank[number]
        turn = np.lexsort((value, row))
        matrix[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = value[turn]
        lexical = np.lexsort(matrix.T[::-1])
        self.rows, self.matrix, self.size = lexical, matrix[lexical], size[lexical]
        # levels[d]: first row of each distinct path of (d + 1) * EDGE elements
        fresh = np.zeros(len(sets), dtype=bool)
        fresh[0] = True
        self.levels, self.largest, self.smallest = [], [], []
        for d in range(0, width, EDGE):
            fresh[1:] |= (self.matrix[1:, d:d + EDGE] != self.matrix[:-1, d:d + EDGE]).any(axis=1)
            heads = np.flatnonzero(fresh)
            self.levels.append(heads)
            self.largest.append(np.maximum.reduceat(self.size, heads))
            self.smallest.append(np.minimum.reduceat(self.size, heads))

    def walk(self, query: int, percent: int, after: bool = False) -> np.ndarray:
        """Rows (in tree order) that link with row ``query``; with ``after`` only those behind it."""
        n = int(self.size[query])
        own = self.matrix[query, :n]
        mark = np.zeros(self.elements + 1, dtype=bool)  # the last entry answers for the padding
        mark[own] = True
        total = len(self.rows)
        start, overlap, stop = np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([total])
        found, counts = [], []
        for d, heads in enumerate(self.levels):
            a, b = np.searchsorted(heads, start), np.searchsorted(heads, stop)
            children = np.repeat(a - np.r_[0, np.cumsum(b - a)[:-1]], b - a) + np.arange(int((b - a).sum()))
            base = np.repeat(overlap, b - a)
            start = heads[children]
            stop = np.r_[heads, total][children + 1]
            edge = self.matrix[start, d * EDGE:(d + 1) * EDGE]
            overlap = base + mark[edge].sum(axis=1)
            depth = (d + 1) * EDGE
            largest, smallest = self.largest[d][children], self.smallest[d][children]
            ended = smallest <= depth  # sets differ, so one of a node at most ends here: its first row
            found.append(start[ended])
            counts.append(overlap[ended])
            last = edge[:, -1]
            ahead = n - np.searchsorted(own, last, side="right")
            need = -(-percent * (n + smallest) // (100 + percent))
            go = (overlap + np.minimum(largest - depth, ahead) >= need) & (largest > depth)
            if after:
                go &= stop > query + 1
            start, stop, overlap = start[go], stop[go], overlap[go]
            if not len(start):
                break
        rows, common = np.concatenate(found), np.concatenate(counts)
        own = rows <= query if after else rows == query
        return rows[(100 * common >= percent * (n + self.size[rows] - common)) & ~own]


def forest(sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between ``sets``; with two sides only links between them count."""
    tree = PrefixTree(sets)
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    both = len(set(side.tolist())) == 2
    out = []
    for q in range(len(sets)):
        x = int(tree.rows[q])
        if both and side[x]:
            continue
        for y in tree.rows[tree.walk(q, percent, after=not both)].tolist():
            if both and not side[y]:
                continue
            a, b = root(x), root(y)
            if a != b:
                parent[b] = a
                out.append((x, y))
    return out


# -- the join --------------------------------------------------------------------------------------------------------

def _share(groups: np.ndarray, key: np.ndarray, first: np.ndarray, several: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys held by two documents at least, and the smallest id that has each."""
    order = np.argsort(key, kind="stable")
    head = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
    entries = np.diff(np.r_[head, len(key)])
    shared = np.empty(len(key), dtype=bool)
    shared[order] = np.repeat((entries > 1) | np.logical_or.reduceat(several[order], head), entries)
    return shared, core.group_min(key, first)


def _with(able: tuple[np.ndarray, np.ndarray], percent: int) -> tuple[np.ndarray, int, np.ndarray]:
    rows, shared = able
    return rows, percent, shared


def _packed(doc_id: int, hashes: np.ndarray) -> bytes:
    """An id and the upper six bytes of its set's hashes: enough to tell the n-grams of one cluster apart."""
    return doc_id.to_bytes(8, "little", signed=True) + (hashes >> _U(32)).astype("<u4").tobytes() + (hashes >> _U(16)).astype("<u2").tobytes()


def _unpacked(payload: bytes) -> tuple[int, np.ndarray]:
    m = (len(payload) - 8) // 6
    high, low = np.frombuffer(payload, "<u4", m, 8), np.frombuffer(payload, "<u2", m, 8 + 4 * m)
    return int.from_bytes(payload[:8], "little", signed=True), high.astype(np.uint64) << _U(16) | low


def links(docs: DataFrame, n: int = N, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(kind, a, b, size): ``doc`` rows (id, class representative, set size) and ``link`` rows (two ids), written."""
    groups = core.group_count(docs, text, GROUP_BYTES)
    texts = core.text_groups(docs, groups, key, text)
    schema = "kind string, a long, b long, size long"

    def frame(kind: str, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> pa.Table:
        return pa.table({"kind": pa.array([kind] * len(a), pa.string()), "a": pa.array(a.astype(np.int64)), "b": pa.array(b.astype(np.int64)), "size": pa.array(size.astype(np.int64))})

    def classes(own: _Group) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(usable rows, distinct identities, smallest id of each, class of each usable row)."""
        rows = np.flatnonzero(own.usable())
        distinct, first, inverse = core.first_of(own.identity()[rows])
        return rows, distinct, own.order[rows[first]], inverse

    def ask_classes(key: tuple, table: pa.Table) -> pa.Table:
        _, distinct, lead, _ = classes(_Group(table, n))
        return core.ask_table(core.ask_rows(key[0].as_py(), distinct, groups, lead))

    def lead_of(_groups: np.ndarray, identity: np.ndarray, lead: np.ndarray) -> np.ndarray:
        return core.group_min(identity, lead)

    def representatives(own: _Group, said: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(usable rows, representative id of each, rows that stand for their class)."""
        rows, _, _, inverse = classes(own)
        lead = said[inverse] if len(rows) else np.empty(0, np.int64)
        mine = np.flatnonzero(lead == own.order[rows]) if len(rows) else np.empty(0, np.int64)
        _, once = np.unique(np.c_[lead[mine], inverse[mine]], axis=0, return_index=True) if len(mine) else (None, np.empty(0, np.int64))
        return rows, lead, np.sort(rows[mine[once]])

    def elements(own: _Group, rows: np.ndarray) -> np.ndarray:
        """Mask of the elements of these rows."""
        mine = np.zeros(len(own.size), dtype=bool)
        mine[rows] = True
        return mine[own.owner]

    def ask_elements(key: tuple, table: pa.Table, said: pa.Table) -> pa.Table:
        own = _Group(table, n)
        _, _, rows = representatives(own, core.replies(said))
        return core.ask_table(core.ask_presence(key[0].as_py(), core.distinct(own.sets[elements(own, rows)]), groups))

    def able(g: int, own: _Group, said: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """(representatives that share enough elements to link at all, mask of shared elements)."""
        _, _, rows = representatives(own, core.replies(core.of_kind(said, 0, groups)))
        mine = elements(own, rows)
        distinct, place, often = np.unique(own.sets[mine], return_inverse=True, return_counts=True)
        found = core.presence_replies(core.of_kind(said, 1, groups), g, distinct, groups) | (often > 1)
        shared = np.zeros(len(own.sets), dtype=bool)
        shared[mine] = found[place]
        enough = 100 * np.bincount(own.owner[shared], minlength=len(own.size)) >= percent * own.size
        return rows[enough[rows]], shared

    def ask_keys(key: tuple, table: pa.Table, said: pa.Table) -> pa.Table:
        own = _Group(table, n)
        value, row = keys(own, *_with(able(key[0].as_py(), own, said), percent))
        value = value & core.SHORT  # a false agreement only adds a candidate
        distinct, first, inverse = core.first_of(value)
        low = core.group_min(value, own.order[row])
        several = np.zeros(len(distinct), dtype=bool)
        several[inverse[own.order[row] != low]] = True
        return core.ask_table(core.ask_rows(key[0].as_py(), distinct, groups, low[first], several, short=True))

    def name_clusters(key: tuple, table: pa.Table, said: pa.Table) -> pa.Table:
        own = _Group(table, n)
        value, row = keys(own, *_with(able(key[0].as_py(), own, said), percent))
        value = value & core.SHORT
        shared, lead = core.sparse_replies(core.of_kind(said, 2, groups))
        at = np.searchsorted(shared, value)
        hit = np.zeros(len(value), dtype=bool)
        inside = at < len(shared)
        hit[inside] = shared[at[inside]] == value[inside]
        row, cluster = clusters_of(own, row[hit], lead[at[hit]].astype(np.int64) if hit.any() else np.empty(0, np.int64), percent)
        return pa.table({"g": pa.array([key[0].as_py()] * len(row), pa.int32()), "cluster": pa.array(cluster), "row": pa.array(row.astype(np.int64)), "id": pa.array(own.order[row])})

    def documents(_key: tuple, table: pa.Table, said: pa.Table) -> pa.Table:
        own = _Group(table, n)
        rows, lead, _ = representatives(own, core.replies(said))
        rep = own.order.copy()
        rep[rows] = lead
        return frame("doc", own.order, rep, own.size)

    def send_sets(_key: tuple, table: pa.Table, wanted: pa.Table) -> pa.Table:
        own = _Group(table, n)
        rows = wanted.column("row").to_numpy()
        payload = [_packed(int(own.order[r]), own.sets[own.lo[r]:own.lo[r + 1]]) for r in rows.tolist()]
        return pa.table({"cluster": wanted.column("cluster"), "i": wanted.column("i"), "j": wanted.column("j"), "side": wanted.column("side"), "payload": pa.array(payload, pa.binary())})

    def join_cluster(_key: tuple, table: pa.Table) -> pa.Table:
        members = [_unpacked(p) for p in table.column("payload").to_pylist()]
        side = table.column("side").to_numpy()
        found = forest([s for _, s in members], side, percent) if len(members) > 1 else []
        ids = np.array([i for i, _ in members])
        pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
        return frame("link", ids[pairs[:, 0]], ids[pairs[:, 1]], np.zeros(len(pairs)))

    identity = core.answer(texts.groupBy("g").applyInArrow(ask_classes, core.ASK), lead_of)
    present = core.answer_presence(texts.groupBy("g").cogroup(identity.groupBy("g")).applyInArrow(ask_elements, core.ASK))
    known = identity.unionAll(core.tagged(present, 1, groups))
    asked = texts.groupBy("g").cogroup(known.groupBy("g")).applyInArrow(ask_keys, core.ASK)
    both = known.unionAll(core.tagged(core.answer(asked, _share, sparse=True), 2, groups))
    members = texts.groupBy("g").cogroup(both.groupBy("g")).applyInArrow(name_clusters, "g int, cluster long, row long, id long")
    # clusters above BLOCK: blocks dealt by id, every pair of blocks one task
    size = members.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = members.join(size, "cluster").withColumn("mine", F.pmod(F.xxhash64("id", F.lit(10)), "blocks").cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "g", "cluster", "row", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("side"),
    )
    sets = texts.groupBy("g").cogroup(members.groupBy("g")).applyInArrow(send_sets, "cluster long, i int, j int, side int, payload binary")
    found = sets.groupBy("cluster", "i", "j").applyInArrow(join_cluster, schema)
    rows = texts.groupBy("g").cogroup(identity.groupBy("g")).applyInArrow(documents, schema)
    return core.write_stage(rows.unionAll(found), "jaccard-links")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): smallest node reachable, for every node of an edge, by large-star and small-star steps."""
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pairs, before = core.write_stage(pairs, "star"), None
    while True:
        # large star: larger neighbours of u move to the smallest of u and its neighbours
        near = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        pairs = near.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours of u, and u itself, move to the smallest of them
        low = pairs.groupBy("u").agg(F.min("v").alias("m"))
        moved = pairs.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = core.write_stage(moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "star")
        now = tuple(pairs.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first())
        if now == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = now


def join(docs: DataFrame, n: int = N, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per document."""
    rows = links(docs, n, percent, key, text)
    own = rows.where("kind = 'doc'")
    found = components(rows.where("a <> b"))
    out = own.join(found, own.a == found.node, "left")
    null = F.col("a") == int(core._NULL_ID)
    return out.select(F.when(~null, F.col("a")).alias("doc_id"), F.col("size").alias("n_shingles"), F.when(~null, F.coalesce("component", "a")).alias("component_id"))


def op10_trie_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(core.read(spark, sf_dir, "documents"))


#: DuckDB: overlaps counted by a join on the n-grams, components by a recursive walk.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM grams a JOIN grams b USING (k) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * common >= 90 * (s.n + t.n - common)
), reach(node, other) AS (
  SELECT x, y FROM links UNION SELECT r.node, l.y FROM reach r JOIN links l ON l.x = r.other
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce((SELECT min(other) FROM reach WHERE node = d.doc_id), d.doc_id)) AS component_id
FROM d LEFT JOIN sizes USING (doc_id)
"""
