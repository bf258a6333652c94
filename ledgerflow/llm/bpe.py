"""Operator 5: byte-level BPE encoding and decoding.

The rank file is compiled into a trie of token bytes plus the pairwise merge
rule; from these a finite-state transducer is determinised lazily.  A token
sequence is the BPE result of its bytes exactly when every adjacent pair is
(merging the two tokens' bytes alone gives back the pair), so reading a piece
byte by byte is a walk over sets of *configurations* (tokens completed so far,
trie node of the open token).  Configurations die when their open token cannot
go on or a pair is not mergeable that way; a token is emitted as soon as every
surviving configuration agrees on it, that is after a lookahead bounded by the
longest token.  Each (state, byte) step is computed once and kept.

Decoding is streamed: ids become bytes block by block and an incremental UTF-8
state machine holds back an unfinished character until its rest arrives.

Cases: null or empty text has no tokens and the hash of no bytes; white space
only, repeated rows and repeated ids are encoded row by row; a very long text is
split and encoded whole, a very long piece in one walk over its bytes; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from . import core

#: Bound on kept transitions, mergeable pairs and pieces each; past it a store starts anew.  Results do not
#: change; a worker's stores take about 0.8 kB an entry.
KEEP = 500_000
#: Longer pieces are encoded each time.
KEEP_LENGTH = 100
#: Ids decoded at a time.
DECODE_BLOCK = 1 << 14


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes -> id of a rank file (one ``base64 id`` line per token)."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


def merge_plain(piece: bytes, ranks: dict[bytes, int], leave: int = 1) -> list[bytes]:
    """BPE by definition: merge the lowest-ranked adjacent pair until none, or only ``leave`` parts, are left."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > leave:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 62))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best:best + 2] = [parts[best] + parts[best + 1]]
    return parts


def last_merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, int] | None:
    """The two tokens whose merge makes ``piece``; none for a single byte."""
    if len(piece) == 1:
        return None
    left, right = merge_plain(piece, ranks, leave=2)
    return ranks[left], ranks[right]


class Transducer:
    """Lazily determinised encoder of single pieces."""

    def __init__(self, ranks: dict[bytes, int], keep: int | None = None):
        self.ranks, self.keep = ranks, keep or KEEP
        self.token = {i: t for t, i in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.accept: list[int] = [-1]
        for piece, rank in ranks.items():
            node = 0
            for byte in piece:
                nxt = self.children[node].get(byte)
                if nxt is None:
                    nxt = self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.accept.append(-1)
                node = nxt
            self.accept[node] = rank
        self.parts = {rank: pair for piece, rank in ranks.items() if (pair := last_merge(piece, ranks))}
        self.join = {pair: rank for rank, pair in self.parts.items()}
        self.spines: tuple[dict, dict] = ({}, {})
        self.pairs: dict[int, bool] = {}
        self.clear()

    def clear(self) -> None:
        self.steps: dict[int, int] = {}  # state and byte -> next state, as ~state if tokens are emitted
        self.emits: dict[int, tuple[int, ...]] = {}
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.ends: list[tuple[int, ...] | None] = []
        self.start = self._state((((-1,), 0),))

    def _state(self, configs: tuple) -> int:
        known = self.number.get(configs)
        if known is None:
            known = self.number[configs] = len(self.states)
            self.states.append(configs)
            self.ends.append(next((done[1:] for done, node in configs if node == 0), None))
        return known

    def _fits(self, left: int, right: int) -> bool:
        """May ``right`` follow ``left``: does BPE of the joined bytes give back the two?"""
        if left < 0:
            return True
        pair = left << 32 | right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) > self.keep:
                self.pairs.clear()
            known = self.pairs[pair] = self._apart(left, right)
        return known

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """Parts of ``token`` that lie at its left (0) or right (1) border at some time, each with the rank that ends it."""
        spine = self.spines[side].get(token)
        if spine is None:
            spine, ends = [(token, 1 << 62)], token
            while (parts := self.parts.get(ends)) is not None:
                spine.append((parts[side], ends))
                ends = parts[side]
            self.spines[side][token] = spine
        return spine

    def _apart(self, left: int, right: int) -> bool:
        """No merge across the border happens while both its parts still stand; on equal ranks the leftmost goes first."""
        for a, a_ends in self._spine(left, 1):
            for b, b_ends in self._spine(right, 0):
                across = self.join.get((a, b))
                if across is not None and across < a_ends and across <= b_ends:
                    return False
        return True

    def _step(self, state: int, byte: int) -> int:
        after: list[tuple[tuple[int, ...], int]] = []
        children, accept = self.children, self.accept
        for done, node in self.states[state]:
            child = children[node].get(byte)
            if child is None:
                continue
            if children[child]:
                after.append((done, child))
            rank = accept[child]
            if rank >= 0 and self._fits(done[-1], rank):
                after.append(((*done, rank), 0))
        agreed = 0  # tokens at the front that all configurations share
        if after:
            shortest = min([len(done) for done, _ in after])
            first = after[0][0]
            while agreed + 1 < shortest and all([done[agreed + 1] == first[agreed + 1] for done, _ in after]):
                agreed += 1
            if shortest > agreed + 1:  # the last agreed token bears on nothing any more
                after = [((-1, *done[agreed + 1:]), node) for done, node in after]
            elif agreed:
                after = [(done[agreed:], node) for done, node in after]
            step, emitted = self._state(tuple(after)), first[1:agreed + 1]
        else:
            step, emitted = self._state(()), ()
        key = state << 8 | byte
        if emitted:
            self.emits[key] = emitted
            step = ~step
        self.steps[key] = step
        return step

    def encode(self, piece: bytes) -> list[int]:
        state, steps, emits = self.start, self.steps, self.emits
        out: list[int] = []
        for byte in piece:
            key = state << 8 | byte
            step = steps.get(key)
            if step is None:
                if len(steps) > self.keep:  # start anew, from the state at hand
                    here = self.states[state]
                    self.clear()
                    state, steps, emits = self._state(here), self.steps, self.emits
                    key = state << 8 | byte
                step = self._step(state, byte)
            if step < 0:
                out += emits[key]
                step = ~step
            state = step
        rest = self.ends[state]
        if rest is None:
            raise ValueError(f"the ranks cannot spell {piece[:80]!r}")
        out += rest
        return out


class Encoder:
    """Text to ids: split by the pattern, each piece through the transducer, the ids of short pieces kept as bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, keep: int | None = None):
        self.transducer = Transducer(ranks, keep)
        self.split = regex.compile(pattern).findall
        self.kept: dict[str, bytes] = {}

    def _ids(self, piece: str) -> bytes:
        return np.array(self.transducer.encode(piece.encode()), dtype="<u4").tobytes()

    def __call__(self, text: str) -> np.ndarray:
        pieces = self.split(text)
        kept = self.kept
        if len(kept) > self.transducer.keep:
            kept.clear()
        long: dict[str, bytes] = {}
        for piece in set(pieces).difference(kept):
            (kept if len(piece) <= KEEP_LENGTH else long)[piece] = self._ids(piece)
        found = [kept.get(p) or long[p] for p in pieces] if long else map(kept.__getitem__, pieces)
        return np.frombuffer(b"".join(found), dtype="<u4")


class Utf8Stream:
    """Incremental UTF-8: ``feed`` returns the text completed so far and keeps an unfinished character back.

    The machine's state is the number of continuation bytes still due and the
    range allowed for the next one; ill-formed bytes become U+FFFD.
    """

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def due(lead: int) -> tuple[int, int, int]:
        """(continuation bytes due, lowest, highest first continuation) after a lead byte; (0, 0, 0) if none may follow."""
        if 0xC2 <= lead <= 0xDF:
            return 1, 0x80, 0xBF
        if 0xE0 <= lead <= 0xEF:
            return 2, 0xA0 if lead == 0xE0 else 0x80, 0x9F if lead == 0xED else 0xBF
        if 0xF0 <= lead <= 0xF4:
            return 3, 0x90 if lead == 0xF0 else 0x80, 0x8F if lead == 0xF4 else 0xBF
        return 0, 0, 0

    @classmethod
    def unfinished(cls, data: bytes) -> int:
        """Length of the well-formed but unfinished character at the end of ``data`` (0 to 3)."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if 0x80 <= lead <= 0xBF:
                continue
            need, low, high = cls.due(lead)
            for byte in data[len(data) - back + 1:]:
                if not need or not low <= byte <= high:
                    return 0
                need, low, high = need - 1, 0x80, 0xBF
            return back if need else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data) - self.unfinished(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.held = self.held.decode("utf-8", "replace"), b""
        return rest


def decode_stream(ids: Iterable[int] | np.ndarray, token: dict[int, bytes], block: int = DECODE_BLOCK) -> Iterator[str]:
    """Text pieces of an id sequence, block by block."""
    ids, stream = np.asarray(ids), Utf8Stream()
    for i in range(0, len(ids), block):
        yield stream.feed(b"".join(map(token.__getitem__, ids[i:i + block].tolist())))
    yield stream.finish()


_ENCODERS: dict[tuple[str, str, int | None], Encoder] = {}


def encoder(raw: bytes, pattern: str, keep: int | None = None) -> Encoder:
    """The worker's encoder of a rank file, compiled once per worker."""
    key = hashlib.sha256(raw).hexdigest(), pattern, keep
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(parse_ranks(raw), pattern, keep)
    return _ENCODERS[key]


def map_encoded(docs: DataFrame, rank_file: str, pattern: str, schema: str, row: Callable[[str, np.ndarray, dict[int, bytes]], tuple], text: str = "text", keep: tuple[str, ...] = ("doc_id",), stores: int | None = None) -> DataFrame:
    """One output row per document (``stores``: the bound ``KEEP``): the ``keep`` columns and what ``row(text, ids, token bytes)`` returns.

    A narrow map.  The rank file is read on the driver and broadcast; its size
    is that of the vocabulary, whatever the data.
    """
    with open(rank_file, "rb") as f:
        raw = docs.sparkSession.sparkContext.broadcast(f.read())
    names = [c.split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(raw.value, pattern, stores)
        for batch in batches:
            rows = [row(t := x.as_py() or "", enc(t), enc.transducer.token) for x in batch.column("__text")]
            own = [pa.array(c) for c in zip(*rows)] if rows else [pa.array([]) for _ in names]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *own], names=[*keep, *names])

    slim = docs.select(*keep, docs[text].alias("__text"))
    full = ", ".join([*(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep), schema])
    return slim.mapInArrow(run, full)


def encode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, token_ids array<bigint>): the general encoder."""
    return map_encoded(docs, rank_file, pattern, "token_ids array<bigint>", lambda t, ids, token: (ids.astype(np.int64).tolist(),), text, (key,))


def _digest(_text: str, ids: np.ndarray, token: dict[int, bytes]) -> tuple[int, str, str]:
    decoded = hashlib.sha256()
    for piece in decode_stream(ids, token):
        decoded.update(piece.encode())
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), decoded.hexdigest()


def encoded_row(_text: str, ids: np.ndarray, token: dict[int, bytes]) -> tuple[bytes, int, str]:
    """(ids as little-endian unsigned 32-bit integers, their number, hash of the decoded text)."""
    n, _, decoded = _digest(_text, ids, token)
    return ids.tobytes(), n, decoded


DIGEST = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(docs: DataFrame) -> DataFrame:
    """Contract columns of ``op5``: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    import public_tokenizers

    docs = docs.withColumn("doc_id", docs["doc_id"].cast("long"))
    return map_encoded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, DIGEST, _digest)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(core.read(spark, sf_dir, "documents"))
