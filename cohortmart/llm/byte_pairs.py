"""Byte-level BPE encoding and decoding by a rank queue (operator 11).

Pre-tokens are doubly linked lists of their bytes' tokens.  Every adjacent pair
that the vocabulary merges lies in a bucket of its merge's rank; a hierarchy of
bitmaps over the buckets gives the least rank that has any by find-first-set
at each level.  The positions of that bucket are merged from left to right;
each merge joins two list nodes and puts at most two new pairs in, and should
one of these rank lower, it goes first.  Pairs that an earlier merge has eaten
are not looked for: their entries are found stale when they come up and
skipped.  A pre-token of n bytes takes some n log n steps however long it is,
where a rescan for every merge takes n squared.

Texts are split by the pattern that belongs to the vocabulary.  The new
pre-tokens of a slice of texts share one queue; those met before come from a
cache bounded by bytes, long ones are never kept.

Cases: a null or empty text has no ids and decodes to no bytes; repeated rows
are encoded row by row; extra columns are ignored; no rows give no rows; an id
that the vocabulary lacks fails the decoding.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import common

#: Bits in a word of the bitmaps.
WORD = 256
#: Bytes of pre-tokens and their ids that a worker keeps (an entry counts as its
#: contents and what Python needs to hold them); longer pre-tokens are not kept.
CACHE_BYTES, ENTRY_BYTES, KEPT_CHARS = 96 << 20, 150, 64
#: Pairs of tokens whose merge is kept; bytes of text worked on at a time, as a rule.
MERGES, SLICE_BYTES = 300_000, 1 << 20
#: In the list of tokens: an end between pre-tokens, and a node that was merged into another.
END, GONE = -1, -2


class RankQueue:
    """Positions by rank, the least rank first.  A set bit says that a bucket, or
    a word of the level below, has something in it."""

    def __init__(self, ranks: int) -> None:
        self.levels = [[0] * -(-ranks // WORD)]
        while len(self.levels[-1]) > 1:
            self.levels.append([0] * -(-len(self.levels[-1]) // WORD))
        self.levels.reverse()  # the root first
        self.buckets: dict[int, list[int]] = {}

    def put(self, rank: int, positions: list[int]) -> None:
        """More positions of a rank (the list itself is kept)."""
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket += positions
            return
        self.buckets[rank] = positions
        for level in reversed(self.levels):
            word, bit = divmod(rank, WORD)
            had, rank = level[word], word
            level[word] = had | 1 << bit
            if had:  # the words above know of this one
                return

    def take(self) -> tuple[int, list[int]] | None:
        """The least rank and its positions from left to right, taken out; None
        from an empty queue."""
        rank = 0
        for level in self.levels:
            bits = level[rank]
            if not bits:
                return None
            rank = rank * WORD + (bits & -bits).bit_length() - 1
        positions, at = self.buckets.pop(rank), rank
        for level in reversed(self.levels):
            at, bit = divmod(at, WORD)
            level[at] &= ~(1 << bit)
            if level[at]:
                break
        positions.sort()
        return rank, positions


class Merges(dict):
    """left << 32 | right -> the rank of two tokens' merge, or -1; filled as asked."""

    def __init__(self, ranks: dict[bytes, int], tokens: list[bytes | None]) -> None:
        super().__init__()
        self.ranks, self.tokens = ranks, tokens

    def __missing__(self, key: int) -> int:
        rank = self.ranks.get(self.tokens[key >> 32] + self.tokens[key & 0xFFFFFFFF], -1)
        if len(self) > MERGES:
            self.clear()
        self[key] = rank
        return rank


class Codec:
    """``ranks``: a file with a token in base 64 and its rank on each line; the
    rank is the token's id.  ``pattern`` splits texts into pre-tokens."""

    def __init__(self, ranks: str, pattern: str, cache_bytes: int = CACHE_BYTES) -> None:
        with open(ranks, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        size = max(self.ranks.values()) + 1
        self.tokens: list[bytes | None] = [None] * size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.double = np.array([self.ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)], np.int32)
        # White space is the Unicode property, as in the library; Python counts some control characters too.
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.queue, self.merges = RankQueue(size), Merges(self.ranks, self.tokens)
        self.known: dict[str, bytes] = {}
        self.cache_bytes, self.known_bytes = cache_bytes, 0
        self.table = pa.array(self.tokens, pa.binary())

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids (as numbers of ``dtype``) of pre-tokens by merges alone.  They
        lie in one list with an END between them that nothing merges with, so
        what a bucket holds is merged for all of them at once."""
        data = np.frombuffer(b"\0".join([*pieces, b""]), np.uint8)
        ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
        start = self.single[data]
        start[ends] = END
        pair = np.full(len(data), -1, np.int32)
        pair[:-1] = self.double[data[:-1].astype(np.int32) << 8 | data[1:]]
        pair[ends] = pair[ends - 1] = -1  # neither an end nor a last byte starts a pair
        queue, merges = self.queue, self.merges
        found = np.flatnonzero(pair >= 0)
        found = found[np.argsort(pair[found], kind="stable")]
        for run in np.split(found, np.flatnonzero(np.diff(pair[found])) + 1) if len(found) else ():
            queue.put(int(pair[run[0]]), run.tolist())
        n = len(data)
        ids, rank_at = array("i", start.tobytes()), array("i", pair.tobytes())  # rank_at: what else a bucket says is stale
        after = array("i", np.arange(1, n + 1, dtype=np.int32).tobytes())
        before = array("i", np.arange(-1, n - 1, dtype=np.int32).tobytes())
        while (least := queue.take()) is not None:
            rank, positions = least
            for k, i in enumerate(positions):
                if rank_at[i] != rank:
                    continue
                gone, lower = after[i], False
                ids[i], ids[gone], rank_at[gone] = rank, GONE, -1
                after[i] = follows = after[gone]
                before[follows] = i  # at the least the END
                right, ahead = ids[follows], before[i]
                rank_at[i] = new = merges[rank << 32 | right] if right >= 0 else -1
                if new >= 0:
                    queue.put(new, [i])
                    lower = new < rank
                left = ids[ahead] if ahead >= 0 else END
                if left >= 0:
                    rank_at[ahead] = new = merges[left << 32 | rank]
                    if new >= 0:
                        queue.put(new, [ahead])
                        lower = lower or new < rank
                if lower:  # a merge that comes before the rest of this bucket
                    if k + 1 < len(positions):
                        queue.put(rank, positions[k + 1:])
                    break
        out = np.frombuffer(ids, np.int32)
        out = out[out != GONE]
        at, raw, w = np.flatnonzero(out == END), out.astype(self.dtype).tobytes(), self.dtype.itemsize
        return [raw[a:b] for a, b in zip([0, *((at[:-1] + 1) * w).tolist()], (at * w).tolist())]

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids of new pre-tokens; the short ones are kept."""
        found: dict[str, bytes] = {}
        several: dict[str, bytes] = {}
        for word in words:
            piece = word.encode("utf-8", "replace")
            whole = self.ranks.get(piece)
            if whole is not None:
                found[word] = whole.to_bytes(self.dtype.itemsize, "little")
            else:
                several[word] = piece
        held: list[str] = []
        size = 0
        for k, (word, piece) in enumerate(several.items()):
            held.append(word)
            size += len(piece)
            if size >= SLICE_BYTES or k + 1 == len(several):
                found.update(zip(held, self.merge([several[w] for w in held])))
                held, size = [], 0
        if self.known_bytes > self.cache_bytes:
            self.known.clear()
            self.known_bytes = 0
        short = {w: ids for w, ids in found.items() if len(w) <= KEPT_CHARS}
        self.known.update(short)
        self.known_bytes += ENTRY_BYTES * len(short) + sum(map(len, short)) + sum(map(len, short.values()))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as numbers of ``dtype``, in slices of bounded size."""
        out: list[bytes] = []
        held: list[list[str]] = []
        size = 0
        for k, text in enumerate(texts):
            held.append(self.split(text))
            size += len(text)
            if size >= SLICE_BYTES or k + 1 == len(texts):
                out += self._gathered(held)
                held, size = [], 0
        return out

    def _gathered(self, words: list[list[str]]) -> list[bytes]:
        get = self.known.get
        ids = [list(map(get, ws)) for ws in words]
        missing = {w for ws, found in zip(words, ids) if None in found for w, x in zip(ws, found) if x is None}
        if missing:
            new = self._learn(list(missing))
            ids = [[new[w] if x is None else x for w, x in zip(ws, found)] if None in found else found
                   for ws, found in zip(words, ids)]
        return list(map(b"".join, ids))

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, memoryview]:
        """All ids' bytes, and where each id's begin (one more entry: the end)."""
        if len(ids) and int(ids.max()) >= len(self.tokens):
            raise ValueError(f"id {int(ids.max())} is not in the vocabulary")
        flat = pa.DictionaryArray.from_arrays(pa.array(ids.astype(np.int32)), self.table).dictionary_decode()
        if flat.null_count:
            raise ValueError("an id is not in the vocabulary")
        starts = np.frombuffer(flat.buffers()[1], np.int32, len(ids) + 1) if len(ids) else np.zeros(1, np.int32)
        return starts, memoryview(flat.buffers()[2] or b"")


@lru_cache(maxsize=1)
def codec(ranks: str, pattern: str) -> Codec:
    """One for each Python worker and vocabulary."""
    return Codec(ranks, pattern)


common.kept("codec", codec.cache_clear)


def _encoded(batch: pa.RecordBatch, c: Codec) -> tuple[pa.ListArray, np.ndarray, np.ndarray]:
    raw = c.encode(batch.column("text").to_pylist())
    ends = np.cumsum([0, *map(len, raw)], dtype=np.int64) // c.dtype.itemsize
    ids = np.frombuffer(b"".join(raw), c.dtype).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)), ends, ids


def _decoded(c: Codec, ends: np.ndarray, ids: np.ndarray) -> pa.Array:
    starts, data = c.decode(ids)
    at = starts[ends]
    return pa.array([bytes(data[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per row: doc_id and the ids of its whole text."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists, _, _ = _encoded(batch, codec(ranks, pattern))
        return pa.record_batch([batch.column("doc_id"), lists], ["doc_id", "ids"])

    return common.map_batches(common.text_column(docs), fn, "doc_id long, ids array<int>", "codec")


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per row of (doc_id, ids): doc_id and the bytes that the ids stand for; a
    null list stands for none."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("ids").fill_null([])
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum([0, *(len(x) for x in lists)])
        return pa.record_batch([batch.column("doc_id"), _decoded(codec(ranks, pattern), ends, ids)], ["doc_id", "decoded"])

    return common.map_batches(encoded.select("doc_id", "ids"), fn, "doc_id long, decoded binary", "codec")


def round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per row: doc_id, the ids of its whole text, and the bytes that these ids decode to."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = codec(ranks, pattern)
        lists, ends, ids = _encoded(batch, c)
        return pa.record_batch([batch.column("doc_id"), lists, _decoded(c, ends, ids)], ["doc_id", "ids", "decoded"])

    return common.map_batches(common.text_column(docs), fn, "doc_id long, ids array<int>, decoded binary", "codec")
