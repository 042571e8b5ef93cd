"""Cross-tokenizer alignment by merge-path partitioning (operator 12).

Two tokenizers, A (byte-level BPE) and B (pieces with byte fallback), read the
same bytes.  The ends of their tokens are two sorted lists; merged, each step
from one distinct end to the next lies in exactly one token of A and one of B,
and so is one link.  The texts of a batch are laid behind each other, so the
batch is one merge, whatever the lengths of its texts.  Diagonals at equal
distances cut it into pieces of equal work: a binary search along each (all
diagonals at once) finds how much of either list lies before it.  Pieces are
merged independently and emit their links and common ends; an end of B whose
equal in A went to the piece before is recognised at the boundary, and a group
that a boundary cuts is stitched from the common ends on both sides.

``align`` writes, in one pass, for every block of documents (bounded by links)
the id pairs that it links with their numbers, and for each document its links
as places in that list of pairs.  The corpus-wide number of a pair is a sum over
blocks; a block's documents and the numbers of the block's own pairs then meet
by block, so no table of all pairs is held anywhere.

Cases: a null or empty text, and one whose tokens do not spell it, has no
tokens: zeros and an empty digest; repeated rows are aligned (and their links
counted) one by one; extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .tokenizer import Encoder, byte_to_char

#: Token ends that one piece merges; links in a block of documents, as a rule.
PIECE_ENDS, BLOCK_LINKS = 1 << 16, 1_500_000
#: Bytes of words, of chunks (A) and of chunks (B) that a worker keeps; longer chunks of B are not kept.
A_CACHE_BYTES, B_CACHE_BYTES, ENTRY_BYTES, KEPT_CHARS = 48 << 20, 64 << 20, 150, 64
#: Bytes of text encoded and aligned at a time, as a rule.
SLICE_BYTES = 4 << 20

_SPACE = "▁"
#: The first space of a run: what stands before it and what follows never share a token of B.
_CUT = re.compile("(?<! ) ")


class PieceEncoder:
    """Ids of a sentencepiece file, chunk by chunk where no piece spans a cut."""

    def __init__(self, path: str, cache_bytes: int = B_CACHE_BYTES) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.tokens = [_piece_bytes(p, self.model.is_byte(i)) for i, p in enumerate(pieces)]
        self.space = self.model.piece_to_id(_SPACE)
        self.chunked = not any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in pieces) and not self.model.is_unknown(self.space)
        self.known: dict[str, bytes] = {}
        self.cache_bytes, self.known_bytes = cache_bytes, 0

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, "<u4").tobytes() for ids in self.model.encode(texts, num_threads=1)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, with the space that the model puts before it."""
        if not self.chunked:
            return self._ids(texts)
        odd = [i for i, t in enumerate(texts) if _SPACE in t]  # the model takes it for a space
        if odd:
            out, rest = [b""] * len(texts), [i for i, t in enumerate(texts) if _SPACE not in t]
            for at, ids in ((odd, self._ids([texts[i] for i in odd])), (rest, self.encode([texts[i] for i in rest]))):
                for i, raw in zip(at, ids):
                    out[i] = raw
            return out
        chunks = [(_CUT.split(" " + t) if "  " in t or t[:1] == " " else f" {t}".split(" "))[1:] if t else [] for t in texts]
        get = self.known.get
        found = [list(map(get, c)) for c in chunks]
        missing = list({c for cs, ids in zip(chunks, found) if None in ids for c, x in zip(cs, ids) if x is None})
        if missing:
            new = dict(zip(missing, self._ids(missing)))
            if "" in new:  # a space with nothing behind it
                new[""] = np.array([self.space], "<u4").tobytes()
            found = [[new[c] if x is None else x for c, x in zip(cs, ids)] if None in ids else ids for cs, ids in zip(chunks, found)]
            if self.known_bytes > self.cache_bytes:
                self.known.clear()
                self.known_bytes = 0
            short = {c: ids for c, ids in new.items() if len(c) <= KEPT_CHARS}
            self.known.update(short)
            self.known_bytes += ENTRY_BYTES * len(short) + sum(map(len, short)) + sum(map(len, short.values()))
        return list(map(b"".join, found))


def _piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace(_SPACE, " ").encode()


def _json_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    table = {c: b for b, c in byte_to_char().items()}
    special = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    known = {i: bytes(table[c] for c in t) for t, i in spec["model"]["vocab"].items() if i not in special} | special
    return [known.get(i, b"") for i in range(max(known) + 1)]


class Table(NamedTuple):
    """The bytes of each id, one after the other, their lengths, and how an id is written."""
    tokens: pa.Array
    lengths: np.ndarray
    written: pa.Array  # id, then "," at 3 id, "|" at 3 id + 1, ";" at 3 id + 2

    @staticmethod
    def of(tokens: list[bytes]) -> Table:
        return Table(pa.array(tokens, pa.binary()), np.array([len(t) for t in tokens], np.int64),
                     pa.array([f"{i}{c}".encode() for i in range(len(tokens)) for c in ",|;"], pa.binary()))

    def spelled(self, ids: np.ndarray) -> bytes:
        return _decoded(ids, self.tokens)


def _decoded(codes: np.ndarray, table: pa.Array) -> bytes:
    flat = pa.DictionaryArray.from_arrays(pa.array(codes.astype(np.int32)), table).dictionary_decode()
    return b"" if not len(flat) else bytes(memoryview(flat.buffers()[2] or b"")[:np.frombuffer(flat.buffers()[1], np.int32)[len(flat)]])


class Path(NamedTuple):
    """The merge of two lists of token ends: links (index in A, index in B) in
    order, and how many ends of A and of B lie up to each common end."""
    a: np.ndarray
    b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray


def diagonals(ends_a: np.ndarray, ends_b: np.ndarray, pieces: int) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of A and of B lie before each of ``pieces`` + 1 diagonals of
    equal distance, an end of A before an equal one of B."""
    n, m = len(ends_a), len(ends_b)
    d = np.arange(pieces + 1, dtype=np.int64) * (n + m) // pieces
    low, high = np.maximum(0, d - m), np.minimum(d, n)
    while (open_ := low < high).any():
        i = (low + high) // 2
        # A's end i comes before B's end d - i - 1: more of A lies before the diagonal.
        more = open_ & (ends_a[np.minimum(i, n - 1)] <= ends_b[np.clip(d - i - 1, 0, m - 1)])
        low, high = np.where(more, i + 1, low), np.where(open_ & ~more, i, high)
    return low, d - low


def merge_path(ends_a: np.ndarray, ends_b: np.ndarray, piece_ends: int = PIECE_ENDS) -> Path:
    """All links and common ends of two sorted lists of distinct ends with the same last one."""
    if not len(ends_a):
        none = np.zeros(0, np.int64)
        return Path(none, none, none, none)
    ia, ib = diagonals(ends_a, ends_b, max(1, -(-(len(ends_a) + len(ends_b)) // piece_ends)))
    pieces = [_piece(ends_a, ends_b, *span) for span in zip(ia[:-1].tolist(), ia[1:].tolist(), ib[:-1].tolist(), ib[1:].tolist())]
    return Path(*(np.concatenate(x) for x in zip(*pieces)))  # groups are stitched by the common ends of all pieces


def _piece(ends_a: np.ndarray, ends_b: np.ndarray, a0: int, a1: int, b0: int, b1: int) -> Path:
    """The links that end in one piece; all other ends of A and B lie before or after it."""
    a, b = ends_a[a0:a1], ends_b[b0:b1]
    # An end of B that has its equal in A is that one's link, even if A's went to the piece before.
    in_a = np.searchsorted(a, b)
    own = np.ones(len(b), bool)
    inside = in_a < len(a)
    own[inside] = a[in_a[inside]] != b[inside]
    if a0 and len(b) and ends_a[a0 - 1] == b[0]:
        own[0] = False
    to_b = np.searchsorted(b, a)
    link_a = np.concatenate([np.arange(a0, a1), a0 + in_a[own]])
    link_b = np.concatenate([b0 + to_b, b0 + np.flatnonzero(own)])
    order = np.argsort(np.concatenate([a, b[own]]), kind="stable")
    # A's common ends: the equal end of B may be the first of the next piece.
    at = b0 + to_b
    common_ = np.flatnonzero(ends_b[np.minimum(at, len(ends_b) - 1)] == a)
    return Path(link_a[order], link_b[order], a0 + common_ + 1, at[common_] + 1)


class Aligner:
    """Both encoders and their tables, for one worker."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.enc_a = Encoder(a_path, cache_bytes=A_CACHE_BYTES)
        self.enc_b = PieceEncoder(b_path)
        self.a, self.b = Table.of(_json_tokens(a_path)), Table.of(self.enc_b.tokens)

    def ids(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Both tokenizers' ids of each text; none where they do not spell it."""
        told = [" " + t for t in texts]
        a = [x.astype(np.int32) if t else x[:0].astype(np.int32) for x, t in zip(self.enc_a.encode(told), texts)]
        b = [np.frombuffer(raw, np.int32) for raw in self.enc_b.encode(texts)]
        spelled = self.a.spelled(_flat(a)), self.b.spelled(_flat(b))
        at = [0, 0]
        for i, t in enumerate(told):
            raw = t.encode("utf-8", "replace") if len(t) > 1 else b""
            n = [int(self.a.lengths[a[i]].sum()), int(self.b.lengths[b[i]].sum())]
            same = all(k == len(raw) and s[p:p + k] == raw for s, p, k in zip(spelled, at, n))
            at = [at[0] + n[0], at[1] + n[1]]
            if not same:
                a[i], b[i] = a[i][:0], b[i][:0]
        return a, b

    def path(self, a: np.ndarray, b: np.ndarray) -> Path:
        return merge_path(np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b]))

    def written(self, a: np.ndarray, b: np.ndarray, path: Path) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;a3|b2;`` of all groups, and where each group's text ends."""
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[path.cut_a - 1], mark_b[path.cut_b - 1] = 1, 2
        size_a, size_b = np.diff(path.cut_a, prepend=0), np.diff(path.cut_b, prepend=0)
        # A group's ids of A stand before its ids of B.
        before_a = np.repeat(path.cut_b - size_b, size_a) + np.arange(len(a))
        before_b = np.repeat(path.cut_a, size_b) + np.arange(len(b))
        codes = np.zeros(len(a) + len(b), np.int32)
        codes[before_a] = 3 * a + mark_a
        codes[before_b] = 3 * (b + len(self.a.lengths)) + mark_b
        table = pa.concat_arrays([self.a.written, self.b.written])
        flat = pa.DictionaryArray.from_arrays(pa.array(codes), table).dictionary_decode()
        at = np.frombuffer(flat.buffers()[1], np.int32, len(codes) + 1) if len(codes) else np.zeros(1, np.int32)
        return (bytes(memoryview(flat.buffers()[2])[:at[-1]]) if len(codes) else b""), at[path.cut_a + path.cut_b]


def _flat(lists: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(lists) if lists else np.zeros(0, np.int32)


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One for each Python worker and pair of files."""
    return Aligner(a_path, b_path)


common.kept("aligner", aligner.cache_clear)

#: A row is a document (its links by their pairs' places, and its counts) or what
#: its block links (sorted pairs, A << 32 | B, and their numbers).
ROWS = ("block long, doc_id long, links binary, wide boolean, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs binary, numbers binary")
_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_DOC = ["block", "doc_id", "links", "wide", *_COUNTS, "groups_sha256"]


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


class _Block:
    """Documents on the way into the written table, until their block is full."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.ends: list[np.ndarray] = []  # of each document's links, by slice
        self.rows: list[list] = [[] for _ in range(6)]
        self.links = 0

    def add(self, t: Aligner, ids: list, texts: list[str]) -> None:
        a, b = t.ids(texts)
        flat_a, flat_b = _flat(a), _flat(b)
        path = t.path(flat_a, flat_b)
        written, ends = t.written(flat_a, flat_b, path)
        last_a = np.cumsum([len(x) for x in a])
        groups = np.searchsorted(path.cut_a, last_a, "right")
        n_links = np.searchsorted(path.a, last_a - 1, "right")
        text_end = np.concatenate([[0], ends])[groups]
        text_start = np.concatenate([[0], text_end[:-1]])
        shas = [hashlib.sha256(written[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(text_start.tolist(), text_end.tolist())]
        for held, new in zip(self.rows, (ids, map(len, a), map(len, b), np.diff(groups, prepend=0).tolist(),
                                         np.diff(n_links, prepend=0).tolist(), shas)):
            held.extend(new)
        self.keys.append(flat_a[path.a].astype(np.int64) << 32 | flat_b[path.b])
        self.links += len(path.a)

    def closed(self, block: int) -> Iterator[pa.RecordBatch]:
        """The block's documents, in batches, and its pairs."""
        pairs, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        self.keys, wide = [], len(pairs) > 1 << 16
        at = at.astype("<u4" if wide else "<u2")
        ids, n_a, n_b, n_groups, n_links, shas = self.rows
        ends = np.cumsum([0, *n_links])
        for s in range(0, len(ids), common.BATCH_ROWS):
            e = min(s + common.BATCH_ROWS, len(ids))
            links = [at[x:y].tobytes() for x, y in zip(ends[s:e].tolist(), ends[s + 1:e + 1].tolist())]
            n = e - s
            yield _record([[block] * n, ids[s:e], links, [wide] * n, n_a[s:e], n_b[s:e], n_groups[s:e], n_links[s:e], shas[s:e],
                           [None] * n, [None] * n])
        if len(pairs):
            yield _record([[block], *[[None]] * 8, [pairs.tobytes()], [np.bincount(at, minlength=len(pairs)).astype("<u4").tobytes()]])


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The written table of documents and of their blocks' pairs (see ``ROWS``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        t, number, block = aligner(a_path, b_path), TaskContext.get().partitionId() << 24, _Block()
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for start, end in _slices(texts):
                block.add(t, ids[start:end], texts[start:end])
                if block.links >= BLOCK_LINKS:
                    yield from block.closed(number)
                    number, block = number + 1, _Block()
        if block.rows[0]:
            yield from block.closed(number)

    return common.materialize(common.map_partitions(common.text_column(docs), run, ROWS, "aligner"), "aligned")


def _record(columns: list) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.binary(), pa.bool_(), *[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], [*_DOC, "pairs", "numbers"])


def block_pairs(aligned: DataFrame) -> DataFrame:
    """(block, pair, n), written: the pairs that each block links, as rows."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        pairs = [np.frombuffer(p, np.int64) for p in batch.column("pairs").to_pylist()]
        if not pairs:
            return None
        numbers = [np.frombuffer(n, "<u4").astype(np.int64) for n in batch.column("numbers").to_pylist()]
        block = np.repeat(batch.column("block").to_numpy(), [len(p) for p in pairs])
        return pa.record_batch([pa.array(block), pa.array(np.concatenate(pairs)), pa.array(np.concatenate(numbers))], ["block", "pair", "n"])

    packed = aligned.filter("pairs is not null").select("block", "pairs", "numbers")
    return common.materialize(common.map_batches(packed, fn, "block long, pair long, n long", rows=1), "block-pairs")  # a block a batch


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, a_id, b_id, count, best), written: how many links of the corpus hold
    the pair, and whether no pair of its B id is held by more."""
    counts = common.materialize(pairs.groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counts.groupBy(b_id.alias("b_id")).agg(F.max("count").alias("most"))
    return (counts.withColumn("b_id", b_id).join(most, "b_id")
            .select("pair", F.shiftright("pair", 32).alias("a_id"), "b_id", "count", (F.col("count") == F.col("most")).alias("best")))


def link_scores(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligned = align(docs, a_path, b_path)
    pairs = block_pairs(aligned)
    counted = pair_counts(pairs)
    wanted = pairs.select("block", "pair").join(counted.select("pair", "count", "best"), "pair")
    texts = aligned.filter("pairs is null").select(*_DOC)
    empty, full = texts.filter("n_links = 0"), texts.filter("n_links > 0")
    result = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def scored(rows: pa.Table, numbers: pa.Table) -> pa.Table:
        order = np.argsort(numbers.column("pair").to_numpy())  # the block's pairs in the order of its list
        count, best = (numbers.column(c).to_numpy()[order].astype(np.int64) for c in ("count", "best"))
        n_best, count_sum = [], []
        for links, wide in zip(rows.column("links").to_pylist(), rows.column("wide").to_pylist()):
            at = np.frombuffer(links, "<u4" if wide else "<u2")
            n_best.append(int(best[at].sum()))
            count_sum.append(int(count[at].sum()))
        return pa.table([rows.column("doc_id"), *(rows.column(c) for c in _COUNTS), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()),
                         rows.column("groups_sha256")], ["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(common.BATCH_ROWS))
    matched = full.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(scored, result)
    return matched.unionByName(empty.select("doc_id", *_COUNTS, F.lit(0).cast("long").alias("n_best"),
                                            F.lit(0).cast("long").alias("count_sum"), "groups_sha256"))


def groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per group of each row: doc_id, group (from 0), the group's end in the bytes
    of space+text, and the ids of A and of B in it."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        t, out = aligner(a_path, b_path), []
        texts = batch.column("text").to_pylist()
        for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), *t.ids(texts)):
            path = t.path(a, b)
            ends = np.cumsum(t.a.lengths[a])[path.cut_a - 1].tolist() if len(a) else []
            out += [(doc_id, k, end, x.tolist(), y.tolist()) for k, (end, x, y) in
                    enumerate(zip(ends, np.split(a, path.cut_a[:-1]), np.split(b, path.cut_b[:-1])))]
        columns = zip(*out) if out else [[]] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "group", "byte_end", "a_ids", "b_ids"])

    return common.map_batches(common.text_column(docs), fn, "doc_id long, group long, byte_end long, a_ids array<int>, b_ids array<int>", "aligner")
