"""Packing documents into sequences by best-fit decreasing (operator 2).

A document's ids (its text's, then an end id) are first cut into full windows,
each a sequence of its own; what is left of it is an item.  Items are placed,
longest first, into the open window with the least room that still takes them,
found by a segment tree indexed by remaining capacity.

Items are dealt evenly over groups (round robin, so no document or copy can
fill one), and each group is packed alone in runs of bounded size: a run of
some thousand items wastes far less than one window, so more groups cost
almost no padding.  Sequence ids are dense from 0: each group's number of
sequences (one row a group, at most ``MAX_GROUPS``) gives its first id.

Cases: a null text counts as empty; an empty text still has its end id;
repeated rows are packed one by one; extra columns are ignored; no rows give
no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .tokenizer import BATCH_ROWS, CACHE_BYTES, encoder

CAPACITY = 2048
END_ID = 1
#: Pieces in a group, as a rule; groups, at most; pieces packed in one run, at most.
GROUP_PIECES, MAX_GROUPS, RUN_PIECES = 8192, 20_000, 65_536

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class OpenWindows:
    """Segment tree over remaining capacities 0..capacity: each node holds how
    many open windows lie under it, each leaf a stack of them."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._add(room, 1)

    def tightest(self, need: int) -> int | None:
        """The least room >= need that an open window has."""
        node, count = need + self.leaves, self.count
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):  # up, until a sibling to the right has windows
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:  # down, always to the left if it can be
                node = 2 * node if count[2 * node] else 2 * node + 1
        return node - self.leaves

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.windows[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of each item, and the number of windows."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_, used = OpenWindows(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        room = open_.tightest(need)
        if room is None:
            room, w, used = capacity, used, used + 1
        else:
            w = open_.take(room)
        window[i], offset[i] = w, capacity - room
        if room > need:
            open_.put(room - need, w)
    return window, offset, used


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = False, added: bool = False, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """Each document's pieces: full windows from its start, then the rest;
    ``with_ids`` adds the piece's ids as little-endian unsigned 32-bit bytes;
    ``added`` and ``cache_bytes`` are the encoder's."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(tokenizer, added, cache_bytes)
        doc, start, length, crc, total, body = [], [], [], [], [], []
        for doc_id, text_ids in zip(batch.column("doc_id").to_pylist(), enc.encode(batch.column("text"))):
            ids = np.append(text_ids.astype("<u4"), np.uint32(end_id)).tobytes()
            n = len(ids) // 4
            for a in range(0, n, capacity):
                piece = ids[4 * a:4 * (a + capacity)]
                doc.append(doc_id)
                start.append(a)
                length.append(len(piece) // 4)
                crc.append(zlib.crc32(piece))
                total.append(n)
                body.append(piece)
        columns = [pa.array(x, pa.int64()) for x in (doc, start, length, crc, total)]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        if with_ids:
            columns.append(pa.array(body, pa.binary()))
            names.append("ids")
        return pa.record_batch(columns, names)

    return common.map_batches(common.text_column(docs), fn, PIECES + (", ids binary" if with_ids else ""), "encoder", BATCH_ROWS)


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each row (a piece with a ``length`` from 1 to ``capacity``) its
    ``sequence_id`` and ``offset``.  ``cut`` is written first: its rows are
    counted, and a lost executor cannot deal them differently."""
    cut = common.materialize(cut, "pieces")
    groups = max(1, min(MAX_GROUPS, -(-cut.count() // GROUP_PIECES)))
    schema = T.StructType([*cut.schema.fields, T.StructField("group", T.IntegerType()),
                           T.StructField("in_group", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        group, used, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal used
            table = pa.Table.from_batches(held).combine_chunks()
            length = table.column("length").to_numpy()
            window, offset, n = best_fit_decreasing(length, capacity)
            table = (table.append_column("group", pa.array(np.full(len(length), group, np.int32)))
                     .append_column("in_group", pa.array(window + used)).append_column("offset", pa.array(offset)))
            used += n
            yield from table.to_batches()

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= RUN_PIECES:
                yield from packed()
                held, rows = [], 0
        if rows:
            yield from packed()

    placed = common.materialize(cut.repartition(groups).mapInArrow(common.in_task(run), schema), "placed")
    sizes = sorted(placed.groupBy("group").agg(F.max("in_group").alias("last")).collect())  # at most MAX_GROUPS rows
    first, offsets = 0, []
    for group, last in sizes:
        offsets.append((group, first))
        first += last + 1
    spark = cut.sparkSession
    firsts = spark.createDataFrame(offsets, "group int, first long")
    return (placed.join(F.broadcast(firsts), "group")
            .withColumn("sequence_id", F.col("first") + F.col("in_group"))
            .drop("group", "first", "in_group"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         with_ids: bool = False, added: bool = False, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """Per piece: where it lies in its document and in its sequence."""
    return place(pieces(docs, tokenizer, capacity, end_id, with_ids, added, cache_bytes), capacity)


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The sequences themselves, from ``pack(..., with_ids=True)``: ids padded
    to ``capacity``, the ids' documents' bounds, and how many ids are real.
    A group here is one sequence, so it has at most ``capacity`` ids."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, real, bounds = [], [], []
        for parts in batch.column("parts").to_pylist():
            raw = b"".join(p["ids"] for p in parts)
            real.append(len(raw) // 4)
            bounds.append([p["offset"] for p in parts])
            row = np.full(capacity, pad_id, np.int32)
            row[:real[-1]] = np.frombuffer(raw, "<i4")
            ids.append(row)
        return pa.record_batch([batch.column("sequence_id"), pa.array(ids, pa.list_(pa.int32())),
                                pa.array(real, pa.int32()), pa.array(bounds, pa.list_(pa.int64()))],
                               ["sequence_id", "ids", "n_real", "starts"])

    grouped = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return common.map_batches(grouped, fn, "sequence_id long, ids array<int>, n_real int, starts array<long>")
