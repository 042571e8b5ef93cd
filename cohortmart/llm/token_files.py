"""Token ids in Arrow stream files (operator 4).

Documents are encoded, an end id is put behind each, and the ids are written
in ascending ``doc_id`` order as equal-length sequences.  A file is an Arrow
IPC file whose batches have

* ``ids``: fixed-size list of ``SEQUENCE`` ids (16 bits where the vocabulary allows),
* ``mask``: fixed-size list of booleans, false on the padding of a file's last sequence,
* ``docs``: the documents that begin in the sequence (id, offset, ids).

All batches but a file's last have ``BATCH`` rows, so sequence k of a file is
row ``k % BATCH`` of batch ``k // BATCH``, a view of the mapped file.

Each file holds one range of ids; the ranges come from approximate quantiles
of ``doc_id`` alone (one bound a file, at most ``MAX_FILES``).  A task streams
its rows to a file of its own name and renames it when it is complete, so a
retried task overwrites equal bytes.  ``path`` must be a URI that pyarrow's
file systems open on every executor (``file://`` on shared storage, ``hdfs://``,
``s3://`` ...).

Cases: a null text counts as empty, an empty one has its end id only; a null
``doc_id`` sorts first; repeated rows are written one by one; extra columns
are ignored; no rows give no files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .tokenizer import BATCH_ROWS, encoder

SEQUENCE, BATCH, END_ID = 2048, 256, 1
FILE_DOCS, MAX_FILES = 8192, 20_000
MANIFEST = "bucket int, file string, n_docs long, n_tokens long, n_sequences long"
_DOC = pa.struct([("doc_id", pa.int64()), ("offset", pa.int32()), ("n_tokens", pa.int64())])


def file_schema(width: int, sequence: int = SEQUENCE) -> pa.Schema:
    ids = pa.uint16() if width == 2 else pa.uint32()
    return pa.schema([("ids", pa.list_(ids, sequence)), ("mask", pa.list_(pa.bool_(), sequence)), ("docs", pa.list_(_DOC))])


class FileWriter:
    """Takes documents' ids one after the other, writes full batches."""

    def __init__(self, path: str, name: str, attempt: int, dtype: np.dtype, sequence: int = SEQUENCE) -> None:
        self.fs, folder = pafs.FileSystem.from_uri(path)
        self.fs.create_dir(folder, recursive=True)
        self.final, self.temp = f"{folder}/{name}", f"{folder}/_{name}.{attempt}"
        self.dtype, self.sequence, self.schema = dtype, sequence, file_schema(dtype.itemsize, sequence)
        self.out = self.fs.open_output_stream(self.temp)
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int, int]] = []  # id, place in the batch, number of ids
        self.held = self.n_docs = self.n_tokens = self.n_sequences = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        full = self.sequence * BATCH
        self.docs.append((doc_id, self.held, len(ids)))
        self.n_docs += 1
        self.n_tokens += len(ids)
        while self.held + len(ids) >= full:
            cut = full - self.held
            self.parts.append(ids[:cut])
            self._flush(full)
            ids = ids[cut:]
        if len(ids):
            self.parts.append(ids)
            self.held += len(ids)

    def _flush(self, real: int) -> None:
        rows = -(-real // self.sequence)
        ids = np.zeros(rows * self.sequence, self.dtype)
        ids[:real] = np.concatenate(self.parts)
        mask = np.arange(len(ids)) < real
        begins = [[] for _ in range(rows)]
        for doc_id, at, n in self.docs:
            begins[at // self.sequence].append({"doc_id": doc_id, "offset": at % self.sequence, "n_tokens": n})
        self.writer.write_batch(pa.record_batch(
            [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.sequence),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), self.sequence), pa.array(begins, pa.list_(_DOC))],
            schema=self.schema))
        self.n_sequences += rows
        self.parts, self.docs, self.held = [], [], 0

    def close(self) -> tuple[str, int, int, int]:
        if self.held:
            self._flush(self.held)
        self.writer.close()
        self.out.close()
        self.fs.move(self.temp, self.final)
        return self.final.rpartition("/")[2], self.n_docs, self.n_tokens, self.n_sequences


class TokenFile:
    """Random access to a file: batches are views of the mapped file."""

    def __init__(self, path: str, name: str) -> None:
        fs, folder = pafs.FileSystem.from_uri(path)
        full = f"{folder}/{name}"
        local = isinstance(fs, pafs.LocalFileSystem)
        self.source = pa.memory_map(full) if local else fs.open_input_file(full)
        self.reader = pa.ipc.open_file(self.source)

    def __len__(self) -> int:
        n = self.reader.num_record_batches
        return (n - 1) * BATCH + self.reader.get_batch(n - 1).num_rows if n else 0

    def ids(self, batch: int) -> np.ndarray:
        """All ids of a batch, without a copy."""
        return self.reader.get_batch(batch).column("ids").flatten().to_numpy(zero_copy_only=True)

    def sequence(self, k: int) -> np.ndarray:
        rows = self.reader.get_batch(k // BATCH).column("ids")
        size = rows.type.list_size
        return rows.flatten().to_numpy(zero_copy_only=True)[k % BATCH * size:(k % BATCH + 1) * size]

    def mask(self, k: int) -> np.ndarray:
        return self.reader.get_batch(k // BATCH).column("mask")[k % BATCH].values.to_numpy(zero_copy_only=False)

    def documents(self) -> Iterator[tuple[int | None, int, list[np.ndarray]]]:
        """(doc_id, place of its first id in the file, its ids in pieces)."""
        for b in range(self.reader.num_record_batches):
            batch = self.reader.get_batch(b)
            size = batch.column("ids").type.list_size
            for row, docs in enumerate(batch.column("docs").to_pylist()):
                for d in docs:
                    at, left, pieces, k = row * size + d["offset"], d["n_tokens"], [], b
                    start = b * BATCH * size + at
                    while left:
                        piece = self.ids(k)[at:at + left]
                        pieces.append(piece)
                        left, at, k = left - len(piece), 0, k + 1
                    yield d["doc_id"], start, pieces


def even_keys(spark: SparkSession, n: int) -> np.ndarray:
    """A key for each of n partitions that Spark's hash deals to it alone."""
    span = int(n * (np.log(n + 1) + 12))
    k = F.col("id").cast("int")
    found = dict(spark.range(span).groupBy(F.pmod(F.hash(k), F.lit(n)).alias("p")).agg(F.min(k).alias("k")).collect())  # n rows
    return np.array([found.get(p, span + p) for p in range(n)], np.int32)


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, added: bool = False) -> DataFrame:
    """Write the files; returns the manifest (one row a file, at most
    ``MAX_FILES``), which is also kept as a Parquet table beside them."""
    docs = common.text_column(docs)
    files = max(1, min(MAX_FILES, -(-docs.count() // FILE_DOCS)))
    bounds = docs.approxQuantile("doc_id", [i / files for i in range(1, files)], 0.1 / files) if files > 1 else []
    bounds = np.array(sorted(set(bounds)), np.float64)
    keys = even_keys(docs.sparkSession, files)  # one file a task

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc, ids = encoder(tokenizer, added), batch.column("doc_id")
        bucket = np.searchsorted(bounds, ids.fill_null(-(1 << 62)).to_numpy(), side="left").astype(np.int32)
        raw = [np.append(x, enc.dtype.type(end_id)).tobytes() for x in enc.encode(batch.column("text"))]
        return pa.record_batch([ids, pa.array(bucket), pa.array(keys[bucket]), pa.array([enc.dtype.itemsize] * len(raw), pa.int32()),
                                pa.array(raw, pa.binary())], ["doc_id", "bucket", "dealt", "width", "ids"])

    encoded = common.map_batches(docs, encode, "doc_id long, bucket int, dealt int, width int, ids binary", "encoder", BATCH_ROWS)
    ordered = encoded.repartition(files, "dealt").sortWithinPartitions("bucket", F.col("doc_id").asc_nulls_first(), "ids")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt, open_, now = TaskContext.get().taskAttemptId(), None, None

        def done() -> pa.RecordBatch:
            name, *counts = open_.close()
            return pa.record_batch([pa.array([now], pa.int32()), pa.array([name]),
                                    *(pa.array([c], pa.int64()) for c in counts)],
                                   ["bucket", "file", "n_docs", "n_tokens", "n_sequences"])

        for batch in batches:
            for doc_id, bucket, width, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "bucket", "width", "ids"))):
                if bucket != now:
                    if open_ is not None:
                        yield done()
                    open_, now = FileWriter(path, f"tokens-{bucket:06d}.arrow", attempt, np.dtype(f"<u{width}")), bucket
                open_.add(doc_id, np.frombuffer(raw, open_.dtype))
        if open_ is not None:
            yield done()

    manifest = f"{path.rstrip('/')}/manifest"
    ordered.mapInArrow(common.in_task(store, "encoder"), MANIFEST).write.mode("overwrite").parquet(manifest)
    return docs.sparkSession.read.parquet(manifest)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: where its ids begin among all ids, how
    many there are, and their checksum as unsigned 32-bit integers."""
    rows = spark.read.parquet(f"{path.rstrip('/')}/manifest").orderBy("bucket").collect()  # a row a file
    first, starts = 0, []
    for r in rows:
        starts.append((r.file, first))
        first += r.n_tokens
    files = spark.createDataFrame(starts, "file string, first long").repartition(max(1, len(starts)), "file")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist()):
                out: list[list] = [[], [], [], []]
                for doc_id, start, pieces in TokenFile(path, name).documents():
                    crc = 0
                    for p in pieces:
                        crc = zlib.crc32(p.astype("<u4"), crc)
                    for column, value in zip(out, (doc_id, before + start, sum(map(len, pieces)), crc)):
                        column.append(value)
                yield pa.record_batch([pa.array(c, pa.int64()) for c in out], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(common.in_task(load), "doc_id long, start long, n_tokens long, ids_crc32 long")
