"""File sources and sinks: header CSV, batch folders, merged outputs, flat exports."""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortmart.functions.columns import qcol
from cohortmart.sources.storage import Files

FILE_COLUMN = "__file"

# RFC-4180 flat files: quotes doubled, NULL and '' both written as empty; text
# keeps its own white space and line breaks.
CSV_WRITE_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "",
                     "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# A quoted line break makes a file unsplittable for Spark's reader (multiLine);
# large files are cut by ``records``.  A value that does not parse fails the scan.
CSV_READ_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST",
                    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _files_by_header(spark: SparkSession, path: str | Sequence[str]) -> list[tuple[list[str], list[str]]]:
    """(column names, files) of every distinct header.  A task reads whatever
    blocks Spark's reader opens for it, even if Python stops behind the header,
    so only files up to ``SPLIT_BYTES`` are a task each; the first bytes of larger
    ones, few for what they hold, are fetched by the driver.  One row a file
    reaches the driver, which lists the files anyway."""
    listed = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path)).select(
        "path", F.col("_metadata.file_path").alias("file"), (F.col("length") > SPLIT_BYTES).alias("large"))
    large = listed.filter("large").collect()
    if large:
        path = [r.path for r in listed.filter("not large").collect()]
    files = Files(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")) if path else None

    def first_record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[str]] = {}
        for batch in batches:
            for value, file, block in zip(*(c.to_pylist() for c in batch.columns)):
                if block or (file in held and held[file][-1] is None):
                    continue  # not the start of a file, or its header is complete
                got = held.setdefault(file, [])
                got.append(value)
                if sum(v.count('"') for v in got) % 2 == 0:
                    got.append(None)
            if held and all(got[-1] is None for got in held.values()) and len(set(batch.column(1).to_pylist())) == 1:
                break  # the rest of this file is not read
        yield pa.record_batch([pa.array(list(held)), pa.array(["\n".join(v for v in got if v is not None) for got in held.values()])],
                              ["file", "header"])

    # One file a partition, small batches: a task reads little of what it opens.
    with settings(spark, {"spark.sql.files.openCostInBytes": str(1 << 40), "spark.sql.files.maxPartitionBytes": str(1 << 40),
                          "spark.sql.execution.arrow.maxRecordsPerBatch": "64"}):
        found = [tuple(r) for r in lines.mapInArrow(first_record, "file string, header string").collect()] if path else []
    by: dict[tuple[str, ...], list[str]] = {}
    for file, header in sorted([*found, *((r.file, files.header(r.path)) for r in large)]):
        header = header.lstrip("\ufeff").rstrip("\r")
        by.setdefault(tuple(next(csv.reader([header]) if "\n" not in header else csv.reader(io.StringIO(header, newline="")))), []).append(file)
    return [(list(h), files) for h, files in by.items()]


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs of a block; as they were afterwards."""
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: A quoted file above this size is cut, so that several tasks read it.
SPLIT_BYTES = 256 << 20


def records(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(file, record): the records of CSV files without their headers, large
    files read by many tasks.

    A line break inside quotes does not end a record, and a task that starts in
    the middle of a file cannot know whether it stands inside.  So a first pass
    counts the quotes of every block of a file; the parity of all before a block
    says how it starts.  Blocks are then read independently: records that lie
    within one are whole, and the pieces of those that a cut runs through (at
    most two a block) are put together again."""
    lines = spark.read.option("lineSep", "\n").text(list(files)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    blocks = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).cast("int").alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int").alias("inside"))
    starts = starts.checkpoint(eager=True)  # one row a block
    if starts.count() <= MAX_BLOCKS:  # a broadcast join leaves the lines in their order
        told = lines.join(F.broadcast(starts), ["file", "block"])
    else:
        told = (lines.withColumn("at", F.monotonically_increasing_id()).join(starts, ["file", "block"])
                .repartition("file", "block").sortWithinPartitions("file", "block", "at"))

    def made(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["file", "block", "seq", "kind", "record"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, open_, tail, held, seq, out = None, False, False, [], 0, []

        def close(kind: int) -> None:
            nonlocal held, seq
            text = "\n".join(held)
            out.append((*key, seq, kind, text[:-1] if kind in (0, _TAIL) and text.endswith("\r") else text))
            held, seq = [], seq + 1

        for batch in batches:
            names = batch.schema.names
            value, file, block, inside = (batch.column(names.index(c)).to_pylist() for c in ("value", "file", "block", "inside"))
            odd = pc.bit_wise_and(pc.count_substring(batch.column(names.index("value")), '"'), 1).to_pylist()
            for v, f, b, i, o in zip(value, file, block, inside, odd):
                if (f, b) != key:
                    if held:
                        close(_MIDDLE if tail else _HEAD)
                    key, open_, seq, tail = (f, b), bool(i), 0, bool(i)
                held.append(v)
                open_ = open_ != bool(o)
                if not open_:
                    close(_TAIL if tail else 0)
                    tail = False
            if out:
                yield made(out)
                out = []
        if held:
            close(_MIDDLE if tail else _HEAD)
            yield made(out)

    found = told.mapInArrow(cut, "file string, block long, seq long, kind int, record string")
    whole = found.filter((F.col("kind") == 0) & ~((F.col("block") == 0) & (F.col("seq") == 0)))
    order = Window.partitionBy("file").orderBy("block", "seq")
    pieces = found.filter("kind <> 0").withColumn("of", F.sum((F.col("kind") == _HEAD).cast("int")).over(order))
    joined = (pieces.groupBy("file", "of").agg(F.sort_array(F.collect_list(F.struct("block", "seq", "record"))).alias("p"))
              .select("file", F.concat_ws("\n", "p.record").alias("record")))
    return whole.select("file", "record").unionByName(joined).filter("record <> ''")


#: Pieces of a record that a cut runs through: it begins, goes through, or ends in a block.
_HEAD, _MIDDLE, _TAIL = 1, 2, 3
#: Blocks whose states (some 100 bytes each) may be broadcast.
MAX_BLOCKS = 500_000


def _read(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
          missing: str = "fail", split_bytes: int | None = None, **options: str) -> DataFrame | None:
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    headers = _files_by_header(spark, path)
    if not headers:
        return None
    for header, files in headers:
        lacking = [f.name for f in schema.fields if f.name not in header]
        if lacking and missing == "fail":
            raise ValueError(f"columns {lacking} are not in the header of {files[0]}")
    if len(headers) > 1:
        return _by_column_map(spark, headers, schema, options)
    (header, files), want = headers[0], {f.name: f for f in schema.fields}
    found = T.StructType([want.get(h) or T.StructField(h, T.StringType()) for h in header])
    opts, sizes = {**CSV_READ_OPTIONS, **options}, Files(spark)
    most = SPLIT_BYTES if split_bytes is None else split_bytes
    large = [f for f in files if sizes.size(f)[1] > most] if opts["multiLine"] == "true" else []
    parts = []
    if len(large) < len(files):
        whole = spark.read.options(**opts).schema(found).csv([f for f in files if f not in set(large)])
        parts.append(whole.withColumn(FILE_COLUMN, F.col("_metadata.file_path")))
    if large:
        parse = {k: v for k, v in opts.items() if k not in ("header", "multiLine")}
        rows = records(spark, large).select(F.from_csv("record", found.toDDL(), parse).alias("r"), F.col("file").alias(FILE_COLUMN))
        parts.append(rows.select("r.*", FILE_COLUMN))
    df = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return df.select(*[qcol(n) if n in header else F.lit(None).cast(f.dataType).alias(n) for n, f in want.items()], FILE_COLUMN)


def _column_map(spark: SparkSession, headers: list[tuple[list[str], list[str]]], options: dict[str, str]) -> DataFrame:
    """(file, values): all files in one scan, whatever their headers; ``values``
    maps a file's column names to its texts."""
    width = max(len(h) for h, _ in headers)
    wide = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    opts = {**CSV_READ_OPTIONS, **options, "mode": "PERMISSIVE"}  # shorter rows are those of narrower files
    files = [f for _, group in headers for f in group]
    names = spark.createDataFrame([(f, h) for h, group in headers for f in group], "file string, names array<string>")
    scan = spark.read.options(**opts).schema(wide).csv(files)
    rows = scan.select(F.array(*wide.names).alias("texts"), F.col("_metadata.file_path").alias("file"))
    return (rows.join(F.broadcast(names), "file")  # one row a file, as the driver lists them
            .select("file", F.map_from_arrays("names", F.slice("texts", F.lit(1), F.size("names"))).alias("values")))


def _by_column_map(spark: SparkSession, headers: list[tuple[list[str], list[str]]], schema: T.StructType,
                   options: dict[str, str]) -> DataFrame:
    values = F.col("values")
    return _column_map(spark, headers, options).select(
        *[F.try_element_at(values, F.lit(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields], F.col("file").alias(FILE_COLUMN))


# --- fixed values: how texts of a type look ---------------------------------
_INTEGER, _DECIMAL, _DATE = r"^[+-]?[0-9]{1,18}$", r"^[+-]?[0-9]{1,13}(\.[0-9]{1,5})?$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
# ----------------------------------------------------------------------------


def reconciled_schema(spark: SparkSession, path: str | Sequence[str], **options: str) -> T.StructType:
    """The columns of all files together, each of the narrowest type that holds
    all its texts in all files: integer, then decimal(18,5), or date, else text;
    a column without any text is text.  Columns follow the order in which the
    files' headers name them.  One scan and one aggregate, whatever the number
    of headers."""
    headers = _files_by_header(spark, path)
    names: list[str] = []
    for header, _ in sorted(headers, key=lambda x: x[1][0]):
        names += [n for n in header if n not in names]
    if not names:
        return T.StructType([])
    # A (column, kinds seen) table: as many rows as there are columns, whatever the files.
    texts = (_column_map(spark, headers, options).select(F.explode("values").alias("name", "text"))
             .filter(F.col("text").isNotNull() & (F.col("text") != "")))
    text = F.col("text")
    kinds = {r.name: r for r in texts.groupBy("name").agg(
        F.min(text.rlike(_INTEGER).cast("int")).alias("integer"), F.min(text.rlike(_DECIMAL).cast("int")).alias("decimal"),
        F.min((text.rlike(_DATE) & F.try_to_date(text).isNotNull()).cast("int")).alias("date")).collect()}

    def kind(name: str) -> T.DataType:
        r = kinds.get(name)
        if r is None:
            return T.StringType()
        return (T.LongType() if r.integer else T.DecimalType(18, 5) if r.decimal else T.DateType() if r.date else T.StringType())

    return T.StructType([T.StructField(n, kind(n)) for n in names])


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
             missing: str = "fail", split_bytes: int | None = None, **options: str) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass over the data).

    Columns are found by their header names, in whatever order a file has
    them; further columns of a file are left out.  A column that a file lacks
    is an error, or NULL with ``missing="null"``.  Files above ``split_bytes``
    (``SPLIT_BYTES``) are read by several tasks, see :func:`records`.
    """
    out = _read(spark, path, schema, missing, split_bytes, **options)
    return spark.createDataFrame([], schema) if out is None else out.drop(FILE_COLUMN)


def read_batch(spark: SparkSession, root: str, batch: str, schema: T.StructType | str,
               batch_col: str = "batch", file_col: str | None = "source_file",
               **options: str) -> DataFrame:
    """All CSV files of one named batch folder, tagged with the batch name and the
    file each row came from.  A folder that is missing or empty is an error."""
    path = f"{root.rstrip('/')}/{batch}"
    df = _read(spark, path, schema, **options)
    if df is None:
        raise FileNotFoundError(f"batch folder {path} holds no files")
    columns = [qcol(c) for c in df.columns if c != FILE_COLUMN]
    columns.append(F.lit(batch).alias(batch_col))
    if file_col:
        columns.append(F.col(FILE_COLUMN).alias(file_col))
    return df.select(*columns)


def merge_outputs(spark: SparkSession, pattern: str | Sequence[str], schema: T.StructType | str | None = None,
                  missing: str = "null", **options: str) -> DataFrame:
    """Many per-subject output files → one table, by column name, in one scan
    however many headers they have; columns missing in a file become NULL.
    Without a ``schema`` the files' own columns, see :func:`reconciled_schema`."""
    if schema is None:
        schema = reconciled_schema(spark, pattern, **options)
    return read_csv(spark, pattern, schema, missing=missing, **options)


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Append tables by column name; columns missing in a table become NULL."""
    if not frames:
        raise ValueError("nothing to union")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> str:
    """Flat CSV with header, as a folder of part files, or of one file.

    Overwriting goes through :func:`replace_folder`: what is there stays until
    the new files are complete, so ``df`` may read from ``path`` itself.
    ``single_file``: the parts are written in parallel without a header and then
    put behind it by the file system."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    if mode == "append":
        if single_file:
            raise ValueError("a single file is replaced, not appended to")
        df.write.mode("append").options(**CSV_WRITE_OPTIONS).csv(path)
        return path

    def fill(folder: str) -> None:
        if single_file:
            _write_single(df, folder)
        else:
            df.write.options(**CSV_WRITE_OPTIONS).csv(folder)

    replace_folder(df.sparkSession, path, fill)
    return path


def _write_single(df: DataFrame, folder: str) -> None:
    """``folder``/part-00000.csv: the header, then every part's bytes in order."""
    files, parts = Files(df.sparkSession), f"{folder}/_parts"
    df.write.options(**{**CSV_WRITE_OPTIONS, "header": "false"}).csv(parts)
    line = io.StringIO()
    csv.writer(line, lineterminator="\n").writerow(df.columns)
    files.write(f"{folder}/part-00000.csv", line.getvalue())
    names = [n for n in files.names(parts) if n.startswith("part-")]
    files.concatenate(f"{folder}/part-00000.csv", [f"{parts}/{n}" for n in names])
    files.delete(parts)


def replace_folder(spark: SparkSession, path: str, fill: Callable[[str], None]) -> None:
    """Replace the folder ``path`` by what ``fill`` writes into a new one.

    The new folder is filled beside the old one and marked as complete; then the
    old one steps aside, the new one takes its name, and the old one goes.  A run
    that dies on the way loses nothing: :func:`recover_folder` (also the first
    thing done here) finishes the exchange or undoes it."""
    files, path = Files(spark), path.rstrip("/")
    recover_folder(spark, path)
    new = f"{path}{_NEW}"
    fill(new)
    files.write(f"{new}/{_COMPLETE}", "")
    _exchange(files, path)


#: Beside a folder while it is replaced, and the mark of a complete new one.
_NEW, _OLD, _COMPLETE = "._new", "._old", "_complete"


def _exchange(files: Files, path: str) -> None:
    new, old = f"{path}{_NEW}", f"{path}{_OLD}"
    if files.exists(path):
        files.rename(path, old)
    files.rename(new, path)
    files.delete(old)
    files.delete(f"{path}/{_COMPLETE}")


def recover_folder(spark: SparkSession, path: str) -> str | None:
    """Put right what a replacement that died has left of ``path``; what was done."""
    files, path = Files(spark), path.rstrip("/")
    new, old = f"{path}{_NEW}", f"{path}{_OLD}"
    if files.exists(f"{path}/{_COMPLETE}"):  # the new folder is in place already
        files.delete(old)
        files.delete(f"{path}/{_COMPLETE}")
        files.delete(new)
        return "finished"
    if files.exists(f"{new}/{_COMPLETE}"):
        _exchange(files, path)
        return "finished"
    done = None
    if files.exists(old) and not files.exists(path):
        files.rename(old, path)
        done = "undone"
    if files.exists(new):
        files.delete(new)
        done = "undone"
    return done


def append_problem(new: DataFrame, previous: DataFrame, key_cols: Sequence[str]) -> str | None:
    """Why a previous export can't be appended, or None: other columns, a NULL
    or repeated key in it, or a key that the new export has."""
    if previous.columns != new.columns:
        return "columns differ"
    keys = [qcol(c) for c in key_cols]
    null = F.lit(False)
    for k in keys:
        null = null | k.isNull()
    held = (new.select(*keys, F.lit(0).alias("__prev")).unionByName(previous.select(*keys, F.lit(1).alias("__prev")))
            .groupBy(*keys).agg(F.sum("__prev").alias("__p"), F.count(F.lit(1)).alias("__n")).filter("__p > 0"))
    found = held.agg(F.max(null.cast("int")).alias("nulls"), F.max((F.col("__p") > 1).cast("int")).alias("repeated"),
                     F.max((F.col("__n") > F.col("__p")).cast("int")).alias("clash")).first()
    for flag, reason in (("nulls", "NULL key"), ("repeated", "repeated key"), ("clash", "key already present")):
        if found[flag]:
            return reason
    return None


def unreadable(df: DataFrame) -> str | None:
    """Why a scan fails, or None: one pass that parses every value."""
    try:
        df.agg(F.max(F.xxhash64(*[qcol(c) for c in df.columns]))).collect()
    except PySparkException as e:
        return f"unreadable: {e.getCondition() or type(e).__name__}"
    return None


def append_export(new: DataFrame, previous: DataFrame | None, key_cols: Sequence[str], new_keys: DataFrame | None = None) -> DataFrame:
    """Append a previous export, all or nothing: it is added only if
    :func:`append_problem` finds none (one aggregate over the keys).
    ``new_keys``: the keys of ``new`` where they are to be had without
    computing its rows."""
    if previous is None or previous.columns != new.columns:
        return new
    prev = previous.select(*[qcol(c).cast(f.dataType).alias(f.name) for c, f in
                             zip(previous.columns, new.schema.fields)])
    keys = [qcol(c) for c in key_cols]
    problem = (append_problem(new, prev, key_cols) if new_keys is None
               else append_problem(new_keys.select(*keys), prev.select(*keys), key_cols))
    return new if problem else new.unionByName(prev)
