"""Helpers shared by the operators: reading documents, Arrow batches, scratch tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortmart.session import scratch_path

#: Rows in one Arrow batch.  A batch of whole texts stays a few MB, so a Python
#: worker holds one batch and its results whatever the partition's size.
BATCH_ROWS = 500


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_column(docs: DataFrame, null_as_empty: bool = True) -> DataFrame:
    """``doc_id`` (long) and ``text`` only, whatever other columns there are."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.coalesce(text, F.lit("")) if null_as_empty else text).alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores behind it a name that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: What a Python worker keeps between tasks: its owner and how to drop it.
_KEPT: dict[str, Callable[[], None]] = {}


def kept(owner: str, drop: Callable[[], None]) -> None:
    _KEPT[owner] = drop


def release(owner: str | None = None) -> None:
    """Drop what other operators' tasks have left in this worker: workers live
    on between stages, their caches should not."""
    for name, drop in _KEPT.items():
        if name != owner:
            drop()


def tidy() -> None:
    """Give memory that a task has freed back to the system; the worker stays."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def in_task(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], owner: str | None = None):
    """``fn`` over a task's batches, with the worker's memory kept small before and after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(owner)
        try:
            yield from fn(batches)
        finally:
            tidy()

    return run


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: str | T.StructType, owner: str | None = None, rows: int = BATCH_ROWS) -> DataFrame:
    """Apply ``fn`` (a module-level function or a closure over small values) to
    each Arrow batch of at most ``rows``; ``None`` emits nothing.  ``owner``:
    whose cache it uses."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None:
                yield out

    return df.mapInArrow(in_task(run, owner), schema)


def map_partitions(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                   schema: str | T.StructType, owner: str | None = None, rows: int = BATCH_ROWS) -> DataFrame:
    """Apply ``fn`` to all batches of a task, one after the other."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df.mapInArrow(in_task(fn, owner), schema)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    The written table cuts the lineage: a lost executor re-reads files and
    never recomputes what came before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


__all__ = ["BATCH_ROWS", "read_table", "text_column", "fresh", "in_task", "kept", "release", "tidy", "map_batches", "map_partitions", "materialize"]
