"""Surrogate ids: natural key → dense number, known keys reused.

``sequence_ids`` numbers rows 1…n in a total order without a single-partition
window: rows are range-partitioned on the order columns and sorted within
partitions, checkpointed (durable, lineage cut, so a lost executor cannot
re-sample different range bounds), counted per partition (one small row per
partition reaches the driver), and offset by the running total of the
preceding partitions through a broadcast of that per-partition table, whose
size is bounded by the partition count.  Every step is deterministic on
recomputation, so ids stay dense and unique when tasks are retried.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortmart.functions.columns import qcol
from cohortmart.session import ensure_checkpoint_dir

#: Slots of a bitmap of keys (8 MB).
BITMAP_BITS = 1 << 26
_LOCAL_BITS = 33  # monotonically_increasing_id = partition id << 33 | row index


def sequence_ids(df: DataFrame, order_cols: Sequence[str], id_col: str,
                 start: int = 0, num_partitions: int | None = None,
                 spread_ties: bool = True) -> DataFrame:
    """``df`` plus ``id_col`` = start + 1 … start + n following ``order_cols``
    (ties broken arbitrarily; give a total order for reproducible ids).  With
    no ``order_cols`` the ids follow the stored row order (no shuffle)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if not order_cols:
        # Unordered: dense unique ids in stored order.  The checkpoint fixes
        # every row's partition and position; no shuffle, no sort.
        ranged = (df.checkpoint(eager=True)
                  .withColumn("__pid", F.spark_partition_id())
                  .withColumn("__mid", F.monotonically_increasing_id()))
        return _apply_offsets(spark, ranged, id_col, start)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [qcol(c) for c in order_cols]
    if spread_ties:
        # Exact copies share every order value and a range partitioner cannot
        # split them; a per-row tiebreak lets a hot group of copies spread over
        # several ranges (copies are interchangeable, so ids stay correct).
        # The input is checkpointed first: row positions are then fixed, so the
        # tiebreak (and the range a row goes to) is the same if a lost task is
        # recomputed.
        df = (df.checkpoint(eager=True)
              .withColumn("__tie", F.monotonically_increasing_id()))
        cols.append(F.col("__tie"))
    ranged = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    return _apply_offsets(spark, ranged, id_col, start)


#: A range of melted rows above this size, and so many times the mean, holds a hot key.
HOT_ROWS, HOT_FACTOR = 4_000_000, 4


def sequence_melted(wide: DataFrame, melt: Callable[[DataFrame], DataFrame], lead_cols: Sequence[str], order_cols: Sequence[str],
                    id_col: str, start: int = 0, ranges: int | None = None) -> DataFrame:
    """:func:`sequence_ids` of ``melt(wide)``, which turns a row into several and
    keeps a column ``__pid``.  The wide rows are dealt to ranges of ``lead_cols``
    (the leading ``order_cols`` that they have; ``ranges`` of them, or as many as
    the size of the wide rows asks for) and stored once; their melted rows are
    sorted and numbered where they are, without a shuffle of their own.
    All rows of one lead value share a range; should one be hot, the melted rows
    are dealt by all their ``order_cols`` instead."""
    spark = wide.sparkSession
    ensure_checkpoint_dir(spark)
    if order_cols:
        wide = wide.repartitionByRange(*([] if ranges is None else [ranges]), *[qcol(c) for c in lead_cols])
    rows = melt(wide.checkpoint(eager=True).withColumn("__pid", F.spark_partition_id()))
    if order_cols:
        sizes = rows.groupBy("__pid").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.avg("n").alias("mean")).first()
        if (sizes.most or 0) > max(HOT_ROWS, HOT_FACTOR * (sizes.mean or 0)):
            return sequence_ids(rows.drop("__pid"), order_cols, id_col, start)
        rows = rows.sortWithinPartitions(*[qcol(c) for c in order_cols])
    return _apply_offsets(spark, rows.withColumn("__mid", F.monotonically_increasing_id()), id_col, start)


def _apply_offsets(spark, ranged: DataFrame, id_col: str, start: int) -> DataFrame:
    """id = start + rows in earlier partitions + position in the partition + 1."""
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, run = [], 0
    for r in sorted(counts, key=lambda r: r["__pid"]):
        offsets.append((r["__pid"], run))
        run += r["n"]
    if not offsets:
        return ranged.drop("__pid", "__mid", "__tie").withColumn(id_col, F.lit(None).cast("long"))
    off = spark.createDataFrame(offsets, "__pid int, __off long")
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), _LOCAL_BITS)
    return (ranged.join(F.broadcast(off), "__pid")
            .withColumn(id_col, (F.lit(start) + F.col("__off") + local + 1).cast("long"))
            .drop("__pid", "__mid", "__off", "__tie"))


def in_bitmap(stored: DataFrame, keys: DataFrame, key_cols: Sequence[str], bits: int = BITMAP_BITS) -> DataFrame:
    """The stored rows whose key's hash one of ``keys`` has: a filter of one
    pass over the stored rows, without a shuffle of them.  It is a left semi
    join with a broadcast side, which the optimizer moves down through unions
    and joins to the scan that the key comes from."""
    slot = F.pmod(F.xxhash64(*[qcol(c) for c in key_cols]), F.lit(bits))
    pieces = (keys.select(slot.alias("slot")).groupBy(F.expr("bitmap_bucket_number(slot)").alias("piece"))
              .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits")))  # bits / 32768 rows at most
    position = F.call_function("bitmap_bit_position", slot)
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftleft", F.lit(1), (position % 8).cast("int"))
    held = (F.call_function("bitmap_bucket_number", slot) == F.col("__piece")) & (byte.bitwiseAND(bit) != 0)
    return stored.join(F.broadcast(pieces.withColumnsRenamed({"piece": "__piece", "bits": "__bits"})), held, "left_semi")


def new_keys(incoming: DataFrame, existing: DataFrame | None, key_cols: Sequence[str]) -> DataFrame:
    """Distinct natural keys of ``incoming`` not yet in ``existing`` (left-anti join).
    Keys with a NULL part are not identifiable and are left out."""
    keys = incoming.select(*[qcol(c) for c in key_cols]).dropna().distinct()
    if existing is None:
        return keys
    return keys.join(existing.select(*[qcol(c) for c in key_cols]), list(key_cols), "left_anti")


def max_id(existing: DataFrame | None, id_col: str) -> int:
    if existing is None:
        return 0
    v = existing.agg(F.max(qcol(id_col)).alias("m")).collect()[0]["m"]
    return int(v) if v is not None else 0


def assign_ids(incoming: DataFrame, existing: DataFrame | None, key_cols: Sequence[str],
               id_col: str) -> tuple[DataFrame, DataFrame]:
    """(new mapping rows, full mapping).  New keys get max(existing) + rank of the
    key; re-running with the same batch adds nothing."""
    fresh = new_keys(incoming, existing, key_cols)
    numbered = sequence_ids(fresh, key_cols, id_col, start=max_id(existing, id_col),
                            spread_ties=False)  # distinct keys: no ties
    numbered = numbered.select(*[qcol(c) for c in key_cols], qcol(id_col))
    if existing is None:
        return numbered, numbered
    full = existing.select(*[qcol(c) for c in key_cols], qcol(id_col)).unionByName(numbered)
    return numbered, full


# --- fixed values: natural keys of the two identity maps -------------------
PATIENT_KEY = ("patient_ide", "patient_ide_source", "project_id")
ENCOUNTER_KEY = ("encounter_ide", "encounter_ide_source", "project_id", "patient_ide",
                 "patient_ide_source")
# --------------------------------------------------------------------------


def patient_keys(visits: DataFrame, source: str, project: str,
                 patient_col: str = "PATIENT_ID") -> DataFrame:
    return visits.select(qcol(patient_col).alias("patient_ide"),
                         F.lit(source).alias("patient_ide_source"),
                         F.lit(project).alias("project_id"))


def encounter_keys(visits: DataFrame, source: str, project: str,
                   patient_col: str = "PATIENT_ID", visit_col: str = "VISIT_ID") -> DataFrame:
    return visits.select(qcol(visit_col).alias("encounter_ide"),
                         F.lit(source).alias("encounter_ide_source"),
                         F.lit(project).alias("project_id"),
                         qcol(patient_col).alias("patient_ide"),
                         F.lit(source).alias("patient_ide_source"))


def assign_patient_num(visits: DataFrame, existing: DataFrame | None, source: str,
                       project: str) -> tuple[DataFrame, DataFrame]:
    return assign_ids(patient_keys(visits, source, project), existing, PATIENT_KEY, "patient_num")


def assign_encounter_num(visits: DataFrame, existing: DataFrame | None, source: str,
                         project: str) -> tuple[DataFrame, DataFrame]:
    return assign_ids(encounter_keys(visits, source, project), existing, ENCOUNTER_KEY,
                      "encounter_num")
