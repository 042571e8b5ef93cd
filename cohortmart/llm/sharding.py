"""Shards by vector bin packing (operator 5).

Rows with equal texts form a group; a group has a vector of bytes, tokens and
rows.  Groups are placed whole, largest first, each in the shard where the dot
product of its vector with the residual capacity is highest, so that all three
sums end up close together (the law the result keeps is ``bytes``).

At scale the groups are dealt by hash over packing buckets of some thousand
groups; each bucket packs into as many bins as there are shards, and the bins
of all buckets are then matched to the shards, one bin of a bucket for each
shard, again by the dot product.  Above ``MAX_BUCKETS`` buckets they are first
matched in tasks, at most so many at a time, to the bins of a bucket one level
up, level by level: neither a task nor the driver ever holds more than
``MAX_BUCKETS`` x shards vectors, and a bucket's size doesn't grow.  A
group heavier than one shard's share in any dimension can't be whole in one
shard without breaking the law; it alone is cut into parts by hash (there are
at most shards x dimensions such groups).

Cases: a null text has size 1 and groups with empty ones; repeated rows each
get a slot; a null ``doc_id`` is kept; extra columns are ignored; no rows give
no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SHARDS = 16
BUCKET_GROUPS, MAX_BUCKETS = 2048, 4096
CHUNK_ROWS, MAX_CHUNKS = 4096, 4096
_KEY = ["h", "text_crc32", "size"]
_DIMS = ["bytes", "tokens", "n"]
#: Weights of the dimensions in the dot product: the law's comes first.
WEIGHTS = np.array([64.0, 4.0, 1.0])


def spaces(text: Column) -> Column:
    """A cheap measure of tokens: pieces between spaces."""
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1


def dot_product_packing(items: np.ndarray, bins: int, once: bool = False, loads: np.ndarray | None = None) -> np.ndarray:
    """Bin of each item (rows of ``items`` are vectors, in the order to place
    them).  Every dimension is scaled to its sum, so the residual capacity of
    an empty bin is 1/bins each; ``loads``: what the bins hold already (scaled
    alike by the caller); ``once``: no bin takes two items."""
    share = np.ones(items.shape[1]) / bins
    residual = np.tile(share, (bins, 1)) if loads is None else share - loads
    out = np.zeros(len(items), np.int64)
    closed = np.zeros(bins)
    for i, item in enumerate(items):
        b = int(np.argmax(residual @ (WEIGHTS * item) + closed))
        out[i] = b
        residual[b] -= item
        if once:
            closed[b] = -np.inf
    return out


def _scaled(vectors: np.ndarray, total: np.ndarray) -> np.ndarray:
    return vectors / np.where(total > 0, total, 1)


def _pack_bucket(shards: int):
    def fn(group: pd.DataFrame) -> pd.DataFrame:
        vectors = group[_DIMS].to_numpy(np.float64)
        scaled = _scaled(vectors, vectors.sum(0))
        order = np.lexsort((group["part"], group["h"], group["text_crc32"], -scaled.sum(1)))
        bins = np.zeros(len(group), np.int32)
        bins[order] = dot_product_packing(scaled[order], shards)
        return group.assign(bin=bins)
    return fn


def _match(totals: pd.DataFrame, shards: int) -> list[tuple[int, int, int]]:
    """(bucket, bin, shard): heaviest buckets first, a bucket's heaviest bins first."""
    scaled = _scaled(totals[_DIMS].to_numpy(np.float64), totals[_DIMS].to_numpy(np.float64).sum(0))
    frame = totals[["bucket", "bin"]].assign(weight=scaled.sum(1), at=np.arange(len(totals)))
    loads, out = np.zeros((shards, len(_DIMS))), []
    heaviest = frame.groupby("bucket")["weight"].sum().sort_values(ascending=False, kind="stable").index
    by_bucket = {k: g.sort_values(["weight", "bin"], ascending=[False, True]) for k, g in frame.groupby("bucket")}
    for bucket in heaviest:
        g = by_bucket[bucket]
        items = scaled[g["at"].to_numpy()]
        chosen = dot_product_packing(items, shards, once=True, loads=loads)
        np.add.at(loads, chosen, items)
        out += [(int(bucket), int(b), int(s)) for b, s in zip(g["bin"], chosen)]
    return out


def _match_upper(shards: int):
    """The bins of one upper bucket's buckets, matched to its own bins."""
    def fn(group: pd.DataFrame) -> pd.DataFrame:
        upper_bin = {(k, b): s for k, b, s in _match(group, shards)}
        return group.assign(upper_bin=[upper_bin[k] for k in zip(group["bucket"], group["bin"])])
    return fn


def _bins_to_shards(totals: DataFrame, buckets: int, shards: int) -> DataFrame:
    """(bucket, bin, shard) of every bin, from the bins' sums."""
    sums = [F.sum(d).alias(d) for d in _DIMS]
    levels = []
    while buckets > MAX_BUCKETS:
        buckets = -(-buckets // MAX_BUCKETS)
        upper = totals.withColumn("upper", F.pmod("bucket", F.lit(buckets)).cast("int"))
        schema = "bucket int, bin int, bytes long, tokens long, n long, upper int, upper_bin int"
        levels.append(common.materialize(upper.groupBy("upper").applyInPandas(_match_upper(shards), schema), "shard-levels"))
        totals = levels[-1].groupBy(F.col("upper").alias("bucket"), F.col("upper_bin").alias("bin")).agg(*sums)
    top = totals.toPandas()  # <= MAX_BUCKETS x shards
    out = F.broadcast(totals.sparkSession.createDataFrame(_match(top, shards), "bucket int, bin int, shard int"))
    for level in reversed(levels):  # these grow with the input and are joined as tables
        out = (level.select("bucket", "bin", "upper", "upper_bin")
               .join(out.select(F.col("bucket").alias("upper"), F.col("bin").alias("upper_bin"), "shard"), ["upper", "upper_bin"])
               .select("bucket", "bin", "shard"))
    return out


def shard(docs: DataFrame, shards: int = SHARDS, tokens: Column | None = None) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot (dense from 0 in
    its shard), grown_shard (null: the law is not ``key``)."""
    spark = docs.sparkSession
    docs = common.text_column(docs)
    text = F.col("text")
    rows = common.materialize(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"), (spaces(text) if tokens is None else tokens).cast("long").alias("tokens")),
        "shard-rows")

    def group(frame: DataFrame, *more: str) -> DataFrame:
        return frame.groupBy(*_KEY, *more).agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
                                               F.count(F.lit(1)).alias("n"))

    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens")).first()
    if not total.n:
        return _result(rows.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long")))
    # At most shards x dimensions groups are heavier than a shard's share.
    heavy = group(rows).filter(" or ".join(f"{d} * {shards} > {int(total[d])}" for d in _DIMS)).withColumn(
        "parts", F.greatest(*(F.ceil(4 * shards * F.col(d) / max(1, int(total[d]))) for d in _DIMS)).cast("int"))
    heavy = spark.createDataFrame(heavy.select(*_KEY, "parts").collect(), "h long, text_crc32 long, size long, parts int")
    rows = (rows.join(F.broadcast(heavy), _KEY, "left")
            .withColumn("part", F.coalesce(F.pmod(F.xxhash64("row"), F.col("parts")), F.lit(0)).cast("int"))
            .drop("parts"))
    buckets = max(1, total.n // BUCKET_GROUPS)
    items = group(rows, "part").withColumn("bucket", F.pmod(F.xxhash64(*_KEY, "part", F.lit(1)), F.lit(buckets)).cast("int"))
    schema = "h long, text_crc32 long, size long, part int, bytes long, tokens long, n long, bucket int, bin int"
    packed = common.materialize(items.groupBy("bucket").applyInPandas(_pack_bucket(shards), schema), "shard-bins")
    totals = packed.groupBy("bucket", "bin").agg(*(F.sum(d).alias(d) for d in _DIMS))
    placed = packed.join(_bins_to_shards(totals, buckets, shards), ["bucket", "bin"]).select(*_KEY, "part", "shard")
    chunks = max(1, min(MAX_CHUNKS, total.n // CHUNK_ROWS))
    assigned = common.materialize(
        rows.join(placed, [*_KEY, "part"]).withColumn("chunk", F.pmod(F.xxhash64("row", F.lit(2)), F.lit(chunks)).cast("int")),
        "shard-rows-placed")
    # Slots: rows numbered within (shard, chunk), behind the rows of the shard's earlier chunks.
    sizes = assigned.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n")).toPandas()  # <= shards x chunks
    sizes = sizes.sort_values(["shard", "chunk"], ignore_index=True)
    sizes["before"] = sizes.groupby("shard")["n"].cumsum() - sizes["n"]
    before = spark.createDataFrame(sizes[["shard", "chunk", "before"]].astype({"shard": "int32", "chunk": "int32"}),
                                   "shard int, chunk int, before long")
    within = "row_number() over (partition by shard, chunk order by row)"
    return _result(assigned.withColumn("at", F.expr(within)).join(F.broadcast(before), ["shard", "chunk"])
                   .withColumn("slot", F.col("before") + F.col("at") - 1))


def _result(frame: DataFrame) -> DataFrame:
    return frame.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
