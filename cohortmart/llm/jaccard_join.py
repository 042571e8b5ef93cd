"""Exact n-gram Jaccard self-join by set relations (operator 6).

A document's set is its distinct word shingles; equal sets are one set from
the start.  Two sets link when 100 |A & B| >= threshold |A | B|.

*Index.*  Every set lists its rarest shingles: with n shingles, any partner
shares one of the first ``n - ceil(threshold n / 100) + 1`` in an order that
all sets use (by how often a shingle's cell of a count sketch over the whole
corpus is hit, then by hash).  The postings of a shingle are an index list.

*Answers from a similar set's answers.*  Links only have to be known up to
reachability.  Each set is first compared with the leaders of its lists; what
links to a leader takes over the leader's component, and two sets of one
component need no comparison of their own.  A group of thousands of near
copies so costs a few comparisons a copy.

*Lists skipped by blocks.*  Only lists that still hold several components are
joined.  A list is sorted by size and cut into blocks; a pair of blocks is
skipped when the sizes and positions in it leave no room for a link, and
inside the rest pairs fall to the same two filters, to a common component, and
to the sets' parity bitmaps (the bits that differ are a lower bound of the
elements that differ; only long lists carry them, pairs of short ones are
looked up).  A list longer than ``LIST`` is dealt over pairs of
parts, each pair of parts to a task of its own.

All that is left is verified on the exact sets.  Sketch, lists and components
are tables; the driver sees the sketch (fixed size) and counts.

Cases: a null text, or one without words, has the empty set, links with
nothing and is its own component; fewer words than a shingle has are one
shingle; rows with an equal id are separate documents that share their id;
a null id is never a component's name unless the class has no other; extra
columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components
from .shingles import document_words, set_key, shingle_set

SHINGLE, THRESHOLD = 3, 90
#: Cells of the count sketch (4 bytes each); more cells only sharpen the order.
CELLS = 1 << 20
_CELL_CHUNKS = 64
#: Leaders each list offers; entries of a list joined in one task; a block;
#: a list from which on its entries bring their parity bits along.
LEADERS, LIST, BLOCK, LONG = 6, 4096, 64, 33
#: Rows of a table of ids that may be broadcast (16 bytes a row).
BROADCAST_ROWS = 2_000_000
_MAX_BITS = 1 << 16


def _sets(batch: pa.RecordBatch, k: int) -> list[np.ndarray]:
    return [shingle_set(w, k) for w in document_words(batch.column("text"))]


def prefix_length(n: int, threshold: int) -> int:
    return n - -(-threshold * n // 100) + 1


def count_sketch(docs: DataFrame, k: int, cells: int = CELLS) -> np.ndarray:
    """How many documents hit each cell, over the whole corpus."""
    size = cells // _CELL_CHUNKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.uint32)
        for batch in batches:
            held = _sets(batch, k)
            if held:
                total += np.bincount((np.concatenate(held) & np.uint64(cells - 1)).astype(np.int64), minlength=cells).astype(np.uint32)
        yield pa.record_batch([pa.array(range(_CELL_CHUNKS), pa.int32()),
                               pa.array([total[c * size:(c + 1) * size].tobytes() for c in range(_CELL_CHUNKS)], pa.binary())],
                              ["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, raw in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                part = np.frombuffer(raw, np.uint32).astype(np.uint64)
                sums[c] = sums[c] + part if c in sums else part
        if sums:
            yield pa.record_batch([pa.array(list(sums), pa.int32()),
                                   pa.array([np.minimum(s, (1 << 32) - 1).astype(np.uint32).tobytes() for s in sums.values()], pa.binary())],
                                  ["chunk", "counts"])

    schema = "chunk int, counts binary"
    parts = (docs.mapInArrow(common.in_task(count), schema).repartition(_CELL_CHUNKS, "chunk")
             .mapInArrow(common.in_task(add), schema).collect())
    out = np.zeros(cells, np.uint32)
    for c, raw in parts:
        out[c * size:(c + 1) * size] = np.frombuffer(raw, np.uint32)
    return out


def ordered_prefix(hashes: np.ndarray, sketch: np.ndarray, threshold: int) -> np.ndarray:
    """The set's first shingles in the common order: by count, then by hash."""
    p = prefix_length(len(hashes), threshold)
    count = np.minimum(sketch[hashes & np.uint64(len(sketch) - 1)], (1 << 24) - 1).astype(np.uint64)
    key = (count << np.uint64(40)) | (hashes >> np.uint64(24))
    first = np.argpartition(key, p - 1)[:p] if p < len(key) else np.arange(len(key))
    return hashes[first[np.lexsort((hashes[first], key[first]))]]


def parity_bits(hashes: np.ndarray) -> bytes:
    """For each of 2^m >= n cells, whether an odd number of shingles hits it."""
    bits = min(_MAX_BITS, max(64, 1 << (len(hashes) - 1).bit_length()))
    cell = ((hashes >> np.uint64(20)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(cell, minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows) halved down to ``size`` bytes; parities stay parities."""
    while bits.shape[1] > size:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def may_link(na: np.ndarray, nb: np.ndarray, differ: np.ndarray, threshold: int) -> np.ndarray:
    """Whether sets of these sizes that differ in at least so many elements can link."""
    both = (na + nb - differ) // 2  # at most so many in common
    return 100 * both >= threshold * (na + nb - both)


def _differing(bits: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """At least so many elements differ between the sets of each pair."""
    out = np.zeros(len(a), np.int64)
    size = np.array([len(x) for x in bits])
    low = np.minimum(size[a], size[b])
    for s in np.unique(low):
        at = np.flatnonzero(low == s)
        used = np.unique(np.concatenate([a[at], b[at]]))
        place = np.zeros(len(bits), np.int64)
        place[used] = np.arange(len(used))
        folded = np.stack([fold(np.frombuffer(bits[i], np.uint8)[None], s)[0] for i in used])
        words = folded.view(np.uint64)  # bitmaps have 8 bytes at least
        for c in range(0, len(at), 4096):
            rows = at[c:c + 4096]
            out[rows] = np.bitwise_count(words[place[a[rows]]] ^ words[place[b[rows]]]).sum(1)
    return out


def list_pairs(n: np.ndarray, pos: np.ndarray, group: np.ndarray, threshold: int, part: np.ndarray | None = None,
               bits: list[bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one list's entries that may link, from entries sorted by size.
    With ``part`` (0 or 1) only pairs across the two parts; ``bits``: parity
    bits, where the entries bring them."""
    left, right = [], []
    starts = np.arange(0, len(n), BLOCK)
    room = n - pos  # the shingles from the common one on
    least_n, most_n = n[starts], np.maximum.reduceat(n, starts)
    most_room = np.maximum.reduceat(room, starts)
    for x, a in enumerate(starts):
        i = np.arange(a, min(a + BLOCK, len(n)))
        # Sizes ascend: blocks whose least set is too large for this block's largest end the run.
        for y in range(x, len(starts)):
            if threshold * least_n[y] > 100 * most_n[x]:
                break
            need = -(-threshold * (least_n[x] + least_n[y]) // (100 + threshold))
            if min(most_room[x], most_room[y]) < need:
                continue
            j = np.arange(starts[y], min(starts[y] + BLOCK, len(n)))
            ni, nj = n[i][:, None], n[j][None]
            ok = (threshold * nj <= 100 * ni) & (np.minimum(room[i][:, None], room[j][None]) * (100 + threshold) >= threshold * (ni + nj))
            ok &= group[i][:, None] != group[j][None]
            if part is not None:
                ok &= part[i][:, None] != part[j][None]
            if x == y:
                ok = np.triu(ok, 1)
            if ok.any():
                p, q = np.nonzero(ok)
                p, q = i[p], j[q]
                if bits is not None:
                    keep = may_link(n[p], n[q], _differing(bits, p, q), threshold)
                    p, q = p[keep], q[keep]
                left.append(p)
                right.append(q)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


class Sets:
    """The documents and, by set, its key, size, parity bits and least id."""

    def __init__(self, docs: DataFrame, rows: DataFrame, shingle: int, threshold: int) -> None:
        self.docs, self.shingle, self.threshold = docs, shingle, threshold
        held = rows.filter("sid is not null")
        self.ids = common.materialize(held.groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")), "set-ids")
        self.bits = common.materialize(held.groupBy("sid").agg(F.min("n").alias("n"), F.first("bits").alias("bits")), "set-bits")

    def near(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose parity bits leave room for a link."""
        a, b = (self.bits.select(*(F.col(c).alias(f"{c}{s}") for c in ("sid", "n", "bits"))) for s in "ab")
        both = (pairs.join(a, F.col("a") == F.col("sida")).join(b, F.col("b") == F.col("sidb"))
                .select("a", "b", "na", "nb", "bitsa", "bitsb"))
        threshold = self.threshold

        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            x, y = (batch.column(f"bits{s}").to_pylist() for s in "ab")
            rows = np.arange(len(x))
            keep = may_link(batch.column("na").to_numpy(), batch.column("nb").to_numpy(), _differing(x + y, rows, rows + len(x)), threshold)
            return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return common.map_batches(both, fn, "a long, b long")

    def exact(self, ids: DataFrame) -> DataFrame:
        """(sid, hashes) of the sets with these keys, from their documents."""
        shingle = self.shingle
        lenders = common.materialize(self.ids.join(_small(ids), "sid", "left_semi").select("sid", F.col("doc_id").alias("lender")), "lenders")

        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            held = _sets(batch, shingle)
            return pa.record_batch([pa.array([set_key(h) if len(h) else None for h in held], pa.int64()), batch.column("doc_id"),
                                    pa.array([h.tobytes() for h in held], pa.binary())], ["sid", "doc_id", "hashes"])

        named = lenders.filter("lender is not null").select(F.col("lender").alias("doc_id")).distinct()
        lent = self.docs.join(_small(named), "doc_id", "left_semi").unionByName(self.docs.filter("doc_id is null"))
        # An id may stand on several rows: the set's key tells which text is meant.
        sets = common.map_batches(lent, fn, "sid long, doc_id long, hashes binary").join(_small(lenders), "sid")
        sets = common.materialize(sets.filter("doc_id <=> lender").select("sid", "hashes"), "exact-sets")
        if sets.count() > lenders.count():  # repeated rows
            sets = common.materialize(sets.dropDuplicates(["sid"]), "exact-sets-once")
        return sets

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link: by their bits, then by the exact sets."""
        threshold = self.threshold
        pairs = common.materialize(self.near(pairs), "pairs")
        ids = common.materialize(pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct(), "pair-ids")
        held = self.exact(ids)
        a, b = (held.select(F.col("sid").alias(s), F.col("hashes").alias(f"h{s}")) for s in "ab")

        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = []
            for x, y in zip(batch.column("ha"), batch.column("hb")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return common.materialize(common.map_batches(pairs.join(a, "a").join(b, "b").select("a", "b", "ha", "hb"), fn, "a long, b long"), "links")


def _shared_lists(index: DataFrame) -> DataFrame:
    """(token, sid, n, pos): the lists of shingles that several sets have."""
    postings = index.select("sid", "n", F.posexplode("prefix").alias("pos", "token"))
    shared = (postings.groupBy("token").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).filter("lo <> hi").select("token"))
    shared = common.materialize(shared, "shared-shingles")
    return common.materialize(postings.join(_small(shared), "token", "left_semi")
                              .groupBy("token", "sid").agg(F.min("n").alias("n"), F.min("pos").alias("pos")), "lists")


def _leader_pairs(lists: DataFrame, threshold: int) -> DataFrame:
    """Pairs of a set and a leader of one of its lists that may link."""
    least = [F.min(F.struct(F.xxhash64("sid", F.lit(0)).alias("h"), "sid", "n", "pos")).alias("l0")]
    least += [F.min(F.struct(F.xxhash64("sid", "token", F.lit(r)).alias("h"), "sid", "n", "pos")).alias(f"l{r}") for r in range(1, LEADERS)]
    leaders = lists.groupBy("token").agg(*least).select("token", F.array(*(f"l{r}" for r in range(LEADERS))).alias("leaders"))
    return (lists.join(leaders, "token").select("sid", "n", "pos", F.explode(F.array_distinct("leaders")).alias("l"))
            .filter("sid <> l.sid").filter(_room(F.col("n"), F.col("pos"), F.col("l.n"), F.col("l.pos"), threshold))
            .select(F.greatest("sid", "l.sid").alias("a"), F.least("sid", "l.sid").alias("b")).distinct())


def _room(na: Column, pa_: Column, nb: Column, pb: Column, threshold: int) -> Column:
    """The size and position filters for two entries of a list."""
    return ((F.lit(threshold) * F.greatest(na, nb) <= 100 * F.least(na, nb))
            & (F.least(na - pa_, nb - pb) * (100 + threshold) >= threshold * (na + nb)))


def _list_pairs(lists: DataFrame, groups: DataFrame, bits: DataFrame, threshold: int) -> DataFrame:
    """Pairs that may link, from the lists that hold several components."""
    grouped = (lists.join(groups, F.col("sid") == F.col("vertex"), "left")
               .select("token", "sid", "n", "pos", F.coalesce("component", "sid").alias("component")))
    several = (grouped.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("length"))
               .filter("lo <> hi").select("token", (F.col("length") >= LONG).alias("long"), F.ceil(F.col("length") / LIST).cast("int").alias("parts")))
    entries = common.materialize(grouped.join(_small(common.materialize(several, "open-lists")), "token"), "open-entries")
    # A list of more than one part: one group for each pair of parts (i <= j), an entry in all pairs of its part.
    mine = F.pmod(F.xxhash64("sid", F.lit(9)), F.col("parts")).cast("int")
    dealt = (entries.withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other")))
    columns = ["token", "i", "j", "sid", "n", "pos", "component", "mine"]
    brought = dealt.filter("long").join(bits.select("sid", "bits"), "sid").select(*columns, "bits")
    dealt = dealt.filter("not long").select(*columns, F.lit(None).cast("binary").alias("bits")).unionByName(brought)
    ordered = dealt.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n", "pos", "sid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in
                (*columns, "bits"))))
        seen: set[tuple[int, int]] = set()
        for (_, i, j), run_ in groupby(rows, key=lambda r: r[:3]):
            held = list(run_)
            if len(held) < 2:
                continue
            sid, n, pos, comp, mine_, raw = zip(*(r[3:] for r in held))
            a, b = list_pairs(np.array(n), np.array(pos), np.array(comp), threshold,
                              None if i == j else (np.array(mine_) == j).astype(int), None if raw[0] is None else list(raw))
            new = {(max(sid[x], sid[y]), min(sid[x], sid[y])) for x, y in zip(a.tolist(), b.tolist())} - seen
            if new:
                if len(seen) > 1_000_000:
                    seen.clear()
                seen |= new
                x, y = zip(*new)
                yield pa.record_batch([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    lists.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(common.BATCH_ROWS))
    return ordered.mapInArrow(common.in_task(run), "a long, b long").distinct()


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def join(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD, hashes: bool = False) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least id reachable by
    links, its own included); ``hashes`` adds the text's hash (h)."""
    spark = docs.sparkSession
    docs = common.text_column(docs)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(common.BATCH_ROWS))
    sketch = spark.sparkContext.broadcast(count_sketch(docs, shingle))

    def index(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = _sets(batch, shingle)
        prefix = [ordered_prefix(h, sketch.value, threshold).view(np.int64) if len(h) else None for h in held]
        return pa.record_batch([*(batch.column(c) for c in named_by), pa.array([set_key(h) if len(h) else None for h in held], pa.int64()),
                                pa.array([len(h) for h in held], pa.int32()), pa.array(prefix, pa.list_(pa.int64())),
                                pa.array([parity_bits(h) if len(h) else None for h in held], pa.binary())],
                               [*named_by, "sid", "n", "prefix", "bits"])

    named_by = ["doc_id", "h"] if hashes else ["doc_id"]
    rows = common.materialize(common.map_batches(
        docs.withColumn("h", _text_hash()) if hashes else docs, index,
        ", ".join(f"{c} long" for c in named_by) + ", sid long, n int, prefix array<long>, bits binary"), "sets")
    lists = _shared_lists(rows.filter("sid is not null"))
    sets = Sets(docs, rows, shingle, threshold)
    edge = [F.col("a").alias("u"), F.col("b").alias("v")]
    links = sets.linked(_leader_pairs(lists, threshold))
    groups = common.materialize(components(links.select(*edge)), "groups")
    links = links.unionByName(sets.linked(_list_pairs(lists, groups, sets.bits, threshold)))
    classes = common.materialize(components(links.select(*edge)), "classes")
    # Ids: the least of each set, then the least of each component.
    placed = sets.ids.join(classes, F.col("sid") == F.col("vertex"), "left").withColumn("component", F.coalesce("component", "sid"))
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.sum("copies").alias("members"))
    named = common.materialize(placed.join(least, "component").filter("members > 1").select("sid", "component_id"), "named")
    return (rows.select(*named_by, "sid", F.col("n").cast("long").alias("n_shingles")).join(_small(named), "sid", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), *named_by[1:]))


def representatives(docs: DataFrame, shingle: int = 5, threshold: int = 80) -> DataFrame:
    """The documents less all but the least id of every component; the near
    copies of a pipeline (words in a row and similarity as given).  What goes
    is named by id and text, so rows that share an id are judged by their own
    texts; rows without an id stay."""
    found = common.materialize(join(docs, shingle, threshold, hashes=True), "joined")
    gone = common.materialize(found.filter("doc_id <> component_id").select("doc_id", "h").distinct(), "near-copies")
    gone_id, gone_h = common.fresh(docs, "gone_id"), common.fresh(docs, "gone_h")
    gone = gone.select(F.col("doc_id").alias(gone_id), F.col("h").alias(gone_h))
    same = F.col("doc_id").eqNullSafe(F.col(gone_id)) & (_text_hash() == F.col(gone_h))
    return docs.join(_small(gone), same, "left_anti").select(*docs.columns)
