"""Document fingerprints by one-permutation MinHash (operator 8).

Each shingle of ``SHINGLE`` words is hashed once; its top bits name one of
``BINS`` bins and the least hash of a bin stands for it.  An empty bin takes
the value of another by optimal densification: every bin probes the bins in an
order of its own, given by a hash of both, and takes the first that is not
empty.  The ``BITS`` low-order bits of each bin are packed into a hexadecimal
string; the likeness of two fingerprints is the share of equal bins, corrected
for bins that are equal by chance.

DataFrame functions only.  The next document in id order comes from one
shuffle by id range: the ranges' bounds are approximate quantiles of the ids
(at most ``MAX_RANGES``), and the first document of a range is also dealt to
the range before it, so that no window ever spans the table.

Cases: a null text counts as empty; a text of fewer words is one shingle, an
empty one is the shingle of the empty word; equal ids are ordered by a hash of
their text, a null id comes first; of one document the next is itself; extra
columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

SHINGLE, BINS, BITS = 5, 128, 8
RANGE_DOCS, MAX_RANGES = 2048, 16_384
_SHIFT = 64 - (BINS.bit_length() - 1)
_MASK = (1 << BITS) - 1


def with_slots(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the low-order bits of each bin, as array<tinyint>."""
    n = f"{out}_"
    following = ", ".join(f"get({n}w, i + {k})" for k in range(1, SHINGLE))
    # Bins in the order of the signed hashes: bin = top bits + BINS / 2.
    bin_of = f"shiftright(x, {_SHIFT})"
    borrowed = (f"array_min(transform({n}m, x -> (xxhash64(b, {bin_of}) & {~_MASK}L) | (x & {_MASK}L)))")
    return (
        df.withColumn(f"{n}w", F.expr(rf"transform(split({text}, '[\\x20\\x09-\\x0D]+'), v -> xxhash64(v))"))
        .withColumn(f"{n}o", F.expr(
            f"sort_array(if(size({n}w) < {SHINGLE}, array(xxhash64({n}w)), "
            f"transform(slice({n}w, 1, greatest(size({n}w) - {SHINGLE - 1}, 0)), (x, i) -> xxhash64(x, {following}))))"))
        .withColumn(f"{n}m", F.expr(f"filter({n}o, (x, i) -> i = 0 or {bin_of} <> shiftright(get({n}o, i - 1), {_SHIFT}))"))
        .withColumn(f"{n}b", F.expr(f"transform({n}m, x -> {bin_of} + {BINS // 2})"))
        .withColumn(out, F.expr(
            f"if(size({n}m) = {BINS}, transform({n}m, x -> cast((x & {_MASK}L) - {1 << (BITS - 1)} as tinyint)), "
            f"transform(sequence(0L, {BINS - 1}L), b -> cast((coalesce(get({n}m, int(array_position({n}b, b) - 1)), {borrowed}) "
            f"& {_MASK}L) - {1 << (BITS - 1)} as tinyint)))"))
        .drop(f"{n}w", f"{n}o", f"{n}m", f"{n}b"))


def packed(slots: str) -> Column:
    """The bins' bits as one hexadecimal string."""
    digits = BITS // 4
    return F.expr(f"array_join(transform({slots}, x -> lpad(lower(hex(int(x) + {1 << (BITS - 1)})), {digits}, '0')), '')")


def likeness(a: str, b: str) -> Column:
    """Share of equal bins, less what chance makes equal, from 0 to 1."""
    same = f"aggregate(zip_with({a}, {b}, (x, y) -> int(x = y)), 0, (s, x) -> s + x) / {BINS}D"
    chance = 1 / (1 << BITS)
    return F.expr(f"greatest(0D, least(1D, ({same} - {chance}D) / {1 - chance}D))")


def with_next(docs: DataFrame, columns: list[str], key: Column) -> DataFrame:
    """Adds ``next_<column>`` of the document that follows in id order."""
    keys = docs.select(key.alias("k"))
    n = keys.count()
    ranges = max(1, min(MAX_RANGES, n // RANGE_DOCS))
    bounds = sorted(set(keys.approxQuantile("k", [i / ranges for i in range(1, ranges)], 0.1 / ranges))) if ranges > 1 else []
    steps = max(1, len(bounds)).bit_length()
    literal = F.array(*(F.lit(int(b)) for b in bounds)) if bounds else F.array(F.lit(0).cast("long"))
    # Binary search: how many bounds lie below the key.
    search = F.aggregate(F.array(*(F.lit(1 << s) for s in reversed(range(steps)))), F.lit(0), lambda at, step: F.when(
        (at + step <= len(bounds)) & (F.get(literal, at + step - 1) < F.col("k")), at + step).otherwise(at))
    firsts = sorted((r["range"], r.k) for r in keys.withColumn("range", search).groupBy("range").agg(F.min("k").alias("k")).collect())
    before = {k: firsts[i - 1][0] for i, (_, k) in enumerate(firsts)}  # the first of all follows the last range
    ghosts = docs.sparkSession.createDataFrame(list(before.items()), "k long, ghost int")
    dealt = (docs.withColumn("k", key).withColumn("home", search).join(F.broadcast(ghosts), "k", "left")
             .withColumn("place", F.explode(F.expr(
                 "filter(array(struct(home as range, 0 as late), if(ghost is null, null, "
                 "struct(ghost as range, 1 as late))), x -> x is not null)")))
             .select(*docs.columns, "k", "place.range", "place.late"))
    order = Window.partitionBy("range").orderBy("late", "k", *([F.xxhash64("text")] if "text" in docs.columns else []))
    return (dealt.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns))
            .filter("late = 0").drop("range", "late", "k"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Per row: its fingerprint, that of its text with the last quarter taken
    from the next document, and both likenesses."""
    own = with_slots(common.text_column(docs), "text", "slots").withColumn("n_chars", F.length("text").cast("long"))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long"))
    both = with_next(own, ["text", "slots"], key)
    edited = both.withColumn("cut", F.expr("int(n_chars div 4)")).withColumn(
        "edited", F.expr("concat(substring(text, 1, int(n_chars) - cut), substring(next_text, 1, cut))"))
    edited = with_slots(edited, "edited", "edited_slots")
    return edited.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        packed("slots").alias("fingerprint"), packed("edited_slots").alias("edited_fingerprint"),
        likeness("slots", "edited_slots").alias("near_edited"), likeness("slots", "next_slots").alias("near_next"))
