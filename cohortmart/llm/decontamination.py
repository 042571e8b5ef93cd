"""Benchmark decontamination over a positional inverted index (operator 7).

``build_index`` stores, for every word of the benchmark that occurs in a
training document, its postings (document row, position), sorted by term in
each file; one more posting a document, of the term ``END``, holds its number
of words.  A benchmark item is then looked up by its rarest terms:

* every window of ``WINDOW`` item words names its two rarest terms; their
  postings, each shifted by the term's place in the item, are intersected, so
  only (document, item, offset) with both terms in place remain;
* for these the postings of all the item's terms are intersected in the same
  way, and runs of ``WINDOW`` places in a row are the exact phrase matches.

``proximity_matches`` gives the items whose two rarest terms lie near each
other in a document, in any order.

DataFrame functions only.  The benchmark's vocabulary, windows and the
candidates are broadcast only below a counted number of rows; beyond it the
same joins are shuffled.

Cases: null texts have no words; an item of fewer than ``WINDOW`` words is one
window, one without words never matches; documents are told apart by row, so
repeated rows and ids each get their own result; repeated items count once by
id; extra columns are ignored; an empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WINDOW, HIT_SHARE = 13, 20
#: Rows of a table that may be broadcast (some hundred bytes each at most).
BROADCAST_ROWS = 200_000
END = -1

_SEPARATORS = [chr(c) for c in [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]]
_UPPER = [chr(c) for c in range(0x41, 0x5B)]


def words_of(text: Column) -> Column:
    """Lower-case A-Z, then the runs of digits, letters and non-ASCII characters."""
    plain = F.trim(F.translate(F.coalesce(text.cast("string"), F.lit("")), "".join(_SEPARATORS + _UPPER),
                               " " * len(_SEPARATORS) + "".join(_UPPER).lower()))
    return F.when(F.length(plain) == 0, F.array().cast("array<string>")).otherwise(F.split(plain, " +"))


def _small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if it is counted to be small; as it is otherwise."""
    return F.broadcast(df) if df.count() <= rows else df


def item_terms(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item, item_id, n, place, term) of every item word, and (word, term)."""
    items = (benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
             .filter(F.size("words") > 0).distinct().withColumn("item", F.xxhash64("item_id", "words")))
    placed = items.select("item", "item_id", F.size("words").alias("n"), F.posexplode("words").alias("place", "word"))
    # Terms are numbered by word; the vocabulary has as many rows as the benchmark has words.
    vocabulary = placed.select("word").distinct().withColumn("term", F.xxhash64("word"))
    return (common.materialize(placed.withColumn("term", F.xxhash64("word")).drop("word"), "benchmark-terms"),
            common.materialize(vocabulary, "benchmark-vocabulary"))


def build_index(docs: DataFrame, vocabulary: DataFrame, keep: list[Column] = ()) -> DataFrame:
    """The stored index: (row, doc_id, term, pos), ``END`` at the number of
    words, and what else to ``keep`` of the row."""
    terms = vocabulary.unionByName(docs.sparkSession.createDataFrame([(" ", END)], "word string, term long"))
    words = F.concat(words_of(F.col("text")), F.array(F.lit(" ")))  # a word that no text has: where the words end
    # The row's number is given before its words are dealt out.
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), words.alias("words"), *keep)
    postings = (rows.select(*(c for c in rows.columns if c != "words"), F.posexplode("words").alias("pos", "word"))
                .join(_small(terms), "word").drop("word"))
    return common.materialize(postings.sortWithinPartitions("term", "row", "pos"), "postings")


def rarest_terms(index: DataFrame, placed: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every window that can occur: (item, start, a, b) with the places of its
    two rarest terms (b is a in a window of one word)."""
    counts = index.filter(F.col("term") != END).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    words = placed.join(_small(counts), "term", "left").fillna(0, ["df"])
    # A window's words are the frame of its first word: a row holds ``window`` of them, however long the item.
    frame = Window.partitionBy("item").orderBy("place").rowsBetween(0, window - 1)
    ranked = (words.withColumn("ranked", F.sort_array(F.collect_list(F.struct("df", "place")).over(frame)))
              .filter(F.col("place") <= F.col("n") - F.least(F.lit(window), F.col("n"))))
    return (ranked.filter("ranked[0].df > 0")
            .select("item", F.col("place").alias("start"), F.expr("ranked[0].place").alias("a"),
                    F.expr("coalesce(get(ranked, 1).place, ranked[0].place)").alias("b")))


def candidates(index: DataFrame, placed: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row, item, shift): both rarest terms of some window stand in place.

    A pair of places of an item brings one row for each of the two, so a
    (row, item, shift, pair) with as many rows as the pair has places has both;
    nothing grows with the square of an item's length."""
    pairs = common.materialize(rarest_terms(index, placed, window).select("item", "a", "b").distinct(), "windows")
    anchors = (pairs.select("item", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("place"))
               .join(placed.select("item", "place", "term"), ["item", "place"]))
    anchors = common.materialize(anchors, "anchors")
    return (index.filter(F.col("term") != END).join(_small(anchors), "term")
            .select("row", "item", (F.col("pos") - F.col("place")).alias("shift"), "a", "b")
            .groupBy("row", "item", "shift", "a", "b").agg(F.count(F.lit(1)).alias("here"))
            .filter(F.col("here") == F.when(F.col("a") == F.col("b"), 1).otherwise(2))
            .select("row", "item", "shift").distinct())


def phrase_matches(index: DataFrame, placed: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row, item, shift, w, starts): the item's windows that occur in the
    document, by their first place; a place p stands at word shift + p."""
    found = common.materialize(candidates(index, placed, window), "candidates")
    rows = _small(found)
    # The shift says which place of the item a position must be, so each meets at most one.
    in_place = (index.filter(F.col("term") != END).join(rows, "row")
                .withColumn("place", F.col("pos") - F.col("shift")).filter("place >= 0")
                .join(_small(placed.select("item", "place", "n", "term")), ["item", "place", "term"])
                .groupBy("row", "item", "shift", "n").agg(F.sort_array(F.collect_list("place")).alias("places")))
    return (in_place.withColumn("w", F.least(F.lit(window), F.col("n")))
            .withColumn("starts", F.expr("filter(places, (x, i) -> get(places, i + w - 1) = x + w - 1)"))
            .filter(F.size("starts") > 0).select("row", "item", "shift", "w", "starts"))


def proximity_matches(index: DataFrame, placed: DataFrame, within: int = 50) -> DataFrame:
    """(row, item): the item's two rarest terms lie within ``within`` words of
    each other.  Positions meet by blocks of that width, never all with all."""
    counts = index.filter(F.col("term") != END).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    rank = Window.partitionBy("item").orderBy("df", "term")
    two = (placed.select("item", "term").distinct().join(_small(counts), "term")
           .withColumn("rank", F.row_number().over(rank)).filter("rank <= 2"))
    hits = index.join(_small(two), "term").withColumn("block", F.floor(F.col("pos") / within))
    a = hits.filter("rank = 1").select("row", "item", F.col("pos").alias("pa"),
                                       F.explode(F.expr("array(block - 1, block, block + 1)")).alias("block"))
    b = hits.filter("rank = 2").select("row", "item", F.col("pos").alias("pb"), "block")
    return a.join(b, ["row", "item", "block"]).filter(F.abs(F.col("pa") - F.col("pb")) <= within).select("row", "item").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[Column] = ()) -> DataFrame:
    """Per document row: row, doc_id, what to ``keep`` of it, n_words, n_hit,
    n_items, items_sha256, contaminated."""
    placed, vocabulary = item_terms(benchmark)
    index = build_index(docs, vocabulary, keep)
    matches = common.materialize(phrase_matches(index, placed, window), "matches")
    hit = (matches.select("row", F.explode("starts").alias("s"), "shift", "w")
           .select("row", F.explode(F.expr("sequence(shift + s, shift + s + w - 1)")).alias("pos")).distinct()
           .groupBy("row").agg(F.count(F.lit(1)).alias("n_hit")))
    ids = _small(placed.select("item", "item_id").distinct())
    items = (matches.join(ids, "item").groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    ends = index.filter(F.col("term") == END).withColumn("n_words", F.col("pos").cast("long")).drop("term", "pos")
    both = hit.join(items, "row")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    item_ids = F.coalesce("items", F.array().cast("array<string>"))
    return (ends.join(_small(both), "row", "left")
            .select(*ends.columns, n_hit.alias("n_hit"), F.size(item_ids).cast("long").alias("n_items"),
                    F.sha2(F.array_join(item_ids, ",").cast("binary"), 256).alias("items_sha256"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * HIT_SHARE >= F.col("n_words"))))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, their columns unchanged.  What
    goes is named by id and text, so rows that share an id, or have none, are
    judged by their own texts."""
    h = F.xxhash64("text")
    found = contamination(docs.select("doc_id", "text"), benchmark, window, keep=[h.alias("h")])
    gone = common.materialize(found.filter("contaminated").select("doc_id", "h").distinct(), "contaminated")
    gone_id, gone_h = common.fresh(docs, "gone_id"), common.fresh(docs, "gone_h")
    gone = gone.select(F.col("doc_id").alias(gone_id), F.col("h").alias(gone_h))
    return docs.join(_small(gone), F.col("doc_id").eqNullSafe(F.col(gone_id)) & (h == F.col(gone_h)), "left_anti")
