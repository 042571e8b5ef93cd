"""Spelling variant grouping by blocked Gram matrices (operator 13).

A word is a vector of letter counts.  Words that differ by one replaced letter
have the same length and a squared distance of two, by one inserted or deleted
letter adjacent lengths and a distance of one; so the distances of two blocks of
words, one product of their matrices, leave few pairs to be compared letter by
letter.

Blocks of one length would grow with the square of the vocabulary.  They are
cut further by letter classes: letters are dealt over ``classes`` classes, and
a word of length L names a block for each class that it has a letter of: its
class counts less that letter, ``(L - 1)`` letters in all; a word of length
L - 1 names the block of its own counts.  Two near words meet in a block, and
just one of those in which they meet is the one that lacks the very letter by
which they differ; there the pair counts.  The number of classes follows the
number of words.  A block of more than ``TILE`` words is dealt over parts, and
every pair of parts is a block of its own.

``word_counts`` sums a task's words before they are shuffled; ``variants`` adds
up each word's near words over its blocks, and ``roots`` follows forms by
pointer doubling, in as many joins as the logarithm of the longest chain.

Cases: a null or empty text has no words; a null id counts as an empty one;
rows of one id and text are counted each; words of any length are compared;
extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

MIN_LENGTH, MIN_COUNT, FORM_SHARE = 5, 3, 2
#: Every so many-th (document, run) loses a letter.
ERRORS = 97
#: Words of a block that are compared at once; distinct words that a task sums up before it passes them on.
TILE, HELD_WORDS = 2048, 200_000
#: Rows of a table that may be broadcast (16 bytes each).
BROADCAST_ROWS = 1_000_000
#: Candidate pairs whose letters are compared at a time.
_PAIRS = 1 << 15

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Runs of A-Z, a-z and U+00C0 to U+00FF, in UTF-8 and lower case.
_RUNS = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def _misspelt(run: bytes, h: int) -> bytes:
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n), written: the words of at least ``min_length`` letters that
    occur ``min_count`` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def emitted() -> pa.RecordBatch:
            words = pa.array(list(total), pa.binary()).cast(pa.string())
            return pa.record_batch([words, pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(_RUNS.findall(text.translate(_LOWER))).items():
                    if len(word) < min_length:  # bytes are no fewer than letters
                        continue
                    h = zlib.crc32(word, start)
                    if not h % ERRORS:
                        word = _misspelt(word, h)
                    total[word] += n
                if len(total) >= HELD_WORDS:
                    yield emitted()
                    total.clear()
        if total:
            yield emitted()

    found = common.map_partitions(common.text_column(docs), run, "word string, n long")
    return common.materialize(found.groupBy("word").agg(F.sum("n").alias("n"))
                              .filter((F.length("word") >= min_length) & (F.col("n") >= min_count)), "words")


def classes_for(words: int) -> int:
    """Letter classes for a vocabulary of so many words; any number gives the same pairs."""
    return min(24, max(2, (words.bit_length() - 9) // 2))


def class_of_letter(classes: int) -> np.ndarray:
    """The class of each of the 256 code points: neighbours in the alphabet go apart."""
    return np.arange(256) % classes


def _letters(words: pa.Array) -> list[np.ndarray]:
    """Code points of each word; all lie below 256."""
    return [np.frombuffer(w.encode("latin-1"), np.uint8) for w in words.to_pylist()]


def _block_rows(words: DataFrame, classes: int) -> DataFrame:
    """(block, less, word, n): a word's row in each of its blocks; ``less`` is the
    class of the letter that the block lacks, -1 in the block of the word's own counts."""
    of, weight = class_of_letter(classes), np.random.default_rng(13).integers(1, 1 << 62, classes, np.int64)

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        letters = _letters(batch.column("word"))
        row = np.repeat(np.arange(len(letters)), [len(x) for x in letters])
        flat = np.concatenate(letters) if letters else np.zeros(0, np.uint8)
        counts = np.bincount(row * classes + of[flat], minlength=len(letters) * classes).reshape(-1, classes)
        own = (counts * weight).sum(1)  # a sum modulo 2^64 names the counts; blocks that share a name harm nothing
        at, less = np.nonzero(counts)
        at, less = np.concatenate([np.arange(len(letters)), at]), np.concatenate([np.full(len(letters), -1), less])
        block = own[at] - np.where(less >= 0, weight[less], 0)
        take = pa.array(at)
        return pa.record_batch([pa.array(block), pa.array(less.astype(np.int32)), batch.column("word").take(take), batch.column("n").take(take)],
                               ["block", "less", "word", "n"])

    return common.map_batches(words.select("word", "n"), fn, "block long, less int, word string, n long", rows=10_000)


def _parts(rows: DataFrame, tile: int) -> DataFrame:
    """Blocks of more than ``tile`` words as pairs of parts (i <= j); ``mine`` is
    the word's own part, by its hash, the same for all its rows."""
    large = common.materialize(rows.groupBy("block").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > tile)
                               .select("block", F.ceil(F.col("size") / tile).cast("int").alias("parts")), "large-blocks")
    if large.count() <= BROADCAST_ROWS:
        large = F.broadcast(large)
    parts = F.coalesce("parts", F.lit(1))
    dealt = rows.join(large, "block", "left").withColumn("mine", F.pmod(F.xxhash64("word"), parts).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.select("block", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "less", "word", "n")


def gram_pairs(x: np.ndarray, y: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two count matrices whose squared distance is 1 to ``most``, by one product."""
    exact = np.float32 if max(x.sum(1).max(initial=0), y.sum(1).max(initial=0)) < 2000 else np.float64  # whole numbers stay whole
    x, y = x.astype(exact), y.astype(exact)
    distance = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    return np.nonzero((distance > 0.5) & (distance < most + 0.5))


def _one_replaced(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows of letters of one length: whether just one differs, and the two letters."""
    differs = x != y
    at, row = differs.argmax(1), np.arange(len(x))
    return differs.sum(1) == 1, x[row, at], y[row, at]


def _one_inserted(long: np.ndarray, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a row of ``long`` less one letter is the row of ``short``, and that letter."""
    first = np.minimum.accumulate(long[:, :-1] == short, axis=1).sum(1)
    last = np.minimum.accumulate((long[:, 1:] == short)[:, ::-1], axis=1).sum(1)
    return first + last >= short.shape[1], long[np.arange(len(long)), first]


def _compare(words: list[np.ndarray], less: np.ndarray, left: np.ndarray, right: np.ndarray, of: np.ndarray,
             whole: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """Near pairs of rows of a block, one of ``left`` (words less a letter), one
    of ``right`` (the like, or shorter words as they are), length by length;
    ``whole``: the two lists hold the same rows, so a replaced letter's pair is
    taken from one side only."""
    out = []
    size = np.array([len(w) for w in words])
    for n in np.unique(size[left]).tolist():
        ix = left[size[left] == n]
        mx = np.stack([words[i] for i in ix])
        for m, iy in ((n, right[(size[right] == n) & (less[right] >= 0)]), (n - 1, right[(size[right] == n - 1) & (less[right] < 0)])):
            if not len(iy):
                continue
            my = np.stack([words[i] for i in iy])
            letters = np.union1d(mx, my)
            place = np.zeros(256, np.int64)
            place[letters] = np.arange(len(letters))
            a, b = gram_pairs(_counts(place[mx], len(letters)), _counts(place[my], len(letters)), 2 if m == n else 1)
            if whole and m == n:
                once = ix[a] < iy[b]
                a, b = a[once], b[once]
            step = max(1, _PAIRS * 16 // max(n, 16))
            for k in range(0, len(a), step):
                ak, bk = a[k:k + step], b[k:k + step]
                if m == n:
                    near, lost_x, lost_y = _one_replaced(mx[ak], my[bk])
                    near &= (of[lost_x] == less[ix[ak]]) & (of[lost_y] == less[iy[bk]])
                else:
                    near, lost = _one_inserted(mx[ak], my[bk])
                    near &= of[lost] == less[ix[ak]]
                out.append((ix[ak[near]], iy[bk[near]]))
    return out


def _counts(places: np.ndarray, letters: int) -> np.ndarray:
    row = np.repeat(np.arange(len(places)), places.shape[1])
    return np.bincount(row * letters + places.ravel(), minlength=len(places) * letters).reshape(-1, letters)


def near_words(words: DataFrame, classes: int | None = None, tile: int = TILE) -> DataFrame:
    """(word, near, best): for each word and block how many near words it has
    there, and the best of them as (-n, word), the least struct."""
    classes = classes or classes_for(words.count())
    dealt = _parts(common.materialize(_block_rows(words, classes), "block-rows"), tile)
    keys = ["block", "i", "j"]
    ordered = dealt.repartition(*keys).sortWithinPartitions(*keys)
    of = class_of_letter(classes)

    def fn(rows: pa.Table) -> pa.RecordBatch | None:
        word, n, less = rows.column("word").to_pylist(), rows.column("n").to_numpy(), rows.column("less").to_numpy()
        mine = rows.column("mine").to_numpy()
        letters = [np.frombuffer(w.encode("latin-1"), np.uint8) for w in word]
        i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        long, short = less >= 0, less < 0
        if i == j:
            every = np.arange(len(word))
            pairs = _compare(letters, less, every[long], every, of, True)
        else:  # a pair of words is one of either part; replaced letters are found from one side
            pairs = (_compare(letters, less, np.flatnonzero(long & (mine == i)), np.flatnonzero(mine == j), of, False)
                     + _compare(letters, less, np.flatnonzero(long & (mine == j)), np.flatnonzero(short & (mine == i)), of, False))
        if not pairs:
            return None
        a, b = (np.concatenate(x) for x in zip(*pairs))
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
        if not len(a):
            return None
        rank = np.zeros(len(word), np.int64)
        rank[sorted(range(len(word)), key=word.__getitem__)] = np.arange(len(word))
        order = np.lexsort((rank[b], -n[b], a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.diff(a, prepend=-1))
        best = pa.StructArray.from_arrays([pa.array(-n[b[first]]), pa.array([word[k] for k in b[first]], pa.string())], ["less", "word"])
        return pa.record_batch([pa.array([word[k] for k in a[first]], pa.string()), pa.array(np.diff(first, append=len(a)), pa.int64()), best],
                               ["word", "near", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in keys])
            cuts = np.flatnonzero((np.diff(key) != 0).any(0)) + 1
            bounds = [0, *cuts.tolist(), batch.num_rows]
            for s, e in zip(bounds, bounds[1:]):
                if e == s:
                    continue
                now = tuple(key[:, s].tolist())
                if held and now != last:
                    if (out := fn(pa.Table.from_batches(held))) is not None:
                        yield out
                    held = []
                held.append(batch.slice(s, e - s))
                last = now
        if held and (out := fn(pa.Table.from_batches(held))) is not None:
            yield out

    return common.map_partitions(ordered, run, "word string, near long, best struct<less:long,word:string>", rows=10_000)


def variants(words: DataFrame, classes: int | None = None, tile: int = TILE) -> DataFrame:
    """(word, n, n_near, form, form_n), written: a word's form is its near word of
    the largest n (the smallest of ties), if that is ``FORM_SHARE`` times its own."""
    near = near_words(words, classes, tile).groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    n = -F.col("best.less")
    has = F.col("best").isNotNull() & (n >= FORM_SHARE * F.col("n"))
    found = (words.join(near, "word", "left")
             .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                     F.when(has, F.col("best.word")).alias("form"), F.when(has, n).alias("form_n")))
    return common.materialize(found, "variants")


def roots(found: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form.  A form occurs at least twice
    as often as its word, so a chain is no longer than the largest n has bits."""
    hops = common.materialize(found.filter("form is not null").select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = hops.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        hops = common.materialize(hops.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"),
                                                                          F.col("ahead").isNotNull().alias("moved")), "forms")
        moved = not hops.filter("moved").isEmpty()
        hops = hops.select("word", "root")
        if not moved:
            return hops


def group(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the documents."""
    found = variants(word_counts(docs, min_length, min_count))
    ends: Column = F.coalesce("root", "word")
    return found.join(roots(found), "word", "left").select("word", "form", ends.alias("root"), "n", "n_near", "form_n")
