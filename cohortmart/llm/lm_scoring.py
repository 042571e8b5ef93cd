"""Language-model scores by masked pseudo-likelihood (operator 3).

A small bidirectional window network in numpy predicts every word of a
document from the two words on either side of it, the word itself masked; the
sum of the conditional log-probabilities is the document's score.

The ``WORDS`` most frequent words of the corpus are classes of their own, others
fall into hashed classes.  A class's code is two digits, each a softmax:
``p(high | context) p(low | context, high)``.  A word of a hashed class then
counts by its share of the class, ``p(word | class)``, from the counts of the
whole vocabulary: a written table that each document's distinct words are
joined to.  One more place in each class stands for words never seen.

Training covers the whole corpus.  Each document belongs to one of ``ROUNDS``
rounds by hash.  In a round every partition trains its own copy of the network
on all words of its share, and the copies are averaged by number of words;
the next round starts from the average.  So what is gathered grows with the
partitions, and the driver holds one network (fixed size).

Cases: a null or empty text has no words and score 0; repeated rows are
scored row by row and count in training as often as they stand; extra columns
are ignored; a corpus without words leaves the network untrained.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .shingles import document_words

DIGITS = 32
CLASSES = DIGITS * DIGITS
UNKNOWN = 32
WORDS = CLASSES - UNKNOWN
SIDE, HIDDEN = 2, 16
_PAD = CLASSES
#: Places of the context words from the masked one.
_PLACES = [j for j in range(-SIDE, SIDE + 1) if j]
ROUNDS, RATE, BATCH = 3, 4e-3, 2048
_CHUNKS = 16
#: Positions scored at a time.
_BLOCK = 1 << 15
#: Parts of a nat in which the shares of words in their classes are summed.
_UNIT = 10**9


class Net(NamedTuple):
    context: np.ndarray    # place x (class or padding) x HIDDEN
    bias: np.ndarray
    high: np.ndarray       # HIDDEN x DIGITS
    high_bias: np.ndarray
    gate: np.ndarray       # DIGITS x HIDDEN: the high digit's view of the context
    low: np.ndarray        # HIDDEN x DIGITS
    low_bias: np.ndarray   # DIGITS x DIGITS

    @staticmethod
    def new(seed: int = 11) -> "Net":
        r = np.random.default_rng(seed)
        f = lambda scale, *s: (r.standard_normal(s) * scale).astype(np.float32)
        return Net(f(0.3, len(_PLACES), CLASSES + 1, HIDDEN), np.zeros(HIDDEN, np.float32), f(0.25, HIDDEN, DIGITS), np.zeros(DIGITS, np.float32),
                   np.ones((DIGITS, HIDDEN), np.float32), f(0.25, HIDDEN, DIGITS), np.zeros((DIGITS, DIGITS), np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self])

    def filled(self, flat: np.ndarray) -> "Net":
        ends = np.cumsum([x.size for x in self])
        return Net(*(flat[e - x.size:e].reshape(x.shape).astype(np.float32) for x, e in zip(self, ends)))


def vocabulary_table(docs: DataFrame) -> DataFrame:
    """Every word's hash and count (word, n), as a written table."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        held = document_words(batch.column("text"))
        words, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        return pa.record_batch([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

    return common.materialize(common.map_batches(docs, count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")


def _most_frequent(counts: DataFrame, top: int) -> list:
    return counts.orderBy(F.desc("n"), "word").limit(top).collect()


def _hashes(rows: list) -> np.ndarray:
    return np.array([r.word for r in rows], np.int64).view(np.uint64)


def word_counts(docs: DataFrame, top: int = WORDS) -> np.ndarray:
    """Hashes of the most frequent words, most frequent first."""
    return _hashes(_most_frequent(vocabulary_table(docs), top))


class Codes:
    """Word hash -> class: the rank of a frequent word, a hashed class of others."""

    def __init__(self, frequent: np.ndarray) -> None:
        order = np.argsort(frequent)
        self.words, self.rank = frequent[order], order

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        other = WORDS + (hashes % np.uint64(UNKNOWN)).astype(np.int64)
        if not len(self.words):
            return other
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.rank[at], other)


class Vocabulary(NamedTuple):
    codes: Codes
    counts: DataFrame      # word, n: all words of the corpus
    places: list[int]      # of each hashed class: its running words, its distinct words and one


def vocabulary(docs: DataFrame, top: int = WORDS) -> Vocabulary:
    """The words' codes and counts, from every document."""
    counts = vocabulary_table(docs)
    frequent = _most_frequent(counts, top)
    places = [1] * UNKNOWN
    for r in counts.groupBy(_hashed_class("word").alias("c")).agg(F.sum(F.col("n") + 1).alias("n")).collect():
        places[r.c] += r.n
    for r in frequent:
        places[r.word % UNKNOWN] -= r.n + 1
    return Vocabulary(Codes(_hashes(frequent)), counts, places)


def _hashed_class(word: str) -> Column:
    """``Codes``'s hashed class (UNKNOWN is a power of two) of a signed hash."""
    return F.col(word).bitwiseAND(F.lit(UNKNOWN - 1)).cast("int")


def sequence(documents: list[np.ndarray], codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """All documents' codes one after the other with padding around each, and
    where each begins."""
    size = np.array([len(d) for d in documents], np.int64)
    starts = np.cumsum(size + SIDE) - size
    seq = np.full(int((size + SIDE).sum()) + SIDE, _PAD, np.int64)
    if size.sum():
        at = np.arange(int(size.sum())) + np.repeat(starts - (np.cumsum(size) - size), size)
        seq[at] = codes(np.concatenate(documents))
    return seq, starts


_ONES = np.ones((DIGITS, 1), np.float32)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    """Of each row; logits are held where exp() is finite."""
    x = np.clip(x, -60, 60)
    return x - np.log(np.exp(x) @ _ONES.astype(x.dtype))


def _forward(net: Net, seq: np.ndarray, a: int, b: int):
    """Log-probabilities of the two digits at the positions a..b-1 (both sides
    of which are in ``seq``)."""
    h = np.broadcast_to(net.bias, (b - a, HIDDEN)).copy()
    for table, j in zip(net.context, _PLACES):
        h += table.take(seq[a + j:b + j], 0)
    h = np.tanh(h)
    target = np.minimum(seq[a:b], CLASSES - 1)
    hi, lo = target // DIGITS, target % DIGITS
    seen = h * net.gate[hi]
    return h, seen, hi, lo, _log_softmax(h @ net.high + net.high_bias), _log_softmax(seen @ net.low + net.low_bias[hi])


def log_probabilities(net: Net, seq: np.ndarray) -> np.ndarray:
    """log p(word | its neighbours) at every position; 0 on padding."""
    out = np.zeros(len(seq))
    for a in range(SIDE, len(seq) - SIDE, _BLOCK):
        b = min(a + _BLOCK, len(seq) - SIDE)
        _, _, hi, lo, high, low = _forward(net, seq, a, b)
        rows = np.arange(b - a)
        out[a:b] = high[rows, hi] + low[rows, lo]
    out[seq == _PAD] = 0
    return out


def _sums_by(keys: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
    """Rows of ``values`` summed by key."""
    out = np.zeros((n, values.shape[1]), np.float32)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        k = keys[order]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        out[k[first]] = np.add.reduceat(values[order], first)
    return out


def gradients(net: Net, seq: np.ndarray, a: int, b: int) -> list[np.ndarray]:
    """Of the mean negative log-probability at a..b-1, padding left out."""
    h, seen, hi, lo, high, low = _forward(net, seq, a, b)
    rows, real = np.arange(b - a), (seq[a:b] != _PAD)
    share = (real / max(1, real.sum())).astype(np.float32)[:, None]
    dhigh, dlow = np.exp(high), np.exp(low)
    dhigh[rows, hi] -= 1
    dlow[rows, lo] -= 1
    dhigh *= share
    dlow *= share
    dseen = dlow @ net.low.T
    dh = (dhigh @ net.high.T + dseen * net.gate[hi]) * (1 - h * h)
    # One sort of the codes serves all places: a context word's row gets the rows of dh that look at it.
    wide = np.zeros((b - a + 4 * SIDE, HIDDEN), np.float32)
    wide[2 * SIDE:2 * SIDE + b - a] = dh
    around = seq[a - SIDE:b + SIDE]
    order = np.argsort(around, kind="stable")
    k = around[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    dcontext = np.zeros_like(net.context)
    for i, j in enumerate(_PLACES):  # around[s] is the word at place j of position s - SIDE - j
        dcontext[i][k[first]] = np.add.reduceat(wide[order + SIDE - j], first)
    return [dcontext, dh.sum(0), h.T @ dhigh, dhigh.sum(0), _sums_by(hi, DIGITS, dseen * h), seen.T @ dlow, _sums_by(hi, DIGITS, dlow)]


class Trainer:
    """Adam over blocks of ``BATCH`` positions."""

    def __init__(self, net: Net, rate: float) -> None:
        self.net, self.rate, self.steps, self.words = net, rate, 0, 0
        self.m, self.v = [np.zeros_like(x) for x in net], [np.zeros_like(x) for x in net]

    def learn(self, seq: np.ndarray) -> None:
        for a in range(SIDE, len(seq) - SIDE, BATCH):
            b = min(a + BATCH, len(seq) - SIDE)
            grads = gradients(self.net, seq, a, b)
            self.steps += 1
            self.words += int((seq[a:b] != _PAD).sum())
            c1, c2, new = 1 - 0.9 ** self.steps, 1 - 0.99 ** self.steps, []
            for x, g, m, v in zip(self.net, grads, self.m, self.v):
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                new.append(x - (self.rate / c1) * m / (np.sqrt(v / c2) + 1e-8))
            self.net = Net(*(x.astype(np.float32) for x in new))


def _round(docs: DataFrame, net: Net, codes: Codes, rate: float) -> Net:
    """One round: every partition's own copy, averaged by number of words."""
    sent = docs.sparkSession.sparkContext.broadcast((net, codes))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        start, codes_ = sent.value
        trainer = Trainer(start, rate)
        for batch in batches:
            trainer.learn(sequence(document_words(batch.column("text")), codes_)[0])
        if trainer.words:
            parts = np.array_split(trainer.net.flat(), _CHUNKS)
            yield pa.record_batch([pa.array(range(_CHUNKS), pa.int32()), pa.array([TaskContext.get().partitionId()] * _CHUNKS, pa.int32()),
                                   pa.array([trainer.words] * _CHUNKS, pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())],
                                  ["chunk", "part", "words", "weights"])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for c, words, raw in zip(*(batch.column(x).to_pylist() for x in ("chunk", "words", "weights"))):
                held = sums.setdefault(c, [0, 0.0])
                held[0] += words
                held[1] = held[1] + words * np.frombuffer(raw, np.float32).astype(np.float64)
        if sums:
            yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([(s / n).astype(np.float32).tobytes() for n, s in sums.values()], pa.binary())],
                                  ["chunk", "weights"])

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(common.BATCH_ROWS))
    copies = docs.mapInArrow(common.in_task(train), "chunk int, part int, words long, weights binary")
    rows = (copies.repartition(_CHUNKS, "chunk").sortWithinPartitions("chunk", "part")  # the same sums in every run
            .mapInArrow(common.in_task(average), "chunk int, weights binary").collect())
    if not rows:
        return net
    return net.filled(np.concatenate([np.frombuffer(r.weights, np.float32) for r in sorted(rows)]))


def train(docs: DataFrame, rounds: int = ROUNDS, rate: float = RATE) -> tuple[Net, Vocabulary]:
    """The network and the vocabulary, from every document."""
    docs = common.text_column(docs)
    words, net = vocabulary(docs), Net.new()
    turn = F.pmod(F.xxhash64("doc_id", F.lit(rounds)), F.lit(rounds))
    for r in range(rounds):
        net = _round(docs.filter(turn == r), net, words.codes, rate / (1 + r))
    return net, words


def _rare_words(held: list[np.ndarray], codes: Codes) -> pa.Array:
    """Each document's distinct words of hashed classes, and how often they stand in it."""
    found = [np.unique(d[codes(d) >= WORDS], return_counts=True) for d in held]
    ends = np.cumsum([0, *(len(w) for w, _ in found)], dtype=np.int32)
    word = np.concatenate([np.zeros(0, np.uint64), *(w for w, _ in found)]).view(np.int64)
    times = np.concatenate([np.zeros(0, np.int32), *(t for _, t in found)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(word), pa.array(times)], ["word", "times"]))


def score(docs: DataFrame, net: Net, words: Vocabulary) -> DataFrame:
    """Per row: doc_id, n_words, log_likelihood (the sum), mean_log_likelihood."""
    sent = docs.sparkSession.sparkContext.broadcast((net, words.codes))

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        net_, codes_ = sent.value
        held = document_words(batch.column("text"))
        seq, starts = sequence(held, codes_)
        total = np.concatenate([[0.0], np.cumsum(log_probabilities(net_, seq))])
        size = np.array([len(d) for d in held], np.int64)
        both = total[starts + size] - total[starts]
        both[size == 0] = 0
        return pa.record_batch([batch.column("row"), batch.column("doc_id"), pa.array(size), pa.array(both), _rare_words(held, codes_)],
                               ["row", "doc_id", "n_words", "by_class", "rare"])

    scored = common.materialize(common.map_batches(
        common.text_column(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), fn,
        "row long, doc_id long, n_words long, by_class double, rare array<struct<word: long, times: int>>"), "classes-scored")
    # Summed in whole billionths, so the order of the words doesn't matter.
    places = F.element_at(F.array(*(F.lit(n).cast("double") for n in words.places)), _hashed_class("word") + 1)
    share = F.round(F.log((F.coalesce("n", F.lit(0)) + 1) / places) * _UNIT).cast("long")
    shares = (scored.select("row", F.inline("rare")).join(words.counts.hint("shuffle_hash"), "word", "left")
              .groupBy("row").agg(F.sum(F.col("times") * share).alias("shares")))
    total = F.col("by_class") + F.coalesce("shares", F.lit(0)) / _UNIT
    return (scored.drop("rare").join(shares, "row", "left").withColumn("log_likelihood", total)
            .select("doc_id", "n_words", "log_likelihood",
                    (F.col("log_likelihood") / F.greatest("n_words", F.lit(1))).alias("mean_log_likelihood")))
