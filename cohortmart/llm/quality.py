"""Quality by a byte-level convolutional network in numpy (operator 9).

Bytes are embedded, ``FILTERS`` learned filters of 8 bytes slide over the
whole text with a step of 4, and each filter's strongest answer is kept for
every chunk of 512 bytes; chunks overlap by half.  The chunk vectors' mean and
maximum over the document go through one hidden layer into a probability.

The network is fitted in the driver on a bounded sample of labelled documents
(``TRAIN_DOCS`` by class, ``TRAIN_BYTES`` of text in all, chosen by hash; rows
whose crc32 of the id is divisible by ``FOLDS`` never take part) and weighted
back to the classes' true shares.  Every document is scored whole in Arrow
batches; a batch is worked on in slices, so long texts need little memory.

Cases: a null or empty text is one chunk of padding and gets that chunk's
score; repeated rows are scored row by row; labels without a document or with null
are left out, a labelled null text is learnt as an empty one, of repeated labels of an id the greatest counts; with labels of
one class only (or none) every score is that class (or 0.5); extra columns are
ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

FOLDS, THRESHOLD = 5, 0.3
TRAIN_DOCS, TRAIN_BYTES, STEPS, BATCH_DOCS = 2000, 64 << 20, 1000, 32

DIM, FILTERS, HIDDEN, STEP = 8, 32, 16, 4
SEGMENT = 256  # half a chunk
_WINDOWS = SEGMENT // STEP
_PAD = 255  # never a byte of UTF-8
_SLICE = 1 << 18


class Net(NamedTuple):
    embed: np.ndarray   # 256 x DIM
    conv: np.ndarray    # 2 STEP DIM x FILTERS
    bias: np.ndarray
    hidden: np.ndarray  # 2 FILTERS x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray     # HIDDEN
    out_bias: np.ndarray

    @staticmethod
    def new(seed: int = 7) -> "Net":
        r = np.random.default_rng(seed)
        f = lambda *s: (r.standard_normal(s) * (2 / s[0]) ** 0.5).astype(np.float32)
        return Net(r.standard_normal((256, DIM)).astype(np.float32), f(2 * STEP * DIM, FILTERS), np.zeros(FILTERS, np.float32),
                   f(2 * FILTERS, HIDDEN), np.zeros(HIDDEN, np.float32), f(HIDDEN), np.zeros(1, np.float32))


def _layout(texts: list[bytes | memoryview | np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All texts one after the other, each padded to whole segments (with one
    byte of padding at least), and the number of segments of each."""
    segments = np.array([len(t) // SEGMENT + 1 for t in texts], np.int64)
    data = np.full(int(segments.sum()) * SEGMENT + STEP, _PAD, np.uint8)
    at = 0
    for t, n in zip(texts, segments.tolist()):
        data[at:at + len(t)] = np.frombuffer(t, np.uint8) if not isinstance(t, np.ndarray) else t
        at += n * SEGMENT
    return data, segments


def _segment_maxima(net: Net, data: np.ndarray, segments: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Each segment's strongest answer of every filter, and with ``where``
    which window gave it."""
    n = int(segments.sum())
    best, at = np.zeros((n, FILTERS), np.float32), np.zeros((n, FILTERS) if where else (0, 0), np.int64)
    last = np.zeros(n, bool)
    last[np.cumsum(segments) - 1] = True  # a text's last window would reach into the next text
    half = STEP * DIM
    for a in range(0, n, _SLICE // SEGMENT):
        b = min(n, a + _SLICE // SEGMENT)
        x = net.embed[data[a * SEGMENT:b * SEGMENT + STEP]].reshape(-1, half)
        y = x[:-1] @ net.conv[:half]
        y += x[1:] @ net.conv[half:]
        y += net.bias
        y = y.reshape(b - a, _WINDOWS, FILTERS)
        y[last[a:b], -1] = -1
        if where:
            at[a:b] = y.argmax(1)
        np.maximum(y.max(1), 0, out=best[a:b])
    return best, at


def _pool(best: np.ndarray, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chunk vectors (a chunk is two neighbouring segments, or the only one),
    the number of chunks of each text, and each chunk's first and second segment."""
    ends = np.cumsum(segments)
    alone = segments == 1
    keep = np.ones(len(best), bool)
    keep[ends[~alone] - 1] = False
    first = np.flatnonzero(keep)
    second = np.minimum(first + 1, len(best) - 1)
    single = np.zeros(len(best), bool)
    single[ends[alone] - 1] = True
    second[single[first]] = first[single[first]]
    return np.maximum(best[first], best[second]), np.where(alone, 1, segments - 1), first, second


def _head(net: Net, mean: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.concatenate([mean, top], 1)
    h = np.maximum(x @ net.hidden + net.hidden_bias, 0)
    return x, h, 1 / (1 + np.exp(-np.clip(h @ net.out + net.out_bias, -30, 30)))


def score_texts(net: Net, texts: list) -> np.ndarray:
    """Probabilities of label 1 of whole texts (their UTF-8 bytes)."""
    if not texts:
        return np.zeros(0)
    data, segments = _layout(texts)
    best, _ = _segment_maxima(net, data, segments)
    chunks, count, *_ = _pool(best, segments)
    starts = np.cumsum(count) - count
    mean = np.add.reduceat(chunks, starts) / count[:, None]
    return _head(net, mean, np.maximum.reduceat(chunks, starts))[2]


def _gradients(net: Net, texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    data, segments = _layout(texts)
    best, at = _segment_maxima(net, data, segments, where=True)
    chunks, count, first, second = _pool(best, segments)
    starts = np.cumsum(count) - count
    mean, top = np.add.reduceat(chunks, starts) / count[:, None], np.maximum.reduceat(chunks, starts)
    x, h, p = _head(net, mean, top)
    dz = ((p - labels) * weights / len(labels)).astype(np.float32)
    dh = dz[:, None] * net.out * (h > 0)
    dx = dh @ net.hidden.T
    doc = np.repeat(np.arange(len(texts)), count)
    dchunk = (dx[:, :FILTERS] / count[:, None])[doc]
    for d, (a, n) in enumerate(zip(starts, count)):  # the maximum over chunks goes to the chunk that gave it
        dchunk[a + chunks[a:a + n].argmax(0), np.arange(FILTERS)] += dx[d, FILTERS:]
    from_first = best[first] >= chunks
    dbest = np.zeros_like(best)
    np.add.at(dbest, first, dchunk * from_first)
    np.add.at(dbest, second, dchunk * ~from_first)
    dbest *= best > 0
    seg, filt = np.nonzero(dbest)
    g = dbest[seg, filt]
    window = (seg * _WINDOWS + at[seg, filt])[:, None] * STEP + np.arange(2 * STEP)
    symbols = data[window]
    e = net.embed[symbols].reshape(len(seg), -1)
    dconv = np.zeros_like(net.conv)
    for k in range(FILTERS):
        m = filt == k
        dconv[:, k] = g[m] @ e[m]
    de = (g[:, None] * net.conv.T[filt]).reshape(-1, DIM)
    flat = symbols.reshape(-1)
    dembed = np.stack([np.bincount(flat, de[:, j], 256) for j in range(DIM)], 1).astype(np.float32)
    return [dembed, dconv, np.bincount(filt, g, FILTERS).astype(np.float32), x.T @ dh, dh.sum(0), h.T @ dz, dz.sum(keepdims=True)]


def train(texts: list[bytes], labels: np.ndarray, share: float = 0.5, steps: int = STEPS, seed: int = 7) -> Net:
    """Adam on the weighted log loss for some ``steps`` of ``BATCH_DOCS``
    texts; ``share``: the weight of label 1."""
    net, r = Net.new(seed), np.random.default_rng(seed)
    ones = labels.mean()
    weights = np.where(labels == 1, share / ones, (1 - share) / (1 - ones))
    m, v, t = [np.zeros_like(x) for x in net], [np.zeros_like(x) for x in net], 0
    epochs = max(1, round(steps / -(-len(texts) // BATCH_DOCS)))
    for epoch in range(epochs):
        order, rate = r.permutation(len(texts)), 4e-3 * (1 - epoch / epochs)
        for a in range(0, len(order), BATCH_DOCS):
            i, t = order[a:a + BATCH_DOCS], t + 1
            grads, new = _gradients(net, [texts[k] for k in i], labels[i], weights[i]), []
            for k, (x, g) in enumerate(zip(net, grads)):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                new.append((x - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-7)).astype(np.float32))
            net = Net(*new)
    return net


def held_out(doc_id):
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == 0


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = TRAIN_DOCS) -> Net | float:
    """The fitted network, or the constant score if only one class is known."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
             .filter("doc_id is not null and y in (0, 1)").filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    classes = [r.y for r in known.select("y").distinct().collect()]
    if len(classes) < 2:
        return float(classes[0] if classes else 0.5)
    ids = [r for y in (0, 1) for r in known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()]
    chosen = docs.sparkSession.createDataFrame(ids, "doc_id long, y int")  # at most 2 x per_class rows
    texts: dict[int, tuple[bytes, int]] = {}
    held = 0
    for r in common.text_column(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", F.col("text").cast("binary").alias("t"), "y").toLocalIterator():
        if r.doc_id not in texts and held + len(r.t) <= TRAIN_BYTES:
            texts[r.doc_id] = (bytes(r.t), r.y)
            held += len(r.t)
    rows = [texts[k] for k in sorted(texts)]
    y = np.array([r[1] for r in rows], np.float64)
    if not 0 < y.sum() < len(y):
        return float(y.mean()) if len(y) else 0.5
    return train([r[0] for r in rows], y)


def _bytes(texts: pa.Array) -> list[np.ndarray]:
    """Views of each text's bytes in the Arrow buffer."""
    if not len(texts):
        return []
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].tolist()
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return [data[a:b] for a, b in zip(offsets, offsets[1:])]


def score(docs: DataFrame, net: Net | float, threshold: float = THRESHOLD) -> DataFrame:
    """The documents' columns and ``score``, ``predicted`` (with underscores
    behind them where the documents have columns of these names)."""
    names = [common.fresh(docs, n) for n in ("score", "predicted")]
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = batch.column(batch.schema.get_field_index("text")).fill_null("")
        s = np.full(len(text), net) if isinstance(net, float) else score_texts(net, _bytes(text))
        return pa.record_batch([*batch.columns, pa.array(s.astype(np.float64)), pa.array((s >= threshold).astype(np.int32))],
                               [*batch.schema.names, *names])

    return common.map_batches(docs, fn, schema)


def passed(docs: DataFrame, net: Net | float, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the network takes for label 1, their columns unchanged."""
    scored = score(docs, net, threshold)
    return scored.filter(F.col(scored.columns[-1]) == 1).drop(*scored.columns[-2:])


def judged(docs: DataFrame, net: Net | float) -> DataFrame:
    """doc_id, held_out, score, predicted of each row."""
    return score(common.text_column(docs), net).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
