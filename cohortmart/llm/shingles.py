"""Sets of hashed word shingles, computed on whole Arrow buffers with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at a time (several arrays of 8 bytes each per byte).
SLICE = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20260101)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)  # a random value for each byte
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) <= n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word in the bytes (A-Z lower-cased)."""
    space = _SPACE[data]
    word = np.concatenate([[False], ~space, [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    up, down = _power(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * up[:len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)), start


def _pieces(data: np.ndarray) -> list[tuple[int, int]]:
    """Cuts at white space near every ``SLICE`` bytes, so no word is cut."""
    out, a = [], 0
    while len(data) - a > SLICE:
        b = a + SLICE
        while b < len(data) and not _SPACE[data[b]]:
            b += 1
        out.append((a, b))
        a = b
    return [*out, (a, len(data))]


def document_words(texts: pa.Array) -> list[np.ndarray]:
    """Word hashes of each text (null: none), many short texts at a time."""
    if not len(texts):
        return []
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    size, out, i = np.diff(offsets), [], 0
    while i < len(size):
        j = i + 1
        while j < len(size) and offsets[j + 1] - offsets[i] <= SLICE:
            j += 1
        if j == i + 1 and size[i] > SLICE:
            text = data[offsets[i]:offsets[j]]
            out.append(np.concatenate([word_hashes(text[a:b])[0] for a, b in _pieces(text)]))
        else:  # a space between neighbours keeps their words apart
            n = j - i
            joined = np.full(int(offsets[j] - offsets[i]) + n, 0x20, np.uint8)
            at = np.arange(offsets[j] - offsets[i]) + np.repeat(np.arange(n), size[i:j])
            joined[at] = data[offsets[i]:offsets[j]]
            hashes, start = word_hashes(joined)
            bounds = np.searchsorted(start, offsets[i:j + 1] - offsets[i] + np.arange(n + 1))
            out += [hashes[a:b] for a, b in zip(bounds, bounds[1:])]
        i = j
    return out


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of all k words in a row; fewer words are one
    shingle, none give an empty set."""
    n = len(words)
    if n == 0:
        return words
    width = min(n, k)
    h = words[:n - width + 1] + np.uint64(width)
    for j in range(1, width):
        h = mix(h) + words[j:n - width + 1 + j] * _STEP[j]
    return np.unique(mix(h))


def set_key(hashes: np.ndarray) -> int:
    """A 64-bit key of the set, as a signed integer."""
    total = np.add.reduce(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64) + np.uint64(len(hashes))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])
