"""Token counts without tokens (operator 1).

A linear longest-match automaton over the pieces of a public word-piece style
vocabulary.  The trie of all pieces gets failure links; each link stores how
many pieces are popped when it is taken, so a word's number of greedy pieces
falls out of one pass over its bytes, without backtracking and without
building a piece.

Alphabet: a byte, or a byte that ends its word (256 more).  A piece marked as
ending a word ends with such a symbol, so no word-end symbol is ever left
over, and as every single symbol is a piece, every word can be read.

Cases: a null or empty text, or one of white space only, has 0 words and 0
tokens; repeated rows are counted row by row; extra columns are ignored; a
word of any length takes time in proportion to its length.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import common
from .tokenizer import byte_to_char

#: Distinct chunks whose counts are kept in a worker.
CACHE_CHUNKS = 500_000
_SYMBOLS = 512
_WORDS_SHIFT = 32


class Automaton:
    """``pieces``: byte strings with whether they end a word."""

    def __init__(self, pieces: list[tuple[bytes, bool]]) -> None:
        go: dict[int, int] = {}
        parent, symbol, accepts = [0], [0], [False]

        def add(symbols: list[int]) -> None:
            node = 0
            for s in symbols:
                nxt = go.get(node * _SYMBOLS + s)
                if nxt is None:
                    nxt = go[node * _SYMBOLS + s] = len(parent)
                    parent.append(node)
                    symbol.append(s)
                    accepts.append(False)
                node = nxt
            accepts[node] = True

        for b in range(_SYMBOLS):
            add([b])
        for piece, ends in pieces:
            if piece:
                add([*piece[:-1], piece[-1] + 256] if ends else [*piece])
        self.go, n = go, len(parent)
        self.fail, self.popped = [0] * n, [0] * n
        depth = [0] * n
        for v in range(1, n):  # a parent is always numbered before its children
            depth[v] = depth[parent[v]] + 1
        for v in sorted(range(1, n), key=depth.__getitem__):
            if accepts[v]:
                self.popped[v] = 1
                continue
            z, popped = self.fail[parent[v]], self.popped[parent[v]]
            while (nxt := go.get(z * _SYMBOLS + symbol[v])) is None:
                popped += self.popped[z]
                z = self.fail[z]
            self.fail[v], self.popped[v] = nxt, popped

    def count(self, word: bytes) -> int:
        """Greedy longest-match pieces of one word."""
        if not word:
            return 0
        go, fail, popped, node, n = self.go, self.fail, self.popped, 0, 0
        last = len(word) - 1
        for i, b in enumerate(word):
            key = b if i < last else b + 256
            while (nxt := go.get(node * _SYMBOLS + key)) is None:
                n += popped[node]
                node = fail[node]
            node = nxt
        while node:
            n += popped[node]
            node = fail[node]
        return n


class Counter(dict):
    """Chunk -> words << 32 | tokens, computed when first asked for."""

    def __init__(self, path: str) -> None:
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix, table = spec["model"].get("end_of_word_suffix") or "", {c: b for b, c in byte_to_char().items()}
        special = {t["content"] for t in spec["added_tokens"]}
        pieces = []
        for token in spec["model"]["vocab"]:
            if token not in special:
                ends = bool(suffix) and token.endswith(suffix) and token != suffix
                body = token[:-len(suffix)] if ends else token
                pieces.append((bytes(table[c] for c in body), ends))
        self.automaton = Automaton(pieces)
        steps = spec["pre_tokenizer"].get("pretokenizers", [])
        self.words = regex.compile(next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split"))

    def __missing__(self, chunk: str) -> int:
        words = self.words.findall(chunk)
        n = (len(words) << _WORDS_SHIFT) + sum(self.automaton.count(w.encode("utf-8", "replace")) for w in words)
        if len(self) >= CACHE_CHUNKS:
            self.clear()
        self[chunk] = n
        return n

    def of(self, text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return sum(map(self.__getitem__, text.lower().split()))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One automaton for each Python worker and vocabulary."""
    return Counter(path)


common.kept("counter", counter.cache_clear)


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per row: words and greedy pieces of the lower-cased text, by the
    vocabulary file ``vocabulary`` (a path that every executor can open)."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = counter(vocabulary)
        both = [c.of(t) for t in batch.column("text").to_pylist()]
        return pa.record_batch([batch.column("doc_id"), pa.array([x >> _WORDS_SHIFT for x in both], pa.int64()),
                                pa.array([x & ((1 << _WORDS_SHIFT) - 1) for x in both], pa.int64())],
                               ["doc_id", "n_words", "n_tokens"])

    return common.map_batches(common.text_column(docs), fn, "doc_id long, n_words long, n_tokens long", "counter")
