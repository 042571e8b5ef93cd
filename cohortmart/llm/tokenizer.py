"""Encoding whole texts with a public tokenizer file, each distinct chunk once.

Texts are cut before single spaces, equal chunks of a batch are encoded once,
and the ids of a text are gathered from its chunks' ids.  A chunk is made of
words, whose ids are kept in a bounded cache and come from the tokenizer's own
model.  That is exact only where no token reaches over a cut; the two kinds of
file for which this holds are recognised by their declared steps.  A text in
which a cut could fall inside white space is encoded whole, a chunk with
characters outside Latin goes through the whole tokenizer, and files of any
other kind encode every text at once.

Strings of the file's added tokens (``<|endoftext|>``) are ordinary text to the
encoder unless ``added`` is set; then they are those tokens, as in the
tokenizer's own setting, and a text that holds one is encoded whole.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .common import kept

#: Bytes of distinct words, and of distinct chunks, that an encoder keeps; each
#: cache starts anew beyond it.  An entry counts as its text, its ids and what
#: Python needs to hold the two.
CACHE_BYTES, ENTRY_BYTES = 108 << 20, 150
#: Rows of a batch (more share more chunks), and bytes of text encoded at a time:
#: what a slice needs for a moment is some 40 times as much, so an encoder with a
#: small cache takes small slices too, a SLICE_SHARE of it.
BATCH_ROWS = 1000
SLICE_BYTES, SLICE_SHARE = 4 << 20, 32

# Fixed value: how byte-level files of the first kind split a text into words.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Stands before each text, so that its first chunk (no space before it) is told from others.
_FIRST = "\x01"
#: White space (or the mark) before a space: a cut there may fall inside a token.
_UNSAFE = "[\\s\x0b\x1c-\x1f\x85\xa0  -     　] |" + _FIRST
_PLAIN = regex.compile("[\x00\x02-\x1b\x20-\x84\x86-ɏ]*")


def byte_to_char() -> dict[int, str]:
    """The printable stand-ins that byte-level vocabularies use for bytes:
    printable Latin-1 stands for itself, the rest follow from U+0100 on."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(same)]
    return {b: chr(b) for b in same} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Token ids of whole texts; the same ids as encoding each text at once."""

    def __init__(self, path: str, added: bool = False, cache_bytes: int = CACHE_BYTES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added  # True: their strings in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.size = max(chain(spec["model"]["vocab"].values(), (t["id"] for t in spec["added_tokens"]))) + 1
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.kind = _kind(spec)
        #: Strings that make a text be encoded whole.
        self.literals = [t["content"] for t in spec["added_tokens"]] if added else []
        if added and any(t["normalized"] for t in spec["added_tokens"]):
            self.kind = "other"
        if self.kind == "spaced":
            self.split = regex.compile(BYTE_LEVEL).findall
        elif self.kind == "words":
            self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        # The model alone, for words whose bytes are already written as its characters.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.chars = byte_to_char()
        # A word that no plain word contains, and that is one token: it tells where words end.
        mark = self.chars[1]
        self.mark_id = (self.model.encode(mark, add_special_tokens=False).ids or [None])[0]
        self.chars[1] = f" {mark} "
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.cache_bytes, self.words_bytes, self.chunks_bytes = cache_bytes, 0, 0
        self.slice_bytes = min(SLICE_BYTES, cache_bytes // SLICE_SHARE + 1)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_words(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.words]
        if self.words_bytes > self.cache_bytes:
            self.words.clear()
            self.words_bytes, new = 0, list(words)
        if not new:
            return
        mapped = "\x01".join([*new, ""]).encode().decode("latin-1").translate(self.chars)
        ids = np.array(self.model.encode_batch_fast([mapped], add_special_tokens=False)[0].ids, self.dtype)
        ends, w = np.flatnonzero(ids == self.mark_id), self.dtype.itemsize
        raw, starts = ids.tobytes(), np.concatenate([[0], ends[:-1] + 1])
        self.words.update(zip(new, [raw[a:b] for a, b in zip((starts * w).tolist(), (ends * w).tolist())]))
        self.words_bytes += ENTRY_BYTES * len(new) + len(mapped) + len(raw)

    def _chunk_ids(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks, from the cache or learned now."""
        found = list(map(self.chunks.get, chunks))
        at = [i for i, f in enumerate(found) if f is None]
        if not at:
            return found
        new = [chunks[i] for i in at]
        told = [c[1:] if c[:1] == _FIRST else " " + c for c in new] if self.kind == "spaced" else new
        odd = set() if _PLAIN.fullmatch("".join(told)) else {j for j, t in enumerate(told) if not _PLAIN.fullmatch(t)}
        if self.kind == "spaced":  # a chunk of letters is one word
            words = [(t,) if c.isalpha() else self.split(t) for c, t in zip(new, told)]
        else:
            words = [(low,) if (low := t.lower()).isalpha() else self.split(low) for t in told]
        for j in odd:
            words[j] = ()
        self._learn_words(set(chain.from_iterable(words)))
        get = self.words.__getitem__
        ids = [get(w[0]) if len(w) == 1 else b"".join(map(get, w)) for w in words]
        for j, raw in zip(odd, self._whole([told[j] for j in odd])):
            ids[j] = raw
        if self.chunks_bytes > self.cache_bytes:
            self.chunks.clear()
            self.chunks_bytes = 0
        self.chunks.update(zip(new, ids))
        self.chunks_bytes += ENTRY_BYTES * len(new) + sum(map(len, new)) + sum(map(len, ids))
        for i, raw in zip(at, ids):
            found[i] = raw
        return found

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after the other, and where each ends."""
        if self.kind == "spaced":
            texts = pc.binary_join_element_wise(_FIRST, texts, "")
        lists = pc.split_pattern(texts, " ")
        ends = lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        ids = pa.array(self._chunk_ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.binary())
        flat = pa.DictionaryArray.from_arrays(coded.indices, ids).dictionary_decode()
        at = np.frombuffer(flat.buffers()[1], np.int32)[:len(flat) + 1]
        return np.frombuffer(flat.buffers()[2], self.dtype, at[-1] // self.dtype.itemsize), at[ends] // self.dtype.itemsize

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text (none of them null) as an array of ``dtype``."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        if self.kind == "other":
            whole = np.ones(len(texts), bool)
        elif self.kind == "spaced":
            whole = pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False)
        else:
            whole = np.zeros(len(texts), bool)
        for literal in self.literals:
            whole = whole | pc.match_substring(texts, literal).to_numpy(zero_copy_only=False)
        out: list[np.ndarray] = [np.zeros(0, self.dtype)] * len(texts)
        if whole.any():
            at = np.flatnonzero(whole)
            for i, raw in zip(at.tolist(), self._whole(texts.take(pa.array(at)).to_pylist())):
                out[i] = np.frombuffer(raw, self.dtype)
        at = np.flatnonzero(~whole)
        size = np.cumsum(pc.binary_length(texts).to_numpy()[at]) // self.slice_bytes
        for rows in np.split(at, np.flatnonzero(np.diff(size)) + 1):
            if len(rows):
                ids, ends = self._cut(texts.take(pa.array(rows)))
                for i, a, b in zip(rows.tolist(), [0, *ends.tolist()], ends.tolist()):
                    out[i] = ids[a:b]
        return out


def _kind(spec: dict) -> str:
    pre, norm = spec["pre_tokenizer"] or {}, spec["normalizer"] or {}
    if not norm and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "spaced"
    steps = pre.get("pretokenizers", [])
    if ([s["type"] for s in steps] == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed"
            and steps[0]["invert"] and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]
            and [n["type"] for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]):
        return "words"
    return "other"


@lru_cache(maxsize=2)
def encoder(path: str, added: bool = False, cache_bytes: int = CACHE_BYTES) -> Encoder:
    """One encoder for each Python worker and file."""
    return Encoder(path, added, cache_bytes)


kept("encoder", encoder.cache_clear)
