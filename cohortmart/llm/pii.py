"""Personal data: offset-preserving deobfuscation and detection (operator 10).

Two layers of spans, always in code points of the source text, end exclusive:

* base: the plain identifier patterns of ``BASE`` on the text as it is;
* added: the same identifiers behind a disguise.  Three transducers rewrite
  the text - homoglyphs to ASCII, spelled digits to digits, at/dot spellings to
  ``@`` and ``.`` - and each keeps, for every character it writes, the source
  interval it came from.  The detectors run on the rewritten text and a hit is
  mapped back through those intervals.  A hit counts only if a rewritten
  character lies in it and no base span of its kind covers it: a base span
  may be a fragment of an identifier that is disguised in part.  Spelled digits
  and at/dot spellings are read twice, strictly and widely (short runs of
  digits beside other digits, dots between digits, ``[@]``, ``[.]``), as the
  wide reading may also run on into prose; the detectors decide in both.
  Digits and at/dot words are those of English, German, French and Spanish.

Look-alikes come from rules over the character data (compatibility forms,
digits of any script, characters that show nothing) and a list of letters of
other scripts.  A rewriting is kept as its changed pieces, in arrays, so it takes
16 bytes a change and a copy of the text, whatever the length of the text.

Cases: a null or empty text has no spans; repeated rows and repeated ids are
scored row by row; extra columns are ignored; texts of any length are scanned
whole in linear time (possessive patterns, starts anchored at run borders).
"""

from __future__ import annotations

import hashlib
import io
import re
import unicodedata
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

KINDS = ("email", "ip", "card", "phone")

_LOCAL = r"[A-Za-z0-9._%+-]"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Greedy digit runs always end at a run border, so a match can only begin at one.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NON_DIGIT = re.compile(r"[^0-9]")

# Letters of other scripts, and signs, that look like ASCII ones.
HOMOGLYPHS = {
    # Cyrillic
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "н": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "ѡ": "w", "х": "x", "у": "y", "ү": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ӏ": "I", "Ј": "J", "К": "K", "М": "M", "О": "O",
    "Р": "P", "Ԛ": "Q", "Ѕ": "S", "Т": "T", "Ѵ": "V", "Ԝ": "W", "Х": "X", "У": "Y", "Ү": "Y",
    # Greek
    "α": "a", "ϲ": "c", "ε": "e", "η": "n", "ι": "i", "ϳ": "j", "κ": "k", "ν": "v", "ο": "o", "σ": "o", "ρ": "p", "τ": "t",
    "υ": "u", "ω": "w", "χ": "x", "γ": "y",
    "Α": "A", "Β": "B", "Ϲ": "C", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Ϳ": "J", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    # Armenian
    "ց": "g", "հ": "h", "ո": "n", "օ": "o", "զ": "q", "ս": "u", "Լ": "L", "Օ": "O", "Տ": "S", "Ս": "U",
    # Cherokee
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M",
    "Ꮲ": "P", "Ꭱ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮍ": "Y", "Ꮓ": "Z",
    # Latin without a rule, signs
    "ı": "i", "ȷ": "j", "ɡ": "g", "ɑ": "a", "ɩ": "i", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "。": ".",
}
# Names of letters that are a Latin one in another dress.
_DRESSED = re.compile(r"(?:LATIN LETTER SMALL CAPITAL|NEGATIVE (?:CIRCLED|SQUARED) LATIN CAPITAL LETTER) ([A-Z])\Z")


def _look_alike(c: str) -> str | None:
    """What a character outside ASCII is read as, by rule: nothing if it shows
    nothing (format characters, selectors, strokes laid over a letter), a space, a
    digit, or the ASCII letters or sign that it is a compatibility form of.
    Ordinal signs are no letters in disguise."""
    kind = unicodedata.category(c)
    if kind == "Cf" or kind == "Mn" and ("VARIATION SELECTOR" in (name := unicodedata.name(c, "")) or "OVERLAY" in name or c == "\u034f"):
        return ""
    if kind == "Zs":
        return " "
    if (digit := unicodedata.digit(c, None)) is not None:
        return str(digit)
    plain = unicodedata.normalize("NFKC", c)
    if plain.isascii() and (plain.isalnum() or len(plain) == 1) and c not in "ªº":
        return plain
    m = _DRESSED.match(unicodedata.name(c, "")) if kind[0] in "LS" else None
    return m and m.group(1).lower()


HOMOGLYPHS.update((c, new) for c in map(chr, chain(range(0x80, 0xD800), range(0xE000, 0x1FC00), range(0xE0000, 0xE01F0)))
                  if c not in HOMOGLYPHS and (new := _look_alike(c)) is not None)
_TO_ONE = {ord(c): new for c, new in HOMOGLYPHS.items() if len(new) == 1}


@lru_cache(maxsize=256)
def _glyphs(chars: str) -> re.Pattern:
    """Runs of those of the look-alikes that are read as one character, and single others."""
    one, other = ("".join(c for c in chars if (ord(c) in _TO_ONE) == k) for k in (True, False))
    return re.compile("|".join([f"[{one}]++"] * bool(one) + [f"[{other}]"] * bool(other)))


# Letters that stand for digits in a run that has digits.
LETTER_DIGITS = str.maketrans("OoIl", "0011")
_LETTERED = re.compile(r"(?<![A-Za-z0-9])(?=[OoIl]*[0-9])[0-9OoIl]++(?![A-Za-z0-9])")

# Digits as spelled in English, German, French and Spanish.
SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
           "seven": "7", "eight": "8", "nine": "9",
           "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "fuenf": "5", "sechs": "6",
           "sieben": "7", "acht": "8", "neun": "9",
           "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
           "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8",
           "nueve": "9"}
# The words of these languages for plus, at and dot; an article that is also a digit.
PLUS = {"plus", "más"}
_ARTICLE = "un"


def _any_of(words: Iterable[str]) -> str:
    """One of the words, the longest that fits, with each common start tried once."""
    rest: dict[str, list[str]] = {}
    for w in sorted(words):
        rest.setdefault(w[:1], []).append(w[1:])
    ends = rest.pop("", None)
    tails = [c + _any_of(more) for c, more in rest.items()]
    return ("(?:" + "|".join(tails) + ")" if len(tails) > 1 else "".join(tails)) if not ends else f"(?:{'|'.join(tails)})?" if tails else ""


_PLUS, _WORD = _any_of(PLUS), _any_of(SPELLED)
_GAP = r"[ \t\r\n,.-]{1,3}"
_BORDER, _ENDED = r"(?<![^\W_])", r"(?![^\W_])"
#: Spelled digits count as a number from so many words in a row.
MIN_SPELLED = 4
_SPELLED_RUN = re.compile(rf"{_BORDER}(?:{_PLUS}{_GAP})?+{_WORD}(?:{_GAP}{_WORD}){{{MIN_SPELLED - 1},}}{_ENDED}")
_SPELLED_WORD = re.compile(_any_of([*PLUS, *SPELLED]))


def _spelled(bracketed: str, bare: str) -> str:
    """These in brackets, or words that stand alone, with the blanks around them."""
    return rf"[ \t]*+[\[({{<][ \t]*+(?:{bracketed})[ \t]*+[\])}}>][ \t]*+|[ \t]++(?:{bare})[ \t]++"


class Reading(NamedTuple):
    """How a disguised address is read: the whole of it, and its spelled dots."""

    address: re.Pattern
    dot: re.Pattern


def _reading(at: str, dot: str) -> Reading:
    return Reading(re.compile(rf"(?i)(?<!{_LOCAL})({_LOCAL}++)({at})([A-Za-z0-9-]++(?:(?:{dot}|\.)[A-Za-z0-9-]++)+)"), re.compile("(?i)" + dot))


_AT_SIGN = r"[ \t]*+@[ \t]*+"
_DOTS, _ROMANCE_AT, _ROMANCE_DOT = "dot|punkt", "arr?obase|arroba", "point|punto"
_ANY_DOT = f"{_DOTS}|{_ROMANCE_DOT}"
_STRICT = _reading(f"(?:{_spelled('at', 'at')}|{_AT_SIGN})", _spelled(_ANY_DOT, _DOTS))
# The wide reading: the same with symbols in brackets.
_WIDE = _reading(f"(?:{_spelled('at|@', 'at')}|{_AT_SIGN})", _spelled(_ANY_DOT + r"|\.", _DOTS))
# French and Spanish words for the dot are common in prose, of English too ("at this point
# in"): standing alone they count behind an at in brackets or one of those languages only.
_ROMANCE = _reading(f"(?:{_spelled(f'at|@|{_ROMANCE_AT}', _ROMANCE_AT)})", _spelled(_ANY_DOT + r"|\.", _ANY_DOT))
_MAYBE_AT_DOT = re.compile(rf"(?i)[\[({{< \t](?:{_DOTS})[\])}}> \t]|[\[({{<][ \t]*+(?:at|{_ROMANCE_DOT})[ \t]*+[\])}}>]")
_MAYBE_WIDE = re.compile(rf"(?i)[\[({{< \t](?:{_ANY_DOT})[\])}}> \t]|[\[({{<][ \t]*+(?:at|@|\.)[ \t]*+[\])}}>]|@[ \t]")
_MAYBE_ROMANCE = re.compile(rf"(?i)[\[({{< \t](?:{_ROMANCE_AT})[\])}}> \t]|[\[({{<][ \t]*+(?:at|@)[ \t]*+[\])}}>]")
# Between and beside digits every word for the dot counts.
_DOT_BY_DIGIT = _spelled(_ANY_DOT + r"|\.", _ANY_DOT)
_DIGIT_DOT = re.compile(rf"(?i)(?<=[0-9])(?:{_DOT_BY_DIGIT})(?=[0-9])")
_ALONE = rf"{_WORD}{_ENDED}"
_WIDE_RUN = re.compile(rf"{_BORDER}(?:{_PLUS}[ \t\r\n,-]{{1,3}})?+{_ALONE}(?:[ \t\r\n,-]{{1,3}}{_ALONE})*+")
#: What a short run stands next to, within so many characters.
_NEAR = 14
_BEFORE = re.compile(rf"(?i)(?:[0-9][ \t-]{{1,3}}|\+[ \t]?|[0-9A-Za-z](?:{_DOT_BY_DIGIT}|\.))\Z")
_AFTER = re.compile(rf"(?i)[ \t-]{{1,3}}[0-9]|(?:{_DOT_BY_DIGIT}|\.)[0-9A-Za-z]")
_TLD = re.compile(r"[A-Za-z]{2,24}\Z")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of local@label(.label)+, in linear time.

    The pattern can only match around an ``@``; all starts within the run
    before it share the same end, so the leftmost free character of the run
    decides.
    """
    out: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(Span("email", start, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return out


def find_base(text: str) -> list[Span]:
    """The base spans by kind as listed in ``KINDS``, then start."""
    out = _emails(text) if "@" in text else []
    if _DIGIT.search(text) is None:
        return out
    if text.count(".") >= 3:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
                out.append(Span("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NON_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(Span("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NON_DIGIT.sub("", m.group())) <= 15:
                out.append(Span("phone", *m.span()))
    return out


class Tape:
    """A rewritten text, kept with the text under it as the pieces that were
    changed (from where to where in either), so that spans can be mapped back."""

    __slots__ = ("text", "under", "src", "src_end", "dst", "dst_end")

    def __init__(self, text: str, under: "Tape | None" = None) -> None:
        self.text, self.under = text, under
        self.src, self.src_end, self.dst, self.dst_end = (array("i") for _ in range(4))

    def rewrite(self, edits: Iterable[tuple[int, int, str]]) -> "Tape":
        """Replace disjoint ascending ``(from, to, replacement)`` pieces.  Characters
        of a replacement as long as its piece map to theirs in it, others to the
        whole piece; what is taken out counts as a change of the character before
        it.  No edits: this tape."""
        out, text, at, length = Tape("", self), io.StringIO(), 0, 0
        for a, b, new in edits:
            text.write(self.text[at:a])
            text.write(new)
            length += a - at
            if len(new) == b - a and out.src and a == out.src_end[-1] and out.dst_end[-1] - out.dst[-1] == a - out.src[-1]:
                out.src_end[-1], out.dst_end[-1] = b, length + len(new)
            else:
                out.src.append(a)
                out.src_end.append(b)
                out.dst.append(length)
                out.dst_end.append(length + len(new))
            length += len(new)
            at = b
        if not out.src:
            return self
        text.write(self.text[at:])
        out.text = text.getvalue()
        return out

    def _place(self, at: int) -> tuple[int, int]:
        """The piece of the text under this one that a character comes from."""
        i = bisect_right(self.dst, at) - 1
        if i < 0:
            return at, at + 1
        if at >= self.dst_end[i]:
            at += self.src_end[i] - self.dst_end[i]
        elif self.dst_end[i] - self.dst[i] == self.src_end[i] - self.src[i]:
            at += self.src[i] - self.dst[i]
        else:
            return self.src[i], self.src_end[i]
        return at, at + 1

    def _changed(self, start: int, end: int) -> bool:
        i = bisect_left(self.dst, end)
        return i > 0 and self.dst_end[i - 1] > start or i < len(self.dst) and self.dst[i] == self.dst_end[i] == end

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """The span in the source, and whether anything in it was rewritten."""
        tape, changed = self, False
        while tape.under is not None:
            changed = changed or tape._changed(start, end)
            start, end, tape = tape._place(start)[0], tape._place(end - 1)[1], tape.under
        return start, end, changed


def _glyph_edits(text: str) -> Iterator[tuple[int, int, str]]:
    if not (held := HOMOGLYPHS.keys() & set(text)):
        return
    for m in _glyphs("".join(sorted(held))).finditer(text):
        run = m.group()
        yield m.start(), m.end(), run.translate(_TO_ONE) if ord(run[0]) in _TO_ONE else HOMOGLYPHS[run]


def _letter_edits(text: str) -> Iterator[tuple[int, int, str]]:
    return ((m.start(), m.end(), m.group().translate(LETTER_DIGITS)) for m in _LETTERED.finditer(text) if not m.group().isdigit())


def _lower(text: str) -> str:
    """In lower case, character by character."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def _digit_edits(text: str) -> Iterator[tuple[int, int, str]]:
    """Each spelled word takes the gap behind it with it, so a run of words
    becomes a run of digits."""
    text = _lower(text)
    return _run_edits(text, _SPELLED_RUN.finditer(text))


def _wide_digit_edits(text: str) -> Iterator[tuple[int, int, str]]:
    """Also of runs of fewer words, where digits, a dot or a plus stand next to
    them; an article alone is none."""
    text = _lower(text)
    return _run_edits(text, (run for run in _WIDE_RUN.finditer(text) if run.group() != _ARTICLE and
                             (_SPELLED_WORD.match(run.group()).group() in PLUS
                              or _AFTER.match(text, run.end(), run.end() + _NEAR)
                              or _BEFORE.search(text[max(0, run.start() - _NEAR):run.start()])
                              or sum(1 for _ in islice(_SPELLED_WORD.finditer(text, run.start(), run.end()), MIN_SPELLED)) == MIN_SPELLED)))


def _run_edits(text: str, runs: Iterable[re.Match]) -> Iterator[tuple[int, int, str]]:
    for run in runs:
        start = new = None
        for m in _SPELLED_WORD.finditer(text, run.start(), run.end()):
            if new is not None:
                yield start, m.start(), new
            word = m.group()
            start, end, new = m.start(), m.end(), "+" if word in PLUS else SPELLED[word]
        yield start, end, new


def _at_dot_edits(text: str, reading: Reading) -> Iterator[tuple[int, int, str]]:
    """At and dot spellings, where a whole address can be read around them: a
    spelled ``at`` needs a dotted domain that ends in letters; bare words
    (" at ", " dot ") only count together, so plain prose is left alone.
    Read widely, an ``@`` with a space behind it counts before any such domain
    (one with a space only before it may be a mention)."""
    for m in reading.address.finditer(text):
        at = m.group(2)
        dots = [d.span() for d in reading.dot.finditer(text, m.start(3), m.end(3))]
        if not dots and (at == "@" or at.strip().lower() == "at" or at.strip() == "@" and not (reading is _WIDE and at[-1] in " \t")):
            continue
        if not _TLD.match(text[dots[-1][1] if dots else m.start(3):m.end(3)].rpartition(".")[2]):
            continue
        if at != "@":
            yield m.start(2), m.end(2), "@"
        for a, b in dots:
            yield a, b, "."


def _strict(tape: Tape) -> Tape:
    tape = tape.rewrite(_digit_edits(tape.text))
    if _MAYBE_AT_DOT.search(tape.text):
        tape = tape.rewrite(_at_dot_edits(tape.text, _STRICT))
    return _romance(tape)


def _romance(tape: Tape) -> Tape:
    return tape.rewrite(_at_dot_edits(tape.text, _ROMANCE)) if _MAYBE_ROMANCE.search(tape.text) else tape


def _wide(tape: Tape) -> Tape:
    tape = tape.rewrite(_wide_digit_edits(tape.text))
    if _MAYBE_WIDE.search(tape.text):
        tape = tape.rewrite(_at_dot_edits(tape.text, _WIDE))
        tape = tape.rewrite((m.start(), m.end(), ".") for m in _DIGIT_DOT.finditer(tape.text))
    return _romance(tape)


def find_added(text: str, base: list[Span]) -> list[Span]:
    """Identifiers behind a disguise, mapped back to the source."""
    tape = Tape(text)
    if not text.isascii():
        tape = tape.rewrite(_glyph_edits(text))
    if _DIGIT.search(tape.text):
        tape = tape.rewrite(_letter_edits(tape.text))
    strict, wide = _strict(tape), _wide(tape)
    found = _hits(strict, [base])
    return found + _hits(wide, [base, found]) if wide.text != strict.text else found


def _hits(tape: Tape, known: list[list[Span]]) -> list[Span]:
    """Spans with a rewritten character that no known span of their kind covers."""
    if tape.under is None:
        return []
    taken = [sorted((s.start, s.end) for s in spans if s.kind == k) for spans in known for k in KINDS]
    out = []
    for s in find_base(tape.text):
        a, b, changed = tape.source(s.start, s.end)
        if not changed:
            continue
        # In a list, spans that begin later end later too.
        at = [(held, bisect_right(held, (a, float("inf"))) - 1) for held in taken[KINDS.index(s.kind)::len(KINDS)]]
        if all(i < 0 or held[i][1] < b for held, i in at):
            out.append(Span(s.kind, a, b))
    return out


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a text, both by kind as listed, then start."""
    if not text:
        return [], []
    base = find_base(text)
    added = find_added(text, base)
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + added, key=lambda s: (order[s.kind], s.start, s.end))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping
    spans become one, named by the one that begins first (then the longest)."""
    parts, at = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= at:
            parts += (text[at:s.start], f"[{s.kind.upper()}]")
        at = max(at, s.end)
    return "".join(parts) + text[at:]


SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def _detect(batch: pa.RecordBatch) -> pa.RecordBatch:
    counts: list[list[int]] = [[] for _ in KINDS]
    digests, all_spans = [], []
    for text in batch.column("text").to_pylist():
        base, spans = find(text)
        for k, column in zip(KINDS, counts):
            column.append(sum(s.kind == k for s in spans))
        digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
        all_spans.append(joined(spans))
    return pa.record_batch([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                            pa.array(digests, pa.string()), pa.array(all_spans, pa.string())],
                           ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])


def detect(docs: DataFrame) -> DataFrame:
    """Per row: counts of all spans by kind, the digest of the base spans, all spans."""
    return common.map_batches(common.text_column(docs), _detect, SCHEMA)


def _redact(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = [None if t is None else redact(t, find(t)[1]) for t in batch.column("text").to_pylist()]
    new = {"text": texts, "n_chars": [None if t is None else len(t) for t in texts]}
    columns = [pa.array(new[f.name], f.type) if f.name in new else batch.column(i) for i, f in enumerate(batch.schema)]
    return pa.record_batch(columns, schema=batch.schema)


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind; same columns
    (``n_chars``, where there is one, is that of the new text; null stays null)."""
    return common.map_batches(docs, _redact, docs.schema)
