"""Operators 11 to 13 against brute force and the public libraries."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from cohortmart.llm import alignment, byte_pairs, common, spelling
from cohortmart.llm.queries import BYTE_VOCABULARY, PIECE_VOCABULARY, RANKS, REGISTRY
from tests.llm.test_operators import frame, multiset, odd_texts

PATTERN = public_tokenizers.PATTERN
ODD = ["a", "aa", "the ", " ", "  ", "\n", "'s", "'S", "9", "é", "日本", "\t", "!", "\x1c", "\x85", "　", "😀", "<s>", "<0x41>",
       "<|endoftext|>", "▁", "\x00", "ﬁ"]


def sha(raw) -> str:
    return hashlib.sha256(raw if isinstance(raw, bytes) else raw.encode()).hexdigest()


def mixed_texts(n, seed, longest=40):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    return odd_texts() + [(1000 + i, t) for i, t in enumerate(mixed_texts(200, 5))]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return common.materialize(frame(spark, rows).repartition(3), "odd")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_rank_queue_takes_the_least_rank():
    r, queue, held = random.Random(1), byte_pairs.RankQueue(100_000), defaultdict(list)
    for step in range(4000):
        if r.random() < 0.6 or not held:
            rank, at = r.randrange(100_000) if r.random() < 0.7 else r.randrange(40), r.randrange(10_000)
            queue.put(rank, [at])
            held[rank].append(at)
        else:
            rank, found = queue.take()
            assert rank == min(held) and found == sorted(held.pop(rank))
    while held:
        assert queue.take()[0] == min(held)
        del held[min(held)]
    assert queue.take() is None


def test_codec_equals_the_library(library):
    codec, r = byte_pairs.Codec(RANKS, PATTERN, cache_bytes=20_000), random.Random(3)
    texts = [*mixed_texts(3000, 2), "y" * 60_000, "".join(r.choice("abcdeé") for _ in range(60_000)), "ab" * 20_000, ""]
    texts += [f"x{chr(c)}y 1{chr(c)}1 {chr(c)} " for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    for raw, t in zip(codec.encode(texts), texts):
        ids = np.frombuffer(raw, codec.dtype)
        assert ids.tolist() == library.encode_ordinary(t)
        assert b"".join(codec.tokens[i] for i in ids) == t.encode()
    codec.encode(["some new words here"])
    assert len(codec.known) < 10  # full, so it started anew
    with pytest.raises(ValueError):
        codec.decode(np.array([60_000]))


def test_merges_of_lower_rank_go_first(tmp_path):
    # "cd" + "e" ranks before "cd": after the first "cd" the new pair comes before the second.
    tokens = [*(bytes([b]) for b in range(256)), b"cde", b"ecd", b"cd", b"cdecd"]
    (tmp_path / "ranks").write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    codec = byte_pairs.Codec(str(tmp_path / "ranks"), PATTERN)
    ranks = {t: i for i, t in enumerate(tokens)}

    def slow(word):
        parts = [bytes([b]) for b in word]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not found:
                return [ranks[p] for p in parts]
            i = min(found)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    r = random.Random(5)
    words = [bytes(r.choices(b"cde", k=r.randint(1, 12))) for _ in range(500)]
    assert [np.frombuffer(x, codec.dtype).tolist() for x in codec.merge(words)] == [slow(w) for w in words]


def test_byte_pairs(spark, docs, rows, library, tmp_path):
    want = Counter()
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want[(i, len(ids), sha(",".join(map(str, ids))), sha(t or ""))] += 1
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert multiset(REGISTRY["op11_byte_pairs"](spark, str(tmp_path))) == want
    encoded = byte_pairs.encode(docs, RANKS, PATTERN)
    assert multiset(byte_pairs.decode(encoded, RANKS, PATTERN)) == Counter((i, (t or "").encode()) for i, t in rows)
    assert byte_pairs.round_trip(docs.filter("false"), RANKS, PATTERN).count() == 0


def test_merge_path_by_pieces():
    r = random.Random(3)
    for _ in range(300):
        a, b = (np.array(sorted({*r.choices(range(1, 60), k=r.randint(1, 40)), 70})) for _ in range(2))
        both = sorted({*a.tolist(), *b.tolist()})
        links, cuts = [(int((a < e).sum()), int((b < e).sum())) for e in both], sorted({*a.tolist()} & {*b.tolist()})
        for size in (1, 2, 3, 7, 1000):
            path = alignment.merge_path(a, b, size)
            assert list(zip(path.a.tolist(), path.b.tolist())) == links
            assert [a.tolist().index(c) + 1 for c in cuts] == path.cut_a.tolist()
            assert [b.tolist().index(c) + 1 for c in cuts] == path.cut_b.tolist()
        at_a, at_b = alignment.diagonals(a, b, 5)
        assert np.abs(np.diff(at_a + at_b) - (len(a) + len(b)) / 5).max() <= 1  # equal work


def test_pieces_equal_the_library():
    model, encoder = sentencepiece.SentencePieceProcessor(model_file=PIECE_VOCABULARY), alignment.PieceEncoder(PIECE_VOCABULARY, 20_000)
    assert encoder.chunked
    texts = [*mixed_texts(3000, 4), *(f"a{chr(c)} b {chr(c)}" for c in range(0x3100)), "y" * 5000, " ", "a ", " a", ""]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [model.encode(t) if t else [] for t in texts]


def brute_alignment(rows):
    plain, pieces = Tokenizer.from_file(BYTE_VOCABULARY), sentencepiece.SentencePieceProcessor(model_file=PIECE_VOCABULARY)
    plain.encode_special_tokens = True
    table = {c: b for b, c in alignment.byte_to_char().items()}

    def spelled(piece):
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    out, count = [], Counter()
    for i, t in rows:
        told, spans, ids = " " + (t or ""), [], []
        if t:
            e = plain.encode(told, add_special_tokens=False)
            ids = [e.ids, pieces.encode(t)]
            raw = [[bytes(table[c] for c in plain.id_to_token(x)) for x in ids[0]], [spelled(pieces.id_to_piece(x)) for x in ids[1]]]
            if not all(b"".join(r) == told.encode() for r in raw):
                ids = []
        if not ids:
            out.append((i, [], [], [], ""))
            continue
        for r in raw:
            at = np.cumsum([0, *map(len, r)]).tolist()
            spans.append(list(zip(at, at[1:])))
        links = []
        y = 0
        for x, (s, e) in enumerate(spans[0]):
            while spans[1][y][1] <= s:
                y += 1
            z = y
            while z < len(spans[1]) and spans[1][z][0] < e:
                links.append((ids[0][x], ids[1][z]))
                z += 1
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, low = [], 0
        for c in cuts:
            groups.append("|".join(",".join(str(k) for k, (s, e) in zip(own, span) if low <= s and e <= c) for own, span in zip(ids, spans)))
            low = c
        count.update(links)
        out.append((i, *ids, links, ";".join(groups)))
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return Counter((i, len(a), len(b), g.count(";") + 1 if g else 0, len(links), sum(count[x] == most[x[1]] for x in links),
                    sum(count[x] for x in links), sha(g) if g else "") for i, a, b, links, g in out)


def test_alignment(spark, docs, rows, tmp_path, monkeypatch):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    short = [(i, t if t is None or len(t) < 20_000 else t[:3000]) for i, t in rows]
    frame(spark, short).repartition(3).write.parquet(f"{tmp_path}/short/documents.parquet")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = brute_alignment(short)
    assert multiset(REGISTRY["op12_alignment"](spark, f"{tmp_path}/short").select(*names)) == want
    long = REGISTRY["op12_alignment"](spark, str(tmp_path)).filter("n_links > 10000").collect()
    assert long and all(r.n_links >= max(r.n_a, r.n_b) and r.n_links == r.n_a + r.n_b - r.n_groups for r in long)
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 300)  # many blocks, one batch over several slices
    monkeypatch.setattr(alignment, "SLICE_BYTES", 500)
    assert multiset(alignment.link_scores(frame(spark, short), BYTE_VOCABULARY, PIECE_VOCABULARY).select(*names)) == want
    assert alignment.link_scores(docs.filter("false"), BYTE_VOCABULARY, PIECE_VOCABULARY).count() == 0
    found = defaultdict(list)
    for g in alignment.groups(frame(spark, short[:20]), BYTE_VOCABULARY, PIECE_VOCABULARY).collect():
        found[g.doc_id].append((g.group, ",".join(map(str, g.a_ids)) + "|" + ",".join(map(str, g.b_ids))))
    told = {r[0]: r[-1] for r in want}
    assert all(sha(";".join(x for _, x in sorted(gs))) == told[i] for i, gs in found.items() if sum(j == i for j, _ in short) == 1)


def brute_words(rows):
    total = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def near(x, y):
    if abs(len(x) - len(y)) > 1 or x == y:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    long, short = (x, y) if len(x) > len(y) else (y, x)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def brute_variants(words):
    by_length = defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    out, form = [], {}
    for w, n in words.items():
        close = [x for d in (-1, 0, 1) for x in by_length[len(w) + d] if near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best
        out.append((w, form.get(w), n, len(close)))
    roots = {}
    for w in words:
        x = w
        while x in form:
            x = form[x]
        roots[w] = x
    return Counter((w, f, roots[w], n, k, words[f] if f else None) for w, f, n, k in out)


def word_rows():
    r = random.Random(11)
    base = ["colour", "behaviour", "straße", "élève", "naïveté", "aaaaa", "aaaaaa", "aaaab", "abcde" * 900, "ÀÉÎÕÜ", "mississippi"]
    base += ["".join(r.choice("abcdé") for _ in range(r.randint(4, 8))) for _ in range(150)]

    def edited(w):
        k = r.randrange(len(w))
        return r.choice([w[:k] + w[k + 1:], w[:k] + r.choice("abceé") + w[k:], w[:k] + r.choice("abceÿ") + w[k + 1:]])

    weights = [1 / (1 + k) for k in range(len(base))]
    rows = []
    for i in range(250):
        ws = r.choices(base, weights, k=60)
        rows.append((i, r.choice([" ", "-", "1"]).join(edited(w) if r.random() < 0.1 else w.upper() if r.random() < 0.1 else w for w in ws)))
    return rows + [(None, rows[3][1]), (5, rows[5][1]), (7, None), (8, ""), (9, "12 34")]


def test_words_of_documents(spark):
    rows = word_rows()
    assert {r.word: r.n for r in spelling.word_counts(frame(spark, rows).repartition(3)).collect()} == brute_words(rows)


@pytest.mark.parametrize("classes, tile", [(None, 2048), (1, 16), (5, 4), (7, 2048)])
def test_variants(spark, classes, tile):
    rows = word_rows()
    words = spelling.word_counts(frame(spark, rows).repartition(3))
    found = spelling.variants(words, classes, tile)
    got = found.join(spelling.roots(found), "word", "left").selectExpr("word", "form", "coalesce(root, word)", "n", "n_near", "form_n")
    want = brute_variants(brute_words(rows))
    assert multiset(got) == want
    assert sum(w[1] is not None for w in want) > 20


def test_spelling_query(spark, tmp_path):
    rows = word_rows()
    frame(spark, rows).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    assert multiset(REGISTRY["op13_spelling"](spark, str(tmp_path))) == brute_variants(brute_words(rows))
    assert spelling.group(frame(spark, [])).count() == 0
    assert spelling.group(frame(spark, [(1, "single words only")])).count() == 0


def test_long_chains_of_forms(spark):
    words = {"abcde" + "f" * k: 3 << k for k in range(18)}
    found = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert {r.root for r in spelling.roots(found).collect()} == {"abcde" + "f" * 17}
