"""Spelling variants, tokenizer alignment and MinHash near-duplicates, against brute force."""

import bisect
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from tests.llm.conftest import AWKWARD, documents
from tillwright.llm import alignment, bpe, minhash, spelling

JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
AWKWARD_TEXTS = [(d, t) for d, t, _ in AWKWARD]


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def brute_variants(rows, least_n, every):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % every == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            n[word] += 1
    words = {w: c for w, c in n.items() if len(w) >= 6 and c >= least_n}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def variant_rows(seed):
    pick = random.Random(seed)
    base = ["".join(pick.choice("abé") for _ in range(pick.randint(6, 9))) for _ in range(25)]
    rows = []
    for d in range(60):
        words = []
        for _ in range(120):
            w = base[min(int(pick.expovariate(0.25)), 24)]
            for _ in range(pick.choice([0, 0, 0, 0, 1, 1, 2])):
                k = pick.randrange(len(w))
                w = pick.choice([w[:k] + w[k + 1:], w[:k] + pick.choice("abéÿ") + w[k:], w[:k] + "É" + w[k + 1:]])
            words.append(pick.choice([w, w.upper() if w.isascii() else w, w.capitalize() if w[0] in "ab" else w]))
        rows.append((d, pick.choice([" ", "-", "7", "Ā"]).join(words)))
    return rows


@pytest.mark.parametrize("most", [1024, 7])
def test_variants_equal_brute_force(spark, most):
    rows = variant_rows(3) + [(None, "nulled nulled"), (7, None), (8, "")]
    got = spelling.variants(documents(spark, [(d, t, "a") for d, t in rows]), least_n=2, every=7, most=most)
    want = brute_variants(rows, 2, 7)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(w[1] is not None for w in want) > 20 and any(w[1] not in (None, w[2]) for w in want)


def test_variants_of_awkward_rows(spark, awkward, empty):
    got = sorted(map(tuple, spelling.variants(awkward).collect()), key=str)
    assert got == sorted(brute_variants(AWKWARD_TEXTS, 5, 199), key=str) and got
    assert spelling.variants(empty).count() == 0
    long = "ab" * 30_000
    texts = documents(spark, [(k, f"{long}x {long}y {long}", "a") for k in range(5)])
    assert {r.word[-1]: r.n_near for r in spelling.variants(texts, every=10**9).collect()} == {"x": 2, "y": 2, "b": 2}


def test_slips_follow_the_checksum():
    found = [(w, zlib.crc32(f"5:{w}".encode())) for w in map("".join, itertools.product("abcde", repeat=5))]
    for word, h in found:
        want = word if h % 11 else word[:h % 5] + word[h % 5 + 1:]
        assert spelling.slipped(word.encode(), zlib.crc32(b"5:"), 11).decode() == want


def shingles_of(text, words):
    tokens = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    tokens = re.findall("[^\x20\x09-\x0D]+", tokens)
    return {tuple(tokens[k:k + words]) for k in range(max(1, len(tokens) - words + 1))} if tokens else set()


def brute_near(rows, words, percent):
    """(doc_id, n_shingles, component_id, kept) of rows whose ids don't repeat with other texts."""
    sets = [(d, shingles_of(t, words)) for d, t in rows]
    up = list(range(len(sets)))

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, (a, x) in enumerate(sets):
        for j, (b, y) in enumerate(sets[:i]):
            if a is not None and b is not None and x and 100 * len(x & y) >= percent * len(x | y):
                up[top(i)] = top(j)
    least = {}
    for k, (d, x) in enumerate(sets):
        if d is not None:
            least[top(k)] = min(d, least.get(top(k), d))
    out = []
    for k, (d, x) in enumerate(sets):
        c = least.get(top(k))
        if d is None and x:
            c = next((least[top(j)] for j, (e, y) in enumerate(sets) if e is not None and x == y), None)
        out.append((d, len(x), c, d == c if d is not None and c is not None else c is None))
    return out


def near_rows(seed, n=220):
    pick = random.Random(seed)
    rows, word = [], lambda: "".join(pick.choice("abcdef") for _ in range(4))
    base = [[word() for _ in range(pick.choice([1, 2, 3, 8, 40, 200]))] for _ in range(30)]
    for d in range(n):
        text = list(pick.choice(base[:3] if d % 2 else base))
        for _ in range(pick.choice([0, 0, 1, 2, 4, 9])):
            text[pick.randrange(len(text))] = word()
        rows.append((d * 3 % 701, (" " if d % 3 else "\n\t").join(text).upper() if d % 5 else " ".join(text)))
    return rows


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    rows = near_rows(8)
    docs = documents(spark, [(d, t, "a") for d, t in rows])
    for words, percent in ((3, 85), (1, 50 + 35)):
        want = sorted(brute_near(rows, words, percent))
        assert sorted(map(tuple, minhash.near_duplicates(docs, words, percent).collect())) == want
        assert 10 < sum(not kept for *_, kept in want) < len(rows) - 10
    monkeypatch.setattr(minhash, "SLICE", 300)  # large groups are cut into slices
    sliced = minhash.near_duplicates(docs, 3, 85)
    assert sorted(map(tuple, sliced.collect())) == sorted(brute_near(rows, 3, 85))


def test_near_duplicates_of_awkward_rows(awkward, empty):
    got = sorted(map(tuple, minhash.near_duplicates(awkward, 3, 85).collect()), key=str)
    assert got == sorted(brute_near(AWKWARD_TEXTS, 3, 85), key=str)
    assert minhash.near_duplicates(empty).count() == 0


def test_sliced_candidates_lose_no_pair(spark):
    pick = np.random.default_rng(4)
    base = pick.integers(0, 256, (6, minhash.SYMBOLS))
    marks = np.repeat(base, 20, axis=0).astype(np.uint8)
    for row in marks:
        row[pick.choice(minhash.SYMBOLS, pick.integers(0, 20), replace=False)] = pick.integers(0, 256)
    rows = spark.createDataFrame([(k, bytearray(m.tobytes())) for k, m in enumerate(marks)], "class long, signature binary")
    near = [(i, j) for i in range(120) for j in range(i) if (marks[i] != marks[j]).sum() <= minhash.REACH]
    want = minhash.lowest(120, *map(np.array, zip(*near))).tolist()
    for most in (1024, 30, 4):
        found = [(r.a, r.b) for r in minhash.candidates(rows, most).collect()]
        assert minhash.lowest(120, *map(np.array, zip(*found))).tolist() == want


def test_signatures_estimate_similarity_and_seldom_miss():
    assert minhash.miss(0.85) < 1e-4 and minhash.miss(0.95) < 1e-9
    pick = np.random.default_rng(2)
    far = []
    for _ in range(400):
        flat = minhash.mixed(pick.integers(0, 1 << 62, 230).astype(np.uint64))
        a, b = minhash.signatures([np.sort(flat[:215]), np.sort(flat[15:])])  # 200 of 230
        far.append((a != b).sum())
    assert abs(np.mean(far) - 64 * (1 - 200 / 230) * 255 / 256) < 0.6 and max(far) <= minhash.REACH


def test_intersections_are_exact():
    pick = np.random.default_rng(1)
    sets = [np.unique(pick.integers(0, 9000, pick.integers(0, 9000))).astype(np.uint64) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) for b in sets[4:]] for a in sets[:4]]
    assert minhash.intersections(sets[:4], sets[4:]).tolist() == want


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(bpe.rank_bytes(JSON), bpe.rank_bytes(MODEL), public_tokenizers.PATTERN)


def brute_alignment(rows):
    """The query's figures by the tokenizers' own libraries and plain loops."""
    a = tokenizers.Tokenizer.from_file(JSON)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    code = alignment.byte_level()
    piece = lambda p: bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
    count, texts = Counter(), []
    for doc, text in rows:
        ids_a, ids_b = a.encode(f" {text or ''}", add_special_tokens=False).ids, b.encode(text or "")
        bytes_a, bytes_b = [bytes(code[c] for c in a.id_to_token(i)) for i in ids_a], [piece(b.id_to_piece(i)) for i in ids_b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == f" {text}".encode():
            texts.append((doc, [], [], [], ""))
            continue
        ends_a, ends_b = list(itertools.accumulate(map(len, bytes_a))), list(itertools.accumulate(map(len, bytes_b)))
        cuts = sorted({*ends_a} & {*ends_b})
        within = lambda ids, ends, s, c: ",".join(map(str, ids[bisect.bisect(ends, s):bisect.bisect(ends, c)]))
        parts = [(within(ids_a, ends_a, s, c), within(ids_b, ends_b, s, c)) for s, c in zip([0, *cuts], cuts)]
        at = dict(zip(ends_b, ids_b))
        linked = [(i, at[e]) for i, e in zip(ids_a, ends_a) if e in at]
        count.update(linked)
        texts.append((doc, ids_a, ids_b, linked, hashlib.sha256(";".join("|".join(p) for p in parts).encode()).hexdigest()))
    highest = {}
    for (_, y), n in count.items():
        highest[y] = max(n, highest.get(y, 0))
    return [(doc, len(x), len(y), len(linked), len(linked), sum(count[p] == highest[p[1]] for p in linked), sum(count[p] for p in linked), digest)
            for doc, x, y, linked, digest in texts]


def alignment_texts(seed):
    pick = random.Random(seed)
    parts = ["the", " and ", "é", "日本", "  ", "\n", "\t", "▁", "<0x41>", "</s>", "<|endoftext|>", "'s", "12", "ﬁ", "😀", "Word", "\x00", " "]
    return [(k, "".join(pick.choice(parts) for _ in range(pick.randint(0, 30)))) for k in range(150)]


def test_alignment_equals_brute_force(spark, awkward, empty, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", 500)
    for rows, docs in ((AWKWARD_TEXTS, awkward), (alignment_texts(6), None)):
        docs = docs or documents(spark, [(d, t, "a") for d, t in rows])
        got = alignment.aligned(docs, JSON, MODEL, public_tokenizers.PATTERN)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(brute_alignment(rows), key=str)
    assert alignment.aligned(empty, JSON, MODEL, public_tokenizers.PATTERN).count() == 0


def test_products_give_overlap_and_group_links(pair):
    for _, text in alignment_texts(9)[:60]:
        a, b, n_a, n_b, _ = pair.sides([text, "other text", ""])
        of_a, of_b = alignment.groups(a, b, a.ends[alignment.links(a, b)[0]])
        spans = lambda s: list(zip(s.firsts().tolist(), s.ends.tolist()))
        overlap = [(i, j, min(p[1], q[1]) - max(p[0], q[0])) for i, p in enumerate(spans(a)) for j, q in enumerate(spans(b)) if max(p[0], q[0]) < min(p[1], q[1])]
        assert list(zip(*(x.tolist() for x in alignment.links(a, b, "overlap")))) == overlap
        grouped = [(i, j, 1) for i, x in enumerate(of_a) for j, y in enumerate(of_b) if x == y]
        assert list(zip(*(x.tolist() for x in alignment.links(a, b, "groups")))) == grouped


def test_product_equals_dense_matrices():
    pick = np.random.default_rng(5)
    dense = [(pick.random((k, 9)) < 0.3) for k in (7, 5)]
    sparse = [alignment.Csr(np.r_[0, np.cumsum(d.sum(1))], np.nonzero(d)[1], 9) for d in dense]
    rows, columns, values = alignment.product(sparse[0], alignment.transposed(sparse[1]))
    out = np.zeros((7, 5), int)
    out[rows, columns] = values
    assert (out == dense[0].astype(int) @ dense[1].T.astype(int)).all()
