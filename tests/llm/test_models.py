"""Language model, toxicity and quality: exact counts, brute force and held-out accuracy."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import suffix_tree
from tests.llm.conftest import AWKWARD, documents, prose
from tillwright.llm import pst, quality, registry, toxicity
from tillwright.llm.common import remainder, table


def test_lm_base_and_counts_equal_brute_force(awkward, empty):
    got = sorted(pst.score(awkward, remainder("doc_id", 10) == 0).collect(), key=lambda r: (r.doc_id or -1, r.n_tokens))
    held = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 10 == 0
    counts = Counter(w for d, t, _ in AWKWARD if not held(d) for w in [*pst.tokens(t or ""), pst.END])
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(AWKWARD)
    for r, (d, t, _) in zip(got, sorted(AWKWARD, key=lambda x: (x[0] or -1, len(pst.tokens(x[1] or ""))))):
        words = [*pst.tokens(t or ""), pst.END]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (d, held(d), len(words), sum(counts[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    assert pst.score(empty, remainder("doc_id", 10) == 0).count() == 0


def test_lm_alone_in_the_hold_out(spark):
    only = documents(spark, [(None, "a b a", "x")])
    assert [(r.n_tokens, r.n_known, r.base_score) for r in pst.score(only, remainder("doc_id", 10) == 0).collect()] == [(4, 0, 0.0)]


def test_lm_beats_the_base_on_held_out_texts(spark, folder):
    r = registry.op1_lm_scoring(spark, folder).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def brute_runs(texts, least):
    found = Counter()
    for text in texts:
        s = [*pst.tokens(text), pst.END]
        for size in range(2, pst.DEPTH + 2):
            found.update(b" ".join(s[i:i + size]) for i in range(len(s) - size + 1))
    return {r: n for r, n in found.items() if n >= least}


TEXTS = ["a b c a b c a b d", "c a b c", "", "a a a a", "b c a b c e f", "e f"] * 2


def test_lm_runs_are_exact_in_chunks(monkeypatch):
    chunk = pst.Chunk()
    for text in TEXTS:
        chunk.add(text)
    want = brute_runs(TEXTS, 4)
    assert set(suffix_tree.frequent(chunk, 4)) == set(want)
    names, numbers, place = chunk.arrays()
    every = sorted({*want, *(w for r in want for w in r.split(b" "))}, key=suffix_tree.code_of)
    runs = suffix_tree.Runs([r for r in every if b" " not in r], [suffix_tree.code_of(r) for r in every])
    counts = np.zeros(len(every), int)
    for slots in runs.ending(runs.of(names)[numbers], place):
        counts += np.bincount(slots[slots >= 0], minlength=len(counts))
    assert {r: n for r, n in zip(every, counts) if b" " in r} == want


def test_lm_is_a_distribution_over_the_next_symbol():
    chunk = pst.Chunk()
    for text in TEXTS:
        chunk.add(text)
    names, numbers, place = chunk.arrays()
    times = np.bincount(numbers)
    root = (times + 0.1) / (times.sum() + 0.1 * (len(names) + 1))
    counts = brute_runs(TEXTS, 2) | {w: int(n) for w, n in zip(names, times)}
    tree = suffix_tree.grow(counts, dict(zip(names, root)), 0.5)
    assert (tree.rest < 1).sum() > 3
    for context in ([], [b"a"], [b"a", b"b"], [b"c", b"a", b"b"], [b"e"], [b"f", b"a"]):
        total = 0.1 / (times.sum() + 0.1 * (len(names) + 1)) * np.prod([1.0])
        p_unknown, sums = None, 0.0
        for w in [*names, b"never"]:
            line = [*context, w]
            single = tree.runs.of(line)
            base = np.array([root[names.index(x)] if x in names else total for x in line])
            p = 10 ** tree.log10(single, np.arange(len(line)), base)[-1]
            sums += p
        assert sums == pytest.approx(1, abs=1e-9)


def test_lm_bar_does_not_rise_with_the_corpus(spark):
    """A run seen three times shapes scores among four million other symbols too."""
    rare = spark.createDataFrame([(k, "alpha beta gamma") for k in range(4)], "doc_id long, text string")
    filler = spark.range(1).select((F.col("id") + 100).alias("doc_id"), F.repeat(F.lit("z "), 4_000_000).alias("text"))
    r = pst.score(rare.union(filler), F.col("doc_id") == 0).where("held_out").first()
    assert r.score > r.base_score + 3


def test_lm_tables_equal_the_tree_in_memory_and_pass_by_the_driver(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")

    def refused(*_):
        raise AssertionError("runs or tree went through the driver")

    monkeypatch.setattr(type(docs), "toArrow", refused)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", refused)
    got = {r.doc_id: r.score for r in pst.score(docs, F.lit(False), gain=0.5).collect()}
    chunk = pst.Chunk()
    for text in TEXTS:
        chunk.add(text)
    names, numbers, place = chunk.arrays()
    times = np.bincount(numbers)
    root = (times + 0.1) / (times.sum() + 0.1 * (len(names) + 1))
    tree = suffix_tree.grow(brute_runs(TEXTS, 2) | {w: int(n) for w, n in zip(names, times)}, dict(zip(names, root)), 0.5)
    each = tree.log10(tree.runs.of(names)[numbers], place, root[numbers])
    assert [got[k] for k in range(len(TEXTS))] == pytest.approx(np.add.reduceat(each, np.flatnonzero(place == 0)).tolist())


def test_lm_small_blocks_hot_words_and_many_tasks_equal_the_tree_in_memory(spark):
    """Every word dealt to several tasks, a block or two texts each, held-out texts with words of their own."""
    pick = np.random.default_rng(8)
    texts = TEXTS + [" ".join(pick.choice(list("abcdefgh"), int(pick.integers(0, 30)), p=[0.4, 0.2, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05])) for _ in range(80)]
    held = [*["new a b c", "a b new c a b"], *texts[::7]]
    docs = spark.createDataFrame([*enumerate(texts), *((1000 + k, t) for k, t in enumerate(held))], "doc_id long, text string")
    chunk, everything = pst.Chunk(), pst.Chunk()
    for text in texts:
        chunk.add(text)
    names, numbers, _ = chunk.arrays()
    times = np.bincount(numbers)
    root = (times + 0.1) / (times.sum() + 0.1 * (len(names) + 1))
    tree = suffix_tree.grow(brute_runs(texts, 2) | {w: int(n) for w, n in zip(names, times)}, dict(zip(names, root)), 0.5)
    for text in texts + held:
        everything.add(text)
    known, (every, numbers, place) = dict(zip(names, root)), everything.arrays()
    base = np.array([known.get(w, 0.1 / (times.sum() + 0.1 * (len(names) + 1))) for w in every])
    want = np.add.reduceat(tree.log10(tree.runs.of(every)[numbers], place, base[numbers]), np.flatnonzero(place == 0))
    for sizes in ({"hot": 10, "share": 150, "block": 60}, {"hot": 1, "share": 50, "block": 200}, {"share": 100}, {}):
        got = {r.doc_id: r.score for r in pst.score(docs, F.col("doc_id") >= 1000, gain=0.5, **sizes).collect()}
        assert [got[k] for k in [*range(len(texts)), *range(1000, 1000 + len(held))]] == pytest.approx(want.tolist())


@pytest.mark.parametrize("columns", [[[]], [[0, 0, 0]], [[1, 2**63, 255, 256], [7], []], [list(range(70_000))],
                                     *([[5] * k + list(range(j))] for k in range(0, 60, 3) for j in range(4))])
def test_lm_columns_of_bytes_come_back(columns):
    arrays = [np.array(c, np.uint64) for c in columns]
    assert [x.view(np.uint64).tolist() for x in pst.unpacked(pst.packed(*arrays))] == columns


def test_ordinal_model_orders_four_grades():
    pick = np.random.default_rng(1)
    words = [f"w{k}" for k in range(8)]
    texts, grades = [], []
    for _ in range(400):
        g = int(pick.integers(4))
        texts.append(" ".join(pick.choice(words[2 * g:2 * g + 2], 12)) + " " + " ".join(pick.choice(words, 6)))
        grades.append(float(g))
    rows = [quality.features(t) for t in texts]
    model = quality.fit(rows[:300], grades[:300])
    assert (np.diff(model.thresholds) > 0).all() and model.grades == [0, 1, 2, 3]
    guesses = [model.expected(model.above(x)) for x in rows[300:]]
    assert np.corrcoef(guesses, grades[300:])[0, 1] > 0.8
    above = model.above(rows[0])
    assert (np.diff(above) <= 0).all() and ((above >= 0) & (above <= 1)).all()


def test_ordinal_gradient_matches_differences():
    rows = [quality.features(t) for t in ("a b", "b c", "c d", "d e", "a e", "b")]
    model = quality.fit(rows, [0, 1, 2, 1, 0, 2], rounds=400, decay=0.0)
    likely = [np.diff(np.concatenate([[0], 1 - model.above(x), [1]]))[g] for x, g in zip(rows, [0, 1, 2, 1, 0, 2])]
    assert min(likely) > 0.8  # separable: the likelihood climbs towards one


def test_quality_without_labels_and_with_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (1, None)], "doc_id long, quality int")
    assert quality.train(awkward, labels).grades == [1.0] and quality.train(awkward, labels.limit(0)).grades == []
    two = spark.createDataFrame([(4, 1), (5, 0), (6, 1)], "doc_id long, quality int")
    rated = quality.score(awkward, quality.train(awkward, two)).collect()
    assert len(rated) == len(AWKWARD) and all(0 <= r.rating.tail <= 1 for r in rated)
    assert quality.score(empty, quality.train(empty, two)).count() == 0


def test_quality_on_held_out_labels(spark, folder):
    rated = registry.op10_quality(spark, folder.replace("sf0.001", "sf0.01"))
    joined = rated.where("held_out").join(table(spark, folder.replace("sf0.001", "sf0.01"), "labels"), "doc_id").collect()
    kept = [r.selected for r in joined if r.quality == 1]
    assert sum(kept) / len(kept) > 0.9
    assert sum(r.selected == (r.quality == 1) for r in joined) / len(joined) > 0.85


def test_short_way_for_plain_tokens():
    tokens = toxicity.Tokens({"fool": 3.0, "abcde*": 2.0, "aaa": 1.0})
    for t in ["fool", "abcdef", "abcde", "aaa", "you", "é", "ñandú", "x" * 60, "ß", "a", "plainword"]:
        assert tokens.plain(t) == tokens.measured(t)


def test_toxicity_features():
    tokens = toxicity.Tokens({"fool": 3.0, "abcde*": 2.0})
    plain, hidden = toxicity.dense("you fool!", tokens), toxicity.dense("f.0.0.l abcdefg", tokens)
    assert plain[0] == 0.5 and plain[7] == 0.5 and hidden[0] == 0 and hidden[1] == 0.5 and hidden[2] == 0.5
    far = toxicity.dense("you " + "x " * 9 + "fool", tokens)
    assert far[7] == 0 and toxicity.dense("", tokens) == [0.0] * 16


def test_toxicity_learns_and_calibrates(spark, empty):
    rows = [(k, prose(k, 30) + (" you rotten swine" if k % 5 == 0 else ""), "a") for k in range(600)]
    rows += [(1000, None, "a"), (1001, "", "a"), (1002, "rotten swine " * 20_000, "a"), (None, "x", "a"), (3, "again", "a")]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(400)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.Model(docs, labels)
    scores = {r.doc_id: r.score for r in model.score(docs).where("doc_id >= 400 OR doc_id IS NULL").collect()}
    assert len(model.score(docs).collect()) == len(rows) and all(0 <= s <= 1 for s in scores.values())
    assert all((scores[k] >= 0.3) == (k % 5 == 0) for k in range(400, 600)) and scores[1002] >= 0.3 and scores[1001] < 0.3
    assert model.score(empty).count() == 0
    none = toxicity.Model(docs, labels.limit(0))
    assert {r.score for r in none.score(docs).collect()} == {0.0}


def test_toxicity_on_held_out_labels(spark, folder):
    found = registry.op7_toxicity(spark, folder.replace("sf0.001", "sf0.01")).where("held_out")
    joined = found.join(table(spark, folder.replace("sf0.001", "sf0.01"), "labels"), "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in joined) / len(joined) > 0.9
