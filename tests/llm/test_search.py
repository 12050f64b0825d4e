"""SimHash, nearest neighbours, sketches, components and the pipeline, against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from tests.llm.conftest import AWKWARD, documents, prose
from tests.oracle import connect, difference
from tillwright.llm import ann, mixing, registry, simhash, sketch
from tillwright.llm.components import components


def lowest_reachable(links, nodes):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n
    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_brute_force():
    assert all(simhash.fingerprint(t or "") == brute_print(t) for _, t, _ in AWKWARD)
    assert simhash.fingerprint(AWKWARD[6][1] * 3) == brute_print(AWKWARD[6][1] * 3)  # over one block of shingles


def test_near_duplicates_equal_brute_force(awkward, empty):
    got = {(r.doc_id, r.fp % (1 << 64)): r.component_id for r in simhash.near_duplicates(awkward).collect()}
    prints = {d: brute_print(t) for d, t, _ in AWKWARD if d is not None}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    want = lowest_reachable(near, prints)
    assert {k: v for k, v in got.items() if k[0] is not None} == {(d, p): want[d] for d, p in prints.items()}
    assert want[11] == want[2] == 1 and simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("most", [16384, 40])
def test_bk_shards_link_what_brute_force_links(spark, most):
    pick = np.random.default_rng(most)
    seeds = pick.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = [int(s) for s in seeds]
    for k in range(360):  # chains of near fingerprints, and one crowded neighbourhood
        source = prints[0] if k % 2 else prints[int(pick.integers(len(prints)))]
        for b in pick.integers(0, 64, int(pick.integers(0, 6))):
            source ^= 1 << int(b)
        prints.append(source)
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(dict.fromkeys(prints))]
    found = simhash.links(spark.createDataFrame(rows, "id long, fp long"), 4, most).collect()
    near = [(i, j) for i, p in rows for j, q in rows if i < j and ((p ^ q) % (1 << 64)).bit_count() <= 4]
    nodes = [i for i, _ in rows]
    assert {n for r in found for n in (r.a, r.b)} <= {n for pair in near for n in pair}
    assert lowest_reachable([(r.a, r.b) for r in found], nodes) == lowest_reachable(near, nodes)


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(300)] + [(7, 7), (5, 6)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, **{1000 + k: 1000 for k in range(1, 300)}}


def test_nearest_equals_brute_force(spark):
    pick = np.random.default_rng(2)
    rows = [(k, pick.normal(size=8 if k % 9 else 1100).round(1 if k % 2 else 3).tolist()) for k in range(400)]
    rows += [(500, rows[20][1]), (501, rows[20][1]), (40, rows[40][1]), (600, None), (602, [0.0] * 8), (604, [1.0, None] * 4),
             (606, [float("nan")] * 8), (608, [float("inf")] * 8), (None, rows[20][1]), (620, [1.0, 2.0, 3.0]), (640, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).withColumn("rank", F.lit(1))
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(table, F.col("id") % 20 == 0, 5, 64, 8).collect())
    fine = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    want = []
    for own, (q, asked) in enumerate(fine):
        near = []
        for other, (c, v) in enumerate(fine):
            if q % 20 == 0 and own != other and len(v) == len(asked):
                total = 0.0
                for x, y in zip(asked, v):
                    total += x * y
                near.append((-total, c))
        want += [(q, k, c, -s) for k, (s, c) in enumerate(sorted(near)[:5], 1)]
    assert got == sorted(want)
    assert ann.nearest(table.limit(0), F.col("id") % 20 == 0).count() == 0


def test_quantisation_bound_holds():
    pick = np.random.default_rng(4)
    a, b = pick.normal(size=(50, 70)), pick.normal(size=(60, 70)) * 1e-3
    (ca, sa, ha), (cb, sb, hb) = ann.quantised(a), ann.quantised(b)
    scale = sa[:, None] * sb[None, :]
    gap = np.abs(ann.products(ca, cb) * scale - a @ b.T)
    assert (gap <= scale * (ha[:, None] + hb[None, :] + 0.25 * 70) * (1 + 1e-9)).all()


def chain(values, seed=42):
    for v in values:
        seed = xxhash.xxh64_intdigest((v % (1 << 64)).to_bytes(8, "little"), seed)
    return seed


def all_hashes(text):
    words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in (text or "").lower().strip(" \t\n\x0b\x0c\r").replace("\t", " ").replace("\n", " ")
             .replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    return sorted({signed(chain(words[i:i + 5])) for i in range(max(1, len(words) - 4))}) if words else []


def brute_sketch(text, fraction=1 / 8, least=64):
    hashes = all_hashes(text)
    last = -(1 << 63) + int(fraction * (1 << 64)) - 1
    below = sum(h <= last for h in hashes)
    if below >= least:
        return hashes[:below], last
    return (hashes, (1 << 63) - 1) if len(hashes) <= least else (hashes[:least], hashes[least - 1])


def near(a, b):
    if not a[0] or not b[0]:
        return float(not a[0] and not b[0])
    x, y = ({h for h in s if h <= min(a[1], b[1])} for s in (a[0], b[0]))
    return len(x & y) / min(len(x), len(y)) if x and y else 0.0


def test_sketches_and_edits_equal_brute_force(awkward, empty):
    got = sorted(((-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited, *map(tuple, (r.sketch, r.edited_sketch, r.next_sketch)))
                  for r in sketch.edited_pairs(awkward).collect()), key=str)
    ids = sorted({d for d, _, _ in AWKWARD if d is not None}, reverse=True)
    texts = {d: t or "" for d, t, _ in AWKWARD}
    want = []
    for d, t, _ in AWKWARD:
        t = t or ""
        following = texts[ids[(ids.index(d) + 1) % len(ids)]] if d is not None else ""
        edited = t[:len(t) - len(t) // 3] + following[:len(t) // 3]
        want.append((-1 if d is None else d, len(t), edited, brute_sketch(t), brute_sketch(edited), brute_sketch(following)))
    assert got == sorted(want, key=str)
    assert sketch.edited_pairs(empty).count() == 0


def test_likeness_and_merging(spark):
    long, short, other = prose(1, 4000), " ".join(prose(1, 4000).split()[1000:1400]), prose(2, 40)
    df = spark.createDataFrame([(long, short, other, f"{short} {other}")], "a string, b string, c string, d string")
    for c in "abcd":
        df = sketch.with_sketch(df, c, f"s{c}")
    pairs = [(x, y) for x in "abcd" for y in "abcd"]
    r = df.select(*(sketch.containment(f"s{x}", f"s{y}").alias(x + y) for x, y in pairs), "sa", "sb", "sc", sketch.merged("sb", "sc").alias("both")).first()
    texts = {"a": long, "b": short, "c": other, "d": f"{short} {other}"}
    assert all(r[x + y] == pytest.approx(near(brute_sketch(texts[x]), brute_sketch(texts[y]))) for x, y in pairs)
    assert r.ab > 0.95 and r.bc < 0.05 and r.ad > 0.8 and r.cc == 1 and r.sc.upto == (1 << 63) - 1 > r.sb.upto > r.sa.upto
    every = {*all_hashes(short), *all_hashes(other)}
    assert list(r.both.hashes) == sorted(h for h in every if h <= r.both.upto) and len(r.both.hashes) >= 64


def test_containment_of_unequal_texts(spark, tmp_path):
    """Short texts are compared exactly, unequal ones with an error that the number of common hashes sets; nothing is null."""
    long = prose(3, 3000)
    words = long.split()
    rows = [(k, long, " ".join(words[k:k + 20 + 40 * k] + prose(100 + k, 10 * k).split())) for k in range(60)]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    got = sketch.with_sketch(sketch.with_sketch(df, "a", "sa"), "b", "sb").select("k", sketch.containment("sa", "sb").alias("c")).collect()
    sets = {k: ({*all_hashes(a)}, {*all_hashes(b)}) for k, a, b in rows}
    gaps = [r.c - len(sets[r.k][0] & sets[r.k][1]) / min(map(len, sets[r.k])) for r in got if r.k >= 20]
    assert np.sqrt(np.mean(np.square(gaps))) < 0.06 and abs(np.mean(gaps)) < 0.03
    texts = [(k, " ".join(words[20 * k:20 * k + 24])) for k in range(60)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    shingles = lambda t: {tuple(t.lower().split()[i:i + 5]) for i in range(max(1, len(t.split()) - 4))}
    found = {r.doc_id: r.near_edited for r in registry.op6_document_fingerprints(spark, str(tmp_path)).collect()}
    for d, t in texts:
        following = texts[d - 1][1] if d else texts[-1][1]
        a, b = shingles(t), shingles(t[:len(t) - len(t) // 3] + following[:len(t) // 3])
        assert found[d] == pytest.approx(len(a & b) / min(len(a), len(b)))


def test_rows_that_repeat_an_id_are_searched_each(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 2.0]), (1, [5.0, 2.0]), (20, [2.0, 0.0]), (20, [2.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, ann.nearest(rows, F.col("id") % 20 == 0, k=3).collect()))
    twin = [(20, 1, 1, 10.0), (20, 2, 20, 4.0), (20, 3, 0, 2.0)]
    assert got == sorted([(0, 1, 1, 5.0), (0, 2, 20, 2.0), (0, 3, 20, 2.0), *twin, *twin])


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_registered_queries_equal_their_twins(spark, folder, name):
    con = connect(folder)
    assert difference(registry.QUERIES[name](spark, folder), con, registry.ORACLES[name]) is None
    con.close()


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in registry.QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert {*registry.QUERIES, "pipeline"} <= set(driver.queries())


def test_pipeline_stages_on_awkward_rows(spark, awkward, empty, folder):
    for docs in (awkward, empty):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
            out = stage(spark, docs, folder)
            assert set(out.columns) <= set(docs.columns) and {"doc_id", "text", "lang", "source", "n_chars"} <= set(out.columns)
            ids = sorted((r.doc_id for r in out.select("doc_id").collect()), key=str)
            if docs is empty:
                assert not ids
            elif k == 1:
                assert ids == sorted((d for d, *_ in AWKWARD), key=str)
            elif k == 2:  # three empty texts, three equal pairs and the copies fold; the first of each group stays
                prints = [(d, brute_print(t)) for d, t, _ in AWKWARD if d is not None]
                groups = lowest_reachable([(a, b) for a, x in prints for b, y in prints if (x ^ y).bit_count() <= 4], [d for d, _ in prints])
                assert ids == sorted({groups[d] for d in groups} | {None}, key=str)
            else:
                assert {*ids} <= {d for d, *_ in AWKWARD}
    assert corpus_pipeline.tokenise(spark, awkward, folder).count() == len(AWKWARD)


def test_near_dedup_loses_no_unlike_text(spark):
    rows = [(7, prose(1, 50)), (7, prose(2, 50)), (7, prose(3, 50)), (7, prose(3, 50)), (9, prose(4, 50)), (8, prose(4, 50)), (None, prose(5, 50))]
    docs = documents(spark, [(d, t, "a") for d, t in rows])
    out = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()), key=str)
    assert out == sorted([rows[0], rows[1], rows[2], rows[5], rows[6]], key=str)


def test_pipeline_equals_its_stages_by_hand(spark, folder):
    """Line dedup and near dedup of the quality stage's rows by brute force, then their ids' digests."""
    docs = corpus_pipeline.quality_filter(spark, registry.table(spark, folder, "documents"), folder).collect()
    holders = {}
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    for r in docs:
        for line in r.text.split("\n"):
            holders.setdefault(key(line), set()).add(r.doc_id)
    texts = {r.doc_id: "\n".join(x for x in r.text.split("\n") if len(key(x)) < 40 or len(holders[key(x)]) < 5 or max(holders[key(x)]) == r.doc_id)
             for r in docs}
    prints = {d: brute_print(t) for d, t in texts.items()}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    kept = {d for d, c in lowest_reachable(links, prints).items() if d == c}
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} <= kept
    stayed = spark.createDataFrame([(d, s, texts[d]) for d, s in ((r.doc_id, r.source) for r in docs) if d in kept], "doc_id long, source string, text string")
    copies = Counter(r.doc_id for r in mixing.mix(stayed, mixing.rates(stayed)).select("doc_id").collect())
    assert Counter(r.doc_id for r in rows) == copies
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in rows)
