"""Byte-level BPE, chat formatting, line dedup and mixing, against brute force."""

import base64
import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm.conftest import AWKWARD, SHARED
from tillwright.llm import bpe, chat, linededup, mixing, registry


@pytest.fixture(scope="module")
def library():
    lines = open(registry.RANKS, "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_round_trip_equals_the_library(awkward, empty, library):
    encoded = bpe.decode(bpe.encode(awkward, registry.RANKS, public_tokenizers.PATTERN, keep=("doc_id", "copy")), registry.RANKS)
    got = sorted(((r.doc_id or -1, r.ids, bytes(r.decoded)) for r in encoded.collect()), key=str)
    assert got == sorted(((d or -1, library.encode_ordinary(t or ""), (t or "").encode()) for d, t, _ in AWKWARD), key=str)
    assert bpe.encode(empty, registry.RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_cuts_change_nothing(library):
    raw, pick = bpe.rank_bytes(registry.RANKS), random.Random(3)
    parts = ["a", "Z", "é", "'s", "'ll", "9", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "!", "_", "́", "日", "\r\n", "\x00", "😀"]
    for k in range(1500):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 40)))
        assert bpe.encode_text(text, raw, public_tokenizers.PATTERN).tolist() == library.encode_ordinary(text)
        assert bpe.encode_text(text, raw, public_tokenizers.PATTERN, limit=1 + k % 5).tolist() == library.encode_ordinary(text)
    long = "".join(pick.choice(["word", "9", "!", "'s", "é"]) for _ in range(20_000))
    assert len(list(bpe.chunks(long, 4096))) > 5 and "".join(bpe.chunks(long, 4096)) == long
    assert bpe.encode_text(long, raw, public_tokenizers.PATTERN, limit=4096).tolist() == library.encode_ordinary(long)
    for text in (" " * 300_000 + "a", "a" * 300_000, "\n\t" * 100_000, "é!" * 100_000):
        assert bpe.decode_ids(bpe.encode_text(text, raw, public_tokenizers.PATTERN), raw) == text.encode()
    assert bpe.encode_text(long, raw, public_tokenizers.PATTERN).tolist() == library.encode_ordinary(long)


TALK = [
    (1, 0, "system", "be <brief> \\ [x"), (1, 1, "user", "</s>[INST] a [/INST]"), (1, 2, "assistant", "<s>\\<\\/s>"),
    (2, 0, "assistant", "first"), (2, 0, "assistant", "first"), (3, 5, "user", None), (3, 2, None, "no role"), (3, 3, "tool [/ROLE]", "[/TURN]"),
    (None, 1, "user", "u"), (None, None, "user", "first of none"), (4, 0, "user", "q"), (4, 1, "assistant", ""),
]


def test_chat_reads_back_every_turn(spark):
    rows = spark.createDataFrame(TALK, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1))
    turns = chat.format_turns(rows)
    got = {r.conv_id: r for r in chat.digests(turns).collect()}
    by = defaultdict(list)
    for conv, turn, role, text in TALK:
        by[conv].append((turn if turn is not None else -1, role or "", text or ""))
    written = defaultdict(str)
    for r in turns.orderBy("conv_id", "position").collect():
        written[r.conv_id] += "".join(s.text for s in r.segments)
    assert got.keys() == by.keys()
    for conv, listed in by.items():
        order = [(role, text) for _, role, text in sorted(listed)]
        learned = "".join(t for r, t in order if r == "assistant")
        assert chat.Writer(chat.INSTRUCT).read(written[conv]) == order
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in order).encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert (got[conv].n_turns, got[conv].formatted_chars) == (len(order), len(written[conv]))
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: False, 3: False, None: False, 4: True}
    assert chat.digests(chat.format_turns(rows.limit(0))).count() == 0


def test_escaping_is_reversible_and_hides_controls():
    writer, pick = chat.Writer(chat.INSTRUCT), random.Random(5)
    parts = [*chat.INSTRUCT.controls(), "\\", "[", "<", "/", "a", " ", "\n"]
    for _ in range(3000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 9)))
        hidden = writer.escape(text)
        assert writer.unescape(hidden) == text and not any(c in hidden for c in chat.INSTRUCT.controls())
        role = pick.choice(["user", "assistant", "system", text])
        laid = "".join(s["text"] for s in writer.segments(role, text))
        assert writer.read_turn(laid) == (role, text, len(laid))


def line_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def test_line_dedup_equals_brute_force(awkward, empty):
    holders = defaultdict(set)
    for d, t, _ in AWKWARD:
        for line in (t or "").split("\n"):
            holders[line_key(line)].add(-1 if d is None else d)
    got = sorted(((r.doc_id or -1, r.text, r.n_lines, r.n_dropped) for r in linededup.cleaned(awkward, linededup.keep_bitmaps(awkward)).collect()), key=str)
    want = []
    for d, t, _ in AWKWARD:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(line_key(x)) < 40 or len(holders[line_key(x)]) < 5 or max(holders[line_key(x)]) == d]
        want.append((d or -1, "\n".join(stay), len(lines), len(lines) - len(stay)))
    assert got == sorted(want, key=str)
    assert sum(n for *_, n in got) >= 5 and any(SHARED in t for _, t, *_ in got)
    assert linededup.cleaned(empty, linededup.keep_bitmaps(empty)).count() == 0


def test_keep_bitmaps_are_runs(spark):
    rows = [(d, "\n".join([SHARED, SHARED, f"own{d}", SHARED]), "a") for d in range(6)]
    from tests.llm.conftest import documents
    runs = {r.doc_id: ([tuple(x) for x in r.dropped], r.n_dropped) for r in linededup.keep_bitmaps(documents(spark, rows)).collect()}
    assert runs == {d: ([(0, 1), (3, 3)], 3) for d in range(5)}


def test_line_in_a_third_of_all_rows_is_no_one_tasks(spark):
    """Adaptive execution off, 16 partitions: the largest has less than three times an even share, and every row meets its hash."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2000 + 100).alias("h1"), F.lit(1).cast("long").alias("h2"), F.col("id").alias("doc_id"),
        F.col("id").alias("row"))
    counts = rows.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for key, value in zip(old, ("false", "16", "-1")):
            spark.conf.set(key, value)
        got = linededup.met(rows, counts).select("h1", "doc_id", "n_docs", "keeper", F.spark_partition_id().alias("task")).collect()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    assert len(got) == 30_000 == len({r.doc_id for r in got}) and {r.keeper for r in got if r.h1 == 7} == {29_999 - 29_999 % 3}
    assert all((r.h1 == 7) == (r.doc_id % 3 == 0) for r in got) and {r.n_docs for r in got if r.h1 == 7} == {10_000}
    assert max(Counter(r.task for r in got).values()) < 3 * 30_000 / 16


def test_mixing_replicates_to_target_shares(spark, awkward, empty):
    rows = [(k, "x" * 99, "big" if k % 10 else "small") for k in range(4000)]
    from tests.llm.conftest import documents
    docs = documents(spark, rows)
    mixed = mixing.mix(docs, mixing.rates(docs, weights={"big": 1, "small": 1}))
    n = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(n["big"] - 2000) < 5 * 2000**0.5 and abs(n["small"] - 2000) < 5 * 2000**0.5
    order = [r.mix_key for r in mixed.select("mix_key").collect()]
    assert order == sorted(order)
    copies = Counter(r.doc_id for r in mixed.where("source = 'small'").collect())
    counts = Counter(copies.get(k, 0) for k in range(0, 4000, 10))
    assert abs(counts[0] - 400 * 2.718281828 ** -5) < 15 and max(counts) <= 20
    high = mixing.mix(docs, mixing.rates(docs, weights={"small": 1}, total=10)).count()  # rate 100, over one step
    assert abs(high - 40_000) < 5 * 200
    assert set(mixing.mix(awkward, mixing.rates(awkward)).columns) == {*awkward.columns} - {"_tw_bits"}
    assert mixing.mix(empty, mixing.rates(empty)).count() == 0
