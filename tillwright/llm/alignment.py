"""Cross-tokenizer alignment by products of incidence matrices.

A text is encoded by two tokenizers. A matrix in compressed rows says which bytes
(or groups) each token touches; the row products A Bᵀ say which tokens of both sides
touch the same ones. Three incidences give three kinds of links: all bytes of a token
(``overlap``, with the number of shared bytes), its last byte (``ends``: byte ranges
that end together), and its group (``groups``: the text is cut wherever tokens of both
sides end). Texts of a batch are laid end to end, so the matrices are those of many
texts at once, block by block.

An id pair's count is how many ``ends`` links of the whole corpus hold it. The pairs
grow with the corpus up to the product of both vocabularies, so they stay a Spark
table: documents are dealt to blocks of ``BLOCK`` links, a block asks for the count of
each of its distinct pairs once, and no task holds more than a block's.

Null and empty texts have no tokens, nor have texts that one of the tokenizers doesn't
give back byte for byte. Repeated rows count each; they are dealt to blocks by row, not
by id or text, so no block fills with copies. Texts of any length are encoded whole.
An empty table gives an empty one. Only ``doc_id`` and the text are read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.llm import bpe
from tillwright.llm.common import slices
from tillwright.session import durable

BLOCK = 2_000_000  # links
HELD = 1_000_000  # different pairs that a counting task holds


class Csr(NamedTuple):
    """Row i has the entries ``columns[starts[i]:starts[i + 1]]``, all of them one."""

    starts: np.ndarray
    columns: np.ndarray
    width: int


def ranges(first: np.ndarray, last: np.ndarray, width: int) -> Csr:
    """Row i touches the columns from ``first[i]`` up to, but not with, ``last[i]``."""
    sizes = last - first
    starts = np.r_[0, np.cumsum(sizes)]
    return Csr(starts, np.arange(starts[-1]) + np.repeat(first - starts[:-1], sizes), width)


def transposed(matrix: Csr) -> Csr:
    rows = np.repeat(np.arange(len(matrix.starts) - 1), np.diff(matrix.starts))
    order = np.argsort(matrix.columns, kind="stable")
    return Csr(np.r_[0, np.cumsum(np.bincount(matrix.columns, minlength=matrix.width))], rows[order], len(matrix.starts) - 1)


def product(left: Csr, right: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the entries of left times right, row after row: each row adds up the rows of ``right`` that its entries name."""
    rows = np.repeat(np.arange(len(left.starts) - 1), np.diff(left.starts))
    sizes = np.diff(right.starts)[left.columns]
    place = np.arange(sizes.sum()) + np.repeat(right.starts[left.columns] - (np.cumsum(sizes) - sizes), sizes)
    key = np.repeat(rows, sizes) * right.width + right.columns[place]
    key, value = np.unique(key, return_counts=True)
    return key // max(right.width, 1), key % max(right.width, 1), value


class Side(NamedTuple):
    """Tokens of texts laid end to end: ids, and where their bytes end."""

    ids: np.ndarray
    ends: np.ndarray

    def firsts(self) -> np.ndarray:
        return np.r_[0, self.ends[:-1]]


def links(a: Side, b: Side, kind: str = "ends") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of linked tokens of both sides, and how many bytes (or groups) they share."""
    size = int(a.ends[-1]) if len(a.ends) else 0
    if kind == "ends":
        return product(ranges(a.ends - 1, a.ends, size), transposed(ranges(b.ends - 1, b.ends, size)))
    if kind == "overlap":
        return product(ranges(a.firsts(), a.ends, size), transposed(ranges(b.firsts(), b.ends, size)))
    of_a, of_b = groups(a, b, a.ends[links(a, b)[0]])
    n = int(of_a[-1]) + 1 if len(of_a) else 0
    return product(ranges(of_a, of_a + 1, n), transposed(ranges(of_b, of_b + 1, n)))


def groups(a: Side, b: Side, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token of both sides, from 0. ``cuts``: where tokens of both end."""
    return np.searchsorted(cuts, a.ends), np.searchsorted(cuts, b.ends)


# Byte-level vocabularies write these bytes as the characters of the same code, and the other ones as 256, 257, ... in order.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_level() -> dict[str, int]:
    others = (b for b in range(256) if b not in PRINTED)
    return {chr(b): b for b in PRINTED} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE file (JSON) run as ranks: its ids are the order of its merges, which is checked."""

    def __init__(self, raw: bytes, pattern: str):
        whole = json.loads(raw)
        model, split = whole["model"], whole["pre_tokenizer"]
        plain = (whole["normalizer"], model["type"], split["type"], split["use_regex"], split["add_prefix_space"])
        joined = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        ids = [model["vocab"][m.replace(" ", "", 1)] for m in joined]
        if plain != (None, "BPE", "ByteLevel", True, False) or model["ignore_merges"] or ids != sorted(set(ids)):
            raise ValueError("not a plain byte-level BPE whose ids are in merge order")
        special = {t["content"] for t in whole["added_tokens"]}
        code = byte_level()
        self.tokens = {i: bytes(map(code.__getitem__, t)) for t, i in model["vocab"].items() if t not in special}
        self.encoding = bpe.encoding_of({t: i for i, t in self.tokens.items()}, pattern)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [bpe.ids_of(self.encoding, f" {t}") for t in texts]


class Pieces:
    """A sentencepiece model; a piece stands for its UTF-8 with U+2581 as space, or for the byte it names."""

    def __init__(self, raw: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=raw)
        named = re.compile("<0x([0-9A-F]{2})>")
        pieces = enumerate(self.model.id_to_piece(list(range(self.model.vocab_size()))))
        self.tokens = {i: bytes([int(m[1], 16)]) if (m := named.fullmatch(p)) else p.replace("▁", " ").encode() for i, p in pieces}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(ids, np.int32) for ids in self.model.encode(texts, num_threads=1)]


class Pair:
    """Both tokenizers and their tables."""

    def __init__(self, raw_a: bytes, raw_b: bytes, pattern: str):
        self.a, self.b = ByteLevel(raw_a, pattern), Pieces(raw_b)
        self.bytes_a, self.bytes_b = bpe.Tokens(self.a.tokens), bpe.Tokens(self.b.tokens)
        self.width = len(self.bytes_b.sizes)
        marked = lambda n: [b"%d%s" % (i, mark) for i in range(n) for mark in (b",", b"|", b";", b"")]
        self.written = marked(max(len(self.bytes_a.sizes), self.width))

    def sides(self, texts: list[str]) -> tuple[Side, Side, np.ndarray, np.ndarray, np.ndarray]:
        """Both sides of the texts laid end to end, the tokens of each text, and where its bytes end; texts not given back have none."""
        kept, sizes = [], np.zeros(len(texts), np.int64)
        for k, (text, a, b) in enumerate(zip(texts, self.a.encode(texts), self.b.encode(texts))):
            raw = f" {text}".encode()
            if text and self.bytes_a.joined(a) == raw == self.bytes_b.joined(b):
                kept.append((a, b))
                sizes[k] = len(raw)
            else:
                kept.append((a[:0], b[:0]))
        a, b = (np.concatenate([np.zeros(0, np.int32), *x]) for x in zip(*kept))
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in zip(*kept))
        return Side(a, np.cumsum(self.bytes_a.sizes[a])), Side(b, np.cumsum(self.bytes_b.sizes[b])), n_a, n_b, np.cumsum(sizes)

    def layout(self, a: Side, b: Side, cuts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """Ids in the order of groups (A before B inside), each with the mark that follows it, and the byte that each token ends at."""
        of_a, of_b = groups(a, b, cuts)
        place = np.r_[of_a * 2, of_b * 2 + 1]
        order = np.argsort(place, kind="stable")
        place, ids, ends = place[order], np.r_[a.ids, b.ids][order], np.r_[a.ends, b.ends][order]
        last = np.r_[place[1:] != place[:-1], True][:len(place)]
        mark = np.where(last, 1 + place % 2, 0)
        return list(map(self.written.__getitem__, (ids.astype(np.int64) * 4 + mark).tolist())), ends


@functools.lru_cache(1)
def _pair(raw_a: bytes, raw_b: bytes, pattern: str) -> Pair:
    return Pair(raw_a, raw_b, pattern)


def linked(docs: DataFrame, path_a: str, path_b: str, pattern: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups_sha256, and the text's id pairs: ``pairs`` (longs a * ids of B + b, in order) and ``times``, as bytes."""
    shared = docs.sparkSession.sparkContext.broadcast((bpe.rank_bytes(path_a), bpe.rank_bytes(path_b)))
    added = "n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, pairs binary, times binary"
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(added).fields])

    def rows(pair: Pair, texts: list[str]) -> list[tuple]:
        a, b, n_a, n_b, sizes = pair.sides(texts)
        i, j, _ = links(a, b)
        code = a.ids[i].astype(np.int64) * pair.width + b.ids[j]
        text_of = np.searchsorted(sizes, a.ends[i])
        parts, ends = pair.layout(a, b, a.ends[i])
        stops = np.searchsorted(np.searchsorted(sizes, ends), np.arange(len(texts) + 1))
        at = np.searchsorted(text_of, np.arange(len(texts) + 1))
        out = []
        for k in range(len(texts)):
            joined = b"".join(parts[stops[k]:stops[k + 1]])[:-1]
            pairs, times = np.unique(code[at[k]:at[k + 1]], return_counts=True)
            n = int(at[k + 1] - at[k])
            out.append((n_a[k], n_b[k], n, hashlib.sha256(joined).hexdigest() if joined else "", n, pairs.tobytes(), times.astype(np.int32).tobytes()))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*shared.value, pattern)
        for batch in slices(batches, "text", 1 << 20):
            columns = zip(*rows(pair, [t.as_py() or "" for t in batch.column("text")]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, OUT))], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


OUT = pa.schema([("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()),
                 ("n_links", pa.int64()), ("pairs", pa.binary()), ("times", pa.binary())])


def packed(column: pa.ChunkedArray | pa.Array, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in column]


def pair_counts(placed: DataFrame, width: int) -> DataFrame:
    """pair, n (links that hold it in the corpus) and best: whether no pair of the same B id has more. ``width``: ids of B."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                every = np.concatenate([pairs, *packed(batch.column("pairs"), np.int64)])
                weight = np.concatenate([times, *packed(batch.column("times"), np.int32)])
                pairs, where = np.unique(every, return_inverse=True)
                times = np.bincount(where, weight, len(pairs)).astype(np.int64)
            if len(pairs) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(times)], ["pair", "n"])
                pairs, times = pairs[:0], times[:0]
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(times)], ["pair", "n"])

    counts = durable(placed.select("pairs", "times").mapInArrow(summed, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    named = counts.withColumn("b", F.col("pair") % width)
    highest = named.groupBy("b").agg(F.max("n").alias("highest"))
    return named.join(highest, "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def aligned(docs: DataFrame, path_a: str, path_b: str, pattern: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is its B id's most frequent), count_sum (over links) and groups_sha256."""
    width = len(Pieces(bpe.rank_bytes(path_b)).tokens)
    stored = durable(linked(docs, path_a, path_b, pattern).withColumn("row", F.monotonically_increasing_id()))
    total = stored.agg(F.sum("n_links")).first()[0] or 0
    placed = stored.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(1, -(-total // BLOCK)))).cast("int"))
    counts = pair_counts(stored, width)

    def asked(group: pa.Table) -> pa.Table:
        pairs = np.unique(np.concatenate(packed(group["pairs"], np.int64)))
        return pa.table({"block": pa.array(np.full(len(pairs), group["block"][0].as_py(), np.int32)), "pair": pairs})

    def summed(rows: pa.Table, answers: pa.Table) -> pa.Table:
        known = answers["pair"].to_numpy()
        order = np.argsort(known)
        known, n, best = known[order], answers["n"].to_numpy()[order], answers["best"].to_numpy()[order]
        pairs, times = packed(rows["pairs"], np.int64), packed(rows["times"], np.int32)
        ends = np.cumsum([0, *map(len, pairs)])
        at, times = np.searchsorted(known, np.concatenate(pairs)), np.concatenate(times).astype(np.int64)
        sums = lambda x: np.diff(np.r_[0, np.cumsum(x)][ends])
        found = {"n_best": sums(times * best[at]), "count_sum": sums(times * n[at])} if len(known) else {c: np.zeros(len(pairs), np.int64) for c in ("n_best", "count_sum")}
        return pa.table({c: rows[c] for c in kept[:-1]} | found | {"groups_sha256": rows["groups_sha256"]})

    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    answers = placed.select("block", "pairs").groupBy("block").applyInArrow(asked, "block int, pair long").join(counts, "pair").select("block", "pair", "n", "best")
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(
        "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string").fields])
    rows = placed.select("block", *kept, "pairs", "times")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(summed, schema)
