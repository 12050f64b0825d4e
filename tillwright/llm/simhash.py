"""SimHash near-dedup with BK-trees.

A bit of a document's fingerprint is set if it is set in over half of the hashes
of its word shingles. Equal fingerprints fold into one class first. Classes at
``radius`` or fewer differing bits link: such a pair agrees in one of
``radius + 1`` bit bands at least, so fingerprints are sharded by (band, value of
the band). Every shard has a BK-tree: a node's children are keyed by their integer
distance to it, and a batch of queries follows only the edges within the radius.
A shard over ``most`` fingerprints is cut into slices; its slice trees are sent to
every task that holds queries of the shard, so no task grows with a hot value and
no link is lost. A tree emits a spanning forest of the links it finds, never all
pairs, and components come from alternating star steps.

Null and empty texts have fingerprint zero, linked like any other. Rows that
repeat a doc_id have fingerprints of their own. A row whose doc_id is null takes
the component of its fingerprint's other rows, null if there are none, and links
nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.llm.common import slices
from tillwright.llm.components import components
from tillwright.session import durable

SEED = 42
LEAF = 48


def fingerprint(text: str, words: int = 4) -> int:
    """The 64-bit SimHash of the whole text; bytes.lower and bytes.split know ASCII letters and spaces only."""
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    size = max(1, len(tokens) - words + 1)
    ones, block = np.zeros(64, np.int64), 1 << 15
    for start in range(0, size, block):
        part = tokens[start:start + block + words - 1]
        joined = [b" ".join(x) for x in zip(*(part[k:] for k in range(words)))] if len(tokens) >= words else [b" ".join(tokens)]
        hashes = np.array([xxhash.xxh64_intdigest(x, SEED) for x in joined], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > size, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 4, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """``doc`` and ``fp``, the fingerprint as a signed long, per row."""
    schema = T.StructType([docs.schema[doc], T.StructField("fp", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            prints = np.array([fingerprint(t or "", words) for t in batch.column(text).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(doc), pa.array(prints.view(np.int64))], [doc, "fp"])

    return docs.select(doc, text).mapInArrow(run, schema)


class Forest:
    """Sets of numbers 0..n-1 merged a batch at a time."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, items: np.ndarray) -> np.ndarray:
        up = self.parent[items]
        while True:
            above = self.parent[up]
            if (above == up).all():
                self.parent[items] = up
                return up
            up = above

    def merge(self, items: np.ndarray) -> None:
        roots = self.roots(items)
        self.parent[roots] = roots.min()


def bk_tree(prints: np.ndarray, items: np.ndarray) -> tuple:
    """(node, {distance: subtree}, None), or (-1, {}, items) for a leaf of a few items."""
    if len(items) <= LEAF:
        return -1, {}, items
    node, rest = items[0], items[1:]
    away = np.bitwise_count(prints[rest] ^ prints[node])
    return node, {int(d): bk_tree(prints, rest[away == d]) for d in np.unique(away)}, None


def bk_links(prints: np.ndarray, tree: tuple, queries: np.ndarray, radius: int, forest: Forest) -> None:
    """Merges every query with the items of the tree within ``radius`` of it."""
    stack = [(tree, queries)]
    while stack:
        (node, children, leaf), asked = stack.pop()
        if leaf is not None:
            near = np.bitwise_count(prints[asked][:, None] ^ prints[leaf][None, :]) <= radius
            for k in np.flatnonzero(near.any(0)):
                forest.merge(np.append(asked[near[:, k]], leaf[k]))
            continue
        away = np.bitwise_count(prints[asked] ^ prints[node]).astype(np.int16)
        hits = asked[away <= radius]
        if len(hits):
            forest.merge(np.append(hits, node))
        for d, child in children.items():
            follow = asked[np.abs(away - d) <= radius]
            if len(follow):
                stack.append((child, follow))


def _shard_links(prints: np.ndarray, ids: np.ndarray, sides: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (id, lowest id of its set) of one task: side 0 is the tree and, unless side 1 has rows, the queries too."""
    order = np.argsort(ids, kind="stable")
    prints, ids, sides = prints[order], ids[order], sides[order]
    forest, everything = Forest(len(ids)), np.arange(len(ids))
    queries = everything[sides == 1]
    bk_links(prints, bk_tree(prints, everything[sides == 0]), queries if len(queries) else everything, radius, forest)
    roots = forest.roots(everything)
    linked = roots != everything
    return ids[linked], ids[roots[linked]]


def links(classes: DataFrame, radius: int = 4, most: int = 16384) -> DataFrame:
    """Spanning links (a, b) between the ids of classes (id, fp) at ``radius`` or fewer bits, duplicates possible."""
    bands = radius + 1
    cuts = [64 * k // bands for k in range(bands + 1)]
    value = lambda k: F.shiftrightunsigned("fp", cuts[k]).bitwiseAND(F.lit((1 << (cuts[k + 1] - cuts[k])) - 1))
    spread = classes.select("id", "fp", F.posexplode(F.array(*(value(k) for k in range(bands)))).alias("band", "value"))
    large = spread.groupBy("band", "value").count().where(F.col("count") > most)
    large = large.select("band", "value", F.ceil(F.col("count") / most).cast("int").alias("n"))
    parted = spread.join(large, ["band", "value"], "left").withColumn("n", F.coalesce("n", F.lit(1)))
    own = F.pmod(F.xxhash64("id"), F.col("n")).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda k: F.struct(
        F.least(k, own).alias("i"), F.greatest(k, own).alias("j"), F.when(k < own, 1).otherwise(0).alias("side")))
    rows = parted.select("id", "fp", "band", "value", F.explode(tiles).alias("t")).select("id", "fp", "band", "value", "t.*")
    keys = ["band", "value", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            columns = np.stack([np.asarray(batch.column(c), np.int64) for c in [*keys, "id", "fp", "side"]])
            held.append(columns)
            joined = np.concatenate(held, axis=1)
            starts = np.flatnonzero(np.r_[True, (joined[:4, 1:] != joined[:4, :-1]).any(0)])
            yield from found(joined[:, :starts[-1]], starts[:-1])
            held = [joined[:, starts[-1]:]]
        if held:
            yield from found(held[0], np.array([0]))

    def found(rows: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        out = []
        for start, end in zip(starts, [*starts[1:], rows.shape[1]]):
            if end - start > 1:
                out.append(_shard_links(rows[5, start:end].view(np.uint64), rows[4, start:end], rows[6, start:end], radius))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["a", "b"])

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable over links), per row of ``docs``."""
    prints = durable(fingerprints(docs, words))
    classes = durable(prints.groupBy("fp").agg(F.min("doc_id").cast("long").alias("id")))
    found = components(links(classes.where("id IS NOT NULL"), radius))
    named = classes.join(found, classes.id == found.node, "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")
