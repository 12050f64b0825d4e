"""MinHash near-dedup by a multi-index Hamming join.

A document is its set of word shingles. Equal sets fold into one class first. A
class has a signature of ``SYMBOLS`` numbers of 8 bits, the low bits of the least
shingle hash under as many permutations; two sets of similarity s differ in each with
probability (1 - s) * 255 / 256. The signature is cut into ``CHUNKS`` chunks. Two
signatures that differ in ``REACH`` = 2 * CHUNKS - 1 symbols at most differ in one
symbol or none within one of the chunks at least (pigeonhole), so a class is filed
under every chunk with each of its symbols left out in turn: all pairs within the
distance meet. At a similarity of 0.85 a pair passes the distance with a probability
of over 0.9999 (``miss``), and nearer ones with more.

Classes that meet are compared by signature, tile by tile; a tile hands on a spanning
forest of the near ones, never all pairs. Links can then exist only inside the
components of those forests. Each class of such a component sends its whole set there
once (or once per tile, where the component is cut into slices), and sizes of
intersections come from products of incidence matrices, so links are exact. They are
handed on as spanning forests too, and components come from alternating star steps.

Words are runs of characters other than ASCII white space, A-Z lowered; a text of
fewer words than a shingle is one shingle; without words, or null, it is the empty
set, linked with nothing and kept. Rows that repeat a doc_id have sets of their own.
A row without doc_id takes the component of equal sets and links nothing itself; it
is kept where it has none. Ties don't arise, since all links within reach count. An
empty table gives an empty one. Only ``doc_id`` and the text are read. A text is read
whole; its set is held by one task at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.llm.common import runs_of, slices
from tillwright.llm.components import components
from tillwright.session import durable

SYMBOLS = 64
CHUNKS = 12
REACH = 2 * CHUNKS - 1
CUTS = [SYMBOLS * k // CHUNKS for k in range(CHUNKS + 1)]
SLICE = 1_000_000  # shingles of a slice of a component
ROWS = 1024  # classes of a slice
FILTER = 1 << 23  # bits
ODD = np.uint64(0x9E3779B97F4A7C15)


def miss(similarity: float) -> float:
    """Probability that the signatures of a pair differ in more than ``REACH`` symbols."""
    p = (1 - similarity) * 255 / 256
    return 1 - sum(math.comb(SYMBOLS, k) * p**k * (1 - p) ** (SYMBOLS - k) for k in range(REACH + 1))


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


PERMUTATIONS = mixed(np.arange(1, 2 * SYMBOLS + 1, dtype=np.uint64) * ODD).reshape(2, -1)


class Words(dict):
    """Hashes of words; at most ``most`` of them are remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word)
        return code


def shingle_set(text: str, words: int, known: Words) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles; a shingle's hash depends on its words, their order and number."""
    tokens = text.encode().lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    size = min(words, len(codes))
    total = np.full(len(codes) - size + 1, size, np.uint64)
    for k in range(size):
        total = mixed(total * ODD + codes[k:len(codes) - size + 1 + k])
    return np.unique(total)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of ``SYMBOLS`` bytes per non-empty set."""
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    flat = np.concatenate(sets)
    out = np.empty((len(sets), SYMBOLS), np.uint8)
    for k, (a, b) in enumerate(PERMUTATIONS.T):
        least = np.minimum.reduceat((flat ^ b) * (a | np.uint64(1)), starts)
        out[:, k] = mixed(least).astype(np.uint8)
    return out


def class_of(found: np.ndarray) -> int:
    """A signed 64-bit name of the set."""
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def prints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, n_shingles, class and signature per row; the latter two are null for empty sets."""
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("n_shingles long, class long, signature binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in slices(batches, "text", 4 << 20):
            sets = [shingle_set(t.as_py() or "", words, known) for t in batch.column("text")]
            full = [k for k, x in enumerate(sets) if len(x)]
            names, marks = [None] * len(sets), [None] * len(sets)
            if full:
                for k, row in zip(full, signatures([sets[k] for k in full])):
                    names[k], marks[k] = class_of(sets[k]), row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(names, pa.int64()), pa.array(marks, pa.binary())], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def filed(classes: DataFrame) -> DataFrame:
    """key and class: a class under each chunk of its signature with each symbol left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                batch = whole.slice(start, 2000)
                marks = np.frombuffer(b"".join(x.as_buffer() for x in batch.column("signature")), np.uint8).reshape(-1, SYMBOLS).astype(np.uint64)
                for chunk in range(CHUNKS):
                    for out in range(CUTS[chunk], CUTS[chunk + 1]):
                        code = np.full(len(marks), chunk * SYMBOLS + out, np.uint64)
                        for k in range(CUTS[chunk], CUTS[chunk + 1]):
                            if k != out:
                                code = mixed(code * ODD + marks[:, k])
                        yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), batch.column("class")], ["key", "class"])

    return classes.select("class", "signature").mapInArrow(run, "key long, class long")


def lowest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lowest number of each of 0..n-1's component over links (a, b)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            return label


def forest(names: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Spanning links of the links (a, b) between rows, as pairs of names."""
    label = lowest(len(names), a, b)
    rows = np.flatnonzero(label != np.arange(len(names)))
    return pa.RecordBatch.from_arrays([pa.array(names[rows]), pa.array(names[label[rows]])], ["a", "b"])


def meeting(marks: np.ndarray, starts: np.ndarray, across: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b) of the same group whose signatures are within reach; in groups across two slices, rows of different sides only."""
    sizes = np.diff(np.r_[starts, len(marks)])
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    few = np.flatnonzero(sizes <= 16)
    for lag in range(1, 16):  # small groups: all of them at once
        of = few[sizes[few] > lag]
        count = sizes[of] - lag
        a = np.arange(count.sum()) + np.repeat(starts[of] - (np.cumsum(count) - count), count)
        fits = ~np.repeat(across[of], count) | (side[a] != side[a + lag])
        for part in np.array_split(a[fits], 1 + fits.sum() // 50_000):
            near = (marks[part] != marks[part + lag]).sum(1) <= REACH
            found.append((part[near], part[near] + lag))
    for group in np.flatnonzero(sizes > 16):
        rows = np.arange(starts[group], starts[group] + sizes[group])
        left, right = (rows[side[rows] == 0], rows[side[rows] == 1]) if across[group] else (rows, rows)
        for start in range(0, len(left), 64):
            part = left[start:start + 64]
            near = (marks[part][:, None, :] != marks[right][None, :, :]).sum(2, dtype=np.uint8) <= REACH
            i, j = np.nonzero(near)
            i, j = part[i], right[j]
            found.append((i[i < j], j[i < j]) if not across[group] else (i, j))
    return tuple(np.concatenate(x) for x in zip(*found))


def group_starts(*columns: np.ndarray) -> np.ndarray:
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def tiles(rows: DataFrame, keys: list[str], parts: str) -> DataFrame:
    """``rows`` with i, j, side: each row goes to every pair of slices of its group that holds its own, dealt by pair and sorted."""
    own = F.pmod(F.xxhash64("class"), F.col(parts)).cast("int")
    every = F.transform(F.sequence(F.lit(0), F.col(parts) - 1), lambda k: F.struct(
        F.least(k, own).alias("i"), F.greatest(k, own).alias("j"), F.when(k < own, 1).otherwise(0).alias("side")))
    kept = [c for c in rows.columns if c != parts]
    spread = rows.select(*kept, F.explode(every).alias("t")).select(*kept, "t.*")
    return spread.repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j", "side")


def candidates(classes: DataFrame, most: int = ROWS) -> DataFrame:
    """Spanning links (a, b) of the classes (class, signature) within reach of each other, duplicates possible."""
    keyed = filed(classes)
    sizes = keyed.groupBy("key").count().where("count > 1").select("key", F.ceil(F.col("count") / most).cast("int").alias("parts"))
    met = keyed.join(sizes, "key").join(classes.select("class", "signature"), "class").select("key", "class", "signature", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of(batches, None, ["key", "i", "j"]):
            names, i, j, side = (rows[c].to_numpy() for c in ("class", "i", "j", "side"))
            marks = np.frombuffer(b"".join(x.as_buffer() for x in rows["signature"]), np.uint8).reshape(-1, SYMBOLS)
            starts = group_starts(rows["key"].to_numpy(), i, j)
            a, b = meeting(marks, starts, i[starts] != j[starts], side)
            if len(a):
                every, place = np.unique(names, return_inverse=True)  # a class meets others under several keys
                yield forest(every, place[a], place[b])

    return tiles(met, ["key"], "parts").mapInArrow(run, "a long, b long")


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of the left with all of the right: products of 0/1 matrices, a block of shingles at a time."""
    flat = np.concatenate([*left, *right])
    every, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in [*left, *right]])
    shared = times[column] > 1
    row, column = row[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(column.max(initial=-1)) + 1, 4096):
        part = slice(*np.searchsorted(column, [start, start + 4096]))
        block = np.zeros((len(left) + len(right), 4096), np.float32)
        block[row[part], column[part] - start] = 1
        total += block[:len(left)] @ block[len(left):].T
    return total.astype(np.int64)


def confirmed(sets: list[np.ndarray], side: np.ndarray, across: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b) with 100 * intersection >= percent * union. ``across``: only pairs of different sides."""
    sizes = np.array([len(x) for x in sets], np.int64)
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if across else (np.arange(len(sets)),) * 2
    if not len(left) or not len(right):
        return left[:0], left[:0]
    if len(sets) == 2:
        both = np.array([[len(np.intersect1d(sets[0], sets[1], assume_unique=True))]])
        left, right = np.array([0]), np.array([1])
    else:
        both = intersections([sets[k] for k in left], [sets[k] for k in right])
    i, j = np.nonzero(100 * both >= percent * (sizes[left][:, None] + sizes[right][None, :] - both))
    return left[i], right[j]


def filter_of(members: DataFrame) -> np.ndarray:
    """A filter of ``FILTER`` bits with a bit for each hashed doc_id; so many bits at any size, and full ones only let more texts through."""
    hashed = members.select(F.xxhash64("doc_id").alias("h"))
    words = hashed.selectExpr(f"shiftrightunsigned(h, 6) & {FILTER // 64 - 1} AS word", "shiftleft(1L, cast(h & 63 AS int)) AS bits")
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER // 64, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint64)


def links(docs: DataFrame, classes: DataFrame, found: DataFrame, words: int, percent: int) -> DataFrame:
    """Spanning links (a, b) between classes (class, doc_id, n_shingles) whose sets are similar, among components (node, component).

    Texts are read again, and those of other documents dropped by a filter of fixed size before anything is shuffled.
    """
    members = durable(found.union(found.select(F.col("component").alias("node"), "component").distinct())
                      .select(F.col("node").alias("class"), "component").join(classes.select("class", "doc_id", "n_shingles"), "class"))
    parts = members.groupBy("component").agg(F.greatest(F.ceil(F.sum("n_shingles") / SLICE), F.ceil(F.count("*") / ROWS)).cast("int").alias("parts"))
    asked = members.join(parts, "component").select("doc_id", "class", "component", "parts")
    shared = docs.sparkSession.sparkContext.broadcast(filter_of(members))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = Words(), shared.value
        for whole in batches:
            h = whole.column("h").to_numpy().view(np.uint64)
            there = (bits[(h >> np.uint64(6)) & np.uint64(len(bits) - 1)] >> (h & np.uint64(63))) & np.uint64(1)
            for batch in slices([whole.take(pa.array(np.flatnonzero(there)))], "text", 4 << 20):
                sets = [shingle_set(t.as_py() or "", words, known) for t in batch.column("text")]
                full = [k for k, x in enumerate(sets) if len(x)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(full, pa.int64())), pa.array([class_of(sets[k]) for k in full], pa.int64()),
                     pa.array([sets[k].tobytes() for k in full], pa.binary())], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs_of(batches, None, ["component", "i", "j"]):
            names, i, j, side = (rows[c].to_numpy() for c in ("class", "i", "j", "side"))
            starts = group_starts(rows["component"].to_numpy(), i, j)
            for start, end in zip(starts, [*starts[1:], len(names)]):
                own = names[start:end]
                _, first = np.unique(own, return_index=True)  # rows that repeat id and text
                first.sort()
                sets = [np.frombuffer(rows["shingles"][int(start + k)].as_buffer(), np.uint64) for k in first]
                a, b = confirmed(sets, side[start:end][first], i[start] != j[start], percent)
                yield forest(own[first], a, b)

    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("class long, shingles binary").fields])
    sets = docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("doc_id").alias("h"), "text").mapInArrow(read, schema)
    sets = sets.join(asked, ["doc_id", "class"]).select("component", "class", "parts", "shingles")
    return tiles(sets, ["component"], "parts").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept, per row of ``docs``."""
    rows = durable(prints(docs, words))
    classes = durable(rows.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("n_shingles"), F.min("signature").alias("signature")))
    named = classes.where("doc_id IS NOT NULL")
    found = components(links(docs, named, components(candidates(named)), words, percent))
    placed = classes.join(found, classes["class"] == found.node, "left").select("class", "doc_id", F.coalesce("component", "class").alias("component"))
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    labels = placed.join(least, "component").select("class", "component_id")
    full = rows.where("class IS NOT NULL").join(labels, "class").select("doc_id", "n_shingles", "component_id")
    every = full.union(rows.where("class IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return every.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
