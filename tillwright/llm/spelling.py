"""Spelling variants by dense prefix-suffix tiling.

Words are counted first. Two words are near if they differ by one inserted, deleted
or replaced code point. Such a pair of g and g or g + 1 code points shares its first
g // 2 or its last g // 2 code points, so words meet in groups by (g, side, those
code points); no near pair is outside. A group's words lie in padded matrices of code
points, one aligned left and one right; blocks of pairs are compared at once, and a
pair is near if its common prefix and suffix together reach the longer length less
one. A pair that meets on both sides counts on the left one. A group of more than
``most`` words is cut into slices, and pairs of slices are tasks of their own.

A tile hands on what it adds to each word (count of near words and the best one),
not its pairs. A word's form is its near word of largest n, ties to the smallest in
code-point order, if that is ``factor`` times the word's n at least. Roots come from
joins that double the steps taken, so their number is the logarithm of the longest
chain, whose n grows by ``factor`` a step.

Null texts hold no words; a null doc_id counts as the empty id in the slip rule;
repeated rows count each. An empty table gives no words. Texts of any length are
read whole, and only a task's own words are held: counts are handed on once a task
has ``HELD`` of them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import runs_of, slices
from tillwright.session import durable

HELD = 500_000
CELLS = 1 << 22  # code points of a block of pairs
#: Latin letters as single bytes; what has no such byte becomes "?" and so ends a word.
RUN = re.compile(rb"[a-z\xc0-\xff]+")


def slipped(run: bytes, seed: int, every: int) -> bytes:
    """The run without one code point, if its checksum says so. ``seed``: the checksum of what stands before it."""
    code = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if code % every:
        return run
    at = code % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, every: int = 199) -> DataFrame:
    """word and n over whole texts: maximal runs of Latin letters, A-Z lowered.

    A run loses the code point number h mod its length if ``every`` divides
    h, the crc32 of ``<doc_id>:<run>``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def handed() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in counts if w]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([n for w, n in counts.items() if w], pa.int64())], ["word", "n"])

        for batch in slices(batches, "text"):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                seed = zlib.crc32(f"{doc or ''}:".encode())
                for word, n in Counter(RUN.findall((text.as_py() or "").encode("latin-1", "replace").lower())).items():
                    counts[slipped(word, seed, every)] += n
                if len(counts) >= HELD:
                    yield handed()
                    counts = Counter()
        yield handed()

    read = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return read.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def matrix(words: np.ndarray) -> np.ndarray:
    """Code points of the words, one row each, padded with 0 at the end."""
    return words.view(np.uint32).reshape(len(words), -1)


def equal_ahead(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per row, how many leading cells are equal."""
    same = a == b
    return np.where(same.all(1), same.shape[1], same.argmin(1))


def blocks(sizes: np.ndarray, starts: np.ndarray, split: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(group, row, row) of the pairs of each group, in blocks; where ``split`` is not 0, only pairs across that row of the group."""
    for lag in range(1, int(sizes.max(initial=0))):
        group = np.flatnonzero(sizes > lag)
        for part in np.array_split(group, max(1, int(sizes[group].sum() * width // CELLS))):
            count = sizes[part] - lag
            of = np.repeat(part, count)
            first = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            across = (split[of] == 0) | ((first < split[of]) & (first + lag >= split[of]))
            of, first = of[across], first[across] + starts[of[across]]
            yield of, first, first + lag


def near_pairs(words: np.ndarray, g: int, left: np.ndarray, sizes: np.ndarray, starts: np.ndarray, split: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the near pairs whose shorter word has g code points. left: whether a group shares the prefix, per group."""
    lengths = np.char.str_len(words)
    ahead, back = matrix(words), matrix(np.array([w[::-1] for w in words.tolist()], words.dtype))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for of, a, b in blocks(sizes, starts, split, g + 1):
        fits = np.minimum(lengths[a], lengths[b]) == g
        of, a, b = of[fits], a[fits], b[fits]
        prefix, suffix = equal_ahead(ahead[a], ahead[b]), equal_ahead(back[a], back[b])
        near = (prefix + suffix >= np.maximum(lengths[a], lengths[b]) - 1) & (left[of] | (prefix < g // 2))
        found.append((a[near], b[near]))
    a, b = (np.concatenate(x) for x in zip(*found))
    return a, b


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before in a column; the first row does."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def added(rows: pa.Table) -> pa.RecordBatch:
    """What whole groups of one g add to their words: how many near ones, and the best of them."""
    g = rows["g"][0].as_py()
    words = np.array(rows["word"].to_pylist(), f"U{g + 1}")
    side, i, j, part, times = (rows[c].to_numpy() for c in ("side", "i", "j", "part", "n"))
    starts = changes(side, i, j, np.array(rows["chars"].to_pylist(), f"U{max(g // 2, 1)}"))
    sizes = np.diff(np.r_[starts, len(words)])
    across = i[starts] != j[starts]
    split = np.where(across, np.add.reduceat((part == 0).astype(np.int64), starts), 0)
    sizes = np.where(across & (split == sizes) | across & (split == 0), 0, sizes)  # no words of the other slice
    a, b = near_pairs(words, g, side[starts] == 0, sizes, starts, split)
    who, what = np.r_[a, b], np.r_[b, a]
    _, rank = np.unique(words, return_inverse=True)
    order = np.lexsort((rank[what], -times[what], rank[who]))
    who, what = who[order], what[order]
    first = changes(rank[who])
    return pa.RecordBatch.from_arrays(
        [pa.array(words[who[first]].tolist(), pa.string()), pa.array(np.diff(np.r_[first, len(who)]), pa.int64()),
         pa.array(times[what[first]], pa.int64()), pa.array(words[what[first]].tolist(), pa.string())], ["word", "n_near", "best_n", "best"])


def near_words(vocabulary: DataFrame, most: int = 1024) -> DataFrame:
    """word, n_near and best, the near word of largest n and that n negated (less), of the words (word, n) that have a near one."""
    n, keys = F.length("word"), ["g", "side", "chars"]
    met = F.array(*(F.struct(g.alias("g"), F.lit(side).alias("side"), end("word", F.floor(g / 2).cast("int")).alias("chars"))
                    for g in (n, n - 1) for side, end in enumerate((F.left, F.right))))
    spread = vocabulary.select("word", "n", F.explode(met).alias("m")).select("word", "n", "m.*")
    sizes = spread.groupBy(*keys).count().where("count > 1")
    parted = spread.join(sizes.select(*keys, F.ceil(F.col("count") / most).cast("int").alias("parts")), keys)
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(
        F.least(k, own).alias("i"), F.greatest(k, own).alias("j"), F.when(k < own, 1).otherwise(0).alias("part")))
    rows = parted.select("word", "n", *keys, F.explode(tiles).alias("t")).select("word", "n", *keys, "t.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_of(batches, "g", keys + ["i", "j"]):
            yield added(group)

    dealt = rows.repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j", "part")
    found = dealt.mapInArrow(run, "word string, n_near long, best_n long, best string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root, the end of its chain, of words (word, form) that have a form."""
    current = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        above = current.select(F.col("word").alias("root"), F.col("root").alias("above"))
        stepped = durable(current.join(above, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")))
        if not stepped.where("moved").limit(1).count():
            return stepped.select("word", "root")
        current = stepped.select("word", "root")


def variants(docs: DataFrame, least_chars: int = 6, least_n: int = 5, factor: int = 5, every: int = 199, most: int = 1024) -> DataFrame:
    """word, form, root, n, n_near and form_n of the words of ``least_chars`` code points or more that occur ``least_n`` times or more."""
    counted = word_counts(docs, every)
    vocabulary = durable(counted.where((F.length("word") >= least_chars) & (F.col("n") >= least_n)))
    found = near_words(vocabulary, most)
    form_n = -F.col("best.less")
    strong = form_n >= factor * F.col("n")
    named = durable(vocabulary.join(found, "word", "left").select(
        "word", F.when(strong, F.col("best.best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(strong, form_n).alias("form_n")))
    ends = roots(named.where("form IS NOT NULL"))
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
