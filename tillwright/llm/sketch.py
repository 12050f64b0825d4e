"""Document fingerprints in DataFrame functions: a threshold-scaled sketch of word shingles.

Every shingle hash below a fixed fraction of the hash range is retained, whatever the
length of the text, and the ``LEAST`` lowest ones in any case. A sketch carries its own
limit, up to which it knows all hashes: the fraction, the highest retained hash where
that lies above it, or the whole range where the text has no other hashes. Two sketches
are compared up to the lower limit of both: the share of the smaller one's hashes
there that the other has too estimates containment, also of very unequal documents.
The hashes of a union up to the lower limit are the sketch of both texts.

So texts of up to ``LEAST`` different shingles are compared exactly among themselves,
and the estimate of longer ones rests on ``LEAST`` hashes at least, or on about the
fraction of them. A short text inside a long one is known by those of its hashes that
lie below the long one's limit; where there are none the estimate is 0.

Words are runs of characters other than ASCII white space, lower-cased; a text of
fewer words than a shingle is one shingle; a text without words (or null) has the empty
sketch, which is like another empty one (1) and unlike any other (0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.common import SPACES
from tillwright.session import durable

LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
LEAST = 64


def with_sketch(df: DataFrame, text: str, name: str, words: int = 5, fraction: float = 1 / 8, least: int = LEAST) -> DataFrame:
    """``df`` and ``name``: the sorted distinct retained hashes of ``text`` and the limit (``upto``, itself included) they are complete to.

    The steps are columns of their own, each read more than once by the next, so
    that a step is computed once per row and not once per element.
    """
    last = min(LOWEST + int(fraction * (1 << 64)) - 1, HIGHEST)
    bare = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(SPACES))
    tokens = F.filter(F.split(bare, "[ \\t-\\r]+", -1), lambda w: w != "")
    df = df.withColumn("_words", F.transform(tokens, lambda w: F.xxhash64(w)))
    n = F.size("_words")
    shingles = F.when(n >= words, F.transform(F.sequence(F.lit(1), F.greatest(n - words + 1, F.lit(1))),
                                              lambda i: F.xxhash64(F.slice("_words", i, words))))
    df = df.withColumn("_shingles", shingles.when(n > 0, F.array(F.xxhash64("_words"))).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_below", F.array_sort(F.array_distinct(F.filter("_shingles", lambda x: x <= last))))
    enough = F.size("_below") >= least
    df = df.withColumn("_lowest", F.when(~enough, F.slice(F.array_sort(F.array_distinct("_shingles")), 1, least + 1)))
    sketch = lambda hashes, upto: F.struct(hashes.alias("hashes"), upto.cast("long").alias("upto"))
    some = F.slice("_lowest", 1, least)
    made = F.when(enough, sketch(F.col("_below"), F.lit(last))).when(F.size("_lowest") <= least, sketch(F.col("_lowest"), F.lit(HIGHEST)))
    return df.withColumn(name, made.otherwise(sketch(some, F.greatest(F.get(some, least - 1), F.lit(last))))).drop("_words", "_shingles", "_below", "_lowest")


def fingerprint(sketch: str) -> Column:
    """The sketch's hashes as text, 16 hexadecimal digits each."""
    return F.array_join(F.transform(f"{sketch}.hashes", lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def containment(a: str, b: str) -> Column:
    """Estimated share of the smaller document's shingles that the other has too, 0 to 1, from the hashes up to the lower limit of both."""
    upto = F.least(f"{a}.upto", f"{b}.upto")
    both_empty = (F.size(f"{a}.hashes") == 0) & (F.size(f"{b}.hashes") == 0)
    known = lambda s: F.filter(f"{s}.hashes", lambda x: x <= upto)
    least = F.least(F.size(known(a)), F.size(known(b)))
    shared = F.size(F.array_intersect(known(a), known(b)))
    return F.when(both_empty, 1.0).when(least > 0, shared / F.nullif(least, F.lit(0))).otherwise(0.0).cast("double")


def merged(a: str, b: str) -> Column:
    """The sketch of both texts together, but for the shingles across the seam."""
    upto = F.least(f"{a}.upto", f"{b}.upto")
    return F.struct(F.filter(F.array_sort(F.array_union(f"{a}.hashes", f"{b}.hashes")), lambda x: x <= upto).alias("hashes"), upto.alias("upto"))


def successors(docs: DataFrame) -> DataFrame:
    """doc_id, next_id (the next lower id; the highest after the lowest) and the length of the text, one row per id.

    Ids are range-partitioned and numbered by part; a part's last id is followed by
    the first of the next part. Only one row per part is ordered in one task.
    """
    sizes = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.char_length(F.coalesce("text", F.lit("")))).alias("n"))
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = durable(sizes.repartitionByRange(width, F.desc("doc_id")).withColumn("part", F.spark_partition_id()))
    heads = placed.groupBy("part").agg(F.max("doc_id").alias("head"))
    parts = Window.orderBy("part")
    top = F.max("head").over(Window.partitionBy())
    heads = heads.select("part", F.coalesce(F.lead("head").over(parts), top).alias("after"))
    inside = F.lead("doc_id").over(Window.partitionBy("part").orderBy(F.desc("doc_id")))
    return placed.withColumn("inside", inside).join(heads, "part").select("doc_id", F.coalesce("inside", "after").alias("next_id"), "n")


def edited_pairs(docs: DataFrame, words: int = 5, fraction: float = 1 / 8) -> DataFrame:
    """Every document's sketch beside those of its edited text and of the next document.

    The edited text is the text with its last third replaced by the start of the
    next document. That document sends only the part that is needed and its sketch.
    Rows that repeat a doc_id are edited each; the next document of an id is then the
    row that is first by text. A row without id has no next document (an empty one).
    """
    every = with_sketch(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "sketch", words, fraction)
    own = every.where("doc_id IS NOT NULL")  # the same rows on both sides, so that texts and sketches are made and shuffled once for both
    wanted = successors(docs).select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("for_id"), F.floor(F.col("n") / 3).cast("int").alias("need"))
    sent = own.join(wanted, "doc_id").groupBy("for_id").agg(
        F.min(F.struct(F.substring("text", F.lit(1), F.col("need")).alias("start"), F.col("sketch"))).alias("sent"))
    both = own.join(sent, own.doc_id == sent.for_id, "left").select("doc_id", "text", "sketch", "sent")
    both = both.unionByName(every.where("doc_id IS NULL"), allowMissingColumns=True)
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    start = F.coalesce(F.substring("sent.start", F.lit(1), third), F.lit(""))
    nothing = F.struct(F.array().cast("array<bigint>").alias("hashes"), F.lit(HIGHEST).alias("upto"))
    both = both.select("doc_id", n.cast("long").alias("n_chars"), "sketch", F.coalesce("sent.sketch", nothing).alias("next_sketch"),
                       F.concat(F.substring("text", F.lit(1), n - third), start).alias("edited"))
    return with_sketch(both, "edited", "edited_sketch", words, fraction)
