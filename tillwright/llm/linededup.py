"""Line dedup in DataFrame functions: keep one copy of a line that many documents share.

The text of a long line becomes a 128-bit hash of its key (stripped at both ends,
A-Z lower-cased). Hashes are range-partitioned with the document as second key,
so that a line with a third of all rows is spread over many tasks, and sorted by
hash, document and position. Streaming over that order folds the lines of a
document into one row of (hash, document); a second, map-side combined sum gives
each hash its number of documents and the document whose copy stays. A hash that
many documents hold meets them in several tasks (``met``). What returns to the documents is no text but a compressed bitmap: the runs of dropped
positions.

A null text is one empty line. Documents are told apart by doc_id; rows that
share a doc_id count as one document, and each is cleaned by its own lines. A
null doc_id counts as one document below all others. Other columns pass through
``cleaned`` untouched, but for those named like the two that it adds.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import SPACES, passing
from tillwright.session import durable

RUNS = "array<struct<first: int, last: int>>"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    """The line stripped of ASCII white space, A-Z lower-cased; ``lower`` alone does that for ASCII lines."""
    bare = F.btrim(line, F.lit(SPACES))
    small = F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(small)


def long_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """doc_id, row (a hash of the text), position and the two halves of the hash of every key of ``least_chars`` or more."""
    apart = docs.select("doc_id", F.xxhash64("text").alias("row"), F.posexplode(lines_of(F.col("text"))).alias("position", "line"))
    keyed = apart.where(F.char_length("line") >= least_chars).select("doc_id", "row", "position", key_of(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= least_chars).select(
        "doc_id", "row", "position", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def met(held: DataFrame, repeated: DataFrame, parts: int = 256) -> DataFrame:
    """``held`` joined with ``repeated`` on the hash; a hash with more than one ``parts``-th of all documents' rows is dealt to several tasks by document.

    Such hashes are fewer than ``parts``, so Spark may broadcast them, and their rows in
    ``repeated`` are copied at most twice ``parts`` times.
    """
    total = repeated.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    counted = repeated.withColumn("_salts", F.ceil(F.col("n_docs") * parts / F.lit(max(1, total))).cast("int"))
    hot = counted.where("_salts > 1").select("h1", "h2", "_salts")
    dealt = held.join(F.broadcast(hot), ["h1", "h2"], "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64("doc_id", "row"), F.col("_salts")).cast("int"), F.lit(0))).drop("_salts")
    copies = counted.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    return dealt.join(copies, ["h1", "h2", "_salt"]).drop("_salt")


def keep_bitmaps(docs: DataFrame, least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """doc_id, row, ``dropped`` (runs of line positions that go, in order) and n_dropped, for documents that lose lines."""
    lines = durable(long_lines(docs, least_chars))
    width = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = lines.repartitionByRange(width, "h1", "h2", "doc_id", "row").sortWithinPartitions("h1", "h2", "doc_id", "row", "position")
    held = in_order.groupBy("h1", "h2", "doc_id", "row").agg(F.collect_set("position").alias("positions"))
    documents = lines.select("h1", "h2", "doc_id").distinct()
    repeated = documents.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
    repeated = durable(repeated.where(F.col("n_docs") >= least_docs))
    gone = met(held, repeated).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    by_doc = gone.groupBy("doc_id", "row").agg(F.array_sort(F.flatten(F.collect_list("positions"))).alias("at"))
    firsts = F.filter("at", lambda x, i: (i == 0) | (F.get("at", i - 1) != x - 1))
    lasts = F.filter("at", lambda x, i: (i == F.size("at") - 1) | (F.get("at", i + 1) != x + 1))
    return by_doc.select("doc_id", "row", F.arrays_zip(firsts.alias("first"), lasts.alias("last")).cast(RUNS).alias("dropped"),
                         F.size("at").alias("n_dropped"))


def _bits(runs: Column) -> Column:
    """Bytes of ones and zeros up to the last dropped line, for a look-up in constant time."""
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get(runs, i - 1)["last"])
    parts = F.transform(runs, lambda r, i: F.concat(
        F.repeat(F.lit("1"), r["first"] - before(i) - 1), F.repeat(F.lit("0"), r["last"] - r["first"] + 1)))
    return F.array_join(parts, "").cast("binary")


def cleaned(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``text`` rid of its dropped lines, and n_lines (before), n_dropped."""
    kept = passing(docs, "n_lines", "n_dropped")
    docs = docs.select(*kept)
    marks = bitmaps.select(F.col("doc_id").alias("_tw_doc"), F.col("row").alias("_tw_row"), _bits(F.col("dropped")).alias("_tw_bits"),
                           F.col("n_dropped").cast("long").alias("_tw_gone"))
    joined = docs.join(marks, F.col("doc_id").eqNullSafe(F.col("_tw_doc")) & (F.xxhash64("text") == F.col("_tw_row")), "left")
    lines = lines_of(F.col("text"))
    stay = F.filter(lines, lambda _, i: F.coalesce(F.substring(F.col("_tw_bits"), i + 1, F.lit(1)) != F.lit(b"0"), F.lit(True)))
    text = F.when(F.col("_tw_gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(stay, "\n"))
    return joined.select(*(text.alias("text") if c == "text" else F.col(c) for c in kept),
                         F.size(lines).cast("long").alias("n_lines"), F.coalesce("_tw_gone", F.lit(0)).cast("long").alias("n_dropped"))
