"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import bpe, linededup, mixing, quality, simhash
from tillwright.llm.common import passing, table
from tillwright.llm.registry import RANKS, bpe_digests
from tillwright.session import durable, shared_folder


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of grade 1 or better is at least a half; the model learns from the labels that ``docs`` has."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    kept = passing(docs, "rating")
    return quality.score(docs.select(*kept), model).where(F.col("rating.tail") >= 0.5).select(*kept)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents rid of lines that five or more of them share, but for one copy; n_chars follows the text."""
    kept = linededup.cleaned(docs, linededup.keep_bitmaps(docs, least_chars=40, least_docs=5))
    return kept.select(*(F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in passing(docs, "n_lines", "n_dropped")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the first by doc_id (null last), then by hash of the text, then by place.

    Rows are numbered in a written copy and judged each, so unlike texts under one doc_id all stay.
    """
    rows = durable(docs.select(*passing(docs)).withColumn("_tw_row", F.monotonically_increasing_id()))
    found = simhash.near_duplicates(rows.select(F.col("_tw_row").alias("doc_id"), "text"), words=4, radius=4)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), "_tw_row")
    named = rows.select("_tw_row", place.alias("place")).join(found.select(F.col("doc_id").alias("_tw_row"), "component_id"), "_tw_row")
    first = named.groupBy("component_id").agg(F.min("place").alias("place")).select("place._tw_row")
    return rows.join(first, "_tw_row", "left_semi").select(*passing(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to tempered source weights, in a global random order."""
    return mixing.mix(docs, mixing.rates(docs)).select(*passing(docs, "copy", "mix_key"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, their digests and the digest of the bytes they decode to."""
    kept = [c for c in ("doc_id", "source", "lang") if c in docs.columns]
    return bpe_digests(bpe.encode(docs, RANKS, public_tokenizers.PATTERN, keep=kept, decoded=True), *kept, "ids")


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources", mix_sources),
    ("byte-level BPE", tokenise),
]

#: The first stage is a trained classifier, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
