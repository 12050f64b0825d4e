"""Readers, keys and small Arrow helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; every other code point belongs to a word.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty string."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % parts


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice holds about ``limit`` bytes of column ``text`` (one row at least)."""
    for batch in batches:
        start, held = 0, 0
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def runs_of(batches: Iterator[pa.RecordBatch], lead: str | None, keys: list[str]) -> Iterator[pa.Table]:
    """Sorted batches as tables of whole groups (``keys``), each table of one value of ``lead`` if one is named; a group may span batches."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        held = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held else pa.Table.from_batches([batch])
        last = pc.equal(held[keys[0]], held[keys[0]][-1])
        for key in keys[1:]:
            last = pc.and_(last, pc.equal(held[key], held[key][-1]))
        whole = held.num_rows - pc.sum(last).as_py()  # the last group may go on in the next batch
        yield from _by_value(held.slice(0, whole), lead)
        held = held.slice(whole)
    if held:
        yield from _by_value(held, lead)


def _by_value(rows: pa.Table, lead: str | None) -> Iterator[pa.Table]:
    if rows.num_rows and not lead:
        yield rows.combine_chunks()
    elif rows.num_rows:
        ends = [x["counts"].as_py() for x in pc.value_counts(rows[lead].combine_chunks())]
        for k, n in enumerate(ends):
            yield rows.slice(sum(ends[:k]), n).combine_chunks()


def labelled_sample(docs: DataFrame, labels: DataFrame, grade: str, bound: int, keep: Column | None = None) -> DataFrame:
    """doc_id, text and grade of at most ``bound`` labelled documents, one row each, chosen by hash of the id.

    A document with several labels takes the largest, one with several texts that of
    the least hash; null labels and ids are no labels. The chosen ids are at most
    ``bound`` rows, so they may be broadcast.
    """
    one = labels.where(F.col("doc_id").isNotNull() & F.col(grade).isNotNull())
    if keep is not None:
        one = one.where(keep)
    one = one.groupBy("doc_id").agg(F.max(grade).alias("grade"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least")
    return found.groupBy("doc_id", "grade").agg(least).select("doc_id", F.col("least.text").alias("text"), "grade")


def passing(docs: DataFrame, *added: str) -> list[str]:
    """The columns of ``docs`` that pass through an operator: all but those named like the ones it adds or uses itself."""
    return [c for c in docs.columns if c.lower() not in added and not c.lower().startswith("_tw_")]
