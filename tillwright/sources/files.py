"""Delimited-file scans, typing with a reject count, and named tables."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tillwright.sources import schemas

REJECTS = "_rejected"
RAW = "_raw"
HELD = "_held"


def text_scan(spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8") -> DataFrame:
    """A headed CSV with every field as text, so that nothing is lost to typing.

    Columns are taken by the names of their heads, in the order of ``schema``; other columns are left out
    and a missing one is an error. Only the head is read for that: text needs no inference pass.
    """
    raw = (
        spark.read
        .option("header", True)
        .option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    heads = {name.lstrip("\ufeff").strip(): name for name in raw.columns}
    if absent := [f.name for f in schema.fields if f.name not in heads]:
        raise ValueError(f"{path} lacks the columns {', '.join(absent)}")
    return raw.select(*(F.col(f"`{heads[f.name]}`").alias(f.name) for f in schema.fields))


def _typed(field: T.StructField, formats: Mapping[str, str]) -> Column:
    column = F.col(field.name)
    if field.name in formats:
        parsed = F.try_to_timestamp(column, F.lit(formats[field.name]))
        return parsed.cast(field.dataType)
    if isinstance(field.dataType, T.StringType):
        return column
    return column.try_cast(field.dataType)


def standardise(df: DataFrame, schema: T.StructType, formats: Mapping[str, str] | None = None, raw: bool = False) -> DataFrame:
    """Text columns to the types of ``schema``.

    A value that does not convert becomes NULL and its column is named in the
    array ``_rejected``; the row itself stays. With ``raw``, the map ``_raw`` has the
    rejected texts by column.
    """
    formats = formats or {}
    typed = {f.name: _typed(f, formats) for f in schema.fields}
    bad = F.filter(
        F.array(*[F.when(F.col(n).isNotNull() & c.isNull(), F.lit(n)) for n, c in typed.items()]),
        lambda name: name.isNotNull(),
    )
    texts = F.map_from_entries(F.filter(
        F.array(*[F.struct(F.lit(n).alias("column_name"), F.when(c.isNull(), F.col(n)).alias("text")) for n, c in typed.items()]),
        lambda entry: entry["text"].isNotNull(),
    ))
    return df.select(*[c.alias(n) for n, c in typed.items()], bad.alias(REJECTS), *([texts.alias(RAW)] if raw else []))


class Quarantine(NamedTuple):
    """All typed rows, the rows with a rejected value and its text, and the rejected values counted by column."""

    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def quarantine(text: DataFrame, schema: T.StructType, folder: str, formats: Mapping[str, str] | None = None) -> Quarantine:
    """Types the rows and stores them in ``folder``, those with a rejected value apart, in one scan of ``text``.

    The counts are observed while the rows are written. A column none of whose values is rejected counts 0.
    Rejected rows stay among ``rows`` with NULL for the value, as in ``standardise``; what reads
    ``rejects`` opens their files only.
    """
    typed = standardise(text, schema, formats, raw=True)
    seen = Observation()
    counted = typed.observe(seen, *[F.count_if(F.array_contains(REJECTS, f.name)).alias(f.name) for f in schema.fields])
    counted.withColumn(HELD, F.size(REJECTS) > 0).write.mode("overwrite").partitionBy(HELD).parquet(folder)
    stored = text.sparkSession.read.schema(T.StructType([*typed.schema.fields, T.StructField(HELD, T.BooleanType())])).parquet(folder)
    return Quarantine(stored.drop(REJECTS, RAW, HELD), stored.filter(HELD).drop(HELD), dict(seen.get))


def reject_counts(standardised: DataFrame) -> DataFrame:
    """Rows per column that failed to convert."""
    return (
        standardised.select(F.explode(REJECTS).alias("column_name"))
        .groupBy("column_name").agg(F.count("*").alias("rejected"))
    )


def load_star(spark: SparkSession, folder: str, kept_in: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``products``, ``sales`` and ``stores`` from one folder of CSV files.

    With ``kept_in``, the typed tables are stored in that folder, rejects apart (``quarantine``), and read from there.
    """
    def load(name: str, schema: T.StructType, formats: Mapping[str, str] | None = None) -> DataFrame:
        text = text_scan(spark, f"{folder}/{name}.csv", schema)
        if kept_in:
            return quarantine(text, schema, f"{kept_in}/{name}", formats).rows
        return standardise(text, schema, formats).drop(REJECTS)

    return (
        load("products", schemas.PRODUCTS),
        load("sales", schemas.SALES, {"sale_date": "yyyy/M/d"}),
        load("stores", schemas.STORES),
    )


def load_transactions(spark: SparkSession, path: str, encoding: str = "gb18030",
                      timestamp_format: str | None = None) -> DataFrame:
    """The invoice log, under the logical names of the cleaning step.

    GB18030 needs ``spark.sql.legacy.javaCharsets`` (set in ``session``).
    """
    formats = {"InvoiceDate": timestamp_format} if timestamp_format else {}
    typed = standardise(text_scan(spark, path, schemas.TRANSACTIONS, encoding), schemas.TRANSACTIONS, formats)
    return typed.select(
        F.lit("all").alias("series_key"),
        F.col("InvoiceNo").alias("invoice_no"),
        F.col("StockCode").alias("stock_code"),
        F.col("Quantity").alias("quantity"),
        F.col("InvoiceDate").alias("invoice_ts"),
        F.col("UnitPrice").alias("unit_price"),
        F.col("CustomerID").alias("customer_id"),
    )


def load_category_orders(spark: SparkSession, path: str) -> DataFrame:
    schema = schemas.CATEGORY_ORDERS
    return standardise(text_scan(spark, path, schema), schema).drop(REJECTS)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Each frame under its name for ``spark.sql``, replacing an earlier one."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)


def save_tables(tables: Mapping[str, DataFrame]) -> None:
    """Each frame as a catalog table, replacing an earlier one."""
    for name, frame in tables.items():
        frame.write.mode("overwrite").saveAsTable(name)


def save_bucketed(tables: Mapping[str, DataFrame], key: str, buckets: int, folder: str | None = None) -> None:
    """Each frame as a catalog table in ``buckets`` sets of files by ``key``, each sorted by it.

    Tables saved with the same ``buckets`` join on ``key`` and sum by it without a shuffle. Rows are dealt
    before the write, so that a bucket is one file and not one per task. ``folder`` takes the tables' files.
    """
    for name, frame in tables.items():
        writer = frame.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
        if folder:
            writer = writer.option("path", f"{folder}/{name}")
        writer.saveAsTable(name)


def profile(df: DataFrame, time_column: str) -> DataFrame:
    """Row count, column count, first and last time in one pass."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.min(time_column).alias("first_time"),
        F.max(time_column).alias("last_time"),
    )
