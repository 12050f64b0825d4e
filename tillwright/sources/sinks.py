"""Result sinks and flat export forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def flat(df: DataFrame) -> DataFrame:
    """Plain export types: money as DOUBLE, counts as BIGINT, days as ISO text."""
    def convert(field: T.StructField) -> Column:
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            return column.cast("double").alias(field.name)
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            return column.cast("bigint").alias(field.name)
        if isinstance(kind, T.DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(field.name)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        return column

    return df.select(*[convert(f) for f in df.schema.fields])


def as_records(df: DataFrame) -> DataFrame:
    """One JSON text per row, the export form of a list of records."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("record"))


def as_maps(df: DataFrame, key: str, value: str, digits: int = 2) -> DataFrame:
    """Key → value maps, one row per hash shard of the keys.

    One map of everything would have to fit one task. ``digits`` hexadecimal
    digits give 16^digits shards; a lookup goes to the shard of its key.
    ``bounded_maps`` chooses the shards by the data.
    """
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(shard_of(F.col(key), digits).alias("shard"))
        .agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("entries"))
    )


def bounded_maps(df: DataFrame, key: str, value: str, limit: int = 10_000) -> DataFrame:
    """Key → value maps of at most ``limit`` entries at any size: shard, part, first_hash, entries.

    The number of shards follows from the counted keys, so that a shard of equal hash digits holds about
    ``limit`` entries or fewer; it is then cut in the order of the hashes where it holds more. A key's map is the
    one with the largest first_hash not above the key's hash in the key's shard (``map_of``). Keys are distinct.
    """
    rows = df.filter(F.col(key).isNotNull()).select(key, value)
    keys, digits = rows.count(), 0
    while limit * 16**digits < keys:
        digits += 1
    hashed = rows.select(key, value, F.md5(F.col(key).cast("string")).alias("hash"))
    placed = hashed.withColumn("shard", F.substring("hash", 1, digits))
    place = F.row_number().over(Window.partitionBy("shard").orderBy("hash", key))
    return (
        placed.withColumn("part", F.floor((place - 1) / limit).cast("int"))
        .groupBy("shard", "part")
        .agg(F.min("hash").alias("first_hash"), F.map_from_entries(F.collect_list(F.struct(key, value))).alias("entries"))
    )


def map_of(maps: DataFrame, key: str) -> DataFrame:
    """The one row of ``bounded_maps`` in which ``key`` is, if it is anywhere; maps themselves aren't sorted or moved."""
    mine = F.md5(F.lit(key))
    found = maps.filter(mine.startswith(F.col("shard")) & (F.col("first_hash") <= mine))
    return found.orderBy(F.desc("first_hash")).limit(1)


def shard_of(key: Column, digits: int = 2) -> Column:
    return F.substring(F.md5(key.cast("string")), 1, digits)


def write_csv(df: DataFrame, path: str, partition_by: str | None = None, encoding: str = "UTF-8") -> None:
    """Headed CSV; one folder per value of ``partition_by``."""
    writer = df.write.mode("overwrite").option("header", True).option("encoding", encoding)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
