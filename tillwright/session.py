"""Session defaults and lineage cutting."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Only results depend on the first three; the rest are plain Spark knobs that a
# cluster is free to override with spark-defaults or --conf.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.legacy.javaCharsets": "true",  # lets the CSV reader accept GB18030
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "tillwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword pairs are extra settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, one in the warehouse, which is shared as well.

    A machine-local folder is refused on a cluster of several machines.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    folder = folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    master = spark.sparkContext.master
    several = not master.startswith("local") or master.startswith("local-cluster")
    named = spark.conf.get("spark.checkpoint.dir", None) is not None  # whoever runs the cluster vouches for that folder
    if several and not named and (folder.startswith("file:") or folder.startswith("/") and not spark.conf.get("spark.hadoop.fs.defaultFS", "")):
        raise RuntimeError(f"{folder} is local to each machine; set spark.checkpoint.dir to a folder that all executors share")
    return folder


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, its lineage cut.

    Used where a small table that was expensive to derive (a daily series out
    of the whole transaction log) feeds several branches of one plan. The copy
    outlives any executor and, being Parquet, is still pruned by column.
    """
    path = f"{shared_folder(df.sparkSession)}/tillwright-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
