"""Session settings and the few helpers that need the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

SMALL_ROWS = 200_000
SMALL_BYTES = 64 * 1024 * 1024


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the checkpoint folder the cluster names.

    Only a local session without one gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="marquee-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of this application in the shared folder."""
    return f"{_scratch_root(spark)}/{uuid.uuid4().hex}/{name}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/marquee-{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove everything this application has written to scratch paths, once its results are read or stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the rows as a table in the shared folder and go on from there.

    Cuts the lineage and survives lost executors like `checkpoint()`. A table also forgets what the
    planner has inferred about the rows: `checkpoint()` carries those constraints on, and in loops
    they grow until planning takes longer than the work.
    """
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> bool:
    """Whether the measured size allows a broadcast."""
    width = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width.cast("long"))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def small(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Mark a join side for broadcast if its measured size is small; else leave the join to Spark.

    Larger sides are joined by shuffle, where adaptive execution splits hot keys.
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


# rows of a piece that heavy work takes as it is, and of a piece that is dealt anew
MOST_ROWS, EACH_ROWS = 100_000, 20_000


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for work that is heavy per row, in tasks of a bounded number of rows.

    Counted are the rows of each piece (of files, from their footers): a file can be cut in many pieces of bytes and
    still have all its rows in one. Pieces that are enough and not too large stay as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    pieces = df.groupBy(F.spark_partition_id().alias("piece")).agg(F.count(F.lit(1)).alias("n"))
    n, largest, rows = pieces.agg(F.count("n"), F.max("n"), F.sum("n")).first()
    if n * 2 > cores and largest <= MOST_ROWS:
        return df
    return df.repartition(max(cores, -(-(rows or 0) // EACH_ROWS)))


def dealt(df: DataFrame) -> DataFrame:
    """The result of a shuffle over all tasks, for work that is heavy per row: adaptive execution joins small pieces
    by their bytes, not by their work. Nothing is measured, so nothing is computed twice."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))
