"""Incremental ingest: new raw files are merged into the stored events as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marquee.operators.upsert import fold_fresh, merge_folded
from marquee.schemas import EVENT
from marquee.sources import keyed


def ingest(
    spark: SparkSession,
    raw_path: str,
    schema: T.StructType,
    to_events: Callable[[DataFrame], DataFrame],
    table: str,
    checkpoint: str,
    max_files: int | None = None,
    rows_each: int = keyed.BUCKET_ROWS,
) -> None:
    """Merge all files that have not been merged yet, then stop.

    The stored table lies in buckets of the event id (`sources.keyed`); a batch reads and rewrites only the buckets it
    has ids of, in one commit that also names the batch, so a batch that a restart sends again is left out.

    to_events: raw rows to canonical rows with `ord`.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def merge(batch: DataFrame, number: int) -> None:
        # folded before it is kept for the merge: one row per id is written, once
        keyed.change(batch.sparkSession, table, "event_id", fold_fresh(to_events(batch)), merge_folded, (checkpoint, number), rows_each)

    query = (
        reader.parquet(raw_path)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
