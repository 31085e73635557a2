"""Stored tables: replaced as a whole, or appended to."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators.upsert import append_unseen
from marquee.sources.commits import CommitLog, Conflict
from marquee.sources.raw import _or_empty

TRIES = 20


def write_table(df: DataFrame, path: str, retain: int = 2, expected: int | None = None) -> int:
    """Replace a whole table: write the rows to a new folder, then commit that folder as the current.

    A plan that still reads the old version is not disturbed, and a failed write changes nothing. Writers may work at
    once: each gets a number of its own, which is returned, and the last one holds. With `expected`, the number the new
    rows were made from, the write is refused (Conflict) if another came between. The last `retain` versions are kept.
    """
    log = CommitLog(df.sparkSession, path)
    version = uuid.uuid4().hex
    df.write.parquet(f"{path}/data/{version}")
    for _ in range(TRIES):
        number, state = log.latest()
        if expected is not None and number != expected:
            break
        versions = [*state.get("versions", []), version]
        if log.commit(number + 1, {"versions": versions[-retain:]}):
            for old in versions[:-retain]:
                log.drop(f"data/{old}")
            return number + 1
    log.drop(f"data/{version}")
    raise Conflict(f"{path}: another writer came first")


def current_version(spark: SparkSession, path: str) -> int:
    """Number of the newest version, 0 before the first."""
    return CommitLog(spark, path).latest()[0]


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The current version; a table that was never written has no rows."""
    versions = CommitLog(spark, path).latest()[1].get("versions")
    return spark.read.schema(schema).parquet(f"{path}/data/{versions[-1]}") if versions else spark.createDataFrame([], schema)


def append_new(df: DataFrame, path: str, key: str, order: Column) -> None:
    """Append the rows whose key the table does not hold yet (review queue)."""
    stored = _or_empty(lambda: df.sparkSession.read.schema(df.schema).parquet(path), df.sparkSession, df.schema)
    append_unseen(stored, df, key, order).write.mode("append").parquet(path)


def append_all(df: DataFrame, path: str) -> None:
    """Append every row (staging of all that was collected)."""
    df.write.mode("append").parquet(path)


def existing_keys(table: DataFrame, key: str) -> DataFrame:
    return table.select(key).where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").distinct()
