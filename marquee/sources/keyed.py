"""Stored tables in buckets of a key, changed by commits.

The rows of a key lie in the bucket whose bits begin the key's hash. A bucket is one folder of data files; the
newest commit lists all buckets, so rewriting several of them is one step: a crash between files leaves the
table as it was, and readers keep what they have begun to read. A bucket that outgrows its size is cut in
2, 4, … by the next bits when it is rewritten, so a bucket is a bounded piece of work whatever the table's
size. A commit also names the last batch of each stream, so a batch that is sent again changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.session import MOST_ROWS, checkpointed, small
from marquee.sources.commits import CommitLog, Conflict

BUCKET_ROWS = 1_000_000
BITS = 32
TRIES = 20


def _hash_bits(key: str) -> Column:
    return F.lpad(F.bin(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << BITS))), BITS, "0")


def _placed(df: DataFrame, key: str, buckets: list[dict]) -> DataFrame:
    """The rows with `_bits` of their bucket.

    One lookup for each length of bits, of which there are few, as the hashes are even: a wide row is neither copied
    for every beginning of its hash nor led through an explode.
    """
    lengths: dict[int, list] = {}
    for b in buckets:
        lengths.setdefault(len(b["bits"]), []).append((b["bits"],))
    if 0 in lengths:  # one bucket for all hashes
        return df.withColumn("_bits", F.lit(""))
    found = df.withColumn("_hash", _hash_bits(key))
    for n, bits in sorted(lengths.items()):
        known = df.sparkSession.createDataFrame(bits, f"_bits{n} string")
        found = found.join(small(known), F.col("_hash").substr(1, n) == F.col(f"_bits{n}"), "left")
    names = [f"_bits{n}" for n in lengths]
    return found.withColumn("_bits", F.coalesce(*names)).where(F.col("_bits").isNotNull()).drop("_hash", *names)


def _read(spark: SparkSession, path: str, buckets: list[dict], schema: T.StructType) -> DataFrame:
    folders = [f"{path}/{b['folder']}" for b in buckets if b["folder"]]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as of now; one that was never written has no rows."""
    return _read(spark, path, CommitLog(spark, path).latest()[1].get("buckets", []), schema)


def _write(df: DataFrame, path: str, key: str, buckets: list[dict], rows_each: int) -> list[dict]:
    """Write the new rows of the buckets; buckets that are too large are cut. Returns the new list.

    The rows are counted by their keys alone, which leaves all other columns out of that pass, and are then placed and
    written in one go: a whole table is never written twice. A task takes some 100,000 rows, in whole buckets.
    """
    spark = df.sparkSession
    counts = {b["bits"]: 0 for b in buckets}
    counts |= {r["_bits"]: r["count"] for r in _placed(df.select(key), key, buckets).groupBy("_bits").count().collect()}  # a row for each bucket
    new = []
    for bits, n in counts.items():
        c = min(BITS - len(bits), max(0, (n - 1) // rows_each).bit_length())
        new += [{"bits": bits + (f"{i:0{c}b}" if c else "")} for i in range(1 << c)]
    name = f"data/{uuid.uuid4().hex}"
    tasks = min(len(new), max(2 * spark.sparkContext.defaultParallelism, -(-sum(counts.values()) // MOST_ROWS)))
    cut = _placed(df, key, new).withColumn("bits", F.concat(F.lit("b"), "_bits")).drop("_bits")
    cut.repartition(tasks, "bits").write.partitionBy("bits").parquet(f"{path}/{name}")
    written = set(CommitLog(spark, path).folders(name))
    return [b | {"folder": f"{name}/bits=b{b['bits']}" if f"bits=b{b['bits']}" in written else None} for b in new]


def change(
    spark: SparkSession, path: str, key: str, fresh: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame],
    batch: tuple[str, int] | None = None, rows_each: int = BUCKET_ROWS,
) -> int:
    """Replace the rows of the buckets that `fresh` has keys of by merge(their stored rows, fresh); one commit.

    Returns how many buckets were rewritten. `batch`: stream and number; a number that the table has seen is left out.
    If another writer commits first, the merge is done again on what it has left.
    """
    fresh, log = checkpointed(fresh), CommitLog(spark, path)
    for _ in range(TRIES):
        number, state = log.latest()
        done = state.get("batches", {})
        if batch and done.get(batch[0], -1) >= batch[1]:
            return 0
        buckets = state.get("buckets") or [{"bits": "", "folder": None}]
        touched = {r["_bits"] for r in _placed(fresh.select(key), key, buckets).select("_bits").distinct().collect()}  # as many as buckets to rewrite
        old = [b for b in buckets if b["bits"] in touched]
        merged = merge(_read(spark, path, old, fresh.drop("ord").schema), fresh)
        new = _write(merged, path, key, old, rows_each) if old else []
        content = {"buckets": [b for b in buckets if b["bits"] not in touched] + new, "batches": done | ({batch[0]: batch[1]} if batch else {})}
        if log.commit(number + 1, content):
            return len(touched)
    raise Conflict(f"{path}: other writers came first {TRIES} times")


def vacuum(spark: SparkSession, path: str, retain: int = 2) -> int:
    """Drop the data that none of the last `retain` commits names. Run it when no writer is at work."""
    log = CommitLog(spark, path)
    kept = {b["folder"].split("/")[1] for n in log.numbers()[-retain:] for b in log.read(n)["buckets"] if b["folder"]}
    gone = [f for f in log.folders("data") if f not in kept]
    for f in gone:
        log.drop(f"data/{f}")
    return len(gone)
