"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def free(docs: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front until no column of `docs` has them (column names ignore case)."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def returned(run):
    """The same Arrow function, giving free memory back to the system when it ends: a worker lives on and serves other stages."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not this C library
            pass

    return wrapped


def row_key(*columns: str) -> Column:
    """64 bits of the whole row's content, to tell rows with one id apart."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def offsets_before(sums: DataFrame, order: str, amount: str, alias: str) -> DataFrame:
    """Sum of `amount` in the rows before, in the order of `order`. `sums` has one row per partition of a
    sorted table, so it is as small as the number of partitions."""
    from pyspark.sql import Window

    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn(alias, F.coalesce(F.sum(amount).over(before), F.lit(0).cast("long"))).drop(amount)


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches cut to at most `rows` rows, so that what a task holds beside its input stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def pieces_for(total: int, each: int, least: int = 1) -> int:
    """Number of partitions of about `each` units."""
    return max(least, -(-int(total or 0) // each))
