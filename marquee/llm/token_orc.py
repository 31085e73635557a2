"""Token ids as ORC files: one row per document, in ascending doc_id order.

Documents are range-partitioned and sorted by id before they are encoded, so each task writes one file of
one id range. ORC stores the id arrays with integer run-length encoding, and keeps row indexes and Bloom
filters on `doc_id`; stripes are read in parallel, and a lookup of few documents skips files, stripes and
row groups by these statistics.

Null text counts as empty (only the end id). Rows that repeat a doc_id stand next to each other, ordered by
a hash of their text; a null doc_id sorts first. Other columns of the input are not looked at. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import offsets_before, slices
from marquee.llm.tokens import encoder

FIELDS = pa.schema(
    [("doc_id", pa.int64()), ("part", pa.int32()), ("ids_before", pa.int64()), ("n_tokens", pa.int64()),
     ("token_ids", pa.list_(pa.int32()))]
)
STORED = "doc_id long, part int, ids_before long, n_tokens long, token_ids array<int>"


def _encode(vocabulary: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, before = encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in slices(batches, 256):
            rows = [encode(t) + end for t in batch.column(1).to_pylist()]
            sizes = np.array([len(r) // 4 for r in rows], np.int64)
            ends = np.cumsum(sizes)
            ids = pa.array(np.frombuffer(b"".join(rows), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(rows), part, np.int32)), pa.array(before + ends - sizes),
                 pa.array(sizes), lists],
                schema=FIELDS,
            )
            before += int(ends[-1]) if len(ends) else 0

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, stripe_bytes: int = 64 << 20) -> None:
    """Encode whole texts, append `end_id` to each, and write them as ORC in ascending doc_id order."""
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    (
        ordered.mapInArrow(_encode(vocabulary, end_id), STORED)
        .write.option("compression", "snappy")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", "10000")
        .option("orc.stripe.size", str(stripe_bytes))
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, token_ids."""
    stored = spark.read.schema(STORED).orc(path)
    sums = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = offsets_before(sums, "part", "n", "before")
    return stored.join(F.broadcast(before), "part").select(  # one row per file
        "doc_id", (F.col("before") + F.col("ids_before")).alias("start"), "n_tokens", "token_ids"
    )


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Tokens of a few documents; the filter is pushed to the files' indexes and Bloom filters."""
    return spark.read.schema(STORED).orc(path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "token_ids")


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zlib

    for batch in batches:
        lists = batch.column(3)
        ends = np.asarray(lists.offsets)
        ids = np.asarray(lists.values).astype("<u4")
        sums = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(sums, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return tokens.select("doc_id", "start", "n_tokens", "token_ids").mapInArrow(
        _checksums, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
