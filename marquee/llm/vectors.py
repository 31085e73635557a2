"""What the two vector searches share: valid vectors, and the best matches per query."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Not null or empty, and no component null, infinite or not a number."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.coalesce(F.exists(F.col(vector), odd), F.lit(True))


def common_length(vectors: DataFrame) -> int:
    """The most frequent number of components (the larger of equally frequent ones); 0 without vectors."""
    found = vectors.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.col("c").desc(), F.col("d").desc()).first()
    return found["d"] if found else 0


def matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, d)


class Best:
    """The best `k` matches per query that one task has seen; least (rank, vec_id) first.

    Combined whenever many have come together, so a task holds about `k` matches per query and at most `room` more.
    """

    def __init__(self, k: int, kind, room: int = 1_000_000):
        self.k, self.kind, self.room, self.parts, self.size = k, kind, room, [], 0

    def add(self, query: np.ndarray, vec: np.ndarray, rank: np.ndarray) -> None:
        if len(query):
            self.parts.append((query, vec, rank))
            self.size += len(query)
            if self.size > self.room:
                self.combine()
                self.room = max(self.room, 2 * self.size)

    def combine(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, self.kind)
        q, v, r = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((r, v, q))
        q, v, r = q[order], v[order], r[order]
        fresh = np.r_[True, (q[1:] != q[:-1]) | (v[1:] != v[:-1])]  # the least rank of each match
        q, v, r = q[fresh], v[fresh], r[fresh]
        order = np.lexsort((v, r, q))
        q, v, r = q[order], v[order], r[order]
        starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        place = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
        kept = place < self.k
        self.parts = [(q[kept], v[kept], r[kept])]
        self.size = int(kept.sum())
        return self.parts[0]

    def batches(self) -> Iterator[pa.RecordBatch]:
        q, v, r = self.combine()
        for at in range(0, len(q), 50_000):
            cut = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array(q[cut]), pa.array(v[cut]), pa.array(r[cut])], names=["query_id", "vec_id", "rank_by"])


def ranked(matches: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, rank_by: the `k` least (rank_by, vec_id) per query; a match found twice counts once."""
    once = matches.groupBy("query_id", "vec_id").agg(F.min("rank_by").alias("rank_by"))
    order = Window.partitionBy("query_id").orderBy("rank_by", "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "rank_by")
