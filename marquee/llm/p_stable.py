"""Approximate nearest neighbours (Euclidean) by multiprobe p-stable hashing.

Each of a few tables hashes a vector by random projections cut into cells; the cell is its bucket. A query
visits cells around its own in the order of their estimated chance to hold a vector at the distance of its
neighbours, until the chances add up to the recall aimed at. That distance is estimated for each query as
the distance of its k-th neighbour in a sample of the vectors, which is never too small. Candidates of all
tables are merged and ranked by exact distance.

The cell width is fitted to a sample of at most `SAMPLE` vectors (least hash of vec_id); every vector is
indexed, equal rows once. A bucket is stored as several rows, each with the vectors of one task, so a bucket with a third of
all vectors is not one row. Vectors that are null, zero, of another length than most, or that hold a null
or non-finite component take no part; rows with a null vec_id neither. Rows that repeat a vec_id are one
candidate, at their least distance, and take one of the k places; as queries, each result is the nearest of their candidates. A query that
meets fewer than k vectors is compared with all; fewer than k candidates give fewer rows. An empty table
gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import slices
from marquee.llm.vectors import Best, common_length, finite, matrix, ranked
from marquee.session import checkpointed

TABLES = 4
HASHES = 8
WIDTH = 2.0
RECALL = 0.93
SAMPLE = 2000
REACH = 2
BUCKETS = "tab int, bucket long, ids binary, vectors binary"


def _least(distances: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Per row the least distance of each vec_id; equal ids lie side by side."""
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    return distances if len(starts) == len(ids) else np.minimum.reduceat(distances, starts, axis=-1)


@dataclass
class Index:
    """Random projections, cell width and the sample that distances are estimated from."""

    length: int
    directions: np.ndarray  # table, component, hash
    shifts: np.ndarray  # table, hash
    width: float
    sample: np.ndarray
    sample_ids: np.ndarray
    k: int
    recall: float

    def cells(self, x: np.ndarray, table: int) -> np.ndarray:
        return (x @ self.directions[table] + self.shifts[table]) / self.width

    @staticmethod
    def buckets(cells: np.ndarray) -> np.ndarray:
        """64 bits per row of cell numbers."""
        out = np.zeros(len(cells), np.uint64)
        for column in cells.T.astype(np.int64).astype(np.uint64):
            out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out.astype(np.int64)


def fit(vectors: DataFrame, k: int, tables: int = TABLES, hashes: int = HASHES, width: float = WIDTH, recall: float = RECALL, seed: int = 5) -> Index | None:
    """None if there are no valid vectors. `vectors`: vec_id, v (valid)."""
    length = common_length(vectors)
    if not length:
        return None
    rows = vectors.where(F.size("v") == length).orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(SAMPLE).collect()  # at most SAMPLE
    sample = np.array([r["v"] for r in rows], np.float64)
    spread = math.sqrt(((sample - sample.mean(axis=0)) ** 2).sum(axis=1).mean()) or float(np.abs(sample).max())
    rng = np.random.default_rng(seed)
    cell = width * spread
    return Index(
        length, rng.normal(size=(tables, length, hashes)), rng.uniform(0, cell, (tables, hashes)), cell, sample,
        np.array([r["vec_id"] for r in rows], np.int64), k, recall,
    )


_erf = np.frompyfunc(math.erf, 1, 1)


def probe_offsets(inside: np.ndarray, distance: float, width: float, aim: float) -> np.ndarray:
    """Cell offsets of one table in the order of their chance, as many as reach the chance `aim`.

    `inside`: place of the query in its cell, per hash. The chance of an offset is the product over the hashes
    of the normal mass of its interval; partial products only fall, so the best of all offsets come from the
    best of the hashes so far.
    """
    steps = np.arange(-REACH, REACH + 1)
    low = steps[None, :] * width - inside[:, None]
    edge = lambda x: 0.5 * (1 + _erf(x / (distance * math.sqrt(2))).astype(float))
    mass = edge(low + width) - edge(low)
    kept = 256
    while True:
        chance, chosen = np.ones(1), np.empty((1, 0), np.int64)
        for m in mass:
            both = (chance[:, None] * m[None, :]).ravel()
            order = np.argsort(-both, kind="stable")[:kept]
            chosen = np.c_[chosen[order // len(steps)], steps[order % len(steps)]]
            chance = both[order]
        reached = np.cumsum(chance)
        if reached[-1] >= aim or len(chance) < kept:
            return chosen[: int(np.searchsorted(reached, aim)) + 1]
        kept *= 4


def _packed(table: int, buckets: np.ndarray, ids: np.ndarray, x: np.ndarray) -> Iterator[tuple]:
    order = np.lexsort((ids, buckets))
    buckets, ids, x = buckets[order], ids[order], x[order]
    starts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(buckets)]):
        yield table, int(buckets[a]), ids[a:b].tobytes(), x[a:b].tobytes()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((), (), (), ())
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["tab", "bucket", "ids", "vectors"])


def _indexed(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = np.asarray(batch.column(0), np.int64), matrix(batch.column(1), index.length)
            for t in range(len(index.directions)):
                yield _rows(list(_packed(t, index.buckets(np.floor(index.cells(x, t))), ids, x)))

    return run


def _probes(index: Index):
    aim = 1 - (1 - index.recall) ** (1 / len(index.directions))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            ids, x = np.asarray(batch.column(0), np.int64), matrix(batch.column(1), index.length)
            reach = []
            for i, v in zip(ids, x):
                other = index.sample_ids != i
                others = np.sqrt(((index.sample[other] - v) ** 2).sum(axis=1))
                others = _least(others, index.sample_ids[other]) if len(others) else others
                kth = np.sort(others)[min(index.k, len(others)) - 1] if len(others) else 0.0
                reach.append(max(float(kth), 1e-6 * index.width))
            for t in range(len(index.directions)):
                place = index.cells(x, t)
                cell = np.floor(place)
                near = [probe_offsets(f * index.width, r, index.width, aim) for f, r in zip(place - cell, reach)]
                which = np.repeat(np.arange(len(ids)), [len(n) for n in near])
                if len(which):
                    buckets = index.buckets(cell[which] + np.concatenate(near))
                    yield _rows(list(_packed(t, buckets, ids[which], x[which])))

    return run


def _reranked(length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(k, np.float64)
        for batch in slices(batches, 64):
            for ids, vectors, q_ids, queries in zip(*[c.to_pylist() for c in batch.columns]):
                ids, q_ids = np.frombuffer(ids, np.int64), np.frombuffer(q_ids, np.int64)
                x, q = np.frombuffer(vectors).reshape(-1, length), np.frombuffer(queries).reshape(-1, length)
                squares = (x * x).sum(axis=1)
                for at in range(0, len(q), 512):
                    own = q[at : at + 512]
                    rough = (own * own).sum(axis=1)[:, None] + squares[None, :] - 2 * own @ x.T
                    rough[q_ids[at : at + 512][:, None] == ids[None, :]] = np.inf
                    each = _least(rough, ids)  # a stored row is sorted by id
                    if each.shape[1] > k:
                        limit = np.partition(each, k - 1, axis=1)[:, k - 1]
                    else:
                        limit = np.full(len(own), np.finfo(float).max)
                    slack = 1e-9 * ((own * own).sum(axis=1) + squares.max())
                    a, b = np.nonzero((rough <= (limit + slack)[:, None]) & np.isfinite(rough))
                    exact = np.sqrt(((own[a] - x[b]) ** 2).sum(axis=1))
                    best.add(q_ids[at : at + 512][a], ids[b], exact)
        yield from best.batches()

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Queries in blocks."""
    for batch in slices(batches, 512):
        if batch.num_rows:
            x = np.asarray(batch.column(1).flatten(), np.float64)
            ids = np.asarray(batch.column(0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())], names=["q_ids", "queries"])


def nearest(vectors: DataFrame, queries: DataFrame, k: int, **settings) -> DataFrame:
    """query_id, rank, vec_id, distance: the `k` nearest found of each query among all other vectors.

    Both frames: vec_id, embedding.
    """
    spark = vectors.sparkSession
    length_of = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")).where(
        F.col("vec_id").isNotNull() & finite("v") & F.exists("v", lambda c: c != 0)
    ).withColumn("v", F.col("v").cast("array<double>"))
    every = checkpointed(length_of(vectors.dropDuplicates(["vec_id", "embedding"])))
    index = fit(every, k, **settings)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, distance double")
    own = F.size("v") == index.length
    stored = every.where(own).mapInArrow(_indexed(index), BUCKETS)
    asked = length_of(queries).where(own)
    probes = asked.mapInArrow(_probes(index), BUCKETS).select("tab", "bucket", F.col("ids").alias("q_ids"), F.col("vectors").alias("queries"))
    met = stored.join(probes, ["tab", "bucket"]).select("ids", "vectors", "q_ids", "queries")
    compared = lambda pairs: ranked(pairs.mapInArrow(_reranked(index.length, k), "query_id long, vec_id long, rank_by double"), k)
    found = checkpointed(compared(met))
    # a query far from everything may have met fewer than k vectors: it visits every bucket of one table
    done = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = checkpointed(asked.join(done, "vec_id", "left_anti"))
    if short.take(1):
        blocks = short.mapInArrow(_blocks, "q_ids binary, queries binary").withColumn("slot", F.monotonically_increasing_id())
        blocks = checkpointed(blocks)
        slots = [r["slot"] for r in blocks.select("slot").collect()]  # one number per block of queries
        dealt = stored.where("tab = 0").withColumn("slot", F.explode(F.array(*[F.lit(s) for s in slots])))
        scanned = compared(dealt.join(blocks, "slot").select("ids", "vectors", "q_ids", "queries"))
        found = found.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(scanned)
    return found.select("query_id", "rank", "vec_id", F.col("rank_by").alias("distance"))
