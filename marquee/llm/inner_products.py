"""Exact top-k by inner product over norm-sorted vectors.

Vectors of whole numbers are sorted by descending length and cut into blocks. Queries come in blocks too;
every query block meets every vector block whose greatest length can still beat the block's thresholds. For
a pair of blocks the products are summed over the first components of a rotated space (the right singular
vectors of all vectors, so these hold most of the length); what the rest can add is at most the product of
the lengths of the rests (Cauchy-Schwarz), and only products that can reach the query's k-th best score are
computed in full, in whole numbers. Thresholds start from the longest vectors of all and rise as a task
goes through its vector blocks from long to short.

Vectors that are null, empty, of another length than most, or hold a null or non-finite component take no
part; rows with a null vec_id neither. Zero vectors do. Rows that repeat a vec_id are one candidate, with
the greatest of their scores: equal rows are dropped first, and thresholds are k-th best scores over distinct
vec_ids. Ties go to the smaller vec_id. An empty table gives an empty result. Products
are exact as long as they stay below 2^53. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import pieces_for
from marquee.llm.vectors import Best, common_length, finite, matrix, ranked
from marquee.session import checkpointed, small

HEAD = 2048
BLOCK_VECTORS = 4096
BLOCK_QUERIES = 512
FIRST_SHARE = 0.5
DENSE_SHARE = 0.01


def _moments(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((length, length))
        for batch in batches:
            x = matrix(batch.column(0), length)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(length), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["row", "sums"])

    return run


def rotation(vectors: DataFrame, length: int) -> np.ndarray:
    """Right singular vectors of all vectors, strongest first (a matrix of `length` by `length`)."""
    parts = vectors.select("v").mapInArrow(_moments(length), "row int, sums array<double>")
    rows = parts.select("row", F.posexplode("sums").alias("col", "s")).groupBy("row", "col").agg(F.sum("s").alias("s")).collect()  # length squared
    moments = np.zeros((length, length))
    for r in rows:
        moments[r["row"], r["col"]] = r["s"]
    return np.linalg.eigh(moments)[1][:, ::-1]


def _blocks(length: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out(rows):
            ids, x = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
            longest = float(np.sqrt((x * x).sum(axis=1).max()))
            return pa.RecordBatch.from_arrays(
                [pa.array([longest]), pa.array([ids.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary())], names=["longest", "ids", "vectors"]
            )

        for batch in batches:
            ids, x = np.asarray(batch.column(0), np.int64), matrix(batch.column(1), length)
            while len(ids):
                room = size - sum(len(r[0]) for r in held)
                held.append((ids[:room], x[:room]))
                ids, x = ids[room:], x[room:]
                if sum(len(r[0]) for r in held) >= size:
                    yield out(held)
                    held = []
        if held:
            yield out(held)

    return run


def _starts(length: int, k: int, head_ids: np.ndarray, head: np.ndarray):
    """Adds to a query block each query's k-th best score among the vec_ids of the longest vectors (or minus infinity)."""
    order = np.argsort(head_ids, kind="stable")
    head_ids, head = head_ids[order], head[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors, reach = [], []
            for ids, vectors in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                ids, q = np.frombuffer(ids, np.int64), np.frombuffer(vectors).reshape(-1, length)
                scores = np.where(ids[:, None] == head_ids[None, :], -np.inf, q @ head.T)
                scores = np.maximum.reduceat(scores, np.flatnonzero(np.r_[True, head_ids[1:] != head_ids[:-1]]), axis=1)  # one column per vec_id
                low = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(q), -np.inf)
                floors.append(low.tobytes())
                norms = np.sqrt((q * q).sum(axis=1))
                least = np.where(norms > 0, low / np.where(norms > 0, norms, 1), np.where(low <= 0, -np.inf, np.inf))
                reach.append(float(least.min()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(floors, pa.binary()), pa.array(reach)], names=["q_ids", "queries", "floors", "reach"]
            )

    return run


def block_scores(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, floor: np.ndarray, turn: np.ndarray, first: int):
    """(query, vector, score) of the pairs that reach the floors; whole numbers, so any order of summing is exact."""
    rq, rx = q @ turn, x @ turn
    rest = np.sqrt((rq[:, first:] ** 2).sum(axis=1))[:, None] * np.sqrt((rx[:, first:] ** 2).sum(axis=1))[None, :]
    most = rq[:, :first] @ rx[:, :first].T + rest
    slack = 1e-9 * (1 + np.abs(most).max(initial=0))
    open_ = (most >= floor[:, None] - slack) & (q_ids[:, None] != ids[None, :])
    if open_.sum() > DENSE_SHARE * open_.size:  # one product of the rows and columns that are open is less work
        rows, columns = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
        exact = q[rows] @ x[columns].T
        i, j = np.nonzero(open_[np.ix_(rows, columns)] & (exact >= floor[rows][:, None]))
        return rows[i], columns[j], exact[i, j]
    a, b = np.nonzero(open_)
    exact = (q[a] * x[b]).sum(axis=1)
    keep = exact >= floor[a]
    return a[keep], b[keep], exact[keep]


def _products(length: int, k: int, turn: np.ndarray, first: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, floors = Best(k, np.int64), {}
        for batch in batches:
            for ids, vectors, q_ids, queries, start in zip(*[c.to_pylist() for c in batch.columns]):
                key = q_ids
                ids, q_ids = np.frombuffer(ids, np.int64), np.frombuffer(q_ids, np.int64)
                x, q = np.frombuffer(vectors).reshape(-1, length), np.frombuffer(queries).reshape(-1, length)
                floor = floors.get(key)
                if floor is None:
                    floor = np.frombuffer(start).copy()
                for at in range(0, len(x), 1024):
                    a, b, score = block_scores(q, q_ids, x[at : at + 1024], ids[at : at + 1024], floor, turn, first)
                    if not len(a):
                        continue
                    order = np.lexsort((-score, ids[at + b], a))
                    a, b, score = a[order], b[order], score[order]
                    fresh = np.r_[True, (a[1:] != a[:-1]) | (ids[at + b[1:]] != ids[at + b[:-1]])]  # the best row of each vec_id
                    a, b, score = a[fresh], b[fresh], score[fresh]
                    order = np.lexsort((ids[at + b], -score, a))
                    a, b, score = a[order], b[order], score[order]
                    begins = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
                    place = np.arange(len(a)) - np.repeat(begins, np.diff(np.r_[begins, len(a)]))
                    kept = place < k
                    best.add(q_ids[a[kept]], ids[at + b[kept]], -score[kept].astype(np.int64))
                    last = place == k - 1
                    floor[a[last]] = np.maximum(floor[a[last]], score[last])
                if len(floors) > 256:
                    floors.clear()
                floors[key] = floor
        yield from best.batches()

    return run


def meetings(vector_blocks: DataFrame, query_blocks: DataFrame) -> DataFrame:
    """ids, vectors, q_ids, queries, floors: every query block (q_ids, queries, floors, reach, slot) with all vector
    blocks (longest, ids, vectors) whose greatest length reaches its thresholds, in descending order of that length
    within each task, so that thresholds rise early wherever the blocks were fetched from."""
    slots = query_blocks.select("slot", "reach")  # two numbers per block of queries
    dealt = vector_blocks.join(small(slots), F.col("reach") <= F.col("longest")).drop("reach")
    met = dealt.join(query_blocks.drop("reach").hint("merge"), "slot")
    return met.sortWithinPartitions("slot", F.col("longest").desc()).select("ids", "vectors", "q_ids", "queries", "floors")


def top_products(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` greatest inner products of each query with all other vectors.

    Both frames: vec_id, v (array of whole numbers as doubles).
    """
    spark = vectors.sparkSession
    valid = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), "v").where(F.col("vec_id").isNotNull() & finite("v"))
    every = valid(vectors)
    length = common_length(every)
    if not length:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)
    every = checkpointed(every.where(F.size("v") == length).dropDuplicates(["vec_id", "v"]).withColumn("square", square))
    asked = valid(queries).where(F.size("v") == length).dropDuplicates(["vec_id", "v"])
    turn = rotation(every, length)
    first = max(1, int(length * FIRST_SHARE))
    head = every.orderBy(F.col("square").desc(), "vec_id").limit(HEAD).collect()  # at most HEAD
    head_ids, head_x = np.array([r["vec_id"] for r in head], np.int64), np.array([r["v"] for r in head])
    vector_blocks = (
        every.repartitionByRange(pieces_for(every.count(), BLOCK_VECTORS), F.col("square").desc(), "vec_id")
        .sortWithinPartitions(F.col("square").desc(), "vec_id")
        .select("vec_id", "v")
        .mapInArrow(_blocks(length, BLOCK_VECTORS), "longest double, ids binary, vectors binary")
    )
    n_blocks = pieces_for(asked.count(), BLOCK_QUERIES)
    query_blocks = (
        asked.repartition(n_blocks, F.xxhash64("vec_id", F.lit(9)))
        .mapInArrow(_blocks(length, BLOCK_QUERIES), "longest double, ids binary, vectors binary")
        .mapInArrow(_starts(length, k, head_ids, head_x), "q_ids binary, queries binary, floors binary, reach double")
    )
    met = meetings(vector_blocks, checkpointed(query_blocks.withColumn("slot", F.monotonically_increasing_id())))
    found = met.mapInArrow(_products(length, k, turn, first), "query_id long, vec_id long, rank_by long")
    return ranked(found, k).select("query_id", "rank", "vec_id", (-F.col("rank_by")).alias("score"))
