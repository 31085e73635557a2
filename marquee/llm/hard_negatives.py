"""Hard negatives by exact whole-number products of anchors and candidates.

Anchors and candidates are dealt by a hash of vec_id into groups of a bounded number of cells, and every
group of anchors meets every group of candidates once, as a tile of one task (an equi-join of the two group
numbers, so no group grows with the data). A tile's products are taken by Strassen's recursion on int64
matrices, padded with zeros to even sides: seven half-size products instead of eight, with whole-number
additions only. Arithmetic modulo 2^64 is a ring, so every product that fits in 64 bits is exact even where
a sum on the way does not.

Two rounds of tiles feed bounded heaps, which merge over tiles in any order. The first keeps each anchor's
best rows of its own label (its positives); the second keeps, for each anchor and positive, the best rows
of other labels whose score lies in the positive's window.

Rows with a null vec_id, label or vector, an empty vector, or a null component take no part, nor do vectors
of another length than most. Rows that repeat a vec_id are one row: the least by label, then by vector.
Zero vectors take part. Equal scores are in the order of vec_id. An anchor without positives, or a positive
without a negative in its window, gives no row; an empty table gives an empty result. Components beyond 64
bits are cut to them by the cast to long. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import pieces_for
from marquee.llm.vectors import Best, common_length, ranked
from marquee.session import checkpointed

LEAF = 16
ANCHOR_CELLS = 1 << 15
CANDIDATE_CELLS = 1 << 20
CHUNK = 2048
LEAST = np.iinfo(np.int64).min
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b of int64 matrices, modulo 2^64. Sides up to `leaf` end the recursion."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a, b = np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, h = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    out = np.empty((2 * i, 2 * h), np.int64)
    c11, c12, c21, c22 = out[:i, :h], out[:i, h:], out[i:, :h], out[i:, h:]
    p = strassen(a11 + a22, b11 + b22, leaf)
    c11[:], c22[:] = p, p
    p = strassen(a21 + a22, b11, leaf)
    c21[:] = p
    c22 -= p
    p = strassen(a11, b12 - b22, leaf)
    c12[:] = p
    c22 += p
    p = strassen(a22, b21 - b11, leaf)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22, leaf)
    c11 -= p
    c12 += p
    c22 += strassen(a21 - a11, b11 + b12, leaf)
    c11 += strassen(a12 - a22, b21 + b22, leaf)
    return out[:m, :n]


def best_columns(scores: np.ndarray, open_: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the `k` greatest open scores of each row; the first columns of equal ones."""
    s = np.where(open_, scores, LEAST)
    edge = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(s), LEAST)
    over, even = open_ & (s > edge[:, None]), open_ & (s == edge[:, None])
    even &= np.cumsum(even, axis=1) <= (k - over.sum(axis=1))[:, None]
    return np.nonzero(over | even)


def share(p: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """percent * p / 100 rounded up or down, without a product that leaves 64 bits."""
    whole, rest = np.divmod(p, 100)
    return percent * whole + (-(-percent * rest // 100) if up else percent * rest // 100)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return np.asarray(table.column(name).combine_chunks(), np.int64)


def _rows(table: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, labels, vectors of a group in the order of label and id."""
    ids, labels = _numbers(table, "vec_id"), _numbers(table, "label")
    flat = table.column("v").combine_chunks().flatten()
    order = np.lexsort((ids, labels))
    return ids[order], labels[order], np.asarray(flat, np.int64).reshape(-1, length)[order]


def _positives(length: int, k: int):
    def tile(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        a_ids, a_labels, a = _rows(anchors, length)
        ids, labels, x = _rows(candidates, length)
        best = Best(k, np.int64)
        for label in np.intersect1d(a_labels, labels):
            one = slice(*np.searchsorted(a_labels, [label, label + 1]))
            first, last = np.searchsorted(labels, [label, label + 1])
            for at in range(first, last, CHUNK):
                cut = slice(at, min(at + CHUNK, last))
                scores = strassen(a[one], x[cut].T)
                i, j = best_columns(scores, a_ids[one][:, None] != ids[cut][None, :], k)
                best.add(a_ids[one][i], ids[cut][j], -scores[i, j])
        return pa.Table.from_arrays([pa.array(c) for c in best.combine()], names=["query_id", "vec_id", "rank_by"])

    return tile


def _negatives(length: int, k: int, low: int, high: int):
    def tile(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        scores_of, ids_of = (anchors.column(c).combine_chunks() for c in ("positive_scores", "positive_ids"))
        a_ids, a_labels = _numbers(anchors, "vec_id"), _numbers(anchors, "label")
        a = np.asarray(anchors.column("v").combine_chunks().flatten(), np.int64).reshape(-1, length)
        ids, labels, x = _rows(candidates, length)
        order = np.argsort(ids, kind="stable")
        ids, labels, x = ids[order], labels[order], x[order]
        counts = np.asarray(pc.list_value_length(scores_of), np.int64)
        p, p_ids = np.asarray(scores_of.flatten(), np.int64), np.asarray(ids_of.flatten(), np.int64)
        owner = np.repeat(np.arange(len(a_ids)), counts)  # a row for each anchor and positive
        least, most = share(p, low, True), share(p, high, False)
        best = Best(k, np.int64)
        for at in range(0, len(ids), CHUNK):
            cut = slice(at, at + CHUNK)
            scores = strassen(a, x[cut].T)
            other = a_labels[:, None] != labels[cut][None, :]
            for slot in range(int(counts.max(initial=0))):
                rows = np.flatnonzero(np.arange(len(p)) - np.repeat(np.cumsum(counts) - counts, counts) == slot)
                own = scores[owner[rows]]
                i, j = best_columns(own, other[owner[rows]] & (own >= least[rows][:, None]) & (own <= most[rows][:, None]), k)
                best.add(rows[i], ids[cut][j], -own[i, j])
        row, negative, score = best.combine()
        columns = [a_ids[owner[row]], p_ids[row], negative, p[row], -score]
        return pa.Table.from_arrays([pa.array(c) for c in columns], names=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    return tile


def _tiles(anchors: DataFrame, candidates: DataFrame, a_groups: int, c_groups: int, work, schema: str) -> DataFrame:
    """Every group of anchors with every group of candidates."""
    left = anchors.withColumn("cg", F.explode(F.sequence(F.lit(0), F.lit(c_groups - 1))))
    right = candidates.withColumn("ag", F.explode(F.sequence(F.lit(0), F.lit(a_groups - 1))))
    return left.groupBy("ag", "cg").cogroup(right.groupBy("ag", "cg")).applyInArrow(work, schema)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `rows`: vec_id, label, v (array of longs). For each row that `is_anchor` holds for and each of its `positives` best
    others of the same label, the first `negatives` rows of other labels by descending score with
    low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    spark = rows.sparkSession
    held = rows.withColumn("_anchor", F.coalesce(is_anchor, F.lit(False)))
    held = held.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "v", "_anchor")
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull())
    held = checkpointed(held.where(whole))
    length = common_length(held)
    if not length:
        return spark.createDataFrame([], RESULT)
    one = held.where(F.size("v") == length).groupBy("vec_id").agg(F.min(F.struct("label", "v", "_anchor")).alias("r"))
    every = checkpointed(one.select("vec_id", "r.label", "r.v", "r._anchor"))
    counts = every.agg(F.count(F.lit(1)).alias("all"), F.count_if("_anchor").alias("anchors")).first()
    c_groups, a_groups = pieces_for(counts["all"] * length, CANDIDATE_CELLS), pieces_for(counts["anchors"] * length, ANCHOR_CELLS)
    dealt = lambda n, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    candidates = every.select("vec_id", "label", "v", dealt(c_groups, 1).alias("cg"))
    anchors = every.where("_anchor").select("vec_id", "label", "v", dealt(a_groups, 2).alias("ag"))
    found = _tiles(anchors, candidates, a_groups, c_groups, _positives(length, positives), "query_id long, vec_id long, rank_by long")
    best = ranked(found, positives).groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "rank_by"))).alias("b"))
    chosen = best.select(
        F.col("query_id").alias("vec_id"),
        F.transform("b", lambda r: r["vec_id"]).alias("positive_ids"),
        F.transform("b", lambda r: -r["rank_by"]).alias("positive_scores"),
    )  # at most `positives` to an anchor
    asked = checkpointed(anchors.join(chosen, "vec_id"))
    tiles = _tiles(asked, candidates, a_groups, c_groups, _negatives(length, negatives, low, high), RESULT.replace("rank int, ", ""))
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    names = [c.split()[0] for c in RESULT.split(", ")]
    return tiles.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(*names)
