"""Packing along a space-filling curve.

Each document's token counts are hashed into a vector, projected to a few dimensions and given the place of
its cell on a Hilbert curve. Documents are range-sorted by that place and laid end to end, so a sequence
holds neighbours; sequences are cut from the stream without gaps, and only the last one is padded.

Null text counts as empty (only the end id). Rows that repeat a doc_id, also whole rows, are packed each.
Equal places on the curve are ordered by doc_id, then by a hash of the text. Other columns are not looked
at. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import pieces_for, slices
from marquee.llm.tokens import encoder
from marquee.session import checkpointed

DIMENSIONS = 4
BITS = 12
HASHED = 256
PART_TOKENS = 1 << 21
MOST_PARTS = 10_000  # more documents make larger parts
PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, curve long, ids binary"
)


def projection(seed: int = 11) -> np.ndarray:
    """Fixed random directions: hashed vector -> few dimensions."""
    return np.random.default_rng(seed).normal(size=(HASHED, DIMENSIONS))


@functools.lru_cache(maxsize=1)
def _bucket_of(ids: int) -> np.ndarray:
    """Hash bucket of each token id."""
    return ((np.arange(ids, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)).astype(np.int64)


def hashed_vectors(rows: list[np.ndarray]) -> np.ndarray:
    """Per document a unit vector of the log counts of its ids' buckets."""
    buckets = _bucket_of(1 << 16)[np.concatenate(rows) & 0xFFFF] if rows else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(rows)) * HASHED, [len(r) for r in rows])
    counts = np.log1p(np.bincount(owner + buckets, minlength=len(rows) * HASHED)).reshape(len(rows), HASHED)
    norms = np.linalg.norm(counts, axis=1, keepdims=True)
    return counts / np.where(norms > 0, norms, 1.0)


def cells(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Cell numbers per dimension; coordinates are squeezed into (0, 1) first."""
    return np.minimum((1 << bits) - 1, np.floor((1 << bits) / (1 + np.exp(-1.7 * points)))).astype(np.int64)


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each cell (row of whole numbers) on the Hilbert curve.

    From the top bit down, the curve's cell at one level is mirrored and turned by the bits above; the
    Gray code of the turned bits gives the place.
    """
    x = points.T.astype(np.int64).copy()
    dims = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        below = level - 1
        for d in range(dims):
            mirror = (x[d] & level) != 0
            swap = np.where(mirror, 0, (x[0] ^ x[d]) & below)
            x[0] = np.where(mirror, x[0] ^ below, x[0] ^ swap)
            x[d] ^= swap
        level >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn, level = np.zeros_like(x[0]), 1 << (bits - 1)
    while level > 1:
        turn = np.where(x[-1] & level, turn ^ (level - 1), turn)
        level >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> bit) & 1)
    return key


def _encode(vocabulary: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, directions = encoder(vocabulary), projection()
        small = encode.tokenizer.get_vocab_size() <= 1 << 16
        for batch in slices(batches, 256):
            rows = [np.frombuffer(encode(t) + end, "<u4") for t in batch.column(1).to_pylist()]
            keys = hilbert_key(cells(hashed_vectors([r[:-1] for r in rows]) @ directions))
            stored = [(r.astype("<u2") if small else r).tobytes() for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(keys), pa.array([len(r) for r in rows], pa.int64()),
                 pa.array(stored, pa.binary())],
                names=["doc_id", "tie", "curve", "n", "ids"],
            )

    return run


def _dealt(starts: list[tuple], bases: list[int]):
    """Adds the part a row belongs to and the tokens of all parts before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            where = zip(*[b.column(n).to_pylist() for n in ("curve", "doc_id", "tie")])
            parts = [max(0, bisect.bisect_right(starts, (c, d is not None, d or 0, t)) - 1) for c, d, t in where]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(parts, pa.int32()), pa.array([bases[p] for p in parts], pa.int64())],
                names=[*b.schema.names, "part", "base"],
            )

    return run


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = None, 0
        for b in slices(batches, 512):
            out = []
            for doc, curve, n, ids, own, base in zip(
                *[b.column(x).to_pylist() for x in ("doc_id", "curve", "n", "ids", "part", "base")]
            ):
                if own != part:
                    part, at = own, base
                wide = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4").tobytes()
                first = 0
                while first < n:
                    sequence, offset = divmod(at, length)
                    size = min(n - first, length - offset)
                    out.append((doc, first, size, n, sequence, offset, curve, wide[4 * first : 4 * (first + size)]))
                    first, at = first + size, at + size
            kinds = [pa.int64()] * 7 + [pa.binary()]
            names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "curve", "ids"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 8, kinds)], names=names
            )

    return run


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, length: int = 1024) -> DataFrame:
    """Pieces of documents with their place in sequences of `length` tokens, ordered along the curve.

    `ids` holds the piece's ids as little-endian unsigned 32-bit integers; the pieces of one sequence in the
    order of `offset` are that sequence.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    encoded = checkpointed(
        texts.withColumn("tie", F.xxhash64("text")).mapInArrow(
            _encode(vocabulary, end_id), "doc_id long, tie long, curve long, n long, ids binary"
        )
    )
    total = encoded.agg(F.sum("n")).first()[0]
    parts = min(MOST_PARTS, pieces_for(total, PART_TOKENS))
    order = ["curve", "doc_id", "tie"]
    sums = (
        encoded.select(*order, "n")
        .repartitionByRange(parts, *order)
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(
            F.min(F.struct("curve", F.col("doc_id").isNotNull().alias("has"), F.coalesce("doc_id", F.lit(0)).alias("d"), "tie")).alias("least"),
            F.sum("n").alias("n"),
        )
        .orderBy("part")
        .collect()  # one row per part
    )
    starts = [tuple(r["least"]) for r in sums]
    bases = np.r_[0, np.cumsum([r["n"] for r in sums])[:-1]].astype(int).tolist() if sums else [0]
    dealt = encoded.mapInArrow(
        _dealt(starts, bases), "doc_id long, tie long, curve long, n long, ids binary, part int, base long"
    )
    return (
        dealt.repartitionById(max(1, len(sums)), F.col("part"))
        .sortWithinPartitions("part", *order)
        .mapInArrow(_cut(length), PIECES)
    )


def sequences(pieces: DataFrame, length: int = 1024, pad_id: int = 0) -> DataFrame:
    """One row per sequence: its ids, padded at the end to `length`; a total that is a power of two is left as it is."""
    n = F.sum("length")
    joined = pieces.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("p"), n.alias("n")
    )  # at most `length` pieces
    padding = F.when((F.col("n").bitwiseAND(F.col("n") - 1)) == 0, F.lit(0)).otherwise(F.lit(length) - F.col("n"))
    pad = bytes(np.array([pad_id], "<u4").tobytes()).hex()
    filled = F.unhex(F.concat(F.expr("array_join(transform(p, x -> hex(x.ids)), '')"), F.expr(f"repeat('{pad}', int(pads))")))
    return joined.withColumn("pads", padding).select(
        "sequence_id", "n", "pads", filled.alias("ids"), F.col("p.doc_id").alias("doc_ids")
    )
