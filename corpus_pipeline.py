"""The corpus pipeline: documents -> packed sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import line_templates, mixing, order_minhash, packing, queries, toxicity
from marquee.llm.common import table
from marquee.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, fitted on the labelled ones, finds toxic go."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go from all documents but the first."""
    cleaned = line_templates.drop_recurring(docs)
    return cleaned.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return order_minhash.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, repeated or left out as their source's target asks."""
    return mixing.mix(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences."""
    pieces = packing.pack(docs, queries.vocabulary_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "curve"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
ORACLE_SQL = None  # trained models, alignment and tokenization are not SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "_"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
