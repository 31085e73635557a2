"""Venue, genre and organizer tables, and the lookups built from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import constants as K
from marquee.functions import text
from marquee.schemas import GENRE, ORGANIZER, VENUE
from marquee.session import small


@dataclass(frozen=True)
class Dimensions:
    """`by_id` and `by_alias` hold the same venue columns, keyed by id and by normalized alias."""

    by_id: DataFrame
    by_alias: DataFrame


def read_records(spark: SparkSession, path: str, key: str, schema: T.StructType) -> DataFrame:
    """Rows of a `{"<key>": [...]}` file, numbered by their place in the list."""
    file = T.StructType([T.StructField(key, T.ArrayType(schema))])
    rows = spark.read.schema(file).json(path, multiLine=True)
    return rows.select(F.posexplode(key).alias("ord", "rec")).select("ord", "rec.*")


def read_venues(spark: SparkSession, path: str) -> DataFrame:
    return read_records(spark, path, "venues", VENUE)


def read_genres(spark: SparkSession, path: str) -> DataFrame:
    return read_records(spark, path, "genres", GENRE)


def read_organizers(spark: SparkSession, path: str) -> DataFrame:
    return read_records(spark, path, "organizers", ORGANIZER)


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    file = T.StructType([T.StructField("stopwords", T.ArrayType(T.StringType()))])
    rows = spark.read.schema(file).json(path, multiLine=True)
    return rows.select(F.explode("stopwords").alias("w")).select(text.normalize_text(F.col("w")).alias("word")).distinct()


def alias_table(venues: DataFrame) -> DataFrame:
    """Normalized alias -> venue id. Where two venues share one, the later venue has it;
    a venue's own name counts after its aliases."""
    names = F.concat(F.coalesce("aliases", F.array().cast("array<string>")), F.array("canonical_name"))
    return (
        venues.select("ord", "id", F.posexplode(names).alias("pos", "name"))
        .withColumn("alias_key", text.normalize_text(F.col("name")))
        .groupBy("alias_key")
        .agg(F.max_by("id", F.struct("ord", "pos")).alias("venue_id"))
    )


def venue_dimensions(venues: DataFrame) -> Dimensions:
    """Lookups for the joins; each is broadcast only if it measures small."""
    facts = venues.select(
        F.col("id").alias("venue_id"), "canonical_name", "address", "lat", "lng", "area", "genres"
    )
    by_alias = alias_table(venues).join(facts, "venue_id")
    return Dimensions(small(facts), small(by_alias))


def term_table(genres: DataFrame, stopwords: list[str] = K.GENRE_STOPWORDS) -> DataFrame:
    """One row per usable term: term, its first word, word count, and the genre it stands for."""
    listed = F.concat(
        F.coalesce("keywords", F.array().cast("array<string>")),
        F.coalesce("aliases", F.array().cast("array<string>")),
    )
    terms = (
        genres.select("ord", "id", "weight", F.explode(listed).alias("raw"))
        .withColumn("term", text.normalize_text(F.col("raw")))
        .where(F.col("term") != "")
        .withColumn("n_words", F.size(F.split("term", " ")))
        .where(~((F.col("n_words") == 1) & F.col("term").isin(stopwords)))
    )
    return terms.select(
        "term", F.substring_index("term", " ", 1).alias("first_word"), "n_words",
        F.col("id").alias("genre_id"), "weight", "ord",
    ).distinct()


def genre_labels(genres: DataFrame) -> DataFrame:
    """Every genre with the pair it is reported as: (parent label, own label) or (own label, null)."""
    parents = genres.select(F.col("id").alias("parent"), F.col("label").alias("parent_label"))
    parent = F.nullif(F.col("parent"), F.lit(""))
    return genres.join(parents, "parent", "left").select(
        F.col("id").alias("genre_id"),
        F.when(parent.isNull(), F.col("label"))
        .otherwise(F.coalesce("parent_label", "parent"))
        .alias("genre"),
        F.when(parent.isNotNull(), F.col("label")).alias("subgenre"),
    )
