"""Enrichers: DataFrame -> DataFrame functions to chain with `.transform`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.functions import arrays, text
from marquee.operators import filters
from marquee.operators.joins import area_of
from marquee.session import small
from marquee.sources.dimensions import Dimensions, genre_labels, term_table

Enricher = Callable[[DataFrame], DataFrame]


def on_active(df: DataFrame, enricher: Enricher, columns: list[str]) -> DataFrame:
    """Run an enricher and keep its values for active rows only."""
    before = df.withColumns({f"_was_{c}": F.col(c) for c in columns})
    after = enricher(before)
    values = {
        c: F.when(filters.is_active(), F.col(c)).otherwise(F.col(f"_was_{c}")) for c in columns
    }
    return after.withColumns(values).drop(*[f"_was_{c}" for c in columns])


# --- artists ----------------------------------------------------------------------------------------


def artist_names(combined: Column) -> Column:
    """Names in a text: split on connecting words and delimiters, noise removed, first spelling kept."""
    pieces = F.flatten(
        F.transform(F.split(combined, K.ARTIST_CONNECTORS, -1), lambda p: F.split(p, K.ARTIST_DELIMITERS, -1))
    )
    names = F.transform(pieces, text.strip)
    usable = F.filter(
        names,
        lambda s: F.length(s).between(2, 60)
        & ~F.lower(s).isin(K.ARTIST_NOISE)
        & s.rlike(K.ARTIST_FIRST_CHAR),
    )
    return arrays.distinct_ignoring_case(usable)


def with_artists(df: DataFrame, keep_existing: bool = False) -> DataFrame:
    """Artists from title, description and details. Overwrites, unless `keep_existing`."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("title", "description", "details")]
    found = artist_names(F.concat_ws("\n", *parts))
    return df.withColumn("artists", arrays.first_filled(F.col("artists"), found) if keep_existing else found)


# --- genre --------------------------------------------------------------------------------------------


# first words of terms that are looked up inside the row; a longer list is left to the join
FIRST_WORDS = 5000


def first_words(terms: DataFrame) -> list[str] | None:
    """The words that terms begin with, or None if there are too many to look up inside a row."""
    found = terms.select("first_word").distinct().limit(FIRST_WORDS + 1).collect()
    return [r["first_word"] for r in found] if len(found) <= FIRST_WORDS else None


def phrases(normalized: Column, n: int, first: list[str] | None = None) -> Column:
    """The next `n` words from every word of a normalized text on, or from the words in `first` alone."""

    def following(words: Column) -> Column:
        phrase = lambda i: F.array_join(F.slice(words, i + 1, n), " ")
        if first is None:
            return F.transform(words, lambda w, i: phrase(i))
        return F.filter(F.transform(words, lambda w, i: F.when(w.isin(first), phrase(i))), lambda p: p.isNotNull())

    return text.let(F.split(normalized, " "), following)


def term_hits(texts: DataFrame, id: str, terms: DataFrame, n: int, keep: list[str] = ()) -> DataFrame:
    """(id, ..., term columns) for every whole-word term in a text, given its `phrases`.

    The outer explode keeps Spark from computing the phrases again in a filter on their number. One row per word, joined to the terms on their first word; the words that follow are compared
    after the join. The terms are a bounded table, so no text is shuffled.
    """
    grams = texts.select(id, *keep, F.explode_outer("phrases").alias("phrase"))
    begins = F.concat("phrase", F.lit(" ")).startswith(F.concat("term", F.lit(" ")))
    return (
        grams.withColumn("first_word", F.substring_index("phrase", " ", 1))
        .join(small(terms), "first_word")
        .where(begins)
        .drop("phrase", "first_word")
    )


def _longest_term(terms: DataFrame) -> int:
    return terms.agg(F.coalesce(F.max("n_words"), F.lit(1))).first()[0]


def best_genre(texts: DataFrame, id: str, terms: DataFrame) -> DataFrame:
    """(id, genre_id) by pass, then word count, weight and list order.

    texts: (id, pass, text), text already normalized.
    """
    n = _longest_term(terms)
    # no filter on the text: Spark would normalize it once more for that, ahead of a shuffle that deals the rows
    found = F.when(F.col("text") != "", phrases(F.col("text"), n, first_words(terms)))
    shaped = texts.select(id, "pass", found.alias("phrases"))
    hits = term_hits(shaped, id, terms, n, ["pass"])
    order = F.struct("pass", -F.col("n_words"), -F.col("weight"), "ord")
    return hits.groupBy(id).agg(F.min_by("genre_id", order).alias("genre_id"))


def combined_text(venue_genres: Column) -> Column:
    plain = [F.coalesce(F.col(c), F.lit("")) for c in ("title", "description", "details")]
    lists = [arrays.joined(F.col(c), " ") for c in ("artists", "support_acts")]
    collective = F.coalesce(F.col("collective"), F.lit(""))
    return text.normalize_text(F.concat_ws(" ", *plain, *lists, collective, arrays.joined(venue_genres, " ")))


def with_genre(df: DataFrame, genres: DataFrame, dims: Dimensions) -> DataFrame:
    """Genre and subgenre by the longest whole-word term.

    The source's own tag is tried first and alone, then all texts of the event, then the first genre
    of the venue by label or alias.
    """
    terms = term_table(genres)
    venue = dims.by_id.select(F.col("venue_id").alias("_id"), F.col("genres").alias("_venue_genres"))
    rows = df.join(venue, F.col("venue_id") == F.col("_id"), "left").drop("_id")
    texts = F.array(
        F.struct(F.lit(0).alias("pass"), text.normalize_text(F.col("genre_raw")).alias("text")),
        F.struct(F.lit(1).alias("pass"), combined_text(F.col("_venue_genres")).alias("text")),
    )
    tagged = rows.select("event_id", F.explode(texts).alias("t")).select("event_id", "t.*")
    best = best_genre(tagged, "event_id", terms)

    labels = F.concat(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>")))
    names = genres.select("ord", F.col("id").alias("genre_id"), F.explode(labels).alias("name"))
    by_name = (
        names.withColumn("name", text.normalize_text(F.col("name")))
        .groupBy("name")
        .agg(F.min_by("genre_id", "ord").alias("_fallback"))
    )
    first = text.normalize_text(F.get("_venue_genres", F.lit(0)))
    joined = (
        rows.join(best, "event_id", "left")
        .withColumn("_name", first)
        .join(small(by_name), F.col("_name") == F.col("name"), "left")
        .withColumn("genre_id", F.coalesce("genre_id", "_fallback"))
        .drop("genre", "subgenre", "name", "_name", "_fallback", "_venue_genres")
    )
    found = joined.join(small(genre_labels(genres)), "genre_id", "left").drop("genre_id")
    return found.select(*df.columns)


def mentions_genre(df: DataFrame, id: str, content: Column, terms: DataFrame) -> DataFrame:
    """Rows whose text holds at least one term."""
    n = _longest_term(terms)
    shaped = df.select(id, phrases(text.normalize_text(content), n, first_words(terms)).alias("phrases"))
    return df.join(term_hits(shaped, id, terms, n).select(id), id, "left_semi")


# --- place ----------------------------------------------------------------------------------------------


def geo_query(address: Column, venue: Column, city: str = "Gent, Belgium") -> Column:
    """Text to look a place up by: address, else venue, with the city."""
    name = F.coalesce(F.nullif(address, F.lit("")), F.nullif(venue, F.lit("")))
    return F.concat(name, F.lit(f", {city}"))


def with_place(df: DataFrame, dims: Dimensions, cache: DataFrame) -> DataFrame:
    """Coordinates, address and area: own, by venue id, by venue name, from the cache, in this order.

    cache: (query, lat, lng), null coordinates for a known miss. Adds `place_from`; null marks rows for
    the review queue, and `geo_query` holds what to look up.
    """
    by_id = dims.by_id.select(
        F.col("venue_id").alias("_id"), F.struct("venue_id", "address", "lat", "lng", "area").alias("a")
    )
    by_name = dims.by_alias.select(
        "alias_key", F.struct("venue_id", "address", "lat", "lng", "area").alias("b")
    )
    cached = cache.select(F.col("query").alias("_q"), F.struct("lat", "lng").alias("c"))
    rows = (
        df.withColumn("geo_query", geo_query(F.col("address"), F.col("venue")))
        .withColumn("_name", text.normalize_text(F.nullif(F.col("venue"), F.lit(""))))
        .join(by_id, F.col("venue_id") == F.col("_id"), "left")
        .join(by_name, F.col("_name") == F.col("alias_key"), "left")
        .join(small(cached), F.col("geo_query") == F.col("_q"), "left")
    )
    own = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    step = (
        F.when(own, "own")
        .when(F.col("a.lat").isNotNull(), "venue id")
        .when(F.col("b.lat").isNotNull(), "venue name")
        .when(F.col("c.lat").isNotNull(), "cache")
    )
    place = F.when(step == "venue id", F.col("a")).when(step == "venue name", F.col("b"))
    rows = rows.withColumn("place_from", step).withColumn("_p", place)
    found = F.col("place_from").isin("venue id", "venue name")
    lat = F.when(F.col("place_from") == "cache", F.col("c.lat")).otherwise(
        F.coalesce(F.when(found, F.col("_p.lat")), F.col("latitude"))
    )
    lng = F.when(F.col("place_from") == "cache", F.col("c.lng")).otherwise(
        F.when(found, F.col("_p.lng")).otherwise(F.col("longitude"))
    )
    rows = rows.withColumns(
        {
            "latitude": lat,
            "longitude": lng,
            "address": F.coalesce(F.when(found, F.col("_p.address")), F.col("address")),
            "venue_id": F.when(F.col("place_from") == "venue name", F.col("_p.venue_id")).otherwise(F.col("venue_id")),
        }
    )
    inferred = area_of(F.col("latitude"), F.col("longitude"))
    area = (
        F.when(F.col("place_from") == "own", F.coalesce("area", inferred))
        .when(found, F.coalesce(F.col("_p.area"), F.when(F.col("latitude") != 0, inferred)))
        .when(F.col("place_from") == "cache", inferred)
        .otherwise(F.col("area"))
    )
    return rows.withColumn("area", area).select(*df.columns, "geo_query", "place_from")


def fill_positions(
    df: DataFrame, cache: DataFrame, box: tuple = K.CITY_BOX
) -> DataFrame:
    """Coordinates for rows that have an address but no position, from the cache, inside the box only.

    Adds `located`: 'already', 'filled', 'unresolved' (in the cache without a usable hit), 'todo'
    (never looked up) or 'no address'.
    """
    hits = cache.select(
        F.col("address").alias("_key"), F.col("lat").alias("_lat"), F.col("lng").alias("_lng")
    )
    key = text.blank_to_null(F.col("address"))
    missing = F.col("lat").isNull() | F.col("lng").isNull()
    joined = df.withColumn("_wanted", F.when(missing, key)).join(
        small(hits), F.col("_wanted") == F.col("_key"), "left"
    )
    low_lat, high_lat, low_lng, high_lng = box
    inside = F.col("_lat").between(low_lat, high_lat) & F.col("_lng").between(low_lng, high_lng)
    state = (
        F.when(~missing, "already")
        .when(key.isNull(), "no address")
        .when(F.coalesce(inside, F.lit(False)), "filled")
        .when(F.col("_key").isNotNull(), "unresolved")
        .otherwise("todo")
    )
    filled = F.col("located") == "filled"
    return (
        joined.withColumn("located", state)
        .withColumns(
            {
                "lat": F.when(filled, F.col("_lat")).otherwise(F.col("lat")),
                "lng": F.when(filled, F.col("_lng")).otherwise(F.col("lng")),
            }
        )
        .drop("_wanted", "_key", "_lat", "_lng")
    )
