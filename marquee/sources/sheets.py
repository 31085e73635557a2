"""Sheet tabs as tables of text, addressed by header name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.functions import numbers, text
from marquee.functions.text import split_list, strip
from marquee.operators import filters
from marquee.operators.normalize import resolve_venue, to_event
from marquee.operators.upsert import cell
from marquee.schemas import EVENT, VENUE
from marquee.sources.dimensions import Dimensions


class MissingColumn(ValueError):
    pass


def read_tab(spark: SparkSession, path: str, lower_headers: bool = False) -> DataFrame:
    """A CSV tab; headers are trimmed, and lower-cased if asked for. Blank cells are ''."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)
    names = [c.strip().lower() if lower_headers else c.strip() for c in rows.columns]
    return rows.toDF(*names).na.fill("")


def write_tab(df: DataFrame, path: str) -> None:
    """Clear and rewrite a tab."""
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def column_or_blank(df: DataFrame, name: str) -> Column:
    """Trimmed cell by header name; '' where the tab has no such column."""
    return strip(F.col(name)) if name in df.columns else F.lit("")


def require(df: DataFrame, *names: str) -> DataFrame:
    for name in names:
        if name not in df.columns:
            raise MissingColumn(f"the tab has no column '{name}'")
    return df


def refuse_empty(df: DataFrame) -> DataFrame:
    """A tab with only a header must not replace a table."""
    if df.isEmpty():
        raise ValueError("the tab has no rows; not replacing the table with it")
    return df


def has_overrides(df: DataFrame) -> bool:
    """Whether a tab can be read for human values: it has the key and one of their columns."""
    human = [c for c in K.HUMAN_COLUMNS if c != "notes"]
    return "event_id" in df.columns and any(c in df.columns for c in human)


# --- venues ------------------------------------------------------------------------------------------


def venue_from_row(df: DataFrame) -> DataFrame:
    """Sheet rows as venues; blank cells stay blank, nothing falls back to the stored venue."""
    get = lambda c: column_or_blank(df, c)
    blank = lambda c: text.no_match_to_null(get(c))
    scrape = F.when(get("scrape_type").isin(K.SCRAPE_TYPES), get("scrape_type"))
    columns = {
        "id": get("id"),
        "canonical_name": get("canonical_name"),
        "aliases": split_list(get("aliases")),
        "lat": numbers.parse_leading_number(get("lat")),
        "lng": numbers.parse_leading_number(get("lng")),
        "underground_weight": F.coalesce(numbers.parse_leading_number(get("underground_weight")), F.lit(0.0)),
        "genres": split_list(get("genres")),
        "scrape_type": scrape,
        "hide": filters.is_truthy(get("hide")),
    }
    extra = [c for c in ("row_no",) if c in df.columns]
    return df.select(*[columns.get(f.name, blank(f.name)).cast(f.dataType).alias(f.name) for f in VENUE], *extra)


def venue_to_row(venues: DataFrame) -> DataFrame:
    """Venues as text rows in the fixed column order."""
    cells = []
    for f in VENUE:
        if f.name == "hide":
            c = F.when(F.col("hide"), F.lit("TRUE")).otherwise(F.lit(""))
        else:
            c = cell(F.col(f.name), f.dataType.simpleString())
        cells.append(c.alias(f.name))
    return venues.select(*cells)


# --- approved events ------------------------------------------------------------------------------------


def approved_events(tab: DataFrame, dims: Dimensions) -> DataFrame:
    """Approved rows of the social tab as canonical events (headers in lower case).

    Values on the row win, the venue lookup fills the rest; ids are minted again.
    """
    require(tab, "approved")
    get = lambda c: column_or_blank(tab, c)
    blank = lambda c: text.no_match_to_null(get(c))
    usable = tab.where(filters.is_approved(F.col("approved"))).where((get("title") != "") & (get("date_start") != ""))
    df = resolve_venue(usable, blank("venue"), dims)
    columns = {f.name: blank(f.name) for f in EVENT if f.name != "overrides"}
    columns |= {
        "event_id": text.event_id(F.lit("facebook"), get("title"), get("date_start")),
        "title": get("title"),
        "date_start": get("date_start"),
        "venue_id": F.coalesce(blank("venue_id"), "r.venue_id"),
        "address": F.coalesce(blank("address"), "r.address"),
        "latitude": F.coalesce(numbers.parse_number(get("latitude")), "r.lat"),
        "longitude": F.coalesce(numbers.parse_number(get("longitude")), "r.lng"),
        "area": F.coalesce(blank("area"), "r.area"),
        "artists": split_list(get("artists")),
        "support_acts": split_list(get("support_acts")),
        "organizers": split_list(get("organizers")),
        "social_links": split_list(get("social_links"), "\n"),
        "interested": numbers.parse_integer(get("interested")),
        "going": numbers.parse_integer(get("going")),
        "source": F.lit("facebook"),
        "status": F.coalesce(blank("status"), F.lit("pending")),
    }
    return to_event(df, [c for c in ("row_no",) if c in tab.columns], **columns)


def pull_counts(tab: DataFrame, events: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows, approved, pulled, with and without a venue, already known; one row."""
    approved = filters.is_approved(F.col("approved"))
    from_tab = tab.agg(F.count(F.lit(1)).alias("rows_in_tab"), F.count_if(approved).alias("approved"))
    known = stored.select("event_id", F.lit(True).alias("_known"))
    from_events = events.join(known, "event_id", "left").agg(
        F.count(F.lit(1)).alias("pulled"),
        F.count("venue_id").alias("venue_resolved"),
        F.count_if(F.col("venue_id").isNull()).alias("venue_unresolved"),
        F.count_if(F.col("_known")).alias("updated"),
    )
    both = from_tab.unionByName(from_events, allowMissingColumns=True)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


