"""Output layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.functions import arrays, numbers
from marquee.operators import filters
from marquee.schemas import FESTIVAL


def by_date_and_hour(df: DataFrame) -> DataFrame:
    """The id comes last, so equal dates and hours have an order and can be split over tasks."""
    last = ["event_id"] if "event_id" in df.columns else []
    return df.orderBy("date_start", F.col("hour_start").asc_nulls_last(), *last)


def active_in_order(events: DataFrame) -> DataFrame:
    """What the JSON export holds: active rows by date, then hour, rows without an hour last."""
    return by_date_and_hour(events.where(filters.is_active()))


def write_json(events: DataFrame, path: str) -> None:
    """Sorted files; range partitioning keeps the order over the files."""
    active_in_order(events).write.mode("overwrite").json(path)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


# --- festival layout: header of another table, then all festival fields -------------------------------

# fixed values: which header names a festival field answers to
HEADER_NAMES = {
    "title": ["title"],
    "venue": ["venue"],
    "address": ["address"],
    "date_start": ["date", "date_start", "datestart", "start_date"],
    "time_start": ["time", "hour_start", "hourstart", "time_start"],
    "lat": ["lat", "latitude"],
    "lng": ["lng", "lon", "longitude"],
    "description": ["desc", "description"],
    "price_detail": ["details"],
    "detail_url": ["url", "source_url", "sourceurl", "link"],
    "ticket_url": ["ticket_url", "ticketurl"],
    "website": ["website"],
    "categories": ["categories", "category"],
    "genre": ["genre"],
    "organizer": ["organizer", "organizers"],
    "price": ["price"],
    "image_url": ["image", "image_url", "imageurl", "cover"],
}
HEADER_CONSTANTS = {"city": "Gent", "country": "BE", "source": "feesten"}
FIELD_PREFIX = "gf_"
FIELD_SEPARATORS = {"reduction_groups": " | ", "gallery": "\n"}
FIELD_ORDER = [
    "node_id", "detail_url", "ics_url", "scraped_at", "title", "venue", "address",
    "date_start", "end_date_start", "time_start", "time_end", "all_times", "all_day",
    "lat", "lng", "categories", "raw_categories", "genre", "price", "price_detail",
    "reduction_groups", "accessibility", "organizer", "organizer_url", "organizer_address",
    "organizer_phone", "organizer_email", "venue_phone", "venue_email", "venue_url",
    "website", "ticket_url", "readspeaker_url", "image_url", "gallery", "description",
]


def _field(name: str) -> Column:
    kind = FESTIVAL[name].dataType.simpleString()
    if kind.startswith("array"):
        return arrays.joined(F.col(name), FIELD_SEPARATORS.get(name, ", "))
    if kind == "boolean":
        return F.when(F.col(name), F.lit("true")).otherwise(F.lit(""))
    if kind == "double":
        return F.coalesce(numbers.number_text(F.col(name)), F.lit(""))
    return F.coalesce(F.col(name), F.lit(""))


def shared_value(header: str) -> Column:
    """The festival value for a header name of the other table; '' for a name it does not know."""
    name = header.strip().lower()
    if name in HEADER_CONSTANTS:
        return F.lit(HEADER_CONSTANTS[name])
    for field, names in HEADER_NAMES.items():
        if name in names:
            return _field(field)
    return F.lit("")


def festival_rows(festival: DataFrame, header: list[str] | None = None) -> DataFrame:
    """Wide text rows: the given header (with a `source` column), then every field with a prefix."""
    shared = list(header or K.FESTIVAL_FALLBACK_HEADER)
    if "source" not in [h.strip().lower() for h in shared]:
        shared.append("source")
    return festival.select(
        *[shared_value(h).alias(h) for h in shared],
        *[_field(f).alias(FIELD_PREFIX + f) for f in FIELD_ORDER],
    )

