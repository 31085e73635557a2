"""Row types."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "long": T.LongType(), "int": T.IntegerType(),
    "boolean": T.BooleanType(), "strings": T.ArrayType(T.StringType()),
}


def _struct(fields: str) -> T.StructType:
    """'name type, name type' with the types above."""
    pairs = [f.split() for f in fields.split(",") if f.strip()]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


_BASE = "_source string, _scraped_at string, title string, date_start string, source_url string, image_url string, "

RAW = {
    "goabase": _struct(
        _BASE + "event_id string, country string, city string, venue_name string, hour_start string, "
        "genre_raw string, artists_raw string, description string, ticket_url string, price string, "
        "organizer string, hour_end string, date_end string, latitude double, longitude double"
    ),
    "beldub": _struct(
        _BASE + "event_id string, venue_name string, hour_start string, genre_raw string, "
        "description string, city string, ticket_url string"
    ),
    "reggaebe": _struct(
        _BASE + "event_id string, venue_name string, city string, hour_start string, artists_raw string, "
        "description string, price string, genre_raw string, latitude double, longitude double"
    ),
    "venue": _struct(
        _BASE + "venue_id string, venue_name string, hour_start string, room string, description string, "
        "price string, ticket_url string, artists_raw string, hour_end string, genre_raw string, "
        "support_raw string"
    ),
    "agenda": _struct(
        _BASE + "venue_id string, venue_name string, hour_start string, hour_end string, "
        "description string, location_raw string"
    ),
    "facebook": _struct(
        "_source string, id string, name string, url string, utcStartDate string, imageUrl string, "
        "description string, usersGoing long, usersInterested long"
    )
    .add(
        "location",
        _struct(
            "name string, contextualName string, streetAddress string, latitude double, "
            "longitude double, city string, countryCode string"
        ),
    )
    .add("ticketsInfo", _struct("buyUrl string, price string, title string"))
    .add("organizators", T.ArrayType(_struct("name string")))
    .add("externalLinks", T.ArrayType(T.StringType())),
}

OVERRIDES = _struct(
    "venue string, address string, latitude double, longitude double, genre string, "
    "hide boolean, approved boolean"
)

EVENT = _struct(
    "event_id string, facebook_id string, venue_id string, aggregator_id string, title string, "
    "date_start string, hour_start string, hour_end string, venue string, room string, address string, "
    "area string, latitude double, longitude double, genre string, subgenre string, genre_raw string, "
    "artists strings, support_acts strings, image_url string, source string, "
    "source_url string, ticket_url string, price string, details string, description string, "
    "interested long, going long, city string, country string, organizers strings, "
    "social_links strings, collective string, status string"
).add("overrides", OVERRIDES)

VENUE = _struct(
    "id string, canonical_name string, initials string, aliases strings, address string, "
    "lat double, lng double, underground_weight double, genres strings, area string, "
    "website string, scrape_url string, scrape_type string, hide boolean"
)

GENRE = _struct(
    "id string, label string, parent string, keywords strings, weight int, aliases strings"
)

ORGANIZER = _struct(
    "id string, name string, aliases strings, genres strings, weight double"
)

FESTIVAL = _struct(
    "node_id string, detail_url string, ics_url string, scraped_at string, title string, venue string, "
    "address string, date_start string, time_start string, lat double, lng double, description string, "
    "website string, categories strings, organizer string, price string, image_url string, "
    "source string, end_date_start string, time_end string, all_times strings, all_day boolean, "
    "price_detail string, reduction_groups strings, accessibility strings, genre string, "
    "raw_categories strings, organizer_url string, organizer_address string, "
    "organizer_phone string, organizer_email string, venue_phone string, venue_email string, "
    "venue_url string, ticket_url string, readspeaker_url string, gallery strings"
)
