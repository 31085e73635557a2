"""Raw records to canonical events, one function per record shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.functions import dates, text
from marquee.schemas import EVENT
from marquee.sources.dimensions import Dimensions

RESOLVED = ["venue_id", "canonical_name", "address", "lat", "lng", "area"]


def default_column(name: str) -> Column:
    kind = EVENT[name].dataType
    if name == "status":
        return F.lit("pending")
    if kind.typeName() == "array":
        return F.array().cast(kind)
    return F.lit(None).cast(kind)


def to_event(df: DataFrame, extra: list[str] | None = None, **columns: Column) -> DataFrame:
    """Canonical layout: the given columns, defaults for the rest."""
    filled = [
        columns.get(f.name, default_column(f.name)).cast(f.dataType).alias(f.name) for f in EVENT
    ]
    return df.select(*filled, *(extra or []))


def has_date(df: DataFrame, column: str = "date_start") -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.col(column) != ""))


def resolve_venue(df: DataFrame, name: Column, dims: Dimensions) -> DataFrame:
    """Left join on the normalized alias; adds `r`, null where no alias fits."""
    found = dims.by_alias.select("alias_key", F.struct(*RESOLVED).alias("r"))
    keyed = df.withColumn("_alias_key", text.normalize_text(F.nullif(name, F.lit(""))))
    return keyed.join(found, F.col("_alias_key") == F.col("alias_key"), "left").drop(
        "_alias_key", "alias_key"
    )


def lookup_venue(df: DataFrame, dims: Dimensions, key: str = "venue_id") -> DataFrame:
    """Left join on the venue id; adds `r`."""
    found = dims.by_id.select(F.col("venue_id").alias("_id"), F.struct(*RESOLVED).alias("r"))
    return df.join(found, F.col(key) == F.col("_id"), "left").drop("_id")


def _kept(df: DataFrame) -> list[str]:
    return [c for c in ("ord",) if c in df.columns]


def _resolved_columns(with_coordinates: bool) -> dict[str, Column]:
    known = F.col("r.lat")
    if not with_coordinates:
        lat, lng = F.col("r.lat"), F.col("r.lng")
    else:
        own = known.isNull() & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
        lat = F.when(own, F.col("latitude")).otherwise(known)
        lng = F.when(own, F.col("longitude")).otherwise(F.col("r.lng"))
    return {
        "venue_id": F.col("r.venue_id"),
        "venue": F.coalesce("r.canonical_name", F.nullif(F.col("venue_name"), F.lit(""))),
        "address": F.col("r.address"),
        "area": F.col("r.area"),
        "latitude": lat,
        "longitude": lng,
    }


def _same(df: DataFrame, *names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names if n in df.columns}


def prefixed_id(prefix: str, raw_id: Column) -> Column:
    return F.concat(F.lit(prefix), F.nullif(raw_id, F.lit("")))


def from_goabase(raw: DataFrame, dims: Dimensions) -> DataFrame:
    df = resolve_venue(has_date(raw), F.col("venue_name"), dims)
    organizer = F.nullif(F.col("organizer"), F.lit(""))
    columns = _same(
        df, "title", "date_start", "source_url", "hour_start", "hour_end", "description", "genre_raw",
        "image_url", "ticket_url", "price", "city", "country",
    ) | _resolved_columns(True)
    return to_event(
        df,
        _kept(df),
        event_id=text.event_id(F.lit("goabase"), F.col("title"), F.col("date_start")),
        aggregator_id=prefixed_id("gb_", F.col("event_id")),
        source=F.lit("goabase"),
        artists=text.split_names(F.col("artists_raw")),
        organizers=F.filter(F.array(organizer), lambda o: o.isNotNull()),
        **columns,
    )


def from_beldub(raw: DataFrame, dims: Dimensions) -> DataFrame:
    df = resolve_venue(has_date(raw), F.col("venue_name"), dims)
    linked = text.extract(F.col("event_id"), r"/events/(\d+)")
    columns = _same(
        df, "title", "date_start", "source_url", "hour_start", "description", "genre_raw",
        "image_url", "ticket_url", "city",
    ) | _resolved_columns(False)
    return to_event(
        df,
        _kept(df),
        event_id=text.event_id(F.lit("beldub"), F.col("title"), F.col("date_start")),
        aggregator_id=prefixed_id("bd_", F.coalesce(linked, F.col("event_id"))),
        source=F.lit("beldub"),
        country=F.lit("Belgium"),
        **columns,
    )


def from_reggaebe(raw: DataFrame, dims: Dimensions) -> DataFrame:
    df = resolve_venue(has_date(raw), F.col("venue_name"), dims)
    columns = _same(
        df, "title", "date_start", "source_url", "hour_start", "description", "genre_raw",
        "image_url", "price", "city",
    ) | _resolved_columns(True)
    return to_event(
        df,
        _kept(df),
        event_id=text.event_id(F.lit("reggaebe"), F.col("title"), F.col("date_start")),
        aggregator_id=prefixed_id("rg_", F.col("event_id")),
        source=F.lit("reggaebe"),
        artists=text.split_names(F.col("artists_raw")),
        country=F.lit("Belgium"),
        **columns,
    )


def _from_own_site(raw: DataFrame, dims: Dimensions, **more: Column) -> DataFrame:
    df = lookup_venue(has_date(raw), dims)
    columns = _same(
        df, "venue_id", "title", "date_start", "source_url", "hour_start", "hour_end", "room",
        "description", "genre_raw", "image_url", "price", "ticket_url",
    )
    return to_event(
        df,
        _kept(df),
        event_id=text.event_id(F.col("venue_id"), F.col("title"), F.col("date_start")),
        venue=F.col("venue_name"),
        source=F.col("_source"),
        address=F.col("r.address"),
        latitude=F.col("r.lat"),
        longitude=F.col("r.lng"),
        area=F.col("r.area"),
        city=F.lit("Gent"),
        country=F.lit("Belgium"),
        **columns,
        **more,
    )


def from_venue_site(raw: DataFrame, dims: Dimensions, keep_artists: bool = False) -> DataFrame:
    """`keep_artists` also fills artists from `artists_raw`, which is dropped by default."""
    more = {"support_acts": text.split_names(F.col("support_raw"))}
    if keep_artists:
        more["artists"] = text.split_names(F.col("artists_raw"))
    return _from_own_site(raw, dims, **more)


def from_agenda(raw: DataFrame, dims: Dimensions) -> DataFrame:
    return _from_own_site(raw, dims)


def from_facebook(raw: DataFrame, dims: Dimensions) -> DataFrame:
    local = raw.withColumn("_date", dates.local_date(F.col("utcStartDate")))
    df = has_date(local, "_date").withColumn(
        "_venue", F.coalesce("location.name", "location.contextualName")
    )
    df = resolve_venue(df, F.col("_venue"), dims)
    names = F.transform("organizators", lambda o: o["name"])
    return to_event(
        df,
        _kept(df),
        facebook_id=F.col("id"),
        aggregator_id=F.concat(F.lit("fb_"), F.col("id")),
        event_id=text.event_id(F.lit("facebook"), F.col("name"), F.col("_date")),
        source=F.lit("facebook"),
        image_url=F.col("imageUrl"),
        title=F.col("name"),
        date_start=F.col("_date"),
        hour_start=dates.local_time(F.col("utcStartDate")),
        venue=F.col("_venue"),
        venue_id=F.col("r.venue_id"),
        address=F.col("location.streetAddress"),
        latitude=F.col("location.latitude"),
        longitude=F.col("location.longitude"),
        city=F.col("location.city"),
        country=F.col("location.countryCode"),
        description=F.col("description"),
        going=F.col("usersGoing"),
        interested=F.col("usersInterested"),
        ticket_url=F.col("ticketsInfo.buyUrl"),
        price=F.coalesce("ticketsInfo.price", "ticketsInfo.title"),
        organizers=F.coalesce(F.filter(names, lambda n: n != ""), F.array().cast("array<string>")),
        source_url=F.col("url"),
        social_links=F.coalesce(F.col("externalLinks"), F.array().cast("array<string>")),
    )


SHAPES = {
    "goabase": from_goabase,
    "beldub": from_beldub,
    "reggaebe": from_reggaebe,
    "facebook": from_facebook,
    "agenda": from_agenda,
    "venue": from_venue_site,
}


def normalize_all(raw_by_shape: dict[str, DataFrame], dims: Dimensions) -> DataFrame:
    """One branch per record shape, then a bag union."""
    parts = [SHAPES[shape](raw, dims) for shape, raw in raw_by_shape.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
