"""Event records derived from the given tables, as expressions both engines read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.normalize import to_event
from marquee.plans.catalog import Tables, computed, norm, select_list
from marquee.schemas import EVENT
from marquee.sources.dimensions import Dimensions, venue_dimensions

AS_OF = "2024-01-15"

# --- documents as events -------------------------------------------------------------------------------

DOC = {
    "ord": "doc_id",
    "event_id": "concat('e', doc_id)",
    "title": "text",
    "date_start": "case lang when 'en' then '2024-03-01' when 'fr' then '2024-03-02' when 'de' then '2024-03-03' else '2024-03-04' end",
    "source": "case doc_id % 5 when 0 then 'facebook' when 1 then 'goabase' when 2 then 'funke' when 3 then 'molotov' else source end",
    "aggregator_id": "case when doc_id % 3 = 0 then concat('d_', doc_id) when doc_id % 3 = 1 then concat('d_', doc_id % 7, ', d_', doc_id) end",
    "facebook_id": "case when doc_id % 5 = 0 then concat('f', doc_id) end",
    "hour_start": "case when n_chars % 3 = 0 then '20:30' end",
    "price": "case when n_chars % 4 = 0 then concat('€ ', doc_id % 20) end",
    "ticket_url": "case when n_chars % 5 = 0 then concat('https://t.example/', doc_id) end",
    "genre_raw": "case when n_chars % 7 = 0 then 'techno' end",
    "interested": "case when n_chars % 2 = 0 then n_chars end",
    "going": "case when n_chars % 6 = 0 then doc_id end",
    "artists": "case when n_chars % 3 = 1 then array(concat('A', doc_id), 'B') else array() end",
    "organizers": "case when n_chars % 5 = 2 then array(source) else array() end",
    "status": "case when doc_id % 50 = 49 then 'duplicate' when doc_id % 2 = 0 then 'pending' end",
}
DOC_SQL = f"select {select_list(DOC)} from documents"
DOC_FILLED = (
    "(" + " + ".join(
        f"(case when {c} is not null and {c} <> '' then 1 else 0 end)"
        for c in ("event_id", "title", "date_start", "source", "aggregator_id", "facebook_id", "hour_start",
                  "price", "ticket_url", "genre_raw", "status")
    )
    + " + (interested is not null)::int + (going is not null)::int + (len(artists) > 0)::int + (len(organizers) > 0)::int)"
)
PRIORITY = (
    "(case when source = 'facebook' then 0 when source in ('goabase', 'beldub', 'reggaebe') then 1 "
    "when source in ('funke', 'chinastraat', 'asgaard', 'kinkystar', 'broei', 'thecrossover', 'molotov') then 2 else 1 end)"
)


def doc_events(t: Tables) -> DataFrame:
    raw = computed(t.heavy("documents"), DOC)
    given = {c: F.col(c) for c in raw.columns if c in EVENT.names}
    return to_event(raw, ["ord"], **given)


# --- orders as events with near copies --------------------------------------------------------------------

# twelve orders share a date; on each date three names stand in four spellings
_SHOW = (
    "concat(case o_orderkey % 3 when 0 then 'deep house night at the dock ' when 1 then 'jazz in the park with friends ' "
    "else 'dub reggae soundsystem live ' end, (o_orderkey - o_orderkey % 36) % 1000)"
)
SHOW = {
    "ord": "o_orderkey",
    "event_id": "concat('s', o_orderkey)",
    "date_start": "concat('d', o_orderkey - o_orderkey % 12)",
    "title": f"case o_orderkey % 4 when 0 then {_SHOW} when 1 then concat({_SHOW}, 's') when 2 then upper({_SHOW}) else concat({_SHOW}, ' ', o_custkey % 100) end",
    "source": "case o_orderkey % 5 when 0 then 'facebook' when 1 then 'goabase' when 2 then 'funke' when 3 then 'molotov' else 'other' end",
    "price": "case when o_custkey % 3 = 0 then concat('€ ', o_custkey) end",
    "going": "case when o_custkey % 4 = 1 then o_custkey end",
    "aggregator_id": "case when o_orderkey % 5 <> 1 then concat('x', o_orderkey % 7, ', y', o_orderkey) end",
    "artists": "case when o_custkey % 5 = 2 then array(concat('DJ ', o_custkey), 'B') else array() end",
    "status": "case when o_orderkey % 40 = 39 then 'duplicate' else 'pending' end",
}
SHOW_SQL = f"select {select_list(SHOW)} from orders"
SHOW_FILLED = "((price is not null)::int + (going is not null)::int + (aggregator_id is not null)::int + (len(artists) > 0)::int)"


def show_events(t: Tables) -> DataFrame:
    raw = computed(t("orders"), SHOW)
    return to_event(raw, ["ord"], **{c: F.col(c) for c in SHOW if c != "ord"})


# --- suppliers as venues -----------------------------------------------------------------------------------

VENUE = {
    "ord": "cast(s_suppkey as int)",
    "id": "concat('v', s_suppkey)",
    "canonical_name": "s_name",
    "initials": "case when s_suppkey % 2 = 0 then substr(s_name, 1, 2) end",
    "aliases": "array(concat('Zaal ', s_suppkey), concat('Café No. ', s_suppkey % 40))",
    "address": "case when s_suppkey % 6 > 0 then concat(n_name, ' ', s_suppkey, ', Gent') end",
    "lat": "case when s_suppkey % 9 > 0 then cast(51.04 as double) + s_suppkey % 35 / cast(1000 as double) end",
    "lng": "case when s_suppkey % 9 > 0 then cast(3.7 as double) + s_suppkey % 70 / cast(1000 as double) end",
    "underground_weight": "s_suppkey % 5 / cast(10 as double)",
    "genres": "array(case s_suppkey % 3 when 0 then 'Zydeco' when 1 then 'gizmo' else 'unknown' end, 'x')",
    "area": "case when s_suppkey % 4 = 0 then 'Muide' end",
    "website": "case when s_suppkey % 3 = 0 then concat('https://v', s_suppkey, '.example') end",
    "scrape_url": "cast(null as string)",
    "scrape_type": "case s_suppkey % 3 when 0 then 'html' when 1 then 'ical' end",
    "hide": "s_suppkey % 10 = 0",
}
VENUE_SQL = f"select {select_list(VENUE)} from supplier join nation on s_nationkey = n_nationkey"
# the alias lookup: later venues win, a venue's own name after its aliases
ALIAS_SQL = (
    f"select alias_key, arg_max(id, (ord, pos)) as venue_id from (select ord, id, unnest([0, 1, 2]) as pos, "
    f"{norm('unnest(aliases || [canonical_name])')} as alias_key from venue) group by alias_key"
)


def venues(t: Tables) -> DataFrame:
    rows = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return computed(rows, VENUE)


def dimensions(t: Tables) -> Dimensions:
    return venue_dimensions(venues(t))


WITH_VENUES = f"venue as ({VENUE_SQL}), alias as ({ALIAS_SQL})"

# --- events as raw records -----------------------------------------------------------------------------------

_NAME = (
    "case event_id % 5 when 0 then concat('SUPPLIER--', lpad(cast(user_id as string), 9, '0'), '!') "
    "when 1 then concat('zaal ', user_id) when 2 then concat('Cafe no ', user_id % 50) when 3 then concat('Ergens ', user_id) "
    "when 4 then (case when user_id % 2 = 0 then '' end) end"
)
RAW = {
    "ord": "event_id",
    "_source": "'goabase'",
    "title": "concat(event_type, ' Nïght ', cast(event_id as string))",
    "date_start": "case when event_id % 17 = 0 then null when event_id % 19 = 0 then '' when event_id % 23 = 0 then '2024-1-5' "
    "else substr(cast(ts as string), 1, 10) end",
    "source_url": "concat('https://g.example/', event_id)",
    "image_url": "case when event_id % 4 = 0 then concat('https://i.example/', event_id, '.jpg') end",
    "raw_id": "case when event_id % 11 = 0 then null when event_id % 13 = 0 then concat('https://f.example/events/', event_id) else cast(event_id as string) end",
    "venue_name": _NAME,
    "country": "'Belgium'",
    "city": "case when event_id % 3 = 0 then 'Gent' end",
    "hour_start": "case when event_id % 29 = 0 then '8:00' else substr(cast(ts as string), 12, 5) end",
    "hour_end": "case when event_id % 5 = 0 then '23:00' end",
    "genre_raw": "case when event_id % 6 = 0 then concat(event_type, ', techno') end",
    "artists_raw": "case when event_id % 2 = 0 then concat('DJ ', user_id, ', Other + Third ,', event_type) end",
    "description": "case when event_id % 3 = 1 then props end",
    "ticket_url": "case when event_id % 8 = 0 then concat('https://t.example/', event_id) end",
    "price": "case when event_id % 7 = 0 then concat('€ ', cast(value as decimal(12,2))) end",
    "organizer": "case when event_id % 4 = 0 then concat('Org ', user_id) when event_id % 4 = 1 then '' end",
    "date_end": "cast(null as string)",
    "latitude": "case when event_id % 3 = 0 then cast(51 as double) + user_id / cast(1000 as double) end",
    "longitude": "case when event_id % 3 = 0 then cast(3.7 as double) + user_id / cast(1000 as double) end",
    "room": "case when event_id % 9 = 0 then 'club' end",
    "support_raw": "case when event_id % 5 = 1 then concat('Sup ', user_id, ' + Act') end",
    "venue_id": "concat('v', user_id)",
    "location_raw": "cast(null as string)",
}
RAW_SQL = f"select {select_list(RAW)} from events"


def raw_events(t: Tables, shape: str) -> DataFrame:
    """`events` in the layout of one raw record shape."""
    df = computed(t.heavy("events"), RAW)
    if shape in ("goabase", "beldub", "reggaebe"):
        return df.drop("room", "support_raw", "venue_id", "location_raw").withColumnRenamed("raw_id", "event_id")
    name = {"venue": "funke", "agenda": "minusOne"}[shape]
    df = df.drop("raw_id").withColumn("_source", F.lit(name))
    return df if shape == "venue" else df.drop("room", "price", "ticket_url", "genre_raw", "support_raw")


def raw_social(t: Tables) -> DataFrame:
    """`events` as nested social records."""
    e = lambda x: F.expr(x)
    return t.heavy("events").select(
        F.col("event_id").alias("ord"),
        F.lit("facebook").alias("_source"),
        e("cast(event_id as string)").alias("id"),
        e("concat(event_type, ' Party ', event_id)").alias("name"),
        e("concat('https://f.example/', event_id)").alias("url"),
        F.when(F.col("event_id") % 17 == 0, F.lit("soon"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("utcStartDate"),
        e("case when event_id % 4 = 0 then concat('https://i.example/', event_id) end").alias("imageUrl"),
        e("case when event_id % 3 = 0 then props end").alias("description"),
        F.col("user_id").alias("usersGoing"),
        e("case when event_id % 2 = 0 then user_id * 3 end").alias("usersInterested"),
        e(
            "case when event_id % 6 < 5 then named_struct('name', case when event_id % 6 < 3 then concat('Zaal ', user_id) end, "
            "'contextualName', 'Somewhere', 'streetAddress', concat('Street ', user_id), 'latitude', cast(51.05 as double), "
            "'longitude', cast(3.72 as double), 'city', 'Gent', 'countryCode', 'BE') end"
        ).alias("location"),
        e(
            "case when event_id % 5 = 0 then named_struct('buyUrl', concat('https://t.example/', event_id), 'price', "
            "case when event_id % 10 = 0 then '€ 5' end, 'title', 'Tickets') end"
        ).alias("ticketsInfo"),
        e(
            "case when event_id % 7 = 0 then array(named_struct('name', concat('Org ', user_id)), named_struct('name', ''), "
            "named_struct('name', 'Second')) end"
        ).alias("organizators"),
        e("case when event_id % 8 = 0 then array('https://a.example', 'https://b.example') end").alias("externalLinks"),
    )


SOCIAL_SQL = """
select event_id as ord, concat(event_type, ' Party ', event_id) as title,
  strftime(timezone('Europe/Brussels', timezone('UTC', ts)), '%Y-%m-%d') as date_start,
  strftime(timezone('Europe/Brussels', timezone('UTC', ts)), '%H:%M') as hour_start,
  case when event_id % 6 < 3 then concat('Zaal ', user_id) when event_id % 6 < 5 then 'Somewhere' end as venue,
  * exclude (value) from events where event_id % 17 <> 0
"""
