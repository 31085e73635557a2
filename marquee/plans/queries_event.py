"""Raw records to canonical events: projections, predicates, joins, validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.operators import export, extract, filters, joins, normalize, overrides, upsert, validate
from marquee.plans import inputs as I
from marquee.plans.catalog import ORACLES, Tables, computed, event_id, names, norm, query, select_list
from marquee.plans.queries_source import flat
from marquee.schemas import EVENT
from marquee.session import small
from marquee.sources import sheets

C = F.col

# --- projections ----------------------------------------------------------------------------------------


def shown(df: DataFrame) -> DataFrame:
    """Canonical rows with arrays as text and without the override struct."""
    return flat(df.drop("overrides"))


DEFAULTS = {f.name: "''" if f.dataType.simpleString().startswith("array") else f"null::{ {'string': 'varchar', 'bigint': 'bigint', 'double': 'double'}[f.dataType.simpleString()] }"
            for f in EVENT if f.name != "overrides"} | {"status": "'pending'"}


def event_sql(source: str, columns: dict[str, str]) -> str:
    """SELECT of a canonical row: given columns, defaults for the rest."""
    merged = DEFAULTS | columns
    return "select " + ", ".join(f"{e} as {n}" for n, e in merged.items()) + f", ord from {source}"


def same(*columns: str) -> dict[str, str]:
    return {c: c for c in columns}


RAW_OK = f"r as (select * from ({I.RAW_SQL}) where date_start is not null and date_start <> '')"
BY_NAME = (
    f"n as (select r.*, v.id as vid, v.canonical_name, v.address as v_address, v.lat as v_lat, v.lng as v_lng, v.area as v_area from r "
    f"left join alias on alias_key = {norm('nullif(r.venue_name, $$$$)')} left join venue v on v.id = alias.venue_id)"
)
BY_ID = (
    "n as (select r.*, v.address as v_address, v.lat as v_lat, v.lng as v_lng, v.area as v_area from r left join venue v on v.id = r.venue_id)"
)
WITH_NAME = f"with {I.WITH_VENUES}, {RAW_OK}, {BY_NAME} "
WITH_ID = f"with {I.WITH_VENUES}, {RAW_OK}, {BY_ID} "
RESOLVED = {
    "venue_id": "vid", "venue": "coalesce(canonical_name, nullif(venue_name, ''))", "address": "v_address", "area": "v_area",
    "latitude": "v_lat", "longitude": "v_lng",
}
OWN_POINT = RESOLVED | {
    "latitude": "case when v_lat is null and latitude is not null and longitude is not null then latitude else v_lat end",
    "longitude": "case when v_lat is null and latitude is not null and longitude is not null then longitude else v_lng end",
}


def joined_names(c: str) -> str:
    return f"array_to_string({names(c)}, '|')"


@query("prj1_defaults", event_sql("(select event_id as ord from events)", {}))
def _(t: Tables):
    return shown(normalize.to_event(t("events").select(C("event_id").alias("ord")), ["ord"]))


GOABASE_SQL = WITH_NAME + event_sql("n", OWN_POINT | same(
    "title", "date_start", "source_url", "hour_start", "hour_end", "description", "genre_raw", "image_url", "ticket_url", "price", "city", "country",
) | {
    "event_id": event_id("'goabase'", "title", "date_start"), "aggregator_id": "'gb_' || raw_id", "source": "'goabase'",
    "artists": joined_names("artists_raw"), "organizers": "coalesce(organizer, '')",
})


@query("prj2_goabase", GOABASE_SQL)
def _(t: Tables):
    return shown(normalize.from_goabase(I.raw_events(t, "goabase"), I.dimensions(t)))


@query("prj3_beldub", WITH_NAME + event_sql("n", RESOLVED | same(
    "title", "date_start", "source_url", "hour_start", "description", "genre_raw", "image_url", "ticket_url", "city",
) | {
    "event_id": event_id("'beldub'", "title", "date_start"), "source": "'beldub'", "country": "'Belgium'",
    "aggregator_id": "'bd_' || coalesce(nullif(regexp_extract(raw_id, '/events/([0-9]+)', 1), ''), raw_id)",
}))
def _(t: Tables):
    return shown(normalize.from_beldub(I.raw_events(t, "beldub"), I.dimensions(t)))


@query("prj4_reggaebe", WITH_NAME + event_sql("n", OWN_POINT | same(
    "title", "date_start", "source_url", "hour_start", "description", "genre_raw", "image_url", "price", "city",
) | {
    "event_id": event_id("'reggaebe'", "title", "date_start"), "aggregator_id": "'rg_' || raw_id", "source": "'reggaebe'",
    "artists": joined_names("artists_raw"), "country": "'Belgium'",
}))
def _(t: Tables):
    return shown(normalize.from_reggaebe(I.raw_events(t, "reggaebe"), I.dimensions(t)))


SITE = {
    "venue_id": "venue_id", "venue": "venue_name", "address": "v_address", "latitude": "v_lat", "longitude": "v_lng", "area": "v_area",
    "event_id": event_id("venue_id", "title", "date_start"), "city": "'Gent'", "country": "'Belgium'",
}


@query("prj5_venue_site", WITH_ID + event_sql("n", SITE | same(
    "title", "date_start", "source_url", "hour_start", "hour_end", "room", "description", "genre_raw", "image_url", "price", "ticket_url",
) | {"source": "'funke'", "support_acts": joined_names("support_raw")}))
def _(t: Tables):
    return shown(normalize.from_venue_site(I.raw_events(t, "venue"), I.dimensions(t)))


@query("prj6_agenda", WITH_ID + event_sql("n", SITE | same(
    "title", "date_start", "source_url", "hour_start", "hour_end", "description", "image_url",
) | {"source": "'minusOne'"}))
def _(t: Tables):
    return shown(normalize.from_agenda(I.raw_events(t, "agenda"), I.dimensions(t)))


SOCIAL = (
    f"with {I.WITH_VENUES}, s as ({I.SOCIAL_SQL}), n as (select s.*, alias.venue_id as vid from s left join alias on alias_key = {norm('s.venue')}) "
)


@query("prj7_social", SOCIAL + event_sql("n", {
    "facebook_id": "cast(event_id as varchar)", "aggregator_id": "'fb_' || event_id", "event_id": event_id("'facebook'", "title", "date_start"),
    "source": "'facebook'", "title": "title", "date_start": "date_start", "hour_start": "hour_start", "venue": "venue", "venue_id": "vid",
    "image_url": "case when event_id % 4 = 0 then 'https://i.example/' || event_id end", "description": "case when event_id % 3 = 0 then props end",
    "address": "case when event_id % 6 < 5 then 'Street ' || user_id end", "latitude": "case when event_id % 6 < 5 then 51.05::double end",
    "longitude": "case when event_id % 6 < 5 then 3.72::double end", "city": "case when event_id % 6 < 5 then 'Gent' end",
    "country": "case when event_id % 6 < 5 then 'BE' end", "going": "user_id", "interested": "case when event_id % 2 = 0 then user_id * 3 end",
    "ticket_url": "case when event_id % 5 = 0 then 'https://t.example/' || event_id end",
    "price": "case when event_id % 10 = 0 then '€ 5' when event_id % 5 = 0 then 'Tickets' end",
    "organizers": "case when event_id % 7 = 0 then 'Org ' || user_id || '|Second' else '' end", "source_url": "'https://f.example/' || event_id",
    "social_links": "case when event_id % 8 = 0 then 'https://a.example|https://b.example' else '' end",
}))
def _(t: Tables):
    return shown(normalize.from_facebook(I.raw_social(t), I.dimensions(t)))


ONE_SHAPE = {"goabase": "prj2_goabase", "beldub": "prj3_beldub", "reggaebe": "prj4_reggaebe", "venue": "prj5_venue_site", "agenda": "prj6_agenda", "facebook": "prj7_social"}


@query("prj8_all_shapes", " union all ".join(f"select * exclude (ord) from ({ORACLES[q]})" for q in ONE_SHAPE.values()))
def _(t: Tables):
    """Every record of the union."""
    raw = {s: I.raw_social(t) if s == "facebook" else I.raw_events(t, s) for s in ONE_SHAPE}
    return shown(normalize.normalize_all(raw, I.dimensions(t))).drop("ord")


APPROVED = {
    "row_no": "event_id",
    "approved": "case event_id % 4 when 0 then ' Yes' when 1 then 'x' when 2 then 'no' else '' end",
    "title": "case when event_id % 31 = 0 then ' ' else concat(' ', event_type, ' ', event_id % 500, ' ') end",
    "date_start": "substr(cast(ts as string), 1, 10)",
    "venue": "case when event_id % 3 = 0 then concat('Zaal ', user_id) else '' end",
    "venue_id": "case when event_id % 7 = 0 then 'own' else '' end",
    "latitude": "case when event_id % 5 = 0 then '51.5' when event_id % 5 = 1 then 'x' else '' end",
    "longitude": "case when event_id % 5 = 0 then '3.5' else '' end",
    "address": "case when event_id % 9 = 0 then 'Straat 1' else '' end",
    "interested": "case when event_id % 2 = 0 then '12.7' else 'many' end",
    "artists": "case when event_id % 2 = 0 then 'A, B ,, C' else '' end",
    "social_links": "concat('https://a.example', chr(10), 'https://b.example')",
    "status": "case when event_id % 6 = 0 then 'approved' else '' end",
}
APPROVED_SQL = (
    f"{I.WITH_VENUES}, tab as (select {select_list(APPROVED)} from events), "
    "ok as (select *, trim(title) as tt from tab where lower(trim(approved)) in ('yes', 'true', 'y', 'x', '1', 'approved') and trim(title) <> ''), "
    f"n as (select ok.*, v.id as vid, v.address as va, v.lat as vlat, v.lng as vlng, v.area as varea from ok left join alias on alias_key = {norm('nullif(ok.venue, $$$$)')} "
    "left join venue v on v.id = alias.venue_id)"
)
APPROVED_COLUMNS = {
    "event_id": event_id("'facebook'", "tt", "date_start"), "title": "tt", "date_start": "date_start", "venue": "nullif(venue, '')",
    "venue_id": "coalesce(nullif(venue_id, ''), vid)", "address": "coalesce(nullif(address, ''), va)", "area": "varea",
    "latitude": "coalesce(try_cast(nullif(latitude, '') as double), vlat)", "longitude": "coalesce(try_cast(nullif(longitude, '') as double), vlng)",
    "interested": "trunc(try_cast(interested as double))::bigint", "artists": "case when row_no % 2 = 0 then 'A|B|C' else '' end",
    "social_links": "'https://a.example|https://b.example'", "source": "'facebook'", "status": "coalesce(nullif(status, ''), 'pending')",
}


def approved_tab(t: Tables) -> DataFrame:
    return computed(t("events"), APPROVED)


@query("prj9_approved_rows", f"with {APPROVED_SQL} " + event_sql("n", APPROVED_COLUMNS).replace(", ord from", ", row_no from"))
def _(t: Tables):
    return shown(sheets.approved_events(approved_tab(t), I.dimensions(t)))


VENUE_TAB = {
    "id": "concat(' v', s_suppkey)", "canonical_name": "s_name", "aliases": "concat('a', s_suppkey, ', b,, ')",
    "lat": "case when s_suppkey % 3 = 0 then '51.05 N' when s_suppkey % 3 = 1 then 'x' else '' end", "lng": "'3.7'",
    "underground_weight": "case when s_suppkey % 2 = 0 then '-0.5' else '' end", "genres": "''", "area": "' Muide '",
    "scrape_type": "case s_suppkey % 3 when 0 then 'html ' when 1 then 'rss' else '' end", "hide": "case s_suppkey % 4 when 0 then 'JA' when 1 then 'no' else '' end",
}


@query(
    "prj10_venue_rows",
    "select 'v' || s_suppkey as id, s_name as canonical_name, null::varchar as initials, 'a' || s_suppkey || '|b' as aliases, null::varchar as address, "
    "case when s_suppkey % 3 = 0 then 51.05::double end as lat, 3.7::double as lng, case when s_suppkey % 2 = 0 then -0.5::double else 0::double end as underground_weight, "
    "'' as genres, 'Muide' as area, null::varchar as website, null::varchar as scrape_url, case s_suppkey % 3 when 0 then 'html' end as scrape_type, "
    "s_suppkey % 4 = 0 as hide from supplier",
)
def _(t: Tables):
    return flat(sheets.venue_from_row(computed(t("supplier"), VENUE_TAB)))


OVERRIDE_TAB = {
    "row_no": "doc_id",
    "event_id": "concat('e', doc_id)",
    "venue_override": "case when quality = 1 then concat(' Zaal ', doc_id) else '' end",
    "latitude_override": "case when doc_id % 4 = 0 then '51,05' when doc_id % 4 = 1 then '51.06' else '' end",
    "longitude_override": "case when doc_id % 4 = 0 then '3,7' when doc_id % 4 = 2 then '3.8' else '' end",
    "genre_override": "case when doc_id % 6 = 0 then 'Techno' else '' end",
    "hide": "case when toxic = 1 then 'X' when doc_id % 5 = 0 then 'nee' else '' end",
    "approved": "case when doc_id % 7 = 0 then 'ja' else ' ' end",
}
OVERRIDE_SQL = (
    "select doc_id as row_no, 'e' || doc_id as event_id, case when quality = 1 then 'Zaal ' || doc_id end as venue, null::varchar as address, "
    "case when doc_id % 4 = 0 then 51.05::double end as latitude, case when doc_id % 4 = 0 then 3.7::double end as longitude, "
    "case when doc_id % 6 = 0 then 'Techno' end as genre, case when toxic = 1 then true when doc_id % 5 = 0 then false end as hide, "
    "case when doc_id % 7 = 0 then true end as approved from labels"
)


@query("prj11_override_cells", f"select *, (venue is null and latitude is null and genre is null and hide is null and approved is null) as none from ({OVERRIDE_SQL})")
def _(t: Tables):
    tab = computed(t("labels"), OVERRIDE_TAB)
    rows = tab.select("row_no", "event_id", overrides.override_struct(tab).alias("o"))
    return rows.select("row_no", "event_id", "o.*", C("o").isNull().alias("none"))


def _doc_cell(c: str) -> str:
    """SQL of one text cell; columns that the documents do not give are empty."""
    if c == "last_seen":
        return f"'{I.AS_OF}'"
    if c not in I.DOC:
        return "''"
    if I.DOC[c].find("array(") >= 0:
        return f"array_to_string({c}, ', ')"
    return f"coalesce(cast({c} as varchar), '')"


@query("prj12_text_cells", f"with d as ({I.DOC_SQL}) select " + ", ".join(f"{_doc_cell(c)} as {c}" for c in K.AUTO_COLUMNS) + " from d")
def _(t: Tables):
    return upsert.to_cells(I.doc_events(t), I.AS_OF).select(*K.AUTO_COLUMNS)


def overridden(t: Tables) -> DataFrame:
    """documents as events with the human values of `labels`, and some coordinates."""
    tab = computed(t("labels"), OVERRIDE_TAB)
    events = I.doc_events(t).withColumns(
        {
            "latitude": F.expr("case ord % 3 when 0 then cast(51 as double) when 1 then cast(0 as double) end"),
            "longitude": F.expr("case when ord % 3 < 2 then cast(3.7 as double) end"),
        }
    )
    return overrides.apply_overrides(events, overrides.pulled_overrides([tab]))


POINTS_SQL = (
    f"d as ({I.DOC_SQL}), o as ({OVERRIDE_SQL}), e as (select d.event_id, coalesce(o.latitude, case d.ord % 3 when 0 then 51::double when 1 then 0::double end) as lat, "
    "coalesce(o.longitude, case when d.ord % 3 < 2 then 3.7::double end) as lng, o.venue as venue, o.genre as genre, coalesce(o.hide, false) as hidden "
    "from d left join o on o.event_id = d.event_id)"
)


@query("prj13_effective_values", f"with {POINTS_SQL} select * from e")
def _(t: Tables):
    return overridden(t).select(
        "event_id", filters.effective("latitude").alias("lat"), filters.effective("longitude").alias("lng"),
        filters.effective("venue").alias("venue"), filters.effective("genre").alias("genre"), filters.is_hidden().alias("hidden"),
    )


# --- predicates -------------------------------------------------------------------------------------------


@query("flt1_has_date", f"select event_id, date_start from (select event_id, {I.RAW['date_start']} as date_start from events) "
       "where date_start is not null and date_start <> ''")
def _(t: Tables):
    return normalize.has_date(I.raw_events(t, "goabase").drop("event_id").withColumnRenamed("ord", "event_id")).select("event_id", "date_start")


@query("flt2_active_rows", f"with d as ({I.DOC_SQL}) select event_id, status from d where status is null or status <> 'duplicate'")
def _(t: Tables):
    return I.doc_events(t).where(filters.is_active()).select("event_id", "status")


@query("flt3_future_rows", f"select event_id from events where strftime(ts, '%Y-%m-%d') >= '{I.AS_OF}'")
def _(t: Tables):
    rows = t("events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("date_start"))
    return rows.where(filters.is_future(I.AS_OF)).select("event_id")


@query("flt4_approved_rows", f"select event_id from (select event_id, {APPROVED['approved']} as a from events) where lower(trim(a)) in "
       "('yes', 'true', 'y', 'x', '1', 'approved')")
def _(t: Tables):
    return approved_tab(t).where(filters.is_approved(C("approved"))).select(C("row_no").alias("event_id"))


@query("flt5_missing_coordinates", f"with {POINTS_SQL} select event_id from e where coalesce(lat, 0) = 0 or coalesce(lng, 0) = 0")
def _(t: Tables):
    return overridden(t).where(filters.lacks_coordinates()).select("event_id")


@query("flt6_split_located", f"with {POINTS_SQL} select case when coalesce(lat, 0) = 0 or coalesce(lng, 0) = 0 then 'failed' else 'located' end as part, "
       "count(*) as n from e group by 1")
def _(t: Tables):
    located, failed = filters.split_located(overridden(t))
    count = lambda df, name: df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"))
    return count(located, "located").unionByName(count(failed, "failed"))


@query("flt7_inside_or_unknown", "select vec_id from (select vec_id, case when vec_id % 5 > 0 then embedding[1] * 10 + 50 end as lat, "
       "embedding[2] * 10 + 4 as lng from embeddings) where lat is null or lng is null or "
       "(lat between 49.49 and 51.51 and lng between 2.54 and 6.41)")
def _(t: Tables):
    at = lambda i: F.get("embedding", F.lit(i))
    rows = t("embeddings").select(
        "vec_id", F.when(C("vec_id") % 5 > 0, at(0) * 10 + 50).alias("lat"), (at(1) * 10 + 4).alias("lng")
    )
    return rows.where(filters.inside_or_unknown("lat", "lng")).select("vec_id")


@query("flt8_lookahead", "select o_orderkey from orders where o_orderdate::date between date '1998-06-15' and date '1998-06-15' + 92")
def _(t: Tables):
    rows = t("orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_start"))
    return rows.where(filters.within_lookahead("date_start", "1998-06-15")).select("o_orderkey")


@query("flt10_cancelled_and_placeholders", "select event_id from events where event_type <> 'error' and not (event_id % 9 = 0)")
def _(t: Tables):
    status = F.when(C("event_type") == "error", F.lit("CANCELLED"))
    title = F.when(C("event_id") % 9 == 0, F.lit("Closed for works")).otherwise(F.lit("Not closed"))
    rows = t("events").select("event_id", status.alias("status"), title.alias("title"))
    return rows.where(~filters.is_cancelled(C("status")) & ~filters.is_placeholder(C("title"))).select("event_id")


@query("flt11_hosted_elsewhere", r"select doc_id from documents where not regexp_matches(text, '(?i)the\s+of') and not regexp_matches(source, '(?i)src1')")
def _(t: Tables):
    rows = t.heavy("documents").where(~filters.is_hosted_elsewhere(r"the\s+of", C("text")) & ~filters.is_hosted_elsewhere("src1", C("source")))
    return rows.select("doc_id")


@query(
    "flt12_listing_links",
    r"""with h as (select page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) as href from pages
    union all select page_id, url from pages union all select page_id, '/nieuws/' || page_id from pages union all select page_id, '#top' from pages
    union all select page_id, '/agenda/concert' from pages union all select page_id, '/agenda/night-' || page_id || '?x=1' from pages)
    select page_id, href, regexp_extract(href, '/agenda/([a-z0-9_-]+)(?:[?#].*)?$', 1) as slug from h where href not like '#%' and href not like 'http%'
    and not regexp_matches(href, '/(nieuws|music-pub|menukaart|history)') and not regexp_matches(href, '^/+(?:[?#]|$)')
    and not regexp_matches(href, '(?i)^/(category|tag|author|page|feed|wp-|praktisch|360|contact|privacy|vacature)')
    and regexp_extract(href, '/agenda/([a-z0-9_-]+)(?:[?#].*)?$', 1) <> 'concert'""",
)
def _(t: Tables):
    pages = t.heavy("pages")
    extra = lambda c: pages.select("page_id", c.alias("href"))
    rows = (
        extract.links(pages).select("page_id", "href")
        .unionByName(extra(C("url")))
        .unionByName(extra(F.concat(F.lit("/nieuws/"), "page_id")))
        .unionByName(extra(F.lit("#top")))
        .unionByName(extra(F.lit("/agenda/concert")))
        .unionByName(extra(F.concat(F.lit("/agenda/night-"), "page_id", F.lit("?x=1"))))
    )
    own = rows.where(filters.is_listing_link(C("href"), "https://site.example"))
    slugs = own.withColumn("slug", F.coalesce(filters.slug_of(C("href"), "agenda"), F.lit("")))
    return filters.without_listed(slugs, "slug", K.CATEGORY_SLUGS)


# --- joins -----------------------------------------------------------------------------------------------------


@query("join1_venue_by_alias", WITH_NAME + "select ord, vid as venue_id, coalesce(canonical_name, nullif(venue_name, '')) as venue, v_lat as lat from n")
def _(t: Tables):
    rows = normalize.has_date(I.raw_events(t, "goabase"))
    found = normalize.resolve_venue(rows, C("venue_name"), I.dimensions(t))
    return found.select("ord", "r.venue_id", F.coalesce("r.canonical_name", F.nullif(C("venue_name"), F.lit(""))).alias("venue"), "r.lat")


@query("join2_venue_by_id", WITH_ID + "select ord, venue_id, v_address as address, v_area as area from n")
def _(t: Tables):
    rows = normalize.has_date(I.raw_events(t, "venue"))
    return normalize.lookup_venue(rows, I.dimensions(t)).select("ord", "venue_id", "r.address", "r.area")


GEO_INPUT = {
    "event_id": "concat('g', event_id)",
    "venue": I.RAW["venue_name"],
    "venue_id": "case when event_id % 7 = 0 then concat('v', user_id) end",
    "address": "case when event_id % 11 = 0 then concat('Kaai ', user_id) end",
    "area": "case when event_id % 13 = 0 then 'Own' end",
    "latitude": "case when event_id % 6 = 0 then cast(51.04 as double) + user_id / cast(4000 as double) end",
    "longitude": "case when event_id % 6 = 0 then cast(3.70 as double) + user_id / cast(2000 as double) end",
}
CACHE = {
    "query": "concat('Kaai ', c_custkey, ', Gent, Belgium')",
    "lat": "case when c_custkey % 3 > 0 then cast(51.05 as double) end",
    "lng": "case when c_custkey % 3 > 0 then cast(3.72 as double) end",
}
AREA_SQL = "(case " + " ".join(
    f"when {{0}} between {a} and {b} and {{1}} between {c} and {d} then '{n}'" for n, a, b, c, d in K.AREA_BOXES
) + " end)"
GEO_SQL = (
    f"with {I.WITH_VENUES}, g as (select {select_list(GEO_INPUT)} from events), k as (select {select_list(CACHE)} from customer), "
    f"j as (select g.*, a.id as aid, a.address as aa, a.lat as alat, a.lng as alng, a.area as aarea, b.id as bid, b.address as ba, b.lat as blat, b.lng as blng, b.area as barea, "
    "k.lat as clat, k.lng as clng, coalesce(nullif(g.address, ''), nullif(g.venue, '')) || ', Gent, Belgium' as geo_query from g left join venue a on a.id = g.venue_id "
    f"left join alias on alias_key = {norm('nullif(g.venue, $$$$)')} left join venue b on b.id = alias.venue_id "
    "left join k on k.query = coalesce(nullif(g.address, ''), nullif(g.venue, '')) || ', Gent, Belgium'), "
    "s as (select *, case when latitude is not null and longitude is not null then 'own' when alat is not null then 'venue id' when blat is not null then 'venue name' "
    "when clat is not null then 'cache' end as place_from from j), "
    "p as (select event_id, geo_query, place_from, case place_from when 'own' then latitude when 'venue id' then alat when 'venue name' then blat when 'cache' then clat else latitude end as latitude, "
    "case place_from when 'own' then longitude when 'venue id' then alng when 'venue name' then blng when 'cache' then clng else longitude end as longitude, "
    "case place_from when 'venue id' then coalesce(aa, address) when 'venue name' then coalesce(ba, address) else address end as address, "
    "case place_from when 'venue name' then bid else venue_id end as venue_id, area, case place_from when 'venue id' then aarea when 'venue name' then barea end as varea from s) "
    f"select event_id, geo_query, place_from, latitude, longitude, address, venue_id, case when place_from = 'own' then coalesce(area, {AREA_SQL.format('latitude', 'longitude')}) "
    f"when place_from in ('venue id', 'venue name') then coalesce(varea, {AREA_SQL.format('latitude', 'longitude')}) when place_from = 'cache' then {AREA_SQL.format('latitude', 'longitude')} "
    "else area end as area from p"
)


def geo_events(t: Tables) -> DataFrame:
    raw = computed(t("events"), GEO_INPUT)
    return normalize.to_event(raw, **{c: C(c) for c in GEO_INPUT})


def geo_cache(t: Tables) -> DataFrame:
    return computed(t("customer"), CACHE)


def placed(t: Tables) -> DataFrame:
    from marquee.operators import enrich

    return enrich.with_place(geo_events(t), I.dimensions(t), geo_cache(t))


@query("join3_place_cascade", f"select place_from, count(*) as n, count(area) as with_area from ({GEO_SQL}) group by place_from")
def _(t: Tables):
    return placed(t).groupBy("place_from").agg(F.count(F.lit(1)).alias("n"), F.count("area").alias("with_area"))


@query("join4_parent_label", "select c.n_nationkey, coalesce(p.n_name, cast(c.parent as varchar)) as parent_label from "
       "(select *, n_nationkey + n_regionkey * 6 as parent from nation) c left join nation p on p.n_nationkey = c.parent")
def _(t: Tables):
    rows = t("nation").withColumn("parent", C("n_nationkey") + C("n_regionkey") * 6)
    return joins.with_parent_label(rows, "n_nationkey", "parent", "n_name").select("n_nationkey", "parent_label")


@query("join6_area_boxes", f"with p as (select vec_id, embedding[1] / 5 + 51.055 as lat, embedding[2] / 5 + 3.73 as lng from embeddings) "
       f"select vec_id, {AREA_SQL.format('lat', 'lng')} as area from p")
def _(t: Tables):
    at = lambda i: F.get("embedding", F.lit(i)) / 5
    rows = t("embeddings").select("vec_id", (at(0) + 51.055).alias("lat"), (at(1) + 3.73).alias("lng"))
    return rows.select("vec_id", joins.area_of(C("lat"), C("lng")).alias("area"))


# as many boxes as orders, some of them wide, a few without any extent, and one in 17 stands without a bound
BOXES = {
    "name": "concat('b', o_orderkey)", "position": "o_custkey * 100 + o_orderkey % 7",
    "low_lat": "50 + cast(o_orderkey * 7919 % 10007 as double) / 10000", "low_lng": "3 + cast(o_orderkey * 104729 % 10009 as double) / 10000",
    "lat_size": "cast(case when o_orderkey % 97 = 0 then 2000 when o_orderkey % 50 = 7 then 0 else 1 + o_custkey % 50 end as double) / 10000",
    "lng_size": "cast(case when o_orderkey % 89 = 0 then 3000 when o_orderkey % 50 = 9 then 0 else 2 + o_custkey % 80 end as double) / 10000",
}
BOX_COLUMNS = {
    "name": "name", "position": "position", "low_lat": "low_lat", "low_lng": "low_lng", "high_lat": "low_lat + lat_size",
    "high_lng": "case when position % 17 = 3 then null else low_lng + lng_size end",
}
# customers stand on corners of the lattice the boxes start on, one in 11 nowhere
STANDS = {
    "c_custkey": "c_custkey", "lat": "case when c_custkey % 11 = 5 then null else 50 + cast(c_custkey * 6007 % 11003 as double) / 10000 end",
    "lng": "3 + cast(c_custkey * 3001 % 10501 as double) / 10000",
}


@query(
    "join6_box_table",
    f"with s as (select {select_list(BOXES)} from orders), b as (select {select_list(BOX_COLUMNS)} from s), p as (select {select_list(STANDS)} from customer), "
    "f as (select c_custkey, arg_min(name, (position, name)) as area from p join b on lat >= low_lat and lat <= high_lat and lng >= low_lng and lng <= high_lng group by c_custkey) "
    "select p.c_custkey, f.area from p left join f on f.c_custkey = p.c_custkey",
)
def _(t: Tables):
    boxes = computed(computed(t("orders"), BOXES), BOX_COLUMNS)
    return joins.areas_by_cell(computed(t("customer"), STANDS), boxes, "lat", "lng").select("c_custkey", "area")


SECOND_TAB = {
    "row_no": "doc_id", "event_id": "case when doc_id % 3 = 0 then concat(' e', doc_id) else '' end",
    "genre_override": "case when doc_id % 9 = 0 then 'House' else '' end", "hide": "''",
}
TABS_SQL = (
    f"a as (select event_id, 0 as tab, row_no, venue, latitude, longitude, genre, hide, approved, "
    f"not (venue is null and latitude is null and genre is null and hide is null and approved is null) as has from ({OVERRIDE_SQL})), "
    "b as (select 'e' || doc_id as event_id, 1 as tab, doc_id as row_no, null as venue, null::double as latitude, null::double as longitude, "
    "case when doc_id % 9 = 0 then 'House' end as genre, null::boolean as hide, null::boolean as approved, doc_id % 9 = 0 as has from documents where doc_id % 3 = 0), "
    "u as (select * from a union all select * from b)"
)


def two_tabs(t: Tables) -> list[DataFrame]:
    return [computed(t("labels"), OVERRIDE_TAB), computed(t.heavy("documents"), SECOND_TAB)]


@query(
    "join7_override_tabs",
    f"with {TABS_SQL}, x as (select event_id, arg_max(row(venue, latitude, genre, hide), case when has then (tab, row_no) end) as o, "
    "arg_max(genre, (tab, row_no)) filter (where true) as g from u group by event_id), "
    "l as (select event_id, max((tab, row_no)) as last from u group by event_id) "
    "select x.event_id, o[1] as venue, o[2] as latitude, o[3] as genre, o[4] as hide, s.genre as strict_genre from x "
    "join l on l.event_id = x.event_id join u s on s.event_id = l.event_id and (s.tab, s.row_no) = l.last",
)
def _(t: Tables):
    tabs = two_tabs(t)
    latest = overrides.pulled_overrides(tabs)
    strict = overrides.pulled_overrides(tabs, strict=True).select("event_id", C("overrides.genre").alias("strict_genre"))
    return latest.select("event_id", "overrides.venue", "overrides.latitude", "overrides.genre", "overrides.hide").join(strict, "event_id")


OLD_NEW = (
    "old as (select o_orderkey as k, o_totalprice as p from orders where o_orderkey % 3 > 0), "
    "new as (select o_orderkey as k, case when o_orderkey % 2 = 0 then o_totalprice else o_totalprice + 1 end as p from orders where o_orderkey % 3 < 2)"
)


@query("join8_full_outer_actions", f"with {OLD_NEW} select coalesce(new.k, old.k) as k, case when old.k is null then 'added' when new.k is null then 'removed' "
       "when old.p is distinct from new.p then 'updated' else 'same' end as action from old full join new on old.k = new.k")
def _(t: Tables):
    rows = t("orders").select(C("o_orderkey").alias("k"), C("o_totalprice").alias("p"))
    old = rows.where(C("k") % 3 > 0)
    new = rows.where(C("k") % 3 < 2).withColumn("p", F.when(C("k") % 2 == 0, C("p")).otherwise(C("p") + 1))
    return upsert.mirror_actions(old, new, "k").select("k", "action")


@query("join9_unseen_keys", "select o_custkey, count(*) as n, false as known from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0) "
       "group by 1 union all select o_custkey, count(*), true from orders where o_custkey in (select c_custkey from customer where c_acctbal > 0) group by 1")
def _(t: Tables):
    rows = t("orders").select("o_custkey")
    known = t("customer").where(C("c_acctbal") > 0).select(C("c_custkey").alias("o_custkey"))
    count = lambda df, flag: df.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).withColumn("known", F.lit(flag))
    return count(joins.unseen(rows, known, "o_custkey"), False).unionByName(count(joins.seen(rows, known, "o_custkey"), True))


@query("join10_place_corrections", "select s_suppkey, case when s_suppkey % 3 = 0 then 51.05018::double else s_acctbal end as lat, "
       "case when s_suppkey % 3 = 0 then 3.7233::double else 0::double end as lng, case when s_suppkey % 3 = 0 then 'Kouter, 9000 Gent' else s_name end as address from supplier")
def _(t: Tables):
    rows = t("supplier").select(
        "s_suppkey", F.when(C("s_suppkey") % 3 == 0, F.lit("  KOUTER -   Kiosk ")).otherwise(C("s_name")).alias("venue"),
        C("s_acctbal").alias("lat"), F.lit(0.0).alias("lng"), C("s_name").alias("address"),
    )
    fixes = t.spark.createDataFrame(K.COORD_FIXES, "venue_key string, lat double, lng double, address string")
    return joins.correct_places(rows, fixes).drop("venue")


@query("join11_detail_once", "select l_orderkey, l_linenumber, l_partkey, p_name from lineitem left join part on p_partkey = l_partkey and p_size > 25")
def _(t: Tables):
    listing = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    details = t("part").where(C("p_size") > 25).select(C("p_partkey").alias("l_partkey"), "p_name")
    return joins.detail_once(listing, details, "l_partkey")


@query(
    "join12_match_by_position",
    "with a as (select o_orderkey, o_orderdate::date as day, row_number() over (partition by o_orderdate::date order by o_orderkey) as n from orders where o_orderkey % 2 = 0), "
    "b as (select o_orderkey as sale, o_totalprice as price, o_orderdate::date as day, row_number() over (partition by o_orderdate::date order by o_orderkey) as n from orders where o_orderkey % 2 = 1) "
    "select a.o_orderkey, a.day, b.sale, b.price from a left join b on a.day = b.day and a.n = b.n",
)
def _(t: Tables):
    rows = t("orders").select("o_orderkey", C("o_orderdate").cast("date").alias("day"), "o_totalprice")
    events = rows.where(C("o_orderkey") % 2 == 0).drop("o_totalprice")
    sales = rows.where(C("o_orderkey") % 2 == 1).select(C("o_orderkey").alias("sale"), C("o_totalprice").alias("price"), "day")
    return joins.match_by_position(events, sales, "day", "o_orderkey", "sale")


@query(
    "join13_cached_lookups",
    "with w as (select distinct concat('Kaai ', user_id) as address from events), c as (select concat('Kaai ', c_custkey) as address, c_acctbal as lat from customer "
    "where c_custkey % 2 = 0) select 'unknown' as part, w.address, null::double as lat, 0::bigint as n from w where w.address not in (select address from c) "
    "union all select 'known', concat('Kaai ', user_id), max(c.lat), count(*) from events left join c on c.address = concat('Kaai ', user_id) group by 2",
)
def _(t: Tables):
    rows = t("events").select(F.concat(F.lit("Kaai "), "user_id").alias("address"))
    cache = t("customer").where(C("c_custkey") % 2 == 0).select(F.concat(F.lit("Kaai "), "c_custkey").alias("address"), C("c_acctbal").alias("lat"))
    known, unknown = joins.known_and_unknown(rows, small(cache), "address")
    counted = known.groupBy("address").agg(F.max("lat").alias("lat"), F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("known"))
    todo = unknown.select("address", F.lit(None).cast("double").alias("lat"), F.lit(0).cast("long").alias("n"), F.lit("unknown").alias("part"))
    return counted.unionByName(todo)


# --- validation --------------------------------------------------------------------------------------------------


@query(
    "val1_event_contract",
    "with r as (select * from (" + I.RAW_SQL + ") where date_start is not null and date_start <> ''), x as (select ord, list_filter([case when ord % 37 = 0 then 'title' end, "
    r"case when not regexp_full_match(date_start, '\d{4}-\d{2}-\d{2}') then 'date_start' end, case when not regexp_full_match(hour_start, '\d{2}:\d{2}') then 'hour_start' end], "
    "lambda p: p is not null) as problems from r) select ord, array_to_string(problems, ',') as problems, problems[1] as first_problem from x",
)
def _(t: Tables):
    rows = normalize.from_goabase(I.raw_events(t, "goabase"), I.dimensions(t))
    broken = rows.withColumn("title", F.when(C("ord") % 37 == 0, F.lit("")).otherwise(C("title")))
    return validate.checked(broken).select("ord", F.array_join("problems", ",").alias("problems"), "first_problem")


@query(
    "val1_valid_and_rejected",
    r"select valid, count(*) as n from (select regexp_full_match(date_start, '\d{4}-\d{2}-\d{2}') and regexp_full_match(hour_start, '\d{2}:\d{2}') as valid "
    f"from ({I.RAW_SQL}) where date_start is not null and date_start <> '') group by valid",
)
def _(t: Tables):
    valid, rejected = validate.split_valid(normalize.from_goabase(I.raw_events(t, "goabase"), I.dimensions(t)))
    count = lambda df, flag: df.agg(F.lit(flag).alias("valid"), F.count(F.lit(1)).alias("n"))
    return count(valid, True).unionByName(count(rejected, False))


@query("val1_calendar_warning", "select o_orderkey, o_orderkey % 3 = 0 as warning, not (o_totalprice = floor(o_totalprice)) as fraction from orders")
def _(t: Tables):
    day = F.when(C("o_orderkey") % 3 == 0, F.lit("2026-13-45")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = t("orders").select("o_orderkey", day.alias("date_start"), C("o_totalprice").alias("going"))
    checked = validate.checked(rows, validate.whole_numbers("going"))
    return checked.select("o_orderkey", validate.calendar_warning().alias("warning"), (F.size("problems") > 0).alias("fraction"))


@query("val2_override_contract", f"with o as ({OVERRIDE_SQL}) select event_id, case when row_no % 8 = 0 then 'overrides.latitude' end as first_problem from o "
       "where not (venue is null and latitude is null and genre is null and hide is null and approved is null)")
def _(t: Tables):
    pulled = overrides.pulled_overrides([computed(t("labels"), OVERRIDE_TAB)]).where(C("overrides").isNotNull())
    number = F.regexp_extract("event_id", r"(\d+)", 1).cast("long")
    broken = pulled.withColumn(
        "overrides", F.when(number % 8 == 0, C("overrides").withField("latitude", F.lit(float("nan")))).otherwise(C("overrides"))
    )
    return validate.checked(broken, validate.override_rules()).select("event_id", "first_problem")


# --- output order ---------------------------------------------------------------------------------------------------


@query("sort1_date_then_hour", f"with d as ({I.DOC_SQL}) select event_id, date_start, hour_start from d where status is distinct from 'duplicate' "
       "order by date_start, hour_start nulls last")
def _(t: Tables):
    return export.active_in_order(I.doc_events(t)).select("event_id", "date_start", "hour_start")


@query("sort2_top_k", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def _(t: Tables):
    return export.top_k(t("orders").select("o_orderkey", "o_totalprice"), 10, C("o_totalprice").desc(), C("o_orderkey"))

