"""Reading and writing: data derived from the given tables goes out and comes back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import text
from marquee.operators import export
from marquee.plans import inputs as I
from marquee.plans.catalog import Tables, norm, query, select_list
from marquee.session import scratch_path
from marquee.sources import dimensions, raw, sheets, tables

C = F.col


def flat(df: DataFrame, separator: str = "|") -> DataFrame:
    """Arrays as text, so both engines show the same."""
    return df.select(
        *[
            F.array_join(C(f.name), separator).alias(f.name) if isinstance(f.dataType, T.ArrayType) else C(f.name)
            for f in df.schema
        ]
    )


@query("src1_raw_arrays", "select event_type as source, event_id, user_id, value from events")
def _(t: Tables):
    folder = scratch_path(t.spark, "raw")
    rows = t("events")
    # files of at most 5,000 records, one JSON array each; the braces and quotes in a note are no borders
    chunk = F.floor(C("event_id") / 5000)
    note = F.lit('} , {"a": [1}\\')
    arrays = rows.groupBy("event_type", chunk.alias("chunk")).agg(
        F.to_json(F.collect_list(F.struct("event_id", "user_id", "value", note.alias("note"), F.array(F.struct("value")).alias("more")))).alias("value")
    )
    arrays = arrays.select("value", F.concat("event_type", F.lit(".json")).alias("source"))
    arrays.write.option("maxRecordsPerFile", 1).partitionBy("source").text(folder)
    schema = T.StructType(
        [T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())]
    )
    missing = raw.read_raw_arrays(t.spark, folder + "-none", schema)
    found = raw.read_raw_arrays(t.spark, folder, schema)
    return found.unionByName(missing).drop("file", "pos")


@query("src2_replace_one_source", "select event_type as _source, event_id, case when event_type = 'view' then value * 2 else value end as value "
       "from events where event_type <> 'view' or event_id % 2 = 0")
def _(t: Tables):
    path = scratch_path(t.spark, "raw")
    rows = t("events").select(C("event_type").alias("_source"), "event_id", "value")
    raw.write_raw(rows, path)
    again = rows.where((C("_source") == "view") & (C("event_id") % 2 == 0)).withColumn("value", C("value") * 2)
    raw.write_raw(again, path)
    return raw.read_raw(t.spark, path, rows.schema).select("_source", "event_id", "value")


@query("src3_read_table", "select o_orderkey, o_orderstatus from orders")
def _(t: Tables):
    path = scratch_path(t.spark, "table")
    rows = t("orders").select("o_orderkey", "o_orderstatus")
    before = tables.read_table(t.spark, path, rows.schema)
    tables.write_table(rows, path)
    return before.unionByName(tables.read_table(t.spark, path, rows.schema))


@query("src4_replace_table", "select o_orderkey, o_totalprice + 2 as o_totalprice from orders")
def _(t: Tables):
    path = scratch_path(t.spark, "table")
    rows = t("orders").select("o_orderkey", "o_totalprice")
    tables.write_table(rows, path)
    # each version reads the one it replaces
    for _ in range(2):
        stored = tables.read_table(t.spark, path, rows.schema)
        tables.write_table(stored.withColumn("o_totalprice", C("o_totalprice") + 1), path)
    return tables.read_table(t.spark, path, rows.schema)


@query("src5_append_unseen", "select c_custkey, arg_min(o_orderkey, o_orderkey) as first_order from orders join customer "
       "on o_custkey = c_custkey group by c_custkey")
def _(t: Tables):
    path = scratch_path(t.spark, "queue")
    rows = t("orders").join(t("customer"), C("o_custkey") == C("c_custkey")).select(
        "c_custkey", C("o_orderkey").alias("first_order")
    )
    tables.append_new(rows, path, "c_custkey", C("first_order"))
    tables.append_new(rows.withColumn("first_order", C("first_order") + 1), path, "c_custkey", C("first_order"))
    return t.spark.read.parquet(path)


NATIONS = {
    "id": "concat('n', n_nationkey)",
    "canonical_name": "n_name",
    "aliases": "array(concat('Natión ', n_nationkey), concat('shared ', n_nationkey % 5))",
    "genres": "array(n_name)",
    "lat": "cast(n_nationkey as double)",
}


@query(
    "src6_registry_lookup",
    f"with venue as (select n_nationkey, {select_list(NATIONS)} from nation), alias as (select alias_key, arg_max(id, (n_nationkey, pos)) as id "
    f"from (select n_nationkey, id, unnest([0, 1, 2]) as pos, {norm('unnest(aliases || [canonical_name])')} as alias_key from venue) group by alias_key) "
    "select id as venue_id, count(*) as customers from customer join alias on alias_key = case c_custkey % 3 when 0 then 'nation ' || c_nationkey "
    "when 1 then 'shared ' || (c_nationkey % 7) else 'nation_' || c_nationkey end group by 1",
)
def _(t: Tables):
    path = scratch_path(t.spark, "venues.json")
    rows = t("nation").orderBy("n_nationkey").selectExpr(*[f"{e} as {n}" for n, e in NATIONS.items()], "n_nationkey")
    listed = F.array_sort(F.collect_list(F.struct("n_nationkey", *NATIONS)))
    rows.agg(F.to_json(F.struct(listed.alias("venues"))).alias("value")).write.text(path)
    venues = dimensions.read_venues(t.spark, path)
    dims = dimensions.venue_dimensions(venues)
    name = F.expr(
        "case c_custkey % 3 when 0 then concat('NATION  ', c_nationkey, '!') when 1 then concat('Shäred ', c_nationkey % 7) "
        "else concat('nation_', c_nationkey) end"
    )
    found = t("customer").select(text.normalize_text(name).alias("alias_key")).join(dims.by_alias, "alias_key")
    return found.groupBy("venue_id").agg(F.count(F.lit(1)).alias("customers"))


ORDER_TAB = {"Event_ID ": "cast(o_orderkey as string)", " Title": "concat('say \"', o_orderpriority, '\",\n', o_orderstatus)", "Notes": "case when o_orderkey % 2 = 0 then o_orderstatus else '' end"}


@query(
    "src7_read_tab",
    "select cast(o_orderkey as varchar) as event_id, 'say \"' || o_orderpriority || '\",' || chr(10) || o_orderstatus as title, "
    "case when o_orderkey % 2 = 0 then o_orderstatus else '' end as notes, '' as venue from orders",
)
def _(t: Tables):
    path = scratch_path(t.spark, "tab")
    sheets.write_tab(t("orders").selectExpr(*[f"{e} as `{n}`" for n, e in ORDER_TAB.items()]), path)
    tab = sheets.read_tab(t.spark, path, lower_headers=True)
    return tab.select("event_id", "title", "notes", sheets.column_or_blank(tab, "venue").alias("venue"))


@query(
    "src8_guarded_tabs",
    "select 'overrides' as tab, count(*) as n from orders union all select 'venues', count(*) from supplier",
)
def _(t: Tables):
    tabs = {
        "overrides": t("orders").select(C("o_orderkey").alias("event_id"), C("o_orderstatus").alias("hide")),
        "plain": t("orders").select(C("o_orderkey").alias("event_id")),
        "keyless": t("orders").select(C("o_orderstatus").alias("hide")),
    }
    counts = [
        df.agg(F.lit(name).alias("tab"), F.count(F.lit(1)).alias("n")) for name, df in tabs.items() if sheets.has_overrides(df)
    ]
    venues = t("supplier").select(C("s_suppkey").alias("id"), C("s_name").alias("canonical_name"))
    checked = sheets.refuse_empty(sheets.require(venues, "id", "canonical_name"))
    counts.append(checked.agg(F.lit("venues").alias("tab"), F.count(F.lit(1)).alias("n")))
    return counts[0].unionByName(counts[1])


CELL = "coalesce(regexp_replace(cast({0} as varchar), '\\.0$', ''), '')"


@query(
    "src9_venue_tab",
    f"with {I.WITH_VENUES} select id, canonical_name, coalesce(initials, '') as initials, array_to_string(aliases, ', ') as aliases, "
    f"coalesce(address, '') as address, {CELL.format('round(lat, 6)')} as lat, {CELL.format('round(lng, 6)')} as lng, "
    f"{CELL.format('underground_weight')} as underground_weight, array_to_string(genres, ', ') as genres, coalesce(area, '') as area, "
    "coalesce(website, '') as website, '' as scrape_url, coalesce(scrape_type, '') as scrape_type, case when hide then 'TRUE' else '' end as hide from venue",
)
def _(t: Tables):
    path = scratch_path(t.spark, "venues")
    rows = I.venues(t).withColumn("lat", F.round("lat", 6)).withColumn("lng", F.round("lng", 6))
    sheets.write_tab(sheets.venue_to_row(rows), path)
    return sheets.read_tab(t.spark, path)


@query("src10_append_staging", "select event_id, event_type from events union all select event_id, event_type from events")
def _(t: Tables):
    path = scratch_path(t.spark, "staging")
    rows = t("events").select("event_id", "event_type")
    tables.append_all(rows, path)
    tables.append_all(rows, path)
    return t.spark.read.parquet(path)


@query(
    "src11_json_export",
    f"with d as ({I.DOC_SQL}) select event_id, date_start, hour_start from d where status is distinct from 'duplicate'",
)
def _(t: Tables):
    path = scratch_path(t.spark, "export")
    rows = I.doc_events(t)
    export.write_json(rows, path)
    return t.spark.read.schema(rows.schema).json(path).select("event_id", "date_start", "hour_start")


FEST = {
    "node_id": "cast(event_id as string)",
    "detail_url": "concat('https://fest.example/nl/day/17/x-', event_id)",
    "title": "concat(event_type, ' ', event_id)",
    "venue": "case when event_id % 3 = 0 then concat('Plein ', user_id) end",
    "date_start": "substr(cast(ts as string), 1, 10)",
    "time_start": "case when event_id % 2 = 0 then substr(cast(ts as string), 12, 5) end",
    "lat": "case when event_id % 5 = 0 then cast(51 as double) end",
    "categories": "array(event_type, 'muziek')",
    "reduction_groups": "array('a', 'b')",
    "all_day": "event_id % 4 = 0",
    "price_detail": "case when event_id % 7 = 0 then 'kids free' end",
    "gallery": "array('https://i.example/1', 'https://i.example/2')",
}
FEST_HEADER = ["event_id", "Title", "DATE_START", "hour_start", "venue", "latitude", "link", "category", "details", "city", "source", "facebook_id"]


@query(
    "src12_festival_tab",
    f"with f as (select {select_list(FEST)} from events) select '' as event_id, title as \"Title\", date_start as \"DATE_START\", coalesce(time_start, '') as hour_start, "
    "coalesce(venue, '') as venue, case when lat is null then '' else '51' end as latitude, detail_url as link, array_to_string(categories, ', ') as category, "
    "coalesce(price_detail, '') as details, 'Gent' as city, 'feesten' as source, '' as facebook_id, node_id as gf_node_id, detail_url as gf_detail_url, "
    "title as gf_title, case when all_day then 'true' else '' end as gf_all_day, 'a | b' as gf_reduction_groups, "
    "'https://i.example/1' || chr(10) || 'https://i.example/2' as gf_gallery, '' as gf_organizer_phone from f",
)
def _(t: Tables):
    from marquee.schemas import FESTIVAL

    given = t("events").selectExpr(*[f"{e} as {n}" for n, e in FEST.items()])
    layout = given.select(
        *[(C(f.name) if f.name in FEST else F.lit(None)).cast(f.dataType).alias(f.name) for f in FESTIVAL]
    )
    path = scratch_path(t.spark, "festival")
    sheets.write_tab(export.festival_rows(layout, FEST_HEADER), path)
    keep = [*FEST_HEADER, "gf_node_id", "gf_detail_url", "gf_title", "gf_all_day", "gf_reduction_groups", "gf_gallery", "gf_organizer_phone"]
    return sheets.read_tab(t.spark, path).select(*keep)


@query("src13_scan_pages", "select page_id, url, length(html)::int as n_chars from pages")
def _(t: Tables):
    pages = raw.read_pages(t.spark, t.path("pages"))
    return pages.select("page_id", "url", F.length("html").alias("n_chars"))


def calendars(t: Tables, per_file: int = 500) -> DataFrame:
    """events as iCal texts: (calendar, ics), a bounded number of events each."""
    e = F.expr
    stamp = F.date_format("ts", "yyyyMMdd'T'HHmmss")
    start = (
        F.when(C("event_id") % 3 == 0, F.concat(F.lit("DTSTART:"), stamp, F.lit("Z")))
        .when(C("event_id") % 3 == 1, F.concat(F.lit("DTSTART;TZID=Europe/Brussels:"), stamp))
        .otherwise(F.concat(F.lit("DTSTART;VALUE=DATE:"), F.date_format("ts", "yyyyMMdd")))
    )
    lines = F.concat_ws(
        "\r\n", F.lit("BEGIN:VEVENT"), start, F.concat(F.lit("DTEND:"), stamp, F.lit("Z")),
        e("case when event_id % 10 > 0 then concat('SUMMARY:', event_type, '\\\\, de\\r\\n el ', event_id) end"),
        e("concat('DESCRIPTION;LANGUAGE=nl:first\\\\nsecond \\\\\\\\n ', event_id)"),
        e("case when event_id % 2 = 0 then 'LOCATION:old' end"), e("case when event_id % 2 = 0 then concat('LOCATION: Zaal ', user_id) end"),
        e("case when event_id % 4 = 0 then concat('URL:https://c.example/', event_id) end"), F.lit("END:VEVENT"),
    )
    rows = t("events").select(F.floor(C("event_id") / per_file).alias("calendar"), "event_id", lines.alias("vevent"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "vevent"))), lambda x: x["vevent"]), "\r\n")
    return rows.groupBy("calendar").agg(F.concat(F.lit("BEGIN:VCALENDAR\r\n"), body, F.lit("\r\nEND:VCALENDAR\r\n")).alias("ics"))


@query("src14_calendar_files", "select count(*) as n_files, (select count(*) from events) as n_events from "
       "(select distinct event_id // 500 from events)")
def _(t: Tables):
    folder = scratch_path(t.spark, "calendars")
    calendars(t).select("ics").write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(f"{folder}/all.ics")
    files = raw.read_calendars(t.spark, folder)
    n = F.size(F.split("ics", "BEGIN:VEVENT")) - 1
    return files.agg(F.count(F.lit(1)).alias("n_files"), F.sum(n).cast("long").alias("n_events"))


@query("src15_existing_keys", f"with d as ({I.DOC_SQL}) select distinct facebook_id from d where facebook_id is not null")
def _(t: Tables):
    return tables.existing_keys(I.doc_events(t), "facebook_id")


@query("src16_subset_of_sources", "select event_id, event_type, '' as asked from events where event_type in ('view', 'click') "
       "union all select null, null, 'nosuch'")
def _(t: Tables):
    rows = t("events").select("event_id", "event_type")
    names = ["View", "CLICK", "nosuch"]
    unknown = raw.unknown_sources(rows, names, "event_type")
    chosen = raw.subset_of_sources(rows, names, "event_type").withColumn("asked", F.lit(""))
    return chosen.unionByName(unknown, allowMissingColumns=True)

