"""Text, number, date, link, array and record functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee import constants as K
from marquee.functions import arrays, dates, numbers, records, text, urls
from marquee.plans.catalog import (
    Tables, computed, dedupe_key, dice, event_id, names, norm, query, select_list,
)

C = F.col

# --- text ---------------------------------------------------------------------------------------------


@query("str1_normalize_text", f"select doc_id, {norm('text')} as folded from documents")
def _(t: Tables):
    return t.heavy("documents").select("doc_id", text.normalize_text(C("text")).alias("folded"))


PAIRS = {"p_partkey": "p_partkey", "a": "p_name", "b": "concat(lower(p_type), ' ', p_name)"}


@query(
    "str2_dice",
    f"with x as (select {select_list(PAIRS)} from part) "
    f"select p_partkey, round({dice('a', 'b')}, 9) as dice from x",
)
def _(t: Tables):
    x = computed(t("part"), PAIRS)
    return x.select("p_partkey", F.round(text.dice(C("a"), C("b")), 9).alias("dice"))


@query(
    "str3_levenshtein",
    f"with x as (select {select_list(PAIRS)} from part) "
    "select p_partkey, levenshtein(a, b)::int as edits from x",
)
def _(t: Tables):
    x = computed(t("part"), PAIRS)
    return x.select("p_partkey", text.levenshtein(C("a"), C("b")).alias("edits"))


@query("str4_event_id", f"select doc_id, {event_id('source', 'text', 'lang')} as event_id from documents")
def _(t: Tables):
    return t.heavy("documents").select("doc_id", text.event_id(C("source"), C("text"), C("lang")).alias("event_id"))


@query("str5_dedupe_key", f"select doc_id, {dedupe_key('text', 'lang')} as key from documents")
def _(t: Tables):
    return t.heavy("documents").select("doc_id", text.dedupe_key(C("text"), C("lang")).alias("key"))


@query(
    "str6_split_names",
    f"select conv_id, turn, array_to_string({names('text')}, '|') as names, "
    f"len({names('text')})::int as n from conversations",
)
def _(t: Tables):
    found = text.split_names(C("text"))
    return t("conversations").select(
        "conv_id", "turn", F.array_join(found, "|").alias("names"), F.size(found).alias("n")
    )


@query(
    "str7_split_list",
    f"select item_id, array_to_string({names('text', '[.]')}, '|') as parts from benchmark",
)
def _(t: Tables):
    return t("benchmark").select("item_id", F.array_join(text.split_list(C("text"), "."), "|").alias("parts"))


@query(
    "str8_clean",
    r"select doc_id, trim(regexp_replace(text, '[\s\x{00a0}]+', ' ', 'g')) as cleaned from documents",
)
def _(t: Tables):
    return t.heavy("documents").select("doc_id", text.clean(C("text")).alias("cleaned"))


SLUG = {
    "p_partkey": "p_partkey",
    "slug": "concat(replace(p_name, ' ', '-'), '-', lpad(cast(p_size as string), 2, '0'), '-06-26')",
}
CAPITALS = "array_to_string(list_transform(string_split({0}, '{1}'), lambda w: upper(w[1]) || w[2:]), ' ')"


@query(
    "str9_slug_titles",
    f"with x as (select {select_list(SLUG)} from part) select p_partkey, "
    + CAPITALS.format(r"regexp_replace(slug, '-\d\d-\d\d-\d\d$', '')", "-") + " as without_date, "
    + CAPITALS.format("replace(slug, '-', ' ')", " ") + " as whole from x",
)
def _(t: Tables):
    x = computed(t("part"), SLUG)
    return x.select(
        "p_partkey", text.title_from_slug(C("slug")).alias("without_date"), text.slug_to_title(C("slug")).alias("whole")
    )


WORDS = ["Ska", "Pop", "Rent", "Ou", "Soul", "The", "Zzz"]
WORD_LIST = "[" + ", ".join(f"'{w}'" for w in WORDS) + "]"


@query(
    "str10_listed_words",
    f"select doc_id, nullif(array_to_string(list_filter({WORD_LIST}, "
    "lambda w: contains(lower(text), lower(w))), ', '), '') as found from documents",
)
def _(t: Tables):
    return t.heavy("documents").select("doc_id", text.listed_words(C("text"), WORDS).alias("found"))


TITLES = {
    "event_id": "event_id",
    "title": "case event_id % 6 when 0 then concat(upper(event_type), ': Name ', user_id, ' + Other ', event_id) "
    "when 1 then concat(upper(event_type), ': all lower ', user_id) "
    "when 2 then concat(upper(event_type), ': Summer Night ', user_id) "
    "when 3 then concat(upper(event_type), ': Act ', user_id) "
    "when 4 then concat('Solo ', user_id, ' + ', event_type, ' + Duo') else concat('Plain ', event_type) end",
}
AFTER_COLON = r"regexp_replace(substr(title, instr(title, ':') + 1), '^\s+|\s+$', '', 'g')"
HINTS = "|".join(K.SUBTITLE_HINTS)


@query(
    "str11_title_artists",
    f"with x as (select {select_list(TITLES)} from events), "
    f"y as (select *, case when contains(title, ':') then {AFTER_COLON} end as rest from x) "
    "select event_id, case when contains(title, ' + ') "
    "then array_to_string(list_transform(string_split(coalesce(rest, title), ' + '), lambda s: trim(s)), ', ') "
    f"when rest <> '' and rest <> lower(rest) and not regexp_matches(lower(rest), '{HINTS}') then rest end as artists from y",
)
def _(t: Tables):
    return computed(t("events"), TITLES).select("event_id", text.title_artists(C("title")).alias("artists"))


@query(
    "str12_plus_artists",
    f"with x as (select {select_list(TITLES)} from events) select event_id, case when contains(title, ' + ') "
    "then array_to_string(string_split(title, ' + '), ', ') end as artists from x",
)
def _(t: Tables):
    return computed(t("events"), TITLES).select("event_id", text.plus_artists(C("title")).alias("artists"))


LINEUP = {
    "event_id": "event_id",
    "act": "concat(upper(substr(event_type, 1, 1)), substr(event_type, 2), ' ', user_id)",
    "lineup": "concat('~~ ', upper(substr(event_type, 1, 1)), substr(event_type, 2), ' ', user_id, ' ....._..... Goa', "
    "chr(10), 'no capital here ... x', chr(10), '** Second Act — live', chr(10), 'Plain line', chr(10), 'Second Act .. again')",
}


@query(
    "str13_lineup_artists",
    f"with x as (select {select_list(LINEUP)} from events) select event_id, concat(act, ', Second Act') as artists from x",
)
def _(t: Tables):
    return computed(t("events"), LINEUP).select("event_id", text.lineup_artists(C("lineup")).alias("artists"))


KIND = {
    "event_id": "event_id",
    "kind": "case event_id % 6 when 0 then 'Club & Bar night' when 1 then 'club night' when 2 then 'bar NIGHT' "
    "when 3 then 'photo expo' when 4 then 'clubbing' else null end",
}


@query(
    "str14_room_from_type",
    "select event_id, case event_id % 6 when 0 then 'club+bar' when 1 then 'club' when 2 then 'bar' "
    "when 3 then 'art' end as room from events",
)
def _(t: Tables):
    return computed(t("events"), KIND).select("event_id", text.room_from_type(C("kind")).alias("room"))


HEADER = {
    "event_id": "event_id",
    "header": "case when event_id % 3 = 0 then 'no room' when event_id % 3 = 1 then "
    "concat('ZAAL ', user_id, ' // ', hour(ts), 'u', lpad(cast(minute(ts) as string), 2, '0')) "
    "else concat(event_type, ' // ', hour(ts), 'u') end",
}


@query(
    "str15_room_and_time",
    "select event_id, case event_id % 3 when 1 then concat('ZAAL ', user_id) when 2 then event_type end as room, "
    "case event_id % 3 when 1 then strftime(ts, '%H:%M') when 2 then strftime(ts, '%H') || ':00' end as hour_start from events",
)
def _(t: Tables):
    return computed(t("events"), HEADER).select(
        "event_id", text.room_of_header(C("header")).alias("room"),
        dates.parse_clock(text.time_of_header(C("header"))).alias("hour_start"),
    )


@query("sort3_truncate", "with l as (select doc_id, text, list_filter(string_split(text, chr(10)), lambda x: x <> '') as l from documents) "
       "select doc_id, substr(text, 1, 500) as cut, nullif(substr(array_to_string(list_slice("
       "l, 1, (select min(i) from range(1, len(l) + 1) r(i) "
       "where length(array_to_string(list_slice(l, 1, i::bigint), ' ')) > 600 "
       "or i = len(l))::bigint), ' '), 1, 600), '') as joined from l")
def _(t: Tables):
    return t.heavy("documents").select(
        "doc_id", text.truncate(C("text"), 500).alias("cut"),
        text.join_until(F.split("text", "\n", -1), 600).alias("joined"),
    )


# --- numbers ---------------------------------------------------------------------------------------------

NUMERALS = {
    "event_id": "event_id",
    "raw": "case event_id % 5 when 0 then concat('  ', value, ' ') when 1 then concat(value, ' km') "
    "when 2 then '' when 3 then concat('-', user_id) else concat('n', value) end",
}


@query(
    "num1_lenient_numbers",
    f"with x as (select {select_list(NUMERALS)} from events), y as (select *, try_cast(trim(raw) as double) as n, "
    r"try_cast(nullif(regexp_extract(trim(raw), '^[+-]?\d+\.?\d*'), '') as double) as lead from x) "
    "select event_id, n as whole_number, trunc(n)::bigint as cut, lead as leading from y",
)
def _(t: Tables):
    x = computed(t("events"), NUMERALS)
    return x.select(
        "event_id", numbers.parse_number(C("raw")).alias("whole_number"), numbers.parse_integer(C("raw")).alias("cut"),
        numbers.parse_leading_number(C("raw")).alias("leading"),
    )


PRICED = {
    "event_id": "event_id",
    "amount": "cast(cast(value as decimal(12,2)) as string)",
    "line": "case event_id % 6 when 0 then concat('Inkom VVK: €', cast(value as decimal(12,2)), ' of meer') "
    "when 1 then concat('prijs € ', cast(value as decimal(12,2)), ' - €', user_id, ' aan de deur') "
    "when 2 then concat('zaal | ', user_id, ' euro') when 3 then 'helemaal GRATIS vandaag' "
    "when 4 then concat('deur: ', user_id) else 'geen prijs' end",
}


@query(
    "num2_prices",
    f"with x as (select {select_list(PRICED)}, user_id as u, event_id % 6 as m from events) select event_id, "
    "case m when 0 then 'VVK: €' || amount when 1 then '€ ' || amount when 4 then 'deur: ' || u end as lineup, "
    "case m when 0 then '€' || amount when 1 then '€ ' || amount when 3 then 'gratis' end as euro, "
    "case m when 0 then '€' || amount when 1 then '€ ' || amount || ' - €' || u end as span, "
    "case m when 0 then '€ ' || amount when 1 then '€ ' || amount when 2 then '€ ' || u || ' euro' end as word, "
    "case m when 0 then amount when 1 then amount end as decimals, "
    "case m when 0 then '€' || amount when 1 then '€ ' || amount when 3 then 'GRATIS' end as free, "
    "case m when 0 then 'VVK: €' || amount when 1 then '€ ' || amount end as presale from x",
)
def _(t: Tables):
    x = computed(t("events"), PRICED)
    line = C("line")
    return x.select(
        "event_id", numbers.price(line, "lineup").alias("lineup"), numbers.price_or_free(line).alias("euro"),
        numbers.price(line, "range").alias("span"), numbers.euro_words(line).alias("word"),
        numbers.price(line, "decimal").alias("decimals"), numbers.price(line, "free_or_euro").alias("free"),
        numbers.price(line, "presale").alias("presale"),
    )


@query(
    "num3_valid_coordinates",
    "select vec_id, case when vec_id % 4 = 0 then null else nullif(embedding[1], 0)::double end as lat from embeddings",
)
def _(t: Tables):
    raw = F.when(C("vec_id") % 4 == 0, F.when(C("vec_id") % 8 == 0, F.lit(0.0)).otherwise(F.lit(float("nan"))))
    first = F.get("embedding", F.lit(0)).cast("double")
    return t("embeddings").select("vec_id", numbers.valid_coordinate(F.coalesce(raw, first)).alias("lat"))


# --- dates -----------------------------------------------------------------------------------------------------


@query(
    "dat1_utc_to_local",
    "with x as (select event_id, timezone('Europe/Brussels', timezone('UTC', date_trunc('second', ts) "
    "+ to_days((user_id * 2)::int))) as l from events) "
    "select event_id, strftime(l, '%Y-%m-%d') as date_start, strftime(l, '%H:%M') as hour_start from x",
)
def _(t: Tables):
    moved = F.expr("ts + make_interval(0, 0, 0, cast(user_id * 2 as int))")
    instant = F.date_format(moved, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    x = t("events").select("event_id", instant.alias("utc"))
    return x.select(
        "event_id", dates.local_date(C("utc")).alias("date_start"), dates.local_time(C("utc")).alias("hour_start")
    )


AS_OF = "1998-06-15"
INFERRED = (
    "case when try_strptime('1998-' || month(d) || '-' || day(d), '%Y-%m-%d') < date '1998-06-15' - interval {0} day "
    "then strftime(try_strptime('1999-' || month(d) || '-' || day(d), '%Y-%m-%d'), '%Y-%m-%d') "
    "else strftime(try_strptime('1998-' || month(d) || '-' || day(d), '%Y-%m-%d'), '%Y-%m-%d') end"
)


@query(
    "dat2_infer_year",
    "with x as (select o_orderkey, o_orderdate as d from orders) select o_orderkey, "
    + ", ".join(f"{INFERRED.format(days)} as by_{name}" for name, days in K.GRACE_DAYS.items())
    + " from x",
)
def _(t: Tables):
    as_of = F.lit(AS_OF).cast("date")
    d = C("o_orderdate")
    return t("orders").select(
        "o_orderkey",
        *[
            dates.infer_year(F.day(d), F.month(d), as_of, days).alias(f"by_{name}")
            for name, days in K.GRACE_DAYS.items()
        ],
    )


NL_LONG = "array('januari','februari','maart','april','mei','juni','juli','augustus','september','oktober','november','december')"
NL_SHORT = "array('jan','feb','mrt','apr','mei','jun','jul','aug','sep','okt','nov','dec')"
EN_LONG = "array('January','February','March','April','May','June','July','August','September','October','November','December')"


def month_of(names_: str, d: str, engine: str) -> str:
    if engine == "spark":
        return f"element_at({names_}, month({d}))"
    return f"({names_.replace('array(', 'list_value(')})[month({d})]"


def day_texts(engine: str) -> str:
    m = lambda n: month_of(n, "o_orderdate", engine)
    return (
        f"case o_orderkey % 4 when 0 then concat('vr ', day(o_orderdate), ' ', {m(NL_LONG)}) "
        f"when 1 then concat('op ', day(o_orderdate), ' ', upper({m(NL_SHORT)}), ' om 20u') "
        f"when 2 then concat(day(o_orderdate), ' ', {m(NL_SHORT)}, ' ', year(o_orderdate)) "
        "else concat(lpad(cast(day(o_orderdate) as string), 2, '0'), '/', lpad(cast(month(o_orderdate) as string), 2, '0'), '/', year(o_orderdate)) end"
    )


@query(
    "dat3_day_month_text",
    "with x as (select o_orderkey, o_orderdate as d from orders) select o_orderkey, "
    f"case when o_orderkey % 4 < 2 then {INFERRED.format(7)} else strftime(d, '%Y-%m-%d') end as date_start from x",
)
def _(t: Tables):
    x = t("orders").selectExpr("o_orderkey", f"{day_texts('spark')} as raw")
    return x.select("o_orderkey", dates.parse_day_month(C("raw"), F.lit(AS_OF).cast("date"), 7).alias("date_start"))


@query(
    "dat4_any_date",
    "select o_orderkey, strftime(o_orderdate + interval 30 year, '%Y-%m-%d') as date_start from orders",
)
def _(t: Tables):
    d = F.add_months(C("o_orderdate").cast("date"), 360)
    days = F.datediff(d, F.lit("1970-01-01").cast("date")).cast("long")
    en = F.element_at(F.expr(EN_LONG), F.month(d))
    nl = F.element_at(F.expr(NL_LONG), F.month(d))
    iso = F.date_format(d, "yyyy-MM-dd")
    pieces = [
        F.concat(iso, F.lit("T20:00:00Z")),
        (days * 86400).cast("string"),
        (days * 86400000 + 3600000).cast("string"),
        F.concat_ws(" ", F.day(d).cast("string"), nl, F.year(d).cast("string")),
        F.concat(en, F.lit(" "), F.day(d), F.lit(", "), F.year(d)),
        F.concat_ws("/", F.day(d).cast("string"), F.month(d).cast("string"), F.year(d).cast("string")),
    ]
    raw = F.element_at(F.array(*pieces), (C("o_orderkey") % len(pieces) + 1).cast("int"))
    x = t("orders").select("o_orderkey", raw.alias("raw"))
    return x.select("o_orderkey", dates.parse_any_date(C("raw"), F.lit(AS_OF).cast("date")).alias("date_start"))


@query(
    "dat5_clock_text",
    "select event_id, case when event_id % 6 = 3 then strftime(ts, '%H') || ':00' when event_id % 6 = 5 then null "
    "else strftime(ts, '%H:%M') end as hour_start, "
    "case when event_id % 6 in (0, 1, 2) then strftime(ts, '%H:%M') "
    "when event_id % 6 = 4 then strftime(ts, '%I:%M') end as showtime from events",
)
def _(t: Tables):
    f = lambda p: F.date_format("ts", p)
    raw = (
        F.when(C("event_id") % 6 == 0, f("H:mm"))
        .when(C("event_id") % 6 == 1, f("H'h'mm"))
        .when(C("event_id") % 6 == 2, F.concat(f("HH.mm"), F.lit("u")))
        .when(C("event_id") % 6 == 3, F.concat(f("H"), F.lit("u")))
        .when(C("event_id") % 6 == 4, f("h:mm a"))
        .otherwise(F.lit("later"))
    )
    x = t("events").select("event_id", raw.alias("raw"))
    return x.select(
        "event_id", dates.parse_clock(C("raw")).alias("hour_start"), dates.parse_showtime(C("raw")).alias("showtime")
    )


TIMED = {
    "event_id": "event_id",
    "line": "case event_id % 3 when 0 then concat('van 19:00 - ', lpad(cast(hour(ts) as string), 2, '0'), ':', lpad(cast(minute(ts) as string), 2, '0')) "
    "when 1 then concat('zaal 18:30 deuren: ', hour(ts), '.', lpad(cast(minute(ts) as string), 2, '0')) else 'geen uur' end",
}


@query(
    "dat6_ranges_and_labels",
    "select event_id, case event_id % 3 when 0 then strftime(ts, '%H:%M') end as hour_end, "
    "case event_id % 3 when 0 then '19:00' when 1 then strftime(ts, '%H:%M') end as hour_start from events",
)
def _(t: Tables):
    x = computed(t("events"), TIMED)
    return x.select(
        "event_id", dates.clock_range_end(C("line")).alias("hour_end"), dates.labelled_clock(C("line")).alias("hour_start")
    )


@query(
    "dat7_dates_in_links",
    "select o_orderkey, case when o_orderkey % 3 < 2 then strftime(o_orderdate, '%Y-%m-%d') end as from_path, "
    "case when o_orderkey % 3 = 2 then '20' || strftime(o_orderdate, '%y-%m-%d') end as from_slug from orders",
)
def _(t: Tables):
    d = lambda p: F.date_format("o_orderdate", p)
    url = (
        F.when(C("o_orderkey") % 3 == 0, F.concat(F.lit("https://site.example/agenda/"), d("yyyy/MM/dd")))
        .when(C("o_orderkey") % 3 == 1, F.concat(F.lit("/nl/events/"), d("yyyy-MM-dd"), F.lit("-some-night")))
        .otherwise(F.concat(F.lit("/concerten/some-name-"), d("dd-MM-yy")))
    )
    x = t("orders").select("o_orderkey", url.alias("url"))
    return x.select(
        "o_orderkey", dates.date_from_path(C("url")).alias("from_path"), dates.date_from_slug(C("url")).alias("from_slug")
    )


@query(
    "dat8_iso_parts",
    "select event_id, strftime(ts, '%Y-%m-%d') as date_start, case when event_id % 2 = 0 then strftime(ts, '%H:%M') end as hour_start from events",
)
def _(t: Tables):
    raw = F.when(C("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    x = t("events").select("event_id", raw.alias("raw"))
    return x.select("event_id", dates.iso_date(C("raw")).alias("date_start"), dates.iso_time(C("raw")).alias("hour_start"))


@query(
    "dat9_range_start",
    "select o_orderkey, case when month(o_orderdate) = 2 and day(o_orderdate) = 29 and (o_orderkey % 30 + 20) % 4 > 0 then null "
    "else '20' || lpad(cast(o_orderkey % 30 + 20 as string), 2, '0') || strftime(o_orderdate, '-%m-%d') end as date_start from orders",
)
def _(t: Tables):
    x = t("orders")
    year = F.lpad((C("o_orderkey") % 30 + 20).cast("string"), 2, "0")
    first = F.date_format("o_orderdate", "dd. MM")
    raw = F.when(C("o_orderkey") % 2 == 0, F.concat(first, F.lit(" > 31. 12. "), year)).otherwise(
        F.concat(first, F.lit(". "), year)
    )
    y = x.select("o_orderkey", raw.alias("raw"))
    return y.select("o_orderkey", dates.range_start(C("raw")).alias("date_start"))


# --- links ------------------------------------------------------------------------------------------------------

HREFS = r"""select page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) as href from pages"""


@query(
    "url1_absolute",
    f"with h as ({HREFS} union all select page_id, url from pages) select page_id, href, case when href = '' then null "
    "when regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') then href when href like '//%' then 'https:' || href "
    "when href like '/%' then 'https://site.example' || href else 'https://site.example/' || href end as url from h",
)
def _(t: Tables):
    from marquee.operators import extract

    pages = t.heavy("pages")
    all_links = extract.links(pages).select("page_id", "href").unionByName(pages.select("page_id", C("url").alias("href")))
    return all_links.select("page_id", "href", urls.absolute("https://site.example", C("href")).alias("url"))


IDS = {
    "event_id": "event_id",
    "url": "case event_id % 4 when 0 then concat('https://x.example/event/', event_id, '/nl') "
    "when 1 then concat('/show?id=', event_id) when 2 then concat('/nl/day/17/a-name-', event_id, '?page=1') else '/agenda' end",
}


@query("url2_id_from_url", "select event_id, case when event_id % 4 < 3 then cast(event_id as varchar) end as id from events")
def _(t: Tables):
    return computed(t("events"), IDS).select("event_id", urls.id_from_url(C("url")).alias("id"))


@query(
    "url3_image_key",
    "select page_id, string_split(string_split(url, '?')[1], '/')[-1] as image from pages",
)
def _(t: Tables):
    return t.heavy("pages").select("page_id", urls.image_key(C("url")).alias("image"))


MAPS = {
    "s_suppkey": "s_suppkey",
    "lat": "cast(50.9 + s_suppkey % 100 / 1000.0 as decimal(8,4))",
    "lng": "cast(3.7 + s_suppkey % 70 / 1000.0 as decimal(8,4))",
}


@query(
    "url4_map_links",
    f"with x as (select {select_list(MAPS)}, s_name from supplier) select s_suppkey, "
    "case when s_suppkey % 3 > 0 then lat::double end as lat, case when s_suppkey % 3 > 0 then lng::double end as lng, "
    "case when s_suppkey % 3 = 0 then 'Tegenover ' || replace(s_name, '#', '/') || ' 7, Gent' end as address from x",
)
def _(t: Tables):
    x = t("supplier").selectExpr(*[f"{e} as {n}" for n, e in MAPS.items()], "s_name")
    name = F.concat(F.lit("Tegenover "), F.replace("s_name", F.lit("#"), F.lit("/")), F.lit(" 7 , , Gent"))
    href = F.concat(
        F.lit("https://maps.example/dir?x=1&daddr="),
        F.when(C("s_suppkey") % 3 > 0, F.concat_ws(",", "lat", "lng")).otherwise(F.url_encode(name)),
        F.lit("&z=2"),
    )
    y = x.select("s_suppkey", href.alias("href"))
    return y.select(
        "s_suppkey", urls.map_latitude(C("href")).alias("lat"), urls.map_longitude(C("href")).alias("lng"),
        urls.map_address(C("href")).alias("address"),
    )


@query("url5_strip_query", "select page_id, regexp_replace(url, '[?#].*$', '') as url from pages")
def _(t: Tables):
    return t.heavy("pages").select("page_id", urls.strip_query(C("url")).alias("url"))


# --- arrays ------------------------------------------------------------------------------------------------------


@query(
    "arr1_joined",
    f"select conv_id, turn, array_to_string({names('text', '[.]')}, ', ') as listed from conversations",
)
def _(t: Tables):
    return t("conversations").select("conv_id", "turn", arrays.joined(text.split_list(C("text"), ".")).alias("listed"))


@query(
    "arr2_first_filled",
    f"select conv_id, turn, array_to_string(case when turn % 2 = 0 then {names('text', '[.]')} else [role] end, '|') as chosen "
    "from conversations",
)
def _(t: Tables):
    some = F.when(C("turn") % 2 == 0, text.split_list(C("text"), "."))
    none = F.array().cast("array<string>")
    return t("conversations").select(
        "conv_id", "turn", F.array_join(arrays.first_filled(none, some, F.array("role")), "|").alias("chosen")
    )


@query(
    "set4_distinct_ignoring_case",
    "with w as (select doc_id, unnest(string_split(text, ' ')) as w, unnest(range(1, len(string_split(text, ' ')) + 1)) as i from documents), "
    "f as (select doc_id, lower(w) as k, min(i) as i, arg_min(w, i) as w from w group by all) "
    "select doc_id, string_agg(w, ' ' order by i) as kept from f group by doc_id",
)
def _(t: Tables):
    return t.heavy("documents").select(
        "doc_id", F.array_join(arrays.distinct_ignoring_case(F.split("text", " ", -1)), " ").alias("kept")
    )


@query(
    "sort4_first_match",
    "select doc_id, list_filter(string_split(text, ' '), lambda w: length(w) > 7)[1] as word from documents",
)
def _(t: Tables):
    return t.heavy("documents").select(
        "doc_id", arrays.first_match(F.split("text", " ", -1), lambda w: F.length(w) > 7).alias("word")
    )


# --- records -------------------------------------------------------------------------------------------------------

JSON = {
    "event_id": "event_id",
    "k": "cast(regexp_extract(props, '(\\\\d+)', 1) as int)",
}


def event_records(t: Tables):
    """events as free-form JSON records: the name and date keys differ from row to row."""
    day = F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    name = F.concat("event_type", F.lit(" "), "user_id")
    third = C("event_id") % 3
    record = F.to_json(
        F.struct(
            F.when(third == 0, name).alias("name"),
            F.when(third != 0, name).alias("title"),
            F.when(third == 0, day).alias("start_date"),
            F.when(third == 1, day).alias("begins_at"),
            F.when(third == 2, day).alias("datetime"),
            F.when(third == 0, F.concat(F.lit("https://pay.example/"), "event_id")).alias("tickets_url"),
            # two links that fit, not in the order of their names
            F.when(third == 1, F.struct(F.concat(F.lit("https://x.example/ticket/"), "event_id").alias("way"), F.lit("https://x.example/shop").alias("buy"))).alias("links"),
            F.when(third == 1, F.lit("https://a.example/tickets")).alias("also"),
            F.when(third == 2, F.concat(F.lit("ftp://ticket/"), "event_id")).alias("url"),
            F.from_json("props", "k int").alias("props"),
            F.when(C("event_id") % 4 != 0, F.concat(F.lit("r"), "event_id")).alias("id"),
            F.when(C("event_id") % 4 == 1, F.lit("11:30 PM")).alias("endTime"),
            F.when(C("event_id") % 4 == 2, F.concat(F.lit("https://i.example/"), "event_id")).otherwise(F.lit("/local.jpg")).alias("cover"),
            F.when(third == 0, F.concat(F.lit("About "), "user_id")).alias("description"),
            F.when(third == 1, F.repeat(F.lit("long "), F.lit(200))).alias("body"),
            F.when(third == 0, C("user_id") + F.lit(0.5)).alias("price"),
        )
    )
    record = F.when(third == 1, F.regexp_replace(record, r"\}$", ',"price":"free"}')).otherwise(record)
    return t.heavy("events").select("event_id", "user_id", "ts", record.alias("record"))


@query(
    "jsn1_first_key",
    "select event_id, event_type || ' ' || user_id as title, strftime(ts, '%Y-%m-%dT%H:%M') as start, "
    "cast(json_extract_string(props, '$.k') as int) as k from events",
)
def _(t: Tables):
    x = event_records(t).withColumn("v", records.parse(C("record")))
    return x.select(
        "event_id", records.first_key(C("v"), K.NAME_KEYS).alias("title"), records.first_key(C("v"), K.DATE_KEYS).alias("start"),
        records.value(C("v"), "props.k", "int").alias("k"),
    )


@query(
    "jsn2_ticket_url",
    "select event_id, case event_id % 3 when 0 then 'https://pay.example/' || event_id "
    "when 1 then 'https://x.example/ticket/' || event_id end as ticket_url from events",
)
def _(t: Tables):
    return event_records(t).select("event_id", records.ticket_url(C("record")).alias("ticket_url"))
