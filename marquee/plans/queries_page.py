"""Extraction from pages, calendars and embedded records, and the whole runs."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.functions import dates
from marquee.functions.pages import BLOCKS
from marquee.operators import extract, festival
from marquee.plans import chains
from marquee.plans import inputs as I
from marquee.plans import queries_event as E
from marquee.plans import queries_scalar as S
from marquee.plans import queries_source as Q
from marquee.plans import queries_table as B
from marquee.plans.catalog import Tables, computed, event_id, query
from marquee.plans.queries_source import flat

C = F.col

# --- calendars ------------------------------------------------------------------------------------------


@query(
    "ext1_calendar_events",
    "with x as (select *, date_trunc('second', ts) as s, timezone('Europe/Brussels', timezone('UTC', date_trunc('second', ts))) as l from events where event_id % 10 > 0), "
    "y as (select *, case when event_id % 3 = 0 then l else s end as m from x) "
    "select (event_id // 500)::bigint as calendar, event_type || ', deel ' || event_id as title, strftime(m, '%Y-%m-%d') as date_start, "
    "case when event_id % 3 < 2 then strftime(m, '%H:%M') end as hour_start, strftime(l, '%H:%M') as hour_end, "
    "case when event_id % 4 = 0 then 'https://c.example/' || event_id end as source_url, 'first' || chr(10) || 'second ' || chr(92) || 'n ' || event_id as description, "
    "case when event_id % 2 = 0 then 'Zaal ' || user_id end as location_raw from y where strftime(m, '%Y-%m-%d') >= '2024-01-03'",
)
def _(t: Tables):
    return extract.calendar_events(Q.calendars(t), "calendar", "ics", min_date="2024-01-03").drop("pos")


# --- links -----------------------------------------------------------------------------------------------


@query(
    "ext2_distinct_links",
    r"""with h as (select page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) as href,
    unnest(range(0, len(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)))) as pos from pages)
    select page_id, regexp_replace(href, '[?#].*$', '') as href, min(pos)::int as pos from h where regexp_matches(href, '^/[a-zA-Z]+') group by all""",
)
def _(t: Tables):
    return extract.distinct_links(extract.links(t.heavy("pages")), "page_id", r"^/[a-zA-Z]+")


def listing_pages(t: Tables) -> DataFrame:
    """events as listing pages: one page per event, with a link to the detail page of its user."""
    html = F.concat(
        F.lit('<ul><li><a class="x" href="/nl/day/'), F.day("ts"), F.lit("/act-"), "user_id",
        F.lit('?from=list"><b>Act</b> &amp; more</a></li><li><a href="/other">o</a></li></ul>'),
    )
    return t.heavy("events").select(C("event_id").alias("page_id"), F.day("ts").alias("day"), html.alias("html"))


NODE_LINK = r"^/nl/day/\d+/.+-(\d+)$"


@query(
    "ext3_listing_to_nodes",
    "select cast(user_id as varchar) as node_id, '/nl/day/' || arg_min(day(ts), (day(ts), event_id)) || '/act-' || user_id as href, min(day(ts))::int as first_day, "
    "case when max(day(ts)) > min(day(ts)) then max(day(ts))::int end as last_day, array_to_string(list_sort(list(distinct day(ts))), ',') as days from events group by user_id",
)
def _(t: Tables):
    pages = listing_pages(t)
    found = extract.links(pages).join(pages.select("page_id", "day"), "page_id")
    nodes = extract.node_days(found, NODE_LINK, "day", F.struct("day", "page_id", "pos"))
    return nodes.withColumn("days", F.array_join(C("days").cast("array<string>"), ","))


def with_head(t: Tables) -> DataFrame:
    """pages with meta tags in their head, and an image in some."""
    tags = F.concat(
        F.when(C("page_id") % 3 == 0, F.concat(F.lit('<meta property="og:image" content="https://i.example/'), "page_id", F.lit('.jpg">')))
        .when(C("page_id") % 3 == 1, F.concat(F.lit('<meta content="https://i.example/'), "page_id", F.lit('.png" property="og:image"/>')))
        .otherwise(F.lit("")),
        F.when(C("page_id") % 2 == 0, F.concat(F.lit("<meta property=og:description content=' Rock &amp; r&#111;ll &eacute; "), "page_id", F.lit(" '>"))).otherwise(F.lit("")),
    )
    head = F.replace("html", F.lit("<head>"), F.concat(F.lit("<head>"), tags))
    image = F.when(C("page_id") % 5 == 0, F.concat(F.lit("<article><img class=p src='/img/"), "page_id", F.lit("'>"))).otherwise(F.lit("<article>"))
    return t.heavy("pages").select("page_id", "url", F.replace(head, F.lit("<article>"), image).alias("html"))


@query(
    "ext4_meta_tags",
    "select page_id, case page_id % 3 when 0 then 'https://i.example/' || page_id || '.jpg' when 1 then 'https://i.example/' || page_id || '.png' "
    "else case when page_id % 5 = 0 then '/img/' || page_id end end as image_url, case when page_id % 2 = 0 then 'Rock & roll é ' || page_id end as description from pages",
)
def _(t: Tables):
    h = C("html")
    return with_head(t).select("page_id", extract.main_image(h).alias("image_url"), extract.page_description(h).alias("description"))


@query(
    "ext6_first_ticket_link",
    "select page_id, case when page_id % 4 = 1 then 'https://shop.example/x/' || page_id when page_id % 4 = 2 then 'https://tickets.example/' || page_id end as ticket_url "
    "from pages where page_id % 4 in (1, 2)",
)
def _(t: Tables):
    a = lambda href, label: F.concat(F.lit("<a rel=x href='"), F.lit(href), "page_id", F.lit(f"'>{label}</a>"))
    more = F.concat(
        a("https://own.example/tickets/", "Tickets"), a("https://other.example/", "Site"),
        F.when(C("page_id") % 4 == 1, a("https://shop.example/x/", "<span>Reserveer</span> nu")).otherwise(F.lit("")),
        F.when(C("page_id") % 4 == 2, a("https://tickets.example/", "hier")).otherwise(F.lit("")),
    )
    pages = t.heavy("pages").select("page_id", F.concat("html", more).alias("html"))
    return extract.first_ticket_link(extract.links(pages), "page_id", "own.example")


# --- texts --------------------------------------------------------------------------------------------------

PLAIN = (
    "trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace({0}, '<[^>]*>', '', 'g'), '&lt;', '<'), "
    "'&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&'), '\\s+', ' ', 'g'))"
)


@query(
    "ext7_descriptions",
    # a paragraph ends where the next block begins, or the block around it ends
    rf"""with h as (select page_id, regexp_replace(regexp_extract(html, '(?s)</h1>(.*)$', 1), '(?i)(</?(?:{"|".join(sorted(BLOCKS))})\b)', '</p>\1', 'g') as html from pages),
    p as (select page_id, unnest(regexp_extract_all(html, '(?is)<p\b[^>]*>(.*?)</p>', 1)) as raw,
    unnest(range(0, len(regexp_extract_all(html, '(?is)<p\b[^>]*>(.*?)</p>', 1)))) as pos from h), """
    f"x as (select page_id, pos, {PLAIN.format('raw')} as txt from p), "
    "s as (select page_id, coalesce(min(pos) filter (where regexp_matches(txt, '(?i)zzz|thsh ')), 1000000) as stop from x group by page_id), "
    "k as (select x.* from x join s on s.page_id = x.page_id where pos < stop and length(txt) >= 25 and not regexp_matches(txt, '(?i)^(the|la) ')), "
    "c as (select *, coalesce(sum(length(txt) + 1) over (partition by page_id order by pos rows between unbounded preceding and 1 preceding), 0) - 1 as before from k) "
    "select pages.page_id, substr(string_agg(txt, ' ' order by pos), 1, 600) as description from pages left join c on c.page_id = pages.page_id and before <= 600 group by pages.page_id",
)
def _(t: Tables):
    """Pages with paragraphs in a header, a menu and a footer too, which are no part of the description."""
    beside = "<header class=x><div><p>A paragraph of the header, long enough to count</p></div></header>"
    below = "<nav><p>A menu with a paragraph of many words, zzz</nav><footer><footer>a</footer><p>Our address and many other things"
    html = F.replace(F.replace(C("html"), F.lit("</h1>"), F.lit(f"</h1>{beside}")), F.lit("</body>"), F.lit(f"{below}</body>"))
    text_of = extract.description(html, 25, skip="(?i)^(the|la) ", stop="(?i)zzz|thsh ", limit=600)
    return t.heavy("pages").select("page_id", text_of.alias("description"))


CARDS = {
    "event_id": "event_id",
    "card": "case when event_id % 4 = 0 then concat('Title ', event_id, ' without a date') else concat('The  ', event_type, ' ', event_id, '  do ', day(ts), ' jan ', "
    "case when event_id % 4 = 1 then '' else concat(substr(cast(ts as string), 12, 5), ' Zaal ', user_id, ' ') end) end",
}


@query(
    "ext8_card_fields",
    "select event_id, case when event_id % 4 = 0 then 'Title ' || event_id || ' without a date' else 'The ' || event_type || ' ' || event_id end as title, "
    "case when event_id % 4 > 0 then strftime(ts, '%Y-%m-%d') end as date_start, case when event_id % 4 > 1 then strftime(ts, '%H:%M') end as hour_start, "
    "case when event_id % 4 > 1 then 'Zaal ' || user_id end as room from events",
)
def _(t: Tables):
    fields = extract.card_fields(C("card"), F.lit("2024-01-01").cast("date"))
    return computed(t("events"), CARDS).select("event_id", *[c.alias(n) for n, c in fields.items()])


@query(
    "ext9_page_blocks",
    "with b as (select page_id, string_split(html, '<p>') as l from pages) select page_id, unnest(range(1, len(l)))::int as pos, unnest(l[2:]) as block from b",
)
def _(t: Tables):
    return extract.blocks(t.heavy("pages"), "page_id", "html", "<p>")


TEXT = {
    "event_id": "event_id",
    "content": "concat('intro', chr(10), chr(10), ' ', event_type, ' ', event_id, ' ', chr(10), substr(cast(ts as string), 9, 2), '/01/2024 at ', substr(cast(ts as string), 12, 5), ' sharp', chr(10), "
    "'line one', chr(10), 'X', chr(10), '31/12/2024 at 20:00', chr(10), 'a', chr(10), 'b', chr(10), ' c ', chr(10), 'd')",
}


@query(
    "ext10_events_in_text",
    "select event_id, event_type || ' ' || event_id as title, strftime(ts, '%Y-%m-%d') as date_start, strftime(ts, '%H:%M') as hour_start, 'line one X' as description from events  "
    "union all select event_id, 'X', '2024-12-31', '20:00', 'a b c' from events where false",
)
def _(t: Tables):
    return extract.events_in_text(computed(t("events"), TEXT), "event_id", "content").drop("pos")


LABELLED = {
    "event_id": "event_id",
    "html": "concat('<div class=\"field field--price\"><div class=\"field__label\"> PRIJS </div><div class=\"field__items\"><div class=\"field__item\">&euro; <b>', user_id, '</b></div></div></div>', "
    "case when event_id % 2 = 0 then concat('<div class=\"field\"><h3 class=\"field__label\">Kortingsgroepen</h3> <div class=\"field__item\">kids, <span>', event_type, '</span> &#43; <div>more</div></div></div>') else '' end)",
}


@query(
    "ext12_labelled_fields",
    "select event_id, '€ ' || user_id as price, case when event_id % 2 = 0 then 'kids, ' || event_type || ' + more' end as groups, null::varchar as genre from events",
)
def _(t: Tables):
    rows = computed(t("events"), LABELLED)
    return rows.select(
        "event_id", extract.labelled_field(C("html"), "Prijs").alias("price"), extract.labelled_field(C("html"), "kortingsgroepen").alias("groups"),
        extract.labelled_field(C("html"), "Genre").alias("genre"),
    )


@query("ext13_script_call", "select page_id, html from pages union all select -1, null")
def _(t: Tables):
    pages = t.heavy("pages")
    slashes = F.replace("html", F.lit("\\"), F.lit("\\\\"))
    escaped = F.replace(F.replace(F.replace(slashes, F.lit('"'), F.lit('\\"')), F.lit("/"), F.lit("\\/")), F.lit("'"), F.lit("\\'"))
    escaped = F.replace(F.replace(escaped, F.lit("\n"), F.lit("\\n")), F.lit("\t"), F.lit("\\t"))
    script = F.concat(F.lit("$('#agenda').replaceWith('"), escaped, F.lit("'); done()"))
    rows = pages.select("page_id", script.alias("js"))
    none = rows.agg(F.lit(-1).cast("long").alias("page_id"), F.lit("no call here").alias("js"))
    return rows.unionByName(none).select("page_id", extract.call_argument(C("js")).alias("html"))


@query(
    "ext14_list_then_detail",
    "select o_orderkey, coalesce(c.c_name, o_orderstatus) as title, coalesce(case when o_orderkey % 3 = 0 then 'list' end, c.c_mktsegment) as price from orders "
    "left join customer c on c.c_custkey = o_custkey and c_acctbal > 0",
)
def _(t: Tables):
    listing = t("orders").select(
        "o_orderkey", "o_custkey", C("o_orderstatus").alias("title"), F.when(C("o_orderkey") % 3 == 0, F.lit("list")).alias("price")
    )
    detail = t("customer").where(C("c_acctbal") > 0).select(C("c_custkey").alias("o_custkey"), C("c_name").alias("title"), C("c_mktsegment").alias("price"))
    return extract.list_then_detail(listing, detail, "o_custkey", ["title"], ["price"]).drop("o_custkey")


@query(
    "ext15_once_per_event",
    "with e as (select event_id, event_type || user_id as title, strftime(ts, '%Y-%m-%d') as date_start, case when event_id % 2 = 0 then 'u' || user_id end as source_url from events) "
    "select min(event_id) as event_id, coalesce(source_url, title || '|' || date_start) as seen from e group by seen",
)
def _(t: Tables):
    rows = t("events").select(
        "event_id", F.concat("event_type", "user_id").alias("title"), F.date_format("ts", "yyyy-MM-dd").alias("date_start"),
        F.when(C("event_id") % 2 == 0, F.concat(F.lit("u"), "user_id")).alias("source_url"),
    )
    once = extract.once_per_event(rows, [], C("event_id"))
    return once.select("event_id", F.coalesce("source_url", F.concat_ws("|", "title", "date_start")).alias("seen"))


# --- embedded records --------------------------------------------------------------------------------------------


@query(
    "jsn3_event_arrays",
    "select event_id, event_type || ' ' || user_id as title, strftime(ts, '%Y-%m-%d') as date_start, strftime(ts, '%H:%M') as hour_start, "
    "case event_id % 3 when 0 then 'https://pay.example/' || event_id when 1 then 'https://x.example/ticket/' || event_id end as ticket_url, "
    "case when event_id % 4 = 0 then 'https://api.example/#/events' else 'https://api.example/#/events/r' || event_id end as source_url, case when event_id % 4 = 1 then '23:30' end as hour_end, "
    "case event_id % 3 when 0 then 'About ' || user_id when 1 then substr(repeat('long ', 200), 1, 500) end as description, case event_id % 3 when 0 then 'EUR' || user_id || '.50' when 1 then 'free' end as price, "
    "case when event_id % 4 = 2 then 'https://i.example/' || event_id end as image_url from events where event_id % 5 < 4",
)
def _(t: Tables):
    r = F.concat(F.lit("["), "record", F.lit("]"))
    fifth = C("event_id") % 5
    blob = (
        F.when(fifth == 0, r).when(fifth == 1, F.concat(F.lit('{"n":1,"results":'), r, F.lit("}")))
        .when(fifth == 2, F.concat(F.lit('{"data":{"items":'), r, F.lit("}}"))).when(fifth == 3, F.concat(F.lit('{"events":'), r, F.lit("}")))
        .otherwise(F.concat(F.lit('{"other":'), r, F.lit("}")))
    )
    rows = S.event_records(t).select("event_id", blob.alias("blob"))
    return extract.json_events(rows, "event_id", "blob", F.lit("2024-01-01").cast("date"), "https://api.example", "https://api.example/#/events").drop("pos")


def nested_blob() -> Column:
    """A JSON text with events at several depths."""
    start = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return F.format_string(
        '{"app":{"w":[{"x":1},{"list":[{"title":"Deep %s","scheduling":{"config":{"startDate":"%s","endDate":"2024-02-01T23:45:00"}},"slug":"deep-%s","mainImage":{"url":"https://i.example/d.jpg"},"registration":{"external":{"registration":"https://t.example/d"},"ticketing":{"lowestPrice":{"amount":"%s"}}}}]}]},'
        '"flat":{"title":"Flat %s","start":"%s","description":"about %s","image":"relative.jpg"},"no":{"title":"No date"}}',
        "event_id", start, "event_id", "user_id", "event_id", start, "event_type",
    )


@query(
    "jsn4_deep_walk",
    "select event_id, 5 as depth, 'Deep ' || event_id as title, strftime(ts, '%Y-%m-%d') as date_start from events union all select event_id, 1, 'Flat ' || event_id, strftime(ts, '%Y-%m-%d') from events",
)
def _(t: Tables):
    rows = t.heavy("events").select("event_id", nested_blob().alias("blob"))
    found = extract.nested_events(rows, ["event_id"], "blob")
    start = F.coalesce(*[F.try_variant_get("v", p, "string") for p in extract.START_PATHS])
    return found.select(
        "event_id", F.size("path").alias("depth"), F.try_variant_get("v", "$.title", "string").alias("title"), dates.iso_date(start).alias("date_start")
    )


@query(
    "ext5_structured_events",
    "select event_id, 'Deep ' || event_id as title, strftime(ts, '%Y-%m-%d') as date_start, strftime(ts, '%H:%M') as hour_start, '23:45' as hour_end, null::varchar as description, "
    "'https://s.example/event-details/deep-' || event_id as source_url, '€ ' || user_id as price, 'https://t.example/d' as ticket_url, 'https://i.example/d.jpg' as image_url from events union all "
    "select event_id, 'Flat ' || event_id, strftime(ts, '%Y-%m-%d'), strftime(ts, '%H:%M'), null, 'about ' || event_type, null, null, null, null from events union all "
    "select event_id, 'Linked ' || event_id, strftime(ts, '%Y-%m-%d'), strftime(ts, '%H:%M'), '22:00', null, 'https://l.example', '€ 7.5', null, 'https://l.example/i.png' from events where event_id % 3 = 0",
)
def _(t: Tables):
    start = F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    ld = F.format_string(
        '[{"@type":"Event","name":" Linked %s","startDate":"%s","endDate":"2024-01-09T22:00","image":"https://l.example/i.png","url":"https://l.example","offers":{"price":7.5}},{"@type":"Place","name":"x"}]', "event_id", start
    )
    html = F.concat(
        F.lit('<html><script type="application/json" id="a">'), nested_blob(), F.lit("</script><script>var x = 1</script><script type=\"application/json\">{broken</script>"),
        F.when(C("event_id") % 3 == 0, F.concat(F.lit('<script type="application/ld+json">'), ld, F.lit("</script>"))).otherwise(F.lit("")), F.lit("</html>"),
    )
    return extract.structured_events(t.heavy("events").select("event_id", html.alias("html")), "event_id", site="https://s.example")


class _Links(HTMLParser):
    """The links of one page (small helper of the example extractor)."""

    def __init__(self):
        super().__init__()
        self.hrefs: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.hrefs.append(dict(attrs).get("href") or "")


def link_records(html: str) -> list[dict]:
    if "$$$" in html:
        raise ValueError("unreadable page")
    parser = _Links()
    parser.feed(html)
    return [{"href": h} for h in parser.hrefs]


UDF2_SQL = r"""select page_id, null::varchar as _error, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) as href from pages where not contains(html, '$$$')
    union all select page_id, 'ValueError: unreadable page', null from pages where contains(html, '$$$')"""


@query("udf2_page_extractor", UDF2_SQL)
def _(t: Tables):
    return extract.run_extractor(t.heavy("pages"), "page_id", "html", link_records, "href string")


@query("udf2_extractor_in_sql", UDF2_SQL)
def _(t: Tables):
    extract.register_extractor(t.spark, "page_links", link_records, "href string")
    return t.spark.sql("select p.page_id, x.* from {pages} p, lateral page_links(p.html) x", pages=t.heavy("pages"))


@query("udf3_failure_isolation", "select contains(html, '$$$') as failed, count(*) as n from pages where contains(html, '$$$') or contains(html, '<a ') group by 1")
def _(t: Tables):
    rows = extract.run_extractor(t.heavy("pages"), "page_id", "html", link_records, "href string")
    return rows.select("page_id", C("_error").isNotNull().alias("failed")).distinct().groupBy("failed").agg(F.count(F.lit(1)).alias("n"))


@query(
    "udf1_chained_enrichers",
    B.FULL_GENRE_SQL + ", c as (select best.*, title || chr(10) || coalesce(description, '') || chr(10) as t from best), "
    f"s as (select *, {B.NAMES_IN} as l from c) select event_id, lab.genre, array_to_string({B.FIRST_NAMES}, '|') as artists, t as combined from s left join lab on lab.id = s.gid",
)
def _(t: Tables):
    from marquee.operators import enrich

    dims, genres = I.dimensions(t), B.genres(t)
    parts = [F.coalesce(C(c), F.lit("")) for c in ("title", "description", "details")]
    done = (
        B.part_events(t)
        .transform(lambda d: enrich.with_genre(d, genres, dims))
        .transform(enrich.with_artists)
    )
    return done.select("event_id", "genre", F.array_join("artists", "|").alias("artists"), F.concat_ws("\n", *parts).alias("combined"))


# --- festival pages ------------------------------------------------------------------------------------------------

BASE = "https://fest.example"


def detail_pages(t: Tables) -> DataFrame:
    """events as festival detail pages: any quoting, nested tags, entities, fields without links."""
    e = F.expr
    html = e(
        """concat('<html><body><h1> <span>Act</span>  ', event_type, ' ', event_id, '</h1>',
        '<div class="info"><div class="field field--name-address location-address"><div class="field__item">Office 1</div></div></div>',
        '<div class="field field--name-gf-event-time"><div class="field__item">10.00 u.</div><div class="field__item"><b>', substr(cast(ts as string), 12, 5), '</b></div>',
        case when event_id % 4 = 0 then '<div class="field__item">Hele <i>dag</i></div>' else '' end, '</div></div>',
        '<div class="field field--name-organizer"><div class=field__item>', case when event_id % 6 = 5 then 'nobody' else concat('<a class=o href=QQ/nl/org/', user_id, 'QQ>Org &amp; <em>caf&eacute;</em> ', user_id, '</a>') end, '</div></div>',
        case when event_id % 7 = 0 then '' else '<div class="field field--name-website"><div class="field__item"><a href=https://w.example/x>site</a></div></div>' end,
        case when event_id % 3 = 0 then concat('<div class="field field--name-categories"><div class="field__item">Muziek</div><div class="field__item"><div>', event_type, '</div> <span>live</span></div></div>') else '' end,
        '<div><div class="field"><div class="field__label">Prijs</div><div class="field__item">&euro; <b>', user_id, '</b> <i>of meer</i></div></div>',
        case when event_id % 2 = 0 then '<div class="field no-label"><div class="field__item">kids <b>gratis</b> &#43; 65</div></div>' else '' end, '</div>',
        '<div class="field"><div class="field__label">Kortingsgroepen</div><div class="field__item">kids, <span>65+</span> , </div></div>',
        case when event_id % 4 = 1 then concat('<div class="field"><div class="field__label">Genre</div><div class="field__item">', event_type, '</div></div>') else '' end,
        '<ul class="field--name-part-of"><li title="t"><span>UitPAS</span></li><li title=QQVanaf 6 jaarQQ><img src=x></li></ul>',
        '<img src="/sites/styles/medium/public/activity/image/a', event_id % 5, '.jpg?itok=1"><img src="/sites/styles/news_detail_large/public/activity/image/a', event_id % 5, '.jpg?itok=2">',
        '<img src="/sites/styles/large/public/activity/image/b.jpg">',
        '<section class=QQgroup-location-sidebarQQ><h3 class="location-name">Plein <b>', user_id, '</b> Oost</h3><div class="field field--name-address location-address"><div class="field__item">Kaai ', user_id, '</div></div>',
        '<div class="field field--name-postalcode location-postalcode">9000</div><div class="field field--name-locality location-locality">Gent</div>',
        '<div class="field field--name-phone location-phone"><a href="tel:09">tel:09 <b>123</b></a></div><div class="field field--name-email location-email"><i>a@b.example</i></div>',
        case when event_id % 2 = 0 then concat('<div class="gf-google-maps-link"><a href="https://maps.example/?x=1&amp;daddr=51.0', user_id, ',3.7', user_id, '">route</a></div>') else '' end, '</section>',
        '<div class="field field--name-url location-url">none here</div><a href="/far/away">far</a>',
        '<div class="group--description"><div class="field__label">Over</div><div><p>Some <b>bold</b> text ', event_id, '</p></div> end</div></main>',
        case when event_id % 5 = 0 then concat('<a class="btn" href="https://tickets.example/', event_id, '?a=1&amp;b=2">koop</a>') else '' end,
        '<script src="https://app-eu.readspeaker.com/cgi-bin/rsent?id=1&amp;lang=nl"></script><a href="/node/', user_id, '/calendar.ics">ics</a></body></html>')""".replace("QQ", "\\'")
    )
    url = F.concat(F.lit(BASE + "/nl/day/17/act-"), "user_id")
    days = F.when(C("event_id") % 3 == 0, F.array(F.day("ts"), F.day("ts") + 2)).otherwise(F.array(F.day("ts")))
    return t.heavy("events").select("event_id", url.alias("url"), days.alias("days"), html.alias("html"))


IMG = "'https://fest.example/sites/styles/news_detail_large/public/activity/image/a' || event_id % 5 || '.jpg?itok=2'"
DETAIL = {
    "node_id": "cast(user_id as varchar)",
    "detail_url": "'https://fest.example/nl/day/17/act-' || user_id",
    "ics_url": "'https://fest.example/node/' || user_id || '/calendar.ics'",
    "scraped_at": "'2026-07-01T00:00:00Z'",
    "title": "'Act ' || event_type || ' ' || event_id",
    "venue": "'Plein ' || user_id || ' Oost'",
    "address": "'Kaai ' || user_id || ', 9000 Gent'",
    "date_start": "'2026-07-' || lpad(cast(day(ts) as varchar), 2, '0')",
    "time_start": "'10:00'",
    "lat": "case when event_id % 2 = 0 then ('51.0' || user_id)::double end",
    "lng": "case when event_id % 2 = 0 then ('3.7' || user_id)::double end",
    "description": "'Some bold text ' || event_id || ' end'",
    "website": "case when event_id % 7 > 0 then 'https://w.example/x' end",
    "categories": "case when event_id % 3 = 0 then 'Muziek|' || event_type || ' live' else '' end",
    "organizer": "case when event_id % 6 < 5 then 'Org & café ' || user_id end",
    "price": "'€ ' || user_id || ' of meer'",
    "image_url": IMG,
    "source": "'feesten'",
    "end_date_start": "case when event_id % 3 = 0 then '2026-07-' || lpad(cast(day(ts) + 2 as varchar), 2, '0') end",
    "time_end": "strftime(ts, '%H:%M')",
    "all_times": "'10:00|' || strftime(ts, '%H:%M')",
    "all_day": "event_id % 4 = 0",
    "price_detail": "case when event_id % 2 = 0 then 'kids gratis + 65' end",
    "reduction_groups": "'kids|65+'",
    "accessibility": "'UitPAS|Vanaf 6 jaar'",
    "genre": "case when event_id % 4 = 1 then event_type end",
    "raw_categories": "case when event_id % 3 = 0 then 'Muziek|' || event_type || ' live' else '' end",
    "organizer_url": "case when event_id % 6 < 5 then 'https://fest.example/nl/org/' || user_id end",
    "organizer_address": "null::varchar",
    "organizer_phone": "null::varchar",
    "organizer_email": "null::varchar",
    "venue_phone": "'09 123'",
    "venue_email": "'a@b.example'",
    "venue_url": "null::varchar",
    "ticket_url": "case when event_id % 5 = 0 then 'https://tickets.example/' || event_id || '?a=1&b=2' end",
    "readspeaker_url": "'https://app-eu.readspeaker.com/cgi-bin/rsent?id=1&lang=nl'",
    "gallery": IMG + " || '|https://fest.example/sites/styles/large/public/activity/image/b.jpg'",
}


@query("ext11_festival_details", "select " + ", ".join(f"{e} as {n}" for n, e in DETAIL.items()) + " from events")
def _(t: Tables):
    return flat(festival.parse_details(detail_pages(t), BASE, "2026-07", F.lit("2026-07-01T00:00:00Z")))


# --- whole runs ---------------------------------------------------------------------------------------------------------


@query("run_consolidation")
def _(t: Tables):
    """Raw records of all shapes merged into the stored events, deduplicated and enriched."""
    raw = {s: I.raw_events(t, s) for s in ("goabase", "beldub", "venue", "agenda")} | {"facebook": I.raw_social(t)}
    stored, _fresh = B.stored_and_fresh(t)
    done = chains.consolidate(raw, stored, I.dimensions(t), B.genres(t), E.geo_cache(t), E.two_tabs(t))
    return flat(done["events"].drop("overrides"))


def festival_parts(t: Tables) -> dict[str, DataFrame]:
    listing = listing_pages(t)
    nodes = chains.listed_nodes(listing)
    user = C("node_id").cast("int")
    name = F.when(user % 3 == 0, F.lit("Kouter - Kiosk")).otherwise(F.concat(F.lit("Plein "), "node_id"))
    details = nodes.select(
        F.concat(F.lit(BASE), "href").alias("url"),
        F.concat(
            F.lit("<h1>Act "), "node_id", F.lit('</h1><div class="location-name">'), name,
            F.lit('</div><div class="field field--name-address location-address"><div class="field__item">Kaai '), user % 3, F.lit(" "), user % 7, F.lit("</div></div>"),
        ).alias("html"),
    )
    cache = nodes.where(user % 3 == 1).select(
        F.concat(F.lit("Kaai "), user % 3, F.lit(" "), user % 7).alias("address"), F.lit(51.05).alias("lat"), F.lit(3.72).alias("lng")
    ).distinct()
    fixes = t.spark.createDataFrame(K.COORD_FIXES, "venue_key string, lat double, lng double, address string")
    return chains.festival_run(listing, details, fixes, cache, BASE, "2026-07", F.lit("2026-07-01"))


@query(
    "run_festival",
    "with n as (select user_id, min(day(ts)) as lo, max(day(ts)) as hi, arg_min(day(ts), (day(ts), event_id)) as d0 from events group by user_id), "
    "p as (select n.*, 'https://fest.example/nl/day/' || d0 || '/act-' || user_id as url from n) "
    "select cast(user_id as varchar) as node_id, url as detail_url, '2026-07-' || lpad(cast(lo as varchar), 2, '0') as date_start, "
    "case when hi > lo then '2026-07-' || lpad(cast(hi as varchar), 2, '0') end as end_date_start, "
    "case when user_id % 3 = 0 then 51.05018::double when user_id % 3 = 1 then 51.05::double end as lat, case when user_id % 3 = 0 then 'already' when user_id % 3 = 1 then 'filled' else 'todo' end as located from p",
)
def _(t: Tables):
    return festival_parts(t)["records"].select("node_id", "detail_url", "date_start", "end_date_start", "lat", "located")


@query(
    "run_festival_work_list",
    "with u as (select distinct user_id % 7 as k from events where user_id % 3 = 2) "
    "select 'Kaai 2 ' || k || ', Gent, Belgium' as query, 0 as rank from u union all select 'Kaai 2, Gent, Belgium', 1 from u group by 1",
)
def _(t: Tables):
    return festival_parts(t)["work_list"].select("query", "rank")


@query(
    "run_festival_counts",
    "select case user_id % 3 when 0 then 'already' when 1 then 'filled' else 'todo' end as located, count(distinct user_id) as n from events group by 1",
)
def _(t: Tables):
    return festival_parts(t)["counts"]


@query(
    "run_approved_pull",
    f"with {E.APPROVED_SQL}, f as (select {event_id(chr(39) + 'facebook' + chr(39), 'tt', 'date_start')} as event_id, row_no, nullif(n.venue, '') as venue, tt as title from n), "
    "l as (select event_id, arg_max(venue, row_no) as venue, arg_max(title, row_no) as title from f group by event_id), "
    f"s as (select event_id, title from ({I.DOC_SQL})) select event_id, title, case when venue is null then '' else venue end as venue from l union all select event_id, title, '' from s",
)
def _(t: Tables):
    stored = I.doc_events(t).drop("ord")
    done = chains.approved_pull(E.approved_tab(t), stored, I.dimensions(t))
    return done.select("event_id", "title", F.coalesce("venue", F.lit("")).alias("venue"))

