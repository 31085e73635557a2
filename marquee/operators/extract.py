"""Records out of captured pages, calendar files and embedded JSON.

Everything works row by row on whole texts with JVM expressions: no shuffle but where rows of several
pages are grouped.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import constants as K
from marquee.functions import dates, records, text, urls
from marquee.functions.markup import inner_text, quoted, unescape
from marquee.functions.pages import of_class, of_label, paragraphs, parts
from marquee.functions.text import clean, extract, let, no_match_to_null, strip
from marquee.operators import aggregates
from marquee.operators.selection import first_per_key
from marquee.session import dealt

# --- markup ---------------------------------------------------------------------------------------------


def body_text(html: Column) -> Column:
    """Text of a page without scripts, styles and comments."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ")
    return clean(unescape(F.regexp_replace(bare, r"<[^>]*>", " ")))


def element_of_tag(html: Column, tag: str) -> Column:
    """Content of the first element of a tag."""
    return extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>")


def meta(html: Column, prop: str) -> Column:
    """`content` of a meta property, whichever way round the attributes stand."""
    p = prop.replace(".", r"\.")
    return let(
        quoted(html),
        lambda h: unescape(F.coalesce(
            extract(h, rf'(?i)<meta[^>]*property="{p}"[^>]*content="([^"]*)"'),
            extract(h, rf'(?i)<meta[^>]*content="([^"]*)"[^>]*property="{p}"'),
        )),
    )


def main_image(html: Column) -> Column:
    """og:image, else the first image of the main part."""
    in_main = unescape(extract(quoted(html), r'(?is)<(?:main|article)\b.*?<img[^>]*\bsrc="([^"]*)"'))
    return F.coalesce(meta(html, "og:image"), in_main)


def page_description(html: Column, limit: int = 800) -> Column:
    return no_match_to_null(text.truncate(strip(meta(html, "og:description")), limit))


def numbered_items(df: DataFrame, id: str, items: Column, alias: str) -> DataFrame:
    """(id, pos, item) for every element of an array.

    An outer explode: for a plain one Spark adds a filter that computes the array a second time.
    """
    return df.select(id, F.posexplode_outer(items).alias("pos", alias)).where(F.col("pos").isNotNull())


# --- links ------------------------------------------------------------------------------------------------

ANCHOR = r'(?is)<a\b[^>]*\bhref="([^"]*)"[^>]*>(.*?)</a>'


def links(pages: DataFrame, id: str = "page_id", html: str = "html") -> DataFrame:
    """(id, pos, href, label) for every link of a page, in order."""
    pairs = let(
        quoted(F.col(html)),
        lambda h: F.zip_with(
            F.regexp_extract_all(h, F.lit(ANCHOR), F.lit(1)), F.regexp_extract_all(h, F.lit(ANCHOR), F.lit(2)),
            lambda href, label: F.struct(href.alias("href"), label.alias("label")),
        ),
    )
    return numbered_items(pages, id, pairs, "l").select(
        id, "pos", unescape(F.col("l.href")).alias("href"), inner_text(F.col("l.label")).alias("label")
    )


def distinct_links(found: DataFrame, id: str, pattern: str) -> DataFrame:
    """Links that fit, without query, each once per page at its first place."""
    bare = found.withColumn("href", urls.strip_query(F.col("href"))).where(F.col("href").rlike(pattern))
    return bare.groupBy(id, "href").agg(F.min("pos").alias("pos"))


def node_days(found: DataFrame, pattern: str, day: str, order: Column) -> DataFrame:
    """Listing links to (node_id, href, first_day, last_day, days).

    pattern: group 1 of the link without query is the node id.
    """
    bare = urls.strip_query(F.col("href"))
    nodes = found.select(extract(bare, pattern).alias("node_id"), bare.alias("href"), F.col(day).alias("day"), order.alias("_at"))
    return aggregates.days_per_node(nodes.where(F.col("node_id").isNotNull()), "node_id", "day", "href", "_at")


def first_ticket_link(found: DataFrame, id: str, own_host: str, pattern: str = r"(?i)ticket|bestel|koop|buy|reserv") -> DataFrame:
    """The first link per page to another site whose address or label is about tickets."""
    outside = F.col("href").startswith("http") & ~F.contains("href", F.lit(own_host))
    fits = F.col("href").rlike(pattern) | F.col("label").rlike(pattern)
    return found.where(outside & fits).groupBy(id).agg(F.min_by("href", "pos").alias("ticket_url"))


# --- texts ----------------------------------------------------------------------------------------------------

# fixed values: parts of a page that hold no description
OUTSIDE = ("nav", "footer", "header")


def description(
    html: Column, min_length: int = 25, skip: str | None = None, stop: str | None = None, limit: int = 600
) -> Column:
    """Paragraphs after the heading that do not lie in `OUTSIDE`: short ones and those that fit `skip` are left out,
    the first that fits `stop` ends it, and so does passing the limit; cut to the limit."""
    found = F.transform(paragraphs(html, OUTSIDE), inner_text)
    if stop:
        # place of the first paragraph that ends the text
        until = lambda p, at: F.when(at > 0, F.slice(p, F.lit(1), F.greatest((at - 1).cast("int"), F.lit(0)))).otherwise(p)
        found = let(found, lambda p: until(p, F.array_position(F.transform(p, lambda x: x.rlike(stop)), True)))
    keep = lambda p: (F.length(p) >= min_length) & (~p.rlike(skip) if skip else F.lit(True))
    return text.join_until(F.filter(found, keep), limit)


def labelled_field(html: Column, label: str) -> Column:
    """Value next to a visible label, ignoring case; null if the label is not there."""
    return no_match_to_null(inner_text(F.get(parts(html, [(of_label(label), of_class("field__item"))]), F.lit(1))))


def blocks(pages: DataFrame, id: str, html: Column, separator: str) -> DataFrame:
    """One row per part of a page between separators; what comes before the first is left out."""
    return numbered_items(pages, id, F.split(html, separator, -1), "block").where(F.col("pos") >= 1)


# fixed values: patterns of dates and times in cards and free text
NL_CARD_DATE = r"(?i)\b(?:ma|di|wo|do|vr|za|zo)\s+(\d{1,2}\s+(?:jan|feb|mrt|apr|mei|jun|jul|aug|sep|okt|nov|dec))\b"
CARD_TIME = r"\b(\d{2}:\d{2})\b"
ANCHOR_LINE = r"^(\d{2}/\d{2}/\d{4})\s+at\s+(\d{2}:\d{2})"
DATE_LINE = r"^\d{2}/\d{2}/\d{4}"


def card_fields(card: Column, as_of: Column, date_pattern: str = NL_CARD_DATE, grace_days: int = 0) -> dict[str, Column]:
    """Card text 'TITLE do 11 jun 20:00 ROOM': title before the date, date, time, room after the time."""
    flat = clean(card)
    before = F.regexp_extract(flat, rf"(?s)^(.*?)(?:{date_pattern})", 1)
    date = extract(flat, date_pattern, 1)
    time = extract(flat, CARD_TIME)
    after = F.when(time.isNotNull(), strip(F.call_function("substring_index", flat, time, F.lit(-1))))
    return {
        "title": no_match_to_null(strip(F.when(before == "", flat).otherwise(before))),
        "date_start": dates.parse_day_month(date, as_of, grace_days),
        "hour_start": dates.parse_clock(time),
        "room": F.when((F.length(after) > 1) & (F.length(after) < 80), after),
    }


def events_in_text(df: DataFrame, id: str, content: str, n_lines: int = 3, limit: int = 500) -> DataFrame:
    """Free text lines: a 'dd/MM/yyyy at HH:mm' line is an event, the line before it the title, up to
    three lines after it, but not past the next date, the description.

    The lines of one text stay in its row as an array, so nothing is shuffled.
    """
    lines = F.filter(F.transform(F.split(content, "\n", -1), strip), lambda x: x != "")
    parts = text.let(
        lines,
        lambda all_lines: F.transform(
            all_lines,
            lambda line, i: F.struct(
                i.alias("pos"), line.alias("line"), F.get(all_lines, i - 1).alias("title"),
                F.slice(all_lines, i + 2, n_lines).alias("after"),
            ),
        ),
    )
    anchored = F.filter(parts, lambda p: p["line"].rlike(ANCHOR_LINE))
    found = df.select(id, F.explode_outer(anchored).alias("p")).select(id, "p.*")
    day = F.regexp_extract("line", ANCHOR_LINE, 1)
    iso = F.concat_ws("-", F.substring(day, 7, 4), F.substring(day, 4, 2), F.substring(day, 1, 2))
    stop = F.array_position(F.transform("after", lambda x: x.rlike(DATE_LINE)), True).cast("int")
    body = F.when(stop > 0, F.slice("after", F.lit(1), F.greatest(stop - 1, F.lit(0)))).otherwise(F.col("after"))
    return found.where(F.length("title") >= 2).select(
        id, "pos", "title", iso.alias("date_start"), F.regexp_extract("line", ANCHOR_LINE, 2).alias("hour_start"),
        no_match_to_null(text.truncate(F.array_join(body, " "), limit)).alias("description"),
    )


def once_per_event(df: DataFrame, scope: list[str], order: Column) -> DataFrame:
    """Within a source an event is known by its link, else by title and date; the first row stays."""
    key = F.coalesce(F.nullif(F.col("source_url"), F.lit("")), F.concat_ws("|", "title", "date_start"))
    return first_per_key(df.withColumn("_seen", key), [*scope, "_seen"], order).drop("_seen")


def list_then_detail(listing: DataFrame, detail: DataFrame, key: str, detail_first: list[str], list_first: list[str]) -> DataFrame:
    """Columns both sides have, each with its own precedence."""
    fields = [*detail_first, *list_first]
    d = detail.select(key, F.struct(*fields).alias("_d"))
    joined = listing.join(d, key, "left")
    chosen = {c: F.coalesce(F.col(f"_d.{c}"), F.col(c)) for c in detail_first}
    chosen |= {c: F.coalesce(F.col(c), F.col(f"_d.{c}")) for c in list_first}
    return joined.withColumns(chosen).drop("_d")


# --- script payloads ---------------------------------------------------------------------------------------------


def call_argument(c: Column, call: str = "replaceWith") -> Column:
    """HTML in a script call `replaceWith('...')`, with the string escapes read; null without the call."""
    raw = extract(c, rf"(?s){call}\('(.*)'\)")
    quoted = F.concat(F.lit('"'), F.regexp_replace(F.replace(raw, F.lit("\\'"), F.lit("'")), r'(?<!\\)"', r'\\"'), F.lit('"'))
    parsed = F.try_variant_get(F.try_parse_json(quoted), "$", "string")
    return F.coalesce(parsed, F.replace(raw, F.lit("\\"), F.lit("")))


SCRIPT_JSON = r'(?is)<script[^>]*type="application/(?:json|ld\+json)"[^>]*>(.*?)</script>'


def embedded_json(pages: DataFrame, id: str, html: str = "html") -> DataFrame:
    """(id, pos, blob, v) for every JSON script of a page that can be read, as text and as variant."""
    found = numbered_items(pages, id, F.regexp_extract_all(html, F.lit(SCRIPT_JSON), 1), "blob")
    return found.withColumn("v", F.try_parse_json("blob")).where(F.col("v").isNotNull())


def json_events(df: DataFrame, id: str, blob: str, as_of: Column, site: str, list_url: str) -> DataFrame:
    """Records of the event array in a JSON text, with the field names the known APIs use.

    A record links to its page on `site`, one without an id to `list_url`.
    """
    # no filter on the array: Spark would compute it once more for that, ahead of a shuffle that deals the rows
    rows = numbered_items(df, id, records.event_array(F.col(blob)), "record").withColumn("v", records.parse(F.col("record")))
    first = lambda keys: records.first_key(F.col("v"), keys)
    read = rows.select(
        id, "pos", "v", "record",
        strip(first(K.NAME_KEYS)).alias("title"), first(K.DATE_KEYS).alias("_day"), first(K.START_TIME_KEYS).alias("_time"),
        no_match_to_null(first(K.ID_KEYS)).alias("_id"), first(K.IMAGE_KEYS).alias("_image"),
    )
    return read.select(
        id, "pos", "title",
        dates.parse_any_date(F.col("_day"), as_of).alias("date_start"),
        dates.parse_clock(F.coalesce("_time", "_day")).alias("hour_start"),
        dates.parse_clock(first(K.END_TIME_KEYS)).alias("hour_end"),
        F.coalesce(F.concat(F.lit(f"{site}/#/events/"), F.nullif("_id", F.lit("0"))), F.lit(list_url)).alias("source_url"),
        no_match_to_null(text.truncate(first(K.DESCRIPTION_KEYS), 500)).alias("description"),
        records.price(F.col("v")).alias("price"),
        F.when(F.col("_image").rlike("^https?:"), F.col("_image")).alias("image_url"),
        records.ticket_url(F.col("record")).alias("ticket_url"),
    ).where((F.col("title") != "") & F.col("date_start").isNotNull())


# fixed values: where the known sites keep the start and the end of an event
START_PATHS = ("$.scheduling.config.startDate", "$.scheduling.startDate", "$.startDate", "$.start")
END_PATHS = ("$.scheduling.config.endDate", "$.scheduling.endDate", "$.endDate")


def _first_of(v: Column, paths: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.try_variant_get(v, p, "string") for p in paths])


DEPTH = 12


def _start_of(node: dict):
    for path in START_PATHS:
        at = node
        for key in path[2:].split("."):
            at = at.get(key) if isinstance(at, dict) else None
        if at is not None:
            return at
    return None


def _is_event(node: dict) -> bool:
    title = node.get("title")
    return isinstance(title, str) and len(title.strip()) > 1 and re.match(r"\d{4}-\d{2}-\d{2}", str(_start_of(node) or "")) is not None


def _events_below(text: str | None) -> list[str]:
    """Places from the top and JSON text of the events in a JSON text, in the order they are written in."""
    try:
        waiting, found = [((), json.loads(text or "null"))], []
    except (ValueError, RecursionError):
        return []
    while waiting:
        path, node = waiting.pop()
        if isinstance(node, dict) and _is_event(node):
            found.append(f"{','.join(map(str, path))} {json.dumps(node, ensure_ascii=False)}")
        elif isinstance(node, (dict, list)) and len(path) < DEPTH:
            below = list(node.values() if isinstance(node, dict) else node)
            waiting += [((*path, i), below[i]) for i in range(len(below) - 1, -1, -1)]
    return found


def nested_events(df: DataFrame, keys: list[str], blob: str) -> DataFrame:
    """All objects with a title and an ISO start date in JSON texts: keys, path (places from the top), v.

    One walk through each text, members in the order they are written in; what is an event is not opened.
    """

    def walk(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(_events_below)

    found = numbered_items(df.withColumn("_key", F.struct(*keys)), "_key", F.pandas_udf(walk, "array<string>")(F.col(blob)), "e")
    places = F.substring_index("e", " ", 1)
    path = F.when(places == "", F.array().cast("array<int>")).otherwise(F.split(places, ",").cast("array<int>"))
    v = F.try_parse_json(F.substring("e", F.length(places) + 2, F.lit(2147483647)))
    return found.select(*[F.col(f"_key.{k}").alias(k) for k in keys], path.alias("path"), v.alias("v"))


LD_PRICE = "$.offers.price"


def structured_events(pages: DataFrame, id: str, html: str = "html", site: str | None = None) -> DataFrame:
    """Events from the JSON scripts of pages: objects with title and start, and schema.org events.

    With `site`, an event without a link gets one from its slug.
    """
    blobs = embedded_json(pages, id, html)
    deep = nested_events(blobs, [id, "pos"], "blob")
    get = lambda path: F.try_variant_get("v", f"$.{path}", "string")
    start, end = _first_of(F.col("v"), START_PATHS), _first_of(F.col("v"), END_PATHS)
    slug = F.concat(F.lit(f"{site}/event-details/"), get("slug")) if site else F.lit(None).cast("string")
    from_walk = deep.select(
        id, "pos", F.lit(0).alias("kind"), F.col("path").alias("n"), strip(get("title")).alias("title"),
        dates.iso_date(start).alias("date_start"), dates.iso_time(start).alias("hour_start"), dates.iso_time(end).alias("hour_end"),
        get("description").alias("description"), F.coalesce(get("url"), slug).alias("source_url"),
        F.coalesce(get("registration.ticketing.lowestPrice.amount"), get("offers.price")).alias("amount"),
        get("registration.external.registration").alias("ticket_url"),
        F.coalesce(get("mainImage.url"), get("mainImage.id"), get("image")).alias("image"),
    )
    many = F.expr("coalesce(try_variant_get(v, '$', 'array<variant>'), array(v))")
    ld = blobs.select(id, "pos", F.posexplode(many).alias("n", "o"))
    of = lambda path: F.try_variant_get("o", path, "string")
    from_ld = ld.where((of("$['@type']") == "Event") & of("$.name").isNotNull() & of("$.startDate").isNotNull()).select(
        id, "pos", F.lit(1).alias("kind"), F.array("n").alias("n"), strip(of("$.name")).alias("title"),
        dates.iso_date(of("$.startDate")).alias("date_start"), dates.iso_time(of("$.startDate")).alias("hour_start"),
        dates.iso_time(of("$.endDate")).alias("hour_end"),
        of("$.description").alias("description"), of("$.url").alias("source_url"), of(LD_PRICE).alias("amount"),
        F.lit(None).cast("string").alias("ticket_url"), of("$.image").alias("image"),
    )
    found = from_walk.unionByName(from_ld).where(F.col("date_start").isNotNull() & (F.col("title") != ""))
    order = F.struct("pos", "kind", "n")
    return first_per_key(found, [id, "title", "date_start"], order).select(
        id, "title", "date_start", "hour_start", "hour_end", text.truncate(F.col("description"), 800).alias("description"),
        "source_url", F.concat(F.lit("€ "), "amount").alias("price"), "ticket_url",
        F.when(F.col("image").startswith("http"), F.col("image")).alias("image_url"),
    )


# --- calendars ----------------------------------------------------------------------------------------------------------


def _unescape_calendar(c: Column) -> Column:
    # an escaped backslash is set aside first, so that '\\\\n' is not read as a line end
    hold = "\u0000"
    c = F.replace(c, F.lit("\\\\"), F.lit(hold))
    c = F.regexp_replace(c, r"\\[nN]", "\n")
    c = F.regexp_replace(c, r"\\([,;])", "$1")
    return F.replace(c, F.lit(hold), F.lit("\\"))


def calendar_events(files: DataFrame, id: str, ics: str, min_date: str | None = None, zone: str = K.LOCAL_ZONE) -> DataFrame:
    """iCal text to events. Of a property that is given twice the last counts.

    A UTC time is moved to local time; a time with a zone of its own is local already.
    """
    cut = F.regexp_replace(F.col("block"), r"(?s)END:VEVENT.*$", "")
    unfolded = F.regexp_replace(cut, r"\r?\n[ \t]", "")
    found = numbered_items(dealt(files), id, F.split(ics, "BEGIN:VEVENT", -1), "block").where(F.col("pos") >= 1)
    rows = found.select(id, "pos", unfolded.alias("text"))

    # one column per property: the value of its last line
    def last_line(key: str) -> Column:
        values = F.regexp_extract_all("text", F.lit(rf"(?im)^{key}(?:;[^:\r\n]*)?:([^\r\n]*)"), 1)
        return strip(F.try_element_at(values, F.lit(-1)))

    keys = ["SUMMARY", "DTSTART", "DTEND", "URL", "DESCRIPTION", "LOCATION"]
    rows = rows.select(id, "pos", *[last_line(k).alias(k) for k in keys])
    prop = lambda key: _unescape_calendar(F.col(key))

    def moment(key: str) -> Column:
        value = F.col(key)
        parts = r"^(\d{4})(\d{2})(\d{2})(?:T(\d{2})(\d{2})(\d{2})?(Z)?)?"
        part = lambda i: F.regexp_extract(value, parts, i)
        day = F.concat_ws("-", part(1), part(2), part(3))
        clock = F.concat(part(4), F.lit(":"), part(5))
        utc = F.concat(day, F.lit("T"), clock, F.lit(":00Z"))
        is_utc = part(7) == "Z"
        return F.when(
            value.rlike(parts),
            F.struct(
                F.when(is_utc, dates.local_date(utc, zone)).otherwise(day).alias("date"),
                F.when(is_utc, dates.local_time(utc, zone)).when(part(4) != "", clock).alias("time"),
            ),
        )

    events = rows.select(
        id, "pos",
        strip(prop("SUMMARY")).alias("title"),
        moment("DTSTART").alias("_s"), moment("DTEND").alias("_e"),
        prop("URL").alias("source_url"),
        no_match_to_null(strip(prop("DESCRIPTION"))).alias("description"),
        no_match_to_null(strip(prop("LOCATION"))).alias("location_raw"),
    ).where((F.col("title") != "") & F.col("_s.date").isNotNull())
    out = events.select(
        id, "pos", "title", F.col("_s.date").alias("date_start"), F.col("_s.time").alias("hour_start"),
        F.col("_e.time").alias("hour_end"), "source_url", "description", "location_raw",
    )
    return out.where(F.col("date_start") >= min_date) if min_date else out


# --- extractors in Python ---------------------------------------------------------------------------------------------------


MOST_ROWS = 2000


def run_extractor(
    pages: DataFrame, id: str, content: str, extractor: Callable[[str], list[dict]], schema: str
) -> DataFrame:
    """Rows an extractor yields per page. A page it fails on gives one row with `_error`; others go on.

    schema: the extractor's columns. Runs batch by batch in the tasks that hold the pages.
    """
    key_type = pages.schema[id].dataType.simpleString()
    names = [f.name for f in T.StructType.fromDDL(schema)]

    def over_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, value in zip(batch[id], batch[content]):
                try:
                    out += [[key, None, *[row.get(n) for n in names]] for row in extractor(value)]
                except Exception as e:
                    out.append([key, f"{type(e).__name__}: {e}", *[None] * len(names)])
                if len(out) >= MOST_ROWS:  # a task holds the rows of few pages
                    yield pd.DataFrame(out, columns=[id, "_error", *names])
                    out = []
            yield pd.DataFrame(out, columns=[id, "_error", *names])

    return pages.select(id, content).mapInPandas(over_batches, f"{id} {key_type}, _error string, {schema}")


def register_extractor(spark: SparkSession, name: str, extractor: Callable[[str], list[dict]], schema: str) -> None:
    """Make an extractor a table function of SQL: `from pages, lateral <name>(html)`.

    Its rows have `_error` and the columns of the schema, as in `run_extractor`; batches go to Python as Arrow.
    """
    names = [f.name for f in T.StructType.fromDDL(schema)]

    class Extractor:
        def eval(self, content: str):
            try:
                rows = [(None, *[row.get(n) for n in names]) for row in extractor(content)]
            except Exception as e:
                rows = [(f"{type(e).__name__}: {e}", *[None] * len(names))]
            yield from rows

    spark.udtf.register(name, F.udtf(Extractor, returnType=f"_error string, {schema}", useArrow=True))
