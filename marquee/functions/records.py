"""Expressions over free-form JSON records (variant columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.functions.text import let


def parse(text: Column) -> Column:
    return F.try_parse_json(text)


def value(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, f"$.{path}", kind)


def first_key(v: Column, keys: list[str], kind: str = "string") -> Column:
    """Value of the first key that is present and not null."""
    return F.coalesce(*[value(v, k, kind) for k in keys])


def members(record: Column) -> Column:
    """Key, text and kind of the members of a JSON object given as text, in the order they are written in.

    A variant keeps members by name; a map read from the text keeps their order. Objects and arrays are texts in JSON.
    """
    entries = lambda text, kinds: F.transform(
        F.map_entries(text), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("text"), F.schema_of_variant(kinds[e["key"]]).alias("kind"))
    )
    both = F.struct(F.from_json(record, "map<string,string>").alias("m"), F.try_variant_get(parse(record), "$", "map<string,variant>").alias("v"))
    return let(both, lambda b: F.when(b["v"].isNotNull(), entries(b["m"], b["v"])))


def ticket_url(record: Column) -> Column:
    """Of a record given as text: known ticket keys first, then member by member, as written, any text, or text one
    level down, that looks like a ticket link."""
    direct = let(parse(record), lambda v: first_key(v, K.TICKET_KEYS))  # parsed once, not once for each key
    texts = lambda m: F.transform(F.filter(m, lambda e: e["kind"] == "STRING"), lambda e: e["text"])
    own = lambda e: F.when(e["kind"].startswith("OBJECT"), F.coalesce(texts(members(e["text"])), F.array().cast("array<string>"))).otherwise(F.array(e["text"]))
    fits = lambda x: x.startswith("http") & x.rlike(K.TICKET_WORDS)
    found = F.get(F.filter(F.flatten(F.transform(members(record), own)), fits), F.lit(0))
    return let(direct, lambda d: F.when(d.startswith("http"), d).otherwise(found))


def is_event(v: Column, names=tuple(K.NAME_KEYS), dates=tuple(K.DATE_KEYS)) -> Column:
    """An object with a name and a date key."""
    return first_key(v, list(names), "variant").isNotNull() & first_key(v, list(dates), "variant").isNotNull()


def event_array(text: Column) -> Column:
    """The event records of a JSON text, each as text: the value itself, a known key, or a known key under data."""
    places = ["", *[f".{k}" for k in K.LIST_KEYS], *[f".data.{k}" for k in K.NESTED_LIST_KEYS]]

    def first_place(v: Column) -> Column:
        looks = lambda p: let(F.try_variant_get(v, f"${p}[0]", "variant"), lambda x: is_event(x))
        return F.coalesce(*[F.when(looks(p), F.get_json_object(text, f"${p}")) for p in places])

    return F.from_json(let(parse(text), first_place), "array<string>")


def price(v: Column) -> Column:
    """A number with its currency and two places; other values as text."""
    kind = F.schema_of_variant(value(v, "price", "variant"))
    number = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)")
    return F.when(number, F.format_string("EUR%.2f", value(v, "price", "double"))).otherwise(value(v, "price"))
