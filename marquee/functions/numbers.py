"""Number and price expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.functions.text import extract, no_match_to_null, strip

_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
_NUMBER_HEAD = r"^([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"


def parse_number(c: Column) -> Column:
    """The whole cell must be a number; anything else is null."""
    t = strip(c)
    return F.when(t.rlike(_NUMBER), t).try_cast("double")


def parse_integer(c: Column) -> Column:
    """Number cut toward zero."""
    n = parse_number(c)
    return F.when(n >= 0, F.floor(n)).otherwise(F.ceil(n)).cast("long")


def parse_leading_number(c: Column) -> Column:
    """The number the cell starts with ('12.5 km' gives 12.5), else null."""
    return extract(strip(c), _NUMBER_HEAD).try_cast("double")


def price(c: Column, layout: str = "euro") -> Column:
    """Price text as written, by one of the known layouts; null if there is none."""
    return no_match_to_null(strip(F.regexp_extract(c, K.PRICE_PATTERNS[layout], 0)))


def price_or_free(c: Column, layout: str = "euro") -> Column:
    return F.coalesce(price(c, layout), F.when(c.rlike(r"(?i)\bgratis\b"), F.lit("gratis")))


def euro_words(c: Column) -> Column:
    """'| 12 euro' and '€ 12' both give a text that starts with '€ '."""
    amount = F.coalesce(
        extract(c, K.PRICE_PATTERNS["word"], 1), extract(c, K.PRICE_PATTERNS["word"], 2)
    )
    return F.concat(F.lit("€ "), strip(amount))


def valid_coordinate(c: Column) -> Column:
    """Null unless finite and not zero."""
    bad = F.isnan(c) | (F.abs(c) == float("inf")) | (c == 0)
    return F.when(~bad, c)


def number_text(c: Column) -> Column:
    """A double as written by hand: 1 instead of 1.0."""
    return F.regexp_replace(c.cast("string"), r"\.0$", "")


def amount_text(c: Column) -> Column:
    """Two decimals, '.00' dropped, decimal comma."""
    # `format_string` writes a null as text
    fixed = F.when(c.isNotNull(), F.format_string("%.2f", c))
    return F.replace(F.regexp_replace(fixed, r"\.00$", ""), F.lit("."), F.lit(","))


def price_range(low: Column, high: Column) -> Column:
    """'€5' or '€5-7,50'; null without amounts."""
    single = F.concat(F.lit("€"), amount_text(low))
    both = F.concat(single, F.lit("-"), amount_text(high))
    return F.when(low == high, single).otherwise(both)
