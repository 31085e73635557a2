"""Row predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.functions import text, urls


def is_active(status: str = "status") -> Column:
    return ~F.col(status).eqNullSafe("duplicate")


def is_future(as_of: str, column: str = "date_start") -> Column:
    return F.col(column) >= F.lit(as_of)


def is_word(c: Column, words: list[str]) -> Column:
    return F.lower(text.strip(c)).isin(words)


def is_approved(c: Column) -> Column:
    return is_word(c, K.APPROVED_WORDS)


def is_truthy(c: Column) -> Column:
    return is_word(c, K.TRUE_WORDS)


def effective(column: str) -> Column:
    """The human value if there is one, else the collected one."""
    return F.coalesce(F.col(f"overrides.{column}"), F.col(column))


def is_hidden() -> Column:
    return F.coalesce(F.col("overrides.hide"), F.lit(False))


def lacks_coordinates() -> Column:
    """No effective position: null or 0 on either axis."""
    missing = lambda c: F.coalesce(effective(c), F.lit(0.0)) == 0
    return missing("latitude") | missing("longitude")


def split_located(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(~lacks_coordinates()), df.where(lacks_coordinates())


def inside_or_unknown(lat: str, lng: str, box: tuple = K.COUNTRY_BOX) -> Column:
    """Inside the box; rows without coordinates stay."""
    low_lat, high_lat, low_lng, high_lng = box
    return (
        F.col(lat).isNull()
        | F.col(lng).isNull()
        | (F.col(lat).between(low_lat, high_lat) & F.col(lng).between(low_lng, high_lng))
    )


def within_lookahead(column: str, as_of: str, days: int = K.LOOKAHEAD_DAYS) -> Column:
    """Not past and at most `days` ahead."""
    day = F.try_to_date(F.col(column), "yyyy-MM-dd")
    first = F.lit(as_of).cast("date")
    return day.between(first, F.date_add(first, days))


def is_cancelled(status: Column) -> Column:
    return F.lower(F.coalesce(status, F.lit(""))) == "cancelled"


def is_placeholder(title: Column) -> Column:
    return title.rlike("(?i)^closed")


def is_hosted_elsewhere(name_pattern: str, *texts: Column) -> Column:
    """Another source lists the row: its name is in one of the texts."""
    found = F.lit(False)
    for t in texts:
        found = found | F.coalesce(t.rlike(rf"(?i){name_pattern}"), F.lit(False))
    return found


def is_listing_link(href: Column, base: str) -> Column:
    """A link of the site that can be an event page."""
    other_scheme = href.rlike("^(#|mailto:|tel:)") | (href == "")
    foreign = href.startswith("http") & ~href.startswith(base)
    page = urls.path(urls.absolute(base, href))
    return (
        ~other_scheme
        & ~foreign
        & ~href.rlike(K.SITE_PAGES)
        & ~href.rlike(K.REGISTRATION_PAGES)
        & ~F.coalesce(page.isin("", "/"), F.lit(True))
        & ~page.rlike(K.NON_EVENT_PATHS)
    )


def slug_of(href: Column, folder: str) -> Column:
    """Slug of '/<folder>/<slug>' links, null for other links."""
    return text.extract(href, rf"/{folder}/([a-z0-9_-]+)(?:[?#].*)?$")


def without_listed(df: DataFrame, key: str, deny: list[str]) -> DataFrame:
    return df.where(~F.col(key).isin(deny))
