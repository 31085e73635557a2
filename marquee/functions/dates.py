"""Date and clock expressions. Dates are 'yyyy-MM-dd' strings, clock times 'HH:mm'.

`as_of` is always an argument, so results do not depend on the day of the run.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.functions.text import WHITE, extract, strip


def month_number(name: Column) -> Column:
    """Dutch and English month names, full or short; null for any other word."""
    table = F.str_to_map(F.lit(",".join(f"{w}:{n}" for w, n in K.MONTHS.items())))
    return F.try_element_at(table, F.lower(name)).cast("int")


def _iso(year: Column, month: Column, day: Column) -> Column:
    """A real calendar day as text, null for 31 February and the like."""
    parts = [x.cast("int").cast("string") for x in (year, month, day)]
    return F.date_format(F.try_to_date(F.concat_ws("-", *parts), "y-M-d"), "yyyy-MM-dd")


def utc_to_local(instant: Column, zone: str = K.LOCAL_ZONE) -> Column:
    """ISO instant text to local wall-clock time, aware of summer time; null if unreadable."""
    return F.convert_timezone(
        F.current_timezone(), F.lit(zone), F.try_to_timestamp(instant).cast("timestamp_ntz")
    )


def local_date(instant: Column, zone: str = K.LOCAL_ZONE) -> Column:
    return F.date_format(utc_to_local(instant, zone), "yyyy-MM-dd")


def local_time(instant: Column, zone: str = K.LOCAL_ZONE) -> Column:
    return F.date_format(utc_to_local(instant, zone), "HH:mm")


def infer_year(day: Column, month: Column, as_of: Column, grace_days: int) -> Column:
    """Day and month without a year: this year, or next year if too far in the past."""
    this_year = _iso(F.year(as_of), month, day)
    late = F.to_date(this_year) < F.date_sub(as_of, grace_days)
    return F.when(late, _iso(F.year(as_of) + 1, month, day)).otherwise(this_year)


DAY_MONTH = r"(?i)\b(\d{1,2})\s+([a-z]{3,})\b(?:\s+(\d{4})\b)?"
NUMERIC_DMY = r"\b(\d{1,2})[/.\-](\d{1,2})[/.\-](\d{4})\b"


def parse_day_month(c: Column, as_of: Column, grace_days: int) -> Column:
    """'vr 12 juni', '12 jun 2026', 'VR 12 JUN', '12/06/2026'."""
    day = extract(c, DAY_MONTH, 1)
    month = month_number(extract(c, DAY_MONTH, 2))
    year = extract(c, DAY_MONTH, 3)
    written = F.when(year.isNotNull(), _iso(year, month, day)).otherwise(
        infer_year(day, month, as_of, grace_days)
    )
    numeric = _iso(extract(c, NUMERIC_DMY, 3), extract(c, NUMERIC_DMY, 2), extract(c, NUMERIC_DMY, 1))
    return F.coalesce(written, numeric)


def iso_date(c: Column) -> Column:
    """Leading yyyy-MM-dd."""
    return extract(c, r"^(\d{4}-\d{2}-\d{2})")


def iso_time(c: Column) -> Column:
    """HH:mm after a T."""
    return extract(c, r"T(\d{2}:\d{2})")


def epoch_date(c: Column) -> Column:
    """Epoch seconds or milliseconds as text to a UTC day."""
    n = F.when(strip(c).rlike(r"^\d{1,18}(\.\d+)?$"), strip(c)).try_cast("double")
    seconds = F.when(n > 1e12, n / 1000).when(n > 1e9, n)
    day = F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))
    return F.date_format(day, "yyyy-MM-dd")


MONTH_DAY_YEAR = r"(?i)([a-z]+)\s+(\d{1,2}),?\s+(\d{4})"
DAY_MONTH_ANY = r"(?i)(\d{1,2})\s+([a-z]+)(?:\s+(\d{4}))?"
LEADING_DMY = r"^(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{4})"


def _padded(year: Column, month: Column, day: Column) -> Column:
    """Text put together as written, without a calendar check."""
    pad = lambda x: F.lpad(x.cast("int").cast("string"), 2, "0")
    return F.concat(year.cast("string"), F.lit("-"), pad(month), F.lit("-"), pad(day))


def parse_any_date(c: Column, as_of: Column) -> Column:
    """ISO, epoch, 'D Month Y', 'Month D Y', 'D/M/Y', the first that fits."""
    s = strip(c)
    dmy_month = month_number(extract(s, DAY_MONTH_ANY, 2))
    dmy_year = F.coalesce(extract(s, DAY_MONTH_ANY, 3), F.year(as_of).cast("string"))
    mdy_month = month_number(extract(s, MONTH_DAY_YEAR, 1))
    return F.coalesce(
        iso_date(s),
        epoch_date(s),
        _padded(dmy_year, dmy_month, extract(s, DAY_MONTH_ANY, 1)),
        _padded(extract(s, MONTH_DAY_YEAR, 3), mdy_month, extract(s, MONTH_DAY_YEAR, 2)),
        _padded(extract(s, LEADING_DMY, 3), extract(s, LEADING_DMY, 2), extract(s, LEADING_DMY, 1)),
    )


DOT_DATE = r"(\d{1,2})[.\s]+(\d{1,2})[.\s]+(\d{2,4})"


def parse_dot_date(c: Column) -> Column:
    """'12. 06. 26' or '12.06.2026'."""
    year = extract(c, DOT_DATE, 3)
    full = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
    return F.coalesce(iso_date(c), _iso(full, extract(c, DOT_DATE, 2), extract(c, DOT_DATE, 1)))


AM_PM = rf"(?i)(\d{{1,2}}):(\d{{2}}){WHITE}*(AM|PM)"
HOUR_MINUTE = r"(?i)(?<!\d)(\d{1,2})[h:.u](\d{2})(?!\d)"
HOUR_ONLY = r"(?i)\b(\d{1,2})[hu]\b"


def _clock(hour: Column, minute: Column) -> Column:
    return F.concat(F.lpad(hour.cast("int").cast("string"), 2, "0"), F.lit(":"), minute)


def parse_clock(c: Column) -> Column:
    """'20:30', '20h30', '20.30u', '20u', '8:30 PM' to HH:mm; null if there is none."""
    hour = extract(c, AM_PM, 1).cast("int")
    half = F.upper(extract(c, AM_PM, 3))
    hour24 = (
        F.when((half == "PM") & (hour < 12), hour + 12)
        .when((half == "AM") & (hour == 12), F.lit(0))
        .otherwise(hour)
    )
    return F.coalesce(
        _clock(hour24, extract(c, AM_PM, 2)),
        _clock(extract(c, HOUR_MINUTE, 1), extract(c, HOUR_MINUTE, 2)),
        _clock(extract(c, HOUR_ONLY, 1), F.lit("00")),
    )


SHOWTIME = r"(?i)(\d{1,2})[.:hu](\d{2})"


def parse_showtime(c: Column) -> Column:
    """'10.00 u.' or '20:30' to HH:mm."""
    return _clock(extract(c, SHOWTIME, 1), extract(c, SHOWTIME, 2))


CLOCK_RANGE = r"\b\d{1,2}[:h]\d{2}\s*[\-–>]+\s*(\d{1,2})[:h](\d{2})\b"
LABELLED_CLOCK = r"(?i)(?:deuren|doors|aanvang|start)\D{0,12}(\d{1,2})[:.](\d{2})"
ANY_CLOCK = r"\b(\d{2}):(\d{2})\b"


def clock_range_end(c: Column) -> Column:
    """'20:00 - 23:00' gives '23:00'."""
    return _clock(extract(c, CLOCK_RANGE, 1), extract(c, CLOCK_RANGE, 2))


def labelled_clock(c: Column) -> Column:
    """The time after doors/start, else the first HH:mm."""
    return F.coalesce(
        _clock(extract(c, LABELLED_CLOCK, 1), extract(c, LABELLED_CLOCK, 2)),
        _clock(extract(c, ANY_CLOCK, 1), extract(c, ANY_CLOCK, 2)),
    )


def date_from_path(url: Column) -> Column:
    """'…/2026/06/12' at the end, or '/2026-06-13-slug'."""
    path = r"(\d{4})/(\d{2})/(\d{2})$"
    day = F.concat_ws("-", *[extract(strip(url), path, i) for i in (1, 2, 3)])
    return F.coalesce(F.when(strip(url).rlike(path), day), extract(url, r"/(\d{4}-\d{2}-\d{2})-[A-Za-z0-9-]+"))


def date_from_slug(url: Column) -> Column:
    """'some-name-20-06-26' gives 2026-06-20."""
    tail = r"-(\d{2})-(\d{2})-(\d{2})$"
    part = lambda i: extract(url, tail, i)
    return F.concat(F.lit("20"), part(3), F.lit("-"), part(2), F.lit("-"), part(1))


DATE_RANGE = r"(\d{1,2})[.]\s*(\d{2})\s*[>]\s*(\d{1,2})[.]\s*(\d{2})[.]\s*(\d{2,4})"


def range_start(c: Column) -> Column:
    """'04. 07 > 26. 07. 26': the first day, with the year of the last; single dates pass."""
    joined = F.concat_ws(". ", extract(c, DATE_RANGE, 1), extract(c, DATE_RANGE, 2), extract(c, DATE_RANGE, 5))
    return F.when(c.rlike(DATE_RANGE), parse_dot_date(joined)).otherwise(parse_dot_date(c))
