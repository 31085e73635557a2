"""Registered queries: each has a name, a function of (spark, folder), and mostly an equal SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marquee.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def heavy(self, name: str) -> DataFrame:
        """A table for work that is heavy per row (whole texts and pages)."""
        return spread(self(name))


def query(name: str, sql: str | None = None):
    """Register a function of `Tables` under a name, with the SQL that gives the same rows."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# --- pieces of SQL for the checking engine ---------------------------------------------------------------


def norm(x: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents({x})), '[^a-z0-9_]+', ' ', 'g'))"


def hashable(x: str) -> str:
    return rf"(case when {norm(x)} = '' then lower(regexp_replace({x}, '^\s+|\s+$', '', 'g')) else {norm(x)} end)"


def event_id(source: str, title: str, date: str) -> str:
    return f"substr(sha1({source} || '|' || {hashable(title)} || '|' || {date}), 1, 16)"


def dedupe_key(title: str, date: str) -> str:
    return f"substr(sha1({hashable(title)} || '|' || {date}), 1, 12)"


def names(x: str, pattern: str = r",|\n|\s\+\s") -> str:
    parts = f"regexp_split_to_array(coalesce({x}, ''), '{pattern}')"
    trimmed = rf"list_transform({parts}, lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g'))"
    return f"list_filter({trimmed}, lambda s: s <> '')"


def bigrams(x: str) -> str:
    return f"list_transform(range(1, length({x})), lambda i: substr({x}, i, 2))"


def dice(a: str, b: str) -> str:
    """SQL for two columns that hold texts."""
    count = lambda x: f"len(list_filter({bigrams(x)}, lambda y: y = g))"
    shared = f"list_sum(list_transform(list_distinct({bigrams(a)}), lambda g: least({count(a)}, {count(b)})))"
    return (
        f"(case when {a} = {b} then 1.0 when length({a}) < 2 or length({b}) < 2 then 0.0 "
        f"else 2.0 * coalesce({shared}, 0) / (length({a}) + length({b}) - 2) end)::double"
    )


def portable(e: str) -> str:
    """An expression both engines read, but for the array constructor."""
    return e.replace("array(", "list_value(")


def select_list(columns: dict[str, str]) -> str:
    return ", ".join(f"{portable(e)} as {n}" for n, e in columns.items())


def computed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} as {n}" for n, e in columns.items()])
