"""Aggregations. All are combined on the map side; none collects an unbounded group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import numbers


def is_filled(df: DataFrame, name: str) -> Column:
    """Not null, and not '' or an empty array."""
    c = F.col(f"`{name}`")
    kind = df.schema[name].dataType
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    if isinstance(kind, T.StringType):
        return F.coalesce(c != "", F.lit(False))
    return c.isNotNull()


def filled_count(df: DataFrame, columns: list[str] | None = None) -> Column:
    """How many fields of the row hold a value."""
    total = F.lit(0)
    for name in columns or df.columns:
        total = total + is_filled(df, name).cast("int")
    return total


def days_per_node(links: DataFrame, node: str, day: str, url: str, pos: str) -> DataFrame:
    """First and last day a node is listed on, number of days, and its first link.

    The last day is null when there is only one.
    """
    days = links.groupBy(node).agg(
        F.min(day).alias("first_day"),
        F.max(day).alias("max_day"),
        F.min_by(url, pos).alias(url),
        F.sort_array(F.collect_set(day)).alias("days"),
    )
    return days.withColumn(
        "last_day", F.when(F.col("max_day") > F.col("first_day"), F.col("max_day"))
    ).drop("max_day")


def price_range_per(df: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """'€low-high' over the positive amounts of each key."""
    usable = F.when(~F.isnan(amount) & (F.col(amount) > 0) & (F.col(amount) != float("inf")), F.col(amount))
    ends = df.groupBy(*keys).agg(F.min(usable).alias("_low"), F.max(usable).alias("_high"))
    return ends.withColumn("price", numbers.price_range(F.col("_low"), F.col("_high"))).drop("_low", "_high")


def fill_profile(df: DataFrame, by: str, fields: list[str]) -> DataFrame:
    """Rows and filled fields per group, with one total row (group null)."""
    measures = [F.count(F.lit(1)).alias("n_rows")]
    for f in fields:
        measures.append(F.count_if(is_filled(df, f)).alias(f"n_{f}"))
    return df.rollup(by).agg(*measures)


def nonzero_count(column: str) -> Column:
    c = F.col(column)
    return F.count_if(c.isNotNull() & (c != 0))


def coverage(df: DataFrame, *columns: str) -> DataFrame:
    """Share of rows where each column is set, in whole percent, and the counts."""
    counts = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        counts.append(F.count(c).alias(f"with_{c}"))
        counts.append(F.round(100 * F.avg(F.col(c).isNotNull().cast("int"))).cast("long").alias(f"pct_{c}"))
    return df.agg(*counts)


def action_counts(df: DataFrame, action: str = "action") -> DataFrame:
    return df.groupBy(action).agg(F.count(F.lit(1)).alias("n"))


def subgenre_counts(genres: DataFrame) -> DataFrame:
    """Per super-genre: number of subgenres and of keywords plus aliases below it."""
    n_terms = F.size("keywords") + F.size("aliases")
    return (
        genres.where(F.col("parent").isNotNull())
        .groupBy("parent")
        .agg(F.count(F.lit(1)).alias("n_subs"), F.sum(n_terms).cast("long").alias("n_terms"))
    )
