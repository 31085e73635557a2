"""Pick rows or values per key.

All picks are aggregations (`min_by`, `max_by`): Spark combines them on the map side, so a key that
holds a third of the rows costs one row per map task and no single task sorts it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def first_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The whole row that comes first in `order`."""
    picked = df.groupBy(*keys).agg(F.min_by(_row(df), F.struct(*order)).alias("_row"))
    return picked.select("_row.*")


def last_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    picked = df.groupBy(*keys).agg(F.max_by(_row(df), F.struct(*order)).alias("_row"))
    return picked.select("_row.*")


def last_filled(c: Column, order: Column) -> Column:
    """Aggregate: the last value that is not null."""
    return F.max_by(c, F.when(c.isNotNull(), order))


def first_filled(c: Column, order: Column) -> Column:
    """Aggregate: the first value that is not null."""
    return F.min_by(c, F.when(c.isNotNull(), order))


def first_nonempty(c: Column, order: Column) -> Column:
    """Aggregate: the first array with elements."""
    return F.min_by(c, F.when(F.size(c) > 0, order))


def last_nonempty(c: Column, order: Column) -> Column:
    return F.max_by(c, F.when(F.size(c) > 0, order))


def longest_per_key(df: DataFrame, keys: list[str], value: str, order: Column) -> DataFrame:
    """The longest text; of equally long ones the first."""
    rank = F.struct(-F.length(value), order)
    return df.groupBy(*keys).agg(F.min_by(value, rank).alias(value))


def numbered(df: DataFrame, keys: list[str], position: str, alias: str, width: int = 1_000_000) -> DataFrame:
    """Row number per key in the order of `position`, a whole number that is unique per key.

    A key is cut into ranges of `width` positions, so one window never holds more than `width` rows,
    however hot the key is. The count of the ranges before is added.
    """
    from pyspark.sql import Window

    part = F.floor(F.col(position) / width)
    cut = df.withColumn("_part", part)
    sizes = cut.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    inside = Window.partitionBy(*keys, "_part").orderBy(position)
    return (
        cut.withColumn("_in_part", F.row_number().over(inside))
        .join(offsets, [*keys, "_part"])
        .withColumn(alias, F.col("_in_part") + F.col("_before"))
        .drop("_in_part", "_before", "_part")
    )


def carried_forward(
    df: DataFrame, keys: list[str], position: str, value: str, alias: str, width: int = 1_000_000
) -> DataFrame:
    """Last non-null `value` up to each row, per key in the order of `position` (unique per key).

    Cut into ranges as in `numbered`; the value is carried over the ranges by a window on one row
    per range.
    """
    from pyspark.sql import Window

    cut = df.withColumn("_part", F.floor(F.col(position) / width))
    ends = cut.groupBy(*keys, "_part").agg(last_filled(F.col(value), F.col(position)).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).drop("_end")
    inside = (
        Window.partitionBy(*keys, "_part").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        cut.withColumn("_own", F.last(value, ignorenulls=True).over(inside))
        .join(carried, [*keys, "_part"])
        .withColumn(alias, F.coalesce("_own", "_carried"))
        .drop("_own", "_carried", "_part")
    )
