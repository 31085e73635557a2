"""Joins that are more than one `join` call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.functions import text
from marquee.operators.selection import numbered
from marquee.session import checkpointed, is_small, small


def area_of(lat: Column, lng: Column, boxes: list[tuple] = K.AREA_BOXES) -> Column:
    """Name of the first box that holds the point, bounds included.

    The boxes are a short fixed list, so this is one expression in the row, not a range join.
    """
    chain = F
    for name, low_lat, high_lat, low_lng, high_lng in boxes:
        chain = chain.when(lat.between(low_lat, high_lat) & lng.between(low_lng, high_lng), F.lit(name))
    return chain


# cells have sides of 2**level degrees, every other level; larger boxes lie in the coarsest, points and slivers in the finest
FINEST, COARSEST = -20, 10
# many boxes are looked up in parts by position: the first 1/4096 of them, up to the first 1/1024, ...
FIRST_BOXES = [4.0**-k for k in range(6, 0, -1)]


def _cell(x: Column, level: Column) -> Column:
    bounded = F.greatest(F.least(x, F.lit(2.0**COARSEST)), F.lit(-(2.0**COARSEST)))
    return F.floor(bounded / F.pow(F.lit(2.0), level)).cast("long")


def _level(low: str, high: str) -> Column:
    size = F.least(F.col(high) - F.col(low), F.lit(2.0**COARSEST))
    level = F.when(size > 0, 2 * F.ceil(F.log2(size) / 2)).otherwise(FINEST)
    return F.greatest(level, F.lit(FINEST)).cast("int")


def _boxes_at(at: DataFrame, boxes: DataFrame) -> DataFrame:
    """(_lat, _lng, _area): the first box by position and name at each position that lies in one."""
    levels = boxes.select("_a", "_b").distinct().collect()  # 256 at most
    if not levels:
        return at.select("*", F.lit(None).cast("string").alias("_area")).limit(0)
    span = lambda side, level: F.explode(F.sequence(_cell(F.col(f"low_{side}"), F.col(level)), _cell(F.col(f"high_{side}"), F.col(level))))
    cells = boxes.withColumn("_x", span("lat", "_a")).withColumn("_y", span("lng", "_b"))
    grids = F.array(*[F.struct(F.lit(a).alias("_a"), F.lit(b).alias("_b")) for a, b in sorted(levels)])
    placed = at.withColumn("_grid", F.explode(grids)).select("_lat", "_lng", "_grid.*")
    placed = placed.withColumn("_x", _cell(F.col("_lat"), F.col("_a"))).withColumn("_y", _cell(F.col("_lng"), F.col("_b")))
    # the planner takes exploded positions for as small as their file and would send them through the driver
    near = small(cells)
    placed = placed if near is not cells else placed.hint("merge")
    inside = F.col("_lat").between(F.col("low_lat"), F.col("high_lat")) & F.col("_lng").between(F.col("low_lng"), F.col("high_lng"))
    return (
        placed.join(near, ["_a", "_b", "_x", "_y"])
        .where(inside)
        .groupBy("_lat", "_lng")
        .agg(F.min(F.struct("position", "name"))["name"].alias("_area"))
    )


def areas_by_cell(points: DataFrame, boxes: DataFrame, lat: str = "latitude", lng: str = "longitude", area: str = "area") -> DataFrame:
    """`area_of` for a table of boxes (name, low_lat, high_lat, low_lng, high_lng, position): adds the name of the
    first box by position (a number; ties: by name) that holds the point, bounds included, or null.

    A range join as an equi-join: each box lies in the cells, at most two by two, of a grid as coarse as its two
    sides, and a point in one cell per grid that has boxes (256 at most). Cells of powers of two are exact, so no
    box is missed at a border. Each position is looked up once, however many rows stand there. Positions or bounds
    that are null or NaN meet nothing. Many boxes are gone through in parts, the first ones first: a position that
    has its box is out of the later parts, so the work follows the tables and not the boxes that overlap.
    """
    at = points.select(F.col(lat).cast("double").alias("_lat"), F.col(lng).cast("double").alias("_lng"))
    at = at.where(~F.isnan("_lat") & ~F.isnan("_lng")).distinct()
    ordered = (F.col("low_lat") <= F.col("high_lat")) & (F.col("low_lng") <= F.col("high_lng"))
    known = boxes.where(ordered & ~F.isnan("high_lat") & ~F.isnan("high_lng")).select(
        _level("low_lat", "high_lat").alias("_a"), _level("low_lng", "high_lng").alias("_b"),
        "name", "position", "low_lat", "high_lat", "low_lng", "high_lng",
    )
    if is_small(known):
        found = _boxes_at(at, known)
    else:
        known, at = checkpointed(known), checkpointed(at)
        cuts = sorted(set(known.agg(F.percentile_approx("position", FIRST_BOXES, 100_000)).first()[0] or []))
        found = None
        for low, high in zip([None, *cuts], [*cuts, None]):
            above = F.lit(True) if low is None else F.col("position") > low
            # boxes without a position come first
            upto = F.lit(True) if high is None else F.col("position") <= high
            part = known.where(above & upto if low is not None else upto | F.col("position").isNull())
            got = checkpointed(_boxes_at(at, part))
            found = got if found is None else found.unionByName(got)
            if high is not None:
                at = checkpointed(at.join(got, ["_lat", "_lng"], "left_anti"))
    here = (points[lat].cast("double") == found["_lat"]) & (points[lng].cast("double") == found["_lng"])
    columns = [points[f"`{c}`"] for c in points.columns if c != area]
    return points.join(found, here, "left").select(*columns, found["_area"].alias(area))


def with_parent_label(df: DataFrame, key: str, parent: str, label: str) -> DataFrame:
    """Self-join on the parent key; the parent's key itself stands in where its row is missing."""
    parents = df.select(F.col(key).alias("_pk"), F.col(label).alias("_pl"))
    joined = df.join(small(parents), F.col(parent) == F.col("_pk"), "left")
    return joined.withColumn("parent_label", F.coalesce("_pl", F.col(parent).cast("string"))).drop("_pk", "_pl")


def match_by_position(
    left: DataFrame, right: DataFrame, key: str, left_pos: str, right_pos: str
) -> DataFrame:
    """One-to-one per key: the n-th left row gets the n-th right row; left rows without one stay."""
    a = numbered(left, [key], left_pos, "_n")
    b = numbered(right, [key], right_pos, "_n")
    return a.join(b, [key, "_n"], "left").drop("_n")


def correct_places(df: DataFrame, fixes: DataFrame, venue: str = "venue") -> DataFrame:
    """Overwrite coordinates, and the address if the fix has one, by venue name."""
    known = fixes.select(
        F.col("venue_key"), F.col("lat").alias("_lat"), F.col("lng").alias("_lng"), F.col("address").alias("_addr")
    )
    name = text.clean(F.lower(F.col(venue)))
    joined = df.join(small(known), name == F.col("venue_key"), "left")
    hit = F.col("venue_key").isNotNull()
    return joined.withColumns(
        {
            "lat": F.when(hit, F.col("_lat")).otherwise(F.col("lat")),
            "lng": F.when(hit, F.col("_lng")).otherwise(F.col("lng")),
            "address": F.coalesce(F.nullif(F.col("_addr"), F.lit("")), "address"),
        }
    ).drop("venue_key", "_lat", "_lng", "_addr")


def known_and_unknown(df: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows joined to the cache, distinct keys the cache has never seen).

    A cache row with null coordinates is a known miss and is not looked up again.
    """
    wanted = df.select(key).where(F.col(key).isNotNull()).distinct()
    unseen = wanted.join(cache.select(key), key, "left_anti")
    return df.join(cache, key, "left"), unseen


def detail_once(listing: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Several listing rows share one detail row: look each key up once, then join it back."""
    wanted = listing.select(key).distinct()
    needed = details.join(wanted, key, "left_semi")
    return listing.join(needed, key, "left")


def unseen(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    return new.join(existing.select(key), key, "left_anti")


def seen(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    return new.join(existing.select(key), key, "left_semi")
