"""Mixing sources to target weights along a time-varying curriculum.

Sources get target sizes by weight, none above three times its own size. How much of a source is asked for
at each moment of the training follows a weight schedule; its integral is the source's cumulative demand.
A document's place in its source's cumulative sizes, put through the inverse of that integral, is its
position in training, and documents are range-sorted by position. A source that is asked for more than it
has gives its documents again, up to three times; one that is asked for less gives the first documents of
a fixed hash order.

Null text has size 0. Null sources are one source, the last. Rows that repeat a whole row are mixed each
and get equal values. An empty table gives an empty result. Other columns are carried along.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import free, row_key
from marquee.session import checkpointed

WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3
#: Per weight in the cycle: (time, rate relative to the mean) knots of a piecewise linear schedule over [0, 1].
SCHEDULES = (
    ((0.0, 0.6), (1.0, 1.4)),
    ((0.0, 1.0), (0.5, 1.2), (1.0, 0.8)),
    ((0.0, 1.5), (0.4, 1.0), (1.0, 0.7)),
)
SPACES = "[^\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACES)), F.lit(0)).cast("long")


def demand(schedule: tuple[tuple[float, float], ...]) -> list[tuple[float, float, float, float]]:
    """Integral of a schedule, scaled to end at 1: (time, demand before, rate, change of rate) per segment."""
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:]))
    out, before = [], 0.0
    for (t0, r0), (t1, r1) in zip(schedule, schedule[1:]):
        out.append((t0, before, r0 / area, (r1 - r0) / (t1 - t0) / area))
        before += (t1 - t0) * (r0 + r1) / 2 / area
    return out


def inverse_demand(x: Column, schedule: tuple[tuple[float, float], ...]) -> Column:
    """The time at which the cumulative demand is `x` (0 to 1): per segment the root of a quadratic."""
    out = F.lit(0.0)
    for t0, before, rate, slope in demand(schedule):
        rest = x - F.lit(before)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(rate * rate) + 2 * F.lit(slope) * rest))
        out = F.when(x >= before, F.lit(t0) + 2 * rest / (F.lit(rate) + root)).otherwise(out)
    return F.least(F.lit(1.0), out)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size, shape (place in the cycle of weights), target.

    Weights repeat over the sources in code point order, null last. The share of all sizes goes by weight,
    stopped at `most` times the source's size, and what is above is shared again by weight: the sources
    that stop are those with the least (limit / weight), up to the point where the share of the rest per
    weight is below the next one's ratio. One row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("shape") + 1)
    named = sizes.withColumn("shape", ((F.row_number().over(by_name) - 1) % len(weights)).cast("int"))
    limited = named.withColumn("weight", cycle).withColumn("limit", (F.lit(most) * F.col("source_size")).cast("double"))
    ratio = limited.withColumn("ratio", F.col("limit") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    shared = (
        ratio.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("open_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("per_weight", (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.col("open_weight"))
        .withColumn("stops", F.col("ratio") <= F.col("per_weight"))
        .withColumn("rate", F.min(F.when(~F.col("stops"), F.struct("ratio", "per_weight"))).over(everything)["per_weight"])
    )
    target = F.when(F.col("rate").isNull() | (F.col("ratio") <= F.col("rate")), F.col("limit")).otherwise(
        F.col("rate") * F.col("weight")
    )
    return shared.select("source", "source_size", "shape", target.alias("target"))


def plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """One row per distinct document row: how often it is taken and where its words lie in its source's demand.

    Columns: doc_id, tie (hash of the row), source, rows, size, source_size, shape, target, copies, before, demand_size.
    The cumulative sizes of a source are taken bucket by bucket of a hash order, so a source with a third of
    all rows is not one window.
    """
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", row_key(*docs.columns).alias("tie"), words(F.col("text")).alias("size")
    )
    items = checkpointed(
        slim.groupBy("doc_id", "source", "tie", "size").agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("spot", F.xxhash64("doc_id", "tie", F.lit(7)))
    )
    buckets = math.isqrt(items.count()) + 1  # as many buckets as rows in a bucket
    items = items.withColumn("bucket", F.floor((F.col("spot") / F.lit(2.0**64) + 0.5) * buckets).cast("int")).withColumn(
        "amount", F.col("size") * F.col("rows")
    )
    sums = items.groupBy("source", "bucket").agg(F.sum("amount").alias("bucket_size"))
    wanted = targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, most)
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = sums.withColumn("head", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0))).drop("bucket_size")
    # a source can be null, so joins go by a key that is not
    key = F.struct(F.col("source").isNull(), F.coalesce("source", F.lit("")))
    heads = heads.withColumn("key", key).join(wanted.withColumn("key", key).drop("source"), "key").drop("source")
    inside = Window.partitionBy("key", "bucket").orderBy("spot", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        items.withColumn("key", key)
        .withColumn("inner", F.coalesce(F.sum("amount").over(inside), F.lit(0)))
        .join(heads, ["key", "bucket"])
        .withColumn("before", F.col("head") + F.col("inner"))
    )
    whole = F.least(F.lit(most), F.floor(F.try_divide("target", "source_size") + 1e-9)).cast("int")
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    extra = (F.col("whole") < most) & (F.col("before") + F.col("amount") / 2 <= rest)
    taken = placed.withColumn("whole", F.when(F.col("source_size") > 0, whole).otherwise(F.lit(1))).withColumn(
        "copies", F.col("whole") + F.when((F.col("source_size") > 0) & extra, 1).otherwise(0)
    )
    return taken.withColumn("demand_size", F.greatest(F.col("target"), F.col("whole") * F.col("source_size").cast("double"))).select(
        "doc_id", "tie", "source", "rows", "size", "source_size", "shape", "target", "copies", "before", "demand_size"
    )


def positions(planned: DataFrame, schedules=SCHEDULES) -> DataFrame:
    """One row per taken copy with its position in training (0 to 1), and one row with copy 0 and no position
    for a document that is not taken."""
    copies = planned.withColumn("copy", F.explode(F.when(F.col("copies") > 0, F.sequence(F.lit(1), F.col("copies"))).otherwise(F.array(F.lit(0)))))
    asked = F.try_divide((F.col("copy") - 1) * F.col("source_size") + F.col("before"), F.col("demand_size"))
    x = F.when(F.col("demand_size") > 0, F.least(F.lit(1.0), asked)).otherwise(F.lit(0.0))
    at = F.lit(None).cast("double")
    for i, schedule in enumerate(schedules):
        at = F.when(F.col("shape") == i, inverse_demand(x, schedule)).otherwise(at)
    return copies.withColumn("position", F.when(F.col("copy") > 0, at))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, schedules=SCHEDULES, most: int = MOST_EPOCHS) -> DataFrame:
    """The documents as training reads them: each as often as it is taken, range-sorted by position. All columns stay as
    they are; `_copy` and `_position` follow, with underscores in front where the documents have columns of these names."""
    doc, tie, own, own_tie, copy, position = free(docs, "_doc", "_tie", "_own", "_own_tie", "_copy", "_position")
    chosen = positions(plan(docs, weights, most), schedules).where("copy > 0").select(
        F.col("doc_id").alias(doc), F.col("tie").alias(tie), F.col("copy").alias(copy), F.col("position").alias(position)
    )
    keyed = docs.withColumn(own, F.col("doc_id").cast("long")).withColumn(own_tie, row_key(*docs.columns))
    joined = keyed.join(chosen, F.col(own).eqNullSafe(F.col(doc)) & (F.col(own_tie) == F.col(tie)))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], copy, position).orderBy(position, "doc_id", copy)
