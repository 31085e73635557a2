"""Checks over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators import aggregates, filters
from marquee.operators.enrich import with_genre
from marquee.sources.dimensions import Dimensions


def genre_coverage(events: DataFrame, genres: DataFrame, dims: Dimensions) -> DataFrame:
    """How many active events get a genre and a subgenre."""
    active = events.where(filters.is_active())
    return aggregates.coverage(with_genre(active, genres, dims), "genre", "subgenre")


# --- profiles that add up over runs ----------------------------------------------------------------------------

# distinct counts have a standard error of about 0.8 percent, ranks of quantiles one of about 0.7
DISTINCT_BITS = 14
QUANTILE_SIZE = 400


def profile_sketches(df: DataFrame, by: str, fields: list[str], numbers: list[str] = ()) -> DataFrame:
    """One row per group that adds up with those of other runs: rows, filled cells and a sketch of the distinct
    values per field, ends and a sketch of the quantiles per number. A group costs a few kilobytes per field."""
    measures = [F.count(F.lit(1)).alias("n_rows")]
    for f in fields:
        filled = aggregates.is_filled(df, f)
        measures.append(F.count_if(filled).alias(f"n_{f}"))
        measures.append(F.hll_sketch_agg(F.when(filled, F.col(f"`{f}`").cast("string")), F.lit(DISTINCT_BITS)).alias(f"values_{f}"))
    for f in numbers:
        x = F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None))
        measures += [F.min(x).alias(f"low_{f}"), F.max(x).alias(f"high_{f}"), F.kll_sketch_agg_double(x, F.lit(QUANTILE_SIZE)).alias(f"ranks_{f}")]
    return df.groupBy(by).agg(*measures)


def store_profile(sketches: DataFrame, path: str, run: str) -> None:
    """Keep the sketches of a run; a run that is repeated takes the place of its first try."""
    rows = sketches.withColumn("run", F.lit(run))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def merged_sketches(sketches: DataFrame, by: str) -> DataFrame:
    """The sketches of several runs or tables as those of all their rows."""
    merge = {"n": F.sum, "values": F.hll_union_agg, "low": F.min, "high": F.max, "ranks": F.kll_merge_agg_double}
    return sketches.groupBy(by).agg(*[merge[c.split("_")[0]](f"`{c}`").alias(c) for c in sketches.columns if c not in (by, "run")])


def profile_report(sketches: DataFrame, shares: tuple[float, ...] = (0.5,)) -> DataFrame:
    """What the sketches tell: distinct values, and the numbers at the given shares of the sorted values."""
    out = []
    for c in sketches.columns:
        kind, _, f = c.partition("_")
        if kind == "values":
            out.append(F.hll_sketch_estimate(f"`{c}`").alias(f"distinct_{f}"))
        elif kind == "ranks":
            ranks = F.col(f"`{c}`")
            for s in shares:
                at = F.kll_sketch_get_quantile_double(ranks, F.lit(float(s)))
                out.append(F.when(F.kll_sketch_get_n_double(ranks) > 0, at).alias(f"p{round(100 * s)}_{f}"))
        else:
            out.append(F.col(f"`{c}`"))
    return sketches.select(*out)
