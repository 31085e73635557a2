"""Chat formatting with collapse of cumulative snapshots.

A conversation that was logged again after each turn appears as many conversations, each a prefix of the
next. Every turn gets the hash of the conversation up to it; a conversation whose own hash is the hash of a
proper prefix of another is dropped by an anti-join, and of equal conversations the one with the least
conv_id stays. What is left is rendered turn by turn.

The hash of a prefix is the XOR, over its turns, of two 64-bit hashes of (place, role, text), so it can be
computed in blocks of places and a very long conversation is not one window. Places are counted over ranges
of about equally many rows, in which rows that repeat count as one row with a number, so neither turns
without a number nor turns that repeat make a range large. Turns are ordered by `turn`
(null first), equal ones by role and text; whole rows that repeat count as turns of their own. Null text
and role differ from empty ones in the hash and are rendered as empty. Rows with a null conv_id are one
conversation. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import pieces_for
from marquee.session import checkpointed

BLOCK_TURNS = 4096
RANGE_TURNS = 200_000
SEGMENT = ("<|", "|>\n", "\n<|end|>\n")


def numbered_turns(turns: DataFrame, each: int = RANGE_TURNS) -> DataFrame:
    """Distinct turns with `rows` (how often they occur) and `start` (the place of the first, from 1).

    Turns are range-sorted and counted within ranges of about `each` rows; what the ranges before hold is added.
    """
    base = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    once = base.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("rows"))
    ranged = checkpointed(once.repartitionByRange(pieces_for(base.count(), each), *order).withColumn("range", F.spark_partition_id()))
    sizes = ranged.groupBy("conv_id", "range").agg(F.sum("rows").alias("range_rows"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    heads = sizes.select("conv_id", "range", F.coalesce(F.sum("range_rows").over(earlier), F.lit(0)).alias("head"))
    inside = Window.partitionBy("conv_id", "range").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, -1)
    counted = ranged.withColumn("inner", F.coalesce(F.sum("rows").over(inside), F.lit(0))).alias("t")
    h = heads.alias("h")
    return counted.join(h, F.col("t.conv_id").eqNullSafe(F.col("h.conv_id")) & (F.col("t.range") == F.col("h.range"))).select(
        "t.conv_id", "role", "text", "rows", (F.col("head") + F.col("inner") + 1).alias("start")
    )


def placed_turns(turns: DataFrame, block: int = BLOCK_TURNS, each: int = RANGE_TURNS) -> DataFrame:
    """Turns with their place (from 1) and the hashes of the conversation up to them.

    Windows run within blocks of `block` places; XORs of the blocks before are added. A turn that repeats is
    dealt to the blocks it fills before it becomes rows.
    """
    last = F.col("start") + F.col("rows") - 1
    number = lambda place: F.floor((place - 1) / block)
    dealt = numbered_turns(turns, each).select("*", F.explode(F.sequence(number(F.col("start")), number(last))).alias("block"))
    within = F.sequence(F.greatest("start", F.col("block") * block + 1), F.least(last, (F.col("block") + 1) * block))
    placed = dealt.repartition("conv_id", "block").select("conv_id", "block", "role", "text", F.explode(within).alias("place"))
    parts = [F.coalesce("role", F.lit("")), F.col("role").isNull(), F.coalesce("text", F.lit("")), F.col("text").isNull()]
    hashed = placed.withColumn("h1", F.xxhash64(F.lit(1), "place", *parts)).withColumn("h2", F.xxhash64(F.lit(2), *parts, "place"))
    run = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rolled = checkpointed(hashed.select("conv_id", "block", "place", "role", "text", F.bit_xor("h1").over(run).alias("r1"), F.bit_xor("h2").over(run).alias("r2")))
    ends = rolled.groupBy("conv_id", "block").agg(F.max_by(F.struct("r1", "r2"), "place").alias("r"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.bit_xor(f"r.r{i}").over(earlier), F.lit(0)).alias(f"e{i}") for i in (1, 2)]
    t, e = rolled.alias("t"), ends.select("conv_id", "block", *before).alias("e")
    return t.join(e, F.col("t.conv_id").eqNullSafe(F.col("e.conv_id")) & (F.col("t.block") == F.col("e.block"))).select(
        "t.conv_id", "place", "role", "text", F.col("r1").bitwiseXOR(F.col("e1")).alias("p1"), F.col("r2").bitwiseXOR(F.col("e2")).alias("p2")
    )


def maximal(placed: DataFrame) -> DataFrame:
    """conv_id, n_turns, copies (conversations equal to it) of those that are no proper prefix of another."""
    last = F.max_by(F.struct("p1", "p2"), "place")
    whole = placed.groupBy("conv_id").agg(F.max("place").alias("n_turns"), last.alias("h")).select("conv_id", "n_turns", "h.p1", "h.p2")
    classes = whole.groupBy("n_turns", "p1", "p2").agg(
        F.min(F.struct(F.col("conv_id").isNotNull(), "conv_id"))["conv_id"].alias("conv_id"), F.count(F.lit(1)).alias("copies")
    )
    p, w = placed.alias("p"), whole.alias("w")
    proper = (
        p.join(w, F.col("p.conv_id").eqNullSafe(F.col("w.conv_id")) & (F.col("p.place") < F.col("w.n_turns")), "left_semi")
        .select(F.col("place").alias("n_turns"), "p1", "p2")
        .distinct()
    )
    return classes.join(proper, ["n_turns", "p1", "p2"], "left_anti").select("conv_id", "n_turns", "copies")


def formatted(turns: DataFrame) -> DataFrame:
    """Maximal conversations, one row per turn: conv_id, place, n_turns, copies, segment.

    A conversation's text is its segments in the order of `place`.
    """
    placed = checkpointed(placed_turns(turns))
    kept = maximal(placed).alias("k")
    opening, middle, closing = SEGMENT
    segment = F.concat(F.lit(opening), F.coalesce("role", F.lit("")), F.lit(middle), F.trim(F.coalesce("text", F.lit(""))), F.lit(closing))
    p = placed.alias("p")
    return p.join(kept, F.col("p.conv_id").eqNullSafe(F.col("k.conv_id"))).select(
        "p.conv_id", F.col("place").cast("long").alias("place"), F.col("n_turns").cast("long").alias("n_turns"), "copies", segment.alias("segment")
    )


def conversation_texts(segments: DataFrame) -> DataFrame:
    """One text per conversation, for tables whose conversations fit in a row each."""
    pieces = F.array_sort(F.collect_list(F.struct("place", "segment")))
    return segments.groupBy("conv_id").agg(F.array_join(F.transform(pieces, lambda s: s["segment"]), "").alias("text"))


FORMATTED_SQL = """
with t as (
  select conv_id, role, text, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as place
  from conversations),
p as (
  select conv_id, place, role, text,
    md5(string_agg(place || '|' || coalesce('r' || length(role) || ':' || role, 'n') || coalesce('t' || length(text) || ':' || text, 'n'), '')
        over (partition by conv_id order by place)) as h
  from t),
w as (select conv_id, max(place) as n_turns, max_by(h, place) as h from p group by conv_id),
c as (select n_turns, h, min(conv_id) as conv_id, count(*) as copies from w group by n_turns, h),
k as (
  select * from c where not exists (
    select 1 from p join w using (conv_id) where p.place < w.n_turns and p.place = c.n_turns and p.h = c.h))
select p.conv_id, p.place::bigint as place, k.n_turns::bigint as n_turns, k.copies::bigint as copies,
  '<|' || coalesce(p.role, '') || '|>' || chr(10) || trim(coalesce(p.text, ''), ' ') || chr(10) || '<|end|>' || chr(10) as segment
from p join k using (conv_id)
"""
