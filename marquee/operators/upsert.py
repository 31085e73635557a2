"""Merging fresh rows into stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.functions import arrays, numbers
from marquee.operators import filters
from marquee.operators.selection import last_filled, last_nonempty
from marquee.schemas import EVENT
from marquee.session import SMALL_ROWS, checkpointed, is_small

# owned by the collecting side: a fresh value replaces the stored one
REFRESHED = [
    "description", "price", "ticket_url", "room", "hour_start", "hour_end",
    "source_url", "image_url", "genre_raw", "source",
]


def fold_fresh(fresh: DataFrame, order: str = "ord", place: str | None = None) -> DataFrame:
    """One row per event id: refreshed columns take the last value, the others the first row's. With `place`, a column of
    that name holds the first `order`."""
    first = F.min_by(
        F.struct(*[f.name for f in EVENT if f.name not in [*REFRESHED, "support_acts", "event_id"]]), order
    ).alias("_kept")
    refreshed = [last_filled(F.col(c), F.col(order)).alias(c) for c in REFRESHED]
    support = last_nonempty(F.col("support_acts"), F.col(order)).alias("support_acts")
    places = [F.min(order).alias(place)] if place else []
    folded = fresh.groupBy("event_id").agg(first, support, *refreshed, *places)
    columns = [
        F.col(f.name) if f.name in [*REFRESHED, "event_id"]
        else arrays.first_filled(F.col("support_acts")).alias("support_acts") if f.name == "support_acts"
        else F.col(f"_kept.{f.name}")
        for f in EVENT
    ]
    return folded.select(*columns, *([place] if place else []))


def merge_events(stored: DataFrame, fresh: DataFrame, order: str = "ord", place: str | None = None) -> DataFrame:
    """New ids are added; of known ids only the refreshed columns move, and only to real values.

    `order` fixes which fresh row is first and which is last; it must be unique over all of `fresh`. With
    `place`, a column of that name holds the first `order` of each new id (null for stored ones). A batch of
    measured small size is broadcast, so the stored table is not shuffled.
    """
    folded = fold_fresh(fresh, order, place)
    if place:  # a row without an id has no place
        folded = folded.where(F.col("event_id").isNotNull())
    return merge_folded(stored, checkpointed(folded), place)


def merge_folded(stored: DataFrame, folded: DataFrame, place: str | None = None) -> DataFrame:
    """`merge_events` for a batch that `fold_fresh` has brought to one row per event id and that lies in files."""
    extra = [place] if place else []
    new, old = folded.alias("n"), stored.alias("o")
    known = F.col("o.event_id").isNotNull()

    def columns(has_old: bool, has_new: bool) -> list[Column]:
        out = []
        for f in EVENT:
            n, o = F.col(f"n.{f.name}"), F.col(f"o.{f.name}")
            if not has_old:
                c = n
            elif not has_new:
                c = o
            elif f.name == "event_id" or f.name in REFRESHED:
                c = F.coalesce(o, n) if f.name == "event_id" else F.coalesce(n, o)
            elif f.name == "support_acts":
                c = arrays.first_filled(n, o)
            else:
                c = F.when(known, o).otherwise(n)
            out.append(c.alias(f.name))
        none = F.lit(None).cast(folded.schema[place].dataType) if place else None
        return out + [(F.col(f"n.{place}") if not has_old else F.when(~known, F.col(f"n.{place}")) if has_new else none).alias(place) for _ in extra]

    on = F.col("o.event_id") == F.col("n.event_id")
    # footers of files tell the number of rows, so a large batch is not read to be measured
    if folded.count() > SMALL_ROWS or not is_small(folded):
        return old.join(new, on, "full_outer").select(*columns(True, True))
    kept = old.join(F.broadcast(new), on, "left").select(*columns(True, True))
    met = old.join(F.broadcast(new), on).select("n.event_id").distinct()
    added = new.join(met, "event_id", "left_anti").select(*columns(False, True))
    return kept.unionByName(added)


def replace_rows(stored: DataFrame, fresh: DataFrame, key: str, order: str) -> DataFrame:
    """Fresh rows replace stored ones with the same key; of equal fresh keys the last wins."""
    columns = [c for c in stored.columns]
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    latest = fresh.groupBy(key).agg(F.max_by(row, order).alias("_row")).select("_row.*")
    kept = stored.join(latest.select(key), key, "left_anti")
    return kept.select(*columns).unionByName(latest)


def append_unseen(stored: DataFrame, new: DataFrame, key: str, order: Column) -> DataFrame:
    """The rows to append: keys the table does not hold, the first row of each."""
    fresh = new.join(stored.select(key), key, "left_anti")
    row = F.struct(*[F.col(f"`{c}`") for c in new.columns])
    return fresh.groupBy(key).agg(F.min_by(row, order).alias("_row")).select("_row.*")


# --- string tables with human columns -----------------------------------------------------------


def cell(c: Column, kind: str) -> Column:
    """One value as a text cell; null is ''."""
    if kind.startswith("array"):
        return arrays.joined(c)
    if kind == "double":
        return F.coalesce(numbers.number_text(c), F.lit(""))
    return F.coalesce(c.cast("string"), F.lit(""))


def to_cells(events: DataFrame, as_of: str) -> DataFrame:
    """Canonical events as rows of text in the stored layout."""
    cells = []
    for name in K.AUTO_COLUMNS:
        if name == "last_seen":
            c = F.lit(as_of)
        elif name == "social_links":
            c = arrays.joined(F.col(name), "\n")
        else:
            c = cell(F.col(name), EVENT[name].dataType.simpleString())
        cells.append(c.alias(name))
    return events.select(*cells, *[c for c in ("ord",) if c in events.columns])


def with_columns_for(
    stored: DataFrame, wanted: list[str] = K.AUTO_COLUMNS + K.HUMAN_COLUMNS
) -> DataFrame:
    """Missing columns are added on the right; order and unknown columns stay."""
    missing = [c for c in wanted if c not in stored.columns]
    return stored.select("*", *[F.lit("").alias(c) for c in missing])


def upsert_cells(
    stored: DataFrame,
    incoming: DataFrame,
    key: str,
    as_of: str | None = None,
    moved: DataFrame | None = None,
    owned: list[str] | None = None,
    append_without_key: bool = True,
    human: list[str] = K.HUMAN_COLUMNS,
) -> DataFrame:
    """Keyed upsert that only writes owned columns; adds `action`.

    stored: text columns plus `row_no`, unique, the place of the row. Of rows with the same key the
    first is the one that is updated. incoming: owned columns and `ord`, its unique order. Of incoming
    rows with the same key the last updates the stored row; if none is stored all are appended. Rows
    without a key are appended (again at every run that brings them), or left out without `append_without_key`.
    A batch of measured size is broadcast: the stored rows are then not shuffled, unless `as_of` asks for all keys.
    Missing owned and `human` columns are added to the table.
    With `as_of`, stored keys that do not come in any more and are not past become 'gone', or 'moved'
    where `moved` holds the key.
    """
    owned = owned or [c for c in K.AUTO_COLUMNS if c in incoming.columns]
    table = with_columns_for(stored, [*owned, *human])
    key_text = F.trim(F.col(key))
    fresh = incoming.where(F.coalesce(F.col(key), F.lit("")) != "").select(
        F.col(key).alias("_k"), F.struct(*owned).alias("_new"), "ord"
    )
    latest = fresh.groupBy("_k").agg(F.max_by("_new", "ord").alias("_new"))
    keyed = table.where(key_text != "").select(key_text.alias("_k"), "row_no")
    few = as_of is None and is_small(incoming.select(key, *owned))
    if few:
        keyed = keyed.join(F.broadcast(fresh.select("_k").distinct()), "_k", "left_semi")
    firsts = keyed.groupBy("_k").agg(F.min("row_no").alias("_row"))
    plan = firsts.join(latest, "_k", "left")
    if moved is not None:
        plan = plan.join(moved.select(F.col(key).alias("_k"), F.lit(True).alias("_moved")), "_k", "left")
    else:
        plan = plan.withColumn("_moved", F.lit(None).cast("boolean"))

    updates = plan.select("_row", "_new", "_moved")
    if few:
        updates = F.broadcast(updates)  # a row for each key of the batch at most
    rows = table.join(updates, table["row_no"] == F.col("_row"), "left")
    hit = F.col("_new").isNotNull()
    absent = F.col("_row").isNotNull() & ~hit
    if as_of is None:
        status = F.lit(None).cast("string")
    else:
        ends = F.when(F.col("_moved"), F.lit("moved")).otherwise(F.lit("gone"))
        due = absent & (F.trim("date_start") >= F.lit(as_of)) & (F.trim("status") != ends)
        status = F.when(due, ends)
    columns = []
    for c in table.columns:
        if c in owned:
            kept = F.coalesce(status, F.col(c)) if c == "status" else F.col(c)
            columns.append(F.when(hit, F.col(f"_new.{c}")).otherwise(kept).alias(c))
        else:
            columns.append(F.col(c))
    action = F.when(hit, F.lit("updated")).when(status.isNotNull(), status).otherwise(F.lit("kept"))
    kept_rows = rows.select(*columns, action.alias("action"))

    last = table.agg(F.coalesce(F.max("row_no"), F.lit(0))).first()[0]
    new_rows = fresh.join(firsts, "_k", "left_anti").select("_new.*", "ord")
    if append_without_key:
        blank = incoming.where(F.coalesce(F.col(key), F.lit("")) == "")
        new_rows = new_rows.unionByName(blank.select(*owned, "ord"))
    added = new_rows.select(
        *[
            F.col(c) if c in owned
            else (F.lit(last + 1) + F.col("ord")).cast("long").alias(c) if c == "row_no"
            else F.lit("").alias(c)
            for c in table.columns
        ],
        F.lit("appended").alias("action"),
    )
    return kept_rows.unionByName(added)


def route_and_upsert(
    events: DataFrame, located_table: DataFrame, failed_table: DataFrame, as_of: str
) -> tuple[DataFrame, DataFrame]:
    """Located events go to one table, the others to a second one; an event that gained coordinates
    leaves a 'moved' row in the second."""
    located, failed = filters.split_located(events)
    ok = to_cells(located, as_of)
    return (
        upsert_cells(located_table, ok, "event_id", as_of),
        upsert_cells(failed_table, to_cells(failed, as_of), "event_id", as_of, moved=ok.select("event_id")),
    )


# --- whole-table mirrors ---------------------------------------------------------------------------


def mirror_actions(local: DataFrame, sheet: DataFrame, key: str = "id") -> DataFrame:
    """Full outer compare of two tables: added, updated, removed or same per key."""
    fields = [c for c in sheet.columns if c != key]
    a = local.select(F.col(key).alias("_lk"), F.struct(*fields).alias("_old"))
    b = sheet.select(F.col(key).alias("_sk"), F.struct(*fields).alias("_new"))
    action = (
        F.when(F.col("_lk").isNull(), "added")
        .when(F.col("_sk").isNull(), "removed")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "updated")
        .otherwise("same")
    )
    joined = a.join(b, F.col("_lk") == F.col("_sk"), "full_outer")
    return joined.select(F.coalesce("_sk", "_lk").alias(key), "_old", "_new", action.alias("action"))


def mirrored(actions: DataFrame, key: str = "id") -> DataFrame:
    """The table after a full mirror: what the sheet holds, and nothing else."""
    return actions.where(F.col("action") != "removed").select(key, "_new.*")
