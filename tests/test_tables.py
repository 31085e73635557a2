"""Merging, deduplication and guards."""

import pytest
from pyspark.sql import functions as F

from marquee import constants as K
from marquee.operators import dedupe, filters, overrides, upsert
from marquee.operators.normalize import to_event
from marquee.operators.selection import carried_forward, numbered
from marquee.session import shared_dir, small
from marquee.sources import sheets

DAY = "2026-06-12"


def events(spark, rows):
    """rows: (event_id, title, source, extra columns)"""
    ddl = "ord long, event_id string, title string, source string, price string, going long, aggregator_id string, status string"
    full = [
        (i, r[0], r[1], r[2], r[3].get("price"), r[3].get("going"), r[3].get("ids"), r[3].get("status", "pending"))
        for i, r in enumerate(rows)
    ]
    df = spark.createDataFrame(full, ddl)
    return to_event(df, ["ord"], date_start=F.lit(DAY), **{c: F.col(c) for c in df.columns if c != "ord"})


def test_deduplicate(spark):
    rows = [
        ("a", "Jazz in the Park!", "facebook", {"going": 5, "ids": "fb_1"}),
        ("b", "Jazz in the park", "goabase", {"ids": "gb_1, gb_2", "price": "5"}),
        ("c", "JAZZ  in thé park", "funke", {"ids": "gb_2"}),
        ("d", "Jazz in the parks", "facebook", {"price": "9"}),
        ("e", "Another evening", "funke", {}),
        ("f", "Jazz in the park", "funke", {"status": "duplicate"}),
    ]
    done, links = dedupe.deduplicate(events(spark, rows))
    got = {r.event_id: r for r in done.collect()}
    assert len(got) == len(rows)
    assert {k for k, r in got.items() if r.status != "duplicate"} == {"c", "e"}
    # the venue's own listing stays and takes what it lacks from the others, best source first
    assert (got["c"].going, got["c"].price, got["c"].title) == (5, "5", "JAZZ  in thé park")
    assert got["c"].aggregator_id == "gb_2"
    assert [r.id for r in links.where("event_id = 'c'").orderBy("place").collect()] == ["gb_2", "gb_1", "fb_1"]


def test_deduplicate_twice_changes_nothing(spark):
    rows = [(f"e{i}", f"night {i % 7} with a long common title", "funke", {"ids": f"x_{i}"}) for i in range(40)]
    once, _ = dedupe.deduplicate(events(spark, rows))
    twice, _ = dedupe.deduplicate(once)
    key = lambda df: sorted((r.event_id, r.status, r.aggregator_id or "") for r in df.collect())
    assert key(once) == key(twice)


def test_groups_of_any_size_are_linked_by_one_rule(spark):
    rows = [(f"e{i}", "same title", "funke", {"ids": f"x_{i}"}) for i in range(300)] + [("z", "alone here", "funke", {"ids": "y"})]
    done, links = dedupe.deduplicate(events(spark, rows))
    assert links.where("event_id = 'e0'").count() == 300 and links.where("event_id = 'z'").first().id == "y"
    assert {r.event_id: r.aggregator_id for r in done.where("status <> 'duplicate'").collect()} == {"e0": "x_0", "z": "y"}


def test_a_group_stands_where_its_first_member_stood(spark):
    rows = [("a", "Jazz in the park", "facebook", {}), ("b", "Jazz in the parks", "funke", {}), ("c", "Jazz in the Park", "funke", {})]
    done, _ = dedupe.deduplicate(events(spark, rows))
    assert [r.event_id for r in done.where("status <> 'duplicate'").collect()] == ["c"]


def test_merge_is_idempotent(spark):
    fresh = events(spark, [("a", "A", "funke", {"price": "1"}), ("a", "A2", "funke", {"price": None}), ("b", "B", "x", {})])
    stored = events(spark, [("a", "Old", "x", {"price": "0", "going": 3})]).drop("ord")
    once = upsert.merge_events(stored, fresh)
    twice = upsert.merge_events(once, fresh)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    a = once.where("event_id = 'a'").first()
    assert (a.title, a.price, a.going, a.source) == ("Old", "1", 3, "funke")


def test_human_columns_survive_two_runs(spark):
    sheet = spark.createDataFrame(
        [(1, "a", "old", DAY, "pending", "keep me"), (2, "z", "gone soon", DAY, "pending", "me too"), (3, "y", "past", "2020-01-01", "pending", "")],
        "row_no long, event_id string, title string, date_start string, status string, notes string",
    )
    cells = upsert.to_cells(events(spark, [("a", "A", "funke", {}), ("n", "N", "funke", {})]), "2026-01-01")
    once = upsert.upsert_cells(sheet, cells, "event_id", as_of="2026-01-01")
    assert {r.event_id: (r.action, r.notes) for r in once.collect()} == {
        "a": ("updated", "keep me"), "z": ("gone", "me too"), "y": ("kept", ""), "n": ("appended", ""),
    }
    twice = upsert.upsert_cells(once.drop("action"), cells, "event_id", as_of="2026-01-01")
    assert {r.event_id: r.action for r in twice.collect()} == {"a": "updated", "z": "kept", "y": "kept", "n": "updated"}
    blank = cells.withColumn("event_id", F.lit(""))
    assert upsert.upsert_cells(sheet, blank, "event_id").count() == 5
    assert upsert.upsert_cells(sheet, blank, "event_id", append_without_key=False).count() == 3


def test_override_cells(spark):
    tab = spark.createDataFrame(
        [(1, "a", "51,05", "3.7", "", "Ja"), (2, "b", "51.05", "", "", ""), (3, "a", "", "", " Zaal ", "nee")],
        "row_no int, event_id string, latitude_override string, longitude_override string, venue_override string, hide string",
    )
    rows = {r.event_id: r.overrides for r in overrides.pulled_overrides([tab]).collect()}
    assert rows["b"] is None
    assert (rows["a"].venue, rows["a"].hide, rows["a"].latitude) == ("Zaal", False, None)


def test_guards(spark):
    tab = spark.createDataFrame([], "title string")
    with pytest.raises(sheets.MissingColumn):
        sheets.require(tab, "approved")
    with pytest.raises(ValueError):
        sheets.refuse_empty(tab)
    assert not sheets.has_overrides(tab)


def test_numbering_over_ranges(spark):
    rows = [(k, p, p if p % 4 == 0 else None) for k in "ab" for p in range(0, 300, 3 if k == "a" else 5)]
    df = spark.createDataFrame(rows, "k string, p long, v long")
    got = {(r.k, r.p): (r.n, r.last) for r in carried_forward(numbered(df, ["k"], "p", "n", 7), ["k"], "p", "v", "last", 7).collect()}
    for k in "ab":
        last, n = None, 0
        for kk, p, v in sorted(r for r in rows if r[0] == k):
            n, last = n + 1, v if v is not None else last
            assert got[k, p] == (n, last)


def test_priorities():
    assert K.SOURCE_PRIORITY["facebook"] < K.DEFAULT_PRIORITY < K.SOURCE_PRIORITY["funke"]


def test_small_sides_are_measured(spark):
    df = spark.range(100).withColumn("s", F.lit("x" * 50))
    hinted = lambda d: "UnresolvedHint" in d._jdf.queryExecution().logical().toString()
    assert hinted(small(df))
    assert not hinted(small(df, max_rows=99))
    assert not hinted(small(df, max_bytes=1000))


def test_shared_dir_is_kept(spark):
    assert shared_dir(spark) == shared_dir(spark)
    assert filters.is_active is not None


def run_once(spark, names, partitions):
    from marquee.plans import chains
    from marquee.plans import inputs as I
    from marquee.plans import queries_event as E
    from marquee.plans import queries_table as B
    from marquee.plans.catalog import Tables
    from tests.conftest import SMALL

    t = Tables(spark, SMALL)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        raw = {s: I.raw_social(t) if s == "facebook" else I.raw_events(t, s) for s in names}
        stored, _ = B.stored_and_fresh(t)
        done = chains.consolidate(raw, stored, I.dimensions(t), B.genres(t), E.geo_cache(t), E.two_tabs(t))
        return {k: sorted(map(repr, df.collect())) for k, df in done.items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_the_run_does_not_depend_on_order_or_partitions(spark):
    names = ["goabase", "beldub", "venue", "agenda", "facebook"]
    first, second = run_once(spark, names, 8), run_once(spark, names[::-1], 3)
    assert first == second
    assert all(first[k] for k in ("events", "rejected", "review"))
    ids = [r.split("event_id=")[1].split(",")[0] for r in first["events"]]
    assert len(ids) == len(set(ids))


def test_a_small_batch_does_not_shuffle_the_stored_rows(spark, tmp_path):
    sheet = spark.range(5000).selectExpr("id as row_no", "concat('k', id % 4900) as event_id", "concat('t', id) as title", "'n' as notes")
    sheet.write.parquet(str(tmp_path / "sheet"))
    stored = spark.read.parquet(str(tmp_path / "sheet"))
    batch = spark.createDataFrame([(1, "k7", "new"), (2, "k7", "newer"), (3, "new key", "x"), (4, None, "no key")], "ord long, event_id string, title string")
    done = upsert.upsert_cells(stored, batch, "event_id", owned=["event_id", "title"], human=["notes"])
    done.collect()
    plan = done._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.split("Final Plan")[-1].split("Initial Plan")[0].splitlines() if "SortMergeJoin" in line or "ShuffledHashJoin" in line]
    got = {(r.row_no, r.event_id): (r.title, r.action) for r in done.collect()}
    assert not joins and len(got) == 5002
    assert got[7, "k7"] == ("newer", "updated") and got[4907, "k7"] == ("t4907", "kept") and got[8, "k8"] == ("t8", "kept")
    assert sorted(v for k, v in got.items() if k[0] > 4999) == [("no key", "appended"), ("x", "appended")]
