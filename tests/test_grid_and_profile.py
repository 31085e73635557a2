"""Lookups in box tables by grid cells, and profiles that add up over runs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from marquee.operators import extract, joins, quality

BOX = "name string, position int, low_lat double, high_lat double, low_lng double, high_lng double"


def first_box(lat, lng, boxes):
    if lat is None or lng is None:
        return None
    held = [(p, n) for n, p, a, b, c, d in boxes if None not in (a, b, c, d) and a <= lat <= b and c <= lng <= d]
    return min(held)[1] if held else None


def boxes_of_all_sizes(rng):
    out = []
    for i in range(300):
        size = lambda: rng.choice([0.0, 2.0 ** rng.randint(-22, 8), rng.random() * 10 ** rng.randint(-5, 2)])
        lat, lng = rng.choice([-1.0, 0.0, 0.25, 1.0, 50.5]) + rng.choice([0, rng.random()]), rng.choice([-3.0, 0.0, 0.5, 3.75]) + rng.choice([0, rng.random()])
        out.append((f"b{i}", rng.randint(0, 40), lat, lat + size(), lng, lng + size()))
    whole = (-math.inf, math.inf)
    return out + [("north", 39, 50.0, math.inf, *whole), ("empty", 0, 2.0, 1.0, 0.0, 9.0), ("open", 0, None, 2.0, 0.0, 9.0), ("nan", 0, 0.0, math.nan, 0.0, math.nan)]


def test_boxes_by_cell_as_by_hand(spark):
    rng = random.Random(5)
    boxes = boxes_of_all_sizes(rng)
    ends = [(rng.choice([b[2], b[3]]), rng.choice([b[4], b[5]])) for b in boxes[:300] for _ in range(3)]
    points = [*ends, *[(rng.uniform(-2, 60), rng.uniform(-4, 9)) for _ in range(500)], (0.0, -0.0), (-0.0, 0.0), (None, 3.0), (51.0, None), (9e9, 0.0)] * 2
    rows = [(i, *p, "kept") for i, p in enumerate(points)]
    got = joins.areas_by_cell(spark.createDataFrame(rows, "id long, latitude double, longitude double, name string"), spark.createDataFrame(boxes, BOX)).collect()
    assert {r.id: r.area for r in got} == {i: first_box(*p, boxes) for i, p in enumerate(points)}
    assert len(got) == len(points) and {r.name for r in got} == {"kept"}
    assert sum(r.area is not None for r in got) > 500


def test_a_box_lies_in_four_cells_at_most(spark):
    boxes = spark.createDataFrame([("a", 1, 0.9, 1.9, -0.1, 0.9), ("b", 2, 0.0, 300.0, 0.0, 300.0)], BOX)
    points = spark.createDataFrame([(1.5, 0.0), (250.0, 250.0), (math.nan, 0.0)], "latitude double, longitude double")
    assert sorted(str(r.area) for r in joins.areas_by_cell(points, boxes).collect()) == ["None", "a", "b"]
    assert {r.area for r in joins.areas_by_cell(points, boxes.limit(0)).collect()} == {None}
    assert joins.areas_by_cell(points.limit(0), boxes).count() == 0


def test_many_boxes_in_parts(spark, monkeypatch):
    """Parts by position give the first box, and exploded positions are never broadcast by the planner's guess."""
    monkeypatch.setattr(joins, "is_small", lambda df: False)
    monkeypatch.setattr(joins, "small", lambda df: df)
    rng = random.Random(8)
    boxes = [*boxes_of_all_sizes(rng), ("thin", 3, 50.0, 50.0001, -180.0, 180.0)]
    points = [(rng.uniform(-2, 60), rng.uniform(-4, 9)) for _ in range(300)] + [(b[2], b[4]) for b in boxes[:200]] + [(50.00005, 170.0), (None, 1.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id long, latitude double, longitude double")
    got = joins.areas_by_cell(df, spark.createDataFrame(boxes, BOX))
    assert {r.id: r.area for r in got.collect()} == {i: first_box(*p, boxes) for i, p in enumerate(points)}
    known = spark.createDataFrame([(0, 0, *boxes[0])], "_a int, _b int, " + BOX)
    at = df.selectExpr("latitude as _lat", "longitude as _lng")
    assert "Broadcast" not in joins._boxes_at(at, known)._jdf.queryExecution().executedPlan().toString()


def profiled(df):
    return quality.profile_sketches(df, "kind", ["v", "tags"], ["x"])


def test_profile_of_runs_is_that_of_all_rows(spark, tmp_path):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 4)).alias("kind"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 9001).alias("v"), F.array(F.col("id") % 12).alias("tags"), (F.col("id") * 7919 % 60_000).cast("double").alias("x"), "id",
    )
    whole = {r.kind: r for r in quality.profile_report(profiled(rows), (0.1, 0.5)).collect()}
    path = str(tmp_path / "runs")
    for run in [*range(7), 3]:
        quality.store_profile(profiled(rows.where(F.col("id") % 7 == run)), path, str(run))
    merged = quality.profile_report(quality.merged_sketches(spark.read.parquet(path), "kind"), (0.1, 0.5)).collect()
    exact = {r.kind: r for r in rows.groupBy("kind").agg(F.countDistinct("v").alias("v"), F.countDistinct("tags").alias("tags")).collect()}
    assert {r.kind for r in merged} == set(whole)
    for r in merged:
        w, e = whole[r.kind], exact[r.kind]
        assert (r.n_rows, r.n_v, r.n_tags, r.low_x, r.high_x) == (w.n_rows, w.n_v, w.n_tags, w.low_x, w.high_x)
        for got in (r, w):
            assert got.distinct_v == pytest.approx(e.v, rel=0.04) and got.distinct_tags == e.tags
            assert got.p50_x == pytest.approx(30_000, abs=0.02 * 60_000) and got.p10_x == pytest.approx(6_000, abs=0.02 * 60_000)


def test_profile_of_empty_cells(spark):
    rows = spark.createDataFrame([("a", None, [], None), ("a", None, None, math.nan), (None, 3, [1], 2.0)], "kind string, v long, tags array<int>, x double")
    got = {r.kind: r for r in quality.profile_report(quality.merged_sketches(profiled(rows).unionAll(profiled(rows)), "kind")).collect()}
    assert (got["a"].n_rows, got["a"].n_v, got["a"].distinct_v, got["a"].low_x, got["a"].p50_x) == (4, 0, 0, None, None)
    assert (got[None].n_rows, got[None].n_tags, got[None].distinct_tags, got[None].high_x, got[None].p50_x) == (2, 2, 1, 2.0, 2.0)
    assert profiled(rows.limit(0)).count() == 0


def test_extractor_in_sql(spark):
    def cut(text):
        return [{"word": w, "place": i} for i, w in enumerate(text.split(" "))] if text != "bad" else 1 / 0

    extract.register_extractor(spark, "cut_words", cut, "word string, place int")
    rows = spark.createDataFrame([(1, "a b"), (2, "bad"), (3, None), (4, "c")], "id int, text string")
    got = spark.sql("select t.id, x.* from {t} t, lateral cut_words(t.text) x", t=rows).collect()
    plain = extract.run_extractor(rows, "id", "text", cut, "word string, place int").collect()
    key = lambda r: (r.id, r._error or "", r.word or "", -1 if r.place != r.place or r.place is None else int(r.place))
    assert sorted(map(key, got)) == sorted(map(key, plain)) and len(got) == 5
