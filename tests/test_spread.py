"""Heavy work is dealt over the tasks, and done once."""

from pyspark.sql import functions as F

from marquee import session
from marquee.functions import records
from marquee.functions import text as tx
from marquee.operators import enrich, extract
from marquee.plans import chains
from marquee.sources import raw


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def pieces(df) -> list[int]:
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_one_row_group_in_many_splits_is_dealt(spark, tmp_path):
    spark.range(150_000).coalesce(1).write.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        stored = spark.read.parquet(str(tmp_path / "t"))
        assert stored.rdd.getNumPartitions() > 8 and len(pieces(stored)) == 1
        dealt = pieces(session.spread(stored))
        assert sum(dealt) == 150_000 and len(dealt) >= 8 and max(dealt) <= 2 * session.EACH_ROWS
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_even_pieces_stay(spark):
    rows = spark.range(0, 1000, 1, 8)
    assert session.spread(rows) is rows


def test_event_arrays_are_read_behind_the_shuffle(spark):
    rows = spark.createDataFrame([(1, '[{"name":"a","date":"2024-03-01"}]'), (2, "{}")], "id long, blob string").repartition(8)
    found = extract.json_events(rows, "id", "blob", F.lit("2024-01-01").cast("date"), "https://a.example", "https://a.example/l")
    assert "json" not in optimized(found).split("Repartition")[1]
    assert [(r["id"], r["pos"], r["title"]) for r in found.collect()] == [(1, 0, "a")]


def test_a_record_is_parsed_once_for_all_ticket_keys(spark):
    rows = spark.createDataFrame([('{"a":1,"shop_url":"http://s"}',)], "record string").select(records.ticket_url(F.col("record")).alias("u"))
    assert 0 < optimized(rows).lower().count("parsejson(") < 6
    assert rows.first()["u"] == "http://s"


def test_calendars_in_one_piece_are_dealt(spark):
    files = spark.createDataFrame(
        [(i, f"BEGIN:VCALENDAR\r\nBEGIN:VEVENT\r\nSUMMARY:s{i}\r\nDTSTART:20240301\r\nEND:VEVENT\r\n") for i in range(100)], "id int, ics string"
    ).coalesce(1)
    found = extract.calendar_events(files, "id", "ics")
    assert len(pieces(found)) > 1 and found.count() == 100


def test_listing_pages_are_read_once(spark):
    html = '<a href="/nl/day/3/act-7">a</a><a href="/nl/day/3/act-8?x=1">b</a>'
    nodes = chains.listed_nodes(spark.createDataFrame([(1, 3, html), (2, 4, html)], "page_id int, day int, html string"))
    assert "Generate" not in optimized(nodes)  # a table, not the work
    assert {(r["node_id"], r["href"], tuple(r["days"])) for r in nodes.collect()} == {("7", "/nl/day/3/act-7", (3, 4)), ("8", "/nl/day/3/act-8", (3, 4))}


def test_texts_are_normalized_behind_the_shuffle(spark):
    terms = spark.createDataFrame([("techno", "techno", 1, 0.5, 0, "g")], "term string, first_word string, n_words int, weight double, ord int, genre_id string")
    texts = spark.createDataFrame([(1, "Deep  Techno"), (2, ""), (3, None)], "id int, raw string").repartition(8)
    best = enrich.best_genre(texts.select("id", F.lit(0).alias("pass"), tx.normalize_text(F.col("raw")).alias("text")), "id", terms)
    assert "regexp_replace" not in optimized(best).split("Repartition")[1]
    assert [tuple(r) for r in best.collect()] == [(1, "g")]


def test_depths_of_json_pieces_are_counted_once(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"x": {"y": 1}}, {"x": {"y": 2}}]')
    found = raw.json_records(spark, str(tmp_path))
    assert optimized(found).count("+- Window ") <= 2
    assert [r["text"] for r in found.orderBy("pos").collect()] == ['{"x": {"y": 1}}', '{"x": {"y": 2}}']
