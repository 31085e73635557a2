import threading

import pytest
from pyspark.sql import functions as F

from marquee.operators import upsert
from marquee.operators.normalize import to_event
from marquee.session import scratch_path
from marquee.sources import keyed, tables
from marquee.sources.commits import CommitLog, Conflict
from marquee.streaming.ingest import ingest


def test_writers_at_once_are_all_kept(spark):
    path = scratch_path(spark, "table")
    numbers, frames = [], [spark.createDataFrame([(i,)], "n int") for i in range(4)]
    threads = [threading.Thread(target=lambda f=f: numbers.append(tables.write_table(f, path, retain=10))) for f in frames]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(numbers) == [1, 2, 3, 4] and CommitLog(spark, path).numbers() == [1, 2, 3, 4]
    versions = CommitLog(spark, path).latest()[1]["versions"]
    assert sorted(spark.read.parquet(f"{path}/data/{v}").first().n for v in versions) == [0, 1, 2, 3]
    assert tables.read_table(spark, path, frames[0].schema).count() == 1


def test_a_write_from_an_old_version_is_refused(spark):
    path = scratch_path(spark, "table")
    df = spark.createDataFrame([(1,)], "n int")
    read = tables.write_table(df, path)
    tables.write_table(df.selectExpr("n + 1 as n"), path, expected=read)
    with pytest.raises(Conflict):
        tables.write_table(df, path, expected=read)
    assert tables.read_table(spark, path, df.schema).first().n == 2 and tables.current_version(spark, path) == 2
    for i in range(3):
        tables.write_table(df.selectExpr(f"n + {i} as n"), path)
    assert len(CommitLog(spark, path).folders("data")) == 2  # older versions go
    log = CommitLog(spark, path)
    assert not log.commit(5, {}) and not log.commit(3, {}) and log.latest()[0] == 5


def newest(stored, fresh):
    """Fresh rows replace stored ones of their key."""
    return stored.join(fresh, "k", "left_anti").unionByName(fresh)


def rows(spark, low, high, value):
    return spark.range(low, high).select(F.concat(F.lit("key "), "id").alias("k"), F.lit(value).alias("v"))


def table(spark, path, schema):
    return {r.k: r.v for r in keyed.read(spark, path, schema).collect()}


def test_a_small_batch_rewrites_few_buckets(spark):
    path = scratch_path(spark, "keyed")
    all_rows = rows(spark, 0, 3000, 0)
    assert keyed.change(spark, path, "k", all_rows, newest, rows_each=100) == 1
    buckets = CommitLog(spark, path).latest()[1]["buckets"]
    bits = sorted(b["bits"] for b in buckets)
    assert len(bits) == 32 and sum(2.0 ** -len(b) for b in bits) == 1  # the beginnings of all hashes, each once
    assert keyed.change(spark, path, "k", rows(spark, 10, 15, 1), newest, rows_each=100) <= 5
    again = {b["folder"] for b in CommitLog(spark, path).latest()[1]["buckets"]}
    assert len({b["folder"] for b in buckets} - again) <= 5
    got = table(spark, path, all_rows.schema)
    assert got == {f"key {i}": int(10 <= i < 15) for i in range(3000)}
    keyed.change(spark, path, "k", rows(spark, 3000, 9000, 2), newest, rows_each=100)  # buckets outgrow their size
    after = CommitLog(spark, path).latest()[1]["buckets"]
    assert len(after) > len(bits) and sum(2.0 ** -len(b["bits"]) for b in after) == 1
    assert table(spark, path, all_rows.schema) == got | {f"key {i}": 2 for i in range(3000, 9000)}
    assert keyed.vacuum(spark, path, retain=1) > 0 and len(table(spark, path, all_rows.schema)) == 9000


def test_a_crash_between_files_and_a_repeated_batch(spark, monkeypatch):
    path = scratch_path(spark, "keyed")
    schema = rows(spark, 0, 1, 0).schema
    keyed.change(spark, path, "k", rows(spark, 0, 500, 0), newest, ("s", 0), rows_each=50)
    monkeypatch.setattr(CommitLog, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        keyed.change(spark, path, "k", rows(spark, 0, 500, 1), newest, ("s", 1))
    monkeypatch.undo()
    assert set(table(spark, path, schema).values()) == {0}
    assert keyed.change(spark, path, "k", rows(spark, 0, 5, 1), newest, ("s", 1)) > 0
    assert keyed.change(spark, path, "k", rows(spark, 0, 5, 7), newest, ("s", 1)) == 0  # sent again
    assert keyed.change(spark, path, "k", rows(spark, 5, 6, 3), newest, ("other", 0)) == 1
    got = table(spark, path, schema)
    assert got["key 0"] == 1 and got["key 5"] == 3 and len(got) == 500


def test_writers_at_once_merge_on_each_other(spark):
    path = scratch_path(spark, "keyed")
    schema = rows(spark, 0, 1, 0).schema
    threads = [threading.Thread(target=lambda i=i: keyed.change(spark, path, "k", rows(spark, 100 * i, 100 * i + 150, i), newest, rows_each=60)) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(table(spark, path, schema)) == 350 and CommitLog(spark, path).latest()[0] == 3


def test_a_large_batch_is_written_once_and_not_read_to_be_measured(spark, monkeypatch):
    path = scratch_path(spark, "ingest")
    events = lambda low, high, title: to_event(
        spark.range(low, high), event_id=F.concat(F.lit("e"), (F.col("id") % 400).cast("string")), title=F.lit(title),
        price=F.when(F.col("id") % 3 == 0, F.concat(F.lit(f"{title} "), "id")), extra=["id"],
    ).withColumnRenamed("id", "ord")
    stored, fresh = events(0, 300, "old").drop("ord"), events(200, 700, "new")  # 200 .. 299 come twice
    keyed.change(spark, f"{path}/table", "event_id", stored, lambda _, rows: rows, rows_each=50)
    fresh.write.parquet(f"{path}/raw")
    wanted = sorted(map(repr, upsert.merge_events(stored, fresh).collect()))
    written, measured, keep = [], [], keyed.checkpointed
    for module in (keyed, upsert):
        monkeypatch.setattr(module, "checkpointed", lambda df: written.append(df.columns) or keep(df))
    monkeypatch.setattr(upsert, "SMALL_ROWS", 100, raising=False)
    monkeypatch.setattr(upsert, "is_small", lambda df: bool(measured.append(df.columns)))
    ingest(spark, f"{path}/raw", fresh.schema, lambda batch: batch, f"{path}/table", f"{path}/checkpoint", rows_each=50)
    assert len(written) == 1 and not measured
    assert sorted(map(repr, keyed.read(spark, f"{path}/table", stored.schema).collect())) == wanted


def test_rows_are_placed_without_copies_of_them(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("v")).unionByName(spark.createDataFrame([(None, "y")], "k string, v string"))
    buckets = [{"bits": b} for b in ("00", "01", "1")]
    placed = keyed._placed(df, "k", buckets)
    assert sorted(placed.columns) == ["_bits", "k", "v"] and "Generate" not in placed._jdf.queryExecution().executedPlan().toString()
    got = placed.withColumn("_hash", keyed._hash_bits("k")).collect()
    assert len(got) == 1001 and all(r["_hash"].startswith(r["_bits"]) for r in got) and {r["_bits"] for r in got} == {"00", "01", "1"}
    assert keyed._placed(df, "k", buckets[:1]).count() < 1001 == keyed._placed(df, "k", [{"bits": ""}]).count()
