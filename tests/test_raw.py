import json
import random

from pyspark.sql import types as T

from marquee.session import scratch_path
from marquee.sources import raw

struct = lambda **fields: T.StructType([T.StructField(n, t) for n, t in fields.items()])
SCHEMA = struct(id=T.IntegerType(), text=T.StringType(), more=T.ArrayType(struct(x=T.StringType())), deep=struct(a=struct(b=T.IntegerType())))
TEXTS = ['plain', 'a } b', '},{"id": 9}', '"quoted" \\', '\\"', '[{', ']}', '{"a": [1}\\\\', 'é … 🎵 }', '', 'line\nbreak }\n']


def records(n, seed):
    rng = random.Random(seed)
    pick = lambda: rng.choice(TEXTS) + rng.choice(TEXTS)
    return [{"id": i, "text": pick(), "more": [{"x": pick()} for _ in range(rng.randint(0, 2))], "deep": {"a": {"b": i}}} for i in range(n)]


def put(spark, folder, name, text):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(text.encode()))
    out.close()


def found(df):
    return sorted((r.source, r.pos, r.id, r.text, [m.x for m in r.more or []], r.deep and r.deep.a.b) for r in df.collect())


def expected(source, rows):
    return [(source, i, r["id"], r["text"], [m["x"] for m in r["more"]], r["deep"]["a"]["b"]) for i, r in enumerate(rows)]


def test_arrays_in_any_layout_and_many_blocks(spark):
    """Strings with braces, quotes and backslashes; pretty-printed or not; blocks that end anywhere, in strings too."""
    folder = scratch_path(spark, "arrays")
    sets = {"a": records(50, 1), "b": records(25, 2), "c": records(1, 3), "d": []}
    put(spark, folder, "a.json", json.dumps(sets["a"], ensure_ascii=False))
    put(spark, folder, "b.json", "﻿ \n" + json.dumps(sets["b"], indent=3) + "\n")
    put(spark, folder, "c.json", json.dumps(sets["c"][0], separators=(",", ":")))  # one object
    put(spark, folder, "d.json", "[ ]")
    put(spark, folder, "e.json", " ")
    want = sorted(row for name, rows in sets.items() for row in expected(name, rows))
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("128m", "700"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = raw.read_raw_arrays(spark, folder, SCHEMA)
            assert found(got) == want
            if size == "700":
                blocks = raw._pieces(spark, folder).groupBy("file").agg({"block": "max"}).where("file like '%a.json'")
                assert blocks.first()[1] > 700  # the file is cut
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", default)


def test_damage_stays_in_its_place(spark):
    folder = scratch_path(spark, "damaged")
    rows = records(20, 4)
    put(spark, folder, "cut.json", json.dumps(rows)[:-30])
    put(spark, folder, "odd.json", '[{"id": 1, "text": "a"}, {"id": "x", "text": "b"}, {"id" 2}, {"id": 3, "text": "c"}]')
    got = raw.read_raw_arrays(spark, folder, SCHEMA)
    assert [r[:4] for r in found(got.where("source = 'odd'"))] == [("odd", 0, 1, "a"), ("odd", 3, 3, "c")]
    assert found(got.where("source = 'cut'")) == expected("cut", rows)[:19]
    assert sorted((r.source, r.pos) for r in raw.raw_failures(spark, folder, SCHEMA).collect()) == [("odd", 1), ("odd", 2)]
    assert raw.read_raw_arrays(spark, folder + "-none", SCHEMA).count() == 0 == raw.raw_failures(spark, folder + "-none", SCHEMA).count()
