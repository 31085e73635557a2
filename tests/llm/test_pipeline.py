import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from marquee.llm import line_templates, order_minhash
from marquee.session import scratch_path
from tests.conftest import SMALL


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        seen[name] = (docs, after)
        if name != "packing":
            assert after.columns == columns and after.dtypes == docs.dtypes
        docs = after
    before, after = seen["toxicity"]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    gone = before.join(after, "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.where("toxic = 0").count() <= 1 and after.join(labels.where("toxic = 1"), "doc_id").count() <= 1
    before, after = seen["line dedup"]
    assert before.count() == after.count()
    assert line_templates.recurring_lines(before).count() > 0
    before, after = seen["near-dedup"]
    classes = order_minhash.near_classes(before).select("class_id").distinct().count()
    assert after.count() == classes and before.join(after, ["doc_id", "text"], "left_semi").count() == after.count()
    before, after = seen["mixing"]
    assert after.join(before, ["doc_id", "text"], "left_anti").count() == 0
    assert after.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    before, after = seen["packing"]
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = sum(len(plain.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in before.collect())
    assert after.agg(F.sum("length")).first()[0] == tokens


def test_run(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.count() > 0 and rows.columns[:3] == ["doc_id", "start", "length"]


def test_own_columns_come_through(spark):
    """Columns named like the stages' own helpers keep their values in every stage but the last."""
    names = "_own _doc _tie _gone _lines _dropped _toxic _scores _p_toxic _copy _position _own_tie tie doc node word copy position line size rows".split()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    wide = docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, wide, SMALL)
        assert after.columns == wide.columns, name
        rows = after.collect()
        assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names), name
    assert corpus_pipeline.STAGES[-1][1](spark, wide, SMALL).count() > 0
    counted = line_templates.drop_recurring(wide)
    assert counted.columns[-2:] == ["__lines", "__dropped"] and counted.where("__lines > 0").count() > 0
