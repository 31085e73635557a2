"""Text rules against plain Python."""

import re
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.functions import text


def folded(s: str) -> str:
    s = "".join(c for c in unicodedata.normalize("NFD", s) if not "̀" <= c <= "ͯ").lower()
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9_\s]", " ", s)).strip()


@given(st.lists(st.text(st.characters(max_codepoint=0x24F), max_size=30), min_size=20, max_size=60))
@settings(max_examples=10, deadline=None)
def test_normalize_text(spark, values):
    df = spark.createDataFrame([(v.replace("\x00", ""),) for v in values], "s string")
    for s, n in df.select("s", text.normalize_text(F.col("s")).alias("n")).collect():
        assert n == folded(s)


def test_titles_without_latin_letters_keep_apart(spark):
    df = spark.createDataFrame([("東京",), ("大阪",), ("",)], "t string")
    ids = [r[0] for r in df.select(text.event_id(F.lit("x"), F.col("t"), F.lit("2026-01-01"))).collect()]
    assert len(set(ids)) == 3 and all(len(i) == 16 for i in ids)


def test_edges(spark):
    row = spark.createDataFrame([("  a   b\n", None)], "a string, b string").select(
        text.clean(F.col("a")), text.clean(F.col("b")), F.size(text.split_names(F.col("b"))), text.strip(F.col("a"))
    ).first()
    assert tuple(row) == ("a b", "", 0, "a   b")
