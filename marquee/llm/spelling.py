"""Spelling variants by permuterm rotations.

A word is ended by a mark that no word holds, and all rotations of the marked word are sorted. A rotation
that ends in the character edited shows what is left of the word as its prefix: words that differ in that
character alone share the prefix, and so does the whole rotation of the word without it. So equal prefixes
lie side by side, and a scan of the sorted table sees a word's neighbours by a replacement, an insertion or
a deletion together. A prefix is shared by at most one whole rotation and one word for each letter of the
alphabet, so a scan group is bounded. Of a run of equal characters only the first counts as deleted; so each
pair of near words meets in exactly one group, counts add up, and no pairs are stored: a group tells each
of its words how many others it has and which of them is most frequent.

Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. Null texts hold no words; a
null doc_id counts as the empty text where words are cut by hash. An empty table gives an empty result; repeated
rows count each. Texts of any length are read whole; a word of L letters takes L rotations of L letters, which
spill to disk where they are long. Other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import pieces_for
from marquee.session import checkpointed

MARK = "\x01"
LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROTATIONS_EACH = 1_000_000


def runs(docs: DataFrame, least: int = 1) -> DataFrame:
    """doc_id (text) and each run of at least `least` letters, with A-Z in lower case."""
    found = F.regexp_extract_all(F.translate(F.col("text").cast("string"), UPPER, LOWER), F.lit(LETTERS), F.lit(0))
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select(id_text.alias("id"), F.explode(F.filter(found, lambda r: F.length(r) >= least)).alias("run"))


def with_deletions(words: DataFrame, every: int) -> Column:
    """The run, without one of its letters where `every` divides the crc32 of "<id>:<run>"."""
    h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "utf-8"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    return words.withColumn("h", h).withColumn("at", at).select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def word_counts(words: DataFrame, shortest: int, least: int) -> DataFrame:
    """word, n: distinct words of at least `shortest` letters that occur at least `least` times."""
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def rotations(counts: DataFrame) -> DataFrame:
    """key, x, lead, n: every rotation of the marked word, whole (x is empty) and split before its last letter x.

    The word is what follows the mark in the key, then x, then what stands before the mark. `lead`: x is the first of
    its run of equal letters.
    """
    length = F.length("word")
    turned = counts.select("word", "n", F.explode(F.sequence(F.lit(0), 2 * length)).alias("j"))
    split_at = F.when(F.col("j") > length, F.col("j") - length - 1)  # the letter edited; null: the whole rotation
    turned = turned.withColumn("i", split_at)
    behind = F.expr("substring(word, coalesce(i + 2, j + 1))")
    before = F.expr("substring(word, 1, coalesce(i, j))")
    x = F.coalesce(F.expr("substring(word, i + 1, 1)"), F.lit(""))
    lead = F.coalesce((F.col("i") == 0) | (F.expr("substring(word, i + 1, 1)") != F.expr("substring(word, i, 1)")), F.lit(False))
    return turned.select(F.concat(behind, F.lit(MARK), before).alias("key"), x.alias("x"), lead.alias("lead"), "n")


def scanned(sorted_rotations: DataFrame) -> DataFrame:
    """word, near, best: a row for each word of a scan group that has others; best is (-n, word) of the most frequent other."""
    whole = F.col("x") == ""
    scan = Window.partitionBy("key").orderBy("x")
    group = scan.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = F.struct((-F.col("n")).alias("n"), F.col("x").alias("x"))
    best = lambda holds: F.min(F.when(holds, other)).over(group)
    seen = sorted_rotations.select(
        "key", "x", "lead", "n",
        F.count_if(~whole).over(group).alias("_split"),
        F.count_if(F.col("lead")).over(group).alias("_lead"),
        F.max(F.when(whole, F.col("n"))).over(group).alias("_whole_n"),
        F.slice(F.sort_array(F.collect_list(F.when(~whole, other)).over(group)), 1, 2).alias("_two"),  # one row a letter at most
        best(F.col("lead")).alias("_best_lead"),
    )
    first, second = F.get("_two", F.lit(0)), F.get("_two", F.lit(1))
    beside = F.when(first["x"] == F.col("x"), second).otherwise(first)
    without = F.when(F.col("lead") & F.col("_whole_n").isNotNull(), F.struct((-F.col("_whole_n")).alias("n"), F.lit("").alias("x")))
    seen = seen.select(
        "key", "x",
        F.when(whole, F.col("_lead")).otherwise(F.col("_split") - 1 + without.isNotNull().cast("int")).alias("near"),
        F.when(whole, F.array("_best_lead")).otherwise(F.filter(F.array(beside, without), lambda o: o.isNotNull())).alias("others"),
    ).where(F.col("near") > 0)
    tail, head = F.substring_index("key", MARK, -1), F.substring_index("key", MARK, 1)
    spelt = lambda x: F.concat(tail, x, head)
    return seen.select(
        spelt(F.col("x")).alias("word"),
        F.col("near").cast("long").alias("near"),
        F.array_min(F.transform("others", lambda o: F.struct(o["n"].alias("n"), spelt(o["x"]).alias("word")))).alias("best"),
    )


def neighbours(counts: DataFrame) -> DataFrame:
    """word, n, n_near, best (-n, word): how many words differ by one letter, and the most frequent of them."""
    letters = counts.agg(F.sum(2 * F.length("word") + 1)).first()[0]
    turned = rotations(counts).repartitionByRange(pieces_for(letters or 0, ROTATIONS_EACH, 12), "key").sortWithinPartitions("key", "x")
    found = scanned(turned)
    own = counts.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast(found.schema["best"].dataType).alias("best"))
    every = own.unionByName(found.withColumn("n", F.lit(None).cast("long")))
    return every.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame, largest: int, times: int) -> DataFrame:
    """word, root: where following the forms (word, form) ends. Each step multiplies n by `times`, so pointers double
    a number of rounds that grows with the logarithm of the logarithm of `largest`."""
    steps = max(1, math.floor(math.log(max(largest, times), times)) + 1)
    found = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        on = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        found = checkpointed(found.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
    return found


def variants(docs: DataFrame, shortest: int = 7, least: int = 2, every: int = 31, times: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of `docs` (doc_id, text).

    form: the most frequent near word (the first in code-point order of equally frequent ones) if it occurs at least
    `times` as often as the word. root: the last word that following the forms leads to.
    """
    counts = checkpointed(word_counts(with_deletions(runs(docs, shortest), every), shortest, least))
    form = (F.col("best").isNotNull()) & (-F.col("best.n") >= times * F.col("n"))
    found = neighbours(counts).select(
        "word", "n", "n_near", F.when(form, F.col("best.word")).alias("form"), F.when(form, -F.col("best.n")).alias("form_n")
    )
    found = checkpointed(found)
    largest = found.agg(F.max("n")).first()[0] or 0
    last = roots(found.where(F.col("form").isNotNull()).select("word", "form"), largest, times)
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
