"""Line dedup by a log-template tree.

A line is cut into tokens; tokens with a digit, an at sign or a link become the variable field `<*>`. The
tree has a fixed depth: token count, then the first three tokens. In a leaf, lines join the template they
agree with in at least 80 % of the places, and the places where they differ become variable fields. A
template that occurs in several documents is recurring: its first document (least doc_id) keeps its lines,
every other document loses them.

Recurring means two documents for lines of 10 tokens and more, and four for shorter ones; lines under three
tokens and templates with less than half of their places fixed are left alone. Lines are compared without
white space at their ends; empty ones always stay. Texts of any length are read whole, line by line. Null text stays null. Rows that repeat a whole document
row (doc_id and text) count as one document; an equal text under another doc_id is another document. All
other columns are carried along. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import free, returned, slices
from marquee.session import checkpointed, small

LEAST_TOKENS = 3
LEADING = 3
LONG_TOKENS = 10
LONG_DOCS, SHORT_DOCS = 2, 4
SIMILARITY = 0.8
LEAF_LINES = 2000
FIELD = "<*>"
VARIABLE = re.compile(r"[0-9@]|://")
KEY = ["k1", "k2"]


def masked_tokens(line: str) -> list[str]:
    """The tokens of a line, variable ones as the field."""
    tokens = line.split()
    if VARIABLE.search(line):
        return [FIELD if VARIABLE.search(t) else t for t in tokens]
    return tokens


def _keys(tokens: list[str]) -> tuple[int, int, int]:
    """64-bit hashes: leaf of the tree, and two of the whole line."""
    import xxhash

    whole = xxhash.xxh3_128_digest(" ".join(tokens))
    leaf = xxhash.xxh3_64_digest(f"{len(tokens)} {' '.join(tokens[:LEADING])}")
    return tuple(int.from_bytes(x, "little", signed=True) for x in (leaf, whole[:8], whole[8:]))


LINES = "doc_id long, tie long, line int, n int, fixed int, leaf long, k1 long, k2 long"


@returned
def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 512):
        out = []
        for doc, tie, text in zip(*[c.to_pylist() for c in batch.columns]):
            for i, line in enumerate((text or "").split("\n")):
                tokens = masked_tokens(line)
                if len(tokens) >= LEAST_TOKENS:
                    out.append((doc, tie, i, len(tokens), len(tokens) - tokens.count(FIELD), *_keys(tokens)))
        yield _batch(out, LINES)


def _batch(rows: list[tuple], kinds: str) -> pa.RecordBatch:
    names = {"long": pa.int64(), "int": pa.int32(), "array<string>": pa.list_(pa.string())}
    fields = [f.rsplit(" ", 1) for f in kinds.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, names[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")


def parsed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, tie (hash of the text), line (place in the text), n (tokens), fixed (of them), leaf, k1, k2."""
    return _rows(docs).mapInArrow(_parsed, LINES)


TOKENS = "leaf long, k1 long, k2 long, tokens array<string>"


@returned
def _wanted_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 512):
        out = []
        for text, wanted in zip(*[c.to_pylist() for c in batch.columns]):
            lines = text.split("\n")
            for i in wanted:
                tokens = masked_tokens(lines[i])
                out.append((*_keys(tokens), tokens))
        yield _batch(out, TOKENS)


def line_tokens(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """leaf, k1, k2, tokens of the lines in `wanted` (doc_id, tie, line)."""
    lists = small(wanted.groupBy("doc_id", "tie").agg(F.collect_set("line").alias("wanted"))).alias("w")
    d = _rows(docs).alias("d")
    met = d.join(lists, F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.tie") == F.col("w.tie")))
    return met.select("text", "wanted").mapInArrow(_wanted_tokens, TOKENS)


def parse(lines: list[list[str]]) -> tuple[list[int], list[list[str]]]:
    """Put the lines of one leaf (or block of it), frequent ones first, into templates.

    Returns, for each line, the line that began its template, and the templates by that line.
    """
    member, templates = [], {}
    if len(lines) <= 24:
        for i, line in enumerate(lines):
            best = max(templates, key=lambda b: (sum(map(str.__eq__, templates[b], line)), -b), default=None)
            if best is not None and sum(map(str.__eq__, templates[best], line)) >= SIMILARITY * len(line):
                templates[best] = [t if t == x else FIELD for t, x in zip(templates[best], line)]
                member.append(best)
            else:
                templates[i] = line
                member.append(i)
        return member, templates
    names: dict[str, int] = {FIELD: 0}
    coded = np.array([[names.setdefault(t, len(names)) for t in line] for line in lines], np.int32)
    words, begun, forms = list(names), [], np.empty_like(coded)
    for i, line in enumerate(coded):
        if begun:
            agree = (forms[: len(begun)] == line).sum(axis=1)
            best = int(agree.argmax())
            if agree[best] >= SIMILARITY * len(line):
                forms[best][forms[best] != line] = 0
                member.append(begun[best])
                continue
        forms[len(begun)] = line
        begun.append(i)
        member.append(i)
    return member, {b: [words[t] for t in forms[k]] for k, b in enumerate(begun)}


PARSED = "leaf long, k1 long, k2 long, n_docs long, t1 long, t2 long, tokens array<string>"


@returned
def _parse_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group, in a group frequent lines first; one group is held at a time."""

    def rows():
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in ("leaf", "group", "block", "k1", "k2", "n_docs", "tokens")])

    out = []
    for _, group in itertools.groupby(rows(), key=lambda r: r[:3]):
        held = list(group)
        member, forms = parse([r[6] for r in held])
        out += [(r[0], r[3], r[4], r[5], held[m][3], held[m][4], forms[m]) for r, m in zip(held, member)]
        if len(out) >= 5000:
            yield _batch(out, PARSED)
            out = []
    yield _batch(out, PARSED)


def _blocks(lines: DataFrame, turn: int, most: int) -> DataFrame:
    """Deal the lines of leaves with more than `most` lines to blocks: at first by key, then by the tokens of one
    segment after the leading ones, so that lines that agree in a segment meet; such a group stays whole."""
    sizes = lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("leaf_lines"))
    sized = lines.join(sizes, "leaf")
    by_key = F.when(F.col("leaf_lines") > most, F.pmod("k1", F.ceil(F.col("leaf_lines") / most))).otherwise(F.lit(0)).cast("long")
    if not turn:
        return sized.withColumn("group", F.lit(0).cast("long")).withColumn("block", by_key)
    at = lambda t: (F.floor(F.lit(t) * (F.size("tokens") - LEADING) / _segments("tokens")) + LEADING).cast("int")
    segment = F.xxhash64(F.slice("tokens", at(turn - 1) + 1, at(turn) - at(turn - 1)))
    grouped = sized.withColumn("group", F.when(F.col("leaf_lines") > most, segment).otherwise(F.lit(0).cast("long")))
    return grouped.withColumn("block", F.lit(0).cast("long"))


def _segments(tokens: str) -> Column:
    """One more than the places in which a line may differ from its template, so one segment is the same."""
    return F.floor(F.size(tokens) * F.lit(1 - SIMILARITY) + F.lit(1e-9)).cast("int") + 1


def templates(lines: DataFrame, most: int = LEAF_LINES) -> DataFrame:
    """(k1, k2) of distinct lines -> (t1, t2) of their template and its number of fixed places.

    A leaf of up to `most` distinct lines is parsed at once. A larger one is parsed in blocks, and the
    templates of the blocks are parsed again, dealt by each segment of their tokens in turn. There are more
    segments than places that may differ, so any two that the threshold joins meet.
    """
    found, current = None, lines
    for turn in itertools.count():
        dealt = _blocks(current, turn, most).select("leaf", "group", "block", *KEY, "n_docs", "tokens")
        sorted_ = dealt.repartition("leaf", "group", "block").sortWithinPartitions("leaf", "group", "block", F.col("n_docs").desc(), *KEY)
        result = checkpointed(sorted_.mapInArrow(_parse_groups, PARSED))
        step = result.select(*KEY, "t1", "t2", "tokens")
        if found is None:
            found = step
        else:
            moved = step.select(F.col("k1").alias("t1"), F.col("k2").alias("t2"), F.col("t1").alias("u1"), F.col("t2").alias("u2"), F.col("tokens").alias("later"))
            found = found.join(moved, ["t1", "t2"], "left").select(
                *KEY, F.coalesce("u1", "t1").alias("t1"), F.coalesce("u2", "t2").alias("t2"), F.coalesce("later", "tokens").alias("tokens")
            )
        counted = result.groupBy("leaf").agg(F.count(F.lit(1)).alias("c"), F.max(_segments("tokens")).alias("turns"))
        large = counted.where((F.col("c") > most) & (F.col("turns") > turn)).select("leaf")
        if not large.take(1):
            break
        begun = result.where("k1 = t1 and k2 = t2").select("leaf", *KEY, "n_docs", "tokens")
        current = checkpointed(begun.join(large, "leaf", "left_semi"))
    fixed = F.size(F.filter("tokens", lambda t: t != FIELD))
    return found.select(*KEY, "t1", "t2", fixed.alias("template_fixed"))


def recurring_lines(docs: DataFrame, most: int = LEAF_LINES) -> DataFrame:
    """doc_id, tie, line of every line to drop."""
    slim = checkpointed(parsed_lines(docs))
    doc = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie").alias("doc")
    found = slim.groupBy(*KEY, "leaf", "n", "fixed", "doc_id", "tie").agg(F.lit(1).alias("one"))
    keys = checkpointed(
        found.groupBy(*KEY, "leaf", "n", "fixed").agg(F.count(F.lit(1)).alias("n_docs"), F.min(doc).alias("first"))
    )
    leaves = keys.groupBy("leaf").agg(F.count(F.lit(1)).alias("leaf_keys")).where("leaf_keys > 1").select("leaf")
    shared = checkpointed(keys.join(leaves, "leaf", "left_semi").select(*KEY, "leaf", "n_docs", "first"))
    own = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie")
    at_first = slim.select("doc_id", "tie", "line", *KEY).join(shared.select(*KEY, "first"), KEY).where(own == F.col("first"))
    tokens = line_tokens(docs, at_first.groupBy(*KEY).agg(F.min(F.struct("doc_id", "tie", "line")).alias("at")).select("at.*"))
    words = tokens.dropDuplicates(KEY).join(shared.select(*KEY, "n_docs"), KEY)
    grouped = templates(words, most)
    several = grouped.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("t1", "t2")
    grouped = checkpointed(grouped.join(several, ["t1", "t2"], "left_semi"))
    together = (
        slim.join(grouped, KEY).groupBy("t1", "t2", "n", "template_fixed", "doc_id", "tie").agg(F.lit(1).alias("one"))
        .groupBy("t1", "t2", "n", "template_fixed").agg(F.count(F.lit(1)).alias("n_docs"), F.min(doc).alias("first"))
    )
    by_template = grouped.select(*KEY, "t1", "t2").join(together, ["t1", "t2"]).select(
        *KEY, "n", F.col("template_fixed").alias("fixed"), "n_docs", "first"
    )
    alone = keys.join(grouped.select(*KEY), KEY, "left_anti").select(*KEY, "n", "fixed", "n_docs", "first")
    needed = F.when(F.col("n") >= LONG_TOKENS, LONG_DOCS).otherwise(SHORT_DOCS)
    recurring = alone.unionByName(by_template).where((F.col("n_docs") >= needed) & (2 * F.col("fixed") >= F.col("n")))
    return (
        slim.select("doc_id", "tie", "line", *KEY)
        .join(recurring.select(*KEY, "first"), KEY)
        .where(own != F.col("first"))
        .select("doc_id", "tie", "line")
    )


def drop_recurring(docs: DataFrame, most: int = LEAF_LINES) -> DataFrame:
    """The documents without their recurring lines, all other columns as they are. Two more columns at the end count
    lines: `_lines` and `_dropped`, with underscores in front where the documents have columns of these names."""
    own, doc, tie, gone, n_lines, n_dropped = free(docs, "_own", "_doc", "_tie", "_gone", "_lines", "_dropped")
    dropped = recurring_lines(docs, most).groupBy("doc_id", "tie").agg(F.collect_set("line").alias(gone))
    right = small(dropped.select(F.col("doc_id").alias(doc), F.col("tie").alias(tie), gone))
    joined = docs.withColumn(own, F.xxhash64("text")).join(
        right, F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(tie)), "left"
    )
    lines = F.split("text", "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col(gone), i)), "\n")
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept)
    return joined.select(
        *[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.coalesce(F.size(lines), F.lit(0)).alias(n_lines),
        F.coalesce(F.size(gone), F.lit(0)).alias(n_dropped),
    )
