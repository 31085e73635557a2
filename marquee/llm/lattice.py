"""Document likelihood over all segmentations into subwords.

The pieces of an existing subword vocabulary and their scores weight a lattice: every way to spell a word
(with the mark of its beginning) by pieces is a path, its weight the product of the pieces' chances. A
forward recursion in log space sums all paths, so a word has its marginal chance whatever its segmentation.
Single bytes are pieces, so every text has one. The vocabulary's scores start the chances; expected piece
counts over all distinct training words (forward and backward, two rounds) fit them to each class of documents.

Words seen in training are arcs of their own: counts are kept for each class of documents (their
language). From a word's count a discount is taken (Kneser and Ney's estimate from the words seen once and
twice); what is taken is given out by the number of classes that hold a word, and what is taken from that by
the lattice. A document is drawn from one of the classes and ends by an end token; its score sums over the
classes, so the class of a document is not looked at where it is scored. Chances of all documents sum to one.

Distinct words are counted, taken through the lattice and scored once each, whatever the number of documents.
Words of bounded length that make up at least one of `HEAD_WORDS` of all words, so at most that many, are
broadcast; the others, none of them frequent, are joined.

Null texts are empty: an end token alone. Rows that repeat each have their score, and each count in training. A
null doc_id counts as the empty text where documents are held out. An empty table gives an empty result. Texts and
words of any length are read whole. Columns other than doc_id, text and the class are not looked at; without a class
column there is one class.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import slices
from marquee.session import checkpointed

CLASSES = 8
HEAD_WORDS = 1_000_000
HEAD_BYTES = 64
HELD_WORDS = 200_000
ROUNDS = 2
PRIOR = 1_000.0
BYTE_SHARE = 0.001
CELLS = 2_000_000


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes, a blank for the beginning of a word, and the logarithm of their chances by their scores.

    Whole-number scores are ranks (of merges) and weigh by Zipf's law; others are taken as logarithms of chances.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weight: dict[bytes, float] = {bytes([b]): 0.0 for b in range(256)}
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    scores = {i: model.get_score(i) for i in ids if not model.is_byte(i)}
    ranked = all(s == int(s) for s in scores.values())
    for i, score in scores.items():
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        weight[piece] = weight.get(piece, 0.0) + (1 / (3 - score) if ranked else np.exp(score))
    pieces = sorted(weight)
    w = np.array([weight[p] for p in pieces])
    single = np.array([len(p) == 1 for p in pieces])
    w = (1 - BYTE_SHARE) * w / w.sum() + BYTE_SHARE * single / single.sum()
    return pieces, np.log(w)


class Lattice:
    """The pieces as a tree of bytes that many words walk at once."""

    def __init__(self, pieces: list[bytes]):
        children: list[dict[int, int]] = [{}]
        piece_at = [-1]
        for k, piece in enumerate(pieces):
            node = 0
            for b in piece:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                    piece_at.append(-1)
                node = children[node][b]
            piece_at[node] = k
        order = sorted(range(len(children)), key=lambda n: (not children[n], n))  # nodes that go on come first; the root is the first
        place = {n: i for i, n in enumerate(order)}
        self.inner = sum(bool(c) for c in children)
        self.next = np.zeros((max(1, self.inner), 256), np.int32)
        for n in order[: self.inner]:
            for b, to in children[n].items():
                self.next[place[n], b] = place[to]
        self.piece = np.array([piece_at[n] for n in order])

    def _arcs(self, text: np.ndarray, longer: np.ndarray, i: int):
        """(end, words, pieces) of the arcs that begin at byte `i`; words are sorted by falling length."""
        words, node, end = np.arange(longer[i]), np.zeros(longer[i], np.int64), i
        while len(words):
            node = self.next[node, text[end, words]]
            end += 1
            on = node > 0
            words, node = words[on], node[on]
            piece = self.piece[node]
            is_piece = piece >= 0
            if is_piece.any():
                yield end, words[is_piece], piece[is_piece]
            if end >= len(longer):
                return
            go = (node < self.inner) & (words < longer[end])
            words, node = words[go], node[go]

    @staticmethod
    def _groups(words: list[bytes]):
        """Words by falling length in groups of bounded size: places, bytes by position, number of longer words."""
        sizes = np.array([len(w) + 1 for w in words])
        order, at = np.argsort(-sizes, kind="stable"), 0
        while at < len(order):
            most = sizes[order[at]]
            own = order[at : at + max(1, CELLS // int(most))]
            text = np.zeros((most, len(own)), np.uint8)
            text[0] = 32
            for column, k in enumerate(own):
                text[1 : sizes[k], column] = np.frombuffer(words[k], np.uint8)
            longer = np.searchsorted(-sizes[own], -np.arange(most), side="left")
            yield own, sizes[own], text, longer
            at += len(own)

    def _forward(self, text: np.ndarray, longer: np.ndarray, logs: np.ndarray) -> np.ndarray:
        most, n = text.shape
        alpha = np.full((most + 1, n, logs.shape[1]), -np.inf)
        alpha[0] = 0
        for i in range(most):
            for end, words, piece in self._arcs(text, longer, i):
                alpha[end, words] = np.logaddexp(alpha[end, words], alpha[i, words] + logs[piece])
        return alpha

    def marginals(self, words: list[bytes], logs: np.ndarray) -> np.ndarray:
        """Logarithm of the chance of each word over all its segmentations, by each column of the pieces' `logs`."""
        out = np.empty((len(words), logs.shape[1]))
        for own, sizes, text, longer in self._groups(words):
            out[own] = self._forward(text, longer, logs)[sizes, np.arange(len(own))]
        return out

    def expected(self, words: list[bytes], logs: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words, each taken once; `logs` has one column."""
        counts = np.zeros(len(logs))
        for own, sizes, text, longer in self._groups(words):
            alpha = self._forward(text, longer, logs)[:, :, 0]
            columns = np.arange(len(own))
            total = alpha[sizes, columns]
            beta = np.full(alpha.shape, -np.inf)
            beta[sizes, columns] = 0
            for i in range(len(text) - 1, -1, -1):
                for end, at, piece in self._arcs(text, longer, i):
                    rest = logs[piece, 0] + beta[end, at]
                    beta[i, at] = np.logaddexp(beta[i, at], rest)
                    counts += np.bincount(piece, np.exp(alpha[i, at] + rest - total[at]), len(counts))
        return counts


def _expected(pieces: list[bytes], logs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, counts = Lattice(pieces), np.zeros(logs.value.shape)
        for batch in batches:
            words = batch.column(0).cast(pa.binary()).to_pylist()
            for z in range(counts.shape[1]):
                own = np.flatnonzero(np.asarray(batch.column(1 + z), np.int64))
                counts[:, z] += lattice.expected([words[i] for i in own], logs.value[:, z : z + 1])
        lists = pa.array(counts.tolist(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts)), pa.int32()), lists], names=["piece", "times"])

    return run


def fitted(words: DataFrame, pieces: list[bytes], logs: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The pieces' log chances in each class, fitted to its distinct training words (word, and a count for each class).

    What the vocabulary's scores said counts as `PRIOR` pieces.
    """
    spark, k, prior = words.sparkSession, len(words.columns) - 1, np.exp(logs)[:, None]
    logs = np.repeat(logs[:, None], k, axis=1)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(logs)
        parts = words.mapInArrow(_expected(pieces, sent), "piece int, times array<double>")
        found = parts.groupBy("piece").agg(*[F.sum(F.col("times")[z]).alias(f"t{z}") for z in range(k)]).collect()  # the pieces of the vocabulary
        counts = np.zeros(logs.shape)
        for r in found:
            counts[r["piece"]] = r[1:]
        logs = np.log((counts + PRIOR * prior) / (counts.sum(axis=0) + PRIOR))
    return logs


class Counts:
    """Discounted chances of one class (or all): what a word of count c has, and what is left for the level below."""

    def __init__(self, words: int, distinct: int, once: int, twice: int, docs: int, below_end: float | None):
        self.discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5
        self.left = np.log(self.discount * distinct + 1)
        spare = 2 if below_end is None else 1  # the lowest level has one end token more
        self.total = np.log(words + docs + spare)
        self.end = (docs + 1) / (words + docs + 2) if below_end is None else (docs + np.exp(self.left) * below_end) / (words + docs + 1)

    def logs(self, c: np.ndarray, below: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(np.maximum(c - self.discount, 0)), self.left + below) - self.total


def _scored(pieces: list[bytes], logs, every: Counts, classes: list[Counts], base_total: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces)
        for batch in batches:
            if not batch.num_rows:
                continue
            c = np.stack([np.asarray(batch.column(2 + z), np.float64) for z in range(len(classes))], axis=1)
            total = c.sum(axis=1)
            spelt = lattice.marginals(batch.column(0).cast(pa.binary()).to_pylist(), logs.value)
            lp = np.stack([k.logs(c[:, z], every.logs((c > 0).sum(axis=1), spelt[:, z])) for z, k in enumerate(classes)], axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(lp) + 1) * len(classes), pa.int32()), pa.array(lp.ravel()))
            columns = [batch.column(0), batch.column(1), pa.array(total > 0), pa.array(np.log10((total + 0.1) / base_total)), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "times", "known", "base", "lp"])

    return run


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of other bytes than blanks and U+0009 to U+000D, with A-Z in lower case (of bytes, these methods see ASCII only)."""
    return (text or b"").lower().split()


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, z, n: counts of a task's documents, passed on whenever many different words have come together."""
    held: dict[int, Counter] = {}

    def out(z: int) -> pa.RecordBatch:
        counts = held.pop(z)
        columns = [pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(np.full(len(counts), z, np.int32)), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "z", "n"])

    for batch in slices(batches, 64):
        for z, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            held.setdefault(z, Counter()).update(words_of(text))
        if sum(map(len, held.values())) > HELD_WORDS:
            yield out(max(held, key=lambda z: len(held[z])))
    for z in list(held):
        yield out(z)


def _counted(head, k: int, ids: pa.DataType):
    """A row for each document with what its frequent words sum to, and one for each other distinct word."""
    names = ["doc_id", "tie", "held_out", "word", "times", "n_tokens", "n_known", "base", "lp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known, base, lp = head.value
        place = {w: i for i, w in enumerate(words)}
        for batch in slices(batches, 64):
            out: list[list] = [[] for _ in names]
            doc_ids, ties, held, texts = (c.to_pylist() for c in (batch.column(0), batch.column(1), batch.column(2), batch.column(3).cast(pa.binary())))
            for doc_id, tie, held_out, text in zip(doc_ids, ties, held, texts):
                counts = Counter(words_of(text))
                at, times, rest = [], [], []
                for w, n in counts.items():
                    i = place.get(w)
                    if i is None:
                        rest.append((w, n))
                    else:
                        at.append(i)
                        times.append(n)
                at, times = np.array(at, np.int64), np.array(times, np.float64)
                own = [doc_id, tie, held_out, None, 0, counts.total(), int(times @ known[at]), float(times @ base[at]), (times @ lp[at]).tolist()]
                for column, value in zip(out, own):
                    column.append(value)
                for column, value in zip(out, (doc_id, tie, held_out)):
                    column.extend([value] * len(rest))
                out[3].extend(w for w, _ in rest)
                out[4].extend(n for _, n in rest)
                for column in out[5:]:
                    column.extend([None] * len(rest))
            kinds = [ids, pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64())]
            columns = [pa.array(c, t) for c, t in zip(out, kinds)]
            columns[3] = columns[3].cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _classes(docs: DataFrame, held_out: Column, column: str | None) -> tuple[Column, list[int]]:
    """Class number of a document, and the number of training documents of each; small classes share the last one."""
    if column is None or column not in docs.columns:
        return F.lit(0), [docs.where(~held_out).count()]
    kinds = docs.where(~held_out).groupBy(F.col(f"`{column}`").cast("string").alias("c")).agg(F.count(F.lit(1)).alias("n"))
    top = kinds.orderBy(F.col("n").desc(), F.col("c").asc_nulls_last()).limit(CLASSES).collect()
    number, sizes = F.lit(len(top)), [r["n"] for r in top]
    for z, r in enumerate(top):
        number = F.when(F.col(f"`{column}`").cast("string").eqNullSafe(F.lit(r["c"])), z).otherwise(number)
    rest = (kinds.agg(F.sum("n")).first()[0] or 0) - sum(sizes)
    return number, [*sizes, rest]


def likelihoods(docs: DataFrame, path: str, held_out: Column, column: str | None = "lang") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each document.

    Learns from the documents that are not `held_out`. score: log10 of the document's chance. base_score: the same of
    single words with 0.1 added to each count.
    """
    spark = docs.sparkSession
    kind, sizes = _classes(docs, held_out, column)
    k, train_docs = len(sizes), sum(sizes)
    parts = docs.select(F.when(~held_out, kind).otherwise(-1).cast("int").alias("z"), F.col("text").cast("string").alias("text"))
    parts = parts.mapInArrow(_occurrences, "word string, z int, n long")
    sums = [F.sum(F.when(F.col("z") == z, F.col("n")).otherwise(0)).alias(f"c{z}") for z in range(k)]
    words = checkpointed(parts.groupBy("word").agg(F.sum("n").alias("times"), *sums))

    every = sum(F.col(f"c{z}") for z in range(k))
    in_classes = sum((F.col(f"c{z}") > 0).cast("long") for z in range(k))
    facts = lambda c, name: [
        F.sum(c).alias(f"{name}_words"), F.count_if(c > 0).alias(f"{name}_distinct"), F.count_if(c == 1).alias(f"{name}_once"), F.count_if(c == 2).alias(f"{name}_twice")
    ]
    found = words.agg(F.sum("times").alias("times"), F.sum(every).alias("all"), *facts(in_classes, "in"), *[f for z in range(k) for f in facts(F.col(f"c{z}"), f"c{z}")]).first().asDict()
    number = lambda name: [found[f"{name}_{x}"] or 0 for x in ("words", "distinct", "once", "twice")]
    low = Counts(*number("in"), sum(s > 0 for s in sizes), None)
    classes = [Counts(*number(f"c{z}"), sizes[z], low.end) for z in range(k)]
    n, v = (found["all"] or 0) + train_docs, found["in_distinct"] + (train_docs > 0)
    base_total = n + 0.1 * (v + 1)

    pieces, logs = vocabulary(path)
    sent = spark.sparkContext.broadcast(fitted(words.where(every > 0).drop("times"), pieces, logs))
    scored = words.mapInArrow(_scored(pieces, sent, low, classes, base_total), "word string, times long, known boolean, base double, lp array<double>")
    scored = checkpointed(scored)

    frequent = (F.col("times") * HEAD_WORDS >= (found["times"] or 0)) & (F.octet_length("word") <= HEAD_BYTES)
    top = scored.where(frequent).collect()  # at most HEAD_WORDS, as their shares sum to one at most
    head = spark.sparkContext.broadcast((
        [r["word"].encode() for r in top],
        np.array([r["known"] for r in top], np.float64),
        np.array([r["base"] for r in top], np.float64),
        np.array([r["lp"] for r in top], np.float64).reshape(-1, k),
    ))
    ids = docs.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = f"doc_id {ids.simpleString()}, tie long, held_out boolean, word string, times long, n_tokens long, n_known long, base double, lp array<double>"
    asked = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), held_out.alias("held_out"), "text")
    counted = checkpointed(asked.mapInArrow(_counted(head, k, to_arrow_type(ids)), schema))

    each = [F.col("lp")[z].alias(f"l{z}") for z in range(k)]
    frequent = counted.where("word is null").select("doc_id", "tie", "held_out", F.lit(1).alias("rows"), "n_tokens", "n_known", "base", *each)
    other = counted.where("word is not null").select("doc_id", "tie", "held_out", "word", F.col("times").alias("t")).join(scored, "word")
    other = other.select(
        "doc_id", "tie", "held_out", F.lit(0).alias("rows"), F.lit(0).cast("long").alias("n_tokens"), F.when(F.col("known"), F.col("t")).otherwise(0).alias("n_known"),
        (F.col("t") * F.col("base")).alias("base"), *[(F.col("t") * F.col("lp")[z]).alias(f"l{z}") for z in range(k)],
    )
    added = frequent.unionByName(other).groupBy("doc_id", "tie", "held_out").agg(F.sum("rows").alias("rows"), *[F.sum(c).alias(c) for c in frequent.columns[4:]])
    ends = [np.log((sizes[z] + 1) / (train_docs + k)) + np.log(classes[z].end) for z in range(k)]
    of_class = [F.col(f"l{z}") / F.col("rows") + F.lit(float(ends[z])) for z in range(k)]
    most = F.greatest(*of_class) if k > 1 else of_class[0]
    summed = most + F.log(sum(F.exp(x - most) for x in of_class))
    end_base = float(np.log10(((train_docs or 0) + 0.1) / base_total))
    one = added.select(
        "doc_id", "held_out",
        (F.col("n_tokens") / F.col("rows")).cast("long").alias("_t"), (F.col("n_known") / F.col("rows")).cast("long").alias("_k"),
        (F.col("base") / F.col("rows") + F.lit(end_base)).alias("base_score"),
        (summed / F.lit(float(np.log(10)))).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("_row"),
    )
    known_end = 1 if train_docs else 0
    return one.select(
        "doc_id", "held_out", (F.col("_t") + 1).alias("n_tokens"), (F.col("_k") + known_end).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), "base_score", "score",
    )
