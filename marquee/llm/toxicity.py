"""Toxicity by a classifier chain.

Three categories are predicted one after the other: `insult` (toxic, with a listed insult), `other_abuse`
(toxic, without one) and `toxic`. Each is a linear model over the log counts of selected words and word
beginnings, and the later models also get the logits of the earlier categories. In training these logits
are out-of-fold: each fold is predicted by a model that has not seen it, so a later model does not learn to
trust what an earlier one has memorised. The decision threshold is fixed on out-of-fold predictions.

The models are fitted on at most `SAMPLE` labelled documents (those with the least hash of doc_id); every
document is scored, over its whole text. Null text counts as empty. Labels without a value are left out; of
repeated labels the toxic one counts. If the labelled documents do not hold both classes, the probability is
the share of the toxic ones and no document is toxic. Repeated rows are scored each; all columns are carried
along. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import free, returned, slices
from marquee.session import checkpointed

#: Common English insults that name the category `insult`.
INSULTS = frozenset("clown disgusting fool idiot jerk loser moron pathetic scum stupid trash worthless".split())
CATEGORIES = ("insult", "other_abuse", "toxic")
SAMPLE = 4000
FEATURES = 1000
FOLDS = 5
BEGINNINGS = (4, 5, 6, 7)
PENALTY = 1.0
STEPS = 150
WORD = re.compile(r"\w+")
KEPT_WORDS = 150_000


def features_of(word: str) -> tuple[str, ...]:
    return (word, *[f"^{word[:k]}" for k in BEGINNINGS if len(word) > k])


def word_list(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(
    x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = STEPS, fed: np.ndarray | None = None, kept: np.ndarray | None = None
) -> np.ndarray:
    """Logistic regression with an L2 penalty by accelerated gradient steps; the last weight is the bias.

    fed: a few more columns, weighed after those of `x`. kept: the rows to fit on (True). Neither is copied together
    with `x`, which is most of what the driver's Python holds.
    """
    fed = np.empty((len(x), 0)) if fed is None else fed
    rows = np.ones(len(x)) if kept is None else kept.astype(float)
    k = x.shape[1]
    forth = lambda w: x @ w[:k] + fed @ w[k:-1] + w[-1]
    back = lambda r: np.r_[r @ x, r @ fed, r.sum()]
    probe = np.ones(k + fed.shape[1] + 1)
    for _ in range(12):
        probe = back(rows * forth(probe))
        probe /= np.linalg.norm(probe) or 1.0
    bound = 0.25 * np.linalg.norm(rows * forth(probe)) ** 2 * 1.05 + penalty
    w = ahead = np.zeros(len(probe))
    for i in range(steps):
        slope = back(rows * (sigmoid(forth(ahead)) - y)) + penalty * np.r_[ahead[:-1], 0.0]
        new = ahead - slope / bound
        ahead, w = new + i / (i + 3) * (new - w), new
    return w


@dataclass
class Chain:
    """A fitted chain: vocabulary, one weight vector per category, and the threshold of the last category."""

    vocabulary: dict[str, int] = field(default_factory=dict)
    weights: list[np.ndarray] = field(default_factory=list)
    threshold: float = 1.0
    share: float = 0.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Logits of all categories, earlier ones fed to later ones."""
        out = np.empty((len(x), 0))
        for w in self.weights:
            out = np.c_[out, np.c_[x, out] @ w[:-1] + w[-1]]
        return out


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap where F1 is best."""
    order = np.argsort(-p)
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    best = int(np.argmax(np.round(f1, 12)))
    below = p[order[best + 1]] if best + 1 < len(y) else 0.0
    return float((p[order[best]] + below) / 2)


def fit_chain(x: np.ndarray, labels: np.ndarray, folds: np.ndarray, vocabulary: dict[str, int]) -> Chain:
    """labels: a column per category, the last one decides."""
    decided = labels[:, -1] if len(labels) else np.zeros(0)
    if not len(decided) or decided.min() == decided.max():
        return Chain(share=float(decided.mean()) if len(decided) else 0.0)
    chain, fed = Chain(vocabulary), np.empty((len(x), 0))
    for c in range(labels.shape[1]):
        logits = lambda w: x @ w[: x.shape[1]] + fed @ w[x.shape[1] : -1] + w[-1]
        out_of_fold = np.empty(len(x))
        for f in np.unique(folds):
            held = folds == f
            w = fit_linear(x, labels[:, c], fed=fed, kept=~held) if (~held).any() else np.zeros(x.shape[1] + c + 1)
            out_of_fold[held] = logits(w)[held]
        chain.weights.append(fit_linear(x, labels[:, c], fed=fed))
        fed = np.c_[fed, out_of_fold]
    chain.threshold = best_threshold(sigmoid(fed[:, -1]), decided)
    return chain


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: documents and toxic documents with each feature."""
    every, toxic = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = {f for w in set(word_list(text)) for f in features_of(w)}
            every.update(found)
            if label:
                toxic.update(found)
    names = list(every)
    for at in range(0, len(names), 10_000):
        part = names[at : at + 10_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array([every[n] for n in part], pa.int64()), pa.array([toxic[n] for n in part], pa.int64())],
            names=["feature", "n", "n_toxic"],
        )


class Vectors:
    """Word lists -> log counts of the vocabulary's features."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary, self.known = vocabulary, {}

    def places(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > KEPT_WORDS:
                self.known.clear()
            found = self.known[word] = tuple(i for f in features_of(word) if (i := self.vocabulary.get(f)) is not None)
        return found

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.vocabulary)))
        for row, text in zip(out, texts):
            hits = [i for p in map(self.places, word_list(text)) for i in p]
            if hits:
                row += np.log1p(np.bincount(hits, minlength=len(row)))
        return out


def _vectorised(vocabulary: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors(vocabulary)
        for batch in slices(batches, 256):
            texts = batch.column(1).to_pylist()
            found = vectors(texts)
            insult = [bool(INSULTS.intersection(word_list(t))) for t in texts]
            places = [np.flatnonzero(r) for r in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(insult), pa.array([p.astype(np.int32) for p in places], pa.list_(pa.int32())),
                 pa.array([r[p].astype(np.float32) for r, p in zip(found, places)], pa.list_(pa.float32()))],
                names=["fold", "toxic", "insult", "places", "counts"],
            )

    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> Chain:
    """Fit the chain on at most `sample` labelled documents."""
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = F.xxhash64("doc_id", F.lit(3))
    chosen = marked.orderBy(order, "doc_id").limit(sample)
    known = checkpointed(
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # at most `sample` rows
        .select("text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(FOLDS)).cast("int").alias("fold"), "doc_id")
        .orderBy(order, "doc_id", F.xxhash64("text")).limit(sample)
    )
    totals = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).first()
    if not totals["n"] or totals["t"] in (0, totals["n"]):
        return Chain(share=(totals["t"] or 0) / totals["n"] if totals["n"] else 0.0)
    counts = known.select("text", "toxic").mapInArrow(_counts, "feature string, n long, n_toxic long").groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic")
    )
    in_toxic = (F.col("n_toxic") + 0.5) / (totals["t"] + 1)
    in_clean = (F.col("n") - F.col("n_toxic") + 0.5) / (totals["n"] - totals["t"] + 1)
    distance = F.abs(F.sqrt(in_toxic) - F.sqrt(in_clean))
    best = counts.where("n >= 3").orderBy(distance.desc(), "feature").limit(features).collect()
    vocabulary = {r["feature"]: i for i, r in enumerate(best)}
    rows = known.select("fold", "text", "toxic").mapInArrow(
        _vectorised(vocabulary), "fold int, toxic int, insult boolean, places array<int>, counts array<float>"
    ).toArrow().combine_chunks()  # at most `sample` rows of at most `features` numbers
    x = np.zeros((rows.num_rows, len(vocabulary)))
    for row, places, counts in zip(x, rows.column("places"), rows.column("counts")):
        row[places.values.to_numpy()] = counts.values.to_numpy()
    fold, toxic, insult = [rows.column(c).to_numpy() for c in ("fold", "toxic", "insult")]
    toxic, insult = toxic.astype(float), insult.astype(float)
    return fit_chain(x, np.c_[toxic * insult, toxic * (1 - insult), toxic], fold, vocabulary)


def _scorer(chain: Chain):
    """Chances of the categories and the verdict for a column of texts; only the texts go to Python."""
    names = [*[f"_p_{c}" for c in CATEGORIES], "_toxic"]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vectors = Vectors(chain.vocabulary)
        for texts in batches:
            parts = []
            for at in range(0, len(texts), 128):
                some = texts.iloc[at : at + 128].tolist()
                if chain.weights:
                    parts.append(sigmoid(chain.logits(vectors(some))))
                else:
                    parts.append(np.tile([0.0, 0.0, chain.share], (len(some), 1)))
            p = np.concatenate(parts) if parts else np.empty((0, len(CATEGORIES)))
            verdict = p[:, -1] >= chain.threshold if chain.weights else np.zeros(len(p), bool)
            yield pd.DataFrame({**{n: p[:, i] for i, n in enumerate(names[:-1])}, "_toxic": verdict})

    return F.pandas_udf(returned(run), ", ".join(f"{n} double" for n in names[:-1]) + ", _toxic boolean")


def scored(docs: DataFrame, chain: Chain) -> DataFrame:
    """All columns, `_p_<category>` for each category and `_toxic`. Columns of these names are replaced."""
    added = [*[f"_p_{c}" for c in CATEGORIES], "_toxic"]
    base = docs.drop(*added)
    (found,) = free(base, "_scores")
    marked = base.withColumn(found, _scorer(chain)(F.col("text")))
    return marked.select(*[F.col(f"`{c}`") for c in base.columns], *[F.col(f"{found}.{c}").alias(c) for c in added])


def without_toxic(docs: DataFrame, chain: Chain) -> DataFrame:
    """The documents that the chain does not find toxic; all columns stay as they are."""
    (found,) = free(docs, "_scores")
    marked = docs.withColumn(found, _scorer(chain)(F.col("text")))
    return marked.where(~F.col(f"{found}._toxic")).select(*[F.col(f"`{c}`") for c in docs.columns])
