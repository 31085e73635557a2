import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import lattice
from marquee.llm.queries import QUERIES, subword_path
from tests.conftest import MEDIUM

PIECES = [b" ", b" a", b" ab", b"a", b"b", b"ab", b"ba", b"aab", b"c"]
CHANCES = np.array([0.2, 0.1, 0.1, 0.15, 0.15, 0.1, 0.1, 0.05, 0.05])
WORDS = [b"a", b"ab", b"abab", b"aabba", b"cab", b"bbbb", b"aabaab", b"c" * 30, b""]


def segmentations(text):
    if not text:
        yield ()
    for k, piece in enumerate(PIECES):
        if text.startswith(piece):
            for rest in segmentations(text[len(piece) :]):
                yield (k, *rest)


def test_marginals_and_expected_counts_as_all_segmentations():
    tree = lattice.Lattice(PIECES)
    other = CHANCES[::-1]
    logs = np.log(np.c_[CHANCES, other])
    got = tree.marginals(WORDS, logs)
    expected = np.zeros(len(PIECES))
    for w, found in zip(WORDS, got):
        paths = list(segmentations(b" " + w))
        chances = [math.prod(CHANCES[k] for k in p) for p in paths]
        assert np.exp(found) == pytest.approx([sum(chances), sum(math.prod(other[k] for k in p) for p in paths)])
        for p, c in zip(paths, chances):
            np.add.at(expected, list(p), c / sum(chances))
    assert tree.expected(WORDS, logs[:, :1]) == pytest.approx(expected)


def test_groups_do_not_matter(monkeypatch):
    tree, logs = lattice.Lattice(PIECES), np.log(CHANCES)[:, None]
    whole = tree.marginals(WORDS, logs), tree.expected(WORDS, logs)
    monkeypatch.setattr(lattice, "CELLS", 8)
    assert np.allclose(whole[0], tree.marginals(WORDS, logs)) and np.allclose(whole[1], tree.expected(WORDS, logs))


def test_chances_of_words_sum_to_one():
    """A word ends where the next piece begins a word: words up to a length hold all but a geometric rest."""
    tree, logs = lattice.Lattice(PIECES), np.log(CHANCES)[:, None]
    words = [bytes(w) for n in range(9) for w in itertools.product(b"abc", repeat=n)]
    total = np.exp(tree.marginals(words, logs)).sum()
    assert 0.9 < total < 1
    counts = Counter({b"ab": 5, b"c": 1, b"ba": 2})
    low = lattice.Counts(3, 3, 3, 0, 1, None)
    level = lattice.Counts(8, 3, 1, 1, 4, low.end)
    spelt = tree.marginals(words, logs)[:, 0]
    c = np.array([counts[w] for w in words], float)
    below = low.logs((c > 0).astype(float), spelt)
    everything = np.exp(level.logs(c, below)).sum() + level.end
    rest = (1 - total) * np.exp(low.left - low.total) * np.exp(level.left - level.total)
    assert everything + rest == pytest.approx(1)


def test_no_underflow():
    tree = lattice.Lattice(PIECES)
    word = b"ab" * 5000
    assert -1e5 < tree.marginals([word], np.log(CHANCES)[:, None])[0, 0] < -1000


def plainly(rows, pieces, logs_of, held):
    """The scores with dictionaries, of rows (doc_id, text, lang); logs_of: log chance of a word's spelling in a class."""
    tokens = lambda t: [w for w in (t or "").encode().lower().split()]
    classes = Counter(lang for i, _, lang in rows if not held(i))
    names = sorted(classes, key=lambda c: (-classes[c], c is None, c or ""))
    counts = {z: Counter(w for i, t, lang in rows if not held(i) and lang == z for w in tokens(t)) for z in names}
    every = sum(counts.values(), Counter())
    n, v = every.total() + sum(classes.values()), len(every) + 1
    level = lambda c, docs, below: lattice.Counts(sum(c.values()), len(c), sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values()), docs, below)
    spread = Counter(w for z in names for w in counts[z])
    low = level(spread, len(names), None)
    levels = [level(counts[z], classes[z], low.end) for z in names] + [level(Counter(), 0, low.end)]
    out = {}
    for i, text, _ in rows:
        words = tokens(text)
        base = sum(math.log10((every[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words) + math.log10((sum(classes.values()) + 0.1) / (n + 0.1 * (v + 1)))
        parts = []
        for z, k in enumerate(levels):
            docs = classes[names[z]] if z < len(names) else 0
            own = counts[names[z]] if z < len(names) else Counter()
            sums = [k.logs(np.array([float(own[w])]), low.logs(np.array([float(spread[w])]), np.array([logs_of(w, z)])))[0] for w in words]
            parts.append(math.log((docs + 1) / (sum(classes.values()) + len(levels))) + math.log(k.end) + sum(sums))
        most = max(parts)
        score = (most + math.log(sum(math.exp(p - most) for p in parts))) / math.log(10)
        out[i] = (held(i), len(words) + 1, sum(every[w] > 0 for w in words) + 1, n, base, score)
    return out


@pytest.mark.parametrize("head", [1, 10**6])
def test_likelihoods_as_plain_code(spark, documents, monkeypatch, head):
    """With all words joined, and with all words broadcast."""
    monkeypatch.setattr(lattice, "HEAD_WORDS", head)
    monkeypatch.setattr(lattice, "HELD_WORDS", 500)
    trained = {}
    fit = lattice.fitted
    monkeypatch.setattr(lattice, "fitted", lambda *a: trained.setdefault("logs", fit(*a)))
    docs = documents.where("length(text) < 3000").select("doc_id", "text", "lang").limit(60).cache()
    held_out = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 10 == 0
    got = {r.doc_id: tuple(r)[1:] for r in lattice.likelihoods(docs, subword_path(), held_out).collect()}
    pieces, _ = lattice.vocabulary(subword_path())
    tree = lattice.Lattice(pieces)
    spelt = {}

    def logs_of(word, z):
        if word not in spelt:
            spelt[word] = tree.marginals([word], trained["logs"])[0]
        return spelt[word][z]

    want = plainly([tuple(r) for r in docs.collect()], pieces, logs_of, lambda i: zlib.crc32(str(i).encode()) % 10 == 0)
    assert set(got) == set(want)
    for i, w in want.items():
        assert got[i][:4] == w[:4] and got[i][4:] == pytest.approx(w[4:], rel=1e-9)


def test_held_out_texts_are_likelier_than_by_single_words(spark):
    rows = QUERIES["op12_subword_lattice"](spark, MEDIUM).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) and all(r.score < 0 for r in rows)


def test_nothing_is_learnt_from_held_out_texts(spark, documents):
    docs = documents.select("doc_id", "text", "lang").limit(80)
    held_out = F.col("doc_id") % 4 == 0
    other = docs.withColumn("text", F.when(held_out, F.lit("zzyzx qwfp")).otherwise(F.col("text")))
    a, b = ({r.doc_id: (r.score, r.base_score) for r in lattice.likelihoods(d, subword_path(), held_out).where("not held_out").collect()} for d in (docs, other))
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], rel=1e-9) for i in a)


def test_odd_rows(spark, odd_docs, no_docs):
    held_out = F.coalesce(F.col("doc_id"), F.lit(0)) % 3 == 0
    rows = lattice.likelihoods(odd_docs, subword_path(), held_out).collect()
    assert len(rows) == odd_docs.count()
    found = {r.doc_id: r for r in rows}
    assert found[1].n_tokens == found[2].n_tokens == found[7].n_tokens == 1 and found[3].n_tokens == 30_001
    twice = [r for r in rows if r.doc_id == 4 and r.n_tokens == 6]
    assert len(twice) == 2 and twice[0] == twice[1] and all(np.isfinite(r.score) and np.isfinite(r.base_score) for r in rows)
    assert lattice.likelihoods(no_docs, subword_path(), held_out).count() == 0
    nothing = lattice.likelihoods(odd_docs, subword_path(), F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and np.isfinite(r.score) for r in nothing) and nothing[0].base_score == pytest.approx(0, abs=1)
    clashing = odd_docs.selectExpr("*", "'x' as word", "1 as z", "2 as lp", "3 as tie", "4 as base")
    again = lattice.likelihoods(clashing, subword_path(), held_out).collect()
    order = lambda rs: sorted(((r.doc_id or -1, r.n_tokens, round(r.score, 6)) for r in rs))
    assert order(again) == order(rows)
    unnamed = lattice.likelihoods(odd_docs.drop("lang"), subword_path(), held_out)
    assert unnamed.count() == len(rows)
