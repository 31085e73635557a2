import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.llm import hard_negatives
from marquee.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference
from tests.conftest import MEDIUM

ROWS = "vec_id long, label long, v array<long>"


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40), st.integers(1, 40), st.integers(1, 40), st.integers(1, 9), st.integers(0, 10**6))
def test_strassen_is_the_product(m, k, n, leaf, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(1 << 40), 1 << 40, (m, k)), rng.integers(-(1 << 18), 1 << 18, (k, n))
    assert (hard_negatives.strassen(a, b, leaf) == a @ b).all()


def test_strassen_wraps_on_the_way():
    """Sums on the way leave 64 bits, the products do not."""
    a = np.full((4, 4), 1 << 61)
    b = np.array([[1, 2, 3, 4], [-1, -2, -3, -3], [1, 0, 0, 0], [-1, 0, 0, 0]])
    want = np.array([[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b.T] for r in a])
    assert (hard_negatives.strassen(a, b, 1) == want).all()


@given(st.integers(-(1 << 62), 1 << 62), st.integers(0, 100))
def test_shares(p, percent):
    exact = percent * p
    assert hard_negatives.share(np.array([p]), percent, False)[0] == exact // 100
    assert hard_negatives.share(np.array([p]), percent, True)[0] == -(-exact // 100)


def by_brute_force(rows, anchors, n_positive, n_negative, low, high):
    out = []
    score = lambda a, b: sum(x * y for x, y in zip(rows[a][1], rows[b][1]))
    for a in anchors:
        ranked = sorted(((-score(a, b), b) for b in rows if b != a))
        for s, p in [(s, b) for s, b in ranked if rows[b][0] == rows[a][0]][:n_positive]:
            fits = [(t, b) for t, b in ranked if rows[b][0] != rows[a][0] and low * -s <= 100 * -t <= high * -s]
            out += [(a, p, k + 1, b, -s, -t) for k, (t, b) in enumerate(fits[:n_negative])]
    return sorted(out)


@pytest.mark.parametrize("cells", [(1 << 15, 1 << 20), (40, 200)])
def test_as_brute_force(spark, monkeypatch, cells):
    """Many ties and one hot label, in one tile and in many."""
    monkeypatch.setattr(hard_negatives, "ANCHOR_CELLS", cells[0])
    monkeypatch.setattr(hard_negatives, "CANDIDATE_CELLS", cells[1])
    monkeypatch.setattr(hard_negatives, "CHUNK", 37)
    rng = np.random.default_rng(4)
    rows = {int(i): (int(rng.choice([0, 0, 0, 1, 2, 3])), rng.integers(-4, 6, 7).tolist()) for i in range(-60, 240)}
    rows |= {i: (i % 3, [2] * 7) for i in range(300, 360)} | {400: (9, [0] * 7), 410: (9, [1] * 7)}
    table = spark.createDataFrame([(i, *r) for i, r in rows.items()], ROWS)
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives(table, F.col("vec_id") % 10 == 0).collect())
    assert got == by_brute_force(rows, [i for i in rows if i % 10 == 0], 5, 3, 50, 95) and got
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives(table, F.col("vec_id") % 25 == 0, 2, 4, 30, 100).collect())
    assert got == by_brute_force(rows, [i for i in rows if i % 25 == 0], 2, 4, 30, 100)


def test_as_sql(spark):
    assert difference(QUERIES["op13_strassen_negatives"](spark, MEDIUM), connect(MEDIUM), ORACLES["op13_strassen_negatives"]) is None


def test_odd_rows(spark):
    good = [(0, 1, [5, 5]), (1, 1, [5, 4]), (2, 2, [4, 4]), (2, 2, [4, 4]), (3, 3, [3, 4])]
    odd = [(None, 1, [9, 9]), (4, None, [9, 9]), (5, 1, None), (6, 1, []), (7, 1, [9, None]), (8, 2, [1, 2, 3]), (2, 7, [9, 9])]
    table = spark.createDataFrame(good + odd, ROWS)
    extra = table.selectExpr("*", "1 as ag", "2 as cg", "'x' as `_anchor`", "3 as positive_ids")
    for rows in (table, extra):
        got = sorted(tuple(r) for r in hard_negatives.hard_negatives(rows, F.col("vec_id") == 0).collect())
        assert got == [(0, 1, 1, 2, 45, 40), (0, 1, 2, 3, 45, 35)]
    assert hard_negatives.hard_negatives(table.limit(0), F.col("vec_id") == 0).count() == 0
    assert hard_negatives.hard_negatives(table, F.col("vec_id") == 99).count() == 0
    assert hard_negatives.hard_negatives(table, F.col("vec_id") == 3).count() == 0  # no row of its label
