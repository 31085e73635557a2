import numpy as np
import pytest

from marquee.llm import inner_products, p_stable
from marquee.llm.queries import ORACLES, QUERIES, whole_numbers
from tests.compare import connect, difference
from tests.conftest import MEDIUM, SMALL

ROWS = "vec_id long, embedding array<float>, label int"


def nearest_of(ids, x, q, k):
    distance = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
    distance[q] = np.inf
    order = np.lexsort((ids, distance))[:k]
    return [(int(ids[i]), float(distance[i])) for i in order if np.isfinite(distance[i])]


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_recall_and_exact_distances(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = {}
    for r in QUERIES["op5_multiprobe_neighbours"](spark, folder).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        want, got = nearest_of(ids, x, q, 10), sorted(found[ids[q]])
        assert [g[0] for g in got] == list(range(1, 11)) and ids[q] not in [g[1] for g in got]
        assert got == sorted(got, key=lambda g: (g[2], g[1]))
        for _, v, d in got:
            assert d == pytest.approx(float(np.sqrt(((x[ids == v][0] - x[q]) ** 2).sum())), rel=1e-12)
        hits += len({w[0] for w in want} & {g[1] for g in got})
        total += len(want)
    assert hits >= 0.9 * total


def odd_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(0, same), (1, same), (2, same), (3, [1.0, 2.0, 3.5]), (4, None), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 2.0]), (7, [float("nan"), 1.0, 1.0]),
            (8, [float("inf"), 1.0, 1.0]), (9, []), (10, [1.0, 2.0]), (None, same), (100, [-1.0, 0.5, 2.0]), (100, [-1.0, 0.5, 2.0])]
    return spark.createDataFrame([(i, v, None) for i, v in rows], ROWS)


def test_odd_vectors_near(spark):
    odd = odd_vectors(spark)
    rows = p_stable.nearest(odd, odd.where("vec_id in (0, 4, 5, 100)"), 10).orderBy("query_id", "rank").collect()
    assert [(r.vec_id, r.distance) for r in rows if r.query_id == 0][:3] == [(1, 0.0), (2, 0.0), (3, 0.5)]
    assert {r.query_id for r in rows} == {0, 100} and {r.vec_id for r in rows} == {0, 1, 2, 3, 100}
    assert len([r for r in rows if r.query_id == 100]) == 4
    assert p_stable.nearest(odd.limit(0), odd, 10).count() == 0


def test_copies_of_one_vector(spark):
    rows = [(i, [1.0, 0.0, float(i % 50 == 0)], 0) for i in range(1000)]
    copies = spark.createDataFrame(rows, ROWS)
    found = p_stable.nearest(copies, copies.where("vec_id = 1"), 10).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [2, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    best = inner_products.top_products(whole_numbers(copies), whole_numbers(copies.where("vec_id = 1")), 5).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in best] == [(i, 4096) for i in (0, 2, 3, 4, 5)]


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_products_as_sql(spark, folder):
    assert difference(QUERIES["op8_norm_sorted_products"](spark, folder), connect(folder), ORACLES["op8_norm_sorted_products"]) is None


def test_odd_vectors_by_product(spark):
    odd = whole_numbers(odd_vectors(spark))
    rows = inner_products.top_products(odd, odd.where("vec_id in (0, 4, 5)"), 20).orderBy("query_id", "rank").collect()
    assert {r.query_id for r in rows} == {0, 5} and {r.vec_id for r in rows} == {0, 1, 2, 3, 5, 100}
    assert [r.vec_id for r in rows if r.query_id == 5] == [0, 1, 2, 3, 100]
    assert inner_products.top_products(odd.limit(0), odd, 20).count() == 0


def test_blocks_and_bounds(spark, monkeypatch):
    """Many blocks and a wide spread of lengths: the result equals brute force."""
    monkeypatch.setattr(inner_products, "HEAD", 50)
    monkeypatch.setattr(inner_products, "BLOCK_VECTORS", 64)
    monkeypatch.setattr(inner_products, "BLOCK_QUERIES", 16)
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(800, 6)) * rng.lognormal(1, 1, (800, 1)) * 4)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, v array<double>")
    got = {}
    for r in inner_products.top_products(vectors, vectors.where("vec_id % 7 = 0"), 9).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q in range(0, 800, 7):
        score = x @ x[q]
        score[q] = -np.inf
        order = np.lexsort((np.arange(800), -score))[:9]
        assert sorted(got[q]) == [(n + 1, int(i), int(score[i])) for n, i in enumerate(order)]


def test_repeated_ids_by_product(spark, monkeypatch):
    """vec_ids that repeat, as copies and with other vectors, in a table much larger than k: as brute force over distinct ids."""
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(3000, 6)) * 20)
    x[0] *= 40
    ids = np.r_[np.arange(3000), np.zeros(30, int), np.full(40, 5), np.repeat(np.arange(100, 400), 3)]
    x = np.r_[x, np.repeat(x[:1], 30, axis=0), np.floor(rng.normal(size=(40, 6)) * 300), np.floor(rng.normal(size=(900, 6)) * 60)]
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x)]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<double>")
    for head in (2048, 60):
        monkeypatch.setattr(inner_products, "HEAD", head)
        got = {}
        for r in inner_products.top_products(vectors, vectors.where("vec_id % 60 = 0"), 20).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        for q in range(0, 3000, 60):
            best = np.full(3000, -np.inf)
            np.maximum.at(best, ids, (x @ x[ids == q].T).max(axis=1))
            best[q] = -np.inf
            order = np.lexsort((np.arange(3000), -best))[:20]
            assert sorted(got[q]) == [(n + 1, int(i), int(best[i])) for n, i in enumerate(order)]


def test_repeated_ids_near(spark):
    """A vec_id stored many times, as copies and with other vectors, takes one place: in a bucket and in the comparison with all."""
    rng = np.random.default_rng(3)
    x = np.r_[rng.normal(size=(40, 4)) * 0.01 + 5, rng.normal(size=(400, 4)) * 3 - 5]
    ids = np.r_[np.arange(440), np.full(30, 1), np.full(30, 2), np.repeat(np.arange(3, 30), 12)]
    x = np.r_[x, np.repeat(x[1:2], 30, axis=0), x[0] + rng.normal(size=(30, 4)) * 0.001, x[np.repeat(np.arange(3, 30), 12)] + rng.normal(size=(324, 4)) * 0.001]
    x = np.r_[x, [[400.0, 400, 400, 400]]]
    ids = np.r_[ids, 999]  # far from everything
    x = np.asarray(x, np.float32).astype(float)
    vectors = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x)], ROWS)
    got = {}
    for r in p_stable.nearest(vectors, vectors.where("vec_id in (0, 35, 999)"), 10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.distance))
    for q in (0, 35, 999):
        best = np.full(1000, np.inf)
        np.minimum.at(best, ids, np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1)))
        best[q] = np.inf
        order = np.lexsort((np.arange(1000), best))[:10]
        assert [g[1] for g in sorted(got[q])] == order.tolist()
        assert [g[2] for g in sorted(got[q])] == pytest.approx(best[order].tolist())


def test_blocks_meet_from_long_to_short(spark):
    vector_blocks = spark.createDataFrame([(float(n), bytes([n]), b"v") for n in range(40)], "longest double, ids binary, vectors binary").repartition(5)
    query_blocks = spark.createDataFrame([(bytes([q]), b"q", b"f", 10.0 * q, q) for q in range(4)], "q_ids binary, queries binary, floors binary, reach double, slot long")
    met = inner_products.meetings(vector_blocks, query_blocks)
    tasks = [[(r.q_ids[0], r.ids[0]) for r in task] for task in met.rdd.glom().collect()]
    assert sorted(pair for task in tasks for pair in task) == [(q, n) for q in range(4) for n in range(10 * q, 40)]
    for task in tasks:
        assert task == sorted(task, key=lambda p: (p[0], -p[1]))
    assert not spark.createDataFrame([], query_blocks.schema).transform(lambda none: inner_products.meetings(vector_blocks, none)).collect()
