"""Nearest neighbours by learned partitions against a search of all pairs."""

import numpy as np
import pyarrow.dataset as ds
import pytest

from gridclimate.llm import learned_partitions as lp
from gridclimate.llm.queries import queries

SF = "/root/testdata/sf0.01"


def plain_nearest(vectors, asked, k):
    """(query, rank, identifier, distance) over lists of (identifier, vector)."""
    out = []
    for own, q in asked:
        away = sorted(
            (float(np.sqrt(((np.array(q, float) - np.array(v, float)) ** 2).sum())), i)
            for i, v in vectors if i != own and len(v) == len(q)
        )
        out += [(own, rank, i, d) for rank, (d, i) in enumerate(away[:k], 1)]
    return sorted(out)


def same(rows, plain):
    rows = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in rows)
    assert [r[:3] for r in rows] == [r[:3] for r in plain]
    assert np.allclose([r[3] for r in rows], [r[3] for r in plain], rtol=1e-12, atol=0)


@pytest.fixture(scope="module")
def table():
    return ds.dataset(f"{SF}/embeddings.parquet").to_table().to_pandas()


def test_query_recall_and_scores(spark, table):
    rows = queries()["op13_learned_partitions"](spark, SF).toPandas()
    vectors = {i: np.array(v, float) for i, v in zip(table.vec_id, table.embedding)}
    plain = plain_nearest(list(vectors.items()), [(i, vectors[i]) for i in vectors if i % 100 == 0], 10)
    true = {(q, i) for q, _, i, _ in plain}
    found = set(zip(rows.query_id, rows.vec_id))
    assert len(found) == len(rows) == len(true)
    assert len(found & true) >= 0.9 * len(true)
    exact = [np.sqrt(((vectors[q] - vectors[i]) ** 2).sum()) for q, i in zip(rows.query_id, rows.vec_id)]
    assert np.allclose(rows.score, exact, rtol=1e-12)
    for _, own in rows.groupby("query_id"):
        own = own.sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11))
        pairs = list(zip(own.score, own.vec_id))
        assert pairs == sorted(pairs)


def test_all_parts_give_all_neighbours(spark, monkeypatch):
    monkeypatch.setattr(lp, "BLOCK", 40)  # several blocks and chunks in every part
    rng = np.random.default_rng(5)
    points = np.round(rng.standard_normal((700, 3)), 1)  # ties and copies
    points[200:450] = points[7]
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = vectors.where("vec_id % 5 = 0")
    plain = plain_nearest([r for r in rows if any(r[1])], [r for r in rows if r[0] % 5 == 0 and any(r[1])], 10)
    same(lp.nearest_vectors(vectors, asked, mass=2.0).collect(), plain)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]),
        (5, [inf, 0.0]), (6, []), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [1.0, 2.0]), (None, [1.0, 2.0]),
        (9, [1.0, 2.0, 3.0]), (100, [1e200, 1e200]), (10, [-1.0, 0.0]),
    ]
    vectors = spark.createDataFrame(
        [(*r, "id", 1) for r in rows], "vec_id long, embedding array<double>, ids string, node int"
    )
    usable = [(0, [1.0, 0.0]), (7, [1.0, 2.0]), (8, [1.0, 2.0]), (9, [1.0, 2.0, 3.0]),
              (100, [1e200, 1e200]), (10, [-1.0, 0.0])]
    found = lp.nearest_vectors(vectors, vectors.where("vec_id <= 10"), k=3).collect()
    same([r for r in found if r.score < inf], [r for r in plain_nearest(usable, usable[:4] + usable[5:], 3)
                                               if r[3] < inf])
    assert {r.query_id for r in found} == {0, 7, 8, 10}  # 9 has no candidate of its width
    assert lp.nearest_vectors(vectors.where("false"), vectors, k=3).collect() == []
    assert lp.nearest_vectors(vectors, vectors.where("false"), k=3).collect() == []


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((8, 16)) * 6
    points = centres[np.repeat(np.arange(8), 100)] + rng.standard_normal((800, 16))
    neighbours = lp.neighbour_graph(points, 10)
    label = lp.balanced_parts(neighbours, 8)
    assert np.bincount(label).tolist() == [100] * 8
    assert (label[neighbours] != label[:, None]).mean() < 0.05


def test_routes_hold_enough():
    odds = np.array([[0.5, 0.3, 0.2, 0.0], [0.99, 0.01, 0.0, 0.0]])
    sizes = np.array([5, 0, 20, 30])
    visited = lp.routed(odds, sizes, 0.75, 10)
    assert visited.tolist() == [[True, False, True, False], [True, False, True, False]]
