"""Near-duplicate vectors against all pairs, over many cells, blocks and visitors."""

import numpy as np
import pytest

from gridclimate.llm import cover_tree as ct


def plain(points, cosine):
    units = points / np.linalg.norm(points, axis=1, keepdims=True)
    near = units @ units.T >= cosine
    np.fill_diagonal(near, False)
    root = np.arange(len(points))
    while True:
        least = np.where(near, root, len(points)).min(1)
        new = np.minimum(root, least)
        if (new == root).all():
            return near.sum(1), root
        root = new


@pytest.mark.parametrize("width, cosine", [(3, 0.95), (8, 0.9), (24, 0.6)])
def test_links_over_many_blocks(spark, monkeypatch, width, cosine):
    monkeypatch.setattr(ct, "BLOCK", 60)
    rng = np.random.default_rng(width)
    centres = rng.standard_normal((12, width))
    points = centres[rng.integers(0, 12, 900)] + 0.35 * rng.standard_normal((900, width))
    points[300:420] = points[5]  # a hot vector
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.id: r for r in ct.near_vectors(vectors, cosine=cosine).collect()}
    links, root = plain(points, cosine)
    assert links.sum() > 0
    assert [got[i].n_links for i in range(900)] == links.tolist()
    assert [got[i].component_id for i in range(900)] == root.tolist()


def test_visits_reach_every_near_vector():
    rng = np.random.default_rng(2)
    points, centres = (ct.units(rng.standard_normal((n, 4))) for n in (400, 15))
    bound = 0.4
    own, visits = ct.near_cells(ct.distances(points, centres), ct.distances(centres, centres), bound)
    near = ct.distances(points, points) <= bound
    for i, j in zip(*np.nonzero(near)):
        if own[i] < own[j]:
            assert visits[i, own[j]]
    assert visits.mean() < 0.35


def test_visits_don_t_grow_with_the_square():
    """Well apart groups: each vector visits few cells, however many there are."""
    rng = np.random.default_rng(3)
    share = []
    for groups in (10, 80):
        middle = ct.units(rng.standard_normal((groups, 32)))
        points = ct.units(np.repeat(middle, 20, 0) + 0.02 * rng.standard_normal((groups * 20, 32)))
        _, visits = ct.near_cells(ct.distances(points, middle), ct.distances(middle, middle), 0.3)
        share.append(visits.sum() / len(points))
    assert share[1] <= share[0] + 0.5


def test_wide_spread_vectors_make_few_nodes():
    """Nothing prunes among wide random vectors; leaves of many vectors keep the tree small."""
    rng = np.random.default_rng(4)
    tree = ct.build_tree(ct.units(rng.standard_normal((2048, 64))))
    assert len(tree.begin) < 2048 // 8


@pytest.mark.parametrize("leaf", [2, 5, 64])
def test_leaves_against_all_pairs(monkeypatch, leaf):
    monkeypatch.setattr(ct, "LEAF", leaf)
    rng = np.random.default_rng(leaf)
    centres = rng.standard_normal((12, 8))
    points = centres[rng.integers(0, 12, 700)] + 0.35 * rng.standard_normal((700, 8))
    points[100:160] = points[3]
    block = ct.make_block(np.arange(700), np.ones(700, np.int64), points)
    found = ct.Traversal(block, block, 0.9)
    links, _ = plain(points, 0.9)
    got = np.zeros(700, np.int64)
    got[block.nodes] = found.links_x
    assert links.sum() > 0
    assert (got - 1 == links).all()
