"""Samples of labelled documents stay bounded, and the models fitted from them are as defined."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridclimate.llm import neighbour_quality as nq
from gridclimate.llm import sentence_toxicity as tox
from gridclimate.llm.labelled import sample_features, sampled_labels

codes = lambda text: [ord(c) for c in text]


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "label_id long, label int"))


def test_one_row_per_identifier(spark):
    docs, labels = frames(spark, [(1, f"t{i}") for i in range(2000)] + [(2, "b")], [(1, 1), (2, 0), (3, 1), (2, 0)])
    for most in (1, 10):
        rows = sample_features(docs, labels, codes, most)
        assert len(rows) <= 2
    again = sample_features(docs.orderBy(F.rand(3)), labels, codes, 10)
    assert [(a, b.tolist()) for a, b in rows] == [(a, b.tolist()) for a, b in again]


def test_bytes_are_bounded(spark):
    docs, labels = frames(spark, [(i, "x" * (1 + 100 * (i == 5))) for i in range(9)], [(i, i % 2) for i in range(9)])
    assert len(sample_features(docs, labels, codes, 9, most_bytes=10**6)) == 9
    assert len(sample_features(docs, labels, codes, 9, most_bytes=80)) == 8
    assert len(sample_features(docs, labels, codes, 9, most_bytes=3 * 8)) == 3
    assert sample_features(docs, labels, codes, 9, most_bytes=0) == []
    assert sample_features(docs, labels.where("false"), codes, 9) == []


def test_a_rare_label_is_not_thinned(spark):
    labels = spark.range(20_000).select(F.col("id").alias("label_id"), (F.col("id") % 200 == 0).cast("int").alias("label"))
    rows = sampled_labels(labels, 1000).collect()
    assert sum(r.label for r in rows) == 100
    assert 1000 <= len(rows) <= 1200


def test_votes_equal_all_cosines():
    """The blocked vote against every cosine in turn."""
    rng = np.random.default_rng(0)
    voters, vectors = (nq.units(rng.standard_normal((n, 12))) for n in (300, 1300))
    labels = (rng.random(300) < 0.4).astype(float)
    got = nq.vote(vectors, voters, labels, 15)
    for own, score in zip(vectors, got):
        cosines = sorted(((float(own @ v), y) for v, y in zip(voters, labels)), reverse=True)[:15]
        weights = [max(c, 0.0) ** 8 + 1e-9 for c, _ in cosines]
        assert score == pytest.approx(sum(w * y for w, (_, y) in zip(weights, cosines)) / sum(weights))


def test_a_tie_at_the_last_neighbour():
    """Voters at the same distance stand for one another; labels alike give the same score."""
    voters = np.array([[1.0, 0.0], [0.6, 0.8], [0.6, 0.8], [0.6, -0.8], [-1.0, 0.0]])
    labels = np.array([1.0, 0.0, 0.0, 0.0, 1.0])
    (score,) = nq.vote(np.array([[1.0, 0.0]]), voters, labels, 2)
    assert score == pytest.approx(1 / (1 + 0.6**8), abs=1e-6)
    assert nq.vote(np.zeros((1, 2)), voters, labels, 5)[0] == pytest.approx(labels.mean())
    assert nq.vote(np.ones((2, 2)), np.zeros((0, 2)), np.zeros(0), 5).tolist() == [0.5, 0.5]


def test_noisy_or_and_its_gradient():
    rng = np.random.default_rng(1)
    document = np.array([0, 0, 0, 1, 2, 2, 3])  # of each sentence
    sentence, place = rng.integers(0, 7, 40), rng.integers(0, 6, 40)
    labelled, values = np.array([1.0, 0.0, 1.0, 0.0]), rng.standard_normal(7)

    def likelihood(values):
        total = 0.0
        for d, y in enumerate(labelled):
            none = 1.0
            for s in np.flatnonzero(document == d):
                logit = values[-1] + sum(values[p] for p, t in zip(place, sentence) if t == s)
                none *= 1 - 1 / (1 + np.exp(-logit))
            total += np.log(1 - none if y else none)
        return total

    gradient = tox.likelihood_gradient(values, place, sentence, document, labelled)
    for k in range(7):
        step = np.eye(7)[k] * 1e-6
        assert gradient[k] == pytest.approx((likelihood(values + step) - likelihood(values - step)) / 2e-6, abs=1e-5)
    model = tox.ToxicityModel(np.arange(3), np.array([0.5, 0.0, -1.0]), -1.0)
    logits = np.array([-2.0, 0.3, 1.0])
    assert tox.Sentences(model).probability(logits) == pytest.approx(1 - np.prod(1 - 1 / (1 + np.exp(-logits))))
