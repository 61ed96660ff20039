"""The stages against plain Python, each on its own input."""

import re

import corpus_pipeline
import pyarrow.dataset as ds
import pytest
from test_llm_queries import plain_components

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """Input and result of each stage, as data frames of pandas."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        result = corpus_pipeline.stored(stage(spark, docs, SF), name)
        out[name] = docs.toPandas(), result.toPandas()
        docs = result
    return out


def test_columns_stay(steps):
    for name in list(steps)[:-1]:
        assert list(steps[name][1].columns) == COLUMNS


def test_quality_keeps_good_documents(steps):
    before, after = steps["quality"]
    labels = ds.dataset(f"{SF}/labels.parquet").to_table().to_pandas()
    good = set(labels[labels.quality == 1].doc_id) & set(before.doc_id)
    assert len(good & set(after.doc_id)) >= 0.97 * len(good)
    assert len(after) < len(before)


def test_exact_copies(steps):
    before, after = steps["exact_copies"]
    content = lambda text: re.sub(r"[\x20\x09-\x0D]", "", text or "")
    best = {}
    for row in before.itertuples():
        key = (-len(row.text), row.doc_id)
        best[content(row.text)] = min(best.get(content(row.text), key), key)
    assert sorted(after.doc_id) == sorted(doc_id for _, doc_id in best.values())


def test_near_copies_of_five_words_and_four_fifths(steps):
    before, after = steps["near_copies"]
    before = before.sort_values("doc_id").reset_index(drop=True)
    assert sorted(after.doc_id) == sorted(set(plain_components(before, 5, 80, 100)[1]))


def test_near_copies_drops_a_cut_copy(spark):
    words = [f"w{k}" for k in range(200)]
    texts = [" ".join(words), " ".join(words[:170]), " ".join(words[:150])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.near_copies(spark, docs, SF).select("doc_id").toPandas()
    assert kept.doc_id.tolist() == [0]


def test_mixture(steps):
    before, after = steps["mixture"]
    texts = dict(zip(before.doc_id, before.text))
    assert all(texts[r.doc_id] == r.text for r in after.itertuples())
    assert after.groupby("doc_id").size().max() <= 2
    words = lambda rows: sum(len(t.split()) for t in rows.text)
    assert 1.3 * words(before) < words(after) < 1.7 * words(before)


def test_pieces(steps):
    before, after = steps["pieces"]
    assert sorted(after.doc_id) == sorted(before.doc_id)


def test_run_gives_the_same(spark, steps):
    rows = corpus_pipeline.run(spark, SF).toPandas()
    last = steps["pieces"][1]
    key = ["doc_id", "ids_sha256"]
    assert rows[key].sort_values(key).values.tolist() == last[key].sort_values(key).values.tolist()
