"""Odd inputs: each case has a defined result."""

import hashlib
import json
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridclimate.llm.class_model import (
    best_classes, class_number, exchange, fit_class_model, likelihood, score_texts, xlogx
)
from gridclimate.llm.components import components
from gridclimate.llm.content_sort import content_groups, drop_exact_copies
from gridclimate.llm.cover_tree import near_vectors
from gridclimate.llm.crf_pii import find_personal_data, train_crf, viterbi
from gridclimate.llm.golden_mix import mix, mixed_documents
from gridclimate.llm.neighbour_quality import fit_quality, score_quality
from gridclimate.llm import parity_join
from gridclimate.llm.parity_join import Bands, WordHashes, near_duplicates, shingles, sketch_keys
from gridclimate.llm.piece_encoding import encode_pieces, piece_model
from gridclimate.llm.sentence_toxicity import fit_toxicity, score_toxicity, sentence_words
from gridclimate.llm.token_files import byte_tokens, read_token_files, write_token_files

PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKENS = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = st.text(
    st.sampled_from(list("abcdehinorst  .,'\n\t▁éçßñ日😀\x00\x1c\x85\xa0　​À<0x>1234_!*#")), max_size=60
)


# --- op1, op3: classifiers ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1), (7, 0), (9, 1), (12, 0), (None, 1), (3, None), (3, 1), (99, 1)], "label_id long, label int"
    )


@pytest.mark.parametrize("fit, score", [(fit_quality, score_quality), (fit_toxicity, score_toxicity)])
def test_classifiers_score_every_row(odd_docs, no_docs, labels, fit, score):
    model = fit(odd_docs, labels)
    rows = score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.row.text or "", r.score) == r.score
    assert score(no_docs, model).count() == 0
    nothing = fit(odd_docs, labels.where("false"))
    assert all(0 <= r.score <= 1 for r in score(odd_docs, nothing).collect())


def test_toxicity_locates_sentences(spark):
    rows = [(i, f"This is fine. {'You rotten fool.' if i % 2 else 'All is well.'} Bye now.") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select(F.col("doc_id").alias("label_id"), (F.col("doc_id") % 2).alias("label"))
    for row in score_toxicity(docs, fit_toxicity(docs, labels)).collect():
        assert row.predicted == row.row.doc_id % 2
        found = [row.row.text[s.begin : s.end] for s in row.sentences]
        assert found == (["You rotten fool."] if row.predicted else [])


def test_sentences_are_spans_of_code_points():
    text = "One two. 😀 three!\nno end\n\nlast"
    assert [text[b:e] for b, e in sentence_words(text)] == ["One two.", "😀 three!", "no end", "last"]


# --- op2, op4: encoding ---------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_pieces_equal_the_library(text):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids = piece_model(PIECES).encode(text)
    assert ids.tolist() == library.encode(text, add_eos=True)
    assert piece_model(PIECES).decode(ids) == library.decode(ids.tolist())


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_tokens_equal_the_library(text):
    library = Tokenizer.from_file(TOKENS)
    model = byte_tokens(TOKENS, 2)
    found = np.frombuffer(model.encode(text), model.dtype).tolist()
    assert found == [*library.encode(text, add_special_tokens=False).ids, 2]


def test_pieces_of_odd_documents(odd_docs, no_docs):
    for row in encode_pieces(odd_docs, PIECES).collect():
        text = row.row.text or ""
        assert row.ids[-1] == piece_model(PIECES).end_id
        assert row.decoded == text.replace("▁", " ")
        assert row.row.ids == 5
        if not text:
            assert len(row.ids) == 1
    assert encode_pieces(no_docs, PIECES).count() == 0


def test_token_files_round_trip(spark, odd_docs, no_docs, tmp_path):
    library = Tokenizer.from_file(TOKENS)
    manifest = write_token_files(odd_docs, str(tmp_path / "t"), TOKENS, 2)
    assert json.loads((tmp_path / "t" / "manifest.json").read_text()) == manifest
    rows = read_token_files(spark, str(tmp_path / "t"), batch_tokens=100).orderBy("start").collect()
    ids = [r.doc_id for r in rows]
    assert ids == [None, None, 1, 2, 3, 3, *range(4, 14)]
    start = 0
    texts = {}
    for r in odd_docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    for r in rows:
        assert r.start == start
        start += r.n_tokens
        options = [[*library.encode(t, add_special_tokens=False).ids, 2] for t in texts[r.doc_id]]
        assert np.frombuffer(r.ids, "<u4").tolist() in options
    assert write_token_files(no_docs, str(tmp_path / "none"), TOKENS, 2) == []
    assert read_token_files(spark, str(tmp_path / "none")).count() == 0


# --- op5: mixing ----------------------------------------------------------------------------------


def test_mix_of_odd_documents(spark, odd_docs, no_docs):
    pieces, decisions = mix(odd_docs)
    rows = decisions.collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    assert sum(r.taken for r in rows) == sum(r.upto - r["from"] for r in pieces.collect())
    assert mix(no_docs)[1].count() == 0
    sources = odd_docs.withColumn("source", F.when(F.col("doc_id") > 7, F.lit(None)).otherwise("b"))
    found = {r.source: r for r in mix(sources)[1].collect()}
    assert set(found) == {"b", None}
    blank = spark.createDataFrame([(1, " ", "a"), (2, None, "a")], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mix(blank)[1].collect()] == [(0.0, 0), (0.0, 0)]


def test_mixed_documents_are_whole(odd_docs):
    rows = mixed_documents(odd_docs)
    assert rows.columns == odd_docs.columns
    texts = {r.text for r in odd_docs.collect()}
    assert {r.text for r in rows.collect()} <= texts


def test_hot_source(spark):
    rows = [(i, "w " * (1 + i % 50), "hot" if i % 3 == 0 else f"s{i % 20}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = mix(docs)[1].groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"))
    assert all(abs(r.n - r.t) <= 0.03 * r.t for r in taken.collect())


@pytest.mark.parametrize("small", [3, 20, 400])
def test_many_small_sources(spark, small):
    """Each source comes near its target, beside one that is much larger."""
    rows = [(i, "w " * small, f"s{i}") for i in range(300)]
    rows += [(1000 + i, "w " * 500, "large") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = mix(docs)[1].groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"))
    taken = {r.source: r for r in taken.collect()}
    assert len(taken) == 301
    assert all(abs(r.n - r.t) <= 0.08 * r.t + 1 for r in taken.values())
    assert abs(sum(r.n - r.t for r in taken.values())) <= 0.02 * sum(r.t for r in taken.values())


# --- op6: class model -----------------------------------------------------------------------------


def test_class_model_of_odd_documents(odd_docs, no_docs):
    model, others = fit_class_model(odd_docs)
    rows = score_texts(odd_docs, model, others).collect()
    assert len(rows) == odd_docs.count()
    assert all(np.isfinite(r["score"]) for r in rows)
    model, others = fit_class_model(no_docs)
    rows = score_texts(odd_docs, model, others, keep={"doc_id": F.col("doc_id")}).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and np.isfinite(r.score) for r in rows)
    assert score_texts(no_docs, model, others).count() == 0


def invented_texts(count, seed=3):
    rng = random.Random(seed)
    kinds = [[f"{k}{i}" for i in range(30)] for k in "abc"]
    draw = lambda k: kinds[k % 3][min(29, int(rng.expovariate(0.15)))]
    return [" ".join(draw(k) for k in range(rng.randrange(60))) for _ in range(count)]


def plain_class_model(texts, model, others):
    """A function that scores a text word by word, from counts in plain Python."""
    listed = model.listed
    classes = {w: int(c) for w, c in zip(listed.words, listed.classes)}
    classes |= {bytes(r.word): r["class"] for r in others.collect()}
    end, tokens = listed.end, [t.encode().lower().split() for t in texts]
    counts = Counter(w for words in tokens for w in words)
    assert set(classes) == set(counts) and set(classes.values()) <= set(range(listed.n_classes))
    pairs = np.zeros((end + 1, end + 1))
    for words in tokens:
        states = [end, *[classes[w] for w in words], end]
        np.add.at(pairs, (states[:-1], states[1:]), 1)
    total = pairs.sum(0)
    share = (total + 0.5) / (total.sum() + 0.5 * (end + 1))
    n = sum(counts.values()) + len(texts)
    unseen = (sum(c == 1 for c in counts.values()) + 0.5) / (n + 1)
    step = lambda s, c: (1 - unseen) * (pairs[s, c] + 20 * share[c]) / (pairs[s].sum() + 20)

    def score(text):
        state, logs = end, 0.0
        for word in text.encode().lower().split():
            if word in classes:
                own = classes[word]
                logs += math.log10(step(state, own) * counts[word] / total[own])
                state = own
            else:
                logs += math.log10(unseen / (len(counts) + 1))
        return logs + math.log10(step(state, end))

    return score


@pytest.mark.parametrize("listed, core", [(80, 9), (12, 6), (1, 1), (1 << 18, 512)])
def test_scores_equal_word_by_word(spark, listed, core):
    texts = invented_texts(60)
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    model, others = fit_class_model(docs, core=core, n_classes=3, listed=listed)
    assert others.count() == len({w for t in texts for w in t.split()}) - len(model.listed.words)
    plain = plain_class_model(texts, model, others)
    new = ["", "a0 b0 unseen c0", "unseen", "x y z a1 x", "a29 a28 q c17 b22 b23", *invented_texts(10, 8)]
    both = spark.createDataFrame([(t,) for t in new + texts], "text string")
    rows = score_texts(both, model, others).collect()
    assert len(rows) == len(new) + len(texts)
    for row in rows:
        assert row.score == pytest.approx(plain(row.row.text), abs=1e-9)
        assert row.n_tokens == len(row.row.text.split()) + 1


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([("a b c a b",), ("b c a",), ("d",), ("e f d",)], "text string")
    model, others = fit_class_model(docs, core=2, n_classes=2, listed=3)
    vocabulary = ["a", "b", "c", "d", "e", "f"]
    # Of what follows a text without words: its end, each known word, and as many unseen and one.
    rows = score_texts(spark.createDataFrame([("",)], "text string"), model, others).collect()
    total = 10 ** rows[0].score
    listed = model.listed
    classes = {w: int(c) for w, c in zip(listed.words, listed.classes)}
    classes |= {bytes(r.word): r["class"] for r in others.collect()}
    counts = Counter("a b c a b b c a d e f d".split())
    for word in vocabulary:
        own = classes[word.encode()]
        total += counts[word] * 10 ** (model.transition[listed.end, own] - model.class_total[own])
    total += (len(vocabulary) + 1) * 10**model.unseen
    assert total == pytest.approx(1.0)


def test_classes_grow_with_the_vocabulary():
    numbers = [class_number(n) for n in (0, 10, 10**3, 10**5, 10**6, 10**9)]
    assert numbers == sorted(numbers) and numbers[0] == 8 and numbers[-1] == 1000


def test_exchange_moves_each_word_to_the_best_class():
    def likelihood(bigrams, classes, n):
        between = np.eye(n)[classes].T @ bigrams @ np.eye(n)[classes]
        return xlogx(between).sum() - xlogx(between.sum(1)).sum() - xlogx(between.sum(0)).sum()

    for seed in range(20):
        bigrams = np.random.default_rng(seed).integers(0, 9, (8, 8)).astype(float)
        classes = np.arange(8) % 3
        for w in range(8):
            options = [np.where(np.arange(8) == w, c, classes) for c in range(3)]
            values = [likelihood(bigrams, o, 3) for o in options]
            if max(values) > values[classes[w]] + 1e-9:
                classes = options[int(np.argmax(values))]
        assert (exchange(bigrams, 3, sweeps=1) == classes).all()


def class_bigrams(bigrams, classes, n):
    return np.eye(n)[classes].T @ bigrams @ np.eye(n)[classes]


def test_best_classes_are_those_of_the_gain():
    rng = np.random.default_rng(6)
    between = rng.integers(0, 50, (5, 5)).astype(float)
    word, side, near = rng.integers(0, 9, 40), rng.integers(0, 2, 40), rng.integers(0, 5, 40)
    n = rng.integers(1, 4, 40)
    words, best, gain = best_classes(word, side, near, n, between, 3)
    assert words.tolist() == sorted(set(word.tolist()))
    for w, c in zip(words, best):
        gains = np.zeros(3)
        for k in np.flatnonzero(word == w):
            for own in range(3):
                pair = (near[k], own) if side[k] == 0 else (own, near[k])
                whole = between[:, own].sum() if side[k] == 0 else between[own].sum()
                gains[own] += n[k] * np.log((between[pair] + 0.5) / (whole + 0.5))
        assert gains[c] == pytest.approx(gains.max())


def test_moves_keep_the_core_and_raise_the_likelihood(spark):
    texts = invented_texts(80)
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    listed = fit_class_model(docs, core=9, n_classes=3)[0].listed
    reader, n = listed.reader(), len(listed.words) + 2
    places = np.concatenate([[n - 2], reader.read(texts)[0]])
    bigrams = np.zeros((n, n))
    np.add.at(bigrams, (places[:-1], places[1:]), 1)
    core = exchange(bigrams[:9, :9], 3)
    assert listed.classes[:9].tolist() == core.tolist()
    start = np.concatenate([core, np.full(n - 11, listed.none), [listed.end, listed.none]])
    value = lambda classes: likelihood(class_bigrams(bigrams, classes, 5))
    assert value(listed.class_of()) > value(start)


# --- op7, op9: near duplicates --------------------------------------------------------------------


def test_near_duplicates_of_odd_documents(odd_docs, no_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    component = {r.id: r.component_id for r in rows if r.id is not None}
    assert component[7] == component[8] == 7
    assert component[9] == component[10] == 9
    assert component[1] == component[3] == 1 and component[2] == 2
    assert component[12] == component[13] == 12
    assert [component[i] for i in (4, 5, 6)] == [4, 5, 6]
    assert {r.component_id for r in rows if r.id is None} == {1, None}
    assert near_duplicates(no_docs).count() == 0


def plain_links(sets, p, q):
    return {
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if len(sets[i] & sets[j]) * q >= len(sets[i] | sets[j]) * p
    }


@pytest.mark.parametrize("share", [0.0, 0.5])
def test_near_groups_against_all_pairs(spark, share):
    """A large group of near copies with more and more changes, and short texts."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(400)}" for _ in range(90)]
    texts = []
    for k in range(180):
        words = list(base) if rng.random() > share else [f"x{rng.randrange(60)}" for _ in range(rng.randrange(40))]
        for _ in range(k % 5):
            if words:
                words[rng.randrange(len(words))] = f"z{rng.randrange(10_000)}"
        texts.append(" ".join(words[: len(words) - k % 3]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [set(found.tolist()) for found in shingles(texts, 3, WordHashes())]
    root = list(range(len(sets)))
    for i, j in sorted(plain_links([s or {("none", k)} for k, s in enumerate(sets)], 90, 100)):
        a, b = sorted((root[i], root[j]))
        root = [a if r == b else r for r in root]
    rows = {r.id: r.component_id for r in near_duplicates(docs).collect()}
    assert [rows[i] for i in range(len(texts))] == root


def test_a_key_means_one_pair_of_words():
    """Words alike at other places than zero words make no common key."""
    keys = [set(sketch_keys(np.array(w, np.uint64), 3).tolist()) for w in ([5, 7, 0], [5, 0, 9])]
    assert len(keys[0]) == len(keys[1]) == 3 and not keys[0] & keys[1]


def test_folds_never_differ_more_than_sets():
    rng, bands = np.random.default_rng(2), Bands(80, 100)
    for size in (3, 40, 300, 2000):
        x = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        group = bands.band(len(x))
        fold = bands.fold(bands.sketch(x, group), group)
        for changed in (0, 1, size // 10, size // 2):
            y = np.unique(np.concatenate([x[changed:], rng.integers(0, 2**63, changed).astype(np.uint64)]))
            other = bands.fold(bands.sketch(y, group), group)
            differ = len(np.setxor1d(x, y))
            assert np.bitwise_count(fold ^ other).sum() <= differ
            if differ > 2 * bands.apart(2 * bands.edges[group + 2]):
                assert np.bitwise_count(fold ^ other).sum() > bands.apart(len(x) + len(y))


@pytest.mark.parametrize("hot", [20, 64])
def test_blocks_hold_all_shared_keys(monkeypatch, hot):
    """Every key leads to all of its sets; one that many share has more than few in its bucket."""
    monkeypatch.setattr(parity_join, "HOT", hot)
    rng, buckets = np.random.default_rng(4), 5
    holders, rows = {}, []
    blocks = parity_join.KeyBlocks(buckets)
    for node in range(1, 160):
        keys = np.unique(parity_join.mixed(rng.integers(0, 40, 12).astype(np.uint64)))
        blocks.add(node, keys, 1 + node % 2, node * 3)
        for key in keys.tolist():
            holders.setdefault(key, set()).add(node)
        if node % 80 == 0:
            rows += [r for b in blocks.packed() for r in b.to_pylist()]
    rows += [r for b in blocks.packed() for r in b.to_pylist()]
    assert any(r["dealt"] for r in rows) == (hot == 20)
    found, plain = {}, Counter()
    for row in rows:
        key, node, group, size = parity_join.block_entries(row, buckets)
        assert (group == 1 + node % 2).all() and (size == node * 3).all()
        for k, n in zip(key.tolist(), node.tolist()):
            found.setdefault(k, set()).add(n)
            plain[k] += not row["dealt"]
    number = lambda k: parity_join.key_number(
        np.array([k], np.uint64) & parity_join.LOW, parity_join.bucket_of(np.array([k], np.uint64), buckets)
    ).view(np.int64)[0]
    assert found == {number(k): nodes for k, nodes in holders.items()}
    assert all(plain[number(k)] > parity_join.FEW for k, nodes in holders.items() if len(nodes) > 2 * hot)


def test_similar_sets_share_enough_keys():
    """As many keys as pairs are counted by, whatever members differ."""
    rng, bands = np.random.default_rng(8), Bands(80, 100)
    for size in (5, 30, 90, 200, 500):
        for _ in range(60):
            x = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            gone = int(rng.integers(0, max(1, bands.apart(2 * len(x)) // 2) + 1))
            y = np.unique(np.concatenate([x[gone:], rng.integers(0, 2**63, gone).astype(np.uint64)]))
            if not bands.similar(x, y):
                continue
            group = min(bands.band(len(x)), bands.band(len(y)))
            if bands.parts(group):
                keys = [set(sketch_keys(bands.sketch(z, group), group).tolist()) for z in (x, y)]
                assert len(keys[0] & keys[1]) >= bands.least_keys(group)


def test_bands_cover_all_similar_sizes():
    bands = Bands(90, 100)
    for small in range(1, 3000):
        large = small * 100 // 90
        assert bands.band(large) - bands.band(small) <= 1


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    rows = components(links).collect()
    roots = {}
    for r in rows:
        roots.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, roots.values())) == [2, 201]
    assert components(links.where("false")).count() == 0


def test_vectors(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.2]), (4, [0.0, 1.0]), (4, [0.0, 1.0]), (5, None),
        (6, [0.0, 0.0]), (7, [float("nan"), 1.0]), (8, [None, 1.0]), (9, [float("inf"), 1.0]), (10, []),
        (11, [1.0, 0.0, 0.0]), (None, [0.0, 3.0]), (12, [1e300, 0.0]), (13, [-1.0, 0.0]),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("links", F.lit(1))
    found = {}
    for r in near_vectors(vectors).collect():
        found.setdefault(r.id, []).append((r.n_links, r.component_id, r.kept))
    assert found[1] == [(3, 1, True)] and found[2] == found[12] == [(3, 1, False)]
    assert found[3] == [(3, 1, False)]
    assert found[4] == [(2, 4, True)] * 2 and found[None] == [(2, 4, False)]
    for alone in (5, 6, 7, 8, 9, 10, 11, 13):
        assert found[alone] == [(0, alone, True)]
    assert near_vectors(vectors.where("false")).count() == 0
    assert near_vectors(vectors.where("vec_id = 6")).collect()[0].n_links == 0


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 8))
    points = np.concatenate([c + rng.standard_normal((60, 8)) * s for c, s in zip(centres, np.linspace(0.02, 0.6, 12))])
    vectors = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.95).sum(1) - 1
    rows = sorted(near_vectors(vectors).collect())
    assert [r.n_links for r in rows] == links.tolist()


# --- op8: exact copies ----------------------------------------------------------------------------


def test_groups_of_odd_documents(odd_docs, no_docs):
    rows = content_groups(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    kept = [r.row.doc_id for r in rows if r.kept]
    assert sorted(k for k in kept if k is not None) == [1, 6, 7, 9, 10, 11, 12, 13]
    hello = [r for r in rows if r.text_sha256 == hashlib.sha256(b"HelloWorld").hexdigest()]
    assert {(r.keep_id, r.group_size) for r in hello} == {(1, 5)}
    assert drop_exact_copies(odd_docs).columns == odd_docs.columns
    assert content_groups(no_docs).count() == 0


def test_hot_content_is_dealt_out(spark):
    rows = [(i, "same text " + " " * (i % 7)) for i in range(2000)] + [(5000 + i, f"t{i % 400}") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = content_groups(docs, run_rows=50).collect()
    assert len(found) == 3000 and sum(r.kept for r in found) == 401
    hot = [r for r in found if r.row.doc_id < 2000]
    assert {(r.keep_id, r.group_size) for r in hot} == {(6, 2000)}
    assert [r.row.doc_id for r in hot if r.kept] == [6]


def test_identical_rows_keep_one(spark):
    docs = spark.createDataFrame([(1, "a")] * 5 + [(None, "b")] * 3, "doc_id long, text string")
    assert sorted(r.kept for r in content_groups(docs).collect()) == [False] * 6 + [True] * 2


# --- op10: personal data --------------------------------------------------------------------------


def test_personal_data(spark, odd_docs, no_docs):
    crf = train_crf()
    text = "Mail jo(at)example.com or a.b@c.org, call (212) 555-0199 today or ask the host 10.0.0.1 for card 4111 1111 1111 1111 of v2.0 in 1999"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = find_personal_data(docs, crf).first()
    assert [(s.kind, text[s.begin : s.end]) for s in row.base] == [
        ("email", "a.b@c.org"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111"),
    ]
    assert [(s.kind, text[s.begin : s.end]) for s in row.spans] == [
        ("email", "jo(at)example.com"), ("email", "a.b@c.org"), ("phone", "(212) 555-0199"),
        ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111"),
    ]
    assert all(not r.spans for r in find_personal_data(odd_docs, crf).collect())
    assert find_personal_data(no_docs, crf).count() == 0


def test_viterbi_finds_the_best_of_all_paths():
    rng = np.random.default_rng(1)
    moves = rng.standard_normal((3, 3))
    sequences = [rng.standard_normal((n, 3)) for n in (1, 4, 2, 5)]
    for emissions, labels in zip(sequences, viterbi(sequences, moves)):
        n = len(emissions)
        score = lambda path: sum(emissions[k, y] for k, y in enumerate(path)) + sum(
            moves[a, b] for a, b in zip(path, path[1:]))
        every = [tuple((k // 3**i) % 3 for i in range(n)) for k in range(3**n)]
        assert score(labels) == pytest.approx(max(map(score, every)))
