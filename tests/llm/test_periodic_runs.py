"""Periodic runs against a search of every lag at every place."""

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridclimate.llm.periodic_runs import collapsed, find_runs, runs_of


def plain_runs(words, least=6, exponent=4):
    found = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                found.append((i, j + q - i, q))
            i = max(j, i + 1)
    within = lambda r, s: s[2] < r[2] and s[0] <= r[0] and sum(s[:2]) >= sum(r[:2])
    return sorted(r for r in found if not any(within(r, s) for s in found))


def own(texts, least=6, exponent=4):
    split, runs = runs_of(texts, least, exponent)
    return split, [[tuple(r[1:]) for r in runs if r[0] == k] for k in range(len(texts))]


pieces = st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9),
                            st.integers(1, 8)), max_size=8)


@settings(max_examples=400, deadline=None)
@given(st.lists(pieces, min_size=1, max_size=4), st.sampled_from([(6, 4), (1, 3), (20, 5)]))
def test_runs_equal_plain_search(docs, least_and_exponent):
    words = [[w for piece, times in doc for w in piece * times] for doc in docs]
    split, found = own([" ".join(w) for w in words], *least_and_exponent)
    for w, runs, bytes_of in zip(words, found, split):
        assert runs == plain_runs(w, *least_and_exponent)
        kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs)]
        assert [x.decode() for x in collapsed(bytes_of, runs)] == kept


def test_known_runs():
    texts = ["a " * 6, "a " * 5, "a b " * 4, "a b " * 3 + "a", "x " + "a b c " * 4 + "a y", None, " \t"]
    assert own(texts)[1] == [[(0, 6, 1)], [], [(0, 8, 2)], [], [(1, 13, 3)], [], []]


def test_overlapping_runs():
    words = ["a"] * 6 + ["b"] * 6 + (["a"] * 6 + ["b"] * 6) * 3
    assert own([" ".join(words)])[1] == [plain_runs(words)]
    assert (0, 48, 12) in plain_runs(words)


def test_texts_are_kept_apart():
    assert own(["a a a", "a a a", "a a a"])[1] == [[], [], []]


@pytest.mark.parametrize("text", ["x " * 10**6, "a b " * 500_000, "ab " * 3 + "a" * 10**6])
def test_long_texts(text):
    begun = time.time()
    own([text])
    assert time.time() - begun < 30


def test_odd_rows(spark, odd_docs, no_docs):
    rows = find_runs(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        words = (row.row.text or "").encode().split()
        assert row.n_words == len(words)
        runs = [(r.start, r.length, r.period) for r in row.runs]
        assert runs == plain_runs(words) if len(words) < 2000 else True
        if not runs:
            assert row.collapsed.encode() == b" ".join(words)
    assert rows[0].row.asDict().keys() == {"doc_id", "text", "row", "ids", "score", "source"}
    assert find_runs(no_docs).collect() == []


def test_arguments(odd_docs):
    for bad in ({"exponent": 2}, {"least": 0}):
        with pytest.raises(ValueError):
            find_runs(odd_docs, **bad)
