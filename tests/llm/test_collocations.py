"""Collocations against counts of all phrases in plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridclimate.llm import collocations as co


def plain_collocations(rows, least=100, longest=5, share=(100, 100), top=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    found = {}
    for phrase, a in counts.items():
        lang, *words = phrase
        if len(words) < 2 or a < least:
            continue
        n = totals[lang]
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
            cuts.append((1000 * a * n // (left * right), k, left, right))
        found[phrase] = (a, *min(cuts)[2:], n, min(cuts)[0])
    subsumed = {
        (phrase[0], *phrase[i : i + size])
        for phrase, row in found.items() for size in range(2, len(phrase) - 1)
        for i in range(1, len(phrase) - size + 1)
        if (own := found[(phrase[0], *phrase[i : i + size])]) and row[0] * share[1] >= own[0] * share[0]
    }
    out = []
    for lang in totals:
        own = [(p, r) for p, r in found.items() if p[0] == lang and p not in subsumed]
        own = [(" ".join(p[1:]), r) for p, r in own]
        own.sort(key=lambda x: (-x[1][4], -x[1][0], x[0].encode()))
        out += [(lang, rank, p, *r) for rank, (p, r) in enumerate(own[:top], 1)]
    return sorted(out)


def frame(spark, rows):
    rows = [(*r, "phrase", 7, "words") for r in rows]
    return spark.createDataFrame(rows, "lang string, text string, word string, n int, id string")


def invented(seed, count=200):
    make = random.Random(seed)
    words = ["A", "b", "C", "ßé", "日本", "x", "Y", "z\x00", "a'b"]
    mark = [" ", " ", " ", "\t", ". ", ", ", "\n", " ", "! ", " ;"]
    rows = []
    for _ in range(count):
        text = "".join(
            make.choice(words[: make.randint(1, 9)]) + make.choice(mark) for _ in range(make.randint(0, 30))
        )
        rows.append((make.choice(["en", "fr", None, "und"]), text))
    return rows + [("en", None), (None, None), ("de", ""), ("de", " .,\n"), ("it", "one"), ("en", "A A A A")]


@pytest.mark.parametrize("given", [
    {"least": 5}, {"least": 3, "longest": 3}, {"least": 2, "share": (80, 100)}, {"least": 4, "top": 7},
])
def test_equals_plain_counts(spark, given):
    rows = invented(len(given) + given["least"])
    got = co.collocations(frame(spark, rows), **given).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, **given)
    assert got


def test_one_word_over_and_over(spark):
    rows = [("en", "the " * 5000), ("en", "The cat. " * 300)] + [("fr", "a b")] * 150
    got = co.collocations(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows)


def test_nothing(spark, no_docs):
    empty = no_docs.withColumn("lang", F.lit("en"))
    assert co.collocations(empty).collect() == []
    assert co.collocations(frame(spark, [("en", "a b c")])).collect() == []
    with pytest.raises(ValueError):
        co.collocations(empty, share=(2, 1))


def test_scores_beyond_64_bits(spark):
    a, total, lefts, rights = 3 * 10**12, 7 * 10**17, [4 * 10**12, 5 * 10**12], [9 * 10**16, 10**13]
    row = spark.createDataFrame([(a, total, lefts, rights)], "n long, total long, lefts array<long>, rights array<long>")
    cut = row.select(F.array_min(F.expr(co.CUTS)).alias("c")).first().c
    scores = [1000 * a * total // (x * y) for x, y in zip(lefts, rights)]
    assert (cut.score, cut.k) == (min(scores), scores.index(min(scores)) + 1)


def test_stripes_in_small_pieces(monkeypatch):
    monkeypatch.setattr(co, "ENTRIES", 64)
    rng = np.random.default_rng(3)
    stripes, batches, expected = co.Stripes(7), [], Counter()
    for size in (0, 10, 500, 33):
        prefix, word = rng.integers(1, 9, size).astype(np.uint64), rng.integers(1, 40, size).astype(np.uint64)
        expected.update(zip(prefix.tolist(), word.tolist()))
        batches += stripes.add(prefix, word)
    batches.append(stripes.packed())
    assert len(batches) > 2
    got, places = Counter(), {}
    for batch in batches:
        for row in batch.to_pylist():
            prefix = np.repeat(np.frombuffer(row["prefixes"], "<u8"), np.frombuffer(row["sizes"], "<u4"))
            words, counts = (np.frombuffer(row[c], "<u8") for c in ("words", "counts"))
            for p, w, n in zip(prefix.tolist(), words.tolist(), counts.tolist()):
                got[p, w] += n
                assert places.setdefault((p, w), row["bucket"]) == row["bucket"]
    assert got == expected
