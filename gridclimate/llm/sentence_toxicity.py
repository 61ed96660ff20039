"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's probability is the logistic of a bias and the weights of its words and of their
first letters, which inflected words share. A document is
toxic if any of its sentences is: noisy-or, ``1 - product(1 - p)``. The weights are fitted so that
the noisy-or meets the documents' labels; the sentences then tell where the offence is.
"""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import row_of, slices
from .labelled import sample_features

REMEMBERED = 150_000
LETTERS = re.compile(r"[^\W\d_]+")
END = re.compile(r"[.!?…][\"')\]»”’]*$")
TERM_BITS = 40
BEGINNING = 4
PRECISION = 1 << 20


def word_terms(word: str) -> tuple[list[int], bool]:
    """Hashes of the letters in lower case and of the first ones; whether a sentence ends here."""
    plain = "".join(LETTERS.findall(word.lower()))
    terms = [zlib.crc32(plain.encode())] if plain else []
    if len(plain) >= BEGINNING:
        terms.append(zlib.crc32(f"{plain[:BEGINNING]}-".encode()))
    return terms, END.search(word) is not None


def sentence_words(text: str) -> list[tuple[int, int]]:
    """Spans in code points of the sentences: they end at a mark of ending or a line's end."""
    spans, start, last = [], None, 0
    for word in re.finditer(r"\S+", text):
        if start is not None and "\n" in text[last : word.start()]:
            spans.append((start, last))
            start = None
        if start is None:
            start = word.start()
        last = word.end()
        if END.search(word.group()):
            spans.append((start, last))
            start = None
    if start is not None:
        spans.append((start, last))
    return spans


def codes_of(text: str, code) -> tuple[np.ndarray, np.ndarray]:
    """The words' codes and the places where sentences begin."""
    lines = [line.split() for line in text.split("\n")]
    codes = np.array([code(w) for line in lines for w in line], np.int64)
    ends = (codes & 1).astype(bool)
    of_lines = np.cumsum([len(line) for line in lines]) - 1
    ends[of_lines[of_lines >= 0]] = True
    return codes >> 1, np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1]) if len(codes) else codes


def training_features(text: str) -> list[int]:
    """The terms of all words; a sentence's number is put above the bits of its terms."""
    words: list[list[int]] = []

    def code(word: str) -> int:
        terms, end = word_terms(word)
        words.append(terms)
        return end

    _, begins = codes_of(text, code)
    starts, number, out = set(begins[1:].tolist()), 0, []
    for k, terms in enumerate(words):
        number += k in starts
        out.extend(t | number << TERM_BITS for t in terms)
    return out


@dataclass
class ToxicityModel:
    """Known terms in ascending order, their weights, and the bias of a sentence."""

    terms: np.ndarray
    weights: np.ndarray
    bias: float


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    examples: int = 4000,
    terms: int = 60_000,
    least_documents: int = 4,
    penalty: float = 0.0004,
    steps: int = 300,
) -> ToxicityModel:
    """Fit on at most ``examples`` labelled documents (``label_id``, ``label``).

    Terms of fewer than ``least_documents`` examples have no weight, and the ``penalty`` on
    absolute weights leaves most others without. With labels of one kind or
    none the weights stay 0 and the bias alone meets the labels' mean.
    """
    rows = sample_features(docs, labels, training_features, examples, text, id)
    rows = [(label, features) for label, features in rows if len(features)]
    found = [features for _, features in rows]
    mask = (1 << TERM_BITS) - 1
    values, seen = np.unique(
        np.concatenate([np.unique(f & mask) for f in found] or [np.zeros(0, np.int64)]),
        return_counts=True,
    )
    values, seen = values[seen >= least_documents], seen[seen >= least_documents]
    known = np.sort(values[np.lexsort((values, -seen))[:terms]])

    labelled = np.array([label for label, _ in rows], float)
    place, sentence, document, base = [], [], [], 0
    for k, f in enumerate(found):
        at = np.searchsorted(known, f & mask)
        here = at < len(known)
        here[here] = known[at[here]] == (f & mask)[here]
        number = f >> TERM_BITS
        place.append(at[here])
        sentence.append(number[here] + base)
        document.append(np.full(number[-1] + 1, k))
        base += int(number[-1]) + 1
    del found
    none = [np.zeros(0, np.int64)]
    return maximise(
        known,
        np.concatenate(place or none),
        np.concatenate(sentence or none),
        np.concatenate(document or none),
        labelled,
        penalty,
        steps,
    )


def likelihood_gradient(values, place, sentence, document, labelled) -> np.ndarray:
    """Of the documents' labels under noisy-or, by the terms' weights and, last, the bias.

    Weight ``place`` occurs in ``sentence``; ``document`` is the document of each sentence.
    """
    logit = values[-1] + np.bincount(sentence, values[place], minlength=len(document))
    quiet = -np.logaddexp(0, logit)  # log of 1 - p
    total = np.bincount(document, quiet, minlength=len(labelled))
    clean = np.exp(np.minimum(total, -1e-9))
    # d likelihood / d logit of a sentence: p * (y * clean / (1 - clean) - (1 - y))
    pull = labelled * clean / (1 - clean) - (1 - labelled)
    slope = -np.expm1(quiet) * pull[document]
    return np.append(np.bincount(place, slope[sentence], minlength=len(values) - 1), slope.sum())


def maximise(known, place, sentence, document, labelled, penalty, steps) -> ToxicityModel:
    """Full-batch Adam on the penalised log-likelihood of the noisy-or; weights shrink to 0."""
    n = max(1, len(labelled))
    values = np.zeros(len(known) + 1)
    values[-1] = -5.0
    mean, square, rate = np.zeros_like(values), np.zeros_like(values), 0.1
    for step in range(1, steps + 1):
        gradient = likelihood_gradient(values, place, sentence, document, labelled) / n
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        pace = rate / (np.sqrt(square / (1 - 0.99**step)) + 1e-5)
        values += pace * mean / (1 - 0.9**step)
        shrunk = np.abs(values) - pace * penalty
        values[:-1] = (np.sign(values) * np.maximum(shrunk, 0))[:-1]
    return ToxicityModel(known, values[:-1], float(values[-1]))


class Sentences:
    """Probabilities of sentences, with a bounded memory of the words' weights."""

    def __init__(self, model: ToxicityModel):
        here = model.weights != 0
        self.weights = dict(zip(model.terms[here].tolist(), model.weights[here].tolist()))
        self.bias = model.bias
        self.words: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def code(self, word: str) -> int:
        """The word's weight as an integer, doubled, plus one if it ends a sentence."""
        code = self.older.get(word)
        if code is None:
            terms, end = word_terms(word)
            code = round(PRECISION * sum(self.weights.get(t, 0.0) for t in terms)) * 2 + end
        if len(self.words) >= REMEMBERED:
            self.older, self.words = self.words, {}
        self.words[word] = code
        return code

    def logits(self, text: str) -> np.ndarray:
        known, slow = self.words.get, self.code
        weights, begins = codes_of(text, lambda w: c if (c := known(w)) is not None else slow(w))
        if not len(weights):
            return np.full(1, self.bias)  # one sentence without words
        return np.add.reduceat(weights, begins) / PRECISION + self.bias

    def probability(self, logits: np.ndarray) -> float:
        return float(-np.expm1(-np.logaddexp(0, logits).sum()))


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    text: str = "text",
    threshold: float = 0.3,
    sentence_threshold: float = 0.1,
    keep: list[str] | None = None,
) -> DataFrame:
    """Every row of ``docs`` as ``row`` (all columns, or those to ``keep``), with ``score``, ``predicted`` and ``sentences``.

    ``sentences`` lists the offending ones of a predicted document as (``begin``, ``end``,
    ``score``), in code points, end exclusive: those of at least ``sentence_threshold``, or else
    the likeliest. NULL texts count as empty; a text without words counts as one sentence without
    words. Whole texts are scored, no other column is read.
    """
    rows = docs.select(
        row_of(docs, keep),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sentences = Sentences(shared.value)
        for batch in slices(batches):
            scores, found = [], []
            for document in batch.column(1).to_pylist():
                logits = sentences.logits(document)
                scores.append(min(1.0, max(0.0, sentences.probability(logits))))
                spans = []
                if scores[-1] >= threshold and document.strip():
                    p = 1 / (1 + np.exp(-logits))
                    wanted = (p >= sentence_threshold) | (p == p.max())
                    spans = [
                        {"begin": b, "end": e, "score": float(q)}
                        for (b, e), q, w in zip(sentence_words(document), p, wanted)
                        if w
                    ]
                found.append(spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(found, SPANS)],
                ["row", "score", "sentences"],
            )

    schema = (
        f"row {rows.schema['row'].dataType.simpleString()}, score double, "
        "sentences array<struct<begin:int,end:int,score:double>>"
    )
    scored = rows.mapInArrow(score, schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


SPANS = pa.list_(
    pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
)
