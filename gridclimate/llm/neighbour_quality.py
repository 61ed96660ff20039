"""Quality by the votes of the nearest labelled documents.

Documents become latent-semantic vectors: weighted terms (words, shapes of words, and how much
repeats), projected on the leading singular vectors of a labelled sample. The labelled vectors are
broadcast, every document's cosines with all of them are computed exactly, block by block, and the
nearest ones vote with their label, weighted by similarity.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import row_of, slices
from .labelled import sample_features

REMEMBERED = 150_000
WORD, SHAPE, FORM = 0, 1, 2
EDGES = re.compile(r"^\W+|\W+$")


def shape(word: str) -> str:
    """Letters as A or a, digits as 0, runs collapsed: ``Shape's`` becomes ``Aa'a``."""
    out = []
    for c in word:
        k = "0" if c.isdigit() else ("A" if c.isupper() else "a") if c.isalpha() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out[:8])


def term(kind: int, value: str) -> int:
    """A term as a number: 32 bits of hash and its kind."""
    return zlib.crc32(value.encode()) * 4 + kind


def forms(text: str, words: list[str]) -> list[int]:
    """How long a text is and how much of it repeats, in steps; defined for empty texts too."""
    lines = [x for x in text.split("\n") if x.strip()]
    again = sum(map(eq, words, words[1:])) * 10 // max(1, len(words))
    new_words = 10 * len(set(words)) // max(1, len(words))
    new_lines = 10 * len(set(lines)) // max(1, len(lines))
    return [
        term(FORM, f"length {len(words).bit_length() // 2}"),
        term(FORM, f"words {new_words if len(words) < 400 else 2 * (new_words // 2)}"),
        term(FORM, f"lines {new_lines}"),
        term(FORM, f"again {min(again, 3)}"),
    ]


def terms_of(text: str) -> list[int]:
    """Distinct terms and their counts, in turn."""
    words = text.split()
    counts = Counter(forms(text, words))
    for word, n in Counter(words).items():
        counts[term(SHAPE, shape(word))] += n
        plain = EDGES.sub("", word).lower()
        if plain:
            counts[term(WORD, plain)] += n
    return [x for pair in sorted(counts.items()) for x in pair]


@dataclass
class QualityModel:
    """Terms in ascending order, their weights and projection; vectors and labels that vote."""

    terms: np.ndarray
    kinds: np.ndarray
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    def vector(self, index: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return weighted(self, index, counts) @ self.projection[index]

    def score(self, vectors: np.ndarray) -> np.ndarray:
        return vote(vectors, self.vectors, self.labels, self.neighbours)


KIND_SHARE = np.array([0.5, 1.0, 1.0])


def weighted(model, index: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Dampened counts times rarity; words, shapes and forms have fixed shares of the length."""
    values = (1 + np.log(counts)) * model.idf[index]
    kinds = model.kinds[index]
    lengths = np.sqrt(np.bincount(kinds, values * values, minlength=3))
    return values / np.maximum(lengths, 1e-12)[kinds] * KIND_SHARE[kinds]


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def vote(vectors, voters, labels, neighbours: int, without_self: bool = False) -> np.ndarray:
    """Share of label 1 among the nearest voters, weighted by the 8th power of the cosine.

    Of voters at the same distance from the last place, any may vote. Without a similar voter the
    score is the mean of all labels.
    """
    if not len(labels):
        return np.full(len(vectors), 0.5)
    scores = []
    for block in np.array_split(vectors, max(1, -(-len(vectors) // 512))):
        cosines = block @ voters.T
        if without_self:
            place = len(scores)
            cosines[np.arange(len(block)), np.arange(place, place + len(block))] = -1
        k = min(neighbours, len(labels))
        nearest = np.argpartition(cosines, len(labels) - k, axis=1)[:, -k:]
        weights = np.maximum(np.take_along_axis(cosines, nearest, 1), 0).astype(float) ** 8 + 1e-9
        scores.extend((weights * labels[nearest]).sum(1) / weights.sum(1))
    return np.clip(np.array(scores), 0.0, 1.0)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    examples: int = 4000,
    terms: int = 6000,
    dimensions: int = 64,
    neighbours: int = 15,
) -> QualityModel:
    """Fit on at most ``examples`` labelled documents (``label_id``, ``label``).

    The ``terms`` that most of the examples have make up the space. With no examples every score
    is one half; with fewer examples than dimensions there are fewer dimensions.
    """
    rows = sample_features(docs, labels, terms_of, examples, text, id)
    found = [features.reshape(-1, 2) for _, features in rows]
    values, seen = np.unique(np.concatenate([f[:, 0] for f in found] or [[]]), return_counts=True)
    most = np.lexsort((values, -seen))[:terms]
    keep = np.sort(most)
    known, seen = values[keep].astype(np.int64), seen[keep]
    model = QualityModel(
        known,
        (known % 4).astype(np.intp),
        np.log((1 + len(rows)) / (1 + seen)) + 1,
        np.zeros((len(known), 0)),
        np.zeros((0, 0)),
        np.array([label for label, _ in rows], float),
        neighbours,
    )
    table = np.zeros((len(rows), len(known)), np.float32)
    for k, f in enumerate(found):
        place = np.searchsorted(known, f[:, 0])
        here = (place < len(known)) & (known[np.minimum(place, len(known) - 1)] == f[:, 0])
        table[k, place[here]] = weighted(model, place[here], f[here, 1])
    model.projection = leading_directions(table, dimensions)
    model.vectors = units(table @ model.projection).astype(np.float32)
    model.projection = model.projection.astype(np.float32)
    return model


def leading_directions(table: np.ndarray, dimensions: int, rounds: int = 4) -> np.ndarray:
    """The leading right singular vectors, by iterating on a random subspace of fixed seed."""
    width = min(dimensions + 16, *table.shape)
    if not width:
        return np.zeros((table.shape[1], 0), np.float32)
    space = np.random.default_rng(0).standard_normal((table.shape[1], width)).astype(np.float32)
    for _ in range(rounds):
        rows = np.linalg.qr(table @ space)[0]
        space = np.linalg.qr(table.T @ rows)[0]
    within = np.linalg.svd(table @ space, full_matrices=False)[2]
    return (space @ within.T[:, :dimensions]).astype(np.float32)


class Scorer:
    """Vectors of documents for a model, with a bounded memory of the words' terms."""

    def __init__(self, model: QualityModel):
        self.model = model
        self.places = {t: k for k, t in enumerate(model.terms.tolist())}
        self.words: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def code(self, word: str) -> int:
        """Places of the word's shape and plain form, one more than they are, in one number."""
        code = self.older.get(word)
        if code is None:
            plain = EDGES.sub("", word).lower()
            a = self.places.get(term(SHAPE, shape(word)), -1) + 1
            b = self.places.get(term(WORD, plain), -1) + 1 if plain else 0
            code = a << 32 | b
        if len(self.words) >= REMEMBERED:
            self.older, self.words = self.words, {}
        self.words[word] = code
        return code

    def vector(self, text: str) -> np.ndarray:
        words = text.split()
        known, slow = self.words.get, self.code
        codes = np.array([c if (c := known(w)) is not None else slow(w) for w in words], np.int64)
        form = [self.places.get(t, -1) + 1 for t in forms(text, words)]
        places = np.concatenate([codes >> 32, codes & 0xFFFFFFFF, form]).astype(np.int64)
        counts = np.bincount(places, minlength=1)
        index = np.flatnonzero(counts[1:])
        return self.model.vector(index, counts[1:][index])


def score_quality(
    docs: DataFrame,
    model: QualityModel,
    text: str = "text",
    threshold: float = 0.3,
    keep: list[str] | None = None,
) -> DataFrame:
    """Every row of ``docs`` as the struct ``row`` (all columns, or those to ``keep``), with ``score`` and ``predicted`` (0 or 1).

    NULL texts count as empty; an empty text has its length and lack of lines for terms, so it has
    a score as well. The broadcast model is bounded by the sizes given to ``fit_quality``: about
    3 MB by default. Whole texts are scored; no other column is read.
    """
    rows = docs.select(
        row_of(docs, keep),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in slices(batches):
            vectors = [scorer.vector(t) for t in batch.column(1).to_pylist()]
            made = np.zeros(0) if not vectors else shared.value.score(
                units(np.stack(vectors)).astype(np.float32)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.float64())], ["row", "score"]
            )

    schema = f"row {rows.schema['row'].dataType.simpleString()}, score double"
    scored = rows.mapInArrow(score, schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
