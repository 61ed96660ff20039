"""Periodic runs of words in each document, by seeds on diagonals.

A run of smallest period ``q`` is a stretch of words that equal the words ``q`` further on: on the
diagonal of lag ``q`` a stretch of equal pairs, at least ``overlap(q)`` long. Lags are taken in
bands from a power of two to the next. All runs of a band share so many pairs at least that a
k-gram of that length, no shorter than the band's lags, occurs in them at each place and again
``q`` words on, and by the periodicity lemma not in between. So the k-grams of a document are
indexed, the pairs of each occurrence with the next one are enumerated, and those whose lag is in
the band are seeds. Seeds of one lag are extended to both sides word by word; a table of how far
each lag has been covered skips seeds inside of a stretch that is known already.

The work of a document is its words times the bands, at most a logarithm of its length.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from .arrow import row_of, slices_of_bytes

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Places of the keys that may occur more than once, all that do among them."""
    places = 1 << (4 * len(keys)).bit_length()
    slot = (keys & np.uint64(places - 1)).astype(np.int64)
    return np.flatnonzero(np.bincount(slot, minlength=places)[slot] > 1)


def next_occurrences(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each place whose key occurs again, with the next place of that key; places ascend."""
    some = repeated(keys)
    keys, places = keys[some], places[some]
    order = np.argsort(keys, kind="stable")
    keys, places = keys[order], places[order]
    same = keys[1:] == keys[:-1]
    return places[:-1][same], places[1:][same]


class Diagonals:
    """Runs of several documents whose words stand one after another.

    ``words`` are numbers, equal for equal words; ``ends`` is where each document ends.
    """

    def __init__(self, words: np.ndarray, ends: np.ndarray, least: int, exponent: int):
        self.words, self.least, self.exponent = words, least, exponent
        lengths = np.diff(ends, prepend=0)
        self.end = np.repeat(ends, lengths)
        self.begin = self.end - np.repeat(lengths, lengths)
        self.doc = np.repeat(np.arange(len(ends)), lengths)
        self.runs: list[tuple[int, int, int, int]] = []  # document, start, length, period
        # Words of different documents differ, so no stretch passes the end of one.
        grams = [mixed(words.astype(np.uint64) + mixed(self.doc.astype(np.uint64)))]
        band = 0
        while True:
            lags = np.arange(1 << band, 2 << band) if band < 4 else np.array([1 << band])
            k = int(self.overlap(lags).min())
            shortest = int(self.whole(lags).min())
            inside = np.flatnonzero(self.end - self.begin >= shortest)
            if not len(inside):
                break
            while 2 << (len(grams) - 1) <= k:
                grams.append(self.doubled(grams[-1], 1 << (len(grams) - 1)))
            self.seeds(self.grams(grams, k, inside), 1 << band, k)
            band += 1
        self.runs.sort()

    def overlap(self, lag):
        """Equal pairs on the diagonal of a run of that period, at least."""
        return np.maximum(self.least - lag, (self.exponent - 1) * lag)

    def whole(self, lag):
        return np.maximum(self.least, self.exponent * lag)

    @staticmethod
    def doubled(grams: np.ndarray, width: int) -> np.ndarray:
        """Hashes of twice as many words from those of ``width``; the last ones mean nothing."""
        out = mixed(grams * np.uint64(0x9E3779B97F4A7C15))
        out[: len(grams) - width] += grams[width:]
        return mixed(out)

    def grams(self, grams: list[np.ndarray], k: int, inside: np.ndarray):
        """Hashes and places of the k-grams that end within their document."""
        places = inside[self.end[inside] - inside >= k]
        level = k.bit_length() - 1
        return self.both(grams[level], places, k - (1 << level)), places

    @staticmethod
    def both(grams: np.ndarray, places: np.ndarray, apart: int) -> np.ndarray:
        if not apart:
            return grams[places]
        return mixed(mixed(grams[places]) * np.uint64(0xD6E8FEB86659FD93) + grams[places + apart])

    def seeds(self, found, low: int, k: int) -> None:
        """Seeds with a lag from ``low`` to less than twice that, as runs."""
        here, there = next_occurrences(*found)
        lag = there - here
        some = (lag >= low) & (lag < 2 * low)
        here, lag = here[some], lag[some]
        order = np.lexsort((here, lag))
        here, lag = here[order], lag[order]
        # Neighbouring seeds overlap: one chain, extended once.
        first = np.ones(len(here), bool)
        first[1:] = (np.diff(lag) != 0) | (np.diff(here) > 1)
        covered: dict[int, int] = {}
        for start, q in zip(here[first].tolist(), lag[first].tolist()):
            if start < covered.get(q, 0):
                continue
            left, right = self.extended(start, q)
            covered[q] = max(right, covered.get(q, 0))
            if right + q - left >= self.whole(q):
                at = int(self.doc[left])
                self.runs.append((at, left - int(self.begin[left]), right + q - left, q))

    def extended(self, place: int, lag: int) -> tuple[int, int]:
        """The stretch of equal pairs around a place, empty if the pair there differs."""
        begin, end = int(self.begin[place]), int(self.end[place]) - lag
        right = place + self.alike(place, end, lag, 1)
        left = place - self.alike(place - 1, begin - 1, lag, -1) if right > place else place
        return left, right

    def alike(self, place: int, stop: int, lag: int, step: int) -> int:
        """How many pairs from ``place`` towards ``stop`` are equal, looked at in growing pieces."""
        total, piece = 0, 16
        while place != stop:
            some = min(piece, abs(stop - place))
            low = place if step > 0 else place - some + 1
            equal = self.words[low : low + some] == self.words[low + lag : low + lag + some]
            equal = equal[::step]
            if not equal.all():
                return total + int(equal.argmin())
            total, place, piece = total + some, place + step * some, 2 * piece
        return total


def runs_of(texts: list[str | None], least: int, exponent: int):
    """Words of each text, and (document, start, length, period) of all runs in order."""
    split = [(text or "").encode().split() for text in texts]
    seen: dict[bytes, int] = {}
    ends = np.cumsum([len(words) for words in split], dtype=np.int64)
    total = int(ends[-1]) if len(split) else 0
    flat = (word for words in split for word in words)
    numbers = np.fromiter(map(seen.setdefault, flat, range(total)), np.int64, total)
    return split, Diagonals(numbers, ends, least, exponent).runs


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Without the words that a run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [word for word, over in zip(words, np.cumsum(change)) if not over]


def find_runs(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    least: int = 6,
    exponent: int = 4,
    column: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``row``, ``n_words``, ``runs`` and ``collapsed``.

    ``row`` is a struct of the columns to keep, all unless given. Words are what the six blanks of
    ASCII separate, numbered from 0. ``runs`` lists start, length and smallest period, by start and
    period, of every stretch of at least ``least`` words and ``exponent`` periods that no
    neighbouring word extends. ``collapsed`` is the text without the words that a run contains
    after its first period, joined by single blanks. NULL, empty and blank texts have no words, no
    runs and an empty ``collapsed``. Repeated rows are found alike, each on its own. ``column``
    replaces the text.
    """
    if exponent < 3 or least < 1:
        raise ValueError("runs need an exponent of at least 3 and a least length of at least 1")
    rows = docs.select(row_of(docs, keep), (docs[text] if column is None else column).alias("text"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_of_bytes(batches, 1):
            split, found = runs_of(batch.column(1).to_pylist(), least, exponent)
            own: list[list] = [[] for _ in split]
            for doc, *run in found:
                own[doc].append(tuple(run))
            flat = np.array([run for runs in own for run in runs], np.int64).reshape(-1, 3)
            fields = [pa.array(flat[:, k]) for k in range(3)]
            offsets = np.concatenate([[0], np.cumsum([len(runs) for runs in own])])
            values = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
            texts = [b" ".join(collapsed(*x)).decode() for x in zip(split, own)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(words) for words in split], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values),
                    pa.array(texts, pa.string()),
                ],
                ["row", "n_words", "runs", "collapsed"],
            )

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(
        make, f"row {kind}, n_words long, runs array<{RUN}>, collapsed string"
    )
