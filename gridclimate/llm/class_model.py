"""Language-model scores from a Brown class model.

Every word of the training texts belongs to one class; the probability of a text is the product of
class transitions and of words given their class. Exchange clustering finds the classes of the most
frequent words: they are moved one by one, each to the class that gains the most likelihood, on
their counted neighbours, and stay there. All other words follow by the classes of their neighbours
in the whole corpus: first the listed ones, in batches that are kept if the likelihood, counted
anew, is higher with them, then the rest, of any number, in a table of Spark. The number of classes
grows with the vocabulary. A word that was never seen has no class: it takes the share of tokens
that were seen only once, and leaves the state as it is.

The texts are read twice to fit: for the counts of all words, and to write the places of tokens as
integers, on which every further pass runs. The most frequent words reach the executors in a table
of bounded size; whatever concerns the others is grouped and joined by Spark.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import slices_of_bytes
from .stored import stored

LONGEST = 64  # bytes of a listed word
LISTED = 1 << 18
CORE = 512
STRENGTH = 20.0  # tokens that the classes' shares count for in a state's transitions
KEPT_KEYS = 1 << 20  # different keys that a task counts before it sends them on
PARTS = 64  # that listed words are dealt out to
TEXT_BYTES = 2 << 20


def words_of(text: str | None) -> list[bytes]:
    """Words between the six blanks of ASCII; letters A to Z count as lower case."""
    return (text or "").encode().lower().split()


def class_number(vocabulary: int) -> int:
    """The number of classes for so many different words: their cube root, eight at least."""
    return max(8, round(vocabulary ** (1 / 3)))


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` (bytes) and ``count`` over the only column, a text."""

    def rows(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "count"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices_of_bytes(batches, 0, TEXT_BYTES):
            for text in batch.column(0).to_pylist():
                counts.update(words_of(text))
            if len(counts) > KEPT_KEYS // 4:
                yield rows(counts)
                counts = Counter()
        yield rows(counts)

    made = texts.mapInArrow(count, "word binary, count long")
    return made.groupBy("word").agg(F.sum("count").alias("count"))


@dataclass
class Listed:
    """The most frequent words in order, their counts, and their classes, -1 as long as they have
    none. The end of a text is a class of its own, and so are words without a class."""

    words: list[bytes]
    counts: np.ndarray
    classes: np.ndarray
    n_classes: int

    @property
    def end(self) -> int:
        return self.n_classes

    @property
    def none(self) -> int:
        return self.n_classes + 1

    @property
    def size(self) -> int:
        return self.n_classes + 2

    def class_of(self) -> np.ndarray:
        """Class by place: after the words that of the end and, also at place -1, no class."""
        own = np.where(self.classes < 0, self.none, self.classes)
        return np.concatenate([own, [self.end, self.none]]).astype(np.int64)

    def reader(self) -> "Reader":
        return Reader(self.words)


class Reader:
    """Places of words: that of the end is behind all words, -1 that of an unlisted word."""

    def __init__(self, words: list[bytes]):
        self.places = {w: k for k, w in enumerate(words)}
        self.end_place = len(words)

    def read(self, texts: list) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Places of all tokens, each text followed by an end; tokens of each text; all words."""
        places, words, lengths = [], [], []
        for text in texts:
            own = words_of(text)
            places.extend(map(self.places.get, own, repeat(-1)))
            places.append(self.end_place)
            words.extend(own)
            words.append(b"")
            lengths.append(len(own) + 1)
        return np.array(places, np.int32), np.array(lengths, np.int64), words


def read_tokens(texts: DataFrame, listed: Listed) -> DataFrame:
    """Pieces of the texts: ``places`` (packed integers) and the unlisted words in order."""
    shared = texts.sparkSession.sparkContext.broadcast(listed.words)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in slices_of_bytes(batches, 0, TEXT_BYTES):
            places, _, words = reader.read(batch.column(0).to_pylist())
            others = [words[k] for k in np.flatnonzero(places < 0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([places.tobytes()], pa.binary()), pa.array([others], pa.list_(pa.binary()))],
                ["places", "others"],
            )

    return texts.mapInArrow(make, "places binary, others array<binary>")


class Neighbours:
    """Counts of the classes next to words, sent on as a block for each part of the words.

    A key is the word's number times two plus the side, times the number of classes, plus the
    class; words are numbered within their part.
    """

    def __init__(self, size: int):
        self.size = size
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, word: np.ndarray, before: np.ndarray, after: np.ndarray) -> Iterator[pa.RecordBatch]:
        # The part comes first, so that keys in order are in order of parts.
        own = ((word % PARTS << 32) + word // PARTS) * 2
        keys, counts = np.unique(
            np.concatenate([own * self.size + before, (own + 1) * self.size + after]), return_counts=True
        )
        keys, at = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        counts = np.concatenate([self.counts, counts])
        self.keys, self.counts = keys, np.bincount(at, counts, len(keys)).astype(np.int64)
        if len(keys) > KEPT_KEYS:
            yield self.blocks()

    def blocks(self) -> pa.RecordBatch:
        width = 2 * self.size << 32
        part, key = self.keys // width, self.keys % width
        found, begins = np.unique(part, return_index=True)
        ends = np.append(begins[1:], len(part)) if len(found) else begins
        rows = [
            (int(p), key[b:e].astype("<u8").tobytes(), self.counts[b:e].astype("<u4").tobytes())
            for p, b, e in zip(found, begins, ends)
        ]
        columns = list(zip(*rows)) or [()] * 3
        self.__init__(self.size)
        kinds = [pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "keys", "counts"]
        )


def pairs_counted(tokens: DataFrame, make, size: int) -> np.ndarray:
    """How often ``make`` gives each pair of numbers below ``size``, over all tokens.

    ``make`` takes the places of some texts and gives the pairs, each as one number.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                keys = make(np.frombuffer(packed.as_buffer(), np.int32))
                total += np.bincount(keys, minlength=size * size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["at", "n"])

    found = tokens.select("places").mapInArrow(count, "at long, n long")
    rows = found.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(size * size)
    total[rows.column("at").to_numpy()] = rows.column("n").to_numpy()
    return total.reshape(size, size)


def core_bigrams(tokens: DataFrame, core: int) -> np.ndarray:
    def make(places: np.ndarray) -> np.ndarray:
        near = (places >= 0) & (places < core)
        both = near[:-1] & near[1:]
        return places[:-1][both].astype(np.int64) * core + places[1:][both]

    return pairs_counted(tokens, make, core)


def class_pairs(tokens: DataFrame, listed: Listed) -> np.ndarray:
    """Bigrams of classes; words without one count as one class."""
    size, end = listed.size, listed.end
    shared = tokens.sparkSession.sparkContext.broadcast(listed.class_of())

    def make(places: np.ndarray) -> np.ndarray:
        found = shared.value[places]
        return np.concatenate([[end], found[:-1]]) * size + found

    return pairs_counted(tokens, make, size)


def neighbours(tokens: DataFrame, listed: Listed, low: int, high: int) -> DataFrame:
    """The classes before and after the words from ``low`` below ``high``, as ``Neighbours``."""
    size, end = listed.size, listed.end
    shared = tokens.sparkSession.sparkContext.broadcast(listed.class_of())

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Neighbours(size)
        for batch in batches:
            for packed in batch.column(0):
                places = np.frombuffer(packed.as_buffer(), np.int32)
                found = shared.value[places]
                at = np.flatnonzero((places >= low) & (places < high))
                # An end is behind each text, so a word has a next token.
                before = np.where(at > 0, found[at - 1], end)
                yield from counts.add((places[at] - low).astype(np.int64), before, found[at + 1])
        yield counts.blocks()

    return tokens.select("places").mapInArrow(make, "part int, keys binary, counts binary")


def xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def exchange(bigrams: np.ndarray, n_classes: int, sweeps: int = 8) -> np.ndarray:
    """Classes of words by the exchange algorithm on their bigram counts.

    Words begin in turn in all classes and are moved in order of frequency until none moves.
    """
    words = len(bigrams)
    n_classes = max(1, min(n_classes, words))
    classes = np.arange(words) % n_classes
    member = np.eye(n_classes)[classes] if words else np.zeros((0, n_classes))
    between = member.T @ bigrams @ member
    for _ in range(sweeps):
        moved = 0
        for w in range(words):
            own = classes[w]
            member[w] = 0
            after, before = bigrams[w] @ member, member.T @ bigrams[:, w]
            again = bigrams[w, w]
            between[own] -= after
            between[:, own] -= before
            between[own, own] -= again
            # Totals with the word's neighbours, who keep their classes wherever it goes.
            out, into = between.sum(1) + before, between.sum(0) + after
            row = xlogx(between + after[None, :]) - xlogx(between)
            column = xlogx(between + before[:, None]) - xlogx(between)
            corner = np.diag(between)
            gain = row.sum(1) - np.diag(row) + column.sum(0) - np.diag(column)
            gain += xlogx(corner + after + before + again)
            gain -= xlogx(corner)
            gain -= xlogx(out + after.sum() + again) - xlogx(out)
            gain -= xlogx(into + before.sum() + again) - xlogx(into)
            best = int(gain.argmax())
            if gain[best] <= gain[own] + 1e-9:
                best = own
            classes[w], member[w, best] = best, 1
            between[best] += after
            between[:, best] += before
            between[best, best] += again
            moved += best != own
        if not moved:
            break
    return classes


def likelihood(between: np.ndarray) -> float:
    """Of class bigrams, as far as it depends on the classes."""
    return float(xlogx(between).sum() - xlogx(between.sum(1)).sum() - xlogx(between.sum(0)).sum())


def best_classes(
    word: np.ndarray, side: np.ndarray, near: np.ndarray, n: np.ndarray, between: np.ndarray,
    n_classes: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different words, the class of each that gains the most likelihood, and that gain.

    Entry k says that ``word`` k has ``n`` tokens of class ``near`` before (side 0) or after it.
    The gain is that of the class bigrams ``between`` to the first order of the word's counts, over
    the average class.
    """
    order = np.argsort(word, kind="stable")
    word, side, near, n = word[order], side[order], near[order], n[order]
    words, begins = np.unique(word, return_index=True)
    if not len(words):
        return words, np.zeros(0, np.int64), np.zeros(0)
    logs = np.log(between + 0.5)
    out, into = np.log(between.sum(1) + 0.5), np.log(between.sum(0) + 0.5)
    # By neighbour and class: what a token gains before that neighbour, and after it.
    tables = np.stack([(logs - into).T[:n_classes].T, (logs.T - out)[:, :n_classes]])
    gains = np.zeros((len(words), n_classes))
    place = np.repeat(np.arange(len(words)), np.diff(np.append(begins, len(word))))
    for part in np.array_split(np.arange(len(word)), len(word) // 16384 + 1):
        if len(part):
            rows = tables[side[part], near[part]] * n[part, None]
            first = np.flatnonzero(np.diff(place[part], prepend=-1))
            gains[place[part][first]] += np.add.reduceat(rows, first)
    best = gains.argmax(1)
    return words, best, gains.max(1) - gains.mean(1)


def listed_moves(found: DataFrame, between: np.ndarray, listed: Listed, low: int) -> pa.Table:
    """``word`` (place), ``best`` class and ``gain`` of the words whose neighbours were counted."""
    size, n_classes = listed.size, listed.n_classes
    shared = found.sparkSession.sparkContext.broadcast(between)

    def choose(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        whole = lambda name, kind: np.concatenate(
            [np.frombuffer(b, kind) for b in table.column(name).to_pylist()]
        ).astype(np.int64)
        at, n = whole("keys", "<u8"), whole("counts", "<u4")
        words, best, gain = best_classes(
            at // (2 * size), at // size % 2, at % size, n, shared.value, n_classes
        )
        return pa.table({"word": words * PARTS + key[0].as_py() + low, "best": best, "gain": gain})

    return found.groupBy("part").applyInArrow(choose, "word long, best long, gain double").toArrow()


def classes_of_listed(tokens: DataFrame, listed: Listed, core: int) -> tuple[Listed, np.ndarray]:
    """The listed words from ``core`` on in classes, and the bigrams of all classes.

    Batches grow fourfold, as the more frequent words say more about the others. Words of a batch
    are moved at once; while that doesn't raise the likelihood of all class bigrams, counted anew,
    the half of the moves that gains less waits for a class until all others have one.
    """
    between, waiting = class_pairs(tokens, listed), []
    while core < len(listed.words):
        high = min(len(listed.words), 4 * core)
        moves = listed_moves(neighbours(tokens, listed, core, high), between, listed, core)
        place, best, gain = (moves.column(c).to_numpy() for c in ("word", "best", "gain"))
        order = np.lexsort((place, -gain))
        while True:
            classes = listed.classes.copy()
            classes[place[order]] = best[order]
            moved = Listed(listed.words, listed.counts, classes, listed.n_classes)
            counted = class_pairs(tokens, moved)
            if len(order) < 2 or likelihood(counted) > likelihood(between):
                break
            waiting.append((place[order[len(order) // 2 :]], best[order[len(order) // 2 :]]))
            order = order[: len(order) // 2]
        listed, between, core = moved, counted, high
    if waiting:
        for place, best in waiting:
            listed.classes[place] = best
        between = class_pairs(tokens, listed)
    return listed, between


OTHERS = "word binary, second binary, before int, after int, n long"


def others_near(tokens: DataFrame, listed: Listed) -> DataFrame:
    """Unlisted words with the classes before and after them, and pairs of them in a row."""
    shared = tokens.sparkSession.sparkContext.broadcast(listed.class_of())
    end = listed.end

    def rows(word, second, before, after, n) -> pa.RecordBatch:
        kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip((word, second, before, after, n), kinds)]
        return pa.RecordBatch.from_arrays(arrays, ["word", "second", "before", "after", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Only words that are too long to be listed may be frequent: they are counted here.
        frequent: Counter = Counter()
        for batch in batches:
            for packed, others in zip(batch.column(0), batch.column(1)):
                places = np.frombuffer(packed.as_buffer(), np.int32)
                words = others.values
                at = np.flatnonzero(places < 0)
                found = shared.value[places]
                before, after = np.where(at > 0, found[at - 1], end), found[at + 1]
                long = pc.greater(pc.binary_length(words), LONGEST).to_numpy(zero_copy_only=False)
                k = np.flatnonzero(~long)
                few = len(k)
                yield rows(words.take(pa.array(k)), pa.nulls(few, pa.binary()), before[k], after[k], np.ones(few, int))
                k = np.flatnonzero(long)
                frequent.update(zip(words.take(pa.array(k)).to_pylist(), repeat(None), before[k].tolist(), after[k].tolist()))
                k = np.flatnonzero(np.diff(at) == 1)
                firsts, seconds = words.take(pa.array(k)).to_pylist(), words.take(pa.array(k + 1)).to_pylist()
                frequent.update(zip(firsts, seconds, repeat(None), repeat(None)))
                if len(frequent) > KEPT_KEYS // 4:
                    yield rows(*zip(*frequent), frequent.values())
                    frequent = Counter()
        if frequent:
            yield rows(*zip(*frequent), frequent.values())

    return tokens.mapInArrow(count, OTHERS)


def classes_of_others(
    tokens: DataFrame, listed: Listed, between: np.ndarray
) -> tuple[DataFrame, np.ndarray]:
    """``word``, ``class``, ``count`` of the unlisted words, and the bigrams they take part in.

    Each token of such a word gives a row; none is frequent but those that are counted before.
    """
    size, n_classes, none = listed.size, listed.n_classes, listed.none
    shared = tokens.sparkSession.sparkContext.broadcast(between)
    near = stored(others_near(tokens, listed), "others_near")

    def choose(table: pa.Table) -> pa.Table:
        coded = table.column("word").combine_chunks().dictionary_encode()
        words, word = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        before, after, n = (table.column(c).to_numpy().astype(np.int64) for c in ("before", "after", "n"))
        side = np.repeat([0, 1], len(word))
        _, best, _ = best_classes(
            np.tile(word, 2), side, np.concatenate([before, after]), np.tile(n, 2), shared.value, n_classes
        )
        own = best[word]
        # A neighbour that is unlisted as well is counted with the pairs of such words.
        keys = np.concatenate([(before * size + own)[before != none], (own * size + after)[after != none]])
        times = np.concatenate([n[before != none], n[after != none]])
        total = np.bincount(keys, times, size * size).astype(np.int64)
        some = np.flatnonzero(total)
        # Words with their class and count, then pairs of classes.
        return pa.table({
            "word": pa.concat_arrays([words, pa.nulls(len(some), pa.binary())]),
            "at": pa.array(np.concatenate([best, some])),
            "n": pa.array(np.concatenate([np.bincount(word, n, len(words)).astype(np.int64), total[some]])),
        })

    buckets = 4 * int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = near.where("second IS NULL").withColumn("part", F.pmod(F.xxhash64("word"), F.lit(buckets)))
    chosen = stored(
        rows.groupBy("part").applyInArrow(choose, "word binary, at long, n long"), "chosen"
    )
    classes = chosen.where("word IS NOT NULL").select(
        "word", F.col("at").alias("class"), F.col("n").alias("count")
    )
    of = lambda name: classes.select(F.col("word").alias(name), F.col("class").alias(f"{name}_class"))
    twice = (
        near.where("second IS NOT NULL").groupBy("word", "second").agg(F.sum("n").alias("n"))
        .join(of("word"), "word").join(of("second"), "second")
        .select((F.col("word_class") * size + F.col("second_class")).alias("at"), "n")
    )
    sums = chosen.where("word IS NULL").select("at", "n").unionByName(twice).groupBy("at").agg(
        F.sum("n").alias("n")
    ).toArrow()  # a row for each pair of classes
    total = np.zeros(size * size)
    total[sums.column("at").to_numpy()] = sums.column("n").to_numpy()
    return classes, total.reshape(size, size)


@dataclass
class ClassModel:
    """Listed words with their classes, counts, and tables of logarithms to base 10."""

    listed: Listed
    train_tokens: int
    ends: int
    base_divisor: float
    transition: np.ndarray  # state, class; the last of both is the end
    class_total: np.ndarray  # logarithm of the tokens of each class
    unseen: float  # of any one word that was never seen

    def emission(self) -> np.ndarray:
        """By place; 0 for the end and unlisted words."""
        own = np.log10(self.listed.counts) - self.class_total[self.listed.classes]
        return np.concatenate([own, [0.0, 0.0]])


def fit_class_model(
    docs: DataFrame,
    text: str = "text",
    core: int = CORE,
    n_classes: int | None = None,
    listed: int = LISTED,
) -> tuple[ClassModel, DataFrame]:
    """The model of all texts, and ``word``, ``class``, ``count`` of the words not listed in it.

    The most frequent words of at most 64 bytes, up to ``listed``, are broadcast, 19 MB at most.
    The ``core`` first of them, at least two for each class, are exchanged one by one, the others in
    batches, words that aren't listed all at once. There are ``n_classes`` classes, unless given the
    cube root of the number of words. NULL texts count as empty. Without texts no word is known.
    """
    texts = docs.select(F.col(f"`{text}`").alias("text"))
    counts = stored(word_counts(texts), "word_counts")
    single = F.count_if(F.col("count") == 1)
    tokens, distinct, once = counts.agg(F.sum("count"), F.count("*"), single).first()
    ends = texts.count()
    n = (tokens or 0) + ends
    words, seen = most_frequent(counts, listed)
    core = min(len(words), max(core, 2 * (n_classes or class_number(distinct))))
    n_classes = max(1, min(n_classes or class_number(distinct), core))

    table = Listed(words, seen, np.full(len(words), -1), n_classes)
    read = stored(read_tokens(texts, table), "tokens")
    table.classes[:core] = exchange(core_bigrams(read, core), n_classes)
    table, between = classes_of_listed(read, table, core)
    others, more = classes_of_others(read, table, between)
    pairs = (between + more)[:-1, :-1]

    states = n_classes + 1
    of_class = pairs.sum(0)
    share = (of_class + 0.5) / (of_class.sum() + 0.5 * states)
    transition = (pairs + STRENGTH * share) / (pairs.sum(1, keepdims=True) + STRENGTH)
    unseen = (once + 0.5) / (n + 1)
    model = ClassModel(
        table, n, ends, n + 0.5 * (distinct + (ends > 0) + 1), np.log10((1 - unseen) * transition),
        np.log10(np.maximum(of_class, 1)), float(np.log10(unseen / (distinct + 1))),
    )
    return model, others


def most_frequent(counts: DataFrame, most: int) -> tuple[list[bytes], np.ndarray]:
    """The most frequent words, ``most`` or somewhat fewer, and their counts, in order.

    A count has to be above a level, which comes from how many words there are per sixteenth of a
    doubling; so no task ranks the words, and only those asked for are collected.
    """
    short = counts.where(F.octet_length("word") <= LONGEST)
    level = F.floor(F.log2("count") * 16).cast("int")
    steps = short.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    lowest, total = None, 0
    for step in steps:
        total += step["count"]
        if total > most:
            break
        lowest = step["level"]
    top = short.where(level >= lowest if lowest is not None else F.lit(False)).toArrow()
    rows = sorted(
        zip(top.column("count").to_pylist(), top.column("word").to_pylist()),
        key=lambda r: (-r[0], r[1]),
    )
    return [word for _, word in rows], np.array([count for count, _ in rows], np.int64)


SCORED = (
    "row long, n_tokens long, known long, base double, score double, "
    "runs array<struct<before:int,after:int,words:array<binary>>>"
)


def word_runs(places: np.ndarray, found: np.ndarray, words: list[bytes], end: int, begins: np.ndarray):
    """For each text a list of its runs of unlisted words: the states before and after, the words."""
    at = np.flatnonzero(places < 0)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    last = np.append(first[1:], len(at)) - 1
    before = np.where(at[first] > 0, found[at[first] - 1], end) if len(at) else at
    after = found[at[last] + 1] if len(at) else at
    flat = pa.array([words[k] for k in at], pa.binary())
    inner = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)).astype(np.int32)), flat)
    fields = [pa.array(before.astype(np.int32)), pa.array(after.astype(np.int32)), inner]
    runs = pa.StructArray.from_arrays(fields, ["before", "after", "words"])
    of_text = np.append(np.searchsorted(at[first], begins), len(first)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(of_text), runs)


def run_scores(model: ClassModel, before, after, lengths, classes, counts):
    """The score of runs of words with their classes (-1: never seen) and counts, and of the step
    that follows each run."""
    begins = np.cumsum(lengths + 1) - lengths - 1
    of_run = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(classes)) + of_run + 1
    # The state before each run, then its words, one run after another.
    states = np.full(len(classes) + len(lengths), -1, np.int64)
    states[begins], states[at] = before, classes
    last = np.maximum.accumulate(np.where(states >= 0, np.arange(len(states)), -1))
    seen = classes >= 0
    own = np.maximum(classes, 0)
    steps = model.transition[states[last[at - 1]], own] + np.log10(np.maximum(counts, 1))
    steps = np.where(seen, steps - model.class_total[own], model.unseen)
    scores = np.bincount(of_run, steps, len(lengths))
    return scores + model.transition[states[last[begins + lengths]], after]


def score_texts(
    docs: DataFrame, model: ClassModel, others: DataFrame, text: str = "text",
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: the columns of ``keep`` (unless given the struct ``row`` of all
    columns), ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and
    ``perplexity``.

    Scores are logarithms to base 10 of a text's probability. NULL texts count as empty: one
    token, the end. Words that aren't listed are joined with their classes and counts; none of
    them can be frequent but those of over 64 bytes.
    """
    if keep is None:
        keep = {"row": F.struct(*[F.col(f"`{c}`") for c in docs.columns])}
    names = list(keep)
    rows = docs.select(
        F.col(f"`{text}`").alias("text"), F.struct(*[c.alias(k) for k, c in keep.items()]).alias("keep")
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = rows.withColumn("row", F.monotonically_increasing_id())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        listed, reader, emission = model.listed, model.listed.reader(), model.emission()
        class_of, none = listed.class_of(), listed.none
        base_of = np.log10(np.concatenate([listed.counts, [model.ends, 0]]) + 0.5)
        base_of -= np.log10(model.base_divisor)
        base_of[-1] = 0.0
        for batch in slices_of_bytes(batches, 0, TEXT_BYTES):
            if not batch.num_rows:
                continue
            places, lengths, words = reader.read(batch.column(0).to_pylist())
            begins = np.cumsum(lengths) - lengths
            found = class_of[places]
            before = np.concatenate([[listed.end], found[:-1]])
            steps = emission[places].copy()
            both = (found != none) & (before != none)
            steps[both] += model.transition[before[both], found[both]]
            known = (places >= 0) & ((places != reader.end_place) | (model.ends > 0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(2),
                    pa.array(lengths),
                    pa.array(np.add.reduceat(known.astype(np.int64), begins)),
                    pa.array(np.add.reduceat(base_of[places], begins)),
                    pa.array(np.add.reduceat(steps, begins)),
                    word_runs(places, found, words, listed.end, begins),
                ],
                ["keep", "row", "n_tokens", "known", "base", "score", "runs"],
            )

    kind = rows.schema["keep"].dataType.simpleString()
    scored = stored(
        rows.select("text", "keep", "row").mapInArrow(score, f"keep {kind}, {SCORED}"), "scored"
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            row, before, after, items = batch.columns
            lengths = np.diff(items.offsets.to_numpy())
            _, classes, counts = (c.to_numpy(zero_copy_only=False) for c in items.flatten().flatten())
            scores = run_scores(model, before.to_numpy(), after.to_numpy(), lengths, classes, counts)
            of_run = np.repeat(np.arange(len(lengths)), lengths)
            logs = np.bincount(of_run, np.log10(counts + 0.5), len(lengths))
            known = np.bincount(of_run, counts > 0, len(lengths)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(scores), pa.array(logs), pa.array(lengths.astype(np.int64)), pa.array(known)],
                ["row", "more", "logs", "times", "rest_known"],
            )

    # Most runs are of one word, and need not be gathered after the join.
    run = scored.select("row", F.posexplode("runs").alias("run", "r"))
    each = run.select(
        "row", "run", "r.before", "r.after", F.size("r.words").alias("length"),
        F.posexplode("r.words").alias("place", "word"),
    )
    item = F.struct(
        "place", F.coalesce("class", F.lit(-1)).cast("long").alias("class"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"),
    )
    joined = each.join(others, "word", "left").select("row", "run", "before", "after", "length", item.alias("item"))
    runs = joined.where("length > 1").groupBy("row", "run").agg(
        F.first("before").alias("before"), F.first("after").alias("after"),
        F.sort_array(F.collect_list("item")).alias("items"),
    ).select("row", "before", "after", "items").unionByName(
        joined.where("length = 1").select("row", "before", "after", F.array("item").alias("items"))
    )
    rest = runs.mapInArrow(
        finish, "row long, more double, logs double, times long, rest_known long"
    ).groupBy("row").agg(*[F.sum(c).alias(c) for c in ("more", "logs", "times", "rest_known")])
    whole = scored.drop("runs").join(rest, "row", "left").na.fill(
        {"more": 0.0, "logs": 0.0, "times": 0, "rest_known": 0}
    )
    total = F.col("score") + F.col("more")
    logs = F.col("logs") - F.col("times") * float(np.log10(model.base_divisor))
    return whole.select(
        *[F.col("keep")[k].alias(k) for k in names],
        "n_tokens",
        (F.col("known") + F.col("rest_known")).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        total.alias("score"),
        F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"),
    )
