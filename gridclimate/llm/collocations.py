"""Phrases whose words stand together more often than by chance, by stripes.

A stripe belongs to a prefix of words and counts the words that come next. Tasks make stripes of
what they read, merge them elementwise in memory of a fixed size, and send them on packed; what
tasks sent is merged elementwise once more. A merged stripe gives the counts of all extensions of
its prefix. The entry of a phrase's last word in the stripe of its other words is also the total of
the phrase as a prefix, so the left part of any cut is an entry of a shorter stripe, and the right
part one of the stripes of the phrase's end. The greatest extension of a phrase, to the right in its
own stripe, to the left in the stripes that end with it, tells whether a longer phrase subsumes it.

Stripes are made length by length, and only where both the prefix and the last words of a phrase,
all but the first, are frequent: a phrase is never more frequent than its parts, so nothing is
lost. Known frequent phrases are looked up in a bit table; what it lets pass in error is counted
and then falls below the threshold. From three words on, only the stretches of a text are read in
which frequent pairs follow one another.

Words are known by 64-bit hashes that depend on the language, prefixes by a hash of their words; an
entry is told apart by its prefix and its next word.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow import slices_of_bytes
from .stored import stored

ENDS = b",;:!?\n\x0b\x0c\r"  # and the full stop, which stands for all of them
BREAK = b"."
SPLIT = bytes.maketrans(ENDS, BREAK * len(ENDS))
TEXT_BYTES = 8 << 20  # of texts split at a time
KNOWN = 300_000  # words that a task remembers
ENTRIES = 1 << 21  # of stripes that a task holds before it sends them on
SLOTS = 16  # that a prefix's stripe is dealt out to
MOST_BITS = 1 << 26  # of a table of frequent phrases
SHIFTS = (0, 20, 38)
SALT = 64


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def extended(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The number of the phrase that a prefix and its next word make."""
    return mixed(prefix * np.uint64(0x9E3779B97F4A7C15) + word)


def word_id(lang: str, word: bytes) -> int:
    """Never 0, which stands for a break and for words that aren't frequent."""
    return xxhash.xxh3_64_intdigest(word, xxhash.xxh3_64_intdigest(lang)) or 1


def split_words(texts: list[str]) -> list[bytes]:
    """Words of all texts in order; a break stands between texts and between pieces of a text."""
    joined = b" . ".join(text.encode() for text in texts).lower()
    return joined.translate(SPLIT).replace(BREAK, b" . ").split()


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Language and words of texts of the same language, bounded pieces at a time."""
    for batch in slices_of_bytes(batches, 1, TEXT_BYTES, 10_000):
        texts: dict[str, list[str]] = {}
        for lang, text in zip(*(column.to_pylist() for column in batch.columns)):
            if text:
                texts.setdefault(lang, []).append(text)
        for lang, some in texts.items():
            yield lang, split_words(some)


def word_counts(docs: DataFrame, least: int) -> DataFrame:
    """``lang``, ``word``, ``n`` of words that are frequent; the language's total has no word."""

    def rows(counts: dict[str, Counter]) -> pa.RecordBatch:
        flat = [(lang, word, n) for lang, own in counts.items() for word, n in own.items()]
        lang, word, n = zip(*flat) if flat else ((), (), ())
        word = [None if x == BREAK else x.decode() for x in word]
        columns = [pa.array(lang, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for lang, words in by_language(batches):
            own = counts.setdefault(lang, Counter())
            total = own.pop(BREAK, 0)
            own.update(words)
            own[BREAK] = total + len(words) - own.pop(BREAK, 0)
            if sum(map(len, counts.values())) > KNOWN:
                yield rows(counts)
                counts = {}
        yield rows(counts)

    counted = docs.mapInArrow(make, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(
        F.col("word").isNull() | (F.col("n") >= least)
    )


def with_ids(words: DataFrame) -> DataFrame:
    """Phrases of one word: their number, and what longer ones are built from."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(*(batch.column(k).to_pylist() for k in range(2)))
            ids = np.array([word_id(lang, word.encode()) for lang, word in pairs], np.uint64)
            yield batch.append_column("id", pa.array(ids.view(np.int64)))

    ids = words.mapInArrow(make, "lang string, word string, n long, id long")
    none = F.array().cast("array<long>")
    return ids.select("id", "lang", F.col("word").alias("phrase"), "n", F.array("id").alias("words"),
                      none.alias("lefts"), none.alias("rights"))


class Frequent:
    """Says which phrases may be among some, by a bit table that Spark has merged.

    It never leaves one out. Its bits grow with the phrases up to ``MOST_BITS``; with very many more
    phrases it lets others pass, which costs time and disk, not results.
    """

    def __init__(self, phrases: DataFrame):
        wanted = max(1 << 16, 16 * phrases.count())
        self.bits = bits = min(MOST_BITS, 1 << (wanted - 1).bit_length())
        places = [F.shiftrightunsigned("id", k).bitwiseAND(bits - 1) for k in SHIFTS]
        filled = (
            phrases.select(F.explode(F.array(*places)).alias("bit"))
            .groupBy(F.shiftright("bit", 5).alias("place"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 32 AS int))")).alias("bits"))
            .toArrow()
        )
        table = np.zeros(bits // 32, np.uint32)
        table[filled.column("place").to_numpy()] = filled.column("bits").to_numpy()
        self.table = phrases.sparkSession.sparkContext.broadcast(table)

    def passes(self, ids: np.ndarray) -> np.ndarray:
        table, here = self.table.value, np.ones(len(ids), bool)
        for k in SHIFTS:
            bit = (ids >> np.uint64(k)) & np.uint64(self.bits - 1)
            here &= (table[bit >> np.uint64(5)] >> (bit & np.uint64(31)).astype(np.uint32)) & 1 == 1
        return here

    def has(self, id: int) -> bool:
        table, most = self.table.value, self.bits - 1
        return all(table[(id >> k & most) >> 5] >> (id >> k & 31) & 1 for k in SHIFTS)


class Known(dict):
    """Numbers of a language's words as they are met, 0 for those that aren't frequent."""

    def __init__(self, lang: str, frequent: Frequent):
        self.lang, self.frequent = lang, frequent
        self[BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN:
            self.clear()
            self[BREAK] = 0
        id = word_id(self.lang, word)
        self[word] = id = id if self.frequent.has(id) else 0
        return id


def numbered(batches: Iterator[pa.RecordBatch], frequent: Frequent) -> Iterator[np.ndarray]:
    """Numbers of the words of texts, 0 for breaks and words that aren't frequent."""
    known: dict[str, Known] = {}
    for lang, words in by_language(batches):
        if lang not in known and len(known) > 100:
            known.clear()
        own = known.setdefault(lang, Known(lang, frequent))
        yield np.fromiter(map(own.__getitem__, words), np.uint64, len(words))


STRIPES = "bucket int, prefixes binary, sizes binary, words binary, counts binary"


class Stripes:
    """Stripes of a task, as sorted entries of prefix, next word and count."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.begin()

    def begin(self) -> None:
        self.pending, self.waiting = [], 0
        self.merged = tuple(np.zeros(0, np.uint64) for _ in range(3))

    def add(self, prefix: np.ndarray, word: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Count these; stripes that have grown too large are sent on."""
        for begin in range(0, len(prefix), ENTRIES // 2):
            some = slice(begin, begin + ENTRIES // 2)
            ones = np.ones(len(prefix[some]), np.uint64)
            self.pending.append((prefix[some], word[some], ones))
            self.waiting += len(ones)
            if self.waiting > ENTRIES // 2:
                self.merge()
                if len(self.merged[0]) > ENTRIES:
                    yield self.packed()

    def merge(self) -> None:
        columns = [np.concatenate(c) for c in zip(self.merged, *self.pending)]
        self.merged, self.pending, self.waiting = merged(*columns), [], 0

    def packed(self) -> pa.RecordBatch:
        """A row for each bucket with the stripes, or slots of stripes, that go there."""
        self.merge()
        prefix, word, count = self.merged
        self.begin()
        slot = word % np.uint64(SLOTS) * np.uint64(0x9E3779B97F4A7C15)
        bucket = (mixed(prefix + slot) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        prefix, word, count, bucket = (c[order] for c in (prefix, word, count, bucket))
        found, begins = np.unique(bucket, return_index=True)
        out = []
        for own, begin, end in zip(found.tolist(), begins, [*begins[1:], len(bucket)]):
            heads = np.flatnonzero(np.diff(prefix[begin:end], prepend=~prefix[begin:begin + 1]))
            sizes = np.diff(np.append(heads, end - begin))
            out.append((own, prefix[begin:end][heads].tobytes(), sizes.astype("<u4").tobytes(),
                        word[begin:end].tobytes(), count[begin:end].tobytes()))
        columns = zip(*out) if out else ([],) * 5
        kinds = [pa.int32(), *[pa.binary()] * 4]
        names = ["bucket", "prefixes", "sizes", "words", "counts"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def merged(prefix: np.ndarray, word: np.ndarray, count: np.ndarray):
    """The sums of equal entries, in order of prefix and next word."""
    if not len(prefix):
        return prefix, word, count
    order = np.lexsort((word, prefix))
    prefix, word, count = prefix[order], word[order], count[order]
    new = np.ones(len(prefix), bool)
    new[1:] = (prefix[1:] != prefix[:-1]) | (word[1:] != word[:-1])
    begins = np.flatnonzero(new)
    return prefix[begins], word[begins], np.add.reduceat(count, begins)


def merged_stripes(stripes: DataFrame, least: int) -> DataFrame:
    """Frequent entries ``prefix``, ``word``, ``n`` of the merged stripes, and their phrase's ``id``."""

    def merge(table: pa.Table) -> pa.Table:
        whole = lambda name, kind: np.concatenate(
            [np.frombuffer(b, kind) for b in table.column(name).to_pylist()]
        )
        prefix = np.repeat(whole("prefixes", "<u8"), whole("sizes", "<u4"))
        entries = merged(prefix, whole("words", "<u8"), whole("counts", "<u8"))
        some = entries[2] >= least
        prefix, word, n = (column[some] for column in entries)
        columns = (prefix, word, n, extended(prefix, word))
        return pa.table({name: pa.array(column.view(np.int64))
                         for name, column in zip(("prefix", "word", "n", "id"), columns)})

    return stripes.groupBy("bucket").applyInArrow(merge, "prefix long, word long, n long, id long")


def buckets_of(spark) -> int:
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def pairs_of(docs: DataFrame, frequent: Frequent) -> DataFrame:
    """Stripes of single frequent words."""
    buckets = buckets_of(docs.sparkSession)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes = Stripes(buckets)
        for ids in numbered(batches, frequent):
            some = (ids[:-1] != 0) & (ids[1:] != 0)
            yield from stripes.add(ids[:-1][some], ids[1:][some])
        yield stripes.packed()

    return docs.mapInArrow(make, STRIPES)


def phrases_at(ids: np.ndarray, length: int) -> np.ndarray:
    """Number of the phrase of that length at each place, 0 where a break is inside."""
    phrase = ids[: max(0, len(ids) - length + 1)]
    whole = phrase != 0
    for k in range(1, length):
        word = ids[k : k + len(phrase)]
        phrase, whole = extended(phrase, word), whole & (word != 0)
    return np.where(whole, phrase, np.uint64(0))


def stretches_of(docs: DataFrame, words: Frequent, pairs: Frequent) -> DataFrame:
    """What of the texts may hold frequent phrases of three words: their words' numbers, 0 between."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids in numbered(batches, words):
            pair = phrases_at(ids, 2)
            good = (pair != 0) & pairs.passes(pair)
            kept = np.zeros(len(ids) + 1, bool)  # the last one stays a break
            three = np.flatnonzero(good[:-1] & good[1:])
            for k in range(3):
                kept[three + k] = True
            numbers = np.where(kept, np.append(ids, np.uint64(0)), np.uint64(0))
            numbers = numbers[kept | np.append(False, kept[:-1])]
            if len(numbers):
                yield pa.RecordBatch.from_arrays([pa.array([numbers.tobytes()], pa.binary())], ["ids"])

    return docs.mapInArrow(make, "ids binary")


def longer_stripes(stretches: DataFrame, length: int, frequent: Frequent) -> DataFrame:
    """Stripes of prefixes of ``length - 1`` words; prefix and end of a phrase are frequent."""
    buckets = buckets_of(stretches.sparkSession)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes = Stripes(buckets)
        for batch in batches:
            for packed in batch.column(0):
                ids = np.frombuffer(packed.as_buffer(), "<u8")
                part = phrases_at(ids, length - 1)
                good = (part != 0) & frequent.passes(part)
                here = np.flatnonzero(good[:-1] & good[1:])
                yield from stripes.add(part[here], ids[here + length - 1])
        yield stripes.packed()

    return stretches.mapInArrow(make, STRIPES)


def joined_phrases(entries: DataFrame, shorter: DataFrame, words: DataFrame) -> DataFrame:
    """The entries as phrases, like ``shorter``, from their prefix, next word and end.

    ``lefts`` are the counts of the left parts of all cuts, ``rights`` those of the right parts.
    """
    prefix = shorter.select(F.col("id").alias("prefix"), "lang", F.col("words").alias("before"),
                            F.col("n").alias("left"), "lefts", F.col("phrase").alias("begin"))
    next = words.select(F.col("id").alias("word"), F.col("phrase").alias("last"))
    phrases = entries.join(prefix, "prefix").join(next, "word").select(
        "id", "lang", F.concat_ws(" ", "begin", "last").alias("phrase"), "n",
        F.concat("before", F.array("word")).alias("words"),
        F.concat("lefts", F.array("left")).alias("lefts"),
    )
    phrases = phrases.withColumn("end", F.slice("words", F.lit(2), F.size("words") - 1))
    end = shorter.select(F.col("words").alias("end"), F.col("n").alias("right"), "rights")
    return phrases.join(end, "end").select(
        "id", "lang", "phrase", "n", "words", "lefts",
        F.concat(F.array("right"), "rights").alias("rights"),
    )


def not_subsumed(phrases: DataFrame, longer: DataFrame | None, share: tuple[int, int]) -> DataFrame:
    """Without phrases that a phrase of one word more holds often enough.

    That suffices: of the phrases on the way to a longer one, none is less frequent than it.
    """
    if longer is None:
        return phrases
    size = F.size("words") - 1
    for side, begin in (("right", F.lit(1)), ("left", F.lit(2))):
        most = longer.groupBy(F.slice("words", begin, size).alias("words")).agg(F.max("n").alias(side))
        phrases = phrases.join(most, "words", "left")
    enough = F.greatest(F.coalesce("left", F.lit(0)), F.coalesce("right", F.lit(0))) * share[1]
    return phrases.where(enough < F.col("n") * share[0]).drop("left", "right")


CUTS = """transform(sequence(1, size(lefts)), k -> struct(
    (cast(n AS decimal(38, 0)) * 1000 * total)
        div (cast(lefts[k - 1] AS decimal(38, 0)) * rights[k - 1]) AS score,
    k AS k))"""


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = 100,
    longest: int = 5,
    share: tuple[int, int] = (100, 100),
    top: int = 2000,
) -> DataFrame:
    """``lang``, ``rank`` from 1, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``, best first.

    Texts are split at full stops, commas, semicolons, colons, exclamation and question marks and
    line ends into pieces, these at blanks and tabs into words; A to Z count as lower case. Phrases
    are 2 to ``longest`` words of a piece that occur at least ``least`` times in their language,
    overlaps included; a NULL language is ``und``. ``a`` counts the phrase, ``n`` the language's
    words, ``l`` and ``r`` the parts of the cut with the least ``score``, floor(1000 a n / (l r)),
    the first of equals. A phrase is left out if a longer one that holds it occurs at least
    ``share`` (a fraction of at most one) as often. Each language has its ``top`` phrases, by
    score, ``a``, both descending, and the bytes of the phrase. Texts that are NULL, empty or
    without words count nothing; repeated rows count each time. Other columns are not read.
    """
    if not 0 < share[0] <= share[1] or least < 1 or longest < 2:
        raise ValueError("share must be above 0 and at most 1, least 1 and longest 2 at least")
    docs = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"),
                       F.col(f"`{text}`").alias("text"))
    counted = stored(word_counts(docs, least), "words")
    totals = counted.where("word IS NULL").select("lang", F.col("n").alias("total"))
    phrases = [stored(with_ids(counted.where("word IS NOT NULL")), "phrases_1")]
    tables = [Frequent(phrases[0])]
    stripes = pairs_of(docs, tables[0])
    for length in range(2, longest + 1):
        if length == 3:
            stretches = stored(stretches_of(docs, *tables), "stretches")
        if length > 2:
            stripes = longer_stripes(stretches, length, tables[-1])
        entries = stored(merged_stripes(stripes, least), f"entries_{length}")
        phrases.append(stored(joined_phrases(entries, phrases[-1], phrases[0]), f"phrases_{length}"))
        if length == longest or phrases[-1].isEmpty():
            break
        tables.append(Frequent(phrases[-1]))
    kept = None
    for own, longer in zip(phrases[1:], [*phrases[2:], None]):
        some = not_subsumed(own, longer, share).select("lang", "phrase", "n", "lefts", "rights")
        kept = some if kept is None else kept.unionByName(some)
    cut = F.array_min(F.expr(CUTS)).alias("cut")
    scored = kept.join(totals, "lang").select("*", cut).select(
        "lang", "phrase", F.col("n").alias("a"), F.expr("lefts[cut.k - 1]").alias("l"),
        F.expr("rights[cut.k - 1]").alias("r"), F.col("total").alias("n"), "cut.score",
    )
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # The best of a language are the best of the best of its parts.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALT))
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    some = scored.withColumn("salt", salt).withColumn("rank", place("lang", "salt"))
    ranked = some.where(F.col("rank") <= top).withColumn("rank", place("lang").cast("long"))
    return ranked.where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
