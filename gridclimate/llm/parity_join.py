"""Near-duplicate documents by a parity-sketch join of their word n-grams.

Every n-gram of a document's set flips one bit of a sketch, so two sketches differ in at most as
many bits as the sets differ in members. Sets of ``a`` and ``b`` members whose Jaccard similarity
is at least ``p / q`` differ in at most ``(a + b) * (q - p) / (q + p)``. Sizes fall into bands so
narrow that similar sets lie in the same or in neighbouring bands; each two neighbouring bands
have sketches with more parts than half that bound, so similar sets have parts in which they
differ in one member at most (pigeonhole). A part has three 64-bit words, of which that member can
change but one: an equi-join on each two words of each part finds all similar sets. Large sketches
have up to three parts more than it takes, so that similar sets share as many keys more, and pairs
that share fewer are dropped as they are counted. For each further part a set leaves out the key
whose words have the fewest bits, as strangers share such keys: what it leaves out comes first in an
order of all keys, so of the keys that two sets share they leave out no more than that many.

Sketches never travel. Their keys do, packed in blocks of a bucket of keys, each with 16 bits on the
third word of its part, which tell most pairs of words that differ in more than one bit. The pairs of
the few sets that share a key are listed there if their sizes and third words allow it. These pairs,
and tiles of the sets of a key that many share, are compared by folds of their sketches: the words
XORed together into a few, about four bits for each member that similar sets may differ in. Folds
differ in no more bits than sketches. Whatever hangs together by close folds is a candidate group,
which holds all links of its sets. The sets of these groups are made anew from the texts, each goes to a few
tasks only, and the sets themselves decide; a pair that is connected already is passed over. What
leaves a task are links that connect, fewer than the sets of its tile.

Equal sets are one node throughout. Sets and n-grams are known by hashes of 64 bits.
"""

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import slices, slices_of_bytes
from .components import components, with_least
from .stored import free_shuffles, stored

WORDS = 3  # of 64 bits in each part of a sketch
TWO = ((0, 1), (0, 2), (1, 2))
THIRD = (2, 1, 0)
FOLD_BITS = 4  # for each member that similar sets may differ in
FEW = 16  # sets sharing a key up to which all their pairs are listed
SOME = 128  # the same, if each is in so few pairs on average that
PAIRS = 4  # of a set are listed
AT_ONCE = 1 << 19  # pairs that are looked at
HOT = 64  # sets sharing a key in what a task sends on from which most of them are dealt out
MORE = 3  # parts more than it takes
SPARE = 32  # members that similar sets differ in at most, for each key that a set leaves out
KEYS = 1 << 20  # that a task holds before it sends them on
TILE_MEMBERS = 1 << 19  # of all sets on one side of a tile
TILE_SETS = 512
TILE_FOLDS = 4096  # sets on one side of a tile that only has their folds
KNOWN = 100_000  # words whose hashes a task remembers
TEXT_BYTES = 1 << 20  # of texts whose sets are made at a time
MOST_BITS = 1 << 26  # of a table of nodes
BLOOM_SHIFTS = (0, 20, 38)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hashes of words as they are met, for so many that a task remembers."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def shingles(texts: list[str | None], width: int, hashes: WordHashes) -> Iterator[np.ndarray]:
    """For each text the distinct hashes, in ascending order, of its ``width``-word sequences.

    Letters A to Z count as lower case; words are what the six blanks of ASCII separate. Fewer
    words are one sequence; no words, or NULL, an empty set.
    """
    split = [(text or "").encode().lower().split() for text in texts]
    total = sum(map(len, split))
    words = np.fromiter(map(hashes.__getitem__, chain.from_iterable(split)), np.uint64, total)
    sequences = {}  # by their width, at each place, of all texts one after another
    for used in {min(width, len(own)) for own in split if own}:
        found = np.full(total - used + 1, used, np.uint64)
        for k in range(used):
            found = found * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(found)]
        sequences[used] = mixed(found)
    begin = 0
    for own in split:
        if not own:
            yield np.zeros(0, np.uint64)
            continue
        used = min(width, len(own))
        found = np.sort(sequences[used][begin : begin + len(own) - used + 1])
        yield found[np.concatenate([[True], found[1:] != found[:-1]])]
        begin += len(own)


def set_id(found: np.ndarray) -> int:
    return int(np.array(xxhash.xxh3_64_intdigest(found.tobytes()), np.uint64).view(np.int64))


class Bands:
    """Bands of set sizes for a least similarity of ``p / q``, and the words of their sketches."""

    def __init__(self, p: int, q: int):
        if not 0 < p <= q:
            raise ValueError("the similarity must be above 0 and at most 1")
        self.p, self.q = p, q
        self.edges = [1]
        while self.edges[-1] < 1 << 44:
            self.edges.append(max(self.edges[-1] + 1, (self.edges[-1] - 1) * q // p + 1))

    def band(self, size: int) -> int:
        return int(np.searchsorted(self.edges, size, "right")) - 1

    def apart(self, sizes: int) -> int:
        """How many members similar sets of so many members together differ in at most."""
        return sizes * (self.q - self.p) // (self.q + self.p)

    def most(self, group: int) -> int:
        """How many members similar sets differ in, one of the band ``group``, the other of it or
        the next; two of the next are met in the group after."""
        return self.apart(self.edges[group + 1] + self.edges[group + 2] - 2) if group >= 0 else 0

    def least_keys(self, group: int) -> int:
        """How many keys similar sets of these bands share at least, of those not left out."""
        return 1 + min(MORE, self.most(group) // 16)

    def spare(self, group: int) -> int:
        """How many keys a set leaves out."""
        return self.most(group) // SPARE

    def parts(self, group: int) -> int:
        """Parts of the sketch for these bands; 0 if only equal sets can be similar."""
        most = self.most(group)
        return most // 2 + self.least_keys(group) + self.spare(group) if most else 0

    def sketch(self, found: np.ndarray, group: int) -> np.ndarray:
        """Words of the sketch of a set for the bands ``group`` and ``group + 1``."""
        bits = 64 * WORDS * self.parts(group)
        odd = np.bincount((found % np.uint64(max(bits, 1))).astype(np.int64), minlength=bits) & 1
        return np.packbits(odd[:bits].astype(np.uint8), bitorder="little").view("<u8")

    def fold(self, sketch: np.ndarray, group: int) -> np.ndarray:
        """Fewer words whose distance never exceeds that of the sketches."""
        if not len(sketch):
            return sketch
        words = -(-FOLD_BITS * self.most(group) // 64)
        padded = np.zeros(-(-len(sketch) // words) * words, np.uint64)
        padded[: len(sketch)] = sketch
        return np.bitwise_xor.reduce(padded.reshape(-1, words), axis=0)

    def folds(self, found: np.ndarray) -> list[np.ndarray]:
        """Those of a set for the groups that its band is the second and the first of."""
        band = self.band(len(found))
        return [self.fold(self.sketch(found, g), g) for g in (band - 1, band)]

    def close(self, fold: np.ndarray, folds: np.ndarray, size: int, sizes: np.ndarray) -> np.ndarray:
        """Which sets are as near to one as similar sets are, by their sizes and folds."""
        most = (sizes + size) * (self.q - self.p) // (self.q + self.p)
        near = np.flatnonzero(np.abs(sizes - size) <= most)
        return near[np.bitwise_count(folds[near] ^ fold).sum(1) <= most[near]]

    def similar(self, x: np.ndarray, y: np.ndarray) -> bool:
        """Whether two sets, sorted, are similar."""
        both = np.concatenate([x, y])
        both.sort(kind="stable")
        common = int((both[1:] == both[:-1]).sum())
        return common * self.q >= (len(both) - common) * self.p


SETS = "node long, size long, band int, lower binary, upper binary"


def document_sets(docs: DataFrame, bands: Bands, width: int, text: str, id: str) -> DataFrame:
    """Identifier, node (hash of the set; NULL if empty), size, band and the folds of both groups."""
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{id}`").alias("id"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices_of_bytes(batches, 0, TEXT_BYTES):
            out = []
            for found in shingles(batch.column(0).to_pylist(), width, hashes):
                if not len(found):
                    out.append((None, 0, None, None, None))
                    continue
                folds = [fold.tobytes() for fold in bands.folds(found)]
                out.append((set_id(found), len(found), bands.band(len(found)), *folds))
            columns = zip(*out) if out else ([],) * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            names = ["id", "node", "size", "band", "lower", "upper"]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(1), *arrays], names)

    return rows.mapInArrow(make, f"id {rows.schema['id'].dataType.simpleString()}, {SETS}")


def made_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[dict[int, np.ndarray]]:
    """The different sets of some texts at a time, by node; texts are the first column."""
    hashes = WordHashes()
    for batch in slices_of_bytes(batches, 0, TEXT_BYTES):
        made = shingles(batch.column(0).to_pylist(), width, hashes)
        yield {set_id(found): found for found in made if len(found)}


def sketch_keys(sketch: np.ndarray, group: int) -> np.ndarray:
    """A hash of group, place and words for each two words of each part."""
    words = sketch.reshape(-1, WORDS)
    place = mixed(np.arange(len(words), dtype=np.uint64) * np.uint64(1024) + np.uint64(group + 1))
    out = []
    for k, (i, j) in enumerate(TWO, 1):
        # Also told apart by k when the second word is zero.
        here = mixed(words[:, i] ^ mixed(place + np.uint64(k)))
        out.append(mixed(here + words[:, j] * np.uint64(2 * k + 1)))
    return np.concatenate(out)


CODES = (mixed(np.arange(1, 65, dtype=np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)
CODES_OF_BYTES = np.zeros((8, 256), np.uint16)
for _bit in range(64):
    CODES_OF_BYTES[_bit // 8, np.arange(256) >> _bit % 8 & 1 == 1] ^= CODES[_bit]
ONE_BIT = np.zeros(1 << 16, bool)  # what codes of words that differ in one bit at most differ in
ONE_BIT[[0, *CODES.tolist()]] = True


def codes(words: np.ndarray) -> np.ndarray:
    """For each word the codes of its bits XORed together."""
    return np.bitwise_xor.reduce(CODES_OF_BYTES[np.arange(8), words.view(np.uint8).reshape(-1, 8)], axis=1)


def sent_keys(sketch: np.ndarray, group: int, spare: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys and the codes of the third words, without the ``spare`` first ones in order of the
    bits of a key's words, then of keys."""
    keys = sketch_keys(sketch, group)
    thirds = codes(sketch).reshape(-1, WORDS)[:, THIRD].T.ravel()
    if not spare:
        return keys, thirds
    bits = np.bitwise_count(sketch).reshape(-1, WORDS).astype(np.int64)
    bits = np.concatenate([bits[:, i] + bits[:, j] for i, j in TWO])
    few = np.flatnonzero(bits <= np.partition(bits, spare)[spare])
    left_out = few[np.lexsort((keys[few], bits[few]))[:spare]]
    return np.delete(keys, left_out), np.delete(thirds, left_out)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Beginnings and lengths of the runs of equal neighbours."""
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else keys
    return begins, np.diff(np.append(begins, len(keys)))


BLOCK = (
    "bucket int, dealt boolean, hot boolean, keys binary, thirds binary, counts binary, nodes binary, groups binary, "
    "sizes binary"
)
KEY_BYTES = 3  # of a key that are sent; its bucket and the code of its third word tell some more
LOW = np.uint64((1 << 8 * KEY_BYTES) - 1)


def planes(numbers: np.ndarray) -> bytes:
    """Small numbers byte by byte, first the lowest of all: the others are alike and pack well."""
    return numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def of_planes(packed: bytes) -> np.ndarray:
    split = np.frombuffer(packed, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(split.T).view("<i4").ravel().astype(np.int64)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets ascend with the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def key_number(low: np.ndarray, bucket: np.ndarray | int) -> np.ndarray:
    return mixed(low + mixed(np.atleast_1d(bucket).astype(np.uint64)))


class KeyBlocks:
    """Keys of some sets, sent on as a block for each bucket.

    Of a key that very many of them share, a few sets go to the key's bucket, where ``hot`` says that
    it is one of many; the others are dealt out, so it sends few entries to one place.
    """

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.begin()

    def begin(self) -> None:
        self.keys, self.thirds, self.lengths, self.nodes, self.groups, self.sizes = [], [], [], [], [], []
        self.count = 0
        self.seen: set[int] = set()

    def add(
        self, node: int, keys: np.ndarray, group: int, size: int, thirds: np.ndarray | None = None
    ) -> None:
        self.keys.append(keys)
        self.thirds.append(np.zeros(len(keys), np.uint16) if thirds is None else thirds)
        self.lengths.append(len(keys))
        self.nodes.append(node)
        self.groups.append(group)
        self.sizes.append(size)
        self.count += len(keys)

    def packed(self) -> Iterator[pa.RecordBatch]:
        if not self.count:
            return
        keys, thirds = np.concatenate(self.keys), np.concatenate(self.thirds)
        nodes, groups = np.array(self.nodes, np.int64), np.array(self.groups, np.int32)
        sizes = np.array(self.sizes, np.int64)
        order = np.lexsort((sizes, groups))  # so that neighbours in a block differ little
        of_nodes = nodes[order], groups[order], sizes[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        places = np.repeat(place, self.lengths)
        self.begin()
        order = np.argsort(keys, kind="stable")
        keys, thirds, places = keys[order], thirds[order], places[order]
        begins, lengths = _runs(keys)
        within = np.arange(len(keys)) - np.repeat(begins, lengths)
        hot = np.repeat(lengths, lengths) >= HOT
        dealt = hot & (within > FEW)
        bucket = bucket_of(keys, self.buckets)
        elsewhere = bucket_of(mixed(of_nodes[0][places].view(np.uint64)), self.buckets)
        for own, buckets in ((~hot, bucket), (hot & ~dealt, bucket), (dealt, elsewhere)):
            if own.any():
                here = keys[own], thirds[own], places[own], buckets[own]
                yield self.blocks(*here, own is dealt, bool(hot[own][0]), of_nodes)

    def blocks(self, keys, thirds, places, buckets, dealt: bool, hot: bool, of_nodes) -> pa.RecordBatch:
        order = np.argsort(buckets * len(of_nodes[0]) + places, kind="stable")
        keys, thirds, places, buckets = keys[order], thirds[order], places[order], buckets[order]
        begins, lengths = _runs(buckets)
        out = []
        for begin, length in zip(begins.tolist(), lengths.tolist()):
            here = slice(begin, begin + length)
            first, counts = _runs(places[here])
            nodes, groups, sizes = (column[places[here][first]] for column in of_nodes)
            sent = 8 if dealt else KEY_BYTES  # a key that is dealt out isn't told by its bucket
            sent = keys[here].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :sent]
            out.append((int(buckets[begin]), dealt, hot, sent.tobytes(), thirds[here].astype("<u2").tobytes(),
                        planes(counts), nodes.tobytes(), planes(groups), planes(np.diff(sizes, prepend=0))))
        columns = zip(*out) if out else ([],) * 9
        kinds = [pa.int32(), pa.bool_(), pa.bool_(), *[pa.binary()] * 6]
        names = ["bucket", "dealt", "hot", "keys", "thirds", "counts", "nodes", "groups", "sizes"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def key_blocks(docs: DataFrame, bands: Bands, width: int, text: str, buckets: int) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = KeyBlocks(buckets)
        for sets in made_sets(batches, width):
            for node, found in sets.items():
                if node in blocks.seen:
                    continue
                blocks.seen.add(node)
                band = bands.band(len(found))
                for group in (band - 1, band):
                    sketch = bands.sketch(found, group)
                    if len(sketch):
                        keys, thirds = sent_keys(sketch, group, bands.spare(group))
                        blocks.add(node, keys, group, len(found), thirds)
                if blocks.count > KEYS:
                    yield from blocks.packed()
        yield from blocks.packed()

    return docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(make, BLOCK)


def block_entries(row: dict, buckets: int):
    """Key, node, group and size of a block's entries."""
    nodes, groups = np.frombuffer(row["nodes"], "<i8"), of_planes(row["groups"])
    places = np.repeat(np.arange(len(nodes)), of_planes(row["counts"]))
    sent = np.frombuffer(row["keys"], np.uint8).reshape(len(places), -1)
    keys = np.zeros((len(places), 8), np.uint8)
    keys[:, : sent.shape[1]] = sent
    keys = keys.view("<u8").ravel()
    number = key_number(keys & LOW, bucket_of(keys, buckets) if row["dealt"] else row["bucket"])
    sizes = np.cumsum(of_planes(row["sizes"]))
    return number.view(np.int64), nodes[places], groups[places], sizes[places]


def pairs_of_runs(begins: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of all pairs of the entries of each run, and the runs' numbers; some at a time."""
    for length in np.unique(lengths).tolist():
        runs = np.flatnonzero(lengths == length)
        i, j = np.triu_indices(length, 1)
        step = max(1, AT_ONCE // max(1, len(i)))
        for start in range(0, len(runs), step):
            some = runs[start : start + step]
            first = begins[some][:, None]
            yield (first + i).ravel(), (first + j).ravel(), np.repeat(some, len(i))


def listed_pairs(
    begins, lengths, hot, node, size, third, bands: Bands
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the pairs that sizes and third words allow, and which runs are ``hot`` or have too
    many."""
    crowded = hot | (lengths > SOME)
    first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    tried = np.flatnonzero((lengths > 1) & ~crowded)
    for i, j, run in pairs_of_runs(begins[tried], lengths[tried]):
        near = np.abs(size[i] - size[j]) <= bands.apart(size[i] + size[j])
        near &= ONE_BIT[third[i] ^ third[j]] & (node[i] != node[j])
        i, j, run = i[near], j[near], tried[run[near]]
        found = np.bincount(run, minlength=len(lengths))
        many = (lengths > FEW) & (found > PAIRS * lengths)
        crowded |= many
        first.append(i[~many[run]])
        second.append(j[~many[run]])
    return np.concatenate(first), np.concatenate(second), crowded


SHARED = "key long, a long, b long, group int, n long"


def shared_keys(blocks: DataFrame, bands: Bands, buckets: int) -> DataFrame:
    """Pairs ``a``, ``b`` of a ``group`` with the number ``n`` of keys that few sets share, and, with
    a ``key``, the sets ``a`` of a key that many share."""

    def merge(table: pa.Table) -> pa.Table:
        plain, dealt = [], []
        for row in table.to_pylist():
            key, node, group, size = block_entries(row, buckets)
            # Keys of different groups that agree in what was sent of them are told apart.
            key = mixed(key.view(np.uint64) ^ mixed(group.astype(np.uint64))).view(np.int64)
            third = np.frombuffer(row["thirds"], "<u2")
            hot = np.full(len(key), row["hot"])
            (dealt if row["dealt"] else plain).append((key, node, group, size, third, hot))
        many = [tuple(np.concatenate(c) for c in zip(*dealt))[:3]] if dealt else []
        a = b = group = n = np.zeros(0, np.int64)
        if plain:
            entries = [np.concatenate(c) for c in zip(*plain)]
            order = np.lexsort((entries[4], entries[1], entries[0]))
            key, node, group, size, third, hot = (column[order] for column in entries)
            hot = np.logical_or.reduceat(hot, _runs(key)[0])
            # Also by the third word: a set may have two keys that agree in what was sent of them.
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1]) | (third[1:] != third[:-1])
            key, node, group, size, third = (column[new] for column in (key, node, group, size, third))
            begins, lengths = _runs(key)
            i, j, crowded = listed_pairs(begins, lengths, hot, node, size, third, bands)
            crowded = np.repeat(crowded, lengths)
            many.append((key[crowded], node[crowded], group[crowded]))
            a, b, group = node[i], node[j], group[i]
            order = np.lexsort((group, b, a))
            a, b, group = a[order], b[order], group[order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (group[1:] != group[:-1])
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(a)))
            a, b, group = a[first], b[first], group[first]
        key, node, of_key = (np.concatenate(c) for c in zip(*many)) if many else (a[:0],) * 3
        none, empty = pa.nulls(len(a), pa.int64()), pa.nulls(len(key), pa.int64())
        return pa.table({
            "key": pa.concat_arrays([none, pa.array(key, pa.int64())]),
            "a": pa.array(np.concatenate([a, node]), pa.int64()),
            "b": pa.concat_arrays([pa.array(b, pa.int64()), empty]),
            "group": pa.array(np.concatenate([group, of_key]).astype(np.int32)),
            "n": pa.concat_arrays([pa.array(n, pa.int64()), empty]),
        })

    return blocks.groupBy("bucket").applyInArrow(merge, SHARED)


def nodes_of(sets: DataFrame) -> DataFrame:
    """One row per node, with its size, band and folds."""
    own = sets.where("node IS NOT NULL").dropDuplicates(["node"])
    return own.select("node", "size", "band", "lower", "upper")


def fold_of_group() -> Column:
    return F.when(F.col("group") == F.col("band"), F.col("upper")).otherwise(F.col("lower"))


def close_pairs(pairs: DataFrame, sets: DataFrame, bands: Bands) -> DataFrame:
    """The pairs ``a``, ``b`` of a ``group`` whose folds are as near as those of similar sets."""
    own = nodes_of(sets)
    for side in ("a", "b"):
        pairs = pairs.join(own.withColumnRenamed("node", side), side).withColumns(
            {f"fold_{side}": fold_of_group(), f"size_{side}": F.col("size")}
        ).drop(*own.columns)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            near = np.zeros(batch.num_rows, bool)
            x, y = batch.column("fold_a").to_pylist(), batch.column("fold_b").to_pylist()
            both = batch.column("size_a").to_numpy() + batch.column("size_b").to_numpy()
            most = bands.apart(both)
            lengths = np.array([len(fold) for fold in x], np.int64)
            for length in np.unique(lengths).tolist():
                some = np.flatnonzero(lengths == length)
                folds = [np.frombuffer(b"".join(side[k] for k in some), "<u8") for side in (x, y)]
                differ = np.bitwise_count(folds[0] ^ folds[1]).reshape(len(some), -1).sum(1)
                near[some] = differ <= most[some]
            yield batch.select(["a", "b"]).filter(pa.array(near))

    rows = pairs.select("a", "b", "size_a", "size_b", "fold_a", "fold_b")
    return rows.mapInArrow(compare, "a long, b long")


class NodeFilter:
    """Says which nodes may be among some, by a bit table that Spark has merged.

    It never leaves a node out. Its bits grow with the nodes up to ``MOST_BITS``; with very many
    more it lets others pass, which an exact join then drops. A node is a hash already; three parts
    of it are the places of its bits.
    """

    def __init__(self, nodes: DataFrame):
        wanted = max(1 << 16, 16 * nodes.count())
        self.bits = bits = min(MOST_BITS, 1 << (wanted - 1).bit_length())
        places = [F.shiftrightunsigned("node", k).bitwiseAND(bits - 1) for k in BLOOM_SHIFTS]
        filled = (
            nodes.select(F.explode(F.array(*places)).alias("bit"))
            .groupBy(F.shiftright("bit", 5).alias("place"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 32 AS int))")).alias("bits"))
            .toArrow()
        )
        table = np.zeros(bits // 32, np.uint32)
        table[filled.column("place").to_numpy()] = filled.column("bits").to_numpy()
        self.table = nodes.sparkSession.sparkContext.broadcast(table)

    def passes(self, nodes: np.ndarray) -> np.ndarray:
        table, here = self.table.value, np.ones(len(nodes), bool)
        nodes = nodes.view(np.uint64)
        for k in BLOOM_SHIFTS:
            bit = (nodes >> np.uint64(k)) & np.uint64(self.bits - 1)
            here &= (table[bit >> np.uint64(5)] >> (bit & np.uint64(31)).astype(np.uint32)) & 1 == 1
        return here


def sets_of(nodes: DataFrame, docs: DataFrame, width: int, text: str) -> DataFrame:
    """``node`` and ``members`` (sorted, packed) of the nodes, made anew from the texts."""
    maybe = NodeFilter(nodes)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sets in made_sets(batches, width):
            here = np.fromiter(sets, np.int64, len(sets))
            here = here[maybe.passes(here)]
            packed = [sets[node].tobytes() for node in here.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(packed, pa.binary())],
                                             ["node", "members"])

    made = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(make, "node long, members binary")
    return made.join(nodes, "node", "left_semi").dropDuplicates(["node"])


class Groups:
    """Which rows of a tile links have joined so far, and these links."""

    def __init__(self, node: np.ndarray):
        # Equal nodes are one from the start.
        self.node, self.links = node, []
        self.label = np.unique(node, return_inverse=True)[1]

    def join(self, x: int, y: int) -> None:
        self.links.append((int(self.node[x]), int(self.node[y])))
        self.label[self.label == self.label[y]] = self.label[x]

    def pairs(self, bands: Bands, size, folds, left, right) -> Iterator[tuple[int, int]]:
        """Rows of ``left`` and of ``right`` that are close and not joined yet, all in the end.

        A pair that is taken has to be joined, or is left alone, before the next one is asked for.
        """
        for x in left.tolist():
            others = right[self.label[right] != self.label[x]]
            near = others[bands.close(folds[x], folds[others], size[x], size[others])]
            while len(near):
                yield x, int(near[0])
                near = near[1:]
                near = near[self.label[near] != self.label[x]]


def links_table(links: list[tuple[int, int]]) -> pa.Table:
    pairs = np.array(links, np.int64).reshape(-1, 2)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def in_tiles(rows: DataFrame, whole: str, tiles: Column) -> DataFrame:
    """The rows once for each tile ``i``, ``j`` of their ``whole``, cut into ``tiles``; ``own`` is
    the side that a row is on."""
    cut = rows.groupBy(whole).agg(tiles.cast("int").alias("tiles"))
    own = F.pmod(F.xxhash64("node", F.lit(7)), "tiles").cast("int")
    placed = rows.join(cut, whole).withColumn("own", own)
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return placed.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop(
        "tiles", "other"
    )


def candidates_of_many(many: DataFrame, sets: DataFrame, bands: Bands) -> DataFrame:
    """Pairs ``a``, ``b`` that connect whatever close folds connect among the sets of each key."""
    rows = many.select("key", F.col("a").alias("node"), "group").join(nodes_of(sets), "node").select(
        "key", "node", "size", fold_of_group().alias("fold")
    )
    rows = in_tiles(rows, "key", F.ceil(F.count("*") / TILE_FOLDS))

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        node, size, own = (table.column(c).to_numpy() for c in ("node", "size", "own"))
        folds = np.stack([np.frombuffer(packed, "<u8") for packed in table.column("fold").to_pylist()])
        joined = Groups(node)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        for x, y in joined.pairs(bands, size, folds, left, right):
            joined.join(x, y)
        return links_table(joined.links)

    return rows.groupBy("key", "i", "j").applyInArrow(compare, "a long, b long")


def links_of(candidates: DataFrame, docs: DataFrame, bands: Bands, width: int, text: str) -> DataFrame:
    """Links ``a``, ``b`` that connect whatever similar sets connect within candidate groups."""
    groups = stored(components(candidates, "candidates"), "groups")
    rows = groups.join(sets_of(groups.select("node"), docs, width, text), "node")
    size = F.octet_length("members") / 8
    rows = stored(rows.withColumnRenamed("root", "whole"), "members")
    tiles = F.greatest(F.ceil(F.sum(size) / TILE_MEMBERS), F.ceil(F.count("*") / TILE_SETS))

    def verify(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        node, own = (table.column(c).to_numpy() for c in ("node", "own"))
        held = [np.frombuffer(packed, "<u8") for packed in table.column("members").to_pylist()]
        size = np.array([len(x) for x in held], np.int64)
        band = np.array([bands.band(n) for n in size])
        folds = [bands.folds(x) for x in held]
        joined = Groups(node)
        for group in np.unique(np.concatenate([band - 1, band])).tolist():
            some = np.flatnonzero((band == group) | (band == group + 1))
            if not bands.parts(group) or len(some) < 2:
                continue
            here = np.zeros((len(node), len(folds[some[0]][0 if band[some[0]] > group else 1])), np.uint64)
            for k in some.tolist():
                here[k] = folds[k][0 if band[k] > group else 1]
            left, right = some[own[some] == i], some[own[some] == j]
            for x, y in joined.pairs(bands, size, here, left, right):
                if bands.similar(held[x], held[y]):
                    joined.join(x, y)
        return links_table(joined.links)

    pieces = in_tiles(rows, "whole", tiles).select("whole", "i", "j", "own", "node", "members")
    return pieces.groupBy("whole", "i", "j").applyInArrow(verify, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    width: int = 3,
    similarity: tuple[int, int] = (90, 100),
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_shingles``, ``node`` and ``component_id``.

    ``component_id`` is the smallest identifier that similar documents lead to, directly or over
    others; ``node`` is alike for equal sets. Documents without words (NULL, empty, blank) have no
    n-grams, no node and their own identifier. A NULL identifier is never the smallest, unless
    there is no other. Repeated rows have equal sets. No link is lost: similarity is decided on the
    sets (by 64-bit hashes), candidates come from all keys of all sketches. Other columns are not
    read.
    """
    bands = Bands(*similarity)
    sets = stored(document_sets(docs, bands, width, text, id), "sets")
    labels = similar_components(docs, sets, bands, width, text)
    rooted = sets.select("id", "size", "node").join(labels, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    return with_least(rooted, "root", "id").select(
        "id",
        F.col("size").alias("n_shingles"),
        "node",
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"),
    )


def similar_components(
    docs: DataFrame, sets: DataFrame, bands: Bands, width: int, text: str
) -> DataFrame:
    """``node`` and ``root`` of all nodes with a link."""
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = key_blocks(docs, bands, width, text, buckets)
    shared = stored(shared_keys(blocks, bands, buckets), "shared")
    free_shuffles(docs.sparkSession)  # of all keys, the most that a shuffle here holds
    # Similar sets share so many keys, or one that many share.
    most = max(g for g in range(len(bands.edges) - 2))
    steps = [g for g in range(1, most) if bands.least_keys(g) > bands.least_keys(g - 1)]
    least = F.lit(1) + sum((F.col("group") >= g).cast("int") for g in steps)
    few = (
        shared.where("key IS NULL").groupBy("a", "b", "group").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least).select("a", "b", "group")
    )
    few = close_pairs(few, sets, bands)
    many = candidates_of_many(shared.where("key IS NOT NULL"), sets, bands)
    candidates = stored(few.unionByName(many).distinct(), "candidates")
    free_shuffles(docs.sparkSession)
    links = stored(links_of(candidates, docs, bands, width, text), "links")
    free_shuffles(docs.sparkSession)
    return components(links, "links")
