"""What the parity join sends and keeps on disk, and that no link is lost by sending less."""

import numpy as np
import pyarrow as pa

from gridclimate.llm import parity_join
from gridclimate.llm.parity_join import Bands, KeyBlocks, close_pairs, document_sets, sent_keys, set_id


def random_set(rng, size):
    return np.unique(rng.integers(0, 2**63, size).astype(np.uint64))


def changed(rng, found, gone):
    """The set with so many members gone and as many new ones."""
    left = rng.permutation(found)[gone:]
    return np.unique(np.concatenate([left, rng.integers(0, 2**63, gone).astype(np.uint64)]))


def test_bytes_of_a_key_with_many_buckets():
    """Sets, sizes and groups are sent with nearly each key then, and must pack well."""
    rng, bands = np.random.default_rng(3), Bands(80, 100)
    blocks, count = KeyBlocks(2400), 0
    for size in rng.integers(150, 1500, 1500).tolist():
        found = random_set(rng, size)
        group = bands.band(len(found))
        keys, thirds = sent_keys(bands.sketch(found, group), group, bands.spare(group))
        blocks.add(set_id(found), keys, group, len(found), thirds)
        count += len(keys)
    sent = [b"".join(v for v in r.values() if isinstance(v, bytes)) for b in blocks.packed() for r in b.to_pylist()]
    assert len(sent) == 2400
    sent, piece = b"".join(sent), 1 << 15
    packed = sum(len(pa.compress(sent[k : k + piece], "lz4")) for k in range(0, len(sent), piece))
    assert packed < 14.5 * count


def test_similar_sets_share_enough_of_what_is_sent():
    """Keys left out and codes of third words never take more than the keys to spare."""
    rng, bands = np.random.default_rng(9), Bands(80, 100)
    pairs = 0
    for size in (3, 9, 30, 90, 200, 700, 3000):
        for _ in range(40):
            x = random_set(rng, size)
            most = bands.apart(2 * len(x)) // 2
            y = changed(rng, x, int(rng.integers(max(0, most - 3), most + 1)))
            group = min(bands.band(len(x)), bands.band(len(y)))
            if not bands.similar(x, y) or not bands.parts(group):
                continue
            sent = [dict(zip(*map(np.ndarray.tolist, sent_keys(bands.sketch(z, group), group, bands.spare(group)))))
                    for z in (x, y)]
            shared = [k for k in sent[0] if k in sent[1] and parity_join.ONE_BIT[sent[0][k] ^ sent[1][k]]]
            assert len(shared) >= bands.least_keys(group)
            pairs += 1
    assert pairs > 150


def test_codes_of_words_that_differ_in_one_bit():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**63, 64).astype(np.uint64)
    flipped = words ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))
    assert parity_join.ONE_BIT[parity_join.codes(words) ^ parity_join.codes(flipped)].all()
    others = rng.integers(0, 2**63, 64).astype(np.uint64)
    assert parity_join.ONE_BIT[parity_join.codes(words) ^ parity_join.codes(others)].sum() < 3


def test_a_hot_key_keeps_its_sets_together():
    """Those in its bucket are few here, but others of its sets are dealt out to other buckets."""
    bands, n = Bands(80, 100), 20
    begins, lengths = np.array([0, n]), np.array([n, n])
    node, size = np.arange(2 * n), np.full(2 * n, 100)
    # Third words of strangers, so hardly a pair of either key is listed.
    third = np.tile(np.arange(n) * 2477 % 65536, 2).astype(np.uint16)
    hot = np.array([False, True])
    i, _, crowded = parity_join.listed_pairs(begins, lengths, hot, node, size, third, bands)
    assert crowded.tolist() == [False, True] and (i < n).all()
    # Alike third words: every pair may be similar, so they are too many to list.
    third[:] = 0
    i, _, crowded = parity_join.listed_pairs(begins, lengths, hot, node, size, third, bands)
    assert crowded.all() and not len(i)


def test_strangers_that_share_keys_are_no_candidates(spark):
    """Else they hang very many sets together, whose members are copied to the tiles of a group."""
    rng, bands = np.random.default_rng(6), Bands(80, 100)
    words = [f"w{k}" for k in range(5000)]
    texts = [" ".join(rng.choice(words, 600)) for _ in range(12)]
    texts += [text + " and some words at the end" for text in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = document_sets(docs, bands, 5, "text", "doc_id").cache()
    rows = {r.id: r for r in sets.collect()}
    by_node = {r.node: k for k, r in rows.items()}
    pairs = [(rows[x].node, rows[y].node, min(rows[x].band, rows[y].band))
             for x in rows for y in rows if x < y and abs(rows[x].band - rows[y].band) <= 1]
    found = close_pairs(spark.createDataFrame(pairs, "a long, b long, group int"), sets, bands).collect()
    sets.unpersist()
    assert len(pairs) > 200
    assert {tuple(sorted((by_node[r.a], by_node[r.b]))) for r in found} == {(k, k + 12) for k in range(12)}


def test_group_sizes_stay_what_similar_sets_need():
    """One of the group's first band, the other of it or the next: no more parts than for these."""
    bands = Bands(80, 100)
    for group in range(20, 40):
        both = bands.edges[group + 1] - 1 + bands.edges[group + 2] - 1
        assert bands.most(group) == bands.apart(both)
        assert bands.parts(group) * 2 > bands.most(group) + 2 * bands.spare(group)
