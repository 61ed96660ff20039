"""The queries on whole tables against SQL or plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import oracle
import public_tokenizers
import pyarrow.dataset as ds
import pytest
import sentencepiece
from tokenizers import Tokenizer

import gridclimate.llm.queries as llm

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs():
    table = ds.dataset(f"{SF}/documents.parquet").to_table().to_pandas()
    return table.sort_values("doc_id").reset_index(drop=True)


def result(spark, name):
    rows = llm.queries()[name](spark, SF).toPandas()
    return rows.sort_values(rows.columns[0]).reset_index(drop=True)


def labelled(docs, rows, column, parts, held):
    labels = ds.dataset(f"{SF}/labels.parquet").to_table().to_pandas()
    both = rows.merge(labels[["doc_id", column]], on="doc_id")
    remainder = np.array([zlib.crc32(str(i).encode()) % parts for i in docs.doc_id])
    assert (rows.held_out.to_numpy() == (remainder == held)).all()
    assert rows.score.between(0, 1).all()
    assert (rows.predicted == (rows.score >= 0.3)).all()
    return both[both.held_out]


@pytest.mark.parametrize("name", llm.oracle_sql())
def test_query_equals_sql(spark, name):
    con = oracle.connect(SF)
    assert oracle.differences(spark, SF, con, llm.queries()[name], llm.oracle_sql()[name]) == {}


def test_op1_held_out_accuracy(spark, docs):
    rows = result(spark, "op1_neighbour_quality")
    assert rows.doc_id.tolist() == docs.doc_id.tolist()
    held = labelled(docs, rows, "quality", 5, 0)
    assert (held.predicted == held.quality).mean() > 0.9


def test_op2_equals_the_library(spark, docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = result(spark, "op2_piece_encoding")
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    for row, text in zip(rows.itertuples(), docs.text):
        ids = library.encode(text, add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == sha(" ".join(map(str, ids)))
        assert row.decoded_sha256 == sha(library.decode(ids))


def test_op3_held_out_accuracy(spark, docs):
    rows = result(spark, "op3_sentence_toxicity")
    held = labelled(docs, rows, "toxic", 4, 2)
    assert (held.predicted == held.toxic).mean() > 0.9


def test_op4_equals_the_library(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows, start = result(spark, "op4_token_files"), 0
    for row, text in zip(rows.itertuples(), docs.text):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def plain_targets(sizes: dict, weights=(3, 1, 2), share=1.5):
    """Reshare what is above twice a source's size until none is above."""
    names = sorted(sizes)
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    wanted, full, target = share * sum(sizes.values()), set(), {}
    while True:
        left = wanted - sum(2 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        target = {s: 2 * sizes[s] if s in full else left * weight[s] / total for s in names}
        above = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not above:
            return target
        full |= above


def test_op5_takes_what_is_wanted(spark, docs):
    rows = result(spark, "op5_golden_mix")
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in docs.text]
    assert rows["size"].tolist() == sizes
    assert (rows.taken <= 2 * rows["size"]).all()
    rows["source"] = docs.source
    groups = rows.groupby("source").agg(
        {"size": "sum", "source_size": "first", "target": "first", "taken": "sum"}
    )
    wanted = plain_targets(groups["size"].to_dict())
    assert (groups["size"] == groups.source_size).all()
    for source, row in groups.iterrows():
        assert math.isclose(row.target, wanted[source], rel_tol=1e-9)
        assert abs(row.taken - row.target) < 0.03 * row.target
    again = result(spark, "op5_golden_mix")
    assert (again.taken == rows.taken).all()


def test_op6_base_and_gain(spark, docs):
    rows = result(spark, "op6_class_model")
    held = np.array([zlib.crc32(str(i).encode()) % 5 == 1 for i in docs.doc_id])
    words = [[*t.encode().lower().split(), None] for t in docs.text]
    counts = Counter(w for k in np.flatnonzero(~held) for w in words[k])
    total, divisor = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    assert (rows.held_out == held).all() and (rows.train_tokens == total).all()
    assert rows.n_tokens.tolist() == [len(w) for w in words]
    assert rows.n_known.tolist() == [sum(x in counts for x in w) for w in words]
    base = [sum(math.log10((counts[x] + 0.5) / divisor) for x in w) for w in words]
    assert np.allclose(rows.base_score, base)
    assert rows.score[held].sum() > rows.base_score[held].sum()


def plain_components(docs, width=3, p=90, q=100):
    sets = []
    for text in docs.text:
        w = text.encode().lower().split()
        k = min(width, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders: dict = {}
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in holders.setdefault(g, []))
        for j, n in common.items():
            if n * q >= (len(s) + len(sets[j]) - n) * p:
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for g in s:
            holders[g].append(i)
    return [len(s) for s in sets], [int(docs.doc_id[find(i)]) for i in range(len(sets))]


def test_op7_equals_plain_components(spark, docs):
    rows = result(spark, "op7_parity_join")
    sizes, components = plain_components(docs)
    assert rows.n_shingles.tolist() == sizes
    assert rows.component_id.tolist() == components


def test_op10_base_equals_plain_patterns(spark, docs):
    rows = result(spark, "op10_crf_pii")
    order = ["email", "ip", "card", "phone"]
    for row, text in zip(rows.itertuples(), docs.text):
        found = [
            ("email", m) for m in re.finditer(
                r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
        ]
        found += [
            ("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))
        ]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            digits = [int(c) for c in m.group() if c.isdigit()][::-1]
            total = sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])
            if 12 <= len(digits) <= 19 and total % 10 == 0:
                found.append(("card", m))
        found += [
            ("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15
        ]
        found.sort(key=lambda f: (f[1].start(), order.index(f[0])))
        base = [f"{k}:{m.start()}:{m.end()}" for k, m in found]
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(row.spans.split(",")) | {""} and len(row.spans.split(",")) >= len(base)
