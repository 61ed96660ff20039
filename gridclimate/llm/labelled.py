"""Bounded samples of labelled documents, from which models are fitted."""

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stored import stored

SAMPLED = "label int, features binary"
SAMPLE_BYTES = 64 << 20


def id_remainder(id: str, parts: int) -> Column:
    """CRC-32 of the identifier as text, modulo ``parts``; by this rows are held out."""
    return F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(parts))


def sampled_labels(labels: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of ``label_id`` and ``label``, those that come first by a hash.

    To these come the first of each label up to a tenth as many, so that a rare label isn't thinned.
    """
    known = labels.select("label_id", F.col("label").cast("int").alias("label")).where(
        "label_id IS NOT NULL AND label IS NOT NULL"
    ).distinct()
    first = lambda rows, n: rows.orderBy(F.xxhash64("label_id"), "label_id", "label").limit(n)
    parts = [first(known, most), *(first(known.where(F.col("label") == k), most // 10) for k in (0, 1))]
    return reduce(DataFrame.unionByName, parts).distinct()


def sample_features(
    docs: DataFrame,
    labels: DataFrame,
    features: Callable[[str], list[int]],
    most: int,
    text: str = "text",
    id: str = "doc_id",
    most_bytes: int = SAMPLE_BYTES,
) -> list[tuple[int, np.ndarray]]:
    """Label and features of labelled documents, collected: ``sampled_labels`` of ``most`` rows.

    ``labels`` has ``label_id`` and ``label`` (0 or 1); rows with a NULL are left out. Of rows that
    share an identifier the text with the least hash counts. The features are made on the
    executors; all that reaches the driver is at most ``most_bytes`` of them, for which the documents
    with the most features are left out if need be. Reruns agree.
    """
    # At most as many rows as the sample has.
    texts = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")).join(
        F.broadcast(sampled_labels(labels, most)), F.col("id") == F.col("label_id")
    )
    # Merged before the shuffle, so an identifier with very many rows sends one a task.
    texts = texts.groupBy("label_id", "label").agg(
        F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [np.array(features(t or ""), "<i8") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([m.tobytes() for m in made], pa.binary())],
                ["label", "features"],
            )

    made = stored(texts.select("label", "least.text").mapInArrow(make, SAMPLED), "sample")
    length = F.length("features")
    sizes = np.sort([row[0] for row in made.select(length).collect()])
    fitting = sizes[np.cumsum(sizes) <= most_bytes]
    rows = made.where(length <= int(fitting[-1] if len(fitting) else 0)).collect()
    # An order that doesn't depend on how the rows were dealt out.
    rows = sorted((row.label, bytes(row.features)) for row in rows)
    while sum(len(packed) for _, packed in rows) > most_bytes:  # equally many features as the last
        rows.remove(max(rows, key=lambda row: (len(row[1]), row)))
    return [(label, np.frombuffer(packed, "<i8")) for label, packed in rows]
