"""From raw documents to token ids: quality, exact and near copies, mixing, encoding.

Every stage works on all that the one before it kept, and all but the last return the columns of
the documents. Stages are written as Parquet and read again, so a lost executor only costs work of
its own stage.
"""

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclimate.llm.content_sort import drop_exact_copies
from gridclimate.llm.golden_mix import mixed_documents
from gridclimate.llm.labelled import id_remainder
from gridclimate.llm.neighbour_quality import fit_quality, score_quality
from gridclimate.llm.parity_join import near_duplicates
from gridclimate.llm.piece_encoding import encode_pieces
from gridclimate.llm.shipping import send_package
from gridclimate.llm.stored import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose neighbours reject them; learned from the labels that the
    query of the operator learns from.

    Each row is judged by its own text, also where its identifier is NULL or repeated, or its text
    NULL (as empty). Without any labelled document of this input all documents stay.
    """
    send_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(id_remainder("doc_id", 5) != 0)
    model = fit_quality(
        docs, labels.select(F.col("doc_id").alias("label_id"), F.col("quality").alias("label"))
    )
    return score_quality(docs, model).where("predicted = 1").select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal contents: the longest, then the smallest identifier.

    NULL texts count as empty, so one of all texts without content stays. A NULL identifier comes
    last; of rows alike in all of this one stays.
    """
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest identifier.

    Documents are near copies if they are linked, over others or directly, by a similarity of at
    least 0.8 on five-word sequences; the query of the operator has a contract of its own. Rows are
    told apart by identifier and text, so a repeated identifier only drops its rows that are near
    copies, and a NULL identifier comes last. Of rows alike in both one stays. Texts without words
    (NULL, empty, blank) are no copies and all stay.
    """
    send_package(spark)
    # The order of this struct is that of identifiers, NULL last, then of a hash of the text.
    row = F.struct(
        F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.xxhash64("text").alias("hash")
    )
    found = near_duplicates(docs.select(row.alias("id"), "text"), id="id", width=5, similarity=(80, 100))
    found = stored(found.where("node IS NOT NULL").select("id", "component_id"), "near")

    def of(ids: DataFrame) -> tuple[DataFrame, Column]:
        ids = ids.select(F.col("id.doc_id").alias("other_id"), F.col("id.hash").alias("other_hash"))
        same = docs["doc_id"].eqNullSafe(ids["other_id"]) & (F.xxhash64(docs["text"]) == ids["other_hash"])
        return ids, same

    dropped = of(found.where("id <> component_id").distinct())
    kept = docs.join(*dropped, "left_anti")
    repeated = found.where("id = component_id").groupBy("id").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    repeated = of(repeated)
    alike = docs.withColumn("other_hash", F.xxhash64("text")).join(*repeated, "left_semi")
    one = alike.dropDuplicates(["doc_id", "other_hash"]).drop("other_hash")
    return kept.join(*repeated, "left_anti").unionByName(one)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of sources takes, as often as it takes them.

    Rows are taken whole, at most twice each; texts without words (NULL, empty, blank) are never
    taken. A NULL source is one more source, the last. Rows that share an identifier, or have none,
    come equally often.
    """
    return mixed_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, end id included, with digests of the ids and of the text decoded from them.

    One row per row, whatever its identifier; a NULL or empty text has the end id alone.
    """
    send_package(spark)
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode_pieces(docs, model, keep=["doc_id", "source"])
    return encoded.select(
        "row.doc_id",
        "row.source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("pieces", pieces),
]

# The first stage's model has no form in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
