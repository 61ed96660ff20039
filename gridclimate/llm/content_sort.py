"""Exact duplicates by sorting contents.

Sampled splitters deal the texts out by ranges of their normalised content, the external sort of
each range puts equal texts next to each other, and a window compares each normalised text in full
with its neighbours. DataFrame operations only.

The range key is the first characters of the normalised text and a hash of all of it, so that a
beginning shared by very many texts is still cut into ranges. A text that occurs very often is
dealt out as numbered runs of about ``run_rows`` rows; the best row and the size of its whole
group are then merged from all its rows before any shuffle. Only the ``hot_texts`` most frequent
contents are treated so: every other content has less than one part in ``hot_texts`` of all rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without blanks; NULL counts as empty."""
    text = F.coalesce(text, F.lit(""))
    for blank in WHITE:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def content_groups(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    run_rows: int = 256,
    hot_texts: int = 4096,
    prefix: int = 32,
) -> DataFrame:
    """One row per row of ``docs``, with the group of equal normalised texts it belongs to.

    Columns: ``row`` (a struct of all columns of ``docs``, so that no name can clash), ``keep_id``,
    ``group_size``, ``kept`` and ``text_sha256`` (of the normalised text). Of a group the row with
    the most code points stays, then the smallest identifier; a NULL identifier comes after all
    others. Rows equal in both are interchangeable, and exactly one of them is kept. NULL texts
    count as empty, an empty table gives no rows.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    id_of, text_of = F.col("row")[id], F.col("row")[text]
    content = normalised(text_of)
    rows = rows.withColumn("hash", F.xxhash64(content))
    better = F.struct(
        (-F.char_length(F.coalesce(text_of, F.lit("")))).alias("shorter"),
        id_of.isNull().alias("no_id"),
        id_of.alias("id"),
    )

    hot = (
        rows.groupBy("hash").count().where(F.col("count") > run_rows)
        .orderBy(F.desc("count"), "hash").limit(hot_texts)
        .select("hash", F.ceil(F.col("count") / run_rows).alias("runs"))
    )
    # At most hot_texts rows of two numbers, whatever the size of the corpus.
    hot = F.broadcast(docs.sparkSession.createDataFrame(hot.collect(), "hash long, runs long"))
    merged = (
        rows.join(hot, "hash")
        .groupBy(F.coalesce(F.sha2(content, 256), F.lit("")).alias("text_sha256"))
        .agg(F.min(better).alias("hot_best"), F.count("*").alias("hot_size"))
    )

    runs = rows.join(hot, "hash", "left").select(
        "row",
        F.left(content, F.lit(prefix)).alias("beginning"),
        "hash",
        F.when(F.col("runs") > 1, F.pmod(F.xxhash64(id_of), "runs")).alias("run"),
    )
    ranges = (
        runs.repartitionByRange("beginning", "hash", "run")
        .withColumn("content", content)
        .withColumn("own", better)
    )
    equal = Window.partitionBy("beginning", "hash", "run", "content").orderBy("own")
    whole = equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = ranges.select(
        "row",
        "run",
        "own",
        F.row_number().over(equal).alias("place"),
        F.first("own").over(whole).alias("best"),
        F.count("*").over(whole).alias("size"),
        F.coalesce(F.sha2("content", 256), F.lit("")).alias("text_sha256"),
    )
    # As many rows as there are hot contents.
    groups = ranked.join(F.broadcast(merged), "text_sha256", "left")
    best = F.when(F.col("run").isNotNull(), F.col("hot_best")).otherwise(F.col("best"))
    size = F.when(F.col("run").isNotNull(), F.col("hot_size")).otherwise(F.col("size"))
    return groups.select(
        "row",
        best["id"].alias("keep_id"),
        size.alias("group_size"),
        ((F.col("place") == 1) & F.col("own").eqNullSafe(best)).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    return content_groups(docs, text, id).where("kept").select("row.*")
