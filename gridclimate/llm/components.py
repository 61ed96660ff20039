"""Connected components of links, by hooking and contraction."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stored import stored

SALTS = 16  # parts that the rows of one component are dealt out to


def salts() -> Column:
    """All parts: each row is copied to every one of them."""
    return F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")


def salt(*columns: str) -> Column:
    """The part of a row."""
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def with_least(rows: DataFrame, root: str, id: str) -> DataFrame:
    """The rows with the smallest ``id`` of their ``root`` as ``least``; NULL without a root.

    The smallest ones are merged before the shuffle, and the rows of one root are dealt out.
    """
    least = rows.where(F.col(root).isNotNull()).groupBy(root).agg(F.min(id).alias("least"))
    least = least.select(root, "least", salts())
    return rows.withColumn("salt", salt(id)).join(least, [root, "salt"], "left").drop("salt")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node`` and ``root`` for every node of the links ``a``, ``b``; one root per component.

    In each round a node hooks to the neighbour that comes first by a hash of the round, pointers
    are followed, and the links are contracted, until none is left. A node with very many links
    only sends its least neighbour per task. Rounds grow with the logarithm of the longest path.
    NULLs link with nothing; no links give no rows.
    """
    links = stored(
        links.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        f"{name}_links",
    )
    labels = None
    round = 0
    while not links.isEmpty():
        order = lambda c: F.struct(F.xxhash64(F.lit(round), c).alias("h"), F.col(c).alias("id"))
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = (
            ends.groupBy("a").agg(F.min(order("b")).alias("first"))
            .select("a", F.least(order("a"), "first")["id"].alias("p"))
        )
        for jump in range(2):
            hooked = stored(hooked, f"{name}_{round}_{jump}")
            onward = hooked.select(F.col("a").alias("p"), F.col("p").alias("q"))
            hooked = hooked.join(onward, "p").select("a", F.col("q").alias("p"))
        hooked = stored(hooked, f"{name}_{round}_hooked")
        to_a = hooked.select("a", F.col("p").alias("x"))
        to_b = hooked.select(F.col("a").alias("b"), F.col("p").alias("y"))
        links = stored(
            links.join(to_a, "a").join(to_b, "b").where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            f"{name}_{round}_links",
        )
        if labels is None:
            labels = hooked.select(F.col("a").alias("node"), F.col("p").alias("root"))
        else:
            moved = hooked.select(F.col("a").alias("root"), "p", salts())
            labels = labels.withColumn("salt", salt("node")).join(moved, ["root", "salt"], "left")
            labels = labels.select("node", F.coalesce("p", "root").alias("root"))
        labels = stored(labels, f"{name}_{round}_labels")
        round += 1
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
