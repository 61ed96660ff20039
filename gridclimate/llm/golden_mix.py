"""Mix sources to target weights by a low-discrepancy schedule. DataFrame operations only.

Slots take the points of the golden-ratio sequence, which are mapped through the cumulative
targets to sources. The slots of a source are ranked; the slot of rank r takes the r-th block of
the source's stream: its documents in shuffled order, cut into blocks of equally many words. A
stream is gone through twice at most. All orders come from hashes, so reruns agree.

A block has 64 words, or fewer for a source whose target would be less than 100 such blocks: the
greatest power of two that gives it 100, one word at least. Sources with blocks of one length share
a sequence, whose points come as densely as their targets ask for, so small sources are met too.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stored import stored

WEIGHTS = (3, 1, 2)
BLOCK_WORDS = 64
LEAST_BLOCKS = 100  # that a target makes up, where words allow
PASSES = 2
# The golden-ratio sequence in integers: multiples of this odd number modulo 2^31.
PERIOD = 1 << 31
GOLDEN = 1327217885
CELLS = 4096


def word_count(text: Column) -> Column:
    """Number of words, which any of the six blanks of ASCII separate; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def block_length(target: Column, most: int) -> Column:
    """A power of two times fewer words than ``most``, so that a target makes up enough blocks."""
    halvings = F.ceil(F.log2(F.lit(float(most * LEAST_BLOCKS)) / F.greatest(target, F.lit(1.0))))
    length = F.floor(F.lit(most) / F.pow(F.lit(2.0), F.greatest(halvings, F.lit(0))))
    return F.greatest(length, F.lit(1)).cast("long")


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Per source: ``source_size`` and ``target``; one row per source, worked out in one task.

    Sources are in order of code points, NULL last, and take the weights in turn. Together they
    get ``share`` times all words; none gets more than ``PASSES`` times its size, the rest of its
    share goes to the others by weight. This is the level ``target = min(cap, level * weight)``:
    in order of cap per weight, the first source that isn't full sets the level. ``words`` is the
    length of the source's blocks.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    turn = F.array(*map(F.lit, weights))
    return (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("number", F.row_number().over(by_name) - 1)
        .withColumn("weight", turn[F.pmod("number", F.lit(len(weights)))].cast("double"))
        .withColumn("cap", (PASSES * F.col("source_size")).cast("double"))
        .withColumn("wanted", share * F.sum("source_size").over(every))
        .withColumn(
            "level",
            (F.col("wanted") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / F.sum("weight").over(after),
        )
        .withColumn("open", F.col("cap") > F.col("level") * F.col("weight"))
        .withColumn("place", F.row_number().over(by_room))
        .withColumn("first", F.min(F.when(F.col("open"), F.struct("place", "level"))).over(every))
        .withColumn(
            "target",
            F.least("cap", F.coalesce(F.col("first.level") * F.col("weight"), F.col("cap"))),
        )
        .withColumn("words", block_length(F.col("target"), block_words))
        .select("source", "number", "source_size", "target", "words")
    )


def schedule(targets: DataFrame) -> DataFrame:
    """One row per slot: ``words`` of a block, ``slot``, ``place`` of the slot from 0 to 1,
    ``number`` of its source, ``epoch`` and ``block`` to take.

    Slots and sources meet in cells of the unit interval, an equi-join. The ranks of a source's
    slots are counted in stretches of slots, so that no source is ranked in one task.
    """
    spark = targets.sparkSession
    lengths = targets.groupBy("words").agg(F.sum("target").alias("total")).where("total > 0")
    # A row for each power of two up to the longest block.
    counts = {r["words"]: -int(-r["total"] // r["words"]) for r in lengths.collect()}

    own = Window.partitionBy("words")
    in_order = own.orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total, last = F.sum("target").over(own), F.max("number").over(own)
    scaled = F.floor(F.sum("target").over(in_order) / total * PERIOD)
    width = PERIOD // CELLS
    intervals = (
        targets.where("target > 0")
        .withColumn("upto", F.when(F.col("number") == last, F.lit(PERIOD)).otherwise(scaled))
        .withColumn("from", F.lag("upto", 1, 0).over(own.orderBy("number")))
        .where("`from` < upto")
        .select(
            "words",
            "number",
            "from",
            "upto",
            F.ceil(F.col("source_size") / F.col("words")).alias("blocks"),
            F.explode(
                F.sequence(F.floor(F.col("from") / width), F.floor((F.col("upto") - 1) / width))
            ).alias("cell"),
        )
    )
    sequences = [
        spark.range(slots).select(
            F.lit(words).cast("long").alias("words"),
            F.col("id").alias("slot"),
            ((F.col("id") + 0.5) / slots).alias("place"),
            F.pmod(F.pmod("id", F.lit(PERIOD)) * GOLDEN, F.lit(PERIOD)).alias("point"),
            F.floor(F.col("id") / max(1, int(slots**0.5))).alias("stretch"),
        )
        for words, slots in sorted(counts.items())
    ]
    none = spark.range(0).select(
        F.col("id").alias("words"), F.col("id").alias("slot"), F.lit(0.0).alias("place"),
        F.col("id").alias("point"), F.col("id").alias("stretch"),
    )
    points = reduce(DataFrame.unionByName, sequences, none)
    points = points.withColumn("cell", F.floor(F.col("point") / width))
    drawn = (
        points.join(intervals, ["words", "cell"])
        .where("point >= `from` AND point < upto")
        .select("words", "slot", "place", "stretch", "number", "blocks")
    )
    within = Window.partitionBy("number", "stretch").orderBy("slot")
    earlier = Window.partitionBy("number").orderBy("stretch").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = drawn.groupBy("number", "stretch").count().select(
        "number", "stretch", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base")
    )
    return (
        drawn.join(bases, ["number", "stretch"])
        .withColumn("rank", F.col("base") + F.row_number().over(within) - 1)
        .select(
            "words",
            "slot",
            "place",
            "number",
            F.floor(F.col("rank") / F.col("blocks")).alias("epoch"),
            F.pmod("rank", "blocks").alias("block"),
        )
        .where(F.col("epoch") < PASSES)
    )


def streams(sizes: DataFrame, targets: DataFrame, seed: int = 42) -> DataFrame:
    """The sizes with ``number``, ``source_size``, ``target`` and ``start``, the words before it.

    A source's stream is put in order of a hash of the identifier. Its words are summed in
    buckets of the hash first, and then within each bucket.
    """
    buckets = max(1, int(sizes.count() ** 0.5))
    shuffled = sizes.withColumn("order", F.xxhash64(F.lit(seed), "doc_id")).withColumn(
        "bucket", F.shiftrightunsigned("order", 33) % buckets
    )
    of_source = ["number", "source_size", "target", "words"]
    names = [F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name")]
    earlier = Window.partitionBy("no_source", "name").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = (
        shuffled.groupBy(*names, "bucket").agg(F.sum("size").alias("words"))
        .withColumn("base", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .drop("words")
        .join(targets.select(*names, *of_source), ["no_source", "name"])
    )
    within = (
        Window.partitionBy("no_source", "name", "bucket")
        .orderBy("order", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        shuffled.select("doc_id", "source", "size", "order", "bucket", *names)
        .join(bases, ["no_source", "name", "bucket"])
        .withColumn("start", F.col("base") + F.sum("size").over(within) - F.col("size"))
        .select("doc_id", "source", "size", *of_source, "start")
    )


def pieces(placed: DataFrame) -> DataFrame:
    """One row per document and block it reaches into: ``from`` and ``upto`` words of it."""
    first = F.floor(F.col("start") / F.col("words"))
    last = F.floor((F.col("start") + F.col("size") - 1) / F.col("words"))
    cut = placed.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.col("block") * F.col("words") - F.col("start")
    return cut.withColumn("from", F.greatest(F.lit(0), begin)).withColumn(
        "upto", F.least("size", begin + F.col("words"))
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    source: str = "source",
    weights=WEIGHTS,
    share: float = 1.5,
    block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """The mix as pieces of slots, and the decision for each document.

    The first table has ``place`` (the slot's, from 0 to 1, which is the order of the mix),
    ``slot``, ``epoch``, ``doc_id``, ``source`` and the words ``from`` to ``upto`` that the slot
    takes of the document. The second has one row per row of ``docs``:
    ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``taken``. Documents without
    words (NULL, empty, blank) are in the second only, with nothing taken; a source of such
    documents has the target 0. Repeated rows are rows of their own. Other columns are not used.
    """
    sizes = stored(
        docs.select(
            F.col(f"`{id}`").alias("doc_id"),
            F.col(f"`{source}`").alias("source"),
            word_count(F.col(f"`{text}`")).alias("size"),
        ),
        "sizes",
    )
    targets = stored(source_targets(sizes, weights, share, block_words), "targets")
    placed = stored(streams(sizes, targets), "streams")
    slots = schedule(targets)
    cut = pieces(placed)
    mixed = cut.drop("words").join(slots, ["number", "block"]).select(
        "place", "slot", "epoch", "doc_id", "source", "from", "upto"
    )
    times = slots.groupBy("number", "block").agg(F.count("*").alias("times"))
    row = ["doc_id", "source", "size", "source_size", "target", "start"]
    taken = (
        cut.join(times, ["number", "block"], "left")
        .groupBy(*row)
        .agg(
            F.sum(F.coalesce("times", F.lit(0)) * (F.col("upto") - F.col("from"))).alias("taken")
        )
    )
    without = placed.where("size = 0").select(*row, F.lit(0).cast("long").alias("taken"))
    return mixed, taken.unionByName(without).drop("start")


def copies(decisions: DataFrame) -> DataFrame:
    """How often each whole document comes: the words taken over its size, rounded."""
    return decisions.groupBy("doc_id").agg(
        F.max(
            F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0)
        ).cast("int").alias("copies")
    )


def mixed_documents(docs: DataFrame, text="text", id="doc_id", source="source") -> DataFrame:
    """The documents of the mix, whole, once for each time that most of their words are taken.

    Has the columns of ``docs``. Rows with the same identifier come equally often. Only the
    document at the end of a source's share is rounded.
    """
    decisions = copies(mix(docs, text, id, source)[1]).withColumnRenamed("doc_id", "mix_id")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return (
        rows.join(decisions, F.col("row")[id].eqNullSafe(F.col("mix_id")))
        .where("copies > 0")
        .select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies"))))
        .select("row.*")
    )
