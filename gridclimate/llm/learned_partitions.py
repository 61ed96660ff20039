"""Approximate nearest neighbours by learned partitions of a neighbour graph.

A bounded sample of the vectors gives a graph of nearest neighbours, found exactly. The graph is
cut into equally large parts with few edges between them, by halving again and again: a spectral
order is cut in the middle and pairs of vectors change sides as long as that removes edges. A small
classifier learns from a vector how its neighbours are spread over the parts. It then indexes every
vector by its most probable part and routes a query to its most probable parts, as many as hold
the wanted share of the probability. Vectors of these parts are ranked by their exact distance.

A part is cut into blocks of vectors and its queries into chunks, so that no task holds more than
one of each, whatever the size of a part. Equal vectors are one entry with their least identifiers.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stored import stored

SAMPLE = 8192  # vectors the graph is made of, at most
SAMPLE_BYTES = 32 << 20
DEGREE = 10
FEWEST_PARTS, MOST_PARTS, PART = 8, 128, 800  # PART: vectors a part aims at between these bounds
HIDDEN = 96
EPOCHS = 30
BLOCK = 8192  # vectors, or queries, in a task


def neighbour_graph(points: np.ndarray, degree: int) -> np.ndarray:
    """The nearest other rows of each row, exactly, in blocks."""
    degree = min(degree, len(points) - 1)
    norms = np.einsum("ij,ij->i", points, points)
    found = np.zeros((len(points), degree), np.int64)
    for begin in range(0, len(points) if degree else 0, 512):
        rows = slice(begin, min(begin + 512, len(points)))
        away = norms[rows, None] + norms - 2 * (points[rows] @ points.T)
        away[np.arange(rows.stop - begin), np.arange(begin, rows.stop)] = np.inf
        found[rows] = np.argpartition(away, degree - 1, axis=1)[:, :degree]
    return found


def halves(a: np.ndarray, b: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """Sides (False, True) of equally many nodes with few of the edges ``a``, ``b`` between them.

    Edges are listed in both directions.
    """
    degree = np.maximum(np.bincount(a, minlength=count), 1).astype(float)
    x = rng.standard_normal(count)
    for _ in range(80):
        x = (x + np.bincount(a, x[b], count) / degree) / 2
        x -= (x * degree).sum() / degree.sum()
        x /= np.linalg.norm(x) or 1.0
    side = np.zeros(count, bool)
    side[np.argsort(x, kind="stable")[count // 2 :]] = True
    cut = int((side[a] != side[b]).sum())
    for _ in range(40):
        gain = np.bincount(a, np.where(side[a] != side[b], 1.0, -1.0), count)
        ordered = np.argsort(-gain, kind="stable")
        left, right = ordered[~side[ordered]], ordered[side[ordered]]
        pairs = min(len(left), len(right))
        better = int((gain[left[:pairs]] + gain[right[:pairs]] > 0).sum())
        changed = side.copy()
        changed[left[: (better + 1) // 2]] = True
        changed[right[: (better + 1) // 2]] = False
        now = int((changed[a] != changed[b]).sum())
        if now >= cut:
            break
        side, cut = changed, now
    return side


def balanced_parts(neighbours: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """A part from 0 for each row; ``parts`` is a power of two, sizes differ by one a halving."""
    rng = np.random.default_rng(seed)
    count = len(neighbours)
    a = np.repeat(np.arange(count), neighbours.shape[1])
    b = neighbours.ravel()
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    label = np.zeros(count, np.int64)
    step = 1
    while step < parts:
        for part in range(step):
            rows = np.flatnonzero(label == part)
            inside = (label[a] == part) & (label[b] == part)
            place = np.zeros(count, np.int64)
            place[rows] = np.arange(len(rows))
            side = halves(place[a[inside]], place[b[inside]], len(rows), rng)
            label[rows[side]] += step
        step *= 2
    return label


@dataclass
class Router:
    """A classifier with one hidden layer: the probability of each part for a vector."""

    middle: np.ndarray
    scale: float
    weights: list[np.ndarray]

    def hidden(self, values: np.ndarray) -> np.ndarray:
        x = (values - self.middle) / self.scale
        return np.maximum(x @ self.weights[0] + self.weights[1], 0.0)

    def probabilities(self, values: np.ndarray) -> np.ndarray:
        z = self.hidden(values) @ self.weights[2] + self.weights[3]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train_router(points: np.ndarray, targets: np.ndarray, seed: int = 0) -> Router:
    """Fit to the spread ``targets`` (rows of probabilities) by the gradient, with Adam's steps."""
    rng = np.random.default_rng(seed)
    middle = points.mean(axis=0)
    scale = float(np.sqrt(((points - middle) ** 2).mean())) or 1.0
    width, parts = points.shape[1], targets.shape[1]
    weights = [
        rng.standard_normal((width, HIDDEN)) * np.sqrt(2 / width), np.zeros(HIDDEN),
        rng.standard_normal((HIDDEN, parts)) * np.sqrt(1 / HIDDEN), np.zeros(parts),
    ]
    router = Router(middle, scale, weights)
    x = (points - middle) / scale
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    batch, step = 128, 0
    steps = EPOCHS * max(-(-len(x) // batch), 16)
    while step < steps:
        order = rng.permutation(len(x))
        for rows in np.array_split(order, -(-len(x) // batch)):
            step += 1
            hidden = router.hidden(points[rows])
            error = (router.probabilities(points[rows]) - targets[rows]) / len(rows)
            back = (error @ weights[2].T) * (hidden > 0)
            slopes = [x[rows].T @ back, back.sum(0), hidden.T @ error, error.sum(0)]
            rate = 0.005 * min(1.0, 2 * (1 - step / (steps + 1)))
            for w, m, v, g in zip(weights, first, second, slopes):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return router


def parts_for(count: int) -> int:
    """A power of two: the parts for so many vectors."""
    wanted = min(max(count / PART, FEWEST_PARTS), MOST_PARTS)
    return 1 << round(np.log2(wanted))


def fit_router(points: np.ndarray, parts: int) -> Router:
    """Graph, parts and classifier of a sample, in an order of rows that reruns share."""
    neighbours = neighbour_graph(points, DEGREE)
    label = balanced_parts(neighbours, parts)
    spread = np.zeros((len(points), parts))
    np.add.at(spread, (np.arange(len(points)), label), 1.0)
    for column in neighbours.T:
        np.add.at(spread, (np.arange(len(points)), label[column]), 1.0)
    return train_router(points, spread / spread.sum(axis=1, keepdims=True))


def matrix(values: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, width)


def usable(values: Column) -> Column:
    """Whether a vector takes part: not NULL or zero, all parts finite."""
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(values, lambda x: x != 0), F.lit(False))


def entries(rows: DataFrame, most: int) -> DataFrame:
    """``values`` of each different vector and its ``most`` least identifiers, in order."""
    first = Window.partitionBy("values").orderBy("id")
    rows = rows.dropDuplicates(["id", "values"]).withColumn("n", F.row_number().over(first))
    listed = rows.where(F.col("n") <= most).groupBy("values").agg(F.collect_list("id").alias("ids"))
    return listed.select("values", F.sort_array("ids").alias("ids"))


def best_of_tile(x, ids, q, own, k) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of the query, identifier and distance of the ``k`` nearest of each query in ``q``.

    ``ids`` lists the identifiers of each row of ``x``; a query's ``own`` is left out. Products of
    matrices tell which rows may be among the nearest, the distances of these are exact.
    """
    counts = np.array([len(some) for some in ids])
    flat = np.concatenate(ids)
    begins = np.cumsum(counts) - counts
    most = max(float(np.abs(x).max()), float(np.abs(q).max()))
    scaled, asked = x / most, q / most
    norms = np.einsum("ij,ij->i", scaled, scaled)
    slack = 1e-11 * scaled.shape[1]  # more than the products round off
    out = []
    for begin in range(0, len(q), 256):
        some = asked[begin : begin + 256]
        away = norms - 2 * (some @ scaled.T) + np.einsum("ij,ij->i", some, some)[:, None]
        # One entry may be the query's own.
        reach = min(k, len(x) - 1)
        bound = np.partition(away, reach, axis=1)[:, reach] + slack
        row, place = np.nonzero(away <= bound[:, None])
        exact = np.sqrt(((q[begin + row] - x[place]) ** 2).sum(axis=1))
        times = counts[place]
        each = np.repeat(begins[place], times) + np.arange(times.sum()) - np.repeat(
            np.cumsum(times) - times, times
        )
        row, score, found = np.repeat(begin + row, times), np.repeat(exact, times), flat[each]
        other = found != own[row]
        row, score, found = row[other], score[other], found[other]
        order = np.lexsort((found, score, row))
        row, score, found = row[order], score[order], found[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        out.append((row[rank < k], found[rank < k], score[rank < k]))
    return tuple(np.concatenate(column) for column in zip(*out))


def routed(probabilities: np.ndarray, sizes: np.ndarray, mass: float, k: int) -> np.ndarray:
    """Which parts each query visits: the most probable ones, up to that share of probability and
    until they hold more than ``k`` identifiers; parts without any are left out."""
    order = np.argsort(-probabilities, axis=1, kind="stable")
    share = np.cumsum(np.take_along_axis(probabilities, order, 1), axis=1)
    held = np.cumsum(sizes[order], axis=1)
    before = np.ones(order.shape, bool)
    before[:, 1:] = (share[:, :-1] < mass) | (held[:, :-1] <= k)
    visited = np.zeros(order.shape, bool)
    np.put_along_axis(visited, order, before, 1)
    return visited & (sizes > 0)


def nearest_of_width(listed: DataFrame, queries: DataFrame, width: int, k: int, mass: float):
    """``id``, ``node`` (hash of the vector), ``found`` and ``score`` for each query and tile."""
    spark = listed.sparkSession
    most = max(2, min(SAMPLE, SAMPLE_BYTES // (8 * width)))
    sample = listed.orderBy(F.xxhash64("values"), "values").limit(most).select("values").toArrow()
    count = listed.count()
    router = fit_router(matrix(sample.column(0), width), parts_for(count))
    model = spark.sparkContext.broadcast(router)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                part = model.value.probabilities(matrix(batch.column("values"), width)).argmax(1)
                yield batch.append_column("part", pa.array(part.astype(np.int32)))

    kind = listed.schema["values"].dataType.simpleString()
    placed = stored(
        listed.mapInArrow(index, f"values {kind}, ids array<bigint>, part int"), f"placed_{width}"
    )
    totals = placed.groupBy("part").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("ids"))
    totals = {row["part"]: row for row in totals.collect()}  # a row for each part
    sizes = np.array([totals[p]["ids"] if p in totals else 0 for p in range(parts_for(count))])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                odds = model.value.probabilities(matrix(batch.column("values"), width))
                row, part = np.nonzero(routed(odds, sizes, mass, k))
                visits = batch.take(pa.array(row))
                yield visits.append_column("part", pa.array(part.astype(np.int32)))

    visits = stored(
        queries.mapInArrow(route, f"id bigint, values {kind}, part int"), f"visits_{width}"
    )
    asked = {row["part"]: row["count"] for row in visits.groupBy("part").count().collect()}
    pieces = [
        (p, -(-row["n"] // BLOCK), -(-asked[p] // BLOCK)) for p, row in totals.items() if p in asked
    ]
    pieces = F.broadcast(spark.createDataFrame(pieces, "part int, blocks long, chunks long"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    spread = lambda n: F.pmod(F.xxhash64("values", F.lit(1)), F.col(n))
    candidates = placed.join(pieces, "part").select(
        "part", spread("blocks").alias("block"), upto("chunks").alias("chunk"),
        F.lit(None).cast("bigint").alias("id"), "values", "ids",
    )
    visitors = visits.join(pieces, "part").select(
        "part", upto("blocks").alias("block"), F.pmod(F.xxhash64("id"), "chunks").alias("chunk"),
        "id", "values", F.lit(None).cast("array<bigint>").alias("ids"),
    )

    def compare(key, rows):
        query = rows["id"].notna().to_numpy()
        if query.all() or not query.any():
            return pd.DataFrame({"id": [], "node": [], "found": [], "score": []})
        values = np.stack(rows["values"].to_numpy()).astype(np.float64)
        own = rows["id"][query].to_numpy().astype(np.int64)
        row, found, score = best_of_tile(
            values[~query], list(rows["ids"][~query]), values[query], own, k
        )
        node = rows["node"].to_numpy()[query]
        return pd.DataFrame({"id": own[row], "node": node[row], "found": found, "score": score})

    tiles = candidates.unionByName(visitors).withColumn("node", F.xxhash64("values"))
    return tiles.groupBy("part", "block", "chunk").applyInPandas(
        compare, "id bigint, node bigint, found bigint, score double"
    )


def nearest_vectors(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    mass: float = 0.97,
    embedding: str = "embedding",
    id: str = "vec_id",
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the ``k`` nearest found.

    ``queries`` has the columns of ``vectors``. Nearness is the Euclidean distance of the vectors
    as they are, in double precision, least first, ties to the smaller identifier. Candidates are
    all rows but those with the query's identifier; a query with fewer than ``k`` gets all. Vectors
    that are NULL, empty or zero, or have a NULL, NaN or infinite part, take no part, nor do rows
    without an identifier; vectors of another width are no candidates. Repeated rows count once;
    an identifier with several vectors stands for as many candidates, or queries. Other columns are
    not read. ``mass`` is the share of the router's probability that a query's parts hold: the
    higher, the better the recall and the more is compared. The graph is made of at most
    ``SAMPLE`` vectors (``SAMPLE_BYTES``); every vector is indexed.
    """
    own = [F.col(f"`{id}`").cast("bigint").alias("id"), F.col(f"`{embedding}`").alias("values")]
    both = [rows.select(*own).where(F.col("id").isNotNull() & usable(F.col("values")))
            for rows in (vectors, queries)]
    listed = stored(entries(both[0], k + 1).withColumn("width", F.size("values")), "entries")
    asked = both[1].dropDuplicates(["id", "values"])
    found = None
    for row in listed.select("width").distinct().orderBy("width").collect():
        width = row["width"]
        of_width = listed.where(F.col("width") == width).select("values", "ids")
        some = nearest_of_width(of_width, asked.where(F.size("values") == width), width, k, mass)
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = asked.select("id", F.lit(0).cast("bigint").alias("node"),
                             F.col("id").alias("found"), F.lit(0.0).alias("score")).where("false")
    first = Window.partitionBy("id", "node").orderBy("score", "found")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias("query_id"), "rank", F.col("found").alias("vec_id"), "score")
