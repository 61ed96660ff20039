"""Near-duplicate vectors by a dual traversal of cover trees.

Vectors are put on the unit sphere, where a cosine is a distance. A bounded sample gives the
centres of the top level; every vector lives in the cell of its nearest centre and visits the cells
that may hold vectors within the threshold of it. Each cell, and its visitors, are cut into blocks
of bounded size. Each block is a cover tree: nested levels whose radii halve, down to leaves, every
node with the radius that covers all below it. Pairs of nodes are dropped when their distance less
both radii is above the threshold, and taken as a whole when their distance plus both radii is
below it; what is left is opened on the next level. The vectors of two leaves are compared at once,
by their cosine in double precision, so the result is exact. On wide vectors spread over the sphere
the cover doesn't group and few pairs of nodes can be dropped; such a node is one leaf, and its
vectors are compared by one product of matrices instead of node by node.

Equal vectors are one node that counts as many, so they cost nothing.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, with_least
from .stored import stored

BLOCK = 2048
CENTRES = 1024
SLACK = 1e-6  # of distances; what is closer to a bound than this is opened
# A node of at most so many vectors isn't split, nor one whose cover at half its radius has made as
# many groups of fewer than two vectors on average: then it is a leaf of all its vectors.
LEAF = 64


def units(values: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; the largest part goes first, against overflow."""
    values = values.astype(np.float64)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * (x @ y.T)))


@dataclass
class Tree:
    """A cover tree over the rows of ``points``, put in order so that a node is a span of them."""

    order: np.ndarray
    point: np.ndarray  # row of each node's centre, in that order
    radius: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first_child: np.ndarray
    last_child: np.ndarray  # exclusive; as first_child where there is none


def build_tree(points: np.ndarray) -> Tree:
    """Cover greedily with half the radius, level by level, until nodes are single rows."""
    order = np.arange(len(points))
    nodes = [[0, 2.0, 0, len(points), 0, 0]]  # centre's place in order, radius, span, children
    todo = [(0, 2.0)]
    while todo:
        at, level = todo.pop()
        begin, end = nodes[at][2:4]
        if end - begin == 1:
            nodes[at][1] = 0.0
            continue
        rows = order[begin:end]
        away = distances(points[rows[:1]], points[rows])[0]
        nodes[at][1] = radius = float(away.max())
        if end - begin <= LEAF:
            continue
        while level > radius:
            level /= 2
        # Below this radius halving says nothing more; the rows become children at once.
        reach = level if radius > 1e-7 else -1.0
        left, groups = rows, []
        while len(left):
            gap = distances(points[left[:1]], points[left])[0] if reach >= 0 else None
            near = gap <= reach if reach >= 0 else np.arange(len(left)) == 0
            near[0] = True
            groups.append(left[near])
            left = left[~near]
            if len(groups) >= LEAF and len(rows) - len(left) < 2 * len(groups):
                break
        if len(left):
            continue
        if len(groups) == 1:
            todo.append((at, level / 2))
            continue
        order[begin:end] = np.concatenate(groups)
        nodes[at][4:6] = len(nodes), len(nodes) + len(groups)
        for group in groups:
            todo.append((len(nodes), level / 2))
            nodes.append([begin, 2.0, begin, begin + len(group), 0, 0])
            begin += len(group)
    # The first row of a span is the centre of its node, and of its first child.
    columns = list(zip(*nodes))
    whole = [np.array(c, np.int64) for c in (columns[2], columns[2], columns[3], *columns[4:])]
    return Tree(order, whole[0], np.array(columns[1]), *whole[1:])


@dataclass
class Block:
    """Vectors of a block in the order of its tree."""

    nodes: np.ndarray
    copies: np.ndarray
    points: np.ndarray
    tree: Tree


def make_block(nodes, copies, values) -> Block:
    points = units(values)
    tree = build_tree(points)
    order = tree.order
    return Block(nodes[order], copies[order], points[order], tree)


class Traversal:
    """Links between two blocks: how many each vector has, and edges that span them."""

    def __init__(self, x: Block, y: Block, cosine: float):
        self.x, self.y, self.cosine = x, y, cosine
        self.bound = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
        self.links_x, self.links_y = np.zeros(len(x.nodes), int), np.zeros(len(y.nodes), int)
        self.edges: list[np.ndarray] = []
        weight = lambda b: np.concatenate([[0], np.cumsum(b.copies)])
        self.weight_x, self.weight_y = weight(x), weight(y)
        # In single precision first: most pairs of single vectors are far from the bound.
        self.short_x = x.points.astype(np.float32)
        self.short_y = self.short_x if x is y else y.points.astype(np.float32)
        root = np.zeros(1, np.int64)
        todo = [(root, root, np.ones((1, 1), bool))]
        while todo:
            todo.extend(self.compare(*todo.pop()))

    def compare(self, a: np.ndarray, b: np.ndarray, wanted: np.ndarray):
        """Decide the wanted pairs of the nodes ``a`` and ``b``; returns those of the next level."""
        s, t = self.x.tree, self.y.tree
        one_a, one_b = s.first_child[a] == s.last_child[a], t.first_child[b] == t.last_child[b]
        self.leaves(a[one_a], b[one_b], wanted[one_a][:, one_b])
        for p, q in ((~one_a, ~one_b), (~one_a, one_b), (one_a, ~one_b)):
            if p.any() and q.any():
                below = self.inner(a[p], b[q], wanted[p][:, q])
                if below:
                    yield below

    def leaves(self, a: np.ndarray, b: np.ndarray, wanted: np.ndarray) -> None:
        """Pairs of vectors of two leaves, all at once, by their cosine in double precision."""
        rows, columns = wanted.any(1), wanted.any(0)
        if not rows.any():
            return
        i, of_a = spans(self.x.tree, a[rows])
        j, of_b = spans(self.y.tree, b[columns])
        near = self.short_x[i] @ self.short_y[j].T >= self.cosine - 1e-4
        p, q = np.nonzero(near & wanted[rows][:, columns][of_a][:, of_b])
        for some in np.array_split(np.arange(len(p)), max(1, len(p) >> 16)):
            u, v = i[p[some]], j[q[some]]
            linked = np.einsum("ij,ij->i", self.x.points[u], self.y.points[v]) >= self.cosine
            u, v = u[linked], v[linked]
            np.add.at(self.links_x, u, self.y.copies[v])
            np.add.at(self.links_y, v, self.x.copies[u])
            if len(u):
                self.edges.append(spanning(np.stack([self.x.nodes[u], self.y.nodes[v]], 1)))

    def inner(self, a: np.ndarray, b: np.ndarray, wanted: np.ndarray):
        """Pairs with a node of several vectors: dropped, taken as a whole, or opened."""
        s, t = self.x.tree, self.y.tree
        apart = distances(self.x.points[s.point[a]], self.y.points[t.point[b]])
        reach = s.radius[a][:, None] + t.radius[b][None, :]
        whole = wanted & (apart + reach <= self.bound - SLACK)
        for p, q in zip(*np.nonzero(whole)):
            i, j = slice(s.begin[a[p]], s.end[a[p]]), slice(t.begin[b[q]], t.end[b[q]])
            self.links_x[i] += self.weight_y[j.stop] - self.weight_y[j.start]
            self.links_y[j] += self.weight_x[i.stop] - self.weight_x[i.start]
            for ends, other in ((self.x.nodes[i], self.y.nodes[j.start]),
                                (self.y.nodes[j], self.x.nodes[i.start])):
                self.edges.append(np.stack([ends, np.full(len(ends), other)], 1))
        opened = wanted & ~whole & (apart - reach <= self.bound + SLACK)
        rows, columns = np.flatnonzero(opened.any(1)), np.flatnonzero(opened.any(0))
        if not len(rows):
            return None
        below_a, of_a = self.children(s, a[rows])
        below_b, of_b = self.children(t, b[columns])
        return below_a, below_b, opened[rows[of_a]][:, columns[of_b]]

    @staticmethod
    def children(tree: Tree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes on the next level, and the place of the parent of each."""
        first, last = tree.first_child[nodes], tree.last_child[nodes]
        size = np.maximum(last - first, 1)
        of = np.repeat(np.arange(len(nodes)), size)
        within = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
        return np.where(last > first, first, nodes)[of] + within, of


def spans(tree: Tree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of the nodes, in the order of the tree, and the place of the node of each."""
    size = tree.end[nodes] - tree.begin[nodes]
    of = np.repeat(np.arange(len(nodes)), size)
    within = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
    return tree.begin[nodes][of] + within, of


def spanning(edges: np.ndarray) -> np.ndarray:
    """As few edges that connect the same nodes."""
    if not len(edges):
        return edges
    nodes, ends = np.unique(edges, return_inverse=True)
    a, b = ends.reshape(-1, 2).T
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    away = label != np.arange(len(nodes))
    return np.stack([nodes[label[away]], nodes[away]], 1)


def farthest_first(points: np.ndarray, most: int) -> np.ndarray:
    """Centres of nested levels: each next one is the row farthest from those before."""
    chosen, away = [0], distances(points[:1], points)[0]
    while len(chosen) < min(most, len(points)) and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, distances(points[chosen[-1:]], points)[0])
    return points[chosen]


def near_cells(away: np.ndarray, between: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each vector, and which centres of higher number it has to visit.

    Whatever is nearer to another centre lies behind the plane in the middle between the two, so a
    vector only visits cells whose plane isn't farther than the bound.
    """
    own = away.argmin(1)
    nearest = away[np.arange(len(away)), own][:, None]
    apart = np.maximum(between[own], 1e-300)
    to_plane = (away * away - nearest * nearest) / (2 * apart)
    return own, (to_plane <= bound + SLACK) & (np.arange(away.shape[1]) > own[:, None])


def links_of_width(nodes: DataFrame, count: int, cosine: float, name: str):
    """Counts (``node``, ``links``, own copies included) and edges of vectors of one width."""
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(CENTRES).select("values").collect()
    centres = farthest_first(
        units(np.array([r["values"] for r in sample], np.float64)),
        min(CENTRES, max(1, -(-count // BLOCK))),
    )
    bound = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    between = distances(centres, centres)

    def place(batches):
        for rows in batches:
            for part in np.array_split(np.arange(len(rows)), len(rows) // 2048 + 1):
                if not len(part):
                    continue
                some = rows.iloc[part].copy()
                away = distances(units(np.stack(some["values"].to_numpy())), centres)
                own, visits = near_cells(away, between, bound)
                some["cell"] = own.astype(np.int32)
                some["visits"] = [np.flatnonzero(v).astype(np.int32) for v in visits]
                yield some

    kind = nodes.schema["values"].dataType.simpleString()
    placed = stored(
        nodes.select("node", "copies", "values").mapInPandas(
            place, f"node long, copies long, values {kind}, cell int, visits array<int>"
        ),
        f"{name}_placed",
    )
    # A row for each of at most ``CENTRES`` cells: into how many blocks those who live in it and
    # those who visit it are cut.
    blocks = F.ceil(F.count("*") / BLOCK).cast("int")
    here = placed.groupBy("cell").agg(blocks.alias("parts"))
    guests = placed.select(F.explode("visits").alias("cell")).groupBy("cell").agg(blocks.alias("groups"))
    cells = F.broadcast(here.join(guests, "cell", "left").na.fill({"groups": 0}))

    part = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    vector = ["node", "copies", "values"]
    own = placed.drop("visits").join(cells, "cell").withColumn("part", part("parts"))
    visiting = placed.select(*vector, F.explode("visits").alias("cell")).join(cells, "cell")
    upto = lambda first, last: F.explode(
        F.when(F.lit(first) < last, F.sequence(F.lit(first), last - 1)).otherwise(F.array().cast("array<int>"))
    )
    # A tile compares a block of a cell with a later one of the same cell, or with visitors.
    tile = lambda part, guest, other: F.struct(
        "cell", part.alias("part"), F.lit(guest).alias("guest"), other.alias("other")
    ).alias("tile")
    column, no = F.col, F.lit(False).alias("second")
    numbered = own.select(*vector, "cell", "part", "parts", "groups")
    with_later = numbered.select("*", upto(0, F.col("parts")).alias("k"))
    with_guests = numbered.select("*", upto(0, F.col("groups")).alias("k"))
    guests_of = visiting.select(*vector, "cell", part("groups").alias("own"), upto(0, F.col("parts")).alias("k"))
    rows = (
        with_later.where("k >= part").select(*vector, tile(column("part"), False, column("k")), no)
        .unionByName(with_later.where("k < part").select(
            *vector, tile(column("k"), False, column("part")), F.lit(True).alias("second")))
        .unionByName(with_guests.select(*vector, tile(column("part"), True, column("k")), no))
        .unionByName(guests_of.select(
            *vector, tile(column("k"), True, column("own")), F.lit(True).alias("second")))
    )

    def compare(key, rows):
        second = rows["second"].to_numpy()
        alone = not key[0]["guest"] and key[0]["part"] == key[0]["other"]
        sides = [
            make_block(some["node"].to_numpy(), some["copies"].to_numpy(), np.stack(some["values"].to_numpy()))
            for some in (rows[~second], rows[second]) if len(some)
        ]
        counts, edges = [], []
        if alone or len(sides) == 2:
            found = Traversal(sides[0], sides[-1], cosine)
            for block, links in [(sides[0], found.links_x), (sides[-1], found.links_y)][: len(sides)]:
                some = links > 0
                counts.append(np.stack([block.nodes[some], links[some]], 1))
            edges = found.edges
        edges = spanning(np.concatenate(edges)) if edges else np.zeros((0, 2), np.int64)
        counts = np.concatenate(counts) if counts else np.zeros((0, 2), np.int64)
        return pd.DataFrame(
            np.concatenate([np.insert(counts, 0, 0, 1), np.insert(edges, 0, 1, 1)]),
            columns=["kind", "a", "b"],
        )

    found = stored(
        rows.groupBy("tile").applyInPandas(compare, "kind long, a long, b long"), f"{name}_found"
    )
    counts = found.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("b").alias("links"))
    return counts, found.where("kind = 1").select("a", "b")


def near_vectors(
    vectors: DataFrame, embedding: str = "embedding", id: str = "vec_id", cosine: float = 0.95
) -> DataFrame:
    """One row per row of ``vectors``: ``id``, ``n_links``, ``component_id``, ``kept``.

    ``n_links`` counts the other rows whose cosine is at least ``cosine`` (above 0), equal rows
    included; ``component_id`` is the smallest identifier that links lead to, and ``kept`` tells
    whether it is the row's own. Vectors that are NULL, empty or zero, or have a NULL, NaN or
    infinite part, link with nothing; nor do vectors of different widths. A NULL identifier is
    never the smallest unless there is no other, and is not kept. Other columns are not read.
    """
    rows = vectors.select(F.col(f"`{id}`").alias("id"), F.col(f"`{embedding}`").alias("values"))
    finite = F.forall(
        "values", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists("values", lambda x: x != 0)
    node = F.when(F.coalesce(finite, F.lit(False)), F.xxhash64("values"))
    rows = rows.withColumn("node", node)
    nodes = stored(
        rows.where("node IS NOT NULL").groupBy("node", "values")
        .agg(F.count("*").alias("copies")).withColumn("width", F.size("values")),
        "vectors",
    )
    widths = nodes.groupBy("width").count().orderBy("width").collect()
    counts = edges = None
    for width, count in widths:
        some = nodes.where(F.col("width") == width)
        more = links_of_width(some, count, cosine, f"width_{width}")
        counts, edges = more if counts is None else (
            counts.unionByName(more[0]), edges.unionByName(more[1])
        )
    if counts is None:
        alone = rows.withColumn("n_links", F.lit(0).cast("long"))
        return alone.select("id", "n_links", F.col("id").alias("component_id"),
                            F.col("id").isNotNull().alias("kept"))
    labels = components(edges, "vectors")
    found = (
        rows.select("id", "node").join(counts, "node", "left").join(labels, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    component = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least"))
    return with_least(found, "root", "id").select(
        "id",
        F.coalesce(F.col("links") - 1, F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
