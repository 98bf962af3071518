"""Near-duplicate vectors: all pairs above a cosine, by dual traversal of cover trees.

On unit vectors a cosine of at least c is a distance of at most sqrt(2 - 2c), so the
triangle inequality holds. Each node of a tree has a centre, which its first child
shares, and covers its points within a radius that at least halves from level to
level; two nodes whose centres are farther apart than the distance and both radii
hold no pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joinwright.functions.columns import col

from .common import flat, spread, staged
from .components import components
from .vectors import finite, matrix, packed

#: Different vectors of a tree; points of a leaf.
TREE = 2048
LEAF = 32
#: Added to distances for what rounding may take away.
ROUNDING = 1e-7


class CoverTree:
    """Nested levels over unit vectors; a node's points are a stretch of ``order``."""

    def __init__(self, unit: np.ndarray):
        self.unit = unit
        self.order = np.arange(len(unit))
        self.start, self.end, self.centre, self.radius = [], [], [], []
        self.children: list[np.ndarray] = []
        if len(unit):
            self._grow(0, len(unit), 0, 2.0)

    def _add(self, start: int, end: int, centre: int, radius: float) -> int:
        self.start.append(start)
        self.end.append(end)
        self.centre.append(centre)
        self.radius.append(radius)
        self.children.append(np.zeros(0, np.int64))
        return len(self.start) - 1

    def _apart(self, centre: int, points: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, 2 - 2 * (self.unit[points] @ self.unit[centre])))

    def _grow(self, start: int, end: int, centre: int, scale: float) -> None:
        todo = [(self._add(start, end, centre, scale), scale)]
        while todo:
            node, scale = todo.pop()
            start, end = self.start[node], self.end[node]
            if end - start <= LEAF or self.radius[node] <= ROUNDING:
                continue
            left, at, made = self.order[start:end].copy(), start, []
            centre = self.centre[node]
            while len(left):
                apart = self._apart(centre, left)
                inside = apart <= scale / 2
                inside[left == centre] = True
                own = left[inside]
                self.order[at : at + len(own)] = own
                made.append(self._add(at, at + len(own), centre, float(apart[inside].max())))
                at += len(own)
                left = left[~inside]
                if len(left):
                    centre = int(left[0])
            self.children[node] = np.array(made)
            todo += [(child, scale / 2) for child in made]

    def frozen(self) -> None:
        self.start, self.end = np.array(self.start), np.array(self.end)
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)


def dual_pairs(one: CoverTree, two: CoverTree, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Points of either tree that may be within ``reach``, as pairs of sets of points.

    If both are the same tree, every set of pairs comes once, also that of a set
    with itself.
    """
    same = one is two
    todo = [(0, 0)] if len(one.order) and len(two.order) else []
    while todo:
        a, b = todo.pop()
        own, other = one.children[a], two.children[b]
        if not len(own) and not len(other):
            yield one.order[one.start[a] : one.end[a]], two.order[two.start[b] : two.end[b]]
            continue
        if not len(own):
            own = np.array([a])
        if not len(other):
            other = np.array([b])
        product = one.unit[one.centre[own]] @ two.unit[two.centre[other]].T
        apart = np.sqrt(np.maximum(0.0, 2 - 2 * product))
        near = apart <= reach + ROUNDING + one.radius[own][:, None] + two.radius[other][None, :]
        if same and a == b:
            near = np.triu(near)
        at = np.nonzero(near)
        todo += zip(own[at[0]].tolist(), other[at[1]].tolist(), strict=True)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n points, the smallest that links reach."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def linked(
    x: np.ndarray, y: np.ndarray | None, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of x and y, or of x alone, of at least this cosine."""
    norm_x = np.sqrt((x * x).sum(axis=1))
    one = CoverTree(x / norm_x[:, None])
    one.frozen()
    if y is None:
        y, norm_y, two = x, norm_x, one
    else:
        norm_y = np.sqrt((y * y).sum(axis=1))
        two = CoverTree(y / norm_y[:, None])
        two.frozen()
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p, q in dual_pairs(one, two, math.sqrt(2 - 2 * threshold)):
        cosine = (x[p] @ y[q].T) / norm_x[p][:, None] / norm_y[q][None, :]
        i, j = np.nonzero(cosine >= threshold)
        i, j = p[i], q[j]
        if one is two and p[0] == q[0]:  # a set with itself: each pair once
            i, j = i[(keep := i < j)], j[keep]
        found_a.append(i)
        found_b.append(j)
    return np.concatenate(found_a), np.concatenate(found_b)


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    Rows link if their labels are equal and not null and the cosine of their vectors
    is at least ``threshold``. ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id that links reach. Vectors that are null, empty,
    zero or hold null, NaN or infinite components link with nothing, nor do vectors
    of different length; such a row is its own component.

    Equal vectors of a label are one point with a weight, however many there are. The
    points of a label are dealt to trees of bounded size, and each pair of trees is a
    row of its own, so a label of any share of all rows is many tasks' work. A pair
    of trees gives sums and a spanning forest, never its pairs of points. The number of
    pairs of trees grows with the square of a label's points.
    """
    rows = vectors.select(
        col(id_column).alias("vec_id"),
        col(label_column).alias("label"),
        col(vector_column).alias("vector"),
    )
    counts = finite("vector") & F.exists("vector", lambda x: x != 0) & F.col("label").isNotNull()
    counts = F.coalesce(counts, F.lit(False))
    points = staged(
        rows.filter(counts)
        .groupBy("label", "vector")
        .agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
        .withColumn("size", F.size("vector"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    groups = points.groupBy("label", "size").agg(
        F.ceil(F.count("*") / F.lit(TREE)).cast("int").alias("n_trees")
    )
    dealt = points.join(groups, ["label", "size"]).withColumn(
        "tree", F.pmod(F.xxhash64("node"), F.col("n_trees")).cast("int")
    )
    keys = ["label", "size", "tree"]
    trees = staged(
        packed(dealt, [*keys, "n_trees"], ["node", "weight", "vector"])
    )
    pairs = trees.select(
        "label", "size", F.col("tree").alias("low"), F.explode(F.sequence("tree", F.col("n_trees") - 1)).alias("high")
    )
    n_pairs = pairs.count()
    met = (
        pairs.join(trees.select("label", "size", F.col("tree").alias("low"), F.col("rows").alias("x")), ["label", "size", "low"])
        .join(trees.select("label", "size", F.col("tree").alias("high"), F.col("rows").alias("y")), ["label", "size", "high"])
        .repartition(spread(vectors.sparkSession, n_pairs, 4), "label", "size", "low", "high")
        .select("low", "high", "x", "y")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = batch.column("x").slice(i, 1).flatten()
                y = batch.column("y").slice(i, 1).flatten()
                own = batch.column("low")[i] == batch.column("high")[i]
                points_x, points_y = matrix(x.field("vector")), None if own else matrix(y.field("vector"))
                a, b = linked(points_x, points_y, threshold)
                node, weight = flat(x.field("node")), flat(x.field("weight"))
                if not own:
                    b = b + len(node)
                    node = np.concatenate([node, flat(y.field("node"))])
                    weight = np.concatenate([weight, flat(y.field("weight"))])
                links = np.bincount(a, weight[b], len(node)) + np.bincount(b, weight[a], len(node))
                root = local_components(len(node), a, b)
                seen = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(node[seen]),
                        pa.array(links[seen].astype(np.int64)),
                        pa.array(node[root[seen]]),
                    ],
                    ["node", "links", "root"],
                )

    found = staged(met.mapInArrow(compare, "node long, links long, root long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    of = (
        points.select("node", "label", "vector", "weight", "least")
        .join(links, "node", "left")
        .join(parts, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    least = of.groupBy("component").agg(F.min("least").alias("component_id"))
    of = of.join(least, "component").select(
        "label",
        "vector",
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        "component_id",
    )
    others = rows.filter(~counts).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        rows.filter(counts)
        .join(of, ["label", "vector"])
        .select("vec_id", "n_links", "component_id")
        .unionByName(others)
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
