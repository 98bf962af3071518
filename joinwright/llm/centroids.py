"""Centroid clustering of integer vectors by equal-average equal-variance search.

Centroids are sorted by component mean. From where a vector's own mean would stand, the
search goes outward to both sides: by the mean alone, no centroid farther out can be nearer
than ``(difference of sums)^2 / width``, and with the deviations no centroid nearer than that
plus ``(difference of deviations)^2``. What neither rejects is measured in integers.
The bounds are floats with room for their rounding; every decision is an integer one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joinwright.functions.columns import col

from .common import id_type, importable, staged
from .vectors import finite, matrix

#: Components below it have exact 64-bit distances up to this many components; others are
#: Python's integers.
SMALL, SMALL_WIDTH = 1 << 26, 1 << 9
#: Part of a bound that its rounding may take up.
ROUNDING = 1e-9
#: Vectors searched side by side.
ROWS = 4096
#: Groups in which the tasks' sums of a cluster are added first.
SUM_GROUPS = 64
LONGEST = (1 << 63) - 1


def integers(x: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """``floor(scale * x)``, as 64-bit numbers where they are small, and which rows are not."""
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.floor(scale * x)
        large = ~(np.abs(whole) < SMALL).all(axis=1) | (x.shape[1] > SMALL_WIDTH)
        return np.where(large[:, None], 0, whole).astype(np.int64), large


def big_integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as Python's integers; a float from 2^52 on is whole itself."""
    whole = [
        [int(v) * scale if abs(v) >= 1 << 52 else int(np.floor(scale * v)) for v in row]
        for row in x.tolist()
    ]
    out = np.empty(x.shape, object)
    out[...] = whole
    return out


def floats(x: np.ndarray) -> np.ndarray:
    """Numbers as floats; what no float holds is infinite, so no bound is built on it."""
    if x.dtype != object:
        return x.astype(np.float64)
    values = [float(v) if abs(v) < 1 << 1023 else float("inf") for v in x.ravel().tolist()]
    return np.array(values, np.float64).reshape(x.shape)


def mean_and_deviation(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and root of summed squared differences from it, of every row, as floats."""
    with np.errstate(over="ignore", invalid="ignore"):
        values = floats(x)
        mean = values.mean(axis=1)
        away = values - mean[:, None]
        return mean, np.sqrt((away * away).sum(axis=1))


class Sorted:
    """Some of the centroids in the order of their means."""

    def __init__(self, components: np.ndarray, numbers: np.ndarray):
        mean, deviation = mean_and_deviation(components)
        order = np.argsort(mean, kind="stable")
        self.components, self.numbers = components[order], numbers[order]
        self.mean, self.deviation = mean[order], deviation[order]

    def search(self, x: np.ndarray, best: np.ndarray, number: np.ndarray) -> int:
        """Better ``best`` distances and ``number``s of the vectors; the distances measured.

        A smaller number wins among equal distances.
        """
        if not len(self.numbers) or not len(x):
            return 0
        width, measured, last = x.shape[1], 0, len(self.numbers) - 1
        mean, deviation = mean_and_deviation(x)
        right = np.searchsorted(self.mean, mean)
        left = right - 1
        open_ = np.arange(len(x))
        with np.errstate(over="ignore", invalid="ignore"):
            while len(open_):
                open_ = open_[(left[open_] >= 0) | (right[open_] <= last)]
                lo, hi, own_mean = left[open_], right[open_], mean[open_]
                down = own_mean - self.mean[np.maximum(lo, 0)]
                up = self.mean[np.minimum(hi, last)] - own_mean
                lower = (hi > last) | (lo >= 0) & (down <= up)
                at = np.where(lower, lo, hi)
                left[open_[lower]] -= 1
                right[open_[~lower]] += 1
                # Room for rounding: a part of the magnitudes, and then of the bound.
                means = np.abs(own_mean) + np.abs(self.mean[at])
                apart = np.maximum(0, np.where(lower, down, up) - ROUNDING * means)
                by_mean = width * apart * apart * (1 - ROUNDING)
                least = floats(best[open_]) * (1 + ROUNDING)
                ended = by_mean > least
                own, other = deviation[open_], self.deviation[at]
                spread = np.abs(own - other) - ROUNDING * (own + other + width * means)
                spread = np.maximum(0, spread)
                by_both = by_mean + spread * spread * (1 - ROUNDING)
                tried = ~(by_both > least)
                rows, found = open_[tried], at[tried]
                measured += len(rows)
                away = x[rows].astype(self.components.dtype) - self.components[found]
                distance = (away * away).sum(axis=1)
                numbers = self.numbers[found]
                better = (distance < best[rows]) | (
                    (distance == best[rows]) & (numbers < number[rows])
                )
                best[rows[better]], number[rows[better]] = distance[better], numbers[better]
                open_ = open_[~ended]
        return measured


class Centroids:
    """All centroids, told apart by whether their distances fit 64 bits."""

    def __init__(self, components: list[list[int]]):
        whole = np.empty((len(components), len(components[0])), object)
        whole[...] = components
        numbers = np.arange(len(components))
        large = np.array([max(map(abs, c)) >= SMALL or len(c) > SMALL_WIDTH for c in components])
        self.small = Sorted(whole[~large].astype(np.int64), numbers[~large])
        self.large = Sorted(whole[large], numbers[large])
        self.every = Sorted(whole, numbers)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Distance and number of each vector's nearest centroid, and the distances measured."""
        number = np.full(len(x), LONGEST)
        if x.dtype == object:
            best = np.full(len(x), float("inf"), object)
            return best, number, self.every.search(x, best, number)
        any_large = len(self.large.numbers) > 0
        best = np.full(len(x), float("inf") if any_large else LONGEST, object if any_large else np.int64)
        measured = self.small.search(x, best, number)
        return best, number, measured + self.large.search(x, best, number)


def assigned(
    batches: Iterator[pa.RecordBatch], held: Centroids, scale: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows with their vectors, distances and centroids' numbers."""
    for whole in batches:
        for start in range(0, whole.num_rows, ROWS):
            batch = whole.slice(start, ROWS)
            floats = matrix(batch.column("vector"))
            x, large = integers(floats, scale)
            for rows in (~large, large):
                if rows.any():
                    part = batch.filter(pa.array(rows))
                    own = big_integers(floats[rows], scale) if rows is large else x[rows]
                    distance, number, _ = held.nearest(own)
                    yield part, own, distance, number


def moved_centroids(rows: DataFrame, centroids: list[list[int]], scale: int) -> list[list[int]]:
    """Means of what is nearest to each centroid, rounded down; one without any stays.

    Tasks add up their own vectors; their sums, one row for a task and cluster, are added in
    two steps, and one row for a cluster reaches the driver.
    """
    held, k = Centroids(centroids), len(centroids)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for _, x, _, number in assigned(batches, held, scale):
            order = np.argsort(number, kind="stable")
            found, starts = np.unique(number[order], return_index=True)
            sums = np.add.reduceat(x[order], starts, axis=0).astype(object)
            counts = np.diff(np.append(starts, len(order)))
            for c, s, n in zip(found.tolist(), sums, counts.tolist(), strict=True):
                if c in totals:
                    totals[c][0] += n
                    totals[c][1] = totals[c][1] + s
                else:
                    totals[c] = [n, s]
        group = TaskContext.get().partitionId() % SUM_GROUPS
        yield as_rows([(c, group, n, s) for c, (n, s) in totals.items()])

    def added(table: pa.Table) -> pa.Table:
        rows_ = table.to_pylist()
        sums = [sum(int(r["sums"][i]) for r in rows_) for i in range(len(rows_[0]["sums"]))]
        first = rows_[0]
        return pa.Table.from_batches(
            [as_rows([(first["cluster"], first["part"], sum(r["n"] for r in rows_), sums)])]
        )

    schema = "cluster long, part long, n long, sums array<string>"
    partial = rows.mapInArrow(summed, schema)
    partial = partial.groupBy("cluster", "part").applyInArrow(added, schema)
    totals = partial.groupBy("cluster").applyInArrow(added, schema).collect()
    out = [list(c) for c in centroids]
    for t in totals:  # at most k rows
        out[t.cluster] = [int(s) // t.n for s in t.sums]
    assert len(totals) <= k
    return out


def as_rows(rows: list[tuple]) -> pa.RecordBatch:
    """Sums of clusters; the integers, which may be longer than a long, as text."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.int64()),
            pa.array([[str(s) for s in r[3]] for r in rows], pa.list_(pa.string())),
        ],
        ["cluster", "part", "n", "sums"],
    )


def first_centroids(rows: DataFrame, k: int, seed: int, scale: int) -> list[list[int]]:
    """The vectors of the smallest hashes of their ids; equal hashes go by the vector."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = rows.select("vector", F.sha2(key, 256).alias("hash")).orderBy("hash", "vector").limit(k)
    return [big_integers(np.array([r.vector], np.float64), scale)[0].tolist() for r in chosen.collect()]


def cluster_vectors(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    width: int = 64,
    scale: int = 256,
    seed: int = 2,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` per vector.

    Vectors of ``width`` components, all finite, are kept; a component counts as
    ``floor(scale * component)``. The first centroids are the vectors of the ``k`` smallest
    hashes of seed and id (all, if there are fewer). Each round assigns every vector to the
    nearest centroid, ties to the smaller number, and moves each centroid to the floor of its
    vectors' mean; a last assignment follows. Distances are squared, ``centroid_sha256`` is
    that of the components in decimal, joined by commas.

    Components of any finite size are exact. A distance or a sum of distances that no long
    holds is null. Null vectors, and those that hold a null or a non-finite component or have
    another width, give no row. A null id draws like an empty one. Repeated rows give a row
    each; if their hash is among the smallest, each is a centroid, and the smaller number gets
    their vectors. Without a kept vector there are no rows. Other columns are not read.

    Every round reads the written vectors once; a task holds the centroids and a batch, and
    what is shuffled is one row of sums per task and cluster.
    """
    importable(vectors.sparkSession)
    source = vectors.select(col(id_column).alias("vec_id"), col(vector_column).alias("vector"))
    rows = staged(source.filter(finite("vector") & (F.size("vector") == width)))
    kind = id_type(rows, "vec_id")
    centroids = first_centroids(rows, k, seed, scale)
    if not centroids:
        return vectors.sparkSession.createDataFrame(
            [],
            f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long,"
            " centroid_sha256 string",
        )
    for _ in range(rounds):
        centroids = moved_centroids(rows, centroids, scale)
    held = Centroids(centroids)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, distance, number in assigned(batches, held, scale):
            long = [d if d <= LONGEST else None for d in distance.tolist()]
            columns = [part.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(long, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    found = staged(rows.mapInArrow(placed, f"vec_id {kind}, cluster int, distance long"))
    whole = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = found.groupBy("cluster").agg(
        F.when(F.count_if(F.col("distance").isNull()) == 0, whole).alias("sum")
    )
    by_cluster = {r["cluster"]: r["sum"] for r in sums.collect()}  # at most k rows
    total = None if None in by_cluster.values() else sum(by_cluster.values())
    fits = lambda s: None if s is None or s > LONGEST else int(s)
    facts = [
        (c, fits(s), fits(total), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for c, s in by_cluster.items()
    ]
    facts = vectors.sparkSession.createDataFrame(
        facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
