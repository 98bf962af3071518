"""Exact top-k search by MaxScore over sharded postings of integer weights.

A dimension is a term. For a query, the postings of a term that can raise a score
are those of the query weight's sign; their largest product bounds what the term
adds. The terms of the smallest bounds that together stay below the score to beat are
non-essential: a candidate has to be found through the others, and is probed in
them only while it can still reach that score. The score to beat is that of the query's
k-th best row so far; it rises from block to block of a shard, and from shard to shard of
a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from joinwright.functions.columns import col

from .centroids import big_integers
from .common import flat, staged
from .vectors import finite, matrix, packed

#: Rows of a shard of the index, shards that a task holds at a time, queries of a block.
SHARD = 4096
SHARDS = 8
QUERY_BLOCK = 512
#: Rows that are scored first where there is no score to beat yet, and the most between two
#: looks at it.
FIRST, MOST_ROWS = 256, 4096
#: Non-essential terms probed at a time.
PROBED = 16
#: Up to so large a weight and so many terms, sums are exact in floats; others are Python's
#: integers.
HEAVIEST, MOST_TERMS = 1 << 20, 1 << 12
#: Scores of more digits than a decimal has count as its ends.
DIGITS = 38
LONGEST = (1 << 63) - 1


def weighed(vectors: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """``floor(scale * x)`` as floats, zero in rows that are not exact so, and which these are."""
    with np.errstate(over="ignore"):
        whole = np.floor(scale * vectors)
        large = ~(np.abs(whole) <= HEAVIEST).all(axis=1) | (vectors.shape[1] > MOST_TERMS)
        return np.where(large[:, None], 0.0, whole), large


class Shard:
    """Postings of a shard: for each term the weights of all its rows, and their range.

    Rows with a weight too large for floats are kept apart, as integers.
    """

    def __init__(self, vectors: np.ndarray, scale: int = 1):
        weights, large = weighed(vectors, scale)
        self.scale, self.vectors, self.multiplied = scale, vectors, 0
        self.n, terms = weights.shape
        heaviest = float(np.abs(weights).max(initial=0))
        # Sums of products of such integers are exact in the type chosen.
        self.type = np.float32 if heaviest**2 * terms < 1 << 24 else np.float64
        self.large = np.flatnonzero(large)
        self.small = np.flatnonzero(~large)
        self.postings = np.ascontiguousarray(weights[self.small].T, dtype=self.type)
        self.top = self.postings.max(axis=1, initial=0).astype(np.float64)
        self.bottom = self.postings.min(axis=1, initial=0).astype(np.float64)

    def search(
        self, query: np.ndarray, k: int, own: int, beat: float = -np.inf
    ) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of all that may be among the best ``k``, but for row ``own``.

        ``query`` is a vector like those of the shard. Only scores from ``beat`` on are found.
        """
        weights, large = weighed(query[None, :], self.scale)
        if large[0]:
            rows = np.arange(self.n)
            return self._exact(query, rows[rows != own], beat)
        rows, scores = self._pruned(weights[0], k, own, beat)
        if len(self.large):
            more, exact = self._exact(query, self.large[self.large != own], beat)
            rows, scores = np.concatenate([rows, more]), np.concatenate([scores.astype(object), exact])
        return rows, scores

    def _exact(self, query: np.ndarray, rows: np.ndarray, beat: float):
        """Scores in Python's integers, of any size."""
        width = min(len(query), self.vectors.shape[1])
        theirs = big_integers(self.vectors[rows, :width], self.scale)
        own = big_integers(query[None, :width], self.scale)[0]
        scores = np.array([sum(map(int.__mul__, t, own)) for t in theirs.tolist()], object)
        kept = np.array([s >= beat for s in scores], bool)
        self.multiplied += len(rows) * width
        return rows[kept], scores[kept]

    def _pruned(self, query: np.ndarray, k: int, own: int, beat: float):
        width = min(len(query), len(self.postings))
        query, postings = query[:width], self.postings[:width]
        kind = np.float64 if np.abs(query).max(initial=0) ** 2 * width >= 1 << 24 else self.type
        weights = query.astype(kind)
        bound = np.where(query > 0, query * self.top[:width], query * self.bottom[:width])
        order = np.argsort(-bound, kind="stable")
        rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0.0)  # bound of terms from here on
        found, scores = [np.zeros(0, np.int64)], [np.zeros(0)]
        best = np.zeros(0)
        start = 0
        while start < len(self.small):
            size = MOST_ROWS if np.isfinite(beat) else FIRST
            rows = np.arange(start, min(start + size, len(self.small)))
            start += size
            rows = rows[self.small[rows] != own]
            # Essential: all terms up to where the rest alone cannot reach the score.
            n = int(np.searchsorted(-rest, -beat, side="right")) if np.isfinite(beat) else width
            n = min(n, width)
            terms = order[:n]
            held = postings[terms][:, rows]
            if beat > 0:
                # What no essential posting of the right sign holds adds up to less.
                some = ((held * np.sign(weights[terms])[:, None]) > 0).any(axis=0)
                rows, held = rows[some], held[:, some]
            partial = weights[terms] @ held
            self.multiplied += held.size
            while True:
                still = partial + rest[n] >= beat
                rows, partial = rows[still], partial[still]
                if n >= width or not len(rows):
                    break
                terms = order[n : n + PROBED]
                partial = partial + weights[terms] @ postings[np.ix_(terms, rows)]
                self.multiplied += len(terms) * len(rows)
                n = min(width, n + PROBED)
            found.append(rows)
            scores.append(partial.astype(np.float64))
            best = np.concatenate([best, partial])
            if len(best) >= k:
                best = np.partition(best, -k)[-k:]
                beat = max(beat, float(best[0]))
        rows, all_scores = np.concatenate(found), np.concatenate(scores)
        kept = all_scores >= beat
        return self.small[rows[kept]], all_scores[kept].astype(np.int64)


class Group:
    """Some shards with their rows' numbers and ids, searched one after the other."""

    def __init__(self, scale: int):
        self.scale = scale
        self.shards: list[tuple[Shard, np.ndarray, pa.Array, dict[int, int]]] = []

    def add(self, rows: pa.StructArray) -> None:
        numbers = flat(rows.field("row"))
        place = {int(r): n for n, r in enumerate(numbers)}
        shard = Shard(matrix(rows.field("vector")), self.scale)
        self.shards.append((shard, numbers, rows.field("vec_id"), place))

    def search(self, query: np.ndarray, row: int, k: int) -> list[tuple[int, int, int]]:
        """Shard, place in it and score of all that may be among the best ``k``."""
        found: list[tuple[int, int, int]] = []
        beat: float = -np.inf
        for s, (shard, _, _, place) in enumerate(self.shards):
            rows, scores = shard.search(query, k, place.get(row, -1), beat)
            found += [(s, r, x) for r, x in zip(rows.tolist(), scores.tolist(), strict=True)]
            if len(found) >= k:
                # No float above the k-th best: rounding down keeps every tie.
                beat = float_below(sorted((x for _, _, x in found), reverse=True)[k - 1])
                found = [f for f in found if f[2] >= beat]
        return found


def float_below(x: int) -> float:
    """The largest float that is not above an integer."""
    try:
        near = float(x)
    except OverflowError:
        return -np.inf if x < 0 else float(np.finfo(np.float64).max)
    return near if near <= x else float(np.nextafter(near, -np.inf))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the best ``k`` rows for each query row.

    A weight is ``floor(scale * component)``, the score the inner product of weights,
    a component that one vector lacks counting as zero. A query's own row is no
    candidate; another row of its id is one. Equal scores go by smaller id, null last,
    then by the order in which the rows were read. Vectors that are null or hold null,
    NaN or infinite components are neither queries nor candidates. An empty table, or one
    without queries, gives no rows.

    Weights of any size are exact. A score that no long holds is given as the nearest
    long; it is ranked by its value up to 38 digits, beyond which scores are equal.

    Every block of queries meets every group of shards, so nothing is missed; groups and
    blocks have bounded size whatever the ids are. A group gives ``k`` rows and ties for a query,
    and the groups' rows are merged per query.
    """
    source = vectors.select(
        col(id_column).alias("vec_id"),
        col(vector_column).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    rows = staged(
        source.filter(finite("vector"))
        .withColumn("row", F.monotonically_increasing_id())
    )
    counted = rows.agg(F.count("*"), F.count_if("is_query")).first()
    n_shards, n_blocks = max(1, -(-counted[0] // SHARD)), max(1, -(-counted[1] // QUERY_BLOCK))
    # Few shards are spread over all cores; what is found does not depend on it.
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    n_groups = max(-(-n_shards // SHARDS), min(n_shards, cores))
    in_shard = F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("int").alias("shard")
    in_block = F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int").alias("block")
    held = ["row", "vec_id", "vector"]
    shards = packed(rows.select(in_shard, *held), ["shard"], held).select(
        (F.col("shard") % n_groups).alias("group"), F.lit(False).alias("asks"), "rows"
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("group")
    blocks = packed(rows.filter("is_query").select(in_block, *held), ["block"], held).select(
        every, F.lit(True).alias("asks"), "rows"
    )
    met = (
        shards.union(blocks.select("group", "asks", "rows"))
        .repartition(n_groups, "group")
        .sortWithinPartitions("group", "asks")
    )
    kind = rows.schema["vec_id"].dataType
    schema = T.StructType(
        [
            T.StructField("query_row", T.LongType()),
            T.StructField("query_id", kind),
            T.StructField("vec_id", kind),
            T.StructField("row", T.LongType()),
            T.StructField("score", T.DecimalType(DIGITS, 0)),
        ]
    )
    arrow = pa.schema(list(to_arrow_type(schema)))
    last = 10**DIGITS - 1

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, index = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column("rows").slice(i, 1).flatten()
                if at != (group := batch.column("group")[i].as_py()):
                    at, index = group, Group(scale)
                if not batch.column("asks")[i].as_py():
                    index.add(own)
                    continue
                numbers, queries = flat(own.field("row")), matrix(own.field("vector"))
                out: list[list] = [[], [], [], [], []]
                for n, query in enumerate(queries):
                    for s, place, score in index.search(query, int(numbers[n]), k):
                        _, theirs, ids, _ = index.shards[s]
                        found = (numbers[n], own.field("vec_id")[n], ids[place], theirs[place])
                        for column, value in zip(out, (*found, max(-last, min(last, score))), strict=True):
                            column.append(value)
                columns = [
                    pa.array([v.as_py() if isinstance(v, pa.Scalar) else v for v in c], f.type)
                    for c, f in zip(out, arrow, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    found = met.mapInArrow(search, schema)
    best = Window.partitionBy("query_row").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row")
    )
    score = F.greatest(F.least("score", F.lit(LONGEST)), F.lit(-LONGEST - 1)).cast("long")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", score.alias("score"))
    )
