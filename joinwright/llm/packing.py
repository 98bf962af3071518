"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

The unit of heredity is a sequence with all it holds. Pieces are dealt to chunks of
bounded size; each chunk has several islands with a population of packings each,
and between epochs every island gets the best packing of its neighbour. Sequences
that stay less than full are opened again and dealt to fewer chunks.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoder
from .common import batch_by_batch, id_and_text, id_type, spread, staged
from .idfiles import with_ends

#: Pieces of a chunk, islands of a chunk, epochs between which elites migrate.
CHUNK = 2000
ISLANDS = 3
EPOCHS = 3
#: Packings of an island, and children per epoch.
POPULATION = 6
CHILDREN = 16
#: Rounds of dealing, and the unused share from which a sequence is opened again.
ROUNDS = 3
SLACK = 0.01

#: Sequences as pairs of load and items.
Bins = list[tuple[int, list[int]]]


def best_fit(lengths: list[int], items: list[int], bins: Bins, capacity: int) -> None:
    """Put each item, longest first, into the sequence that it fills most."""
    room = sorted((capacity - load, n) for n, (load, _) in enumerate(bins) if load < capacity)
    for i in items:
        need = lengths[i]
        at = bisect_left(room, (need,))
        if at < len(room):
            left, n = room.pop(at)
            load, held = bins[n]
            held.append(i)
            bins[n] = (load + need, held)
        else:
            left, n = capacity, len(bins)
            bins.append((need, [i]))
        if left > need:
            insort(room, (left - need, n))


def fitness(bins: Bins, capacity: int) -> float:
    """Fewer sequences first; among equals, those of uneven load, which leave more room."""
    squares = sum((load / capacity) ** 2 for load, _ in bins)
    return -len(bins) + squares / (len(bins) + 1)


def crossover(lengths: list[int], one: Bins, two: Bins, capacity: int, rng: random.Random) -> Bins:
    """Whole well-filled sequences of ``two`` enter ``one``.

    Sequences of ``one`` that share a document with them are taken apart, and what
    is then without a place, with the worst-filled sequences, is put in by best fit.
    """
    full = sorted(two, key=lambda b: -b[0])
    start = rng.randrange(max(1, len(full) // 2))
    entering = full[start : start + rng.randint(1, max(1, len(full) // 4))]
    there = {i for _, held in entering for i in held}
    child, loose = [(load, list(held)) for load, held in entering], []
    for load, held in one:
        if there.isdisjoint(held):
            child.append((load, list(held)))
        else:
            loose += [i for i in held if i not in there]
    child.sort(key=lambda b: -b[0])
    for _ in range(rng.randint(1, 3)):
        if len(child) > 1:
            loose += child.pop()[1]
    loose.sort(key=lambda i: -lengths[i])
    best_fit(lengths, loose, child, capacity)
    return child


def grouped(lengths: list[int], places: list[int]) -> Bins:
    held: list[list[int]] = [[] for _ in range(max(places, default=-1) + 1)]
    for i, n in enumerate(places):
        held[n].append(i)
    return [(sum(lengths[i] for i in h), h) for h in held]


def placed(bins: Bins, n: int) -> list[int]:
    places = [0] * n
    for k, (_, held) in enumerate(bins):
        for i in held:
            places[i] = k
    return places


def evolve(
    lengths: list[int],
    population: list[list[int]] | None,
    elite: list[int] | None,
    capacity: int,
    seed: str,
) -> list[list[int]]:
    """Packings of an island after an epoch, best first.

    It ends at once when the best packing has as few sequences as its tokens need.
    """
    rng, n = random.Random(seed), len(lengths)
    if population is None:
        longest = sorted(range(n), key=lambda i: -lengths[i])
        packings: list[Bins] = []
        for k in range(POPULATION):
            order = longest
            if k:  # nearly by length, in another order each time
                noise = [lengths[i] * rng.uniform(0.8, 1.2) for i in range(n)]
                order = sorted(range(n), key=lambda i: -noise[i])
            packings.append([])
            best_fit(lengths, order, packings[-1], capacity)
            if not k and len(packings[0]) * capacity - sum(lengths) < capacity:
                break
    else:
        packings = [grouped(lengths, p) for p in population]
        if elite is not None:
            packings.append(grouped(lengths, elite))
    scored = sorted(
        ((fitness(b, capacity), k, b) for k, b in enumerate(packings)), reverse=True
    )[:POPULATION]
    fewest = -(-sum(lengths) // capacity)
    for k in range(CHILDREN):
        if len(scored[0][2]) <= fewest or len(scored) < 2:
            break
        one = min(rng.sample(range(len(scored)), 2))
        two = rng.choice([p for p in range(len(scored)) if p != one])
        child = crossover(lengths, scored[one][2], scored[two][2], capacity, rng)
        score = fitness(child, capacity)
        if score > scored[-1][0] and all(score != s for s, *_ in scored):
            scored[-1] = (score, POPULATION + k, child)
            scored.sort(reverse=True)
    return [placed(b, n) for _, _, b in scored]


def pieces(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and a number ``row``, written once.

    A document of more than ``capacity`` ids is cut; its first piece takes what the
    others, which are full, leave.
    """
    source = id_and_text(docs, id_column, text_column)

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        coder, at = encoder(tokenizer_file, False), 0
        for ids, counts in coder.encode(batch.column("text")):
            whole, ends = with_ends(ids, counts, end_id, np.dtype("<u4"))
            size = counts + 1
            pieces_ = -(-size // capacity)
            of = np.repeat(np.arange(len(size)), pieces_)
            piece = np.arange(len(of)) - np.repeat(np.cumsum(pieces_) - pieces_, pieces_)
            first = size - (pieces_ - 1) * capacity
            start = np.where(piece > 0, first[of] + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, first[of])
            place = 4 * ((ends - size)[of] + start)
            view = memoryview(whole).cast("B")
            crcs = [zlib.crc32(view[a:b]) for a, b in zip(place.tolist(), (place + 4 * length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(at + of)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )
            at += len(counts)

    schema = f"doc_id {id_type(source)}, piece int, start long, length long, ids_crc32 long"
    made = source.mapInArrow(partial(batch_by_batch, cut), schema)
    return staged(made.withColumn("row", F.monotonically_increasing_id()))


def evolved(state: DataFrame, capacity: int, epoch: int, tasks: int) -> DataFrame:
    """The islands after an epoch; ``elite`` is what the neighbour has sent, or null."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                row["population"] = evolve(
                    row["lengths"],
                    row["population"],
                    row.pop("elite"),
                    capacity,
                    f"{row['chunk']}/{row['island']}/{epoch}",
                )
                yield pa.RecordBatch.from_pylist([row], schema)

    schema = pa.schema(
        [
            ("chunk", pa.int64()),
            ("island", pa.int32()),
            ("lengths", pa.list_(pa.int64())),
            ("population", pa.list_(pa.list_(pa.int32()))),
        ]
    )
    return staged(
        state.repartition(tasks, "chunk", "island")
        .select("chunk", "island", "lengths", "population", "elite")
        .mapInArrow(
            step, "chunk long, island int, lengths array<long>, population array<array<int>>"
        )
    )


def packed_chunks(items: DataFrame, n_chunks: int, capacity: int) -> DataFrame:
    """``row, length, chunk, bin``: the best packing of every chunk of items."""
    spark = items.sparkSession
    tasks = spread(spark, n_chunks * ISLANDS, 8)
    chunks = staged(
        items.groupBy(F.pmod(F.xxhash64("row"), F.lit(n_chunks)).alias("chunk"))
        .agg(F.sort_array(F.collect_list(F.struct("row", "length"))).alias("items"))
        .select("chunk", "items")
    )
    state = chunks.select(
        "chunk",
        F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        F.col("items.length").alias("lengths"),
        F.lit(None).cast("array<array<int>>").alias("population"),
        F.lit(None).cast("array<int>").alias("elite"),
    )
    for epoch in range(EPOCHS):
        if epoch:
            sent = state.select(
                "chunk",
                ((F.col("island") + 1) % ISLANDS).cast("int").alias("island"),
                F.col("population")[0].alias("elite"),
            )
            state = state.join(sent, ["chunk", "island"])
        state = evolved(state, capacity, epoch, tasks)
    best = state.groupBy("chunk").agg(
        F.min_by(F.col("population")[0], F.array_max(F.col("population")[0])).alias("places")
    )
    return chunks.join(best, "chunk").select(
        "chunk", F.inline(F.arrays_zip("items", F.col("places").alias("bin")))
    ).select("items.row", "items.length", "chunk", "bin")


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. Pieces
    lie in a sequence one after the other from 0. A full piece is a sequence of its
    own. A null text is empty and gives one piece, the end id. Repeated rows are
    packed as often as they occur; an empty table gives no rows.

    Chunks have bounded size whatever the ids or lengths are, as they are dealt by a
    number of the written piece. Every epoch is written to the shared folder.
    """
    cut = pieces(docs, tokenizer_file, capacity, end_id, id_column, text_column)
    items = cut.filter(F.col("length") < capacity).select("row", "length")
    whole = cut.filter(F.col("length") >= capacity).select(
        "row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    found, n_items = [whole], items.count()
    for turn in range(ROUNDS):
        if not n_items:
            break
        n_chunks = -(-n_items // CHUNK)
        in_bin = Window.partitionBy("chunk", "bin")
        loads = staged(packed_chunks(items, n_chunks, capacity)).select(
            "row",
            "length",
            F.sum("length").over(in_bin).alias("load"),
            F.expr(f"{turn}L * 281474976710656L + chunk * 65536L + bin").alias("sequence_id"),
            (
                F.sum("length").over(in_bin.orderBy("row").rowsBetween(Window.unboundedPreceding, 0))
                - F.col("length")
            ).alias("offset"),
        )
        last = n_chunks == 1 or turn == ROUNDS - 1
        closed = F.lit(True) if last else F.col("load") >= (1 - SLACK) * capacity
        loads = staged(loads.withColumn("closed", closed))
        found.append(loads.filter("closed").select("row", "sequence_id", "offset"))
        if last:
            break
        items = loads.filter("not closed").select("row", "length")
        n_items = items.count()
    places = found[0]
    for more in found[1:]:
        places = places.unionByName(more)
    return cut.join(places, "row").drop("row")
