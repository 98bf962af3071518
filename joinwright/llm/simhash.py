"""Near-duplicate documents by SimHash fingerprints.

A positional byte is one of the 8 bytes of a fingerprint with its place. Two
fingerprints that differ in at most 3 bits share at least 5 positional bytes. Of
any 5 places at least 3 lie in the same half, so the inverted index needs one list
for each choice of 3 places of a half and their bytes: within such a list the
shared positional bytes of a pair are tallied, pairs with fewer than 5 go, and the
others are verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joinwright.functions.columns import col

from .common import (
    batch_by_batch, chunk_pairs, flat, group_starts, id_and_text, importable, sorted_groups, staged, unused,
)
from .components import components

#: Bits in which linked fingerprints may differ, and the positional bytes they then share.
DISTANCE = 3
SHARED = 8 - DISTANCE
#: The places of a list's bytes: all triples of either half.
PLACES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
#: Fingerprints of a list that are compared in one group; longer lists are cut into chunks.
LIST_CHUNK = 2048
#: Rows compared with all others at a time.
STRIPE = 256
SEED = 42
#: Shingles whose bits are summed at a time.
SUMMED = 1 << 17


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, repeats included."""
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(size, len(words)) - 1
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    pairs = zip(starts.tolist(), ends[span:].tolist(), strict=False)
    return np.array([digest(view[a:b], SEED) for a, b in pairs], np.uint64)


def fingerprint(text: str, size: int = 3) -> int:
    """Bits that are set in over half of the shingles' hashes, unsigned; zero without words."""
    hashes = shingle_hashes(text, size)
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SUMMED):
        part = hashes[at : at + SUMMED].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big")


def fingerprinted(
    docs: DataFrame, name: str, size: int = 3, text_column: str = "text"
) -> DataFrame:
    """The rows with their fingerprint, a signed long, as column ``name``."""
    importable(docs.sparkSession)
    text = docs.columns.index(text_column)

    def hashed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        values = [fingerprint(t.as_py() or "", size) for t in batch.column(text)]
        fp = pa.array(np.array(values, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([*batch.columns, fp], [*batch.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    return docs.mapInArrow(partial(batch_by_batch, hashed), schema)


def near(fp: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of ``others`` (columns) each of ``fp`` (rows) links with.

    Positional bytes that are shared are tallied, and only pairs with enough of them
    are verified.
    """
    differing = fp[:, None] ^ others[None, :]
    tally = np.zeros(differing.shape, np.uint8)
    places = differing.view(np.uint8).reshape(*differing.shape, 8)
    for place in range(8):
        tally += places[:, :, place] == 0
    linked = tally >= SHARED
    linked[linked] = np.bitwise_count(differing[linked]) <= DISTANCE
    return linked


def spanning_links(fp: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what is connected among different fingerprints, one fewer
    than there are members in each part; every member is compared once with all that
    are not reached yet."""
    out, open_ = [], np.arange(len(fp))
    while len(open_) > 1:
        seed, waiting, open_ = int(open_[0]), open_[:1], open_[1:]
        while len(waiting) and len(open_):
            linked = near(fp[waiting[:STRIPE]], fp[open_]).any(axis=0)
            reached, open_ = open_[linked], open_[~linked]
            out += [(seed, int(r)) for r in reached]
            waiting = np.concatenate([waiting[STRIPE:], reached])
    return out


def linked_in_lists(rows: DataFrame) -> DataFrame:
    """``a, b``: links that connect the fingerprints of every list."""
    keys = ["place", "bytes", "chunk_low", "chunk_high"]

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, keys):
            starts = group_starts(table, keys)
            fp = flat(table["fp"])
            size = np.diff(starts)
            found: list[np.ndarray] = []
            # Lists of two, the most frequent kind, all at once.
            two = starts[:-1][size == 2]
            x, y = fp[two].view(np.uint64), fp[two + 1].view(np.uint64)
            shared = ((x ^ y)[:, None].view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            close = (shared >= SHARED) & (np.bitwise_count(x ^ y) <= DISTANCE)
            found.append(np.stack([fp[two], fp[two + 1]], axis=1)[close])
            for k in np.flatnonzero(size > 2):
                own = fp[starts[k] : starts[k + 1]]
                if pairs := spanning_links(own.view(np.uint64)):
                    found.append(own[np.array(pairs)])
            out = np.concatenate(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[:, 0].copy()), pa.array(out[:, 1].copy())], ["a", "b"]
            )

    return (
        rows.select(*keys, "fp")
        .repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(links, "a long, b long")
        .distinct()
    )


def inverted_index(fps: DataFrame) -> DataFrame:
    """``place, bytes, fp``: each fingerprint in the list of every choice of three places."""
    entries = [
        F.struct(
            F.lit(n).alias("place"),
            sum(
                F.shiftleft(F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)), 8 * k)
                for k, p in enumerate(places)
            )
            .cast("int")
            .alias("bytes"),
        )
        for n, places in enumerate(PLACES)
    ]
    return fps.select("fp", F.inline(F.array(*entries)))


def fingerprint_groups(rows: DataFrame) -> DataFrame:
    """``fp, group`` of every fingerprint; ``group`` is one that stands for its component.

    Copies are one fingerprint from the first step on, so a group of copies of any
    size is one entry of the index. A list of the index that is long, as near copies
    of one text make it, is cut into chunks that meet pairwise, and gives about as many
    links as it has members, not all pairs.
    """
    fps = staged(rows.select("fp").distinct())
    index = inverted_index(fps)
    long_lists = index.groupBy("place", "bytes").count().filter(F.col("count") > LIST_CHUNK)
    dealt = index.join(long_lists, ["place", "bytes"], "left").withColumn(
        "chunks", F.ceil(F.coalesce("count", F.lit(1)) / F.lit(LIST_CHUNK)).cast("int")
    )
    dealt = chunk_pairs(dealt, F.col("chunks"), F.pmod(F.xxhash64("fp"), F.col("chunks")))
    found = components(linked_in_lists(dealt))
    return staged(
        fps.join(found, F.col("fp") == F.col("node"), "left").select(
            "fp", F.coalesce("component", "fp").alias("group")
        )
    )


def near_duplicates(
    docs: DataFrame, size: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, fp, component_id`` of every row.

    Fingerprints of at most 3 differing bits are linked; ``component_id`` is the
    smallest id in the component (null only if all its ids are). A null text has no
    words, hence the fingerprint zero, which links like any other. Repeated rows
    share a fingerprint. Other columns of ``docs``, whatever their names, are not read.
    """
    source = id_and_text(docs, id_column, text_column)
    rows = staged(fingerprinted(source, "fp", size).select("doc_id", "fp"))
    groups = fingerprint_groups(rows)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least")).join(groups, "fp")
    smallest = least.groupBy("group").agg(F.min("least").alias("component_id"))
    by_fp = groups.join(smallest, "group").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def first_of_groups(
    docs: DataFrame, size: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row of each near-duplicate group, with the columns of ``docs``.

    It is that of the smallest id, null last; of rows that share id and fingerprint, which are
    copies, any stays.  A null text has the fingerprint zero, and so has one without words.  A text
    of any length is hashed in slices.  Nothing comes of an empty table.
    """
    fp, row, kept_row = unused(docs, "fp"), unused(docs, "row"), unused(docs, "kept_row")
    rows = fingerprinted(docs, fp, size, text_column)
    rows = staged(rows.withColumn(row, F.monotonically_increasing_id()))
    ids = rows.select(col(id_column).alias("doc_id"), col(fp).alias("fp"), col(row).alias("row"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    per_fp = ids.groupBy("fp").agg(first.alias("first")).join(fingerprint_groups(ids), "fp")
    kept = per_fp.groupBy("group").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.row").alias(kept_row))
    return rows.join(kept, col(row) == col(kept_row), "left_semi").drop(fp, row)


def hex_fingerprints(found: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` with 16 lowercase hex digits."""
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
