"""Token ids as files of Huffman-coded blocks, and their way back.

A file set is a folder with two Parquet tables:

* ``codes``: the length of each id's code (canonical, so the lengths say all);
* ``blocks``: rows of whole documents in ascending order, each with its bits, the
  bit offset of every CHECKPOINT-th id, and the directory of its documents.

Every block is read on its own, and inside a block all stretches between
checkpoints are decoded side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encoder
from .common import (
    batch_by_batch,
    flat,
    id_and_text,
    id_type,
    importable,
    in_small_batches,
    spread,
    staged,
)

#: Longest code in bits; the decoding table has 2 to that power of entries.
LONGEST = 20
#: Ids between two checkpoints.
CHECKPOINT = 64
#: Ids after which a block is closed, at the end of a document.
BLOCK_IDS = 1 << 16
#: Ids of a task that writes blocks.
TASK_IDS = 4_000_000


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of the best prefix code of which no code is longer than ``longest``.

    Package-merge: in each round the list of symbols is merged with pairs of the
    list before, and what the last list takes is traced back through the rounds.
    """
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << longest:
        raise ValueError(f"{n} ids have no codes of {longest} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    rounds, values = [], leaves
    for _ in range(longest):
        is_leaf = np.arange(len(values)) < n if values is leaves else merged_leaf
        rounds.append(is_leaf)
        pairs = values[: len(values) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        place = np.argsort(both, kind="stable")
        values, merged_leaf = both[place], place < n
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(rounds):
        own = int(is_leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


def canonical(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the ids by (length, id), and the code of each id so ordered."""
    order = np.lexsort((ids, lengths))
    size = lengths[order]
    width = int(size[-1]) if len(size) else 0
    steps = np.left_shift(1, width - size)
    first = np.cumsum(steps) - steps
    return order, first >> (width - size)


class Codec:
    """Encoder and decoder of one code."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order, codes = canonical(ids, lengths)
        ids, lengths = ids[order], lengths[order]
        self.width = int(lengths.max(initial=1))
        top = int(ids.max(initial=0)) + 1
        self.code, self.size = np.zeros(top, np.uint64), np.zeros(top, np.int64)
        self.code[ids], self.size[ids] = codes, lengths
        # Entry of the table: the id whose code these bits begin with, and its length.
        repeat = np.left_shift(1, self.width - lengths)
        self.id_at = np.zeros(1 << self.width, np.uint32)
        self.size_at = np.ones(1 << self.width, np.uint8)
        self.id_at[: repeat.sum()] = np.repeat(ids, repeat)
        self.size_at[: repeat.sum()] = np.repeat(lengths, repeat)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bits of the ids and the bit offsets of the checkpoints."""
        size = self.size[ids]
        end = np.cumsum(size)
        start = end - size
        word, used = start >> 5, start & 31
        shifted = self.code[ids] << (64 - used - size).astype(np.uint64)
        n_words = (int(end[-1]) >> 5) + 2 if len(ids) else 2
        # The bits do not overlap, so sums below 2**32 are unions.
        words = np.bincount(word, (shifted >> np.uint64(32)).astype(float), n_words)
        words += np.bincount(word + 1, (shifted & np.uint64(0xFFFFFFFF)).astype(float), n_words)
        return words.astype(">u4").tobytes(), start[::CHECKPOINT]

    def decode(self, bits: bytes, offsets: np.ndarray, n: int) -> np.ndarray:
        """All ``n`` ids; every checkpoint is the start of a lane."""
        windows = np.ndarray((len(bits) - 3,), ">u4", bits, strides=(1,))
        out = np.zeros((len(offsets), CHECKPOINT), np.uint32)
        at = offsets.astype(np.int64)
        left = np.minimum(n - np.arange(len(offsets)) * CHECKPOINT, CHECKPOINT)
        shift, mask = 32 - self.width, (1 << self.width) - 1
        for k in range(int(left.max(initial=0))):
            if k >= left[-1]:
                at = at[left > k]  # only the last lane can be shorter
                left = left[left > k]
            window = windows[at >> 3].astype(np.int64) << (at & 7)
            entry = (window >> shift) & mask if self.width <= 25 else None
            out[: len(at), k] = self.id_at[entry]
            at = at + self.size_at[entry]
        return out.reshape(-1)[:n]


def tokenised(
    docs: DataFrame, tokenizer_file: str, words: bool, end_id: int, id_column: str, text_column: str
) -> DataFrame:
    """``doc_id, ids`` (little-endian unsigned 32-bit, with the end id), written once."""
    source = id_and_text(docs, id_column, text_column)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(tokenizer_file, words)
        kind = pieces.type if end_id < 1 << 8 * pieces.type.itemsize else np.dtype("<u4")

        def coded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            at = 0
            for ids, counts in pieces.encode(batch.column("text")):
                whole, ends = with_ends(ids, counts, end_id, kind)
                bounds = np.append(0, ends * kind.itemsize).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(counts)),
                        pa.array(counts + 1, pa.int64()),
                        pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(bounds), pa.py_buffer(whole)]),
                    ],
                    ["doc_id", "n_ids", "ids"],
                )
                at += len(counts)

        return batch_by_batch(coded, batches)

    coded = source.mapInArrow(encode, f"doc_id {id_type(source)}, n_ids long, ids binary")
    return staged(coded.withColumn("row", F.monotonically_increasing_id()))


def with_ends(
    ids: np.ndarray, counts: np.ndarray, end_id: int, kind: np.dtype
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of several documents with an end id after each, and where each ends then."""
    ends = np.cumsum(counts + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, end_id, kind)
    own = np.ones(len(out), bool)
    own[ends - 1] = False
    out[own] = ids
    return out, ends


def ids_of(values: pa.BinaryArray, n: int) -> np.ndarray:
    """The ``n`` ids of all rows, one after the other; they are of one width."""
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int32)[values.offset : values.offset + len(values) + 1]
    own = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if len(values) else np.zeros(0, np.uint8)
    return own.view(np.dtype("<u2") if len(own) == 2 * n else np.dtype("<u4"))


def listed(values: pa.Array) -> pa.ListArray:
    """All values as the list of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def write_ids(
    docs: DataFrame,
    folder: str,
    tokenizer_file: str,
    words: bool = True,
    end_id: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encode every text, append ``end_id``, and write the file set in ascending id order.

    The code lengths come from the counts of all ids, which are summed per task
    before they are shuffled; what the driver gets is bounded by the vocabulary.
    Texts are encoded once. A null text is empty: its document is the end id alone.
    Null ids come first; rows of equal id follow the order in which they were read,
    and however many there are, they are dealt to tasks like others.
    Unless the session bounds the bytes of batches, they are bounded from here on.
    """
    spark = docs.sparkSession
    in_small_batches(spark)
    rows = tokenised(docs, tokenizer_file, words, end_id, id_column, text_column)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            n = int(flat(batch.column("n_ids")).sum())
            own = np.bincount(ids_of(batch.column("ids"), n))
            if len(own) > len(total):
                total, own = own, total
            total[: len(own)] += own
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    counted = (
        rows.select("n_ids", "ids")
        .mapInArrow(count, "id long, n long")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # at most one row per id of the vocabulary
        .sort_values("id")
    )
    ids, counts = counted["id"].to_numpy(np.int64), counted["n"].to_numpy(np.int64)
    lengths = code_lengths(counts)
    codes = pa.table({"id": ids, "length": lengths}).to_pandas()
    spark.createDataFrame(codes, "id long, length long").coalesce(1).write.parquet(f"{folder}/codes")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part = Codec(ids, lengths), TaskContext.get().partitionId()
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size = before = number = 0

        def closed() -> pa.RecordBatch:
            doc_ids, lengths_of, own = zip(*held)
            bits, offsets = codec.encode(np.concatenate(own))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([before], pa.int64()),
                    pa.array([size], pa.int64()),
                    pa.array([bits], pa.binary()),
                    listed(pa.array(offsets, pa.int64())),
                    listed(pa.concat_arrays(doc_ids)),
                    listed(pa.array(np.concatenate(lengths_of), pa.int64())),
                ],
                names,
            )

        for batch in batches:
            sizes = flat(batch.column("n_ids"))
            upto = np.append(0, np.cumsum(sizes, dtype=np.int64))
            ids_of_batch = ids_of(batch.column("ids"), int(upto[-1]))
            row = 0
            while row < len(sizes):
                # The block ends with the document that fills it, if one of this batch does.
                full = int(np.searchsorted(upto[1:], upto[row] + BLOCK_IDS - size))
                stop = min(full + 1, len(sizes))
                # Copies, as what is held must not keep its batch.
                doc_ids = pa.concat_arrays([batch.column("doc_id").slice(row, stop - row)])
                held.append((doc_ids, sizes[row:stop].copy(), ids_of_batch[upto[row] : upto[stop]].copy()))
                size += int(upto[stop] - upto[row])
                if size >= BLOCK_IDS:
                    yield closed()
                    held, before, size, number = [], before + size, 0, number + 1
                row = stop
        if held:
            yield closed()

    names = "part number before n_ids bits checkpoints doc_ids lengths".split()
    schema = (
        "part int, number int, before long, n_ids long, bits binary, checkpoints array<long>,"
        f" doc_ids array<{id_type(rows)}>, lengths array<long>"
    )
    (
        rows.repartitionByRange(spread(spark, int(counts.sum()), TASK_IDS), "doc_id", "row")
        .sortWithinPartitions("doc_id", "row")
        .select("doc_id", "n_ids", "ids")
        .mapInArrow(blocks, schema)
        .write.parquet(f"{folder}/blocks")
    )


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document of a file set.

    ``start`` counts the ids of all documents before it; ``ids`` are the bytes of
    little-endian unsigned 32-bit integers. The blocks are not shuffled: the driver
    gets the number of ids in each file, and so the ids before it. Unless the session
    bounds the bytes of batches, they are bounded from here on.
    """
    importable(spark)
    in_small_batches(spark)
    codes = spark.read.parquet(f"{folder}/codes").toPandas()  # bounded by the vocabulary
    ids, lengths = codes["id"].to_numpy(np.int64), codes["length"].to_numpy(np.int64)
    blocks = spark.read.parquet(f"{folder}/blocks")
    sizes = dict(blocks.groupBy("part").agg(F.sum("n_ids")).collect())  # one row per file
    base, before = {}, 0
    for part in sorted(sizes):
        base[part] = before
        before += sizes[part]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ids, lengths)

        def decoded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            columns = dict(zip(batch.schema.names, batch.columns))
            for row in range(batch.num_rows):
                part, before, n_ids = (columns[c][row].as_py() for c in ("part", "before", "n_ids"))
                checkpoints = flat(columns["checkpoints"][row].values)
                all_ids = codec.decode(columns["bits"][row].as_buffer(), checkpoints, n_ids)
                size = flat(columns["lengths"][row].values)
                end = np.cumsum(size)
                bounds = np.append(0, end * 4).astype(np.int32)
                whole = pa.py_buffer(np.ascontiguousarray(all_ids, "<u4"))
                yield pa.RecordBatch.from_arrays(
                    [
                        columns["doc_ids"][row].values,
                        pa.array(base[part] + before + end - size),
                        pa.array(size),
                        pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(bounds), whole]),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

        return batch_by_batch(decoded, batches)

    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return blocks.select(
        "part", "before", "n_ids", "bits", "checkpoints", "doc_ids", "lengths"
    ).mapInArrow(decode, f"doc_id {kind}, start long, n_tokens long, ids binary")


def crc32(df: DataFrame, column: str = "ids") -> DataFrame:
    """The frame with ``ids_crc32`` in place of the bytes."""
    return df.withColumn("ids_crc32", F.crc32(F.col(column))).drop(column)
