"""Fill-in-middle: a document's middle moves to its end, between sentinels, and back.

The text is a bytearray all the time. Two cuts are found by scanning for the bytes that
begin a code point, sentinels are inserted at them, and neighbouring blocks change places
by three reversals: either block, then both as one. The same rotation the other way about
and the removal of the sentinels restore the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, id_type, importable, text_runs

#: Bytes that are scanned or exchanged at a time.
BLOCK = 1 << 16


class Sentinels(NamedTuple):
    """What stands before prefix, suffix and middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def byte_of(text: np.ndarray, k: int, n: int) -> int:
    """Where the ``k``-th of ``n`` code points begins; the end of the text for ``k = n``."""
    if len(text) == n or not k:
        return k
    for at in range(0, len(text), BLOCK):
        begins = (text[at : at + BLOCK] & 0xC0) != 0x80
        found = int(np.count_nonzero(begins))
        if k < found:
            return at + int(np.flatnonzero(begins)[k])
        k -= found
    return len(text)


def reverse(view: np.ndarray, a: int, b: int) -> None:
    """Reverse a stretch in place; of either end a block is held at a time."""
    while b - a > 1:
        n = min(BLOCK, (b - a) // 2)
        left = view[a : a + n].copy()
        view[a : a + n] = view[b - n : b][::-1]
        view[b - n : b] = left[::-1]
        a, b = a + n, b - n


def rotate(view: np.ndarray, a: int, m: int, b: int) -> None:
    """Exchange the neighbouring blocks ``[a, m)`` and ``[m, b)`` in place."""
    reverse(view, a, m)
    reverse(view, m, b)
    reverse(view, a, b)


def moved(text: bytes, form: str, cuts: tuple[int, int], marks: tuple[bytes, bytes, bytes]) -> bytearray:
    """Output for a form; the cuts are places in bytes, the marks those of ``Sentinels``."""
    buffer = bytearray(text)
    if form == "plain":
        return buffer
    p, s, m = marks
    low, high = cuts
    buffer[high:high] = s
    buffer[low:low] = m
    buffer[:0] = p
    middle, suffix = low + len(p), high + len(p) + len(m)
    view = np.frombuffer(buffer, np.uint8)
    rotate(view, middle if form == "psm" else 0, suffix, len(buffer))
    return buffer


def unmoved(output: bytes, form: str, marks: tuple[bytes, bytes, bytes]) -> bytearray:
    """The text that gave an output of that form."""
    buffer = bytearray(output)
    if form == "plain":
        return buffer
    p, s, m = marks
    # A sentinel that the text does not hold cannot arise at a seam, so the first is the one.
    at_p, at_s, at_m = buffer.find(p), buffer.find(s), buffer.find(m)
    start = at_s if form == "psm" else 0
    turn = at_m if form == "psm" else at_p
    suffix = turn - start
    view = np.frombuffer(buffer, np.uint8)
    rotate(view, start, turn, len(buffer))
    del view
    at_s, at_m = len(buffer) - suffix, at_s if form == "psm" else at_m - at_p
    del buffer[at_s : at_s + len(s)]
    del buffer[at_m : at_m + len(m)]
    del buffer[: len(p)]
    return buffer


def draws(seed: int, doc_id: str = "doc_id") -> list[Column]:
    """Four numbers below 2^32 of every id; a null id draws like an empty one."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    digest = F.sha2(key, 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame,
    seed: int = 1,
    moved_percent: int = 90,
    spm_percent: int = 20,
    marks: Sentinels = Sentinels(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every document.

    ``n`` counts code points, and the cuts lie between them. ``form`` is ``psm`` (prefix,
    suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain`` (the text as it is), by
    numbers drawn from seed and id; a text that is empty or holds a sentinel is plain.
    ``prefix_chars`` and ``middle_chars`` are null for plain. One pass without a shuffle.

    A null text is empty. A null id draws like an empty one. Repeated rows give a row each,
    all alike. A text of any length is one buffer and blocks of 64 KB. Other columns of
    ``docs``, whatever their names, are not read. No sentinel may be part of another, nor
    begin with what another ends with.
    """
    source = id_and_text(docs, id_column, text_column)
    h1, h2, h3, h4 = draws(seed)
    a, b = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    held = F.lit(False)
    for mark in marks:
        held = held | F.contains("text", F.lit(mark))
    plain = (F.col("n") == 0) | held | (F.col("h3") % 100 >= moved_percent)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    planned = (
        source.select(
            "doc_id", "text", F.char_length("text").cast("long").alias("n"),
            h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), h4.alias("h4"),
        )
        .withColumn("form", form)
        .withColumn("prefix_chars", F.when(F.col("form") != "plain", F.least(a, b)))
        .withColumn("middle_chars", F.when(F.col("form") != "plain", F.abs(a - b)))
        .select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.col("text").cast("binary"))
    )
    coded = tuple(m.encode() for m in marks)

    def one(text: bytes, n: int, form: str, prefix: int | None, middle: int | None) -> bytes:
        cuts = (0, 0)
        if form != "plain":
            view = np.frombuffer(text, np.uint8)
            cuts = byte_of(view, prefix, n), byte_of(view, prefix + middle, n)
        return bytes(moved(text, form, cuts, coded))

    kind = id_type(source)
    return changed(
        planned, "text", ["n", "form", "prefix_chars", "middle_chars"], one, "output",
        f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string",
    )


def restored(
    rows: DataFrame, marks: Sentinels = Sentinels(), output_column: str = "output"
) -> DataFrame:
    """The rows with the text that gave their ``output``, as ``text`` in its place.

    It is rebuilt from output and ``form`` alone. A null output gives an empty text.
    """
    coded = tuple(m.encode() for m in marks)
    names = [("text" if c == output_column else c, t) for c, t in rows.dtypes]
    ready = rows.withColumn(
        output_column, F.coalesce(F.col(output_column), F.lit("")).cast("binary")
    )
    return changed(
        ready, output_column, ["form"], lambda output, form: bytes(unmoved(output, form, coded)),
        "text", ", ".join(f"`{c}` {t}" for c, t in names),
    )


def changed(
    rows: DataFrame, column: str, others: list[str], function: Callable, name: str, schema: str
) -> DataFrame:
    """The rows with a binary column replaced by a text, made of it and other columns."""
    importable(rows.sparkSession)
    at, names = rows.columns.index(column), [name if c == column else c for c in rows.columns]

    def batchwise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in text_runs(batch.column(at)):
                part = batch.slice(start, stop - start)
                given = [part.column(c).to_pylist() for c in others]
                made = [function(t.as_py(), *g) for t, *g in zip(part.column(at), *given, strict=True)]
                columns = list(part.columns)
                columns[at] = pa.array(made, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(batchwise, schema)
