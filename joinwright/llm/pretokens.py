"""Where a tokenizer's pretokens begin, for many texts at once.

Pretokenizers cut between classes of characters: letters, numbers, other signs, white space.
Which class a character has is asked of the library, once per character; the cuts then
follow from arrays of classes. A pretoken's tokens do not depend on what is around it, so
the different pretokens of many texts are all that has to be merged or encoded.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import flat, text_runs

LETTER, NUMBER, SIGN, SPACE, UNKNOWN = range(5)
#: Bytes of text that are cut at a time.
SLICE_BYTES = 4 << 20
#: Fixed value: endings that are cut off after an apostrophe with which a pretoken begins.
ENDINGS = [b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"]
LONE_SPACE = re.compile(r"(?<=[^\W_]) (?=[^\W_])")


class Pretokens:
    """Cuts of a pretokenizer of one of two kinds.

    Byte-level ones keep a space with what follows it, and runs of white space and of numbers
    whole; those of words drop white space and cut numbers into digits.
    """

    def __init__(self, pre_tokenizer, words: bool):
        self.ask, self.words = pre_tokenizer.pre_tokenize_str, words
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)

    def class_of(self, character: str) -> int:
        """The class, from what the library leaves together."""

        def together(text: str) -> bool:
            return [span for _, span in self.ask(text)] == [(0, len(text))]

        if together("a" + character):
            return LETTER
        if together("!" + character):
            return SIGN
        return NUMBER if together(character if self.words else "1" + character) else SPACE

    def classes_of(self, codes: np.ndarray) -> np.ndarray:
        found = self.classes[codes]
        if (found == UNKNOWN).any():
            for code in np.unique(codes[found == UNKNOWN]).tolist():
                self.classes[code] = self.class_of(chr(code))
            found = self.classes[codes]
        return found

    def begins(self, codes: np.ndarray, kind: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Whether a pretoken begins at each character; ``first`` are places where texts do."""
        space = kind == SPACE
        out = np.ones(len(codes), bool)
        np.not_equal(kind[1:], kind[:-1], out=out[1:])
        at_first = np.zeros(len(codes) + 1, bool)
        at_first[first] = True
        if self.words:
            out |= kind == NUMBER
        else:
            plain = codes == 32
            out[1:] &= ~(plain[:-1] & ~space[1:])
            # The last white space before a sign parts from the others, as it may go with the sign.
            last = np.flatnonzero(space[:-1] & ~space[1:])
            out[last[~at_first[last + 1]]] = True
        out |= at_first[:-1]
        quotes = np.flatnonzero((codes == 39) & out)
        if len(quotes):
            self._cut_endings(codes, at_first, out, quotes)
        return out

    def _cut_endings(self, codes, at_first, out, quotes) -> None:
        last = len(codes) - 1
        for ending in ENDINGS:
            fits = quotes + len(ending) <= last
            for n, letter in enumerate(ending, start=1):
                at = np.minimum(quotes + n, last)
                fits &= (codes[at] == letter) & ~at_first[at]
            at = quotes[fits]
            for n in range(1, len(ending) + 1):
                out[at + n] = False
            after = at + len(ending) + 1
            out[after[after < len(out)]] = True

    def cut(self, texts: pa.StringArray) -> tuple[np.ndarray, pa.DictionaryArray]:
        """The pretokens of the texts as bytes, one after the other, and where each text's begin.

        The places have the number of pretokens as their last.
        """
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = (data or pa.py_buffer(b"")).slice(int(at[0]), int(at[-1] - at[0]))
        at = at - at[0]
        codes = np.frombuffer(data, np.uint8)
        if not len(codes):
            return np.zeros(len(texts) + 1, np.int64), pa.array([], pa.binary()).dictionary_encode()
        if codes.max() < 128:
            first, byte = at, None
        else:
            codes = np.frombuffer(data.to_pybytes().decode().encode("utf-32-le"), "<u4")
            width = np.ones(len(codes), np.uint8)
            for above in (0x7F, 0x7FF, 0xFFFF):
                width += codes > above
            byte = np.zeros(len(codes), np.int32)
            np.cumsum(width[:-1], dtype=np.int32, out=byte[1:])
            first = np.searchsorted(byte, at)
            first[at == len(data)] = len(codes)
        kind = self.classes_of(codes)
        places, codes = np.flatnonzero(self.begins(codes, kind, first)), None
        bounds = np.append(places if byte is None else byte[places], len(data)).astype(np.int32)
        byte = None
        cut = pa.Array.from_buffers(pa.binary(), len(places), [None, pa.py_buffer(bounds), data])
        if self.words:
            kept = kind[places] != SPACE
            cut, places = cut.filter(pa.array(kept)), places[kept]
        return np.searchsorted(places, first), cut.dictionary_encode()


def parts(texts: pa.StringArray) -> Iterator[tuple[np.ndarray, pa.StringArray, bool]]:
    """Runs of texts of about SLICE_BYTES, the number of each text, and whether more of it follows.

    A longer text comes in several parts, cut before a space between two letters or digits, where
    a pretoken begins whatever is around it.
    """
    for start, stop in text_runs(texts, SLICE_BYTES):
        run = texts.slice(start, stop - start)
        if stop - start > 1 or pc.binary_length(run)[0].as_py() <= SLICE_BYTES:
            yield np.arange(start, stop), run, False
            continue
        text, at = run[0].as_py(), 0
        while at < len(text):
            found = LONE_SPACE.search(text, at + SLICE_BYTES)
            end = found.start() if found else len(text)
            yield np.array([start]), pa.array([text[at:end]]), end < len(text)
            at = end


#: Bytes of a remembered pretoken besides its text, and the longest text that is remembered.
OVERHEAD, LONGEST = 250, 200


class Remembered:
    """A value for each pretoken, worked out once.

    Two generations whose keys and values have a bounded number of bytes, besides those of one
    call: when the young one is full it becomes the old one, and what is found there moves back,
    so frequent ones stay.
    """

    def __init__(self, work: Callable[[list[bytes]], list], most: int):
        self.work, self.most, self.size = work, most, 0
        self.young: dict[bytes, object] = {}
        self.old: dict[bytes, object] = {}

    def values(self, keys: list[bytes]) -> list:
        out = list(map(self.young.get, keys))
        missing = [i for i, v in enumerate(out) if v is None]
        if not missing:
            return out
        own = [keys[i] for i in missing]
        known = list(map(self.old.get, own))
        made = iter(self.work([k for k, v in zip(own, known) if v is None]))
        known = [next(made) if v is None else v for v in known]
        for i, value in zip(missing, known):
            out[i] = value
        new = {k: v for k, v in zip(own, known) if len(k) <= LONGEST}
        size = sum(map(len, new)) * 2 + OVERHEAD * len(new)
        if self.size + size > self.most:
            self.old, self.young, self.size = self.young, {}, 0
        self.young.update(new)
        self.size += size
        return out


def gathered(
    values: list[bytes], kind: np.dtype, numbers: np.ndarray, places: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The items of the values in the order of ``numbers``, and how many each text has."""
    size = np.fromiter(map(len, values), np.int64, len(values)) // kind.itemsize
    items = np.frombuffer(b"".join(values), kind)
    begin = np.cumsum(size) - size
    taken = size[numbers]
    end = np.cumsum(taken)
    place = np.repeat(begin[numbers] - (end - taken), taken)
    place += np.arange(len(place))
    upto = np.append(0, end)
    return items[place], np.diff(upto[places])


def sums(values: list[int], numbers: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Sum of each text's values."""
    upto = np.append(0, np.cumsum(np.asarray(values, np.int64)[numbers]))
    return np.diff(upto[places])


def numbers_of(cut: pa.DictionaryArray) -> np.ndarray:
    return flat(cut.indices).astype(np.int64)
