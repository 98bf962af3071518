"""Token counts by byte-pair merging, and ids of texts through their different pretokens."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import flat, id_and_text, id_type
from .pretokens import Pretokens, Remembered, gathered, numbers_of, parts, sums

#: Bytes of either generation of a worker's remembered pretokens.
KEPT_BYTES = 32 << 20
#: What lower case is not told for here: all from U+0250 on, and the dotted capital I.
NOT_LATIN_RE2 = "[^\x00-\u012f\u0131-\u024f]"


def without(texts: pa.StringArray, special: list[str]) -> tuple[np.ndarray, pa.StringArray]:
    """Which texts hold a special string, and all texts, those as empty ones."""
    held = np.zeros(len(texts), bool)
    for string in special:
        held |= flat(pc.match_substring(texts, string))
    return held, pc.if_else(pa.array(held), "", texts) if held.any() else texts


def merged_length(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> int:
    """Symbols left when no adjacent pair can be merged any more.

    The pairs wait in a heap by rank, then place; the symbols are a linked list.
    """
    n = count = len(symbols)
    ids, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [
        (found[0], i) for i in range(n - 1) if (found := ranks.get((ids[i], ids[i + 1])))
    ]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        found = ranks.get((ids[i], ids[j])) if j < n else None
        if found is None or found[0] != rank:
            continue  # one of the two has been merged meanwhile
        ids[i], ids[j] = found[1], -1
        k = after[i] = after[j]
        count -= 1
        if k < n:
            before[k] = i
            if pair := ranks.get((ids[i], ids[k])):
                heapq.heappush(heap, (pair[0], i))
        if (h := before[i]) >= 0 and (pair := ranks.get((ids[h], ids[i]))):
            heapq.heappush(heap, (pair[0], h))
    return count


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in printable}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(printable)))
    return [letters[b] for b in range(256)]


#: Byte-level characters of the bytes 0 to 255, as a table for ``str.translate``.
LETTERS = dict(enumerate(byte_letters()))


class MergeCounter:
    """Number of tokens of texts under a byte-level BPE vocabulary file."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary = spec["model"]["vocab"]
        pairs = (p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"])
        self.ranks = {
            (vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b])
            for rank, (a, b) in enumerate(pairs)
        }
        self.byte_id = [vocabulary[LETTERS[b]] for b in range(256)]
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.pretokens = Pretokens(Tokenizer.from_file(file).pre_tokenizer, False)
        self.merged = Remembered(self._merge, KEPT_BYTES)

    def _merge(self, pretokens: list[bytes]) -> list[int]:
        id_of, ranks = self.byte_id.__getitem__, self.ranks
        return [merged_length(list(map(id_of, p)), ranks) for p in pretokens]

    def plain_counts(self, texts: pa.StringArray) -> np.ndarray:
        """Tokens of texts without special strings."""
        out = np.zeros(len(texts), np.int64)
        for owners, run, _ in parts(texts):
            places, cut = self.pretokens.cut(run)
            value = self.merged.values(cut.dictionary.to_pylist())
            np.add.at(out, owners, sums(value, numbers_of(cut), places))
        return out

    def counts(self, texts: pa.StringArray) -> np.ndarray:
        """A special string is one token; what lies between is merged."""
        held, plain = without(texts, self.special)
        out = self.plain_counts(plain)
        for i in np.flatnonzero(held).tolist():
            pieces, n = [texts[i].as_py()], 0
            for string in self.special:
                split = [p.split(string) for p in pieces]
                n += sum(len(p) - 1 for p in split)
                pieces = [q for p in split for q in p]
            out[i] = n + int(self.plain_counts(pa.array(pieces)).sum())
        return out


@lru_cache(maxsize=2)
def counter(file: str) -> MergeCounter:
    return MergeCounter(file)


def token_counts(
    docs: DataFrame,
    tokenizer_file: str,
    limit: int = 1024,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document.

    The count is the number of bytes less the number of merges: no id is made.
    ``tokenizer_file`` is a byte-level BPE file of the tokenizers library, whose
    special strings count as one token each wherever they stand. One pass without a
    shuffle; of a worker's memory it takes the vocabulary, a bounded number of
    remembered pieces and a batch of texts.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows give a row each. A
    null id stays null. Other columns of ``docs``, whatever their names, are not read.
    """
    source = id_and_text(docs, id_column, text_column)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(tokenizer_file).counts
        for batch in batches:
            texts = batch.column("text")
            n_bytes = pc.cast(pc.binary_length(texts), pa.int64())
            n_tokens = pa.array(counts(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), n_bytes, n_tokens, pc.greater(n_tokens, limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = f"doc_id {id_type(source)}, n_bytes long, n_tokens long, over_limit boolean"
    return source.mapInArrow(counted, schema)


class PieceEncoder:
    """Ids of texts by the tokenizers library, each different pretoken encoded once.

    ``words``: the tokenizer is one of lower-case words, which drops all white space.
    """

    def __init__(self, file: str, words: bool):
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.normalizer = self.tokenizer.model, self.tokenizer.normalizer
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.type = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = words
        self.pretokens = Pretokens(self.tokenizer.pre_tokenizer, words)
        self.coded = Remembered(self._ids, KEPT_BYTES)

    def _ids(self, pretokens: list[bytes]) -> list[bytes]:
        """Ids of each pretoken by the library's model."""
        letters = b"".join(pretokens).decode("latin-1").translate(LETTERS)
        ends = list(accumulate(map(len, pretokens)))
        tokenize, size = self.model.tokenize, self.type.itemsize
        ids, to, at = [], [], 0
        for end in ends:
            ids += [t.id for t in tokenize(letters[at:end])]
            to.append(len(ids) * size)
            at = end
        whole = np.array(ids, self.type).tobytes()
        return [whole[a:b] for a, b in zip([0, *to], to)]

    def normalized(self, texts: pa.StringArray) -> pa.StringArray:
        """Texts as the pretokenizer gets them, but for the kind of white space."""
        if not self.words:
            return texts
        other = pc.match_substring_regex(texts, NOT_LATIN_RE2)
        lower = pc.utf8_lower(texts)
        if not pc.any(other).as_py():
            return lower
        normal = self.normalizer.normalize_str
        own = [normal(t) if o else p for t, o, p in zip(texts.to_pylist(), flat(other), lower.to_pylist(), strict=True)]
        return pa.array(own, pa.string())

    def encode(self, texts: pa.StringArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of texts, their ids one after the other and the number of each."""
        held, plain = without(texts, self.special)
        before: list[np.ndarray] = []  # ids of the parts so far of a long text
        for owners, run, more in parts(plain):
            places, cut = self.pretokens.cut(self.normalized(run))
            value = self.coded.values(cut.dictionary.to_pylist())
            ids, counts = gathered(value, self.type, numbers_of(cut), places)
            if before or more:
                before.append(ids)
                if more:
                    continue
                ids, before = np.concatenate(before), []
                counts = np.array([len(ids)])
            if held[owners].any():
                ids, counts = self._with_special(texts, owners, held, ids, counts)
            yield ids, counts

    def _with_special(self, texts, owners, held, ids, counts) -> tuple[np.ndarray, np.ndarray]:
        """Texts with special strings are encoded whole by the library."""
        own = np.split(ids, np.cumsum(counts)[:-1])
        for n, i in enumerate(owners.tolist()):
            if held[i]:
                whole = self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids
                own[n] = np.array(whole, self.type)
        return np.concatenate(own), np.array([len(o) for o in own])


@lru_cache(maxsize=2)
def encoder(file: str, words: bool) -> PieceEncoder:
    return PieceEncoder(file, words)
