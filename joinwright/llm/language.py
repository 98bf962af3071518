"""Language of documents and of their spans.

The script of a word narrows its candidate languages; letter trigrams score it under
each; and Viterbi, with a penalty for every switch, labels the words, so that
spans of mixed text get their own languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joinwright.functions.columns import col

from .common import bounded_sample, id_and_text, text_runs, unused, with_struct

#: Buckets of trigrams, and what is added to their counts.
BUCKETS = 1 << 15
SMOOTHING = 0.5
#: Cost of a switch between languages, and what a word can say at most for one of them.
SWITCH = 14.0
MOST = 8.0
#: Trigram weights gathered at a time.
CELLS = 1 << 22
#: Share of a script's letters from which a language counts as written in it.
SCRIPT_SHARE = 0.01
#: Documents to learn from at most.
LEARNED = 20_000
#: First code points of stretches of scripts; a code point is of the last that is not above it.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0900, "indic"), (0x0E00, "thai"),
    (0x0E80, "other"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2E80, "han"), (0x3040, "kana"),
    (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "other"),
    (0x20000, "han"), (0x40000, "other"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})


#: Code points looked up at a time; as Python objects, all at once take 150 MB.
LOOKED_UP = 1 << 12


@lru_cache(maxsize=1)
def letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: lower-case letter (0 if none), whether it is one, its script."""
    low, is_letter = np.zeros(0x110000, np.uint32), np.zeros(0x110000, bool)
    for first in range(0, 0x110000, LOOKED_UP):
        codes = range(first, first + LOOKED_UP)
        own = slice(first, first + LOOKED_UP)
        is_letter[own] = [chr(c).isalpha() for c in codes]
        low[own] = [ord(x) if len(x := chr(c).lower()) == 1 else c for c in codes]
    low[~is_letter] = 0
    starts = [first for first, _ in SCRIPTS]
    of = np.searchsorted(starts, np.arange(0x110000), side="right") - 1
    script = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS], np.uint8)[of]
    return low, is_letter, script


@dataclass
class Words:
    """The words of several texts, one after the other."""

    text: np.ndarray  #: number of the text
    start: np.ndarray  #: first character in the text
    size: np.ndarray  #: letters
    script: np.ndarray
    trigram: np.ndarray  #: bucket for each letter of the words
    first: np.ndarray  #: place of the word's first letter among all letters


def words_of(texts: list[str]) -> Words:
    low_of, is_letter, script_of = letters()
    joined = "\n".join(texts) + "\n"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    letter = is_letter[code]
    low = np.concatenate([[0], low_of[code], [0]]).astype(np.uint32)
    mixed = low[:-2] * np.uint32(0x9E3779B1) + low[1:-1] * np.uint32(0x85EBCA77) + low[2:] * np.uint32(0xC2B2AE3D)
    trigram = ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(17)
    before = np.concatenate([[False], letter[:-1]])
    starts = np.flatnonzero(letter & ~before)
    ends = np.flatnonzero(~letter & before)
    rank = np.cumsum(letter) - 1
    text = np.searchsorted(begins, starts, side="right") - 1
    return Words(text, starts - begins[text], ends - starts, script_of[code[starts]], trigram[letter], rank[starts])


@dataclass
class LanguageModel:
    """Languages in order of name, log-probabilities of trigrams, and who writes which script."""

    languages: list[str]
    weights: np.ndarray  #: buckets x languages
    writes: np.ndarray  #: scripts x languages

    def word_scores(self, words: Words) -> np.ndarray:
        """Words x languages: how far below the best language that writes the word's script.

        A language that does not write it has the lowest score. Letters are added up in blocks, so
        beside the scores the memory has a bounded size, also for a very long word.
        """
        sums = np.zeros((len(words.first), len(self.languages)), np.float32)
        block = max(1, CELLS // max(1, len(self.languages)))
        for a in range(0, len(words.trigram), block):
            b = min(a + block, len(words.trigram))
            low = int(np.searchsorted(words.first, a, side="right")) - 1
            high = int(np.searchsorted(words.first, b, side="left"))
            starts = np.maximum(words.first[low:high] - a, 0)
            sums[low:high] += np.add.reduceat(self.weights[words.trigram[a:b]], starts, axis=0)
        others = ~self.writes[words.script]
        sums[others] = -np.inf
        sums -= sums.max(axis=1, keepdims=True)
        np.maximum(sums, -MOST, out=sums)
        return sums


def learn(
    docs: DataFrame,
    bound: int = LEARNED,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> LanguageModel:
    """Model of the languages of labelled documents; rows without text or language are left out.

    It learns from ``bound`` documents at most, chosen by a hash of the id. Trigrams
    are counted per task and summed in a shuffle; the driver gets one row per language
    and bucket in use.
    """
    labelled = docs.select(
        col(id_column).alias("doc_id"), col(text_column).alias("text"), col(lang_column).alias("lang")
    ).filter("text is not null and lang is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        width = BUCKETS + len(SCRIPT_NAMES)
        for batch in batches:
            for start, stop in text_runs(batch.column("text")):
                part = batch.slice(start, stop - start)
                words = words_of(part.column("text").to_pylist())
                langs = np.array(part.column("lang").to_pylist(), dtype=object)[words.text]
                of_letter = np.repeat(langs, words.size)
                for lang in set(langs.tolist()):
                    own = np.bincount(words.trigram[of_letter == lang], minlength=BUCKETS)
                    scripts = np.bincount(
                        words.script[langs == lang], words.size[langs == lang], len(SCRIPT_NAMES)
                    )
                    total[lang] = total.get(lang, np.zeros(width)) + np.append(own, scripts)
        for lang, counts in total.items():
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(seen)), pa.array(seen), pa.array(counts[seen].astype(np.int64))],
                ["lang", "bucket", "n"],
            )

    counted = (
        bounded_sample(labelled, "doc_id", bound)
        .select("text", "lang")
        .mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # bounded by languages and buckets
    )
    languages = sorted(counted["lang"].unique())
    table = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(languages)))
    table[counted["bucket"], counted["lang"].map(languages.index)] = counted["n"]
    trigrams, scripts = table[:BUCKETS] + SMOOTHING, table[BUCKETS:]
    weights = np.log(trigrams / trigrams.sum(axis=0))
    share = scripts / np.maximum(1, scripts.sum(axis=0))
    writes = share >= SCRIPT_SHARE
    writes[~writes.any(axis=1)] = True  # nobody writes it: the script says nothing
    return LanguageModel(languages, weights.astype(np.float32), writes)


def viterbi(scores: np.ndarray, switch: float) -> np.ndarray:
    """Best language of each word, a switch between neighbours costing ``switch``.

    If no stretch of words gains half a switch by any other language than the best
    single one, the text has no switch and the search is spared.
    """
    total = scores.sum(axis=0)
    best = int(total.argmax())
    gain = np.cumsum(scores - scores[:, best : best + 1], axis=0)
    below = np.minimum.accumulate(np.vstack([np.zeros(gain.shape[1]), gain[:-1]]), axis=0)
    if (gain - below).max() <= switch / 2:
        return np.full(len(scores), best)
    state = [0.0] * scores.shape[1]
    back = []
    for word in scores.tolist():
        top = max(state)
        jump = top - switch
        back.append((state.index(top), [s < jump for s in state]))
        state = [w + (s if s >= jump else jump) for w, s in zip(word, state, strict=True)]
    out, at = np.empty(len(scores), np.int64), state.index(max(state))
    for n in range(len(scores) - 1, -1, -1):
        out[n] = at
        came, jumped = back[n]
        if jumped[at]:
            at = came
    return out


def label_texts(model: LanguageModel, texts: list[str]) -> list[tuple]:
    """``lang_pred, score, spans`` of every text."""
    out: list[tuple] = [("und", 0.0, [])] * len(texts)
    words = words_of(texts)
    if not model.languages or not len(words.text):
        return out
    scores = model.word_scores(words)
    edges = np.searchsorted(words.text, np.arange(len(texts) + 1))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if a == b:
            continue
        path = viterbi(scores[a:b], SWITCH)
        size = words.size[a:b]
        held = np.bincount(path, size, len(model.languages))
        best = int(held.argmax())
        evidence = scores[a:b].sum(axis=0)
        sure = 1 / np.exp(np.minimum(evidence - evidence[best], 50)).sum()
        turns = np.append(np.flatnonzero(np.append(True, path[1:] != path[:-1])), len(path))
        start = words.start[a:b]
        spans = [
            (int(start[i]), int(start[j - 1] + size[j - 1]), model.languages[path[i]])
            for i, j in zip(turns[:-1], turns[1:], strict=True)
        ]
        spans = [dict(zip(("start", "end", "lang"), s, strict=True)) for s in spans]
        share = float(held[best] / held.sum())
        out[k] = (model.languages[best], share * min(1.0, float(sure) if len(turns) == 2 else 1.0), spans)
    return out


SPAN = T.StructType(
    [T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())]
)
LABEL = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]
)


def identify(
    docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` of every document.

    ``lang_pred`` is the language of most letters, ``score`` their share (times the
    posterior of the language where the text is in one); ``spans`` are stretches of
    words with ``start`` and ``end`` in characters. A text that is null or has no letter
    is ``und`` with score 0 and no span, and so is every text if the model has learned no
    language. One pass without a shuffle; repeated rows give a row each.
    """
    source = id_and_text(docs, id_column, text_column)
    labelled = with_struct(source, "text", "label", LABEL, lambda texts: label_texts(model, texts))
    return labelled.select("doc_id", "label.*")


def in_a_language(
    docs: DataFrame,
    model: LanguageModel,
    least: float = 0.4,
    text_column: str = "text",
) -> DataFrame:
    """The rows whose text is in a learned language with at least this score, unchanged.

    A null text, one without letters and every text of a model without languages go; a text of
    any length is one row. Repeated rows are judged alike. An empty table stays empty.
    """
    name = unused(docs, "label")
    labelled = with_struct(docs, text_column, name, LABEL, lambda texts: label_texts(model, texts))
    kept = (F.col(f"{name}.lang_pred") != "und") & (F.col(f"{name}.score") >= least)
    return labelled.filter(kept).drop(name)
