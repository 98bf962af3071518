"""Severity of toxicity by cumulative-link ordinal regression on sparse text features.

One weight per feature serves all thresholds: the probability of at most grade k is
the logistic function of (threshold k - weighted sum). The features are words, and
beginnings of words, that labelled toxic documents use more than chance explains.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from joinwright.functions.columns import col

from .common import bounded_sample, id_and_text, staged, text_runs, unused, with_struct

WORD = re.compile(r"[^\W\d_]+")
#: Letters of a beginning; it counts as a feature of longer words.
BEGINNING = 5
#: Labelled documents to learn from at most, and features at most.
LEARNED = 20_000
FEATURES = 4096
#: Least log-likelihood ratio of a feature, and documents it is in.
RATIO = 25.0
SEEN = 4
#: Grades above 0: toxic documents in equal parts by how much of the features they hold.
GRADES = 3
RIDGE = 1e-5
#: Probability of any grade above 0 from which a document counts as toxic.
TOXIC = 0.2
STEPS = 400


def features_of(text: str) -> Counter:
    """Words and beginnings (with a star) and how often they occur."""
    found = Counter(WORD.findall(text.lower()))
    for word, n in list(found.items()):
        if len(word) > BEGINNING:
            found[word[:BEGINNING] + "*"] += n
    return found


@dataclass
class OrdinalModel:
    """Weights that all thresholds share, and the ascending thresholds."""

    place: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def sparse(self, text: str) -> dict[int, float]:
        """Features in use and the logarithm of 1 + their number."""
        place, out = self.place, {}
        for word, n in Counter(WORD.findall(text.lower())).items():
            if (k := place.get(word)) is not None:
                out[k] = out.get(k, 0) + n
            if len(word) > BEGINNING and (k := place.get(word[:BEGINNING] + "*")) is not None:
                out[k] = out.get(k, 0) + n
        return {k: float(np.log1p(n)) for k, n in out.items()}

    def above(self, text: str) -> np.ndarray:
        """Probability of a grade above 0, above 1 and so on."""
        total = sum(self.weights[k] * x for k, x in self.sparse(text).items())
        return 1 / (1 + np.exp(np.clip(self.thresholds - total, -50, 50)))


def fit_ordinal(
    rows: np.ndarray, features: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of least penalised loss, by gradient steps of adaptive size.

    ``rows, features, values`` are the non-zero entries; thresholds are kept in order
    as a first one and positive differences.
    """
    n, n_thresholds = len(grades), int(grades.max(initial=0))
    if not n_thresholds:
        return np.zeros(n_features), np.full(1, 50.0)
    share = np.array([(grades <= k).mean() for k in range(n_thresholds)])
    start = np.log(np.clip(share, 1e-3, 1 - 1e-3) / np.clip(1 - share, 1e-3, 1))
    parameters = np.zeros(n_features + n_thresholds)
    parameters[n_features] = start[0]
    parameters[n_features + 1 :] = np.log(np.maximum(np.diff(start), 1e-2))
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, STEPS + 1):
        weights, free = parameters[:n_features], parameters[n_features:]
        gaps = np.exp(free[1:])
        thresholds = free[0] + np.concatenate([[0], np.cumsum(gaps)])
        total = np.bincount(rows, values * weights[features], n)
        upper = np.where(grades < n_thresholds, thresholds[np.minimum(grades, n_thresholds - 1)], np.inf)
        lower = np.where(grades > 0, thresholds[np.maximum(grades - 1, 0)], -np.inf)
        at_upper = 1 / (1 + np.exp(np.clip(total - upper, -50, 50)))
        at_lower = 1 / (1 + np.exp(np.clip(total - lower, -50, 50)))
        at_upper[np.isinf(upper)], at_lower[np.isinf(lower)] = 1.0, 0.0
        likely = np.maximum(at_upper - at_lower, 1e-12)
        to_upper, to_lower = at_upper * (1 - at_upper) / likely, at_lower * (1 - at_lower) / likely
        by_total = to_upper - to_lower  # of the loss
        gradient = np.zeros_like(parameters)
        gradient[:n_features] = np.bincount(features, values * by_total[rows], n_features) / n
        gradient[:n_features] += RIDGE * weights
        by_threshold = np.zeros(n_thresholds)
        has = grades < n_thresholds
        by_threshold -= np.bincount(grades[has], to_upper[has], n_thresholds)
        has = grades > 0
        by_threshold += np.bincount(grades[has] - 1, to_lower[has], n_thresholds)
        later = np.cumsum(by_threshold[::-1])[::-1] / n
        gradient[n_features] = later[0]
        gradient[n_features + 1 :] = later[1:] * gaps
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        rate = 0.1 if step < STEPS * 3 // 4 else 0.02
        parameters -= rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    free = parameters[n_features:]
    return parameters[:n_features], free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    bound: int = LEARNED,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> OrdinalModel:
    """Model from documents with a 0/1 label ``toxic``.

    It learns from about ``bound`` labelled documents at most, chosen by a hash of the id,
    one row of each. Grade 0 are the documents that are not toxic; the others are divided into equal
    parts by the sum of their features' values. Counts of features are
    summed per task, then in a shuffle; the driver gets the features chosen
    and the non-zero entries of the sample. Null labels and ids count as no label.
    Without toxic documents among the labelled, nothing is toxic.
    """
    known = labels.select(col(id_column).alias("label_id"), col(label_column).cast("int").alias("toxic"))
    known = known.filter("toxic is not null").groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    # The sample of ids is bounded, so it may be broadcast; texts are not shuffled for it.
    chosen_ids = F.broadcast(bounded_sample(known, "label_id", bound))
    source = id_and_text(docs, id_column, text_column)
    labelled = staged(
        source.join(chosen_ids, F.col("doc_id") == F.col("label_id"))
        .dropDuplicates(["doc_id"])
        .select("text", (F.col("toxic") > 0).alias("toxic"))
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in text_runs(batch.column("text")):
                part = batch.slice(start, stop - start)
                toxic, clean = Counter(), Counter()
                for text, bad in zip(*(part.column(c).to_pylist() for c in ("text", "toxic")), strict=True):
                    (toxic if bad else clean).update(features_of(text).keys())
                names = list(toxic.keys() | clean.keys())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.string()),
                        pa.array([toxic[w] for w in names], pa.int64()),
                        pa.array([clean[w] for w in names], pa.int64()),
                    ],
                    ["feature", "bad", "good"],
                )

    sizes = labelled.agg(F.count_if("toxic"), F.count_if(~F.col("toxic"))).first()
    n_bad, n_good = map(float, sizes)
    counts = (
        labelled.mapInArrow(count, "feature string, bad long, good long")
        .groupBy("feature")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .filter((F.col("bad") >= SEEN) & (F.col("bad") * n_good > F.col("good") * n_bad))
    )
    x_log_x = lambda x: F.when(x > 0, x * F.log(x)).otherwise(0.0)
    cells = [F.col("bad"), F.col("good"), n_bad - F.col("bad"), n_good - F.col("good")]
    seen = F.col("bad") + F.col("good")
    everything = n_bad + n_good
    ratio = 2 * (
        sum(map(x_log_x, cells)) - x_log_x(seen) - x_log_x(everything - seen)
        + F.lit(everything * np.log(max(everything, 1)) - sum(n * np.log(max(n, 1)) for n in (n_bad, n_good)))
    )
    chosen = counts.withColumn("ratio", ratio).filter(F.col("ratio") >= RATIO)
    names = [r[0] for r in chosen.orderBy(F.desc("ratio"), "feature").limit(FEATURES).collect()]
    model = OrdinalModel({w: k for k, w in enumerate(names)}, np.zeros(len(names)), np.zeros(1))

    def entries(texts: list[str]) -> list[tuple]:
        out = []
        for text in texts:
            found = model.sparse(text)
            out.append((list(found.keys()), list(found.values()), sum(found.values())))
        return out

    kind = T.StructType(
        [
            T.StructField("places", T.ArrayType(T.IntegerType())),
            T.StructField("values", T.ArrayType(T.DoubleType())),
            T.StructField("much", T.DoubleType()),
        ]
    )
    sample = with_struct(labelled, "text", "x", kind, entries).select("toxic", "x.*").toPandas()
    bad = sample["toxic"].to_numpy(bool)
    grades = np.zeros(len(sample), np.int64)
    if bad.any():
        cuts = np.quantile(sample["much"][bad], np.arange(1, GRADES) / GRADES)
        grades[bad] = 1 + np.searchsorted(cuts, sample["much"][bad], side="left")
        grades = np.searchsorted(np.unique(grades), grades) + (0 if (~bad).any() else 1)
    n_entries = sample["places"].map(len).to_numpy(np.int64)
    joined = [np.concatenate([np.zeros(0), *map(np.asarray, sample[c])]) for c in ("places", "values")]
    weights, thresholds = fit_ordinal(
        np.repeat(np.arange(len(sample)), n_entries), joined[0].astype(np.int64), joined[1], grades, len(names)
    )
    return OrdinalModel(model.place, weights, thresholds)


SEVERITY = T.StructType(
    [
        T.StructField("severity", T.DoubleType()),
        T.StructField("grade", T.IntegerType()),
        T.StructField("toxic", T.BooleanType()),
    ]
)


def grade_texts(model: OrdinalModel, texts: list[str]) -> list[tuple]:
    out = []
    for text in texts:
        above = model.above(text)
        out.append((float(above.sum()), int((above >= TOXIC).sum()), bool(above[0] >= TOXIC)))
    return out


def severity(
    docs: DataFrame, model: OrdinalModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, severity, grade, toxic`` of every document.

    ``severity`` is the expected grade, ``grade`` the highest that is reached with
    a probability of TOXIC or more, ``toxic`` whether that is above 0. A null or empty text has
    no features and is judged by the thresholds alone. One pass without a shuffle.
    """
    source = id_and_text(docs, id_column, text_column)
    graded = with_struct(source, "text", "graded", SEVERITY, lambda texts: grade_texts(model, texts))
    return graded.select("doc_id", "graded.*")


def not_toxic(docs: DataFrame, model: OrdinalModel, text_column: str = "text") -> DataFrame:
    """The rows that are not toxic, unchanged.

    Null and empty texts have no features and stay. A text of any length is one row; repeated
    rows are judged alike. An empty table stays empty.
    """
    name = unused(docs, "graded")
    graded = with_struct(docs, text_column, name, SEVERITY, lambda texts: grade_texts(model, texts))
    return graded.filter(~F.col(f"{name}.toxic")).drop(name)
