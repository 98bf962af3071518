"""Filter of URLs: rules by host and path, and boosted trees for the rest.

The URLs that a rule decides are the labelled ones; the trees learn from their
lexical features and judge the URLs that no rule fits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joinwright.functions.columns import col

from .common import bounded_sample, id_type, importable, staged

#: Rows to learn from at most.
LEARNED = 50_000
#: Trees, levels of a tree, step, bins of a feature, rows of a leaf, penalty of leaf values.
TREES, LEVELS, RATE, BINS, LEAST, PENALTY = 40, 4, 0.2, 32, 5, 1.0
#: Labels of the host suffixes that have statistics, and what these are smoothed with.
SUFFIX_LABELS, PRIOR = (1, 2, 3), 5.0
#: Parts of the labelled rows; a row's statistics come from the other parts.
FOLDS = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, and the beginning of the path."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: str) -> tuple[Column, Column]:
    """What follows the first ``://``, up to ``/``, ``?``, ``#`` or the end, and the path after
    it; both empty without ``://``."""
    at = F.locate("://", col(url))
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)"))
    authority = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    host = F.coalesce(F.translate(authority, UPPER, LOWER), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def longest_rule(rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits ``host`` and ``path``; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = (F.col("host") == r.host) | F.col("host").endswith("." + r.host)
        fits &= F.col("path").startswith(r.path)
        rule = F.when(fits, F.lit(r.text)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def entropy(text: str) -> float:
    if not text:
        return 0.0
    n = np.unique(list(text), return_counts=True)[1] / len(text)
    return float(-(n * np.log2(n)).sum())


def lexical(url: str, host: str, path: str, known: tuple[float, ...]) -> list[float]:
    """Features of a URL; ``known`` are the shares of blocked URLs under its host's suffixes."""
    n = max(1, len(url))
    query = url.partition("#")[0].partition("?")[2]
    return [
        len(url), len(host), len(path), len(query), path.count("/"), host.count("."),
        sum(c.isdigit() for c in url) / n, sum(c.isdigit() for c in host) / max(1, len(host)),
        sum(not c.isalnum() for c in url) / n, host.count("-"), entropy(host), entropy(path),
        len([p for p in query.split("&") if p]), float("#" in url), float(url.startswith("https")),
        *known,
    ]


@dataclass
class Trees:
    """Boosted trees of equal depth: a feature and an edge per inner node, a value per leaf."""

    edges: list[np.ndarray]
    features: np.ndarray  #: trees x inner nodes
    splits: np.ndarray
    values: np.ndarray  #: trees x leaves
    start: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack(
            [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.edges)], axis=1
        )

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of a block."""
        bins, total = self.binned(x), np.full(len(x), self.start)
        for features, splits, values in zip(self.features, self.splits, self.values, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(LEVELS):
                right = bins[np.arange(len(x)), features[node]] > splits[node]
                node = 2 * node + 1 + right
            total += values[node - (2**LEVELS - 1)]
        return total


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees fitted to 0/1 labels by second-order steps on the logistic loss.

    A level is grown at once: one histogram over nodes, features and bins.
    """
    quantiles = np.arange(1, BINS) / BINS
    edges = [np.unique(np.quantile(x[:, k], quantiles)) for k in range(x.shape[1])]
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model = Trees(edges, *(np.zeros((0, 2**LEVELS - 1), np.int64) for _ in range(2)), np.zeros((0, 2**LEVELS)), float(np.log(rate / (1 - rate))))
    bins, total, n_features = model.binned(x), np.full(len(x), model.start), x.shape[1]
    features, splits, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        slope, curve = p - y, np.maximum(p * (1 - p), 1e-9)
        feature = np.zeros(2**LEVELS - 1, np.int64)
        split = np.full(2**LEVELS - 1, BINS, np.int64)  # no row is beyond it
        node = np.zeros(len(x), np.int64)
        for level in range(LEVELS):
            first, width = 2**level - 1, 2**level
            at = ((node - first)[:, None] * n_features + np.arange(n_features)) * BINS + bins
            shape = (width, n_features, BINS)
            sums = [
                np.bincount(at.ravel(), np.repeat(v, n_features), np.prod(shape)).reshape(shape).cumsum(axis=2)
                for v in (slope, curve, np.ones(len(x)))
            ]
            left = [s[:, :, :-1] for s in sums]
            right = [s[:, :, -1:] - l for s, l in zip(sums, left, strict=True)]
            whole = [s[:, :, -1:] for s in sums]
            gain = sum(
                sign * part[0] ** 2 / (part[1] + PENALTY)
                for sign, part in ((1, left), (1, right), (-1, whole))
            )
            gain[(left[2] < LEAST) | (right[2] < LEAST)] = 0
            best = gain.reshape(width, -1)
            chosen = best.argmax(axis=1)
            useful = best[np.arange(width), chosen] > 1e-6
            feature[first : first + width] = np.where(useful, chosen // (BINS - 1), 0)
            split[first : first + width] = np.where(useful, chosen % (BINS - 1), BINS)
            node = 2 * node + 1 + (bins[np.arange(len(x)), feature[node]] > split[node])
        leaf = node - (2**LEVELS - 1)
        value = -RATE * np.bincount(leaf, slope, 2**LEVELS) / (np.bincount(leaf, curve, 2**LEVELS) + PENALTY)
        total += value[leaf]
        features.append(feature)
        splits.append(split)
        values.append(value)
    return Trees(edges, np.array(features), np.array(splits), np.array(values), model.start)


@dataclass
class UrlModel:
    """``statistics`` is a written table with a row for every suffix of a labelled host."""

    statistics: DataFrame | None
    base: float
    trees: Trees | None

    def blocked(self, urls: list[tuple]) -> np.ndarray:
        """Probability that each URL (url, host, path and what is known) is to be blocked."""
        if self.trees is None or not urls:
            return np.full(len(urls), self.base)
        x = [lexical(url, host, path, known) for url, host, path, *known in urls]
        return 1 / (1 + np.exp(-self.trees.score(np.array(x, float))))


def suffix_columns() -> list[Column]:
    """The last labels of ``host``, the last of them first."""
    labels = F.reverse(F.split("host", r"\."))
    return [F.array_join(F.slice(labels, 1, k), ".") for k in SUFFIX_LABELS]


def with_known(
    rows: DataFrame, statistics: DataFrame, base: float, without: str | None = None
) -> tuple[DataFrame, list[str]]:
    """The rows with the share of blocked labelled URLs under each suffix of their host.

    A suffix that no labelled host has gets the share of the next shorter one. ``without``
    names a column with the part of the labelled rows that is left out. Every suffix
    is joined on its own, so a suffix that most hosts have is a hot key of a kept side only.
    """
    shorter, names = F.lit(base), []
    for k, suffix in zip(SUFFIX_LABELS, suffix_columns(), strict=True):
        counted = statistics.toDF(f"suffix_{k}", f"bads_{k}", f"ns_{k}")
        rows = rows.withColumn(f"own_{k}", suffix).join(
            counted, F.col(f"own_{k}") == F.col(f"suffix_{k}"), "left"
        )
        bad, n = (
            F.aggregate(f"{c}_{k}", zero, lambda a, x: a + x)
            - (F.element_at(f"{c}_{k}", F.col(without) + 1) if without else zero)
            for c, zero in (("bads", F.lit(0.0)), ("ns", F.lit(0).cast("bigint")))
        )
        share = (bad + F.lit(PRIOR * base)) / (n + F.lit(PRIOR))
        name = f"known_{k}"
        rows = rows.withColumn(name, F.coalesce(F.when(n > 0, share), shorter))
        rows = rows.drop(f"own_{k}", f"suffix_{k}", f"bads_{k}", f"ns_{k}")
        shorter = F.col(name)
        names.append(name)
    return rows, names


def learn(ruled: DataFrame, bound: int = LEARNED) -> UrlModel:
    """Model from the rows of ``page_id, url, host, path, verdict`` that have a verdict.

    Statistics of suffixes cover all labelled rows; they are summed in a shuffle and
    written, however many they are. The trees learn from ``bound`` rows at most,
    chosen by a hash of the URL. What a row learns from about its suffixes comes from other
    parts of the labelled rows, so that neither a rare suffix nor the row's own share gives its
    label away. Without rows of both verdicts there are no trees, and everything has
    the verdict of the labelled (allow, if there are none).
    """
    labelled = (
        ruled.filter("verdict is not null")
        .withColumn("bad", (F.col("verdict") == "block").cast("double"))
        .withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "url"), F.lit(FOLDS)).cast("int"))
    )
    in_fold = [F.col("fold") == f for f in range(FOLDS)]
    statistics = staged(
        labelled.select(
            F.explode(F.array_distinct(F.array(*suffix_columns()))).alias("suffix"), "bad", "fold"
        )
        .groupBy("suffix")
        .agg(
            F.array(*(F.sum(F.when(f, F.col("bad")).otherwise(0.0)) for f in in_fold)).alias("bads"),
            F.array(*(F.count_if(f) for f in in_fold)).alias("ns"),
        )
    )
    sample = staged(bounded_sample(labelled, "url", bound).select("url", "host", "path", "bad", "fold"))
    base = sample.agg(F.avg("bad")).first()[0] or 0.0
    if not 0 < base < 1:
        return UrlModel(statistics, base, None)
    sample, names = with_known(sample, statistics, base, "fold")
    sample = sample.select("url", "host", "path", *names, "bad").orderBy("url", "bad").toPandas()
    x = [
        lexical(url, host, path, known)
        for url, host, path, *known, _ in sample.itertuples(index=False)
    ]
    return UrlModel(statistics, base, boost(np.array(x, float), sample["bad"].to_numpy(float)))


def with_rules(
    pages: DataFrame, rules: list[Rule], id_column: str = "page_id", url_column: str = "url"
) -> DataFrame:
    """``page_id, url, host, path, rule, verdict``; the last two are null where no rule fits."""
    importable(pages.sparkSession)
    host, path = host_and_path("url")
    rule, verdict = longest_rule(rules)
    return (
        pages.select(col(id_column).alias("page_id"), col(url_column).alias("url"))
        .withColumns({"host": host, "path": path})
        .withColumns({"rule": rule, "verdict": verdict})
    )


def judge(ruled: DataFrame, model: UrlModel, threshold: float = 0.5) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every page.

    A rule's verdict stands; else a page is blocked from a probability of
    ``threshold`` on, which is ``score``. A URL that is null or has no ``://`` has an empty host and
    path, fits no rule and is judged by the model like others. Repeated rows give a row
    each. The pages' ids and URLs are joined with the statistics of their hosts' suffixes; what
    else the pages have is not moved.
    """
    known, shares = with_known(ruled, model.statistics, model.base)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = [batch.column(c).to_pylist() for c in ("url", "host", "path", *shares)]
            p = model_.blocked([(u or "", *rest) for u, *rest in zip(*given, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(p, pa.float64())], [*names, "score"]
            )

    names = ["page_id", "host", "path", "rule", "verdict"]
    model_ = UrlModel(None, model.base, model.trees)  # without the frame, which stays on the driver
    kinds = f"page_id {id_type(ruled, 'page_id')}, host string, path string, rule string, verdict string"
    own = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return known.mapInArrow(scored, f"{kinds}, score double").withColumn(
        "verdict", F.coalesce("verdict", own)
    )
