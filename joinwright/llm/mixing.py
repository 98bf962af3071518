"""Mixing sources to target weights by iterative proportional fitting.

The tokens of the cells (source, language, topic) are raked: in turn, the weights of
all sources, languages and topics are scaled to their targets, until all three
margins hold. A document is then drawn so many times as is in proportion to the weight
of its cell, the rest of it by a draw. Everything is a DataFrame expression.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joinwright.functions.columns import col

from .common import staged, unused

DIMENSIONS = ("source", "lang", "topic")
#: Most sweeps over the margins, and the relative error from which on there are no more.
SWEEPS, TOLERANCE = 24, 1e-10
#: Tokens that are drawn, as a share of those there are.
SHARE = 0.5
#: Targets are the present shares to this power: below 1, small categories gain.
TEMPER = 0.8
#: Bytes of text that count as a token.
TOKEN_BYTES = 4
#: A draw is a whole number below this.
DRAWS = 1 << 32
#: Register of a text, the first that fits, which stands for its topic: a name, and a
#: string that the text contains or a pattern.
TOPICS = (
    ("web", "http", None),
    ("contact", "@", None),
    ("numeric", None, "[0-9]{3,}"),
    ("lines", "\n", None),
)
OTHER_TOPIC = "prose"


def topic_of(text: Column) -> Column:
    """Topic of a text by its register."""
    found = F.lit(OTHER_TOPIC)
    for name, part, pattern in reversed(TOPICS):
        fits = text.contains(part) if part else text.rlike(pattern)
        found = F.when(fits, F.lit(name)).otherwise(found)
    return found


def tokens_of(text: Column) -> Column:
    """Estimated tokens; at least one, so that every document has a weight."""
    return F.greatest(F.lit(1), F.ceil(F.octet_length(text) / F.lit(TOKEN_BYTES))).cast("long")


def cell_columns(text: str = "text", source: str = "source", lang: str = "lang") -> dict[str, Column]:
    """Cell and tokens of a document; what is null is a category of its own, ''."""
    content = F.coalesce(col(text), F.lit(""))
    return {
        "source": F.coalesce(col(source).cast("string"), F.lit("")),
        "lang": F.coalesce(col(lang).cast("string"), F.lit("")),
        "topic": topic_of(content),
        "tokens": tokens_of(content),
    }


def tempered(cells: DataFrame, dimension: str, power: float = TEMPER) -> DataFrame:
    """``dimension, target``: present token shares to this power, adding up to 1."""
    raised = cells.groupBy(dimension).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("raised"))
    total = raised.agg(F.sum("raised")).first()[0] or 1.0
    return raised.select(dimension, (F.col("raised") / F.lit(total)).alias("target"))


def rake(
    cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS, tolerance: float = TOLERANCE
) -> DataFrame:
    """The cells with ``ratio``, what each token weighs after raking.

    ``targets`` has a frame (category, ``target``) for each dimension; a category
    without a target, or whose weights are all zero, has the factor 0. Cells are
    never changed: what a step writes is one factor per category, and what it shuffles are sums
    per task and category. When a sweep finds all margins within ``tolerance`` of their
    targets, raking ends. Targets that the cells cannot meet, as where every source has a language
    of its own, are warned about after ``sweeps`` sweeps; the ratios are those reached then.
    """
    factors = {d: targets[d].select(d, F.lit(1.0).alias(f"f_{d}")) for d in DIMENSIONS}
    for _ in range(sweeps):
        off = []
        for d in DIMENSIONS:
            weight, held = F.col("tokens").cast("double"), cells
            for other in DIMENSIONS:
                if other != d:
                    held = held.join(factors[other], other, "left")
                    weight = weight * F.coalesce(f"f_{other}", F.lit(0.0))
            held = held.groupBy(d).agg(F.sum(weight).alias("held"))
            factor = F.when(F.col("held") > 0, F.coalesce("target", F.lit(0.0)) / F.col("held"))
            # The margin was that far off before this step.
            error = F.abs(F.col("held") * F.coalesce(f"f_{d}", F.lit(0.0)) - F.coalesce("target", F.lit(0.0)))
            made = staged(
                held.join(targets[d], d, "left")
                .join(factors[d], d, "left")
                .select(
                    d, F.coalesce(factor, F.lit(0.0)).alias("made"),
                    (error / F.greatest("target", F.lit(1e-300))).alias("off"),
                )
            )
            off.append(made.select("off"))
            factors[d] = made.select(d, F.col("made").alias(f"f_{d}"))
        error = reduce(DataFrame.union, off).agg(F.max("off")).first()[0] or 0.0
        if error <= tolerance:
            break
    else:
        warnings.warn(f"after {sweeps} sweeps a margin is {error:.2g} off its target", stacklevel=2)
    ratio, out = F.lit(1.0), cells
    for d in DIMENSIONS:
        out = out.join(factors[d], d, "left")
        ratio = ratio * F.coalesce(f"f_{d}", F.lit(0.0))
    return out.select(*DIMENSIONS, "tokens", ratio.alias("ratio"))


def draw(id_column: Column) -> Column:
    """A whole number below DRAWS from the id, the same at every run."""
    digest = F.md5(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def expected_copies(cells: DataFrame, share: float) -> DataFrame:
    """``source, lang, topic, copies``: how often a document of the cell is drawn, on average.

    That is the ratio times one number for all cells, so that ``share`` of the tokens is
    drawn and the margins are the targets, whatever the heaviest ratio is.
    """
    tokens = F.col("tokens").cast("double")
    total, held = cells.agg(F.sum(tokens), F.sum(tokens * F.col("ratio"))).first()
    times = share * total / held if held else 0.0
    return cells.select(*DIMENSIONS, (F.col("ratio") * F.lit(times)).alias("copies"))


def raked(docs: DataFrame, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """The cells of the documents with ``tokens`` and ``ratio``.

    Without ``targets`` they are the present shares, tempered. Documents are summed into cells
    per task before any shuffle, so a source of any share is no task's burden.
    """
    cells = staged(
        docs.select(*(c.alias(n) for n, c in cell_columns().items()))
        .groupBy(*DIMENSIONS)
        .agg(F.sum("tokens").alias("tokens"))
    )
    targets = targets or {d: staged(tempered(cells, d)) for d in DIMENSIONS}
    return staged(rake(cells, targets))


def calibrated(
    docs: DataFrame, targets: dict[str, DataFrame] | None = None, share: float = SHARE
) -> DataFrame:
    """``source, lang, topic, copies`` of every cell of the documents; targets as in ``raked``."""
    return staged(expected_copies(raked(docs, targets), share))


def times_drawn(copies: str, id_column: str) -> Column:
    """Whole part of the expected copies, and one more by a draw for the rest."""
    whole = F.floor(copies)
    more = draw(col(id_column)) < (F.col(copies) - whole) * F.lit(float(DRAWS))
    return whole + more.cast("long")


def mix(
    docs: DataFrame, targets: dict[str, DataFrame] | None = None, share: float = SHARE
) -> DataFrame:
    """``doc_id, source, lang, topic, tokens, copies, times`` of every document.

    ``copies`` is how often a document of its cell is drawn on average, ``times`` how often this
    one is; rows of one id share the draw. ``share`` of the tokens is expected to be drawn: a
    category that is rarer than its target is repeated, and does not scale the others down. A null
    source or language is a category '', a null text counts one token. An empty table gives no rows.
    """
    of = docs.select("doc_id", *(c.alias(n) for n, c in cell_columns().items()))
    return of.join(calibrated(docs, targets, share), list(DIMENSIONS)).select(
        "doc_id", *DIMENSIONS, "tokens", "copies", times_drawn("copies", "doc_id").alias("times")
    )


def sampled(
    docs: DataFrame, targets: dict[str, DataFrame] | None = None, share: float = SHARE
) -> DataFrame:
    """The rows that ``mix`` draws, each as often as it does, with their own columns.

    Null texts, sources and languages count as in ``mix``; a text of any length is one row.
    """
    names = {n: unused(docs, f"of_{n}") for n in DIMENSIONS}
    columns = cell_columns()
    expected, times = unused(docs, "expected"), unused(docs, "times")
    cells = calibrated(docs, targets, share).toDF(*names.values(), expected)
    drawn = (
        docs.withColumns({names[n]: columns[n] for n in DIMENSIONS})
        .join(cells, list(names.values()))
        .withColumn(times, times_drawn(expected, "doc_id"))
        .filter(F.col(times) > 0)
    )
    drawn = drawn.withColumn(times, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))))
    return drawn.select(*(col(c) for c in docs.columns))


def oracle(sweeps: int = 12, power: float = TEMPER, share: float = SHARE) -> str:
    """The result of ``mix`` over ``documents`` with tempered targets, as SQL.

    It has so many sweeps that the margins hold.
    """
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    cases = " ".join(
        "WHEN "
        + (f"contains(t, {quoted(part)})" if part else f"regexp_matches(t, {quoted(pattern)})")
        + f" THEN {quoted(name)}"
        for name, part, pattern in TOPICS
    )
    steps = [
        f"""of AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
         CASE {cases} ELSE '{OTHER_TOPIC}' END AS topic,
         greatest(1, CAST(ceil(strlen(t) / {TOKEN_BYTES}.0) AS BIGINT)) AS tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents))""",
        """cells AS MATERIALIZED (
  SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS tokens FROM of GROUP BY ALL)""",
    ]
    for d in DIMENSIONS:
        steps.append(
            f"""target_{d} AS MATERIALIZED (
  SELECT {d}, raised / sum(raised) OVER () AS target
  FROM (SELECT {d}, pow(sum(tokens), {power}) AS raised FROM cells GROUP BY {d}))"""
        )
        steps.append(f"{d}_0 AS MATERIALIZED (SELECT {d}, CAST(1 AS DOUBLE) AS f FROM target_{d})")
    now = {d: f"{d}_0" for d in DIMENSIONS}
    for sweep in range(1, sweeps + 1):
        for d in DIMENSIONS:
            a, b = (x for x in DIMENSIONS if x != d)
            steps.append(
                f"""{d}_{sweep} AS MATERIALIZED (
  SELECT {d}, any_value(target) / sum(tokens * {now[a]}.f * {now[b]}.f) AS f
  FROM cells JOIN {now[a]} USING ({a}) JOIN {now[b]} USING ({b}) JOIN target_{d} USING ({d})
  GROUP BY {d})"""
            )
            now[d] = f"{d}_{sweep}"
    product = " * ".join(f"{now[d]}.f" for d in DIMENSIONS)
    joins = " ".join(f"JOIN {now[d]} USING ({d})" for d in DIMENSIONS)
    steps.append(f"rated AS MATERIALIZED (SELECT source, lang, topic, {product} AS r FROM cells {joins})")
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT doc_id, source, lang, topic, tokens, CAST(round(1e6 * copies) AS BIGINT) AS copies_ppm,
       CAST(floor(copies) AS BIGINT) + CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
         < (copies - floor(copies)) * {float(DRAWS)} AS BIGINT) AS times
FROM of JOIN (
  SELECT source, lang, topic, r * {share} * sum(tokens) OVER () / sum(tokens * r) OVER () AS copies
  FROM rated JOIN cells USING (source, lang, topic)
) USING (source, lang, topic)"""
    )
