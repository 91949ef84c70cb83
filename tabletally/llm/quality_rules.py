"""Quality rules: robust multivariate outliers of document statistics.

Every text gets counts, a base rule, and a vector of transformed statistics
(logarithms and square roots, which even out their scales). Per language and
source, and per language, a minimum-covariance-determinant estimate says what
is usual there; a document is rejected if its Mahalanobis distance from the
estimate is beyond a chi-square quantile.

The estimates run as SQL aggregates over all documents that pass the base rule:

* Copies of a text count once per group, so a large group of copies cannot pass
  for the usual case. Vectors are rounded to a fine grid; a cell weighs as much
  as the number of distinct texts in it.
* Start: coordinate-wise medians and quartile ranges of each group.
* Concentration steps: distances from the current estimate, their median per
  group, then mean and covariance of the closer half, scaled to be consistent
  for normal data. Each step is one job; its small result is checkpointed.
* A group's estimate is blended with its language's, weighing as much as
  ``prior`` texts, so small groups need no special case. ``FLOORS`` are the
  scales below which a difference is never unusual; they are added to the
  covariance, which keeps it invertible where a statistic is constant.

All aggregates combine map-side, so a source with a third of the rows adds one
row per task to the shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import reliable, table
from .textstats import with_counts

#: Statistic, and the scale added to its spread.
FLOORS = {"wl": 0.05, "sym": 0.04, "dup": 0.2, "rep": 0.2, "up": 0.05, "dig": 0.1, "pt": 0.04, "top": 0.05}
P = len(FLOORS)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
GRID = 0.02
MIN_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
GROUP_BYTES = 1024  # more than an estimate takes
BROADCAST_BYTES = 32 << 20


def chi2_cdf(x: float, dof: int) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dof // 2))


def chi2_quantile(q: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dof) < q else (low, mid)
    return low


#: The covariance of the inner half of normal data, times this, is that of all.
CONSISTENCY = 0.5 / chi2_cdf(chi2_quantile(0.5, P), P + 2)


def vector() -> list[Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    lines = F.greatest("n_lines", F.lit(1))
    values = {
        "wl": F.log(chars / words), "sym": F.sqrt(F.col("n_symbols") / chars), "dup": F.sqrt(F.col("n_dup_lines") / lines),
        "rep": F.sqrt(F.col("n_repeat_words") / words), "up": F.sqrt(F.col("n_upper") / chars),
        "dig": F.sqrt(F.col("n_digits") / chars), "pt": F.sqrt(F.col("n_points") / chars), "top": F.sqrt(F.col("n_top_word") / words),
    }
    return [values[name].alias(f"x{i}") for i, name in enumerate(FLOORS)]


def distance() -> Column:
    """Squared Mahalanobis distance of x0.. from ``mean`` under ``precision`` (upper triangle, off-diagonals doubled)."""
    off = [F.col(f"x{i}") - F.col("mean")[i] for i in range(P)]
    terms = [F.col("precision")[k] * off[i] * off[j] for k, (i, j) in enumerate(PAIRS)]
    return sum(terms[1:], terms[0])


def with_precision(estimates: DataFrame) -> DataFrame:
    """(_group, n, mean, cov) -> the same with the precision of cov plus the floors; one small row per group."""
    floors = np.diag(np.square(list(FLOORS.values())))

    def invert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for cov in batch["cov"]:
                full = np.zeros((P, P))
                for (i, j), value in zip(PAIRS, cov, strict=True):
                    full[i, j] = full[j, i] = value
                inverse = np.linalg.inv(full + floors)
                out.append([float(inverse[i, j] * (1 if i == j else 2)) for i, j in PAIRS])
            yield batch.assign(precision=out)

    return estimates.mapInPandas(
        invert, "_group string, n long, mean array<double>, cov array<double>, precision array<double>"
    )


def weight_of(cells: DataFrame) -> Column:
    """The number of distinct texts in a cell; 1 where none is given."""
    return F.col("_weight") if "_weight" in cells.columns else F.lit(1)


def medians(cells: DataFrame) -> DataFrame:
    weight = weight_of(cells)
    quartiles = [F.percentile(f"x{i}", [0.25, 0.5, 0.75], weight).alias(f"q{i}") for i in range(P)]  # few grid values
    spread = [F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(2.0)) for i in range(P)]
    return cells.groupBy("_group").agg(F.sum(weight).alias("n"), *quartiles).select(
        "_group", "n", F.array(*[F.col(f"q{i}")[1] for i in range(P)]).alias("mean"),
        F.array(*[spread[i] if i == j else F.lit(0.0) for i, j in PAIRS]).alias("cov"),
    )


def sent(estimates: DataFrame, groups: int) -> DataFrame:
    """Estimates as the side of a join: broadcast up to a checked size, so that no
    group's rows meet in one task, and left to the planner beyond it."""
    return F.broadcast(estimates) if groups * GROUP_BYTES <= BROADCAST_BYTES else estimates


def concentrate(cells: DataFrame, estimates: DataFrame, groups: int) -> DataFrame:
    """One concentration step; ``groups`` is the number of estimates."""
    near = cells.join(sent(estimates.select("_group", "mean", "precision"), groups), "_group")
    # rounded logarithms, so that a group's median is taken over a bounded number of values
    near = near.withColumn("_d", F.round(F.log(F.greatest(distance(), F.lit(1e-12))), 4))
    weight = weight_of(cells)
    half = near.groupBy("_group").agg(F.percentile("_d", 0.5, weight).alias("_half"), F.sum(weight).alias("_all"))
    inner = near.join(sent(half, groups), "_group").where(F.col("_d") <= F.col("_half"))
    # moments around the former mean, which keeps them well-conditioned
    off = [F.col(f"x{i}") - F.col("mean")[i] for i in range(P)]
    sums = inner.groupBy("_group").agg(
        F.max("_all").alias("n"), F.first("mean").alias("_at"),
        F.array(*[F.sum(weight * o) / F.sum(weight) for o in off]).alias("_m"),
        F.array(*[F.sum(weight * off[i] * off[j]) / F.sum(weight) for i, j in PAIRS]).alias("_s"),
    )
    cov = [(F.col("_s")[k] - F.col("_m")[i] * F.col("_m")[j]) * CONSISTENCY for k, (i, j) in enumerate(PAIRS)]
    return sums.select(
        "_group", "n", F.array(*[F.col("_at")[i] + F.col("_m")[i] for i in range(P)]).alias("mean"), F.array(*cov).alias("cov")
    )


def estimate(rows: DataFrame, steps: int = 4, prior: int = 50) -> DataFrame:
    """Estimates per language and source, blended with their language's: (_group, mean, precision), to be joined."""
    grid = [F.round(F.col(f"x{i}") / GRID).cast("long").alias(f"x{i}") for i in range(P)]
    levels = rows.select(F.explode(F.array("_lang", "_source")).alias("_group"), "_hash", *grid).distinct()
    counted = levels.groupBy("_group", *[f"x{i}" for i in range(P)]).agg(F.count(F.lit(1)).alias("_weight"))
    cells = reliable(counted.select("_group", "_weight", *[(F.col(f"x{i}") * GRID).alias(f"x{i}") for i in range(P)]))
    current = reliable(with_precision(medians(cells)))
    groups = current.count()
    for _ in range(steps):
        current = reliable(with_precision(concentrate(cells, current, groups)))
    pairs = rows.select("_lang", "_source").distinct()
    own = current.select(F.col("_group").alias("_source"), "n", "mean", "cov")
    wide = current.select(F.col("_group").alias("_lang"), F.col("mean").alias("_mean"), F.col("cov").alias("_cov"))

    def blend(a: str, b: str) -> Column:
        return F.zip_with(a, b, lambda x, y: (x * F.col("n") + y * prior) / (F.col("n") + prior))

    blended = pairs.join(own, "_source").join(wide, "_lang").select(
        F.col("_source").alias("_group"), "n", blend("mean", "_mean").alias("mean"), blend("cov", "_cov").alias("cov")
    )
    return sent(reliable(with_precision(blended)).select("_group", "mean", "precision"), groups)


def apply_rules(
    df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", quantile: float = 0.999, keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` with the counts, ``base_failed``, ``distance`` (null where the base rule fails) and ``kept``.

    Defined cases: a null or empty text has no words and fails the base rule;
    null languages and sources form groups of their own; repeated rows get
    equal verdicts; an empty table gives no rows; texts are read whole.
    """
    keep = [c for c in df.columns if c != text] if keep is None else keep
    groups = df.withColumns({
        "_lang": F.concat(F.lit("lang "), F.to_json(F.struct(F.col(lang).alias("l")))),
        "_source": F.concat(F.lit("source "), F.to_json(F.struct(F.col(lang).alias("l"), F.col(source).alias("s")))),
        "_hash": F.xxhash64(text),
    })
    counted = reliable(with_counts(groups, text, [*keep, "_lang", "_source", "_hash"]))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = counted.withColumn("base_failed", failed).select("*", *vector())
    usual = estimate(rows.where(~F.col("base_failed")))
    near = F.when(~F.col("base_failed"), distance())
    return (
        rows.join(usual, rows["_source"] == usual["_group"], "left")
        .withColumn("distance", near)
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= chi2_quantile(quantile, P), F.lit(False)))
        .drop("_lang", "_source", "_hash", "_group", "mean", "precision", *[f"x{i}" for i in range(P)])
    )


def op4_rules(spark, sf_dir: str) -> DataFrame:
    """All documents with their counts and verdicts."""
    return apply_rules(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )
