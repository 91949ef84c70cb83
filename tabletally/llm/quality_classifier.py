"""Quality classifier: random Fourier features over document statistics.

Each text becomes a vector of standardised statistics. ``features`` random
cosines of it approximate a Gaussian kernel; ridge regression on them is fitted
by normal equations that are summed per partition, then over partitions, so
neither rows nor kernel matrices are gathered. The raw ridge scores are turned
into probabilities by isotonic regression on held-back labelled rows: counted
in fine bins by Spark, pooled on the driver (the number of bins is fixed),
joined by straight lines so that ranks survive.

All labelled rows are used. What is broadcast has a fixed size: the random
frequencies, the weights and the calibration knots.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_of_id, learns, reliable, table
from .textstats import with_counts

STATISTICS = (
    "words", "word_length", "symbols", "repeated_lines", "repeated_words", "upper", "digits", "points", "exclaims",
    "top_word", "twice", "distinct", "line_length", "other_letters",
)
CLIP = 4.0  # standard deviations
#: Parts that the partitions' sums of a matrix row are added up in before they are added together.
SUM_PARTS = 64
BIN = 0.0025
#: Pseudo-counts that each calibration bin block starts from, at the base rate.
PRIOR = 2.0


def statistics() -> list[Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    lines = F.greatest("n_lines", F.lit(1))
    values = [
        F.log1p("n_words"), F.log(chars / words), F.sqrt(F.col("n_symbols") / chars), F.sqrt(F.col("n_dup_lines") / lines),
        F.sqrt(F.col("n_repeat_words") / words), F.sqrt(F.col("n_upper") / chars), F.sqrt(F.col("n_digits") / chars),
        F.sqrt(F.col("n_points") / chars), F.sqrt(F.col("n_exclaim") / chars), F.sqrt(F.col("n_top_word") / words),
        F.sqrt(F.col("n_twice") / words), F.log(F.greatest("n_distinct", F.lit(1)) / words), F.log1p(words / lines),
        F.sqrt(F.col("n_other") / chars),
    ]
    return [v.cast("double").alias(name) for v, name in zip(values, STATISTICS, strict=True)]


class Features:
    """Random cosines whose products approximate exp(-|x - y|^2 / (2 bandwidth^2)), and a constant."""

    def __init__(self, mean: list[float], spread: list[float], features: int, bandwidth: float, seed: int):
        draw = np.random.default_rng(seed)
        self.mean, self.spread = np.array(mean), np.array(spread)
        self.frequencies = draw.normal(0, 1 / bandwidth, (len(mean), features))
        self.phases = draw.uniform(0, 2 * np.pi, features)

    def of(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -CLIP, CLIP)
        waves = np.cos(z @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(x), 1))])


def normal_equations(rows: DataFrame, features: Features) -> tuple[np.ndarray, np.ndarray]:
    """Sum of z z' and z y over all rows: partition sums, added row by row of the matrix, in parts first."""
    size = len(features.phases) + 1

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = features.of(batch[list(STATISTICS)].to_numpy(float))
            total += z.T @ np.column_stack([z, batch["label"].to_numpy(float)])
        yield pd.DataFrame({"i": np.arange(size), "part": TaskContext.get().partitionId() % SUM_PARTS, "sums": list(total)})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": group["i"].iloc[:1], "part": 0, "sums": [np.sum(group["sums"].tolist(), axis=0)]})

    schema = "i long, part long, sums array<double>"
    parts = rows.mapInPandas(partial, schema).groupBy("i", "part").applyInPandas(add, schema)
    summed = parts.groupBy("i").applyInPandas(add, schema).collect()
    matrix = np.zeros((size, size + 1))
    for r in summed:
        matrix[r.i] = r.sums
    return matrix[:, :-1], matrix[:, -1]


def isotonic(score: np.ndarray, positives: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators over bins in ascending score: knots (score, probability), probabilities not falling."""
    blocks: list[list[float]] = []  # score * number, positives, number
    for s, p, n in zip(score, positives, number, strict=True):
        blocks.append([s * n, p, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    base = sum(b[1] for b in blocks) / sum(b[2] for b in blocks)
    knots = np.array([b[0] / b[2] for b in blocks])
    values = np.maximum.accumulate([(b[1] + PRIOR * base) / (b[2] + PRIOR) for b in blocks])
    return knots, values


def score_quality(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    features: int = 200,
    bandwidth: float = 3.0,
    ridge: float = 1e-3,
    seed: int = 7,
) -> DataFrame:
    """(key, score): the probability of label 1 for every row of ``df``.

    Learns from rows of ``labels`` whose key may be learnt from; a quarter of
    them calibrates, the others fit. Labels, language, source and key never
    enter a score.

    Defined cases: a null or empty text has zero counts and gets a score like
    any other; null labels are ignored; without any usable label every score
    is 0.5; repeated rows get equal scores; an empty table gives no rows.
    """
    counted = reliable(with_counts(df, text, [key]).select(key, *statistics()))
    known = (
        labels.where(learns(F.col(key)) & F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .select(F.col(key).alias("_key"), F.col(label).cast("double").alias("label"))
    )
    labelled = reliable(
        counted.join(known, counted[key] == known["_key"])
        .withColumn("calibrates", F.floor(crc_of_id(F.col(key)) / 5) % 4 == 0)
        .select(*STATISTICS, "label", "calibrates")
    )
    moments = counted.agg(
        F.array(*[F.coalesce(F.avg(c), F.lit(0.0)) for c in STATISTICS]).alias("mean"),
        F.array(*[F.coalesce(F.stddev_pop(c), F.lit(0.0)) for c in STATISTICS]).alias("spread"),
    ).first()
    basis = Features(moments["mean"], [max(s, 0.05) for s in moments["spread"]], features, bandwidth, seed)
    gram, target = normal_equations(labelled.where(~F.col("calibrates")), basis)
    penalty = ridge * max(gram[-1, -1], 1.0) * np.diag([1.0] * features + [1e-6])
    weights = np.linalg.solve(gram + penalty, target)

    def raw(batch: pd.DataFrame) -> np.ndarray:
        return np.clip(basis.of(batch[list(STATISTICS)].to_numpy(float)) @ weights, -1, 2)

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = raw(batch)
            yield pd.DataFrame({"bin": np.floor(at / BIN).astype(int), "raw": at, "label": batch["label"]})

    bins = (
        labelled.where("calibrates").mapInPandas(binned, "bin long, raw double, label double")
        .groupBy("bin").agg(F.avg("raw").alias("raw"), F.sum("label").alias("positives"), F.count(F.lit(1)).alias("number"))
        .orderBy("bin").toPandas()
    )
    knots, values = (np.zeros(1), np.full(1, 0.5))
    if len(bins):
        knots, values = isotonic(bins["raw"].to_numpy(), bins["positives"].to_numpy(), bins["number"].to_numpy())

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.interp(raw(batch.to_pandas()), knots, values)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], [key, "score"])

    return counted.mapInArrow(scored, f"`{key}` {dict(counted.dtypes)[key]}, score double")


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    scores = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select(
        "doc_id", (~learns(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
