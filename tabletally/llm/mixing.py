"""Mixing sources to target weights by a time-varying curriculum.

Every source has a share of the mix and a schedule: its sampling weight as a
function of the training time t in [0, 1]. The steps, all DataFrame
operations:

1. Targets. Sources weigh ``weights`` in turn (code point order, null last)
   and share 100 % of all tokens; a target stops at ``max_epochs`` times its
   source's size and the excess is reshared by weight until none is above.
   This is a water level over the sources, found with one window over the
   (few) sources: sorted by cap / weight, the capped ones are a prefix.
2. Demand. Each source's documents stand in a fixed random order (md5 of the
   id). A document's copy number k begins at token
   ``k * source_size + offset`` of the source's demand. Copies are taken while
   they begin before the target; the last, partial epoch takes a document if
   at least half of it lies before the target.
3. Positions. The schedule w(t) falls or rises linearly around 1, so its
   integral W(t) is a parabola with W(1) = 1. The copy that begins at token d
   is due when the source has been asked for d tokens: t = W^-1(d / target).
4. Order. Documents are range-sorted by position.

Offsets are two-level prefix sums: each source is cut by its hash order into
buckets of about ``rows_per_bucket`` rows; bucket totals are summed per source,
rows within a bucket. A source with a third of all rows is therefore spread
over many tasks. The bucket count changes the plan only, never a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, table

#: Weights in turn, and the slope of the schedule in turn
#: (start weight minus end weight; the mean is always 1).
WEIGHTS = (1, 2, 3)
SLOPES = (1.0, -1.0)
MAX_EPOCHS = 3


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _pick(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, slopes=SLOPES, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(_src, _null, source_size) -> the same with target and slope; one row per source.

    The windows without a partition run over one row per source.
    """
    by_name = Window.orderBy("_null", "_src")
    by_ratio = Window.orderBy("_ratio", "_null", "_src")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        sizes.withColumn("_rank", F.row_number().over(by_name) - 1)
        .withColumn("_weight", _pick(weights, F.col("_rank")))
        .withColumn("_slope", _pick(slopes, F.col("_rank")))
        .withColumn("_cap", F.col("source_size") * max_epochs)
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
        .withColumn("_total", F.sum("source_size").over(everything))
        .withColumn("_capped", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_left", F.sum("_weight").over(onward))
        .withColumn("_level", (F.col("_total") - F.col("_capped")) / F.col("_left"))
    )
    level = F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(everything)
    target = F.least(F.col("_cap").cast("double"), F.col("_weight") * F.coalesce(level, F.lit(0.0)))
    return ranked.withColumn("target", target).select("_src", "_null", "source_size", "target", "_slope")


def position_of(demand: Column, target: Column, slope: Column) -> Column:
    """t in [0, 1] at which the schedule 1 + slope * (1/2 - t) has asked for ``demand`` of ``target``.

    W(t) = (1 + slope/2) t - slope/2 t^2 is inverted in closed form.
    """
    share = F.least(F.greatest(demand / target, F.lit(0.0)), F.lit(1.0))
    b = 1 + slope / 2
    return 2 * share / (b + F.sqrt(F.greatest(b * b - 2 * slope * share, F.lit(0.0))))


def mix(
    df: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights=WEIGHTS,
    slopes=SLOPES,
    max_epochs: int = MAX_EPOCHS,
    rows_per_bucket: int = 500,
    carry: list[str] | None = None,
) -> DataFrame:
    """Give every row of ``df`` its part of the mix.

    Returns the columns ``carry`` of ``df`` (all of them if None) as struct
    ``row``, whatever their names, and size, source_size, target, taken, copies
    and positions (ascending array, one per copy taken).

    Defined cases: a null text has size 0; a null source is a source of its
    own, ordered last; rows with equal keys follow each other in an arbitrary
    but size-ordered way; a table without words takes nothing; an empty table
    gives no rows; texts are never cut.
    """
    order_key = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or df.columns]).alias("row"),
        words_in(F.col(text)).alias("size"),
        F.coalesce(F.col(source), F.lit("")).alias("_src"),
        F.col(source).isNull().alias("_null"),
        order_key.alias("_order"),
    )
    buckets = max(1, df.select(key).count() // rows_per_bucket)
    # the first 8 hex digits of the order, scaled to the buckets: bucket order is row order
    bucket = F.floor(F.conv(F.substring("_order", 1, 8), 16, 10).cast("long") * buckets / F.lit(16**8)).cast("long")
    rows = rows.withColumn("_bucket", bucket)

    sums = rows.groupBy("_src", "_null", "_bucket").agg(F.sum("size").alias("_sum"))
    sizes = sums.groupBy("_src", "_null").agg(F.sum("_sum").alias("source_size"))
    earlier = Window.partitionBy("_src", "_null").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_src", "_null", "_bucket", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    places = starts.join(source_targets(sizes, weights, slopes, max_epochs), ["_src", "_null"])

    within = (
        Window.partitionBy("_src", "_null", "_bucket").orderBy("_order", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.col("_start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("target") - F.col("_epochs") * F.col("source_size")
    extra = ((2 * F.col("_offset") + F.col("size") <= 2 * rest) & (rest > 0)).cast("long")
    copies = F.least(F.col("_epochs") + extra, F.lit(max_epochs).cast("long"))
    positions = F.when(F.col("target") > 0, F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(max_epochs - 1)), lambda k: k < F.col("copies")),
        lambda k: position_of(k * F.col("source_size") + F.col("_offset"), F.col("target"), F.col("_slope")),
    )).otherwise(F.array().cast("array<double>"))
    return (
        rows.join(places, ["_src", "_null", "_bucket"])
        .withColumn("_offset", offset)
        .withColumn("_epochs", epochs)
        .withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .withColumn("positions", positions)
        .select("row", "size", "source_size", "target", "taken", "copies", "positions")
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per copy taken, range-sorted by its training position: the columns of the mixed table."""
    return (
        mixed.where(F.col("copies") > 0)
        .select("row", F.explode("positions").alias("_position"))
        .orderBy("_position", F.xxhash64("row"))
        .select("row.*")
    )


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents with their place in the mix, ordered by first position; those not taken follow."""
    mixed = mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    first = F.try_element_at("positions", F.lit(1))
    untaken = 2 + F.pmod(F.xxhash64("row.doc_id"), F.lit(1 << 20)) / F.lit(1 << 20)
    return (
        mixed.select(
            F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", "copies",
            first.alias("position"),
        )
        .orderBy(F.coalesce("position", untaken), "doc_id")
    )


OP9_SQL = f"""
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS src, source IS NULL AS nul,
           coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
           md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS ord
      FROM documents),
s AS (SELECT src, nul, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY src, nul),
r AS (SELECT *, row_number() OVER (ORDER BY nul, src) - 1 AS rnk FROM s),
w AS (SELECT *, 1 + rnk % 3 AS weight, CASE WHEN rnk % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS slope,
             source_size * {MAX_EPOCHS} AS cap FROM r),
v AS (SELECT *, cap::DOUBLE / weight AS ratio, sum(source_size) OVER () AS total FROM w),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY ratio, nul, src
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                / sum(weight) OVER (ORDER BY ratio, nul, src
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level FROM v),
t AS (SELECT *, least(cap::DOUBLE, weight * coalesce(max(CASE WHEN level <= ratio THEN level END) OVER (), 0.0))
                AS target FROM l),
o AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.slope,
             coalesce(sum(d.size) OVER (PARTITION BY d.src, d.nul ORDER BY d.ord, d.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
        FROM d JOIN t ON d.src = t.src AND d.nul = t.nul),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM o),
c AS (SELECT *, least(epochs + CASE WHEN 2 * off + size <= 2 * (target - epochs * source_size)
                                     AND target - epochs * source_size > 0 THEN 1 ELSE 0 END, {MAX_EPOCHS}) AS copies
        FROM e)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(copies * size AS BIGINT) AS taken,
       CAST(copies AS BIGINT) AS copies,
       CASE WHEN copies > 0 AND target > 0 THEN
         2 * least(greatest(off / target, 0.0), 1.0) /
         (1 + slope / 2 + sqrt(greatest((1 + slope / 2) * (1 + slope / 2)
                                        - 2 * slope * least(greatest(off / target, 0.0), 1.0), 0.0))) END AS position
  FROM c
"""
