"""Insert-if-absent with Bloom filters in front of the join.

A key that is certainly not in the target is missing; no join has to say so. A
Bloom filter of the target's keys sorts the batch into rows that are certainly
missing, which go straight to the result, and rows that may be known, which take
the exact left anti join. A second filter, of the keys that may be known, thins
out the target before it is shuffled. The result is that of ``missing_rows``.

The filter is native: its bits lie in 64-bit words, a key sets ``BITS`` bits of
one word, ``bit_or`` folds the keys map-side, and 512 words make a row. Its size
follows from the counted keys and is never above ``MOST_BYTES``, so it can be
broadcast at any size of the target; beyond that many keys it rules out less,
and more rows take the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import any_null
from ..session import kept
from .insert_missing import missing_rows

#: Filter bits a key is given, bits it sets, words in a row of the filter.
BITS_PER_KEY, BITS, WORDS = 16, 4, 512
MOST_BYTES = 64 << 20


def filter_rows(n_keys: int, most_bytes: int = MOST_BYTES) -> int:
    """Rows (of 4 KB) of a filter for ``n_keys`` keys."""
    wanted = -(-n_keys * BITS_PER_KEY // (64 * WORDS))
    return max(1, min(wanted, most_bytes // (8 * WORDS)))


def _hashes(keys: list[str]) -> tuple[Column, Column]:
    """Two hashes of the key's values: which word, and which bits of it."""
    return F.xxhash64(*keys), F.xxhash64(F.lit("bits"), *keys)


def _word(keys: list[str], rows: int) -> Column:
    return F.pmod(_hashes(keys)[0], F.lit(rows * WORDS))


def _mask(keys: list[str]) -> Column:
    """The key's bits within its word: six bits of the second hash choose each."""
    chosen = _hashes(keys)[1]
    out = F.lit(0).cast("long")
    for i in range(BITS):
        place = F.shiftrightunsigned(chosen, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return out


def key_filter(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """The filter of the non-null keys of ``df``: ``(filter_row, words)``, exactly ``rows`` rows of 4 KB."""
    spark = df.sparkSession
    own = df.where(~any_null(keys)).select(_word(keys, rows).alias("word"), _mask(keys).alias("mask"))
    every = spark.range(rows * WORDS).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
    words = own.unionByName(every).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    entries = F.array_sort(F.collect_list(F.struct("word", "mask")))
    return words.groupBy(F.floor(F.col("word") / WORDS).alias("filter_row")).agg(
        F.transform(entries, lambda e: e["mask"]).alias("words")
    )


def with_maybe(df: DataFrame, keys: list[str], bloom: DataFrame, rows: int, name: str) -> DataFrame:
    """``df`` with a flag: false where the filter rules the key out. Null keys are ruled out."""
    word, mask = _word(keys, rows), _mask(keys)
    place = F.floor(word / WORDS)
    # every row number is there, so the inner join keeps all rows; at most MOST_BYTES are broadcast
    joined = df.join(F.broadcast(bloom), place == bloom["filter_row"])
    bits = F.element_at("words", (F.pmod(word, F.lit(WORDS)) + 1).cast("int"))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (~any_null(keys) & (bits.bitwiseAND(mask) == mask)).alias(name))


def missing_rows_filtered(
    batch: DataFrame, target: DataFrame, keys: list[str], most_bytes: int = MOST_BYTES
) -> DataFrame:
    """``missing_rows`` for a batch with one row per key, with filters before the shuffle.

    Rows with a null key are left out, as there. The target's keys are read three
    times (count, filter, join), the batch's three times and its rows once; each
    filter is built once.
    """
    name = "_maybe_known"
    while name in batch.columns:
        name = "_" + name
    n_target = target.where(~any_null(keys)).count()
    rows = filter_rows(n_target, most_bytes)
    bloom = kept(key_filter(target.select(*keys), keys, rows))
    flagged = with_maybe(batch.where(~any_null(keys)), keys, bloom, rows, name)
    certain = flagged.where(~F.col(name)).drop(name)
    open_ones = flagged.where(F.col(name)).drop(name)
    n_open = open_ones.select(*keys).count()
    if not n_open:
        return certain
    back = filter_rows(n_open, most_bytes)
    wanted = with_maybe(target.select(*keys), keys, kept(key_filter(open_ones.select(*keys), keys, back)), back, name)
    candidates = wanted.where(F.col(name)).drop(name)
    return certain.unionByName(missing_rows(open_ones, candidates.distinct(), keys, unique=True))
