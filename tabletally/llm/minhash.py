"""Document fingerprints by one-permutation MinHash, in DataFrame operations only.

Every 5-word shingle is hashed once. The top bits of the hash choose one of
``BINS`` bins, the least hash of a bin is its value. A bin without shingles
borrows the value of a filled bin by optimal densification: each empty bin
draws its own random order of all bins and takes the first filled one, so
borrowing adds no correlation. Of every value, scrambled with its bin's number so that
bins with the same borrowed value stay independent, the low 8 bits are stored:
two hex digits a bin. Two fingerprints agree by chance in 1 of 256 bins, which
the likeness corrects for.

All of it runs on arrays inside one row; fingerprints need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, free_name, reliable, table

BINS = 128
BIN_SHIFT = 57  # 64 - log2(BINS)
SHINGLE = 5
CHANCE = 1 / 256  # that the stored bits of different values agree


def with_fingerprint(df: DataFrame, text: str, output: str, shingle: int = SHINGLE) -> DataFrame:
    """``df`` with the fingerprint of its column ``text`` in column ``output``.

    Words are runs without ASCII white space, as they are. A text of fewer
    words than a shingle is one shingle; a text without words (or null) has the
    empty fingerprint. Texts are read whole. A column named like the output is
    replaced.
    """
    words, hashes, filled, bins = (free_name(df, name) for name in ("_words", "_hashes", "_filled", "_bins"))
    w, h, f, held = F.col(words), F.col(hashes), F.col(filled), F.col(bins)
    count = F.size(w)
    windows = F.transform(F.sequence(F.lit(1), count - shingle + 1), lambda i: F.xxhash64(F.slice(w, i, shingle)))
    hashed = F.when(count >= shingle, windows).when(count > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<long>"))
    bin_of = lambda x: F.shiftright(x, BIN_SHIFT)  # noqa: E731  from -BINS / 2 to BINS / 2 - 1
    # sorted hashes: the first one of each bin is its least
    least = F.filter(h, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(h, i - 1))))

    def entry(b: Column, x: Column) -> Column:
        """The bin's number above its stored bits."""
        return F.shiftleft(b + BINS // 2, 8).bitwiseOR(F.xxhash64(x, b).bitwiseAND(255))

    def borrowed(b: Column) -> Column:
        # the filled bin that comes first in this bin's own random order; the low bits carry its index
        order = F.array_min(F.transform(held, lambda c, i: F.xxhash64(b, c).bitwiseAND(-BINS).bitwiseOR(i.cast("long"))))
        return F.get(f, order.bitwiseAND(BINS - 1).cast("int"))

    every = F.sequence(F.lit(-BINS // 2).cast("long"), F.lit(BINS // 2 - 1).cast("long"))
    own = F.transform(f, lambda x, i: entry(F.get(held, i), x))
    others = F.transform(F.array_except(every, held), lambda b: entry(b, borrowed(b)))
    values = F.when(F.size(f) == BINS, own).otherwise(F.sort_array(F.concat(own, others)))
    packed = F.array_join(F.transform(values, lambda e: F.lpad(F.hex(e.bitwiseAND(255)), 2, "0")), "")
    return (
        df.withColumn(words, F.transform(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0)), lambda x: F.xxhash64(x)))
        .withColumn(hashes, F.sort_array(hashed))
        .withColumn(filled, least)
        .withColumn(bins, F.transform(f, bin_of))
        .withColumn(output, F.when(F.size(f) > 0, F.lower(packed)).otherwise(F.lit("")))
        .drop(words, hashes, filled, bins)
    )


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles of two fingerprints, 0 to 1; two empty texts are alike."""
    same = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.substr(a, 2 * i + 1, F.lit(2)) == F.substr(b, 2 * i + 1, F.lit(2))))
    corrected = (same / BINS - CHANCE) / (1 - CHANCE)
    return (
        F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0)
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), corrected)))
    )


def successors(df: DataFrame, key: str) -> DataFrame:
    """(key, next) over the distinct rows of ``df`` by ascending key (null first); after the last comes the first.

    Range-sorted rows are numbered per partition, partition offsets are added;
    the only window without a partition has one row per sorted partition.
    """
    placed = reliable(df.orderBy(key).withColumn("_id", F.monotonically_increasing_id()))
    parts = placed.groupBy(F.shiftright("_id", 33).alias("_part")).count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    ranked = (
        placed.withColumn("_part", F.shiftright("_id", 33)).join(offsets, "_part")
        .withColumn("_rank", F.col("_offset") + F.col("_id").bitwiseAND((1 << 33) - 1)).drop("_id", "_part", "_offset")
    )
    total = placed.count()
    after = ranked.select(F.col(key).alias("next"), F.pmod(F.col("_rank") - 1, F.lit(max(total, 1))).alias("_rank"))
    return ranked.join(after, "_rank").drop("_rank")


def edited(text: Column, n: Column, head: Column) -> Column:
    """``text`` (n code points) with its last quarter replaced by as much of ``head``."""
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), (n - quarter).cast("int")), F.substring(head, F.lit(1), quarter))


def op2_minhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text; likeness to the edited text and to the next document.

    Where several rows share a doc_id, the text of least hash stands for it as
    the next document.

    Texts are shuffled once, by doc_id: that exchange serves the join that tells
    every document how much of it the one before needs, and the join with those
    beginnings. Each text is fingerprinted once; fingerprints travel on their own.
    """

    def key(column: str) -> list[Column]:
        """A nullable id as two columns that join by plain equality."""
        return [F.coalesce(column, F.lit(0).cast("long")).alias("_k"), F.col(column).isNull().alias("_n")]

    keys = ["_k", "_n"]
    doc_id = F.when(~F.col("_n"), F.col("_k"))
    docs = table(spark, sf_dir, "documents").select(*key("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    stands = docs.groupBy(*keys).agg(F.floor(F.max(F.length("text")) / 4).cast("int").alias("wanted"), F.min(F.xxhash64("text")).alias("_hash"))
    follows = reliable(successors(stands.select(doc_id.alias("doc_id"), "wanted", "_hash"), "doc_id"))
    to = [c.alias(n) for c, n in zip(key("doc_id"), ("_to_k", "_to_n"), strict=True)]
    sends = follows.select(*key("next"), *to, "wanted").join(follows.select(*key("doc_id"), F.col("_hash").alias("_stands")), keys)

    prints = with_fingerprint(docs.withColumn("_hash", F.xxhash64("text")), "text", "_fp")
    prints = reliable(prints.select(*keys, "_hash", F.unhex("_fp").alias("fp")))
    heads = (
        # the hashes are compared after the join: as a join key they would need a shuffle of their own
        docs.join(sends, keys).where(F.xxhash64("text").bitwiseXOR(F.col("_stands")) == 0)
        .select(F.col("_to_k").alias("_k"), F.col("_to_n").alias("_n"), F.substring("text", F.lit(1), F.col("wanted")).alias("head"))
        .dropDuplicates(keys)  # of equal rows
    )
    rows = docs.join(heads, keys).withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", edited(F.col("text"), F.col("n_chars"), F.col("head")))
    rows = with_fingerprint(rows, "edited", "edited_fingerprint").select(
        *keys, F.xxhash64("text").alias("_hash"), "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "edited_fingerprint",
    )
    shown = lambda c: F.lower(F.hex(c))
    texts = prints.select(*keys, "_hash", "fp").dropDuplicates([*keys, "_hash"])  # one per id and text
    after = sends.select(F.col("_to_k"), F.col("_to_n"), *keys, F.col("_stands").alias("_hash")).join(texts, [*keys, "_hash"])
    after = after.select(F.col("_to_k").alias("_k"), F.col("_to_n").alias("_n"), F.col("fp").alias("next_fp"))
    return (
        rows.join(texts, [*keys, "_hash"]).join(after, keys)
        .withColumn("fingerprint", shown("fp"))
        .select(
            doc_id.alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
            likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
            likeness(F.col("fingerprint"), shown("next_fp")).alias("near_next"),
        )
    )
