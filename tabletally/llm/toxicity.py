"""Toxicity scores from class-conditional Kneser-Ney models.

Two language models, of toxic and of ordinary labelled texts, are compared by
length-normalised log-likelihood. They are interpolated Kneser-Ney models over
the bytes of words (``ORDER`` bytes with the word's borders): a text's
likelihood is that of its words, and an expression that was rarely or never
seen is judged by the parts it shares with others, as inflected forms do.

With h the bytes before x and h' the same without the first,

    P_c(x|h) = (1 - g_h) max(c_c(hx) - D, 0) / sum over x + g_h P_c(x|h')
    g_h      = D * kinds(h) / count(h)

The highest order counts texts (of each distinct word, how many texts of the
class have it), lower orders count continuations (in how many different
contexts the class shows the bytes), the lowest order those of both classes
together. The discount of each order follows from its counts of counts,
D = n1 / (n1 + 2 n2). Backoff is *shared*: the weights g come from both classes'
counts, and a class that never saw h uses both classes' counts after h. So where
neither class has counted hx, both probabilities are g_h times the shorter ones,
g_h cancels, and the log ratio of x is that of the longest counted end of hx.
One number per counted expression is the whole model.

Counting is a Spark aggregate over distinct words of all labelled texts, each
text once however many copies it has; all expressions counted there score. Their
numbers (12 bytes each) are broadcast below a checked size; beyond it the words
of all texts are joined with them. Log ratios are fixed-point integers, so sums
are the same in any order and both ways give the same scores.

Per text the words' ratios give a few figures: their mean over the text (the
length-normalised log-likelihood ratio), the largest, and how much stands above
some levels. A logistic function makes them a probability. It is fitted on
figures of all labelled texts, each from a model that has not counted the text's
third of the labels.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from .common import free_name, learns, reliable, table, with_text_columns

#: ASCII letters and bytes of other scripts are word characters; the rest separates.
WORD_BYTES = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
#: Bytes of the longest and of the shortest expression that tells the classes apart.
ORDER, LEAST = 5, 3
FOLDS = 3
UNIT = 1 << 16  # of a log ratio
MOST = 12 * UNIT  # of a word's log ratio: beyond it, more counts are no more evidence
#: Levels of a word's log ratio above which its excess is added up.
LEVELS = (UNIT, 2 * UNIT, 3 * UNIT)
SUMS = ("total", "n", "top", "kinds", *(f"above{i}" for i in range(len(LEVELS))))
#: Most bytes of expressions that are broadcast, and of small label tables.
BROADCAST_BYTES = 64 << 20
CHARS_AT_ONCE = 1 << 20
WORDS_KEPT = 1 << 19
#: Most texts of a class that the logistic function is fitted on: those of least hash.
SAMPLE = 20_000


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(WORD_BYTES).split()


def windows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The last ORDER bytes at every byte of the words and at the border behind each, as numbers; and the word's place."""
    pad = b" " * (ORDER - 1)
    chars = np.frombuffer(b"".join([pad + w + b" " for w in words]), np.uint8).astype(np.int64)
    lengths = np.array([len(w) + 1 for w in words], np.int64)
    keys = np.zeros(len(chars), np.int64)
    for back in range(ORDER):
        keys[ORDER - 1 :] |= chars[ORDER - 1 - back : len(chars) - back] << (8 * back)
    inside = np.ones(len(chars), bool)
    starts = np.cumsum(lengths + ORDER - 1) - lengths
    inside[(starts[:, None] - np.arange(1, ORDER)).ravel()] = False
    return keys[inside], np.repeat(np.arange(len(words)), lengths)


def tagged(keys: np.ndarray | Column, level: int) -> np.ndarray | Column:
    """An expression of ``level`` bytes as one number, its length in front."""
    if isinstance(keys, Column):
        return keys.bitwiseOR(F.lit(level << 8 * ORDER))
    return keys | (level << 8 * ORDER)


class Ratios:
    """Log ratios of words from the sorted expressions and their ratios; remembers words."""

    def __init__(self, keys: np.ndarray, ratios: np.ndarray):
        self.keys, self.ratios, self.known = keys, ratios, {}

    def learn(self, words: list[bytes]) -> None:
        keys, of = windows(words)
        out, open_ones = np.zeros(len(keys), np.int64), np.arange(len(keys))
        for level in range(ORDER, LEAST - 1, -1):  # the longest counted end decides
            wanted = tagged(keys[open_ones] & ((1 << 8 * level) - 1), level)
            at = np.minimum(np.searchsorted(self.keys, wanted), max(len(self.keys) - 1, 0))
            hit = self.keys[at] == wanted if len(self.keys) else np.zeros(len(wanted), bool)
            out[open_ones[hit]] = self.ratios[at[hit]]
            open_ones = open_ones[~hit]
        sums = np.zeros(len(words), np.int64)
        np.add.at(sums, of, out)
        self.known.update(zip(words, np.clip(sums, -MOST, MOST).tolist(), strict=True))

    def sums(self, texts: list[str]) -> np.ndarray:
        """Per text the columns of ``SUMS``; zeros without words."""
        out = np.zeros((len(texts), len(SUMS)), np.int64)
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= CHARS_AT_ONCE):
                size += len(texts[end])
                end += 1
            counts = [Counter(words_of(t)) for t in texts[start:end]]
            new = set(chain.from_iterable(counts)) - self.known.keys()
            if new:
                self.learn(sorted(new))
            for i, words in enumerate(counts, start):
                if words:
                    r = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
                    times = np.fromiter(words.values(), np.int64, len(words))
                    above = [np.maximum(r - level, 0).sum() for level in LEVELS]
                    out[i] = [(r * times).sum(), times.sum(), r.max(), len(r), *above]
            if len(self.known) > WORDS_KEPT:
                self.known = {}
            start = end
        return out


def figures(sums: np.ndarray) -> np.ndarray:
    """Figures of the texts' sums (columns of ``SUMS``) that the logistic function takes."""
    total, n, top, kinds, *above = sums.T / np.where(np.isin(SUMS, ("n", "kinds")), 1, UNIT)[:, None]
    return np.column_stack([
        total / np.maximum(n, 1), top, np.log1p(above[0]), np.log1p(above[2]), above[1] / np.maximum(kinds, 1),
    ])


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> np.ndarray:
    """Ridge logistic regression on standardised columns by damped Newton steps.

    Returns the weights for the columns as given; the last one is the constant.
    """
    if not len(x):
        return np.zeros(x.shape[1] + 1)
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    ridge = penalty * np.diag([1.0] * x.shape[1] + [1e-2])

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, z @ w).sum() - y @ (z @ w) + w @ ridge @ w / 2)

    w = np.zeros(z.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (y - p) - ridge @ w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, gradient)
        size = 1.0
        while size > 1e-6 and loss(w + size * step) > loss(w) - 1e-4 * size * (gradient @ step):
            size /= 2
        w += size * step
        if size * np.abs(step).max() < 1e-6:
            break
    weights = w[:-1] / spread
    return np.append(weights, w[-1] - weights @ mean)


def count_expressions(labelled: DataFrame) -> DataFrame:
    """(key, fold, c0, c1): of each class's words, in how many texts, every window of ORDER bytes occurs.

    ``labelled`` has the columns text, label (0 or 1) and fold, a row per distinct text.
    """

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {}
            for text, label, fold in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for w in set(words_of(text or "")):
                    counts.setdefault((w, fold), [0, 0])[label] += 1
            if counts:
                words, folds = zip(*counts, strict=True)
                c0, c1 = zip(*counts.values(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.binary()), pa.array(folds, pa.int64()), pa.array(c0, pa.int64()), pa.array(c1, pa.int64())],
                    names=["word", "fold", "c0", "c1"],
                )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, of = windows(batch.column(0).to_pylist())
            fold, c0, c1 = (c.to_numpy()[of] for c in batch.columns[1:])
            kinds, at = np.unique(keys * FOLDS + fold, return_inverse=True)
            sums = [np.bincount(at, c).astype(np.int64) for c in (c0, c1)]
            columns = [kinds // FOLDS, kinds % FOLDS, *sums]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "fold", "c0", "c1"])

    totals = [F.sum("c0").alias("c0"), F.sum("c1").alias("c1")]
    words = labelled.select("text", "label", "fold").mapInArrow(count_words, "word binary, fold long, c0 long, c1 long")
    words = words.groupBy("word", "fold").agg(*totals)
    return words.mapInArrow(spread, "key long, fold long, c0 long, c1 long").groupBy("key", "fold").agg(*totals)


def log_ratios(counts: DataFrame) -> DataFrame:
    """(variant, key, ratio) of all expressions of LEAST to ORDER bytes.

    ``counts`` has a row (variant, key, c0, c1) per window. Expressions with the
    same context are at most as many as there are bytes, and so are those with
    the same end, so no group or join key is large.
    """
    level_rows = {ORDER: counts.where("c0 + c1 > 0")}
    for level in range(ORDER - 1, LEAST - 2, -1):
        end = F.col("key").bitwiseAND(F.lit((1 << 8 * level) - 1))
        above = level_rows[level + 1]
        level_rows[level] = above.groupBy("variant", end.alias("key")).agg(
            F.count_if(F.col("c0") > 0).alias("c0"), F.count_if(F.col("c1") > 0).alias("c1")
        )
    context = Window.partitionBy("variant", F.shiftright("key", 8))
    both = F.col("c0") + F.col("c1")
    chances = level_rows[LEAST - 1].select(
        "variant", F.col("key").alias("end"), (both / F.sum(both).over(context)).alias("q0")
    ).withColumn("q1", F.col("q0"))
    out = None
    for level in range(LEAST, ORDER + 1):
        rows = level_rows[level]
        # counts of counts: one row a variant
        seen = rows.groupBy("variant").agg(F.count_if(both == 1).alias("n1"), F.count_if(both == 2).alias("n2"))
        discount = F.greatest(F.lit(0.05), F.least(F.lit(0.95), F.coalesce(F.expr("try_divide(n1, n1 + 2 * n2)"), F.lit(0.5))))
        sized = rows.join(F.broadcast(seen.select("variant", discount.alias("d"))), "variant")
        less = {c: F.greatest(v - F.col("d"), F.lit(0.0)) for c, v in (("0", F.col("c0")), ("1", F.col("c1")), ("b", both))}
        sums = sized.select(
            "variant", "key", F.col("key").bitwiseAND(F.lit((1 << 8 * (level - 1)) - 1)).alias("end"),
            *[v.alias(f"a{c}") for c, v in less.items()], *[F.sum(v).over(context).alias(f"s{c}") for c, v in less.items()],
            F.least(F.lit(1.0), F.greatest(F.lit(1e-6), F.col("d") * F.count(F.lit(1)).over(context) / F.sum(both).over(context))).alias("g"),
        )
        joined = sums.join(chances, ["variant", "end"])
        chance = {}
        for c in "01":
            two = (
                F.when(F.col(f"s{c}") > 0, F.col(f"a{c}") / F.col(f"s{c}"))
                .when(F.col("sb") > 0, F.col("ab") / F.col("sb"))
                .otherwise(F.col(f"q{c}"))
            )
            chance[c] = (1 - F.col("g")) * two + F.col("g") * F.col(f"q{c}")
        found = reliable(joined.select("variant", "key", chance["0"].alias("p0"), chance["1"].alias("p1")))
        chances = found.select("variant", F.col("key").alias("end"), F.col("p0").alias("q0"), F.col("p1").alias("q1"))
        ratio = F.round((F.log("p1") - F.log("p0")) * UNIT).cast("int")
        part = found.select("variant", tagged(F.col("key"), level).alias("key"), ratio.alias("ratio"))
        out = part if out is None else out.unionByName(part)
    return out


def packed(df: DataFrame, variant: int) -> tuple[np.ndarray, np.ndarray]:
    """A variant's expressions, sorted, and their ratios, as arrays on the driver."""
    rows = df.where(F.col("variant") == variant).select("key", "ratio").toArrow()
    keys, ratios = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    order = np.argsort(keys)
    return keys[order], ratios[order]


def joined_sums(df: DataFrame, text: str, ratios: DataFrame) -> DataFrame:
    """(_hash, the columns of ``SUMS``) of every text that has words, by joins with the expressions (key, ratio)."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, name in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = Counter(words_of(text or ""))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(found)), pa.array(found, pa.binary()), pa.array(found.values(), pa.int64())],
                        names=["_hash", "word", "times"],
                    )

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_pylist()
            if found:
                windowed, of = windows(found)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), pa.array(windowed)], names=["word", "window"])

    # copies of a text say the same
    rows = df.select(text, F.xxhash64(text)).mapInArrow(words, "_hash long, word binary, times long")
    rows = reliable(rows.groupBy("_hash", "word").agg(F.max("times").alias("times")))
    spelled = rows.select("word").distinct().mapInArrow(keys, "word binary, window long")
    # each window once: the longest counted end decides
    ends = spelled.select("window").distinct().select("window", F.explode(F.array(*[
        F.struct(F.lit(n).alias("level"), tagged(F.col("window").bitwiseAND(F.lit((1 << 8 * n) - 1)), n).alias("key"))
        for n in range(LEAST, ORDER + 1)
    ])).alias("e")).select("window", "e.level", "e.key")
    best = ends.join(ratios, "key").groupBy("window").agg(F.max_by("ratio", "level").alias("ratio"))
    of_word = spelled.join(best, "window", "left").groupBy("word").agg(F.coalesce(F.sum("ratio"), F.lit(0)).alias("r"))
    of_word = of_word.withColumn("r", F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.col("r"))))
    r = F.col("r")
    return rows.join(of_word, "word").groupBy("_hash").agg(
        F.sum(r * F.col("times")).alias("total"), F.sum("times").alias("n"), F.max("r").alias("top"), F.count(F.lit(1)).alias("kinds"),
        *[F.sum(F.greatest(r - level, F.lit(0))).alias(f"above{i}") for i, level in enumerate(LEVELS)],
    )


def with_sums(
    df: DataFrame, text: str, ratios: DataFrame, sent: Broadcast | None, outputs: StructType,
    work: Callable[[np.ndarray], list], keep: list[str] | None,
) -> DataFrame:
    """``df`` with columns that ``work`` computes from the sums of its texts."""
    if sent is not None:
        def make() -> Callable[[list[str]], list]:
            known = Ratios(*sent.value)
            return lambda texts: work(known.sums(texts))

        return with_text_columns(df, text, outputs, make, keep)
    names = df.columns if keep is None else keep
    mark = free_name(df, "_hash")
    found = joined_sums(df, text, ratios).withColumnRenamed("_hash", mark)
    rows = df.select(*[F.col(f"`{c}`") for c in names], F.xxhash64(text).alias(mark)).join(found, mark, "left")
    new = {f.name.lower() for f in outputs}
    kept = [f for f in df.select(*[F.col(f"`{c}`") for c in names]).schema if f.name.lower() not in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.column_stack([c.fill_null(0).to_numpy() for c in batch.columns[len(kept) :]]).astype(np.int64)
            made = [pa.array(c) for c in work(sums.reshape(-1, len(SUMS)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *made], names=[*(f.name for f in kept), *outputs.names])

    return rows.select(*[F.col(f"`{f.name}`") for f in kept], *SUMS).mapInArrow(run, StructType([*kept, *outputs]))


def score_toxicity(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    keep: list[str] | None = None, broadcast_bytes: int = BROADCAST_BYTES, sample: int = SAMPLE,
) -> DataFrame:
    """The columns ``keep`` of ``df`` (all if None) with ``score``: the probability of label 1.

    Learns from rows of ``labels`` whose key may be learnt from: all of them are
    counted. Labels, language, source and key never enter a score.
    ``broadcast_bytes`` tells only how the counted expressions get to the texts;
    ``sample`` bounds the texts of each class that the logistic function is
    fitted on.

    Defined cases: a null or empty text, or one without letters, has no
    evidence and gets the constant of the logistic function; null labels and
    keys are not learnt from; a text labelled both ways counts in both classes;
    without labels of both classes every score is 0; repeated rows get equal
    scores; a column of ``df`` named ``score`` is replaced, others may have any
    name; texts are read whole; an empty table gives no rows.
    """
    outputs = StructType().add("score", DoubleType())
    known = labels.where(learns(F.col(key)) & F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(label).cast("long").alias("label")
    )
    # one row per text and label, so that copies count once
    texts = df.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_hash"))
    first = reliable(texts.join(known, "_key").groupBy("_hash", "label").agg(F.min("_key").alias("_key")))
    classes = {r["label"]: r["count"] for r in first.groupBy("label").count().collect()}
    if len(classes) < 2:
        return with_text_columns(df, text, outputs, lambda: lambda texts: [[0.0] * len(texts)], keep)
    # 24 bytes a row: broadcast up to a checked size, joined by shuffle beyond it
    once = F.broadcast(first) if sum(classes.values()) * 24 <= broadcast_bytes else first
    own = df.select(F.col(key).alias("_key"), F.col(text).alias("text"), F.xxhash64(text).alias("_hash"))
    # rows that repeat a key and a text are one
    learnt = own.join(once, ["_key", "_hash"]).withColumn("fold", F.pmod("_hash", F.lit(FOLDS)))
    unique = learnt.groupBy("_hash", "label").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    if not unique.isEmpty():
        learnt = learnt.dropDuplicates(["_hash", "label"])
    counts = reliable(count_expressions(learnt))
    # variant FOLDS counts all, variant f leaves fold f out
    variants = counts.select(
        "key", F.explode(F.array(*[F.struct(F.lit(v).alias("variant"), F.col("fold").alias("fold"), "c0", "c1") for v in range(FOLDS + 1)])).alias("x")
    ).select("key", "x.*").where("variant != fold")
    ratios = reliable(log_ratios(variants.groupBy("variant", "key").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))))
    sizes = {r["variant"]: r["count"] for r in ratios.groupBy("variant").count().collect()}
    context = df.sparkSession.sparkContext

    def model(variant: int) -> tuple[DataFrame, Broadcast | None]:
        mine = ratios.where(F.col("variant") == variant).select("key", "ratio")
        fits = sizes.get(variant, 0) * 12 <= broadcast_bytes
        return mine, context.broadcast(packed(ratios, variant)) if fits else None

    shape = StructType()
    for name in SUMS:
        shape = shape.add(name, LongType())
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64(F.lit("sample"), "_hash"), "_hash"))
    chosen = learnt
    if max(classes.values()) > sample:
        least = first.withColumn("_rank", rank).where(F.col("_rank") <= sample).select("_hash", "label")
        chosen = learnt.join(F.broadcast(least), ["_hash", "label"], "left_semi")  # 16 bytes for each text of the sample
    parts = [
        with_sums(chosen.where(F.col("fold") == f).select("text", "label"), "text", *model(f), shape, lambda sums: list(sums.T), ["label"]).toArrow()
        for f in range(FOLDS)
    ]
    rows = np.column_stack([pa.concat_tables(parts).column(c).to_numpy() for c in ("label", *SUMS)])
    rows = rows[np.lexsort(rows.T[::-1])]  # the same weights whatever order the rows came in
    weights = fit_logistic(figures(rows[:, 1:]), rows[:, 0].astype(float))

    def probability(sums: np.ndarray) -> list:
        return [1 / (1 + np.exp(-np.clip(figures(sums) @ weights[:-1] + weights[-1], -30, 30)))]

    return with_sums(df, text, *model(FOLDS), outputs, probability, keep)


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document's toxicity score."""
    scores = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
    return scores.select(
        "doc_id", (~learns(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
