"""Secret scans: candidates by pattern, false positives removed by a random forest.

DataFrame and SQL operations (with the DataFrame API's random forest) only.

1. Candidates: in words that hold a long enough run of key characters with a
   digit or mixed case, each such run. ``key=value`` runs give the value. Also
   every match of a provider format, and every value after a secret-like name,
   whatever its letters and length.
2. Features: length; character classes and the transitions between them;
   dictionary coverage (the share of the run in words that many distinct texts
   of the corpus hold outside candidates); path (marks of paths and addresses in the run, and the file path of
   the document); neighbouring words (how much more often the word before and
   after stands at secrets than at other findings, over all labelled findings).
3. Labelled findings train the forest. Where the caller has none, labelling
   rules name the sure cases: provider formats and assignments to
   secret-like names are secrets; addresses, numbers, versions and dictionary
   words are not. Everything else is left for the forest to judge. Neither the
   rules' outcome nor whether a value is assigned is a feature, and a labelled
   finding's neighbours are judged by findings of other values. At most ``sample`` labelled findings per class
   train it, those of least hash: a documented bound of the training set.
4. All candidates are judged by the forest.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, free_name, reliable, table

#: What a candidate is.
RUN = r"[A-Za-z0-9_+/=.@:~-]{8,}"
MARKED = r"[0-9]|[a-z][A-Z]"
MARKED_RUN = rf"(?<![A-Za-z0-9_+/=.@:~-])(?=[A-Za-z0-9_+/=.@:~-]*?(?:{MARKED})){RUN}"
LEAST_SHARE = 1e-4  # of the distinct texts, held by a word of the dictionary
BROADCAST_BYTES = 32 << 20
ASSIGNED = r"^([A-Za-z_][A-Za-z0-9_.-]*)[=:]+(.{6,})$"
#: The labelling rules.
SECRET_FORMATS = (
    r"^(?:AKIA|ASIA)[0-9A-Z]{16}$", r"^gh[pousr]_[A-Za-z0-9]{36}$", r"^xox[abprs]-[A-Za-z0-9-]{10,}$",
    r"^[sr]k_(?:live|test)_[A-Za-z0-9]{16,}$", r"^AIza[A-Za-z0-9_-]{35}$", r"^eyJ[A-Za-z0-9_=-]+\.[A-Za-z0-9_=-]+",
)
SECRET_NAMES = r"^(?:.*_)?(?:passwd|password|pwd|secret|token|apikey|api_key|access_key|auth|credential)s?$"
ORDINARY = (
    r"^[^@]+@[A-Za-z0-9.-]+\.[A-Za-z]+$", r"^[0-9.:+/-]+$", r"^[a-z]+://",
)
WORDED = r"^[A-Za-z.'-]+$"
#: Candidates of any letters: provider formats, and what is assigned to a secret-like name in the last word of a text.
FORMATS = "(?<![A-Za-z0-9])(?:" + "|".join(f.strip("^$") for f in SECRET_FORMATS) + ")(?![A-Za-z0-9])"
NAMES = r"(?:passwd|password|passphrase|pwd|secret|token|api_?key|access_key|auth|credential)s?(?:_?key)?(?:_[a-z0-9]+)*"
NAMED = rf"(?i){NAMES}[\"']?\s*[=:]"
NAMED_VALUE = rf"(?i){NAMES}[\"']?\s*[=:]+>?\s*[\"'`(]*([^\s\"'`<>,;&(){{}}\[\]]+)(?=\S*$)"
#: Character classes for transitions.
CLASSES = {"l": "a-z", "u": "A-Z", "d": "0-9"}

FEATURES = (
    "length", "distinct", "digits", "upper", "lower", "longest_letters",
    "lu", "ld", "ul", "ud", "dl", "du", "coverage",
    "slashes", "dots", "ats", "path_depth", "path_test",
    "quoted", "before_odds", "after_odds",
)
#: Parts of the labelled findings, by value: a finding's neighbours are judged by the other parts.
FOLDS = 5


def may_hold(text: Column) -> Column:
    """False for texts without candidates."""
    return text.rlike(MARKED) | text.rlike(FORMATS) | text.rlike(NAMED)


def candidates(df: DataFrame, key: str, text: str, path: str | None) -> DataFrame:
    """One row per candidate: key, word_no, value, before, after, assigned, quoted, path.

    ``explode_outer`` and a test of the exploded value, because a plain explode
    lets the optimizer derive a filter on the array, which would split the text
    once more for every word.
    """
    docs = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                     (F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")).alias("path"))
    words = F.col("words")

    def wanted(i: Column) -> Column:
        word = F.try_element_at(words, i)
        tail = F.concat_ws(" ", F.get(words, i - 3), F.get(words, i - 2), word)
        return (
            (F.length(word) >= 8) & word.rlike(MARKED) & word.rlike(RUN)
            | F.col("has_format") & word.rlike(FORMATS) | F.col("has_name") & tail.rlike(NAMED_VALUE)
        )

    marked = (
        docs.where(may_hold(F.col("text")))
        .withColumn("has_format", F.col("text").rlike(FORMATS)).withColumn("has_name", F.col("text").rlike(NAMED))
        .withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
        .withColumn("at", F.filter(F.sequence(F.lit(1), F.size(words)), wanted))
        .select("key", "path", F.explode_outer(F.transform("at", lambda i: F.struct(
            i.alias("word_no"), F.get(words, i - 3).alias("far"), F.get(words, i - 2).alias("near"),
            F.get(words, i - 1).alias("word"), F.get(words, i).alias("next")))).alias("f"))
        .where(F.col("f").isNotNull())
        .select("key", "path", "f.*")
    )
    found = F.filter(F.regexp_extract_all("word", F.lit(f"({RUN})"), F.lit(1)), lambda run: run.rlike(MARKED))
    values = F.transform(found, lambda run: F.regexp_replace(F.regexp_replace(run, ASSIGNED, "$2"), r"[.:]+$", ""))
    sure = F.concat(
        F.regexp_extract_all("word", F.lit(f"({FORMATS})"), F.lit(1)),
        F.transform(F.regexp_extract_all(F.concat_ws(" ", "far", "near", "word"), F.lit(NAMED_VALUE), F.lit(1)),
                    lambda v: F.regexp_replace(v, r"[.:?!]+$", "")),
    )
    more = F.filter(F.array_except(sure, values), lambda v: v.rlike("[A-Za-z0-9]"))
    runs = marked.withColumn("sure", more).withColumn("f", F.explode(F.concat(
        F.transform(found, lambda run: F.struct(run.alias("run"), F.lit(False).alias("whole"))),
        F.transform("sure", lambda v: F.struct(v.alias("run"), F.lit(True).alias("whole"))),
    ))).select("*", "f.*")
    named = F.when(F.col("whole"), "").otherwise(F.regexp_extract("run", ASSIGNED, 1))
    front = F.expr("substring_index(word, run, 1)")
    split = (
        runs.withColumn("name", named)
        .withColumn("value", F.regexp_replace(F.when(F.col("name") != "", F.regexp_extract("run", ASSIGNED, 2)).otherwise(F.col("run")), r"[.:]+$", ""))
        .withColumn("lead", F.concat_ws(" ", "far", "near", front, "name"))
    )
    return split.select(
        "key", "path", F.col("word_no").cast("long").alias("word_no"), "value",
        F.regexp_extract(F.lower("lead"), r"([a-z_]{2,})[^a-z_]*$", 1).alias("before"),
        F.regexp_extract(F.lower(F.coalesce("next", F.lit(""))), r"([a-z_]{2,})", 1).alias("after"),
        ((F.col("name") != "") | F.col("lead").rlike(r"[=:]\s*[\"']?\s*$")).cast("double").alias("assigned"),
        F.expr("substring_index(word, value, 1)").rlike(r"[\"']$").cast("double").alias("quoted"),
    ).where(F.col("whole") | F.col("value").rlike(MARKED))


def dictionary(df: DataFrame, text: str, least: int) -> DataFrame:
    """Lower-case words of at least three letters in ``least`` distinct texts or more,
    and in a ``LEAST_SHARE`` of them; words within candidates do not count."""
    texts = df.select(F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    number = df.select(F.xxhash64(F.coalesce(F.col(text), F.lit("")))).distinct().count()
    plain = F.lower(F.regexp_replace("text", MARKED_RUN, " "))
    words = F.array_distinct(F.regexp_extract_all(plain, F.lit(r"[a-z]{3,}"), F.lit(0)))
    counted = texts.select(F.explode_outer(words).alias("run")).where(F.col("run").isNotNull()).groupBy("run").count()
    return counted.where(F.col("count") >= max(least, LEAST_SHARE * number)).select("run")


def coverage(values: DataFrame, words: DataFrame) -> DataFrame:
    """(value, coverage): the share of each distinct value that lies in dictionary words."""
    runs = values.select("value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit(r"[a-z]{3,}"), F.lit(0))).alias("run"))
    return runs.join(words, "run").groupBy("value").agg((F.sum(F.length("run")) / F.length("value")).alias("coverage"))


def share(pattern: str) -> Column:
    return F.regexp_count("value", F.lit(pattern)) / F.length("value")


def plain_features() -> dict[str, Column]:
    value = F.col("value")
    runs = F.transform(F.regexp_extract_all(value, F.lit("[A-Za-z]+"), F.lit(0)), F.length)
    return {
        "length": F.length(value).cast("double"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
        "digits": share("[0-9]"), "upper": share("[A-Z]"), "lower": share("[a-z]"),
        "longest_letters": F.coalesce(F.array_max(runs), F.lit(0)) / F.length(value),
        **{a + b: share(f"(?<=[{x}])(?=[{y}])") for a, x in CLASSES.items() for b, y in CLASSES.items() if a != b},
        "slashes": F.regexp_count(value, F.lit("[/~]")).cast("double"),
        "dots": F.regexp_count(value, F.lit("[.:]")).cast("double"),
        "ats": F.regexp_count(value, F.lit("@")).cast("double"),
        "path_depth": F.regexp_count("path", F.lit("[/]")).cast("double"),
        "path_test": F.lower("path").rlike("test|example|sample|fixture|mock|doc").cast("double"),
    }


def rule_label() -> Column:
    """1 for sure secrets, 0 for sure others, null for the rest."""
    value = F.col("value")
    formats = value.rlike("|".join(SECRET_FORMATS))
    assigned = (F.col("assigned") == 1) & F.col("before").rlike(SECRET_NAMES) & value.rlike("[0-9]")
    # letters after a secret-like name may be a password: the forest judges them
    named = (F.col("assigned") == 1) & F.col("before").rlike(f"{NAMES}$")
    worded = value.rlike(WORDED) | (F.col("coverage") >= 0.8)
    return F.when(formats, 1).when(value.rlike("|".join(ORDINARY)) | worded & ~named, 0).when(assigned & ~worded, 1)


def fold() -> Column:
    return F.pmod(F.xxhash64("value"), F.lit(FOLDS))


def odds(labelled: DataFrame, column: str, prior: float = 5.0) -> DataFrame:
    """(word, odds_fold, log odds of standing at a secret, against those of all findings), shrunk by 2 ``prior`` imagined usual findings.

    The row of fold f leaves the findings of that part out, so that a finding's
    own label says nothing about it; fold -1 counts all, for unlabelled rows.
    """
    n, secret = labelled.agg(F.count(F.lit(1)), F.sum("label")).first()
    usual = secret / n
    by_fold = labelled.groupBy(column, fold().alias("odds_fold")).agg(F.sum("label").alias("s"), F.count(F.lit(1)).alias("n"))
    # a word has at most FOLDS rows
    word = Window.partitionBy(column)
    rest = by_fold.select(column, "odds_fold", (F.sum("s").over(word) - F.col("s")).alias("s"), (F.sum("n").over(word) - F.col("n")).alias("n"))
    whole = by_fold.groupBy(column).agg(F.lit(-1).cast("long").alias("odds_fold"), F.sum("s").alias("s"), F.sum("n").alias("n"))
    positive, negative = F.col("s") + 2 * prior * usual, F.col("n") - F.col("s") + 2 * prior * (1 - usual)
    return rest.unionByName(whole).select(
        column, "odds_fold", (F.log(positive / negative) - F.log(F.lit(usual / (1 - usual)))).alias(f"{column}_odds")
    )


def scan(
    df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = "source", findings: DataFrame | None = None,
    sample: int = 5000, trees: int = 20, depth: int = 6, seed: int = 11, least: int = 20,
) -> DataFrame:
    """Every candidate of every text: key, word_no (from 1), value, label (of the rules, if any), probability, is_secret.

    ``findings`` may give labelled findings (value, before, after, label);
    they then train the forest together with their features here instead of the rules' labels.

    Defined cases: null or empty texts have no candidates; a null path is the
    empty path; repeated rows and repeated candidates are judged alike and all
    returned; without labelled findings of both classes there is no forest and
    the labels themselves decide (unlabelled: no secret); texts are read whole.
    """
    found = reliable(candidates(df, key, text, path))
    covered = coverage(found.select("value").distinct(), dictionary(df, text, least))
    rows = found.join(covered, "value", "left").na.fill(0.0, ["coverage"]).withColumns(plain_features())
    if findings is None:
        rows = rows.withColumn("label", rule_label().cast("double"))
    else:
        # findings that say both of one value and place follow the majority; a tie is no label
        said = F.avg(F.col("label").cast("double"))
        given = findings.groupBy("value", "before", "after").agg(F.when(said > 0.5, 1.0).when(said < 0.5, 0.0).alias("label"))
        rows = rows.join(given, ["value", "before", "after"], "left")
    rows = reliable(rows)

    order = F.xxhash64("value", "before", "after", "key", "word_no")
    labelled = [rows.where(F.col("label") == c).orderBy(order, "value", "word_no").limit(sample) for c in (0, 1)]
    learnt = reliable(labelled[0].union(labelled[1]))
    classes = {r["label"] for r in learnt.select("label").distinct().collect()}
    if len(classes) < 2:
        sure = F.coalesce("label", F.lit(0.0))
        return rows.select(F.col("key").alias(key), "word_no", "value", "label", sure.alias("probability"), sure.cast("int").alias("is_secret"))
    sides = {}
    for column in ("before", "after"):
        table_of = reliable(odds(rows.where(F.col("label").isNotNull()), column))
        small = table_of.agg(F.sum(F.length(column) + 64)).first()[0] <= BROADCAST_BYTES
        sides[column] = F.broadcast(table_of) if small else table_of

    def with_neighbours(part: DataFrame) -> DataFrame:
        for column, table_of in sides.items():
            own = F.when(F.col("label").isNull(), F.lit(-1).cast("long")).otherwise(fold())
            part = part.withColumn("odds_fold", own).join(table_of, [column, "odds_fold"], "left").na.fill(0.0, [f"{column}_odds"])
        return part

    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt"
    )
    ready = assembler.transform(with_neighbours(learnt)).select("features", "label", order.alias("_order")).coalesce(1).sortWithinPartitions("_order")
    model = forest.fit(ready.select("features", "label"))
    judged = model.transform(assembler.transform(with_neighbours(rows)))
    return judged.select(
        F.col("key").alias(key), "word_no", "value", "label",
        vector_to_array("probability")[1].alias("probability"), F.col("prediction").cast("int").alias("is_secret"),
    )


def redact(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = "source", mark: str = "[secret]", **options) -> DataFrame:
    """``df`` with every secret that the scan finds replaced by ``mark`` in its text; no row is dropped.

    A secret is replaced wherever it stands in a text of its key. Texts without
    candidates do not take part in any shuffle. Null and empty texts, null keys,
    repeated rows and empty tables come out as they are; other columns may have
    any name.
    """
    of, values = free_name(df, "_of"), free_name(df, "_secrets")
    secrets = (
        scan(df, key, text, path, **options).where("is_secret = 1")
        .groupBy(F.col(key).alias(of)).agg(F.array_sort(F.collect_set("value"), longest_first).alias(values))
    )
    secrets = reliable(secrets)
    may = F.coalesce(may_hold(F.col(text)), F.lit(False))
    cleaned = F.aggregate(F.coalesce(values, F.array().cast("array<string>")), F.col(text), lambda t, s: F.replace(t, s, F.lit(mark)))
    columns = [cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in df.columns]
    changed = df.where(may).join(secrets, F.col(key).eqNullSafe(F.col(of)), "left").select(*columns)
    return df.where(~may).unionByName(changed)


def longest_first(a: Column, b: Column) -> Column:
    """So that a secret that is part of another does not spoil it."""
    return F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0)


def op10_secrets(spark, sf_dir: str) -> DataFrame:
    """Every candidate in the documents with the forest's verdict."""
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "word_no", F.length("value").cast("long").alias("length"), F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"),
        "probability", "is_secret",
    )
