"""A corpus pipeline over ``documents``: the stages call the operators of ``tabletally.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of ``documents``. An empty table passes every stage as an
empty table; columns beside ``doc_id``, ``text``, ``source`` and ``n_chars`` are
carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabletally.llm.bpe import encode_decode
from tabletally.llm.common import remove_folder, shared_folder, table
from tabletally.llm.mixing import mix, training_order
from tabletally.llm.secrets import redact
from tabletally.llm.simhash import keep_representatives
from tabletally.llm.toxicity import score_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic (0.5 or more) go; all other rows stay as they are.

    Null and empty texts have no evidence and stay unless most labelled texts
    are toxic; repeated rows go or stay together; null ids are not learnt from;
    texts are read whole. Without labels of both classes every document stays.
    """
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col("score") < 0.5).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one with the least doc_id.

    Null and empty texts are one class; of equal rows one stays; null ids come
    last; among texts of one id the one of least hash stays; texts are read whole.
    """
    return keep_representatives(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts and ``n_chars`` is counted again; every document stays.

    A null text stays null with its ``n_chars``; empty texts, null ids and null
    sources pass; repeated rows are changed alike; texts are read whole.
    """
    return redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order: a document stands there once per copy taken.

    A null text has no words and is taken as its source's share asks; null
    sources are a source of their own; repeated rows are separate documents;
    ties of position follow the row's hash; texts are never cut.
    """
    return training_order(mix(docs))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document (packed little-endian 32-bit), and a digest of what they decode to.

    Null and empty texts have no ids; null ids and repeated rows give a row each;
    texts are read whole.
    """
    coded = encode_decode(docs, keep=["doc_id", "source"])
    return coded.select(
        "doc_id", "source", F.col("bpe_count").alias("n_tokens"), "bpe_ids",
        F.sha2(F.col("bpe_text").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("mixing", mixing),
    ("bpe", encoding),
]

#: Models and components have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to ``documents``. A stage's output goes once the next one is written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            remove_folder(spark, last)
        docs, last = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
