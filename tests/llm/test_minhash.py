from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tabletally.llm import minhash

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in minhash.op2_minhash(spark, SF).collect()}
    assert len(got) == len(docs)
    errors = []
    for i, d in enumerate(docs):
        follows = docs[(i + 1) % len(docs)].text
        quarter = len(d.text) // 4
        changed = d.text[: len(d.text) - quarter] + follows[:quarter]
        r = got[d.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(d.text), hashlib.sha256(changed.encode()).hexdigest())
        errors += [r.near_edited - similar(d.text, changed), r.near_next - similar(d.text, follows)]
        assert all(0 <= x <= 1 for x in (r.near_edited, r.near_next))
    assert abs(sum(errors) / len(errors)) < 0.01
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.05
    by_text = {}
    for d in docs:
        assert by_text.setdefault(d.text, got[d.doc_id].fingerprint) == got[d.doc_id].fingerprint


def test_query_runs_no_python(spark):
    plan = minhash.op2_minhash(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


ODD = [None, "", "  \n\t ", "one", "one two three four", "a b c d e", "x " * 30_000, "word" * 50_000, "é ü 日本 x y z"]


def test_odd_texts_and_clashing_columns(spark):
    rows = [(i, t, "w", "h") for i, t in enumerate(ODD + ["one"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, _words string, _HASHES string")
    got = {r.doc_id: r for r in minhash.with_fingerprint(df, "text", "fp").collect()}
    assert [got[i].fp for i in range(3)] == ["", "", ""]
    assert got[3].fp == got[9].fp != got[4].fp and got[3]._words == "w"
    assert all(len(got[i].fp) == 2 * minhash.BINS for i in range(3, 9))
    assert minhash.with_fingerprint(df.limit(0), "text", "fp").count() == 0


def test_a_single_shingle_differs_from_another(spark):
    df = spark.createDataFrame([("a",), ("b",)], "text string")
    a, b = [r.fp for r in minhash.with_fingerprint(df, "text", "fp").orderBy("text").collect()]
    near = spark.range(1).select(minhash.likeness(F.lit(a), F.lit(b)).alias("x")).first().x
    assert near < 0.1


@pytest.mark.parametrize("keys", [[], [7], [3, 1, 2], [None, 5, -2], list(range(1000))])
def test_successors(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: r.next for r in minhash.successors(df, "k").collect()}
    ordered = sorted(keys, key=lambda k: (k is not None, k or 0))
    assert got == {k: ordered[(i + 1) % len(ordered)] for i, k in enumerate(ordered)}
