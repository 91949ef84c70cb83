from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabletally.llm import quality_classifier, quality_rules, textstats

SF = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def slow_counts(text: str) -> dict:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside),
    }


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab #|é\n\t\x1c\xa0", max_size=60))
def test_counts(text):
    got = dict(zip(textstats.NAMES, textstats.counts(text), strict=True))
    want = slow_counts(text)
    assert {k: got[k] for k in want} == want


def test_rules_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = quality_rules.op4_rules(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        want = slow_counts(texts[r.doc_id])
        assert {k: r[k] for k in want} == want
        assert r.base_failed == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
        assert not (r.base_failed and r.kept) and (r.distance is None) == r.base_failed


def test_rules_keep_clean_documents_and_reject_junk(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    got = [r for r in quality_rules.op4_rules(spark, SF_MID).collect() if r.doc_id in labels and not r.base_failed]
    assert all(r.kept == bool(labels[r.doc_id]) for r in got) and len(got) > 300


def test_concentration_equals_numpy(spark):
    """One step of the estimate against the same step with plain arrays."""
    draw = np.random.default_rng(5)
    x = draw.normal(0, 0.2, (400, quality_rules.P))
    x[:100] += 3  # a quarter far away
    names = [f"x{i}" for i in range(quality_rules.P)]
    cells = spark.createDataFrame([("g", *map(float, row)) for row in x], "_group string, " + ", ".join(f"{n} double" for n in names))
    start = quality_rules.with_precision(quality_rules.medians(cells))
    first = start.first()
    floors = np.diag(np.square(list(quality_rules.FLOORS.values())))
    cov = np.diag([first["cov"][k] for k, (i, j) in enumerate(quality_rules.PAIRS) if i == j])
    off = x - np.array(first["mean"])
    distance = np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov + floors), off)
    near = x[distance <= np.sort(distance)[len(x) // 2 - 1]]
    got = quality_rules.concentrate(cells, start, 1).first()
    assert np.allclose(got["mean"], near.mean(axis=0), atol=1e-6)
    full = np.cov(near.T, bias=True) * quality_rules.CONSISTENCY
    assert np.allclose(got["cov"], [full[i, j] for i, j in quality_rules.PAIRS], atol=1e-6)
    assert (np.abs(got["mean"]) < 0.2).all()  # the far quarter has no say


def test_rules_on_odd_tables(spark):
    words = " ".join(f"word{i % 37}x{i}" for i in range(120))
    rows = [(1, None, None, None, "x"), (2, "", "en", "s", "x"), (3, words, None, None, "x"), (3, words, None, None, "x"),
            (None, words + " end", "en", "s", "x"), (5, "a b c " * 20_000, "en", "s", "x"), (6, "w" * 100_000, "en", None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, KEPT string")
    got = quality_rules.apply_rules(df, keep=["doc_id"]).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id: r.kept for r in got}
    assert kept == {1: False, 2: False, 3: True, None: True, 5: False, 6: False}
    assert quality_rules.apply_rules(df.limit(0), keep=["doc_id"]).count() == 0
    assert quality_rules.apply_rules(df.where("doc_id < 3"), keep=["doc_id"]).count() == 2


def test_a_group_of_copies_does_not_become_the_usual_case(spark):
    draw = np.random.default_rng(2)
    clean = [" ".join(draw.choice(["alpha", "beta", "gamma", "delta", "of", "the", "it,", "so."], 90)) for _ in range(60)]
    odd = " ".join(f"### {w} $$$" for w in draw.choice(["one", "two", "three", "four", "five", "sixes"], 90))
    rows = [(i, t, "en", "s") for i, t in enumerate(clean + [odd] * 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.apply_rules(df, keep=["doc_id"]).where("not base_failed").collect()}
    assert all(k == (i < 60) for i, k in kept.items())


def test_cells_weigh_their_distinct_texts(spark):
    """100 texts in one cell and 20 of one cell each: the usual case is the dense cell; copies of another do not count."""
    rows = [("g", i, 0.0) for i in range(100)] + [("g", 100 + i, 0.1 * i) for i in range(1, 21)] + [("g", 500, 2.5)] * 300
    df = spark.createDataFrame([(g, "l", h, *[x] * quality_rules.P) for g, h, x in rows],
                               "_source string, _lang string, _hash long, " + ", ".join(f"x{i} double" for i in range(quality_rules.P)))
    got = quality_rules.estimate(df, steps=1).first()
    assert max(abs(m) for m in got["mean"]) < 1e-6


def test_chi_square():
    assert abs(quality_rules.chi2_quantile(0.999, 8) - 26.124) < 0.01
    assert abs(quality_rules.chi2_cdf(2.0, 2) - (1 - np.exp(-1))) < 1e-12


def test_classifier_query(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    got = quality_classifier.op5_quality(spark, SF_MID).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_normal_equations_equal_numpy(spark):
    draw = np.random.default_rng(1)
    x, y = draw.normal(size=(500, len(quality_classifier.STATISTICS))), draw.integers(0, 2, 500)
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in quality_classifier.STATISTICS) + ", label double")
    basis = quality_classifier.Features([0.0] * x.shape[1], [1.0] * x.shape[1], 20, 3.0, 1)
    gram, target = quality_classifier.normal_equations(df.repartition(5), basis)
    z = basis.of(x)
    assert np.allclose(gram, z.T @ z) and np.allclose(target, z.T @ y)
    # the features' products approximate the kernel
    wide = quality_classifier.Features([0.0] * x.shape[1], [1.0] * x.shape[1], 20_000, 3.0, 1).of(x[:20])[:, :-1]
    far = ((np.clip(x[:20], -4, 4)[:, None] - np.clip(x[:20], -4, 4)[None]) ** 2).sum(-1)
    assert np.abs(wide @ wide.T - np.exp(-far / 18)).max() < 0.05


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 5), st.floats(0, 1)), min_size=1, max_size=15))
def test_isotonic(pairs):
    number = np.array([float(n) for n, _ in pairs])
    positives = np.array([round(n * p) for n, p in pairs], float)
    score = np.arange(len(pairs), dtype=float)
    knots, values = quality_classifier.isotonic(score, positives, number)
    assert (np.diff(knots) > 0).all() and (np.diff(values) >= 0).all() and ((values >= 0) & (values <= 1)).all()
    # least squares among rising steps, by the minimax formula
    fit = [max(min(positives[a : b + 1].sum() / number[a : b + 1].sum() for b in range(i, len(pairs))) for a in range(i + 1)) for i in range(len(pairs))]
    assert len(knots) == len(np.unique(np.round(fit, 9)))


def test_classifier_on_odd_tables(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (4, "a b"), (4, "a b"), (5, "w " * 50_000), (6, "x" * 100_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, SCORE string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_classifier.score_quality(df, none).collect()
    assert len(got) == len(rows) and {r.score for r in got} == {0.5}
    some = spark.createDataFrame([(i, i % 2) for i in range(1, 7)] + [(2, None)], "doc_id long, quality int")
    got = quality_classifier.score_quality(df, some).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 4}) == 1
    assert quality_classifier.score_quality(df.limit(0), some).count() == 0


@pytest.mark.parametrize("text", ["", "\n\n", "a\na\n a", "x x x x x"])
def test_counts_of_small_texts(text):
    want = slow_counts(text)
    got = dict(zip(textstats.NAMES, textstats.counts(text), strict=True))
    assert {k: got[k] for k in want} == want
