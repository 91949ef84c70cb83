from __future__ import annotations

import random
import re
import zlib

import numpy as np

from tabletally.llm import toxicity

SF = "/root/testdata/sf0.001"
WORDS = [a + b + c for a in ("ba", "ko", "ri", "tu", "ne") for b in ("la", "mi", "so", "du") for c in ("n", "r", "s", "t")]
BAD = ["grumok", "grumoks", "grumoky", "vlachen", "vlachers", "vlachish"]


def corpus(n=600, seed=3):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        words = draw.choices(WORDS, k=draw.randint(20, 120))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(draw.randint(2, 5)):
                words.insert(draw.randrange(len(words)), draw.choice(BAD))
        rows.append((i, " ".join(words).capitalize(), int(toxic)))
    return rows


def score(spark, rows, extra=(), **kw):
    docs = spark.createDataFrame([r[:2] for r in rows] + list(extra), "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    return toxicity.score_toxicity(docs, labels, **kw)


def test_held_out_accuracy_and_unseen_forms(spark):
    rows = corpus()
    clean = " ".join(WORDS[:50])
    extra = [(10_000, clean), (10_001, clean + " vlacheness " + clean + " grumokal"), (10_002, " ".join([clean] * 200) + " grumok vlachen")]
    got = {r.doc_id: r.score for r in score(spark, rows, extra).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    right = [(got[i] >= 0.5) == bool(t) for i, _, t in held]
    assert len(held) > 80 and np.mean(right) > 0.97
    assert got[10_000] < 0.5 <= got[10_001] and got[10_002] >= 0.5  # forms never seen; two words in a long text


def test_labels_of_held_out_rows_are_not_read(spark):
    rows = corpus(200)
    flipped = [(i, t, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, t, y in rows]
    a = sorted((r.doc_id, r.score) for r in score(spark, rows).collect())
    b = sorted((r.doc_id, r.score) for r in score(spark, flipped).collect())
    assert a == b


def test_copies_count_once(spark):
    rows = corpus(200)
    copies = [(1000 + i, rows[1][1], rows[1][2]) for i in range(300) if zlib.crc32(str(1000 + i).encode()) % 5]
    a = {r.doc_id: r.score for r in score(spark, rows).collect()}
    b = {r.doc_id: r.score for r in score(spark, rows + copies).collect()}
    assert all(abs(a[i] - b[i]) < 1e-9 for i in a)


def test_scores_do_not_depend_on_how_the_model_reaches_the_texts(spark):
    rows = corpus()
    extra = [(10_000 + i, r[1] + " " + rows[i + 1][1]) for i, r in enumerate(rows[:50])] + [(20_000, rows[0][1])] * 3 + [(30_000, None), (30_001, "")]
    whole = sorted((r.doc_id, r.score) for r in score(spark, rows, extra).collect())
    joined = sorted((r.doc_id, r.score) for r in score(spark, rows, extra, broadcast_bytes=0).collect())
    assert len(joined) == len(rows) + len(extra) and joined == whole


def test_odd_texts(spark):
    rows = corpus(200)
    extra = [(9000, None), (9001, ""), (9002, " \n"), (9003, "123 !!"), (9004, "nan " * 200_000), (None, "baln"), (9005, "x" * 600_000), (9005, "x" * 600_000)]
    got = score(spark, rows, extra).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r.score <= 1 for r in got)
    same = {r.score for r in got if r.doc_id in (9000, 9001, 9002, 9003)}
    assert len(same) == 1 and same.pop() < 0.5
    assert len({r.score for r in got if r.doc_id == 9005}) == 1
    docs = spark.createDataFrame([(1, "a b", "x")], "doc_id long, text string, SCORE string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.asDict() for r in toxicity.score_toxicity(docs, none).collect()] == [{"doc_id": 1, "text": "a b", "score": 0.0}]
    assert toxicity.score_toxicity(docs.limit(0), none).count() == 0


def test_sums_do_not_depend_on_the_batch(monkeypatch):
    keys = np.sort(np.unique(np.concatenate([toxicity.tagged(toxicity.windows([w.encode() for w in WORDS])[0] & ((1 << 8 * n) - 1), n) for n in (3, 4, 5)])))
    ratios = np.random.default_rng(1).integers(-99_999, 99_999, len(keys))
    texts = [t for _, t, _ in corpus(40)] + ["", "x" * 50_000, "baln " * 50]
    whole = toxicity.Ratios(keys, ratios).sums(texts)
    monkeypatch.setattr(toxicity, "CHARS_AT_ONCE", 300)
    monkeypatch.setattr(toxicity, "WORDS_KEPT", 5)
    assert (toxicity.Ratios(keys, ratios).sums(texts) == whole).all()
    assert (whole[-3] == 0).all() and whole[-1][1] == 50


def slow_model(rows):
    """Kneser-Ney probabilities by the formulas, with dictionaries: expression -> (P_ordinary, P_toxic)."""
    counts = {}
    for text, label in rows:
        for word in set(re.findall(rb"[a-z\x80-\xff]+", text.lower().encode())):
            padded = b"    " + word + b" "
            for i in range(5, len(padded) + 1):
                counts.setdefault(padded[i - 5 : i], [0, 0])[label] += 1
    levels = {5: counts}
    for n in (4, 3, 2):
        levels[n] = {}
        for gram, c in levels[n + 1].items():
            lower = levels[n].setdefault(gram[1:], [0, 0])
            for k in (0, 1):
                lower[k] += c[k] > 0
    chance = {g: [sum(c) / sum(sum(d) for h, d in levels[2].items() if h[:-1] == g[:-1])] * 2 for g, c in levels[2].items()}
    found = {}
    for n in (3, 4, 5):
        n1, n2 = (sum(sum(c) == k for c in levels[n].values()) for k in (1, 2))
        d = min(max(n1 / (n1 + 2 * n2) if n1 + n2 else 0.5, 0.05), 0.95)
        by_context = {}
        for g, c in levels[n].items():
            by_context.setdefault(g[:-1], []).append(c)
        new = {}
        for g, c in levels[n].items():
            after = by_context[g[:-1]]
            weight = min(max(d * len(after) / sum(map(sum, after)), 1e-6), 1.0)
            p = []
            for k in (0, 1):
                mine = sum(max(x[k] - d, 0) for x in after)
                pool = sum(max(sum(x) - d, 0) for x in after)
                own = max(c[k] - d, 0) / mine if mine else max(sum(c) - d, 0) / pool if pool else chance[g[1:]][k]
                p.append((1 - weight) * own + weight * chance[g[1:]][k])
            new[g] = p
        found |= new
        chance = new
    return found


def test_log_ratios_against_the_formulas(spark):
    rows = [(t, y) for _, t, y in corpus(60)] + [("Übel übler schön", 1), ("schöne Übung", 0)]
    df = spark.createDataFrame([(t, y, i % 3) for i, (t, y) in enumerate(rows)], "text string, label long, fold long").repartition(3)
    counts = toxicity.count_expressions(df).groupBy("key").agg({"c0": "sum", "c1": "sum"}).toDF("key", "c0", "c1")
    got = {r.key: r.ratio for r in toxicity.log_ratios(counts.selectExpr("3 AS variant", "key", "c0", "c1")).collect()}
    expected = {}
    for g, (p0, p1) in slow_model(rows).items():
        key = len(g) << 40 | int.from_bytes(g, "big")
        expected[key] = (np.log(p1) - np.log(p0)) * toxicity.UNIT
    assert got.keys() == expected.keys()
    assert max(abs(got[k] - expected[k]) for k in got) <= 0.6


def test_query_covers_all_documents(spark):
    got = toxicity.op3_toxicity(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.collect())
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5)
