from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from tabletally.llm import topk

SF = "/root/testdata/sf0.001"
DDL = "extra string, vec_id long, embedding array<float>, asker int, score int"


def brute(rows: list[tuple], every: int = 100, k: int = 10, scale: int = 1024) -> list[tuple]:
    """(query_id, rank, vec_id, score) by comparing each query with every row."""
    kept = []
    for vec_id, vector in rows:
        if vector is not None and all(c is not None and math.isfinite(c) for c in vector):
            kept.append((vec_id, [math.floor(scale * float(np.float32(c))) for c in vector]))
    out = []
    for i, (q, x) in enumerate(kept):
        if q is None or q % every:
            continue
        scores = [
            (-sum(a * b for a, b in zip(x, y, strict=False)), c is None, c or 0, c)
            for j, (c, y) in enumerate(kept) if j != i
        ]
        out += [(q, rank, c, -s) for rank, (s, _, _, c) in enumerate(sorted(scores, key=lambda t: t[:3])[:k], 1)]
    return sorted(out, key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame([("x", a, b, 1, 2) for a, b in rows], DDL).repartition(3)
    return sorted((tuple(r) for r in topk.top_k(df, **options).collect()), key=repr)


def test_query_equals_its_sql(spark):
    got = topk.op11_topk(spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    rel = con.execute(topk.OP11_SQL)
    assert [d[0] for d in rel.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(rel.fetchall())


def test_odd_rows(spark):
    rows = [
        (0, [0.5, -0.5]), (100, [0.5, -0.5]), (1, [0.25, 0.25]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]),
        (5, [float("inf"), 1.0]), (6, []), (7, [0.75]), (None, [0.5, -0.5]), (200, [0.0, 0.0]), (200, [0.5, -0.5]),
        (8, [-0.5, 0.5]), (8, [-0.5, 0.5]), (300, []), (400, None), (-100, [-3.0, 0.001]),
    ]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(100, None)]) == []
    assert run(spark, [(100, [1.0])]) == []


def test_hot_copies_ties_and_several_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "VALUES_IN_SHARD", 2048)
    rng = np.random.default_rng(5)
    hot = rng.normal(size=8).tolist()
    rows = [(i, hot if i % 3 == 0 else rng.normal(size=8).tolist()) for i in range(1500)]
    assert run(spark, rows, lane=4) == brute(rows)


def test_values_beyond_doubles_stay_exact(spark):
    rows = [(100 * i, [3e5 + i, -2e5, 1e4 * i]) for i in range(20)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("n, spread", [(4000, 0.02)])
def test_pruning_skips_blocks_and_changes_nothing(spark, n, spread, monkeypatch):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(20, 16))
    values = np.floor(1024 * (centres[rng.integers(0, 20, n)] + spread * rng.normal(size=(n, 16)))).astype(np.int64)
    order = np.lexsort([values[:, d] >= 0 for d in range(16)][::-1])
    values = values[order]
    shard, scored = topk.Shard(16), []
    for start in range(0, n, topk.ROWS_IN_BLOCK):
        part = values[start : start + topk.ROWS_IN_BLOCK]
        ids = np.arange(start, start + len(part))
        shard.add(start, ids.tobytes(), np.zeros(len(part), bool).tobytes(), part.tobytes(), len(part), 16)
    score = shard.score
    monkeypatch.setattr(shard, "score", lambda q, o, rows, b, kth: scored.append(len(rows)) or score(q, o, rows, b, kth))
    asks = np.arange(0, n, 100)
    found = shard.search(topk.Vectors(values[asks]), asks, np.full(len(asks), topk.LEAST), 10)
    products = values[asks] @ values.T
    products[np.arange(len(asks)), asks] = -(10**15)
    for i in range(len(asks)):
        best = sorted(zip(-products[i], range(n), strict=True))[:10]
        assert [(-s, r) for s, r in best] == [(s, r) for q, s, _, _, r in found.tolist() if q == i]
    assert sum(scored) < 0.5 * len(asks) * len(shard.blocks)
