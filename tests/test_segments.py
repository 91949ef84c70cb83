from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabletally.operators.pairs_json import pairs_to_json
from tabletally.operators.segments import pairs_to_json_segments

DDL = "g string, k string, v string, pos int"


def joined(rows):
    """Group -> its object, put together from the segments."""
    parts = {}
    for r in sorted(rows, key=lambda r: r["segment"]):
        parts.setdefault(r["g"], []).append(r)
    for group in parts.values():
        assert [r["segment"] for r in group] == list(range(1, group[0]["n_segments"] + 1))
    return {g: "{" + ",".join(r["json"][1:-1] for r in group if r["json"] != "{}") + "}" for g, group in parts.items()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", None, ""]), st.sampled_from(["k1", "k2", "k3", "k 4", None, 'q"']),
                  st.sampled_from(["x", "y", None]), st.integers(0, 5) | st.none()),
        max_size=60,
    ),
    st.integers(1, 4),
)
def test_concatenation_equals_the_plain_fold(spark, rows, size):
    df = spark.createDataFrame(rows, DDL).repartition(3)
    expected = {r["g"]: r["json"] for r in pairs_to_json(df, ["g"], "k", "v", "pos").collect()}
    got = pairs_to_json_segments(df, ["g"], "k", "v", "pos", size).collect()
    assert joined(got) == expected
    assert all(len(json.loads(r["json"])) <= size for r in got)


def test_a_hot_group_lies_in_several_tasks(spark):
    rows = spark.range(30_000).selectExpr("IF(id % 3 = 0, 'hot', CAST(id % 50 AS string)) AS g", "CAST(id AS string) AS k", "'v' AS v", "CAST(id AS int) AS pos")
    got = pairs_to_json_segments(rows, ["g"], "k", "v", "pos", 1000)
    by_group = {}
    for r in got.collect():
        by_group.setdefault(r["g"], []).append(r)
    assert sorted(len(json.loads(r["json"])) for r in by_group["hot"]) == [1000] * 10
    assert {r["n_keys"] for r in by_group["hot"]} == {10_000}
    keys = [k for r in sorted(by_group["hot"], key=lambda r: r["segment"]) for k in json.loads(r["json"])]
    assert keys == [str(i) for i in range(0, 30_000, 3)]


def test_bad_size(spark):
    with pytest.raises(ValueError):
        pairs_to_json_segments(spark.createDataFrame([], DDL), ["g"], "k", "v", "pos", 0)
