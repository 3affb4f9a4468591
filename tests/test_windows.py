"""Sliding windows over blocks with halos, against plain slicing."""

import random

import pytest

from loomframe.operators import sequences


@pytest.mark.parametrize("length, stride, each", [(3, 1, 8), (5, 2, 1), (4, 7, 1), (1, 1, 2), (6, 4, 2)])
def test_windows_equal_plain_slices(spark, monkeypatch, length, stride, each):
    monkeypatch.setattr(sequences, "WINDOWS_EACH", each)
    rng = random.Random(length)
    runs = {"a": 57, "b": length, "c": length - 1, None: 23, "d": 1}
    data = [(run, i, rng.random() if rng.random() < 0.9 else None, f"k{run}") for run, n in runs.items() for i in range(n)]
    df = spark.createDataFrame(data, "run string, t long, x double, kind string").repartition(3)
    got = sequences.sliding_windows(df, ["run"], ["t"], length, stride, ["x", "t"], keep=["kind"])
    assert got.columns == ["run", "kind", "start", "x", "t"]
    want = []
    for run, n in runs.items():
        own = [r for r in data if r[0] == run]
        want += [(run, f"k{run}", s, [r[2] for r in own[s:s + length]], list(range(s, s + length)))
                 for s in range(0, n - length + 1, stride)]
    key = lambda r: (str(r[0]), r[2])
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)


def test_rows_go_to_two_blocks_at_most(spark):
    """Whatever the stride, the blocks hold little more than the rows."""
    df = spark.range(4_000).selectExpr("1 AS run", "id AS t", "id * 1.0D AS x")
    found = sequences.sliding_windows(df, ["run"], ["t"], 50, 1, ["x"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2 and found.count() == 3_951
    moved = spark.range(4_000).selectExpr("CASE WHEN id % 400 < 49 AND id >= 400 THEN 2 ELSE 1 END AS n").agg({"n": "sum"})
    assert moved.first()[0] < 1.15 * 4_000
