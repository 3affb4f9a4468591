"""Quantiles by radix selection and densities by the fast Gauss transform, against plain sums."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.operators import boosting, distributions, quantiles

PROBS = {"least": 0.0, "a": 0.1, "median": 0.5, "b": 0.937, "most": 1.0}


def values(kind, rng):
    return {"normal": lambda: rng.gauss(5, 2), "ties": lambda: float(rng.randrange(4)), "equal": lambda: 2.5,
            "wide": lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300),
            "close": lambda: 1.0 + rng.randrange(1 << 20) * 2.0 ** -52,
            "zeros": lambda: rng.choice([0.0, -0.0, 5e-324, -5e-324, 1.0])}[kind]()


@pytest.mark.parametrize("few, cells, shipped", [(1_000_000, 4096, 10_000), (10, 4, 10_000), (0, 2, 0)])
def test_quantiles_are_exact(spark, monkeypatch, few, cells, shipped):
    """With few cells, many passes; with nothing shipped, buckets are joined by key."""
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "CELLS", cells)
    monkeypatch.setattr(quantiles, "SHIPPED", shipped)
    rng = random.Random(few)
    kinds = ["normal", "ties", "equal", "wide", "close", "zeros"] if few else ["normal", "ties"]
    data = [(rng.choice(["g", "h", None]), *[values(k, rng) if rng.random() < 0.9 else None for k in kinds])
            for _ in range(500)] + [("empty", *[None for _ in kinds]), ("one", *[7.0 for _ in kinds])]
    df = spark.createDataFrame(data, "g string, " + ", ".join(f"{k} double" for k in kinds)).repartition(3)
    got = {(r["g"], r["column"]): r for r in quantiles.column_summary(df, kinds, PROBS, ["g"]).collect()}
    for i, kind in enumerate(kinds, 1):
        for g in ("g", "h", None, "one"):
            own = np.sort([r[i] for r in data if r[0] == g and r[i] is not None])
            r = got[g, kind]
            assert r["count"] == len(own)
            for name, p in PROBS.items():
                at = (len(own) - 1) * p
                lo, hi = own[math.floor(at)], own[math.ceil(at)]
                assert r[name] == (lo if lo == hi else lo + (hi - lo) * (at - math.floor(at)))
            if kind != "wide":
                assert math.isclose(r["mean"], own.mean(), rel_tol=1e-9, abs_tol=1e-12)
                assert r["std"] is None if len(own) == 1 else math.isclose(r["std"], own.std(ddof=1), rel_tol=1e-6, abs_tol=1e-12)
    assert ("empty", "normal") not in got
    assert quantiles.column_summary(df.filter("false"), kinds, PROBS).collect() == []


def test_codes_keep_the_order(spark):
    rng = random.Random(1)
    xs = sorted([rng.choice([-1, 1]) * 2 ** rng.uniform(-1074, 1023) for _ in range(2_000)] + [
        0.0, 5e-324, -5e-324, math.inf, -math.inf, 1.0, 2.0, math.nextafter(2.0, 0), -1.0, 1.7976931348623157e308])
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").coalesce(1).select(
        quantiles.code(F.col("x"))).collect()]
    assert got == sorted(got)
    with_nan = spark.createDataFrame([(float("nan"),), (1.0,), (3.0,)], "x double")
    assert math.isnan(quantiles.exact_quantiles(with_nan, ["x"], {"m": 1.0}).first()["m"])


@pytest.mark.parametrize("tolerance", [1e-6, 1e-13])
def test_density_is_within_its_bound(spark, tolerance):
    rng = random.Random(4)
    xs = [rng.gauss(0, 1) for _ in range(400)] + [rng.uniform(50, 60) for _ in range(50)] + [3.0] * 100 + [1e12, -1e12]
    df = spark.createDataFrame([(x,) for x in [*xs, None, float("nan")]], "x double").repartition(3)
    width, grid = 0.37, [-5 + 0.25 * i for i in range(300)] + [3.0]
    got = {r["x"]: r["density"] for r in distributions.kde(df, "x", grid, width, tolerance).collect()}
    assert sorted(got) == sorted(set(grid))
    top = 1 / (width * math.sqrt(2 * math.pi))
    for g in got:
        direct = sum(math.exp(-((g - x) / width) ** 2 / 2) for x in xs) * top / len(xs)
        assert abs(got[g] - direct) <= 2 * tolerance * top + 1e-15
    nothing = spark.createDataFrame([(None,)], "x double")
    assert distributions.kde(nothing, "x", grid, width).collect() == []


def test_hermite_terms_stay_below_their_bound():
    order = distributions.hermite_order(1e-13)
    for t in np.linspace(-6, 6, 121):
        h, last, total = math.exp(-t * t), 0.0, 0.0
        u = 0.5 / math.sqrt(2)
        for n in range(order):
            total += u ** n / math.factorial(n) * h
            last, h = h, 2 * t * h - 2 * n * last
        assert abs(total - math.exp(-(t - u) ** 2)) <= 1e-13


@pytest.mark.parametrize("right", [False, True])
def test_histogram_of_odd_values(spark, right):
    edges = [0.0, 1.0, 2.5, 4.0]
    xs = [None, float("nan"), -1.0, 0.0, 0.5, 1.0, 2.5, 3.0, 4.0, 4.1, math.inf, -math.inf]
    data = [("a", x) for x in xs] + [("b", None), (None, 1.0)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {}
    for r in distributions.histogram(df, "x", edges, by=["g"], right=right).collect():
        got.setdefault(r["g"], []).append((r["bin"], r["count"], r["below"], r["above"]))
    bins = [(0, 3, 2, 3), (1, 1, 2, 3), (2, 2, 2, 3)] if right else [(0, 2, 2, 3), (1, 1, 2, 3), (2, 3, 2, 3)]
    assert sorted(got["a"]) == bins
    assert sorted(got["b"]) == [(k, 0, 0, 0) for k in range(3)]
    assert sorted(r[:2] for r in got[None]) == ([(0, 1), (1, 0), (2, 0)] if right else [(0, 0), (1, 1), (2, 0)])


def plain_tree(bins, g, h, columns, s):
    """Leaf-wise growth on whole arrays: list of (rows, value), in no order."""
    def best(rows):
        found = None
        for c in columns:
            for last in range(bins.max() + 1):
                left = rows[bins[rows, c] <= last]
                right = rows[bins[rows, c] > last]
                if min(len(left), len(right)) < max(1, s.least_rows) or min(h[left].sum(), h[right].sum()) < s.least_weight:
                    continue
                gain = sum(score(g[x].sum(), h[x].sum()) for x in (left, right)) - score(g[rows].sum(), h[rows].sum())
                if gain > 1e-12 and (found is None or gain > found[0] + 1e-9):
                    found = gain, left, right
        return found

    def score(a, b):
        return max(abs(a) - s.l1, 0) ** 2 / (b + s.l2)

    leaves = [(np.arange(len(g)), 0, best(np.arange(len(g))))]
    while len(leaves) < s.leaves:
        able = [x for x in leaves if x[2] and x[1] < s.depth]
        if not able:
            break
        top = max(able, key=lambda x: x[2][0])
        leaves = [x for x in leaves if x is not top] + [(rows, top[1] + 1, best(rows)) for rows in top[2][1:]]
    return [(rows, -s.rate * np.sign(g[rows].sum()) * max(abs(g[rows].sum()) - s.l1, 0) / (h[rows].sum() + s.l2))
            for rows, _, _ in leaves]


@pytest.mark.parametrize("settings", [
    {"trees": 3, "leaves": 6, "depth": 3, "bins": 8, "least_rows": 3},
    {"trees": 2, "leaves": 16, "depth": 7, "bins": 16, "l1": 0.3, "l2": 1.4, "least_rows": 1},
    {"trees": 10, "leaves": 2, "depth": 1, "bins": 5, "rate": 0.5}])
def test_leafwise_trees_equal_a_plain_version(spark, settings):
    rng = random.Random(8)
    data = []
    for i in range(400):
        a, b, c = rng.gauss(0, 1), float(rng.randrange(5)), rng.random()
        y = int(a + (b == 2) - 2 * (c > .8) + rng.gauss(0, .5) > .4)
        data.append((i, None if i % 17 == 0 else a, float("nan") if i % 23 == 0 else b, c, 7.0, y))
    df = spark.createDataFrame([*data, (999, 1.0, 1.0, 1.0, 7.0, None)], "id long, a double, b double, c double, k double, y int")
    names = ["a", "b", "c", "k"]
    model = boosting.fit_leafwise(df.repartition(3), names, "y", "id", **settings)
    s = model.settings
    bins = np.array([[0 if x is None or x != x else 1 + sum(cut <= x for cut in own) for x, own in zip(row[1:5], model.cuts)]
                     for row in data])
    y = np.array([row[5] for row in data])
    margin = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
    assert len(model.trees) == s.trees
    for _ in range(s.trees):
        p = 1 / (1 + np.exp(-margin))
        for rows, value in plain_tree(bins, p - y, p * (1 - p), [0, 1, 2, 3], s):
            margin[rows] += value
    got = {r.id: r.prediction for r in model.score(df, ["id"], "margin").collect()}
    assert len(got) == 401 and all(math.isclose(got[i], m, abs_tol=1e-6) for i, m in enumerate(margin))
    per_tree = [sum(t == n for t, *_ in model.splits()) + 1 for n in range(s.trees)]
    assert max(per_tree) <= s.leaves and max(d for _, d, *_ in model.splits()) < s.depth
    assert "k" not in {c for _, _, c, _, _ in model.splits()}
    chance = {r.id: r.prediction for r in model.score(df, ["id"]).collect()}
    assert all(math.isclose(chance[i], 1 / (1 + math.exp(-got[i])), rel_tol=1e-9) for i in got)


def test_leafwise_trees_of_odd_tables(spark):
    schema = "id long, a double, y int"
    none = boosting.fit_leafwise(spark.createDataFrame([], schema), ["a"], "y", "id")
    assert none.trees == [] and none.score(spark.createDataFrame([(1, 2.0, 0)], schema), ["id"], "margin").first()[1] == 0
    alike = spark.createDataFrame([(i, None, i % 2) for i in range(60)], schema)
    flat = boosting.fit_leafwise(alike, ["a"], "y", "id", trees=2)
    assert flat.splits() == [] and abs(flat.score(alike, ["id"]).first()[1] - 0.5) < 1e-9
    one = boosting.fit_leafwise(alike.withColumn("y", F.lit(1)), ["a"], "y", "id", trees=1)
    assert one.score(alike, ["id"]).first()[1] > 0.99


def test_leafwise_trees_sample_rows_and_columns(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(i, rng.random(), rng.random(), int(rng.random() < 0.4)) for i in range(500)],
                               "id long, a double, b double, y int")
    fit = dict(trees=4, leaves=4, rows_share=0.5, columns_share=0.5, least_rows=5)
    model = boosting.fit_leafwise(df, ["a", "b"], "y", "id", **fit)
    again = boosting.fit_leafwise(df.repartition(7), ["a", "b"], "y", "id", **fit)
    assert model.splits() == again.splits()
    for tree in range(4):
        assert len({c for t, _, c, _, _ in model.splits() if t == tree}) <= 1
    assert all(150 < t.sums[2, 0].sum() < 350 for t in model.trees)


def test_leafwise_passes_add_up_rows_in_tasks(spark, monkeypatch):
    """What is grouped is cells of tasks, not rows; blocks of rows don't change the trees."""
    rng = random.Random(4)
    df = spark.createDataFrame([(i, rng.random(), rng.random(), int(rng.random() < 0.4)) for i in range(3000)],
                               "id long, a double, b double, y int").coalesce(2)
    kind, grouped = type(df), []
    plain = kind.groupBy

    def groupBy(self, *cols):
        if cols[:1] == ("node",):
            grouped.append(self.count())
        return plain(self, *cols)

    fit = dict(trees=10, leaves=3, depth=2, bins=4, rows_share=0.8)
    monkeypatch.setattr(kind, "groupBy", groupBy)
    whole = boosting.fit_leafwise(df, ["a", "b"], "y", "id", **fit)
    assert grouped and max(grouped) <= 2 * 2 * 2 * 5
    monkeypatch.setattr(kind, "groupBy", plain)
    monkeypatch.setattr(boosting, "BLOCK", 100)
    assert boosting.fit_leafwise(df, ["a", "b"], "y", "id", **fit).splits() == whole.splits()
