"""Hand-made tables: nulls, ties, zero denominators, empty and one-row inputs."""

import itertools
import math
import random
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.functions.columns import clip, f_beta, log_amount, safe_ratio
from loomframe.functions.normal import probit
from loomframe.operators import baskets, clustering, evaluation, mail, relational, sequences
from loomframe.operators import distributions as dist
from loomframe.operators.joins import skew_join
from loomframe.operators.ordered import (
    Ordered, first_row, last_known, max_before, next_known, previous, row_number, run_max,
    run_sum, whole_count, whole_max, whole_min, whole_sum)


def values(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


# -- ordered scans ------------------------------------------------------------

def scans():
    v = F.col("v")
    return {"total": run_sum(v), "top": run_max(v), "below": max_before(v), "n": row_number(),
            "prev": previous(v), "last": last_known(v), "next": next_known(v),
            "first": first_row(v), "all": whole_sum(v), "most": whole_max(v),
            "least": whole_min(v), "rows": whole_count()}


@pytest.mark.parametrize("part", [["g"], []])
def test_split_scans_equal_plain_scans(spark, part):
    from loomframe.session import GROUP_LIMIT

    draw = random.Random(1)
    rows = [(draw.choice(["a", "a", "a", "b", None]), i,
             draw.choice([None, draw.randint(-9, 9)])) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, t int, v int")
    plain = Ordered(df, part, ["t"])
    assert plain.fits
    want = sorted(values(plain.scan(**scans()), "t", *scans()))
    spark.conf.set(GROUP_LIMIT, "20")
    try:
        cut = Ordered(df, part, ["t"])
        assert not cut.fits
        assert sorted(values(cut.scan(**scans()), "t", *scans())) == want
        sizes = cut.df.groupBy(*part, cut.piece).count().agg(F.max("count")).first()[0]
        assert sizes < 100  # no piece is near the size of the whole
    finally:
        spark.conf.unset(GROUP_LIMIT)


def test_a_value_held_by_most_rows_is_cut_by_the_next_column(spark):
    from loomframe.session import GROUP_LIMIT

    draw = random.Random(2)
    rows = [(draw.choice([0.0, 0.0, 0.0, draw.random(), -draw.random(), None]), i,
             draw.randint(-9, 9)) for i in range(600)]
    df = spark.createDataFrame(rows, "t double, id int, v int")
    want = sorted(values(Ordered(df, [], ["t", "id"]).scan(**scans()), "id", *scans()))
    spark.conf.set(GROUP_LIMIT, "25")
    try:
        cut = Ordered(df, [], ["t", "id"])
        assert sorted(values(cut.scan(**scans()), "id", *scans())) == want
        # Only nulls may stay together: they have no place on the axis.
        sizes = cut.df.filter("t is not null").groupBy(cut.piece).count()
        assert sizes.agg(F.max("count")).first()[0] < 80
    finally:
        spark.conf.unset(GROUP_LIMIT)


def test_scan_of_empty_input(spark):
    df = spark.createDataFrame([], "g string, t int, v int")
    assert Ordered(df, ["g"], ["t"]).scan(**scans()).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, small_groups, how):
    left = spark.createDataFrame([(i % 3 if i % 4 else 0, i) for i in range(300)], "k int, i int")
    right = spark.createDataFrame([(0, "x"), (2, "y")], "k int, name string")
    assert sorted(map(tuple, skew_join(left, right, ["k"], how).collect())) == sorted(
        map(tuple, left.join(right, "k", how).collect()))


# -- scalar functions ---------------------------------------------------------

def test_probit_against_the_standard_library(spark):
    points = [1e-12, 1e-5, 0.01, 0.074, 0.076, 0.3, 0.5, 0.7, 0.925, 0.999, 1 - 1e-5]
    df = spark.createDataFrame([(p,) for p in points], "p double")
    for p, z in values(df.select("p", probit(F.col("p")).alias("z")), "p", "z"):
        assert z == pytest.approx(NormalDist().inv_cdf(p), abs=1e-9)
    outside = spark.createDataFrame([(0.0,), (1.0,), (None,)], "p double")
    assert values(outside.select(probit(F.col("p")).alias("z")), "z") == [(None,)] * 3


def test_guarded_functions(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)], "a double, b double")
    out = df.select(safe_ratio(F.col("a"), F.col("b")).alias("r"),
                    f_beta(F.col("a"), F.col("b"), 1).alias("f"),
                    log_amount(F.col("a")).alias("l"))
    assert values(out, "r", "f", "l") == [(0.0, 0.0, 0.01), (0.0, 0.0, 0.0), (1.0, 1.0, 0.0)]
    nulls = spark.createDataFrame([(None,), (7.0,)], "a double")
    assert values(nulls.select(clip(F.col("a"), 0.0, 5.0).alias("c")), "c") == [(None,), (5.0,)]


# -- baskets ------------------------------------------------------------------

def test_basket_scores_keep_null_and_zero_apart(spark):
    rows = [(1, 2, 20, 5, 1, 1), (1, 2, 20, 6, 0, 1),   # one of two found
            (1, 3, 30, 7, 0, 1),                        # nothing predicted
            (1, 4, 40, 7, 1, 0), (1, 4, 40, 8, 0, 1)]   # nothing in common
    t = spark.createDataFrame(rows, "user_id int, predicted_order_num int, predicted_order_id int, "
                                    "product_id int, in_prev_order int, in_cur_order int")
    got = {r["order_num"]: r for r in baskets.basket_f1(t).collect()}
    assert got[2]["prev_ord_as_pred_F1"] == pytest.approx(2 / 3)
    assert got[3]["prev_ord_as_pred_PRECISION"] is None and got[3]["prev_ord_as_pred_F1"] is None
    assert got[4]["prev_ord_as_pred_F1"] == 0.0


def test_first_gap_is_left_out(spark):
    orders = spark.createDataFrame([(1, 1, 1, "prior", 9), (2, 1, 2, "prior", 3),
                                    (3, 1, 3, "prior", None), (4, 1, 4, "train", 4)],
                                   "order_id int, user_id int, order_number int, eval_set string, "
                                   "days_since_prior_order int")
    out = baskets.days_since_first(orders).orderBy("order_number")
    assert [r[0] for r in values(out, "days_since_first_order")] == [0, 3, 3, 7]


def test_basket_strings_of_an_order_without_products(spark):
    p = spark.createDataFrame([(1, 12, 1), (1, 3, 1), (2, 5, 0)], "order_id int, product_id int, order int")
    assert dict(values(baskets.basket_strings(p), "order_id", "products")) == {1: "3 12", 2: ""}


def test_reorder_delay_is_null_without_reorders(spark):
    history = spark.createDataFrame([(1, 1, 1, 0, 0), (1, 2, 3, 0, 9)],
                                    "user_id int, product_id int, times int, first_day int, last_day int")
    got = dict(values(baskets.product_reorder_delay(history), "product_id",
                      "delay_between_reorders_LOG_AVG"))
    assert got[1] is None and got[2] == pytest.approx(math.log(10 / 2))


# -- series -------------------------------------------------------------------

SERIES = [(1, i, v) for i, v in enumerate([None, 1.0, None, None, 4.0, None])] + [(2, 0, None)]


def series(spark):
    return spark.createDataFrame(SERIES, "s int, t int, v double")


def test_linear_gaps(spark):
    out = sequences.interpolate_linear(series(spark), "s", ["t"], ["v"]).orderBy("s", "t")
    assert [r[0] for r in values(out, "v")] == [None, 1.0, 2.0, 3.0, 4.0, 4.0, None]


def test_akima_leaves_the_ends_and_follows_a_line(spark):
    out = sequences.interpolate_akima(series(spark), "s", ["t"], ["v"]).orderBy("s", "t")
    got = [r[0] for r in values(out, "v")]
    assert got[0] is None and got[5] is None and got[6] is None
    assert got[1:5] == pytest.approx([1, 2, 3, 4])


def test_akima_keeps_a_flat_stretch_flat(spark):
    known = {0: 0.0, 1: 0.0, 2: 0.0, 4: 0.0, 5: 3.0, 6: 9.0}
    df = spark.createDataFrame([(1, i, known.get(i)) for i in range(7)], "s int, t int, v double")
    out = sequences.interpolate_akima(df, "s", ["t"], ["v"]).filter("t = 3")
    assert values(out, "v") == [(pytest.approx(0.0, abs=1e-12),)]


def test_runs_and_windows(spark):
    df = spark.createDataFrame([(1, t, s) for t, s in enumerate("aabbbba")], "p int, t int, s string")
    runs = sequences.segment_runs(df, "p", "s", ["t"])
    assert [r[0] for r in values(runs.orderBy("t"), "run")] == [0, 0, 1, 1, 1, 1, 2]
    win = sequences.sliding_windows(runs, ["p", "run"], ["t"], 3, 2, ["t"])
    assert sorted(values(win, "run", "start", "t")) == [(1, 0, [2, 3, 4])]
    assert sequences.window_length(5.12, 3) == 170


def test_rank_ignores_nulls_and_ties(spark, small_groups):
    df = spark.createDataFrame([(1, v) for v in [None, 2.0, 2.0, 5.0] * 20], "s int, v double")
    got = set(values(sequences.rank_symmetric(df, "s", ["v"]), "v"))
    assert got == {(None,), (0.0,), (1.0,)}


# -- mail ---------------------------------------------------------------------

def test_names_and_addresses(spark):
    cases = ["'a@x.com', Doe, J", "Roe, K", "Solo", "A, B, C", "Doe, x@y.z, J", ""]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = {r[0] for r in values(mail.clean_names(df, "t"), "name")}
    assert got == {"a@x.com", "Doe, J", "Roe, K", "Solo", "A, B", "C", "Doe, x@y.z", "J"}


def test_thread_needs_a_prefix_and_takes_the_subject_literally(spark):
    subjects = ["a.b (c)", "RE: a.b (c)", "fw: Re: a.b (c)", "RE: axb (c)", "RE: A.B (c)"]
    df = spark.createDataFrame([(i, s, "Mon, 14 May 2001 16:39:00 -0700 (PDT)")
                                for i, s in enumerate(subjects)], "id int, subject string, date string")
    assert [r[0] for r in values(mail.emails_in_thread(df, "a.b (c)"), "id")] == [1, 2]


def test_mail_without_receivers_is_left_out_of_traffic(spark):
    rows = [(1, "a@x", None, "b@x", "c"), (2, "a@x", "b@x, c@x, b@x", None, "c"), (3, "b@x", None, "a@x", "c")]
    df = spark.createDataFrame(rows, "id int, sender string, rcpt string, cc string, subject string")
    got = values(mail.contact_traffic(df, "a@x"), "contact", "from", "to", "total")
    assert got == [("b@x", 1, 1, 2), ("c@x", 0, 1, 1)]


# -- evaluation and distributions ---------------------------------------------

def test_thresholds_are_strict_in_the_table_and_inclusive_on_the_curve(spark):
    df = spark.createDataFrame([(0.2, 0), (0.8, 1)], "s double, y int")
    table = evaluation.threshold_table(df, "s", "y", [0.2, 0.8])
    assert sorted(values(table, "threshold", "tp", "fp", "tn", "fn")) == [
        (0.2, 1, 0, 1, 0), (0.8, 0, 0, 1, 1)]
    assert sorted(values(evaluation.threshold_table(df, "s", "y"), "threshold", "tp", "fp")) == [
        (0.2, 1, 0), (0.8, 0, 0)]
    assert sorted(values(evaluation.pr_curve(df, "s", "y"), "threshold", "precision", "recall")) == [
        (0.2, 0.5, 1.0), (0.8, 1.0, 1.0)]


def test_no_threshold_helps(spark):
    df = spark.createDataFrame([(1, 0.3, 0)], "o int, s double, y int")
    sweep = evaluation.order_f1_by_threshold(df, ["o"], "s", "y", evaluation.even_thresholds())
    assert values(evaluation.best_threshold(sweep), "threshold", "f1") == [(0.0, 0.0)]


def test_quantiles_of_tied_and_missing_values(spark):
    rows = [("a", 1.0), ("a", 1.0), ("a", 4.0), ("b", 2.0), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = relational.exact_quantiles(df, ["v"], {"m": 0.5, "q": 0.75}, ["g"])
    assert sorted(values(got, "g", "count", "m", "q")) == [("a", 3, 1.0, 2.5), ("b", 1, 2.0, 2.0)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 1.0, 1.5, 2.0, 3.0)], "x double")
    left = dist.histogram(df, "x", [0, 1, 2])
    right = dist.histogram(df, "x", [0, 1, 2], right=True)
    assert [r[0] for r in values(left.orderBy("bin"), "count")] == [1, 3]
    assert [r[0] for r in values(right.orderBy("bin"), "count")] == [2, 2]


def test_density_integrates_to_one(spark):
    df = spark.createDataFrame([(float(i % 17),) for i in range(500)], "x double")
    grid = [-20 + 0.25 * i for i in range(240)]
    total = dist.kde(df, "x", grid, dist.bandwidth(df, "x")).agg(F.sum("density")).first()[0]
    assert total * 0.25 == pytest.approx(1, abs=1e-3)


# -- density clustering -------------------------------------------------------

def brute_dbscan(points, eps, min_pts):
    ids = sorted(points)
    xy = np.array([points[i] for i in ids])
    near = ((xy[:, None] - xy[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= min_pts
    label, clusters = {}, 0
    for i in range(len(ids)):
        if not core[i] or ids[i] in label:
            continue
        clusters += 1
        todo = [i]
        while todo:
            j = todo.pop()
            if label.get(ids[j]):
                continue
            label[ids[j]] = clusters
            todo += [k for k in np.flatnonzero(near[j]) if core[k] and ids[k] not in label]
    for i in range(len(ids)):
        if not core[i]:
            around = [label[ids[k]] for k in np.flatnonzero(near[i]) if core[k]]
            label[ids[i]] = min(around, default=0)
    return label


@pytest.mark.parametrize("spread", [30, 200])
def test_dbscan_equals_brute_force(spark, spread):
    draw = random.Random(spread)
    centres = [(draw.uniform(0, spread), draw.uniform(0, spread)) for _ in range(4)]
    points = {}
    for i in range(360):
        cx, cy = centres[i % 4]
        points[i] = (cx + draw.gauss(0, 4), cy + draw.gauss(0, 4)) if i % 9 else (
            draw.uniform(0, spread), draw.uniform(0, spread))
    for i in range(360, 450):  # a third of one cell: copies of a point
        points[i] = centres[0]
    df = spark.createDataFrame([(i, *p) for i, p in points.items()], "id int, x double, y double")
    got = dict(values(clustering.dbscan_2d(df, "id", "x", "y", 2.5, 5), "id", "subclass"))
    assert got == brute_dbscan(points, 2.5, 5)


def test_dbscan_with_crowded_cells_split(spark, small_groups):
    draw = random.Random(5)
    points = {i: (draw.gauss(0, 3), draw.gauss(0, 3)) if i % 2 else (draw.uniform(0, 60), 1.0)
              for i in range(300)}
    df = spark.createDataFrame([(i, *p) for i, p in points.items()], "id int, x double, y double")
    got = dict(values(clustering.dbscan_2d(df, "id", "x", "y", 2.0, 6), "id", "subclass"))
    assert got == brute_dbscan(points, 2.0, 6)


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60) if i != 30]
    nodes = spark.createDataFrame([(i,) for i in range(62)], "node int")
    got = dict(values(clustering.connected(nodes, spark.createDataFrame(edges, "a int, b int")),
                      "node", "root"))
    assert got == {i: 0 if i <= 30 else 31 if i <= 60 else 61 for i in range(62)}


def test_best_epoch_stops_at_the_first_long_wait(spark):
    scores = [0.1, 0.5, 0.4, 0.4, 0.4, 0.9]
    df = spark.createDataFrame([("r", i, s) for i, s in enumerate(scores)],
                               "run string, epoch int, f1m double")
    for patience, best in itertools.product([3, 4], [None]):
        got = values(sequences.best_epoch(df, "run", "epoch", "f1m", patience), "best_epoch")
        assert got == [(1,) if patience == 3 else (5,)]


def test_skew_join_of_null_and_map_rows(spark, small_groups):
    left = spark.createDataFrame([(None if k % 3 == 0 else k % 3, k, {"a": k}) for k in range(300)],
                                 "k int, id int, m map<string, int>").repartition(3)
    right = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    joined = skew_join(left, right, ["k"], "left")
    got = sorted((r["id"], r["v"]) for r in joined.collect())
    assert got == [(k, {0: None, 1: "x", 2: "y"}[k % 3]) for k in range(300)]
    assert skew_join(left, right, ["k"], "left_anti").count() == 100
    # The null rows have salts of their own, as many as their key needs.
    assert "_salt" in joined._jdf.queryExecution().toString()


def test_text_order_keys_are_cut(spark, small_groups):
    rows = [("g", f"common-prefix-{k:05d}-and-a-long-tail-{k % 7}", k) for k in range(500)]
    rows += [("h", None, k) for k in range(3)] + [("t", "same", k) for k in range(200)]
    df = spark.createDataFrame(rows, "g string, name string, v long").repartition(4)
    work = Ordered(df, ["g"], ["name", "v"])
    assert not work.fits
    got = {(r["g"], r["v"]): r["n"] for r in work.scan(n=row_number()).collect()}
    assert got == {**{("g", k): k + 1 for k in range(500)}, **{("h", k): k + 1 for k in range(3)},
                   **{("t", k): k + 1 for k in range(200)}}


def test_density_with_one_far_value(spark):
    df = spark.range(20_001).select(F.when(F.col("id") == 20_000, 1e6).otherwise(F.col("id") / 20_000.0).alias("x"))
    got = {r["x"]: r["density"] for r in dist.kde(df, "x", [0.25, 0.5, 0.75, 500.0], 0.02).collect()}
    assert all(got[x] == pytest.approx(0.99995, abs=1e-5) for x in (0.25, 0.5, 0.75)) and got[500.0] == 0


def test_histogram_keeps_groups_outside_the_edges(spark):
    df = spark.createDataFrame([("in", 0.5), ("out", 9.0), ("out", -1.0), (None, 1.5)], "g string, x double")
    got = {(r["g"], r["bin"]): (r["count"], r["below"], r["above"])
           for r in dist.histogram(df, "x", [0, 1, 2], by=["g"]).collect()}
    assert got == {("in", 0): (1, 0, 0), ("in", 1): (0, 0, 0), ("out", 0): (0, 1, 1), ("out", 1): (0, 1, 1),
                   (None, 0): (0, 0, 0), (None, 1): (1, 0, 0)}


def test_akima_plan_grows_linearly(spark):
    names = [f"c{i}" for i in range(6)]
    df = spark.range(40).select((F.col("id") % 2).alias("s"), F.col("id").alias("t"), *[
        F.when((F.col("id") + i) % 5 != 0, F.sin(F.col("id") + i)).alias(n) for i, n in enumerate(names)])

    def lines(k):
        return len(sequences.interpolate_akima(df, "s", ["t"], names[:k])._jdf.queryExecution().analyzed()
                   .toString().splitlines())
    assert lines(6) <= lines(1) + 20
    whole = {(r["s"], r["t"]): r for r in sequences.interpolate_akima(df, "s", ["t"], names).collect()}
    for n in names:
        for r in sequences.interpolate_akima(df, "s", ["t"], [n]).collect():
            assert whole[(r["s"], r["t"])][n] == r[n]


def test_transitions_move_lines_once_and_keep_copies(spark):
    from loomframe.operators import baskets as b
    orders = spark.createDataFrame([(1, 9, 1, "prior"), (2, 9, 2, "prior"), (2, 9, 2, "prior"), (3, 9, 3, "test"),
                                    (4, None, 2, "prior")], "order_id long, user_id long, order_number long, eval_set string")
    op = spark.createDataFrame([(9, 1, 5), (9, 1, None), (9, 2, 5), (9, 2, 6), (9, 2, 6), (9, 3, 7), (None, 2, 5)],
                               "user_id long, order_number long, product_id long")
    got = b.basket_transitions(orders, op)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(user_id" in plan
    found = sorted(map(tuple, got.collect()), key=repr)
    assert found == sorted(2 * [(9, 2, 2, 5, 1, 1), (9, 2, 2, 6, 0, 1), (9, 2, 2, None, 1, 0)], key=repr)


def test_transitions_do_not_double_lines(spark, small_groups):
    """Orders become lists; where they are too long for that, rows are dealt out with the same result."""
    from loomframe.operators import baskets as b
    orders = spark.createDataFrame(
        [(10 * u + n, u, n, "prior" if n < 5 else "test") for u in range(30) for n in range(1, 6) if (u + n) % 7]
        + [(None, 3, 2, "prior")], "order_id long, user_id long, order_number long, eval_set string")
    op = spark.createDataFrame(
        [(u, n, (u * n + k) % 6 or None) for u in range(30) for n in range(1, 6) for k in range(3) if (u + k) % 5],
        "user_id long, order_number long, product_id long")
    spark.conf.set("loomframe.groupRowLimit", "3")
    by_rows = b.basket_transitions(orders, op)
    spark.conf.set("loomframe.groupRowLimit", "100000")
    by_lists = b.basket_transitions(orders, op)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (by_rows, by_lists)]
    assert ["in_prev_order" in p and "collect_list(product_id" in p for p in plans] == [False, True]
    lines, want = {}, []
    for u, n, p in op.collect():
        lines.setdefault((u, n), set()).add(p)
    for o, u, n, kind in orders.collect():
        cur, prev = lines.get((u, n), set()), lines.get((u, n - 1), set())
        want += [(u, n, o, p, int(p in prev), int(p in cur)) for p in cur | prev if kind == "prior" and n >= 2]
    for found in (by_rows, by_lists):
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_a_small_table_is_looked_up_without_salt_or_shuffle(spark, small_groups):
    from loomframe.operators import baskets as b
    op = spark.createDataFrame([(u, 100 * u + n, "prior", 1 + u % 2, int(n > 0)) for u in range(40) for n in range(3)],
                               "user_id long, order_id long, source string, product_id long, reordered int")
    products = spark.createDataFrame([(1, 7, 4), (1, 8, 4), (3, 9, 5)], "product_id long, aisle_id long, department_id long")
    hot = b.user_counts(op, products)
    plan = hot._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in plan
    want = [(u, 3, 1, 6, 1, 2) for u in range(0, 40, 2)]
    assert sorted(map(tuple, hot.collect())) == want
    spark.conf.set("loomframe.groupRowLimit", "100000")
    plain = b.user_counts(op, products)
    assert "Expand" not in plain._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, plain.collect())) == want and plain.schema == hot.schema


def test_groups_are_counted_in_parts_first(spark):
    from loomframe.operators.ordered import groups_fit
    df = spark.range(100).select((F.col("id") % 10).alias("k"), F.when(F.col("id") < 40, F.col("id")).alias("some"))
    for limit, k, some in ((9, False, False), (10, True, False), (59, True, False), (60, True, True), (100, True, True)):
        spark.conf.set("loomframe.groupRowLimit", str(limit))
        try:
            assert (groups_fit(df, ["k"]), groups_fit(df, ["some"])) == (k, some)
        finally:
            spark.conf.unset("loomframe.groupRowLimit")


def test_random_split_of_a_table_as_one_group(spark):
    from loomframe.operators.ordered import groups_fit
    from loomframe.operators.sampling import random_split
    df = spark.createDataFrame([(i,) for i in range(200)] + [(7,), (7,), (None,), (None,), (None,)], "id long")
    held = {}
    for limit in (1000, 205, 204, 2):  # ranked by one window up to 205 rows, else by ranges of keys
        spark.conf.set("loomframe.groupRowLimit", str(limit))
        try:
            assert groups_fit(df, []) == (limit >= 205) and groups_fit(df.limit(0), [])
            rows = values(random_split(df, "id", 0.1), "id", "role")
        finally:
            spark.conf.unset("loomframe.groupRowLimit")
        assert len(rows) == 205
        held[limit] = sorted((r[0] for r in rows if r[1] == "validation"), key=repr)
    assert len(held[205]) == 20 and held[205].count(None) == 3 and len({repr(h) for h in held.values()}) == 1
    assert values(random_split(df.limit(0), "id", 0.1), "id", "role") == []


def test_tasks_are_small_unless_the_session_says_otherwise(spark):
    from loomframe.session import TASK_BYTES, prepare
    spark.conf.unset(TASK_BYTES)
    assert prepare(spark).conf.get(TASK_BYTES) in ("16m", "16MB", "16777216b")
    spark.conf.set(TASK_BYTES, "8m")
    assert prepare(spark).conf.get(TASK_BYTES) in ("8m", "8MB", "8388608b")
    spark.conf.unset(TASK_BYTES)
    prepare(spark)


def test_bag_of_words_moves_terms_by_block(spark):
    from loomframe.operators import text as t
    docs = spark.createDataFrame([(1, "aa bb aa"), (2, "bb cc"), (2, "cc dd"), (None, "dd ee"), (None, "ff dd"), (3, None)],
                                 "doc long, text string")
    got = t.bag_of_words(docs, "doc", "text")
    plan = got._jdf.queryExecution().executedPlan().toString()
    # By block, by term, by block; documents' own counts stay where they are.
    assert "SortMergeJoin" not in plan and "hashpartitioning(doc" not in plan
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([
        (1, "bb", 1), (2, "bb", 1), (2, "dd", 1), (None, "dd", 2)], key=repr)
    base = spark.createDataFrame([("aa", "x"), ("cc", "x"), ("ff", "bb")], "token string, base string")
    got = t.bag_of_words(docs, "doc", "text", stop=["ee"], lexicon=base)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([
        (1, "x", 2), (1, "bb", 1), (2, "bb", 1), (2, "x", 2), (2, "dd", 1), (None, "dd", 2), (None, "bb", 1)], key=repr)
