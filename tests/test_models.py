"""Invariants of samples, models and plans."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import __spark_entry__ as entry_file
from loomframe.operators import models as m
from loomframe.operators import sampling as sm
from loomframe.plans import models as model_plans

QUERIES = entry_file.queries()


def test_folds_are_disjoint_and_complete(spark):
    folds = QUERIES["stratified_folds"](spark, SMALL)
    assert folds.groupBy("fold", "id").count().filter("count <> 1").isEmpty()
    per = {r["fold"]: r["n"] for r in folds.groupBy("fold").agg(F.count("*").alias("n")).collect()}
    assert len(per) == 10 and len(set(per.values())) == 1


def test_weighted_draws_follow_the_weights(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, 0.0)], "id long, w double")
    drawn = sm.weighted_resample(df, "id", "w", 4000, seed=2)
    counts = {r["id"]: r["count"] for r in drawn.groupBy("id").count().collect()}
    assert sum(counts.values()) == 4000 and 3 not in counts
    assert counts[2] == pytest.approx(3000, abs=120)


@pytest.fixture(scope="module")
def labelled(spark):
    x, y = F.col("id") % 20, F.col("id") % 7
    return spark.range(400).select("id", x.cast("double").alias("x"), y.cast("double").alias("y"),
                                   (x > 9).cast("int").alias("label"))


@pytest.mark.parametrize("fit", [
    lambda d, f, y: m.fit_forest(d, f, y, numTrees=3), lambda d, f, y: m.fit_boosted(d, f, y, maxIter=3),
    lambda d, f, y: m.fit_svm(d, f, y, maxIter=20),
    lambda d, f, y: m.fit_mlp(d, f, y, [2, 4, 2], maxIter=200)])
def test_classifiers_learn_a_simple_cut(spark, labelled, fit):
    model = fit(labelled, ["x", "y"], "label")
    got = m.predict(model, labelled, ["id", "label"], ["x", "y"], "class")
    assert got.filter("label = prediction").count() > 360


def test_importances_are_ranked(spark, labelled):
    model = m.fit_forest(labelled, ["x", "y"], "label", numTrees=5)
    got = m.feature_importances(model, ["x", "y"], spark).collect()
    assert got[0]["feature"] == "x" and sum(r["importance"] for r in got) == pytest.approx(1)


def test_fourier_products_stand_for_the_kernel(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.5)], "x double, y double")
    a, b = [r["rff"] for r in m.fourier_features(df, ["x", "y"], 2000, 0.5, 3).collect()]
    assert sum(p * q for p, q in zip(a, b)) == pytest.approx(2.718281828 ** (-0.5 * 1.25), abs=0.05)


def test_reconstruction_of_a_plane_is_exact(spark):
    df = spark.range(50).select("id", F.col("id").cast("double").alias("a"),
                                (F.col("id") % 7).cast("double").alias("b"),
                                (F.col("id") * 2.0 + F.col("id") % 7).alias("c"), F.lit(0).alias("Class"))
    out = m.reconstruction_error(df, df.withColumn("c", F.col("c") + (F.col("id") == 3).cast("double")),
                                 ["a", "b", "c"], 2, ["id"])
    errors = {r["id"]: r["error"] for r in out.collect()}
    assert errors.pop(3) > 0.01 and max(errors.values()) < 1e-9


@pytest.mark.parametrize("name", ["clean_names", "rank_normalise", "probit", "fit_mlp", "dbscan_2d"])
def test_queries_without_sql_give_rows(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_silhouette_is_in_range(spark):
    labels, scores = model_plans._clusters(spark, SMALL)
    assert labels.count() > 0 and scores["inertia"] > 0 and -1 <= scores["silhouette"] <= 1


# -- plans --------------------------------------------------------------------

def plan_text(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", ["all_features", "interpolate_akima", "rank_symmetric", "tfidf_l2",
                                  "threshold_table", "order_f1_by_threshold", "contact_traffic",
                                  "sliding_windows", "clean_names", "weighted_resample"])
def test_no_python_rows_and_no_cross_joins(spark, name):
    text = plan_text(QUERIES[name](spark, SMALL))
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan_text(QUERIES["filter_in"](spark, SMALL))
    assert "PushedFilters: [In(event_type" in text and "props" not in text
