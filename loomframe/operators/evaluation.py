"""Scores of predictions: confusion counts, threshold sweeps, curves, F measures.

Scores are collapsed to counts per distinct score or per threshold interval
before anything is ordered, so no sweep multiplies rows by thresholds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.functions.columns import f_beta, safe_ratio
from loomframe.operators.ordered import Ordered, run_sum, whole_sum
from loomframe.operators.relational import unpivot
from loomframe.session import stored

INF = float("inf")


def _hits(actual: Column, guessed: Column) -> dict[str, Column]:
    return {"tp": F.count_if(actual & guessed), "fp": F.count_if(~actual & guessed),
            "tn": F.count_if(~actual & ~guessed), "fn": F.count_if(actual & ~guessed)}


def _precision_recall() -> dict[str, Column]:
    tp = F.col("tp")
    return {"precision": safe_ratio(tp, tp + F.col("fp")), "recall": safe_ratio(tp, tp + F.col("fn"))}


def beta_columns(betas: Sequence[float]) -> dict[str, Column]:
    return {f"f{b:g}": f_beta(F.col("precision"), F.col("recall"), b) for b in betas}


def confusion_counts(df: DataFrame, y: str, yhat: str, positive=1,
                     by: Sequence[str] = ()) -> DataFrame:
    """TP, FP, TN, FN, precision and recall; 0 where a ratio is undefined."""
    hits = _hits(F.col(y) == positive, F.col(yhat) == positive)
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in hits.items()]).withColumns(
        _precision_recall())


def f_betas(counts: DataFrame, betas: Sequence[float] = (1, 10, 50)) -> DataFrame:
    return counts.withColumns(beta_columns(betas))


def collapse_subclasses(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Any label above 0 becomes 1."""
    return df.withColumns({c: (F.col(c) > 0).cast("int") for c in cols})


# -- thresholds ---------------------------------------------------------------


def _score_counts(df: DataFrame, score: str, y: str, positive) -> DataFrame:
    """Rows of each class per distinct score, written once: the ordered scans first
    look at the number of scores and must not read the input again for it."""
    one = F.col(y) == positive  # a null label counts as neither
    return stored(df.filter(F.col(score).isNotNull()).groupBy(
        F.col(score).alias("threshold")).agg(
        F.count_if(one).alias("_pos"), F.count_if(~one).alias("_neg")))


def distinct_thresholds(df: DataFrame, score: str) -> DataFrame:
    return df.filter(F.col(score).isNotNull()).select(F.col(score).alias("threshold")).distinct()


def _from_totals(tp: Column, fp: Column, pos: Column, neg: Column) -> dict[str, Column]:
    return {"tp": tp, "fp": fp, "tn": neg - fp, "fn": pos - tp}


def threshold_table(df: DataFrame, score: str, y: str,
                    thresholds: Sequence[float] | None = None,
                    betas: Sequence[float] = (1, 10, 50), positive=1) -> DataFrame:
    """Counts and measures when ``score > threshold`` is the prediction, for the
    given thresholds or else for every distinct score."""
    if thresholds is None:
        counts = _score_counts(df, score, y, positive)
        sums = Ordered(counts, [], ["threshold"]).scan(
            _upto_pos=run_sum(F.col("_pos")), _upto_neg=run_sum(F.col("_neg")),
            _all_pos=whole_sum(F.col("_pos")), _all_neg=whole_sum(F.col("_neg")))
        tp = F.col("_all_pos") - F.col("_upto_pos")
        fp = F.col("_all_neg") - F.col("_upto_neg")
    else:
        counts = _interval_counts(df, score, y, sorted(set(thresholds)), positive)
        w = Window.orderBy(F.desc("_slot"))  # one row per threshold
        above, whole = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)
        zero = F.lit(0).cast("long")
        sums = counts.withColumns({
            "_tp": F.coalesce(F.sum("_pos").over(above), zero),
            "_fp": F.coalesce(F.sum("_neg").over(above), zero),
            "_all_pos": F.sum("_pos").over(whole), "_all_neg": F.sum("_neg").over(whole)})
        sums = sums.filter(F.col("threshold").isNotNull())
        tp, fp = F.col("_tp"), F.col("_fp")
    hits = _from_totals(tp, fp, F.col("_all_pos"), F.col("_all_neg"))
    return sums.select("threshold", *[c.alias(n) for n, c in hits.items()]).withColumns(
        _precision_recall()).withColumns(beta_columns(betas))


def _interval_counts(df: DataFrame, score: str, y: str, thresholds: list[float],
                     positive) -> DataFrame:
    """Rows whose score is in (previous threshold, this threshold], per threshold,
    and one row without threshold for the scores above all of them."""
    k = len(thresholds)
    # Intervals closed on the right: search the negated score in negated thresholds.
    split = Bucketizer(splits=[-INF, *[-t for t in reversed(thresholds)], INF],
                       inputCol="_minus", outputCol="_bucket")
    one = F.col(y) == positive  # a null label counts as neither
    rows = df.filter(F.col(score).isNotNull()).select(
        (-F.col(score).cast("double")).alias("_minus"), one.alias("_one"))
    slot = (F.lit(k) - F.col("_bucket")).cast("int")
    counts = split.transform(rows).groupBy(slot.alias("_slot")).agg(
        F.count_if("_one").alias("_pos"), F.count_if(~F.col("_one")).alias("_neg"))
    table = df.sparkSession.createDataFrame(
        [*enumerate(thresholds), (k, None)], "_slot int, threshold double")
    return table.join(counts, "_slot", "left").na.fill(0, ["_pos", "_neg"])


def pr_curve(df: DataFrame, score: str, y: str, positive=1) -> DataFrame:
    """Precision and recall when ``score >= threshold``, for every distinct score."""
    counts = _score_counts(df, score, y, positive).withColumn("_down", -F.col("threshold"))
    sums = Ordered(counts, [], ["_down"]).scan(
        tp=run_sum(F.col("_pos")), _fp=run_sum(F.col("_neg")), _all=whole_sum(F.col("_pos")))
    return sums.select("threshold", F.col("_pos").alias("hits"), "tp", F.col("_fp").alias("fp"),
                       F.col("_all").alias("positives"),
                       safe_ratio(F.col("tp"), F.col("tp") + F.col("_fp")).alias("precision"),
                       safe_ratio(F.col("tp"), F.col("_all")).alias("recall"))


def average_precision(df: DataFrame, score: str, y: str, positive=1) -> DataFrame:
    """Sum over the curve of (recall gained) x precision."""
    curve = pr_curve(df, score, y, positive)
    return curve.agg(F.sum(safe_ratio(F.col("hits"), F.col("positives")) * F.col("precision"))
                     .alias("average_precision"))


def threshold_at_recall(curve: DataFrame, recall: float = 0.9,
                        betas: Sequence[float] = (1,)) -> DataFrame:
    """The highest threshold whose recall is above the bound, and the scores there."""
    best = curve.filter(F.col("recall") > recall).agg(
        F.max("threshold").alias("threshold"),
        F.max_by("precision", "threshold").alias("precision"),
        F.max_by("recall", "threshold").alias("recall"))
    return best.withColumns(beta_columns(betas))


# -- mean basket F1 over thresholds -------------------------------------------


def even_thresholds(stop: float = 0.5, n: int = 100) -> list[float]:
    step = stop / (n - 1)
    return [i * step for i in range(n)]


def order_f1_by_threshold(df: DataFrame, group: Sequence[str], score: str, target: str,
                          thresholds: Sequence[float]) -> DataFrame:
    """Mean F1 per group when ``score >= threshold``; an undefined F1 counts as 0.

    The F1 of a group changes only at thresholds its own scores reach, so each
    group gives one change per occupied interval and the changes are summed up.
    """
    cuts = sorted(set(thresholds))
    rows = Bucketizer(splits=[-INF, *cuts, INF], inputCol="_s", outputCol="_b").transform(
        df.select(*group, F.col(score).cast("double").alias("_s"), F.col(target).alias("_t")))
    per = rows.groupBy(*group, F.col("_b").cast("int").alias("_b")).agg(
        F.sum("_t").alias("_hits"), F.count(F.lit(1)).alias("_rows"))
    # From here on a group has at most one row per threshold interval.
    w = Window.partitionBy(*group).orderBy(F.desc("_b"))
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    f1 = safe_ratio(2 * F.sum("_hits").over(run),
                    F.sum("_rows").over(run) + F.sum("_hits").over(whole))
    per = per.withColumns({"_f1": F.when(F.col("_b") > 0, f1).otherwise(0.0),
                           "_first": (F.row_number().over(w) == 1).cast("long")})
    # Interval 0 is below every threshold: it holds no prediction.
    change = F.when(F.col("_b") > 0, F.col("_f1") - F.coalesce(F.lag("_f1").over(w), F.lit(0.0)))
    steps = per.withColumn("_step", change).groupBy("_b").agg(
        F.sum("_step").alias("_step"), F.sum("_first").alias("_groups"))
    table = df.sparkSession.createDataFrame(
        [(0, None), *[(i + 1, t) for i, t in enumerate(cuts)]], "_b int, threshold double")
    sums = table.join(steps, "_b", "left").na.fill(0, ["_step", "_groups"])
    down = Window.orderBy(F.desc("_b"))  # one row per threshold
    total = F.sum("_groups").over(down.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))
    mean = safe_ratio(F.sum("_step").over(down.rowsBetween(Window.unboundedPreceding, 0)), total)
    return sums.withColumn("f1", mean).filter(F.col("_b") > 0).select("threshold", "f1")


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The lowest threshold with the highest F1; 0 when no F1 is above 0.

    Sums of many changes carry rounding noise, so values are compared at 12 digits.
    """
    place = F.struct(F.round("f1", 12), -F.col("threshold"))
    best = sweep.agg(F.max_by(F.struct("threshold", "f1"), place).alias("_b"))
    some = F.col("_b.f1") > 0
    return best.select(F.when(some, F.col("_b.threshold")).otherwise(0.0).alias("threshold"),
                       F.when(some, F.col("_b.f1")).otherwise(0.0).alias("f1"))


# -- many classes -------------------------------------------------------------


def confusion_matrix(df: DataFrame, y: str, yhat: str, normalise: bool = False) -> DataFrame:
    """Rows per (truth, prediction); with ``normalise`` also the share of the truth."""
    counts = df.groupBy(y, yhat).agg(F.count(F.lit(1)).alias("count"))
    if not normalise:
        return counts
    # The matrix has one row per pair of classes, whatever the number of rows.
    return counts.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy(y)))


def multiclass_scores(df: DataFrame, y: str, yhat: str,
                      weights: str = "predicted") -> DataFrame:
    """Accuracy in percent, macro F1 and weighted F1.

    ``weights='predicted'`` weighs classes by predicted rows, ``'true'`` by true rows.
    """
    counts = confusion_matrix(df, y, yhat)
    right = F.when(F.col(y) == F.col(yhat), F.col("count")).otherwise(0)
    ends = F.array(F.struct(F.col(y).alias("c"), F.col("count").alias("t"), F.lit(0).cast(
        "long").alias("p"), right.cast("long").alias("tp")),
        F.struct(F.col(yhat).alias("c"), F.lit(0).cast("long").alias("t"),
                 F.col("count").alias("p"), F.lit(0).cast("long").alias("tp")))
    per = counts.select(F.explode(ends).alias("e")).groupBy("e.c").agg(
        F.sum("e.t").alias("t"), F.sum("e.p").alias("p"), F.sum("e.tp").alias("tp"))
    per = per.withColumn("f1", safe_ratio(2 * F.col("tp"), F.col("t") + F.col("p")))
    w = F.col("p" if weights == "predicted" else "t")
    return per.agg((100 * F.try_divide(F.sum("tp"), F.sum("t"))).alias("acc"),
                   F.avg("f1").alias("f1m"),
                   F.try_divide(F.sum(F.col("f1") * w), F.sum(w)).alias("f1w"))


# -- features, folds, hits ----------------------------------------------------


def fisher_scores(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """|mean1 - mean0| / (var1 + var0) of each column, on z-scored values, ascending."""
    long = unpivot(df, cols, [label])
    one = F.when(F.col(label) == 1, F.col("value"))
    zero = F.when(F.col(label) == 0, F.col("value"))
    sums = long.groupBy("column").agg(
        F.abs(F.avg(one) - F.avg(zero)).alias("_gap"),
        (F.var_samp(one) + F.var_samp(zero)).alias("_var"), F.stddev_samp("value").alias("_std"))
    # z-scoring divides the gap by the std and the variances by its square.
    return sums.select("column", F.try_divide(F.col("_gap") * F.col("_std"), F.col("_var"))
                       .alias("fisher")).orderBy("fisher", "column")


def positive_hits(predictions: DataFrame, row_id: str, y: str, yhat: str) -> DataFrame:
    """Per positive row how often it was tested and how often found."""
    return predictions.filter(F.col(y) == 1).groupBy(row_id).agg(
        F.count(F.lit(1)).alias("tested"), F.count_if(F.col(yhat) == 1).alias("right")
    ).withColumn("rate", F.col("right") / F.col("tested"))


def fold_summary(fold_scores: DataFrame, model: str = "model",
                 betas: Sequence[float] = (1, 10, 50)) -> DataFrame:
    """Per model the mean counts, precision, recall, and mean and std of each F."""
    scored = f_betas(fold_scores.withColumns(_precision_recall()), betas)
    names = [f"f{b:g}" for b in betas]
    return scored.groupBy(model).agg(
        *[F.avg(c).alias(f"{c}_mean") for c in ("tp", "tn", "fp", "fn", "precision", "recall")],
        *[F.avg(c).alias(f"{c}_mean") for c in names],
        *[F.stddev_samp(c).alias(f"{c}_std") for c in names])
