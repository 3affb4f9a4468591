"""Sampling, splitting, scaling, evaluation and distributions of transactions."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.functions.columns import f_beta, safe_ratio
from loomframe.operators import distributions as dist
from loomframe.operators import evaluation as ev
from loomframe.operators import sampling as sm
from loomframe.operators import scaling as sc
from loomframe.operators.joins import union_all
from loomframe.operators.models import one_class_outliers as outliers
from loomframe.plans.registry import Registry, rounded
from loomframe.plans.views import basket_lines, table, transactions, with_views

plan = Registry()
BASE = with_views("tx")


def key_sql(seed: int, row_id: str) -> str:
    return f"md5(concat('{seed}:', {row_id}))"


def ranked_sql(source: str, row_id: str, by: str, seed: int) -> str:
    part = f"PARTITION BY {by}" if by else ""
    return f"""(SELECT *, row_number() OVER ({part} ORDER BY {key_sql(seed, row_id)}, {row_id})
      AS rk, count(*) OVER ({part}) AS of_ FROM {source})"""


# -- folds and splits ---------------------------------------------------------

FOLDS = f"""{BASE}, f AS (SELECT unnest(range(10))::INT AS fold),
fold_rows AS (SELECT fold, id, "Class", concat(fold, ':', id) AS k FROM tx, f),
folds AS (SELECT fold, id, CASE WHEN rk <= round(of_ * 0.05::DOUBLE) THEN 'test' ELSE 'train' END
  AS role FROM (SELECT *, row_number() OVER (PARTITION BY fold, "Class"
      ORDER BY md5(concat('0:', k)), id) AS rk,
    count(*) OVER (PARTITION BY fold, "Class") AS of_ FROM fold_rows))"""


def _folds(spark, sf_dir):
    return sm.stratified_folds(transactions(spark, sf_dir), "id", "Class")


@plan.add(f"{FOLDS} SELECT * FROM folds")
def stratified_folds(spark, sf_dir):
    return _folds(spark, sf_dir)


@plan.add(f"""{FOLDS} SELECT fold, role, count(*) AS rows,
  round(avg(CASE WHEN "Class" = 1 THEN 1.0::DOUBLE ELSE 0 END), 9) AS share
FROM folds JOIN tx USING (id) GROUP BY fold, role""")
def fold_report(spark, sf_dir):
    return rounded(sm.fold_report(_folds(spark, sf_dir), transactions(spark, sf_dir), "id",
                                  "Class"))


@plan.add(f"""{FOLDS} SELECT tx.id, "V1", "Class", role FROM tx JOIN folds USING (id)
WHERE fold = 3""")
def fold_frames(spark, sf_dir):
    tx = transactions(spark, sf_dir).select("id", "V1", "Class")
    train, test = sm.fold_frames(tx, _folds(spark, sf_dir), 3, "id")
    return train.withColumn("role", F.lit("train")).unionByName(
        test.withColumn("role", F.lit("test")))


@plan.add(f"""{BASE}, f AS (SELECT id, CASE WHEN rk <= round(of_ * 0.1::DOUBLE) THEN 'test'
  ELSE 'train' END AS role FROM (SELECT *, row_number() OVER (PARTITION BY "Class"
    ORDER BY md5(concat('5:', '0:', id)), id) AS rk, count(*) OVER (PARTITION BY "Class") AS of_
  FROM tx)) SELECT 0 AS fold, id, role FROM f""")
def stratified_holdout(spark, sf_dir):
    return sm.stratified_folds(transactions(spark, sf_dir), "id", "Class", n=1, test_size=0.1,
                               seed=5)


@plan.add(f"""{BASE} SELECT id, "Class" FROM {ranked_sql('tx', 'id', '"Class"', 0)}
WHERE rk <= CASE WHEN "Class" = 1 THEN 100000 ELSE 1500 END""")
def sample_per_class(spark, sf_dir):
    return sm.sample_per_class(transactions(spark, sf_dir), "id", "Class",
                               {1: 100000, 0: 1500}).select("id", "Class")


@plan.add(f"""{BASE}, c AS (SELECT "Class", count(*) AS n FROM tx GROUP BY 1),
a AS (SELECT * FROM (VALUES (1::INT, 100000::BIGINT), (0, 1500), (7, 5)) t("Class", required))
SELECT a."Class", required, coalesce(n, 0) AS available,
  greatest(required - coalesce(n, 0), 0) AS missing FROM a LEFT JOIN c ON a."Class" = c."Class" """)
def class_shortfall(spark, sf_dir):
    return sm.class_shortfall(transactions(spark, sf_dir), "Class", {1: 100000, 0: 1500, 7: 5})


UNDER = f"""{BASE}, chosen AS (SELECT id, "Class" FROM {ranked_sql('tx', 'id', '"Class"', 0)}
  WHERE "Class" = 1 OR rk <= 2000),
parts AS (SELECT id, "Class", CASE WHEN rk <= ceil(of_ * 0.2::DOUBLE) THEN 'test' ELSE 'train' END
  AS role FROM {ranked_sql('chosen', 'id', '', 1)})"""


@plan.add(f"{UNDER} SELECT * FROM parts")
def undersample_split(spark, sf_dir):
    return sm.undersample_split(transactions(spark, sf_dir).select("id", "Class"), "id", "Class",
                                2000)


@plan.add(f"""{UNDER} SELECT role, count(*) AS rows,
  round(avg(CASE WHEN "Class" = 1 THEN 1.0::DOUBLE ELSE 0 END), 9) AS share
FROM parts GROUP BY role""")
def split_shares(spark, sf_dir):
    return rounded(sm.split_shares(undersample_split(spark, sf_dir), "Class"))


SHARE = """s AS (SELECT count_if("Class" = 1)::DOUBLE / count(*) AS p,
  count_if("Class" = 1) AS pos FROM tx)"""


@plan.add(f"""{BASE}, {SHARE}, k AS (SELECT least(ceil(3000 * p), pos) AS n1 FROM s)
SELECT id, "Class" FROM {ranked_sql('tx', 'id', '"Class"', 0)}, k
WHERE rk <= CASE WHEN "Class" = 1 THEN n1 ELSE 3000 - n1 END""")
def reduce_size(spark, sf_dir):
    return sm.reduce_size(transactions(spark, sf_dir), "id", "Class", 3000).select("id", "Class")


@plan.add(f"""{BASE}, {SHARE}, k AS (SELECT ceil(3000 * p) AS n1, ceil(0.2::DOUBLE * 3000) AS nt,
  ceil(p * ceil(0.2::DOUBLE * 3000)) AS t1 FROM s)
SELECT id, "Class", CASE WHEN rk <= CASE WHEN "Class" = 1 THEN t1 ELSE nt - t1 END
  THEN 'test' ELSE 'train' END AS role FROM {ranked_sql('tx', 'id', '"Class"', 0)}, k
WHERE rk <= CASE WHEN "Class" = 1 THEN n1 ELSE 3000 - n1 END""")
def proportional_split(spark, sf_dir):
    return sm.proportional_split(transactions(spark, sf_dir), "id", "Class", 3000).select(
        "id", "Class", "role")


@plan.add(f"""{with_views('b_op')} SELECT order_id, product_id, CASE WHEN
  CAST(concat('0x', substr({key_sql(1, 'order_id')}, 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE
  < 1 - 0.2::DOUBLE THEN 'model' ELSE 'threshold' END AS part FROM b_op""")
def group_split(spark, sf_dir):
    return sm.group_split(basket_lines(spark, sf_dir), "order_id", 0.2).select(
        "order_id", "product_id", "part")


@plan.add(f"""{BASE} SELECT id, CASE WHEN rk <= floor(of_ * 0.1::DOUBLE) THEN 'validation'
  ELSE 'train' END AS role FROM {ranked_sql('tx', 'id', '', 0)}""")
def random_split(spark, sf_dir):
    return sm.random_split(transactions(spark, sf_dir), "id", 0.1).select("id", "role")


@plan.add("""WITH w AS (SELECT event_id, event_type, event_id % 7 AS weight FROM events),
ends AS (SELECT *, (sum(weight) OVER (ORDER BY event_id))::DOUBLE - weight AS lo FROM w
  WHERE weight > 0),
draws AS (SELECT d AS draw, CAST(concat('0x', substr(md5(concat('0:', d)), 1, 13)) AS BIGINT)
  / 4503599627370496.0::DOUBLE * (SELECT sum(weight) FROM w)::DOUBLE AS at
  FROM (SELECT unnest(range((SELECT count(*) FROM events))) AS d))
SELECT draw, event_id, event_type, weight FROM draws ASOF JOIN ends ON draws.at >= ends.lo""")
def weighted_resample(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.pmod("event_id", F.lit(7)).alias("weight"))
    return sm.weighted_resample(events, "event_id", "weight", events.count()).select(
        "draw", "event_id", "event_type", "weight")


# -- scaling ------------------------------------------------------------------

@plan.add(f"""{BASE}, st AS (SELECT avg("Time") mt, stddev_samp("Time") dt, avg("V1") m1,
  stddev_samp("V1") d1, avg("V2") m2, stddev_samp("V2") d2 FROM tx WHERE "Class" = 0)
SELECT id, round(("Time" - mt) / dt, 6) AS "Time", round(("V1" - m1) / d1, 6) AS "V1",
  round(("V2" - m2) / d2, 6) AS "V2", "Class" FROM tx, st""")
def normalise(spark, sf_dir):
    tx = transactions(spark, sf_dir).drop("Amount")
    return rounded(sc.normalise(tx, tx.filter("Class = 0"), exclude=["id", "Class"]), 6)


@plan.add(f"""{BASE}, st AS (SELECT avg("V1") m1, stddev_pop("V1") d1, avg("V2") m2,
  stddev_pop("V2") d2 FROM tx WHERE "Class" = 0)
SELECT id, round(("V1" - m1) / d1, 6) AS "V1", round(("V2" - m2) / d2, 6) AS "V2", "Class"
FROM tx, st""")
def class_scaler(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    return rounded(sc.class_scaler(tx, ["Time", "V1", "V2", "Amount"], ["Time", "Amount"], 0), 6)


@plan.add(f"""{BASE} SELECT id, round("V1" / (SELECT stddev_samp("V1") FROM tx), 6) AS "V1",
  round("V2" / (SELECT stddev_samp("V2") FROM tx), 6) AS "V2" FROM tx""")
def scale_by_std(spark, sf_dir):
    return rounded(sc.scale_by_std(transactions(spark, sf_dir).select("id", "V1", "V2"),
                                   ["V1", "V2"]), 6)


@plan.add(f"""{BASE}, st AS (SELECT avg("V1") m1, stddev_pop("V1") d1, avg("V2") m2,
  stddev_pop("V2") d2 FROM tx WHERE "Class" = 0),
d AS (SELECT id, "Class", sqrt(pow(("V1" - m1) / d1, 2) + pow(("V2" - m2) / d2, 2)) AS distance
  FROM tx, st),
cut AS (SELECT quantile_cont(distance, 0.95) AS c FROM d WHERE "Class" = 0)
SELECT id, round(distance, 6) AS distance, CASE WHEN distance > c THEN 1 ELSE 0 END AS outlier
FROM d, cut""")
def one_class_outliers(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    return rounded(outliers(tx, tx, ["V1", "V2"], 0.05, ["id"]), 6)


# -- evaluation ---------------------------------------------------------------
# The score of a transaction is V1 / 100, its prediction V1 > 60.

SCORED = BASE + ', scored AS (SELECT *, "V1" / 100 AS score, CASE WHEN "V1" > 60 THEN 1 ELSE 0 END '\
    'AS guess FROM tx)'
MEASURES = """CASE WHEN tp + fp = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / (tp + fn) END AS recall"""


def beta_sql(*betas: int) -> str:
    return ", ".join(f"""CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE ELSE
      round((1.0::DOUBLE + {b * b}) * precision * recall / ({b * b} * precision + recall), 9)
      END AS f{b}""" for b in betas)


ROUND_PR = "round(precision, 9) AS precision, round(recall, 9) AS recall"
COUNTS = """count_if({y} AND {g})::BIGINT AS tp, count_if(NOT {y} AND {g})::BIGINT AS fp,
  count_if(NOT {y} AND NOT {g})::BIGINT AS tn, count_if({y} AND NOT {g})::BIGINT AS fn"""


def counts_sql(y: str, g: str) -> str:
    return COUNTS.format(y=y, g=g)


def _scored(spark, sf_dir):
    v = F.col("V1")
    return transactions(spark, sf_dir).withColumns(
        {"score": v / 100, "guess": (v > 60).cast("int")})


@plan.add(f"""{SCORED}, c AS (SELECT {counts_sql('"Class" = 1', 'guess = 1')} FROM scored),
m AS (SELECT *, {MEASURES} FROM c) SELECT tp, fp, tn, fn, {ROUND_PR} FROM m""")
def confusion_counts(spark, sf_dir):
    return rounded(ev.confusion_counts(_scored(spark, sf_dir), "Class", "guess"))


@plan.add(f"""{SCORED}, c AS (SELECT {counts_sql('"Class" = 1', 'guess = 1')} FROM scored),
m AS (SELECT *, {MEASURES} FROM c)
SELECT tp, fp, tn, fn, {ROUND_PR}, {beta_sql(1, 10, 50)} FROM m""")
def f_betas(spark, sf_dir):
    return rounded(ev.f_betas(ev.confusion_counts(_scored(spark, sf_dir), "Class", "guess")))


@plan.add(f"""{BASE} SELECT id, round(CASE WHEN "V1" = 0 THEN 0 ELSE "V2" / "V1" END, 9) AS ratio,
  round(CASE WHEN "V1" + "Amount" = 0 THEN 0 ELSE 5.0 * "V1" * "Amount"
    / nullif(4 * "V1" + "Amount", 0) END, 6) AS f2 FROM tx""")
def safe_ratios(spark, sf_dir):
    return transactions(spark, sf_dir).select(
        "id", F.round(safe_ratio(F.col("V2"), F.col("V1")), 9).alias("ratio"),
        F.round(f_beta(F.col("V1"), F.col("Amount"), 2), 6).alias("f2"))


@plan.add("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN 1 ELSE 0 END AS y,
  CASE WHEN o_custkey % 3 > 0 THEN 1 ELSE 0 END AS yhat FROM orders""")
def collapse_subclasses(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.pmod("o_orderkey", F.lit(4)).alias("y"),
        F.pmod("o_custkey", F.lit(3)).alias("yhat"))
    return ev.collapse_subclasses(rows, ["y", "yhat"])


THRESHOLD_COUNTS = counts_sql('"Class" = 1', "score > threshold")


@plan.add(f"""{SCORED}, g AS (SELECT DISTINCT score AS threshold FROM scored),
per AS (SELECT score, count_if("Class" = 1) AS pos, count_if("Class" = 0) AS neg
        FROM scored GROUP BY 1),
run AS (SELECT score AS threshold, CAST(sum(pos) OVER () - sum(pos) OVER (ORDER BY score) AS BIGINT)
    AS tp, CAST(sum(neg) OVER () - sum(neg) OVER (ORDER BY score) AS BIGINT) AS fp,
  CAST(sum(neg) OVER (ORDER BY score) AS BIGINT) AS tn,
  CAST(sum(pos) OVER (ORDER BY score) AS BIGINT) AS fn FROM per),
m AS (SELECT *, {MEASURES} FROM run)
SELECT round(threshold, 9) AS threshold, tp, fp, tn, fn, {ROUND_PR}, {beta_sql(1, 10, 50)} FROM m""")
def threshold_table(spark, sf_dir):
    return rounded(ev.threshold_table(_scored(spark, sf_dir), "score", "Class"))


GRID = [i * (59 / 472) / 60 for i in range(473)]


@plan.add(f"""{SCORED}, g AS (SELECT i * (59.0::DOUBLE / 472) / 60 AS threshold
  FROM (SELECT unnest(range(473)) AS i)),
c AS (SELECT threshold, {THRESHOLD_COUNTS} FROM scored, g GROUP BY threshold),
m AS (SELECT *, {MEASURES} FROM c)
SELECT round(threshold, 9) AS threshold, tp, fp, tn, fn, {ROUND_PR}, {beta_sql(1, 10, 50)} FROM m""")
def threshold_grid(spark, sf_dir):
    return rounded(ev.threshold_table(_scored(spark, sf_dir), "score", "Class", thresholds=GRID))


@plan.add(f"{SCORED} SELECT DISTINCT round(score, 9) AS threshold FROM scored")
def distinct_thresholds(spark, sf_dir):
    return rounded(ev.distinct_thresholds(_scored(spark, sf_dir), "score"))


CURVE = f"""{SCORED}, per AS (SELECT score AS threshold, count_if("Class" = 1) AS hits,
  count(*) AS n FROM scored GROUP BY 1),
curve AS (SELECT threshold, hits::BIGINT AS hits,
  CAST(sum(hits) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
  CAST(sum(n - hits) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp,
  CAST(sum(hits) OVER () AS BIGINT) AS positives FROM per),
pr AS (SELECT *, tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / positives AS recall FROM curve)"""


@plan.add(f"""{CURVE} SELECT round(threshold, 9) AS threshold, hits, tp, fp, positives, {ROUND_PR}
FROM pr""")
def pr_curve(spark, sf_dir):
    return rounded(ev.pr_curve(_scored(spark, sf_dir), "score", "Class"))


@plan.add(f"""{CURVE} SELECT round(sum(hits::DOUBLE / positives * precision), 9)
  AS average_precision FROM pr""")
def average_precision(spark, sf_dir):
    return rounded(ev.average_precision(_scored(spark, sf_dir), "score", "Class"))


@plan.add(f"""{CURVE}, b AS (SELECT * FROM pr WHERE recall > 0.9::DOUBLE
  ORDER BY threshold DESC LIMIT 1)
SELECT round(threshold, 9) AS threshold, {ROUND_PR}, {beta_sql(1)} FROM b""")
def threshold_at_recall(spark, sf_dir):
    return rounded(ev.threshold_at_recall(ev.pr_curve(_scored(spark, sf_dir), "score", "Class")))


SWEEP = f"""{with_views('b_op')}, p AS (SELECT user_id, order_id, product_id / 50.0::DOUBLE AS score,
  reordered AS target FROM b_op),
t AS (SELECT i * (0.5::DOUBLE / 99) AS threshold FROM (SELECT unnest(range(100)) AS i)),
f AS (SELECT threshold, user_id, order_id, coalesce(2.0::DOUBLE * count_if(target = 1 AND score >=
    threshold) / nullif(count_if(score >= threshold) + count_if(target = 1), 0), 0) AS f1
  FROM p, t GROUP BY ALL),
sweep AS (SELECT threshold, avg(f1) AS f1 FROM f GROUP BY threshold)"""


def _sweep(spark, sf_dir):
    rows = basket_lines(spark, sf_dir).select(
        "user_id", "order_id", (F.col("product_id") / 50.0).alias("score"),
        F.col("reordered").alias("target"))
    return ev.order_f1_by_threshold(rows, ["user_id", "order_id"], "score", "target",
                                    ev.even_thresholds())


@plan.add(f"{SWEEP} SELECT round(threshold, 9) AS threshold, round(f1, 9) AS f1 FROM sweep")
def order_f1_by_threshold(spark, sf_dir):
    return rounded(_sweep(spark, sf_dir))


@plan.add(f"""{SWEEP}, b AS (SELECT * FROM sweep ORDER BY round(f1, 12) DESC, threshold LIMIT 1)
SELECT round(CASE WHEN f1 > 0 THEN threshold ELSE 0 END, 9) AS threshold,
  round(CASE WHEN f1 > 0 THEN f1 ELSE 0 END, 9) AS f1 FROM b""")
def best_threshold(spark, sf_dir):
    return rounded(ev.best_threshold(_sweep(spark, sf_dir)))


CLASSES = """WITH p AS (SELECT CAST(user_id % 5 AS INT) AS y, CAST((user_id + CASE WHEN value > 60
  THEN 1 ELSE 0 END) % 6 AS INT) AS yhat FROM events)"""


def _classes(spark, sf_dir):
    move = (F.col("value") > 60).cast("int")
    return table(spark, sf_dir, "events").select(
        F.pmod("user_id", F.lit(5)).cast("int").alias("y"),
        F.pmod(F.col("user_id") + move, F.lit(6)).cast("int").alias("yhat"))


@plan.add(f"""{CLASSES} SELECT y, yhat, count(*) AS count,
  round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY y), 9) AS share FROM p GROUP BY y, yhat""")
def confusion_matrix(spark, sf_dir):
    return rounded(ev.confusion_matrix(_classes(spark, sf_dir), "y", "yhat", normalise=True))


def _multi_sql(weight: str) -> str:
    return f"""{CLASSES}, k AS (SELECT y AS c FROM p UNION SELECT yhat FROM p),
    s AS (SELECT c, (SELECT count(*) FROM p WHERE y = c) AS t, (SELECT count(*) FROM p
        WHERE yhat = c) AS g, (SELECT count(*) FROM p WHERE y = c AND yhat = c) AS tp FROM k),
    f AS (SELECT *, 2.0::DOUBLE * tp / (t + g) AS f1 FROM s)
    SELECT round(100.0::DOUBLE * sum(tp) / sum(t), 9) AS acc, round(avg(f1), 9) AS f1m,
      round(sum(f1 * {weight}) / sum({weight}), 9) AS f1w FROM f"""


@plan.add(_multi_sql("g"))
def multiclass_scores(spark, sf_dir):
    return rounded(ev.multiclass_scores(_classes(spark, sf_dir), "y", "yhat"))


@plan.add(_multi_sql("t"))
def multiclass_scores_true(spark, sf_dir):
    return rounded(ev.multiclass_scores(_classes(spark, sf_dir), "y", "yhat", weights="true"))


@plan.add(BASE + ", z AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", "Class" AS k, ("{c}" - (SELECT avg("{c}") FROM tx))
      / (SELECT stddev_samp("{c}") FROM tx) AS z FROM tx""" for c in ("Time", "V1", "V2", "Amount"))
    + """) SELECT "column", round(abs(avg(z) FILTER (k = 1) - avg(z) FILTER (k = 0))
  / (var_samp(z) FILTER (k = 1) + var_samp(z) FILTER (k = 0)), 6) AS fisher FROM z GROUP BY 1""")
def fisher_scores(spark, sf_dir):
    return rounded(ev.fisher_scores(transactions(spark, sf_dir), ["Time", "V1", "V2", "Amount"],
                                    "Class"), 6)


FOLD_GUESS = f"""{FOLDS}, guesses AS (SELECT fold, tx.id, "Class", CASE WHEN "V1" > 60 + fold * 3
  THEN 1 ELSE 0 END AS guess FROM folds JOIN tx USING (id) WHERE role = 'test')"""


def _fold_guesses(spark, sf_dir):
    test = _folds(spark, sf_dir).filter(F.col("role") == "test")
    rows = test.join(transactions(spark, sf_dir).select("id", "V1", "Class"), "id")
    return rows.withColumn("guess", (F.col("V1") > 60 + F.col("fold") * 3).cast("int"))


@plan.add(f"""{FOLD_GUESS} SELECT id, count(*) AS tested, count_if(guess = 1)::BIGINT AS "right",
  round(count_if(guess = 1)::DOUBLE / count(*), 9) AS rate FROM guesses WHERE "Class" = 1
GROUP BY id""")
def positive_hits(spark, sf_dir):
    return rounded(ev.positive_hits(_fold_guesses(spark, sf_dir), "id", "Class", "guess"))


MODELS = (40, 60, 80)


@plan.add(f"""{FOLDS}, g AS (SELECT t.model, fold, "Class", "V1" > t.model AS hit
  FROM folds JOIN tx USING (id), (VALUES (40), (60), (80)) t(model) WHERE role = 'test'),
c AS (SELECT model, fold, {counts_sql('"Class" = 1', 'hit')} FROM g GROUP BY model, fold),
m AS (SELECT *, {MEASURES} FROM c), fb AS (SELECT *, {beta_sql(1, 10, 50)} FROM m)
SELECT model, {", ".join(f"round(avg({c}), 6) AS {c}_mean" for c in (
    "tp", "tn", "fp", "fn", "precision", "recall", "f1", "f10", "f50"))},
  {", ".join(f"round(stddev_samp(f{b}), 6) AS f{b}_std" for b in (1, 10, 50))}
FROM fb GROUP BY model""")
def fold_summary(spark, sf_dir):
    # Three cut-offs stand for three models.
    rows = _fold_guesses(spark, sf_dir)
    counts = union_all([ev.confusion_counts(
        rows.withColumn("guess", (F.col("V1") > cut).cast("int")), "Class", "guess",
        by=["fold"]).withColumn("model", F.lit(cut)) for cut in MODELS])
    return rounded(ev.fold_summary(counts), 6)


# -- distributions ------------------------------------------------------------

def _bins_sql(n: int, low: float, width: float) -> str:
    return (f"bins AS (SELECT i::INT AS bin, {low} + i * {width}::DOUBLE AS low, "
            f"{low} + (i + 1) * {width}::DOUBLE AS high FROM (SELECT unnest(range({n})) AS i))")


@plan.add(f"""WITH {_bins_sql(24, 0, 1)}, h AS (SELECT (epoch(ts) % 86400) / 3600 AS x FROM events),
c AS (SELECT bin, count(x) AS count FROM bins LEFT JOIN h ON (x > low OR (bin = 0 AND x = low))
  AND x <= high GROUP BY bin)
SELECT bin, low, high, count, 0::BIGINT AS below, 0::BIGINT AS above, round(count::DOUBLE / sum(count) OVER (), 9) AS density
FROM bins JOIN c USING (bin)""")
def histogram(spark, sf_dir):
    seconds = F.pmod(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6, F.lit(86400))
    times = table(spark, sf_dir, "events").select((seconds / 3600).alias("x"))
    return rounded(dist.histogram(times, "x", list(range(25)), density=True, right=True))


@plan.add(f"""{BASE}, {_bins_sql(25, 0, 2)}, k AS (SELECT DISTINCT "Class" FROM tx),
c AS (SELECT k."Class", bin, low, high, count("V1") AS count FROM k JOIN bins ON true LEFT JOIN tx
  ON tx."Class" = k."Class" AND "V1" >= low AND ("V1" < high OR (bin = 24 AND "V1" = high))
  GROUP BY ALL),
o AS (SELECT "Class", count(*) FILTER ("V1" < 0) AS below, count(*) FILTER ("V1" > 50) AS above FROM tx GROUP BY 1)
SELECT c.*, below, above, round(count::DOUBLE / (2 * sum(count) OVER (PARTITION BY c."Class")), 9) AS density
FROM c JOIN o ON o."Class" = c."Class" """)
def histogram_by_class(spark, sf_dir):
    return rounded(dist.histogram(transactions(spark, sf_dir), "V1",
                                  [2.0 * i for i in range(26)], density=True, by=["Class"]))


@plan.add("""WITH s AS (SELECT count(*) AS n, 0.9::DOUBLE * least(stddev_samp(value),
    (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) / 1.34::DOUBLE)
    * pow(count(*), -0.2::DOUBLE) AS h FROM events),
g AS (SELECT 2.0::DOUBLE * j AS x FROM (SELECT unnest(range(51)) AS j))
SELECT x, round(sum(exp(-pow((x - value) / h, 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6)
  AS density FROM g, events, s GROUP BY x""")
def kde(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return rounded(dist.kde(events, "value", [2.0 * j for j in range(51)],
                            dist.bandwidth(events, "value")), 6)
