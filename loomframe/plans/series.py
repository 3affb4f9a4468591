"""Sensor series: runs, interpolation, ranks, windows, subject splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.functions import normal
from loomframe.operators import scaling
from loomframe.operators import sequences as s
from loomframe.operators.ordered import Ordered, row_number
from loomframe.plans.registry import Registry, rounded
from loomframe.plans.views import sensor, table, transactions, with_views
from loomframe.session import stored

plan = Registry()
BASE = with_views("sensor")
ORDER = ["ts", "event_id"]
ID = "event_id"

RUNS = f"""{BASE}, flagged AS (
  SELECT *, CASE WHEN row_number() OVER w > 1 AND activity_id <> lag(activity_id) OVER w
            THEN 1 ELSE 0 END AS flag
  FROM sensor WINDOW w AS (PARTITION BY subject_id ORDER BY ts, event_id)),
runs AS (
  SELECT * EXCLUDE (flag), CAST(sum(flag) OVER (PARTITION BY subject_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run FROM flagged)"""
PLACED = f"""{RUNS}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY subject_id, run ORDER BY ts, event_id) AS n,
    count(*) OVER (PARTITION BY subject_id, run) AS total FROM runs)"""


def _runs(spark, sf_dir):
    """Numbered runs as the stored stage that the later steps start from."""
    return stored(s.segment_runs(sensor(spark, sf_dir), "subject_id", "activity_id", ORDER))


@plan.add(f"{RUNS} SELECT * FROM runs WHERE activity_id <> 1")
def segment_runs(spark, sf_dir):
    return s.segment_runs(sensor(spark, sf_dir), "subject_id", "activity_id", ORDER, drop=1)


@plan.add(f"""{BASE}, n AS (
  SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY ts, event_id) AS n FROM sensor),
near AS (
  SELECT *, last_value(CASE WHEN s1 IS NOT NULL THEN n END IGNORE NULLS) OVER up AS n0,
    last_value(s1 IGNORE NULLS) OVER up AS v0,
    first_value(CASE WHEN s1 IS NOT NULL THEN n END IGNORE NULLS) OVER down AS n1,
    first_value(s1 IGNORE NULLS) OVER down AS v1
  FROM n WINDOW up AS (PARTITION BY subject_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING
    AND CURRENT ROW), down AS (PARTITION BY subject_id ORDER BY n ROWS BETWEEN CURRENT ROW
    AND UNBOUNDED FOLLOWING))
SELECT event_id, round(CASE WHEN s1 IS NOT NULL THEN s1 WHEN n0 IS NULL THEN NULL
  WHEN n1 IS NULL THEN v0 ELSE v0 + (v1 - v0) / nullif(n1 - n0, 0) * (n - n0) END, 6) AS s1
FROM near""")
def interpolate_linear(spark, sf_dir):
    out = s.interpolate_linear(sensor(spark, sf_dir), "subject_id", ORDER, ["s1"])
    return rounded(out.select(ID, "s1"), 6)


@plan.add(f"""{BASE}, n AS (
  SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY ts, event_id) AS n FROM sensor),
k AS (SELECT subject_id, n AS x, s1 AS y, row_number() OVER w AS k,
        count(*) OVER (PARTITION BY subject_id) AS total
      FROM n WHERE s1 IS NOT NULL WINDOW w AS (PARTITION BY subject_id ORDER BY n)),
d AS (SELECT *, (lead(y) OVER w - y) / (lead(x) OVER w - x) AS d FROM k
      WINDOW w AS (PARTITION BY subject_id ORDER BY k)),
m AS (SELECT *, lag(d, 2) OVER w AS p2, lag(d, 1) OVER w AS p1, lead(d, 1) OVER w AS q1,
        lag(d, 3) OVER w AS p3, lead(d, 2) OVER w AS q2
      FROM d WINDOW w AS (PARTITION BY subject_id ORDER BY k)),
e AS (SELECT *,
  CASE WHEN k > 1 THEN p1 WHEN total = 2 THEN d ELSE 2 * d - q1 END AS l1,
  CASE WHEN k > 2 THEN p2 WHEN k = 2 THEN CASE WHEN total = 2 THEN p1 ELSE 2 * p1 - d END
       WHEN total = 2 THEN d ELSE 3 * d - 2 * q1 END AS l2,
  CASE WHEN k < total THEN d WHEN total = 2 THEN p1 ELSE 2 * p1 - p2 END AS r1,
  CASE WHEN k < total - 1 THEN q1
       WHEN k = total - 1 THEN CASE WHEN total = 2 THEN d ELSE 2 * d - p1 END
       WHEN total = 2 THEN p1 ELSE 3 * p1 - 2 * p2 END AS r2 FROM m),
f AS (SELECT *, abs(r2 - r1) AS wr, abs(l1 - l2) AS wl,
        max(abs(r2 - r1) + abs(l1 - l2)) OVER (PARTITION BY subject_id) AS most FROM e),
t AS (SELECT *, CASE WHEN wr + wl > 1e-9::DOUBLE * most THEN (wr * l1 + wl * r1) / (wr + wl)
             ELSE (l2 + r2) / 2 END AS t FROM f),
c AS (SELECT subject_id, x AS x0, y AS y0, t AS t0, d AS sl, lead(x) OVER w AS x1,
        lead(t) OVER w AS t1 FROM t WINDOW w AS (PARTITION BY subject_id ORDER BY k))
SELECT n.event_id, round(CASE WHEN n.s1 IS NOT NULL THEN n.s1 ELSE y0 + (n - x0) * (t0 + (n - x0)
    * ((3 * sl - 2 * t0 - t1) / (x1 - x0) + (n - x0) * ((t0 + t1 - 2 * sl)
    / ((x1 - x0) * (x1 - x0))))) END, 6) AS s1
FROM n LEFT JOIN c ON c.subject_id = n.subject_id AND n.s1 IS NULL AND n.n > c.x0 AND n.n < c.x1""")
def interpolate_akima(spark, sf_dir):
    out = s.interpolate_akima(sensor(spark, sf_dir), "subject_id", ORDER, ["s1"])
    return rounded(out.select(ID, "s1"), 6)


RANKS = f"""{BASE}, ranked AS (
  SELECT event_id, subject_id, CASE WHEN s1 IS NOT NULL THEN dense_rank() OVER (
      PARTITION BY subject_id ORDER BY s1 NULLS LAST) END AS r1,
    dense_rank() OVER (PARTITION BY subject_id ORDER BY s2) AS r2 FROM sensor),
shares AS (SELECT event_id, r1::DOUBLE / max(r1) OVER (PARTITION BY subject_id) AS a1,
             r2::DOUBLE / max(r2) OVER (PARTITION BY subject_id) AS a2 FROM ranked)"""


@plan.add(f"{RANKS} SELECT event_id, round(2 * a1 - 1, 9) AS s1, round(2 * a2 - 1, 9) AS s2 "
          "FROM shares")
def rank_symmetric(spark, sf_dir):
    return rounded(s.rank_symmetric(sensor(spark, sf_dir), "subject_id", ["s1", "s2"]).select(
        ID, "s1", "s2"))


def _ratio_sql(x: str, pair) -> str:
    def poly(coefficients) -> str:
        text = repr(coefficients[-1]) + "::DOUBLE"
        for c in coefficients[-2::-1]:
            text = f"({text} * {x} + {c!r}::DOUBLE)"
        return text
    return f"{poly(pair[0])} / {poly(pair[1])}"


def probit_sql(p: str) -> str:
    """The same published approximation, for a column name ``p`` within (0, 1)."""
    r, t = f"(0.180625::DOUBLE - ({p} - 0.5) * ({p} - 0.5))", f"sqrt(-ln(least({p}, 1 - {p})))"
    return f"""CASE WHEN abs({p} - 0.5) <= 0.425::DOUBLE THEN ({p} - 0.5) * {_ratio_sql(r, normal.CENTRE)}
      ELSE sign({p} - 0.5) * CASE WHEN {t} <= 5 THEN {_ratio_sql(f"({t} - 1.6::DOUBLE)", normal.MIDDLE)}
      ELSE {_ratio_sql(f"({t} - 5)", normal.FAR)} END END"""


def _edged(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN greatest(least({c}, 1 - 1e-5::DOUBLE), 1e-5::DOUBLE) END"


@plan.add(f"""{RANKS}, edged AS (SELECT event_id, {_edged('a1')} AS p1, {_edged('a2')} AS p2 FROM shares)
SELECT event_id, round({probit_sql('p1')}, 6) AS s1, round({probit_sql('p2')}, 6) AS s2 FROM edged""")
def rank_normalise(spark, sf_dir):
    return rounded(s.rank_normalise(sensor(spark, sf_dir), "subject_id", ["s1", "s2"]).select(
        ID, "s1", "s2"), 6)


@plan.add(f"""WITH shares AS (SELECT event_id, (value + 1) / 200 AS p FROM events)
SELECT event_id, round(CASE WHEN p > 0 AND p < 1 THEN {probit_sql('p')} END, 6) AS z FROM shares""")
def probit(spark, sf_dir):
    share = (F.col("value") + 1) / 200
    return rounded(table(spark, sf_dir, "events").select(
        ID, normal.probit(share).alias("z")), 6)


@plan.add(f"{PLACED} SELECT event_id, subject_id, run FROM placed WHERE n > 1 AND n <= total - 1")
def trim_runs(spark, sf_dir):
    return s.trim_runs(_runs(spark, sf_dir), ["subject_id", "run"], ORDER, 1).select(
        ID, "subject_id", "run")


@plan.add(f"""{PLACED} SELECT subject_id, run, (n - 1) // 2 AS block, round(avg(s1), 6) AS s1,
  round(avg(s2), 6) AS s2 FROM placed GROUP BY ALL HAVING count(*) = 2""")
def downsample(spark, sf_dir):
    return rounded(s.downsample(_runs(spark, sf_dir), ["subject_id", "run"], ORDER, 2,
                                ["s1", "s2"]), 6)


@plan.add(f"{PLACED} SELECT subject_id, run, (n - 1) // 3 AS block, s1, s2 FROM placed "
          "WHERE (n - 1) % 3 = 0")
def downsample_first(spark, sf_dir):
    return s.downsample(_runs(spark, sf_dir), ["subject_id", "run"], ORDER, 3, ["s1", "s2"],
                        method="first")


@plan.add(f"""{PLACED} SELECT a.subject_id, a.run, a.activity_id, a.n - 1 AS start,
  string_agg(CAST(b.event_id AS VARCHAR), ',' ORDER BY b.n) AS events
FROM placed a JOIN placed b ON a.subject_id = b.subject_id AND a.run = b.run
  AND b.n BETWEEN a.n AND a.n + 2
WHERE a.n - 1 <= a.total - 3 GROUP BY ALL""")
def sliding_windows(spark, sf_dir):
    out = s.sliding_windows(_runs(spark, sf_dir), ["subject_id", "run"], ORDER, 3, 1, [ID],
                            keep=["activity_id"])
    return out.select("subject_id", "run", "activity_id", "start", F.array_join(
        F.transform(ID, lambda e: e.cast("string")), ",").alias("events"))


@plan.add(f"{BASE} SELECT event_id, subject_id FROM (SELECT *, row_number() OVER "
          "(PARTITION BY subject_id ORDER BY ts, event_id) AS n FROM sensor) "
          "WHERE n BETWEEN 6 AND 15")
def slice_rows(spark, sf_dir):
    return s.slice_rows(sensor(spark, sf_dir), ["subject_id"], ORDER, 5, 10).select(
        ID, "subject_id")


@plan.add(with_views("tx") + """, t AS (SELECT "Time", count_if("Class" = 0) AS n0,
  count_if("Class" = 1) AS n1 FROM tx GROUP BY 1)
SELECT "Time", CAST(sum(n0) OVER (ORDER BY "Time") AS BIGINT) AS class_0,
  CAST(sum(n1) OVER (ORDER BY "Time") AS BIGINT) AS class_1 FROM t""")
def cumulative_classes(spark, sf_dir):
    return s.cumulative_classes(transactions(spark, sf_dir), "Time", "Class", [0, 1])


EPOCHS = """epochs AS (SELECT user_id AS run, n - 1 AS epoch, value / 100 AS validation,
    value / 200 AS test FROM (SELECT *, row_number() OVER (PARTITION BY user_id
      ORDER BY ts, event_id) AS n FROM events))"""


@plan.add(f"""WITH RECURSIVE {EPOCHS},
-- the training loop row by row: score to beat, epoch it was reached, epochs left to wait
walk AS (
  SELECT run, epoch, CASE WHEN validation > 0 THEN validation ELSE 0 END AS best,
    0::BIGINT AS best_epoch, CASE WHEN validation > 0 THEN 10 ELSE 9 END AS left_
  FROM epochs WHERE epoch = 0
  UNION ALL
  SELECT w.run, e.epoch,
    CASE WHEN w.left_ - 1 >= 0 AND e.validation > w.best THEN e.validation ELSE w.best END,
    CASE WHEN w.left_ - 1 >= 0 AND e.validation > w.best THEN e.epoch ELSE w.best_epoch END,
    CASE WHEN w.left_ - 1 >= 0 AND e.validation > w.best THEN 10 ELSE w.left_ - 1 END
  FROM walk w JOIN epochs e ON e.run = w.run AND e.epoch = w.epoch + 1),
chosen AS (SELECT run, arg_max(best_epoch, epoch) AS best_epoch FROM walk GROUP BY run)
SELECT c.run, c.best_epoch, e.validation, e.test FROM chosen c
JOIN epochs e ON e.run = c.run AND e.epoch = c.best_epoch""")
def best_epoch(spark, sf_dir):
    # Users are the training runs, their events the epochs.
    events = Ordered(table(spark, sf_dir, "events"), ["user_id"], ORDER).scan(n=row_number())
    scores = events.select(F.col("user_id").alias("run"), (F.col("n") - 1).alias("epoch"),
                           (F.col("value") / 100).alias("validation"),
                           (F.col("value") / 200).alias("test"))
    return s.best_epoch(scores, "run", "epoch", "validation", 10, report=["test"])


@plan.add(f"{BASE} SELECT event_id, subject_id, CASE subject_id WHEN 1 THEN 'test' "
          "WHEN 9 THEN 'validation' ELSE 'train' END AS role FROM sensor")
def subject_split(spark, sf_dir):
    return s.subject_split(sensor(spark, sf_dir), "subject_id", list(range(1, 10)), 1).select(
        ID, "subject_id", "role")


# -- scaling by subject -------------------------------------------------------

def _z_sql(stats: str, over: str = "") -> str:
    return f"""{BASE}{stats} SELECT event_id,
      round((s1 - m1) / nullif(d1, 0), 6) AS s1, round((s2 - m2) / nullif(d2, 0), 6) AS s2
      FROM sensor {over}"""


@plan.add(_z_sql(""", st AS (SELECT subject_id, avg(s1) AS m1, stddev_samp(s1) AS d1,
  avg(s2) AS m2, stddev_samp(s2) AS d2 FROM sensor GROUP BY 1)""", "JOIN st USING (subject_id)"))
def subject_zscore(spark, sf_dir):
    return rounded(scaling.subject_zscore(sensor(spark, sf_dir), "subject_id", ["s1", "s2"])
                   .select(ID, "s1", "s2"), 6)


@plan.add(_z_sql(""", st AS (SELECT avg(s1) AS m1, stddev_samp(s1) AS d1, avg(s2) AS m2,
  stddev_samp(s2) AS d2 FROM sensor WHERE subject_id NOT IN (1, 9))""", ", st"))
def population_zscore(spark, sf_dir):
    return rounded(scaling.population_zscore(
        sensor(spark, sf_dir), "subject_id", ["s1", "s2"], holdout=[1, 9]).select(
        ID, "s1", "s2"), 6)


@plan.add(f"""{BASE}, st AS (SELECT min(s1) AS a1, max(s1) AS b1, min(s2) AS a2, max(s2) AS b2
  FROM sensor WHERE subject_id NOT IN (1, 9))
SELECT event_id, round(2 * (s1 - a1) / (b1 - a1) - 1, 6) AS s1,
  round(2 * (s2 - a2) / (b2 - a2) - 1, 6) AS s2 FROM sensor, st""")
def population_minmax(spark, sf_dir):
    return rounded(scaling.population_minmax(
        sensor(spark, sf_dir), "subject_id", ["s1", "s2"], holdout=[1, 9]).select(
        ID, "s1", "s2"), 6)
