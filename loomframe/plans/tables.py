"""Projection, filter, join, set, summary, sort and sink queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.functions import columns as c
from loomframe.operators import relational as rel
from loomframe.plans.registry import Registry, rounded
from loomframe.plans.views import (
    basket_lines, basket_orders, sensor, table, transactions, with_views)
from loomframe.sources import tables as sinks

plan = Registry()
BASKETS = with_views("b_op", "b_products")
TX = with_views("tx")
SENSOR = with_views("sensor")

# -- projections and filters --------------------------------------------------


@plan.add("SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem")
def select_matching(spark, sf_dir):
    return rel.select_matching(table(spark, sf_dir, "lineitem"), "date$",
                               keep=["l_orderkey", "l_linenumber"])


@plan.add("SELECT * EXCLUDE (o_orderstatus, o_orderpriority) FROM orders")
def select_except(spark, sf_dir):
    return rel.select_except(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


@plan.add("SELECT event_id, event_type, value FROM events "
          "WHERE event_type IN ('error', 'click') AND user_id NOT IN (1, 2, 3)")
def filter_in(spark, sf_dir):
    events = rel.filter_in(table(spark, sf_dir, "events"), "event_type", ["error", "click"])
    return rel.filter_in(events, "user_id", [1, 2, 3], negate=True).select(
        "event_id", "event_type", "value")


@plan.add("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05::DOUBLE THEN 'high' "
          "ELSE 'low' END AS band FROM lineitem")
def conditional_value(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        c.if_else(F.col("l_discount") > 0.05, "high", "low").alias("band"))


@plan.add("SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 "
          "WHEN 'error' THEN 3 END AS event_type FROM events")
def recode(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return rel.recode(events, "event_type", {"click": 1, "view": 2, "error": 3})


@plan.add("SELECT o_orderkey, n_name AS nation FROM orders JOIN customer ON o_custkey = c_custkey "
          "LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 0")
def recode_table(spark, sf_dir):
    codes = table(spark, sf_dir, "nation").filter("n_regionkey <> 0").select(
        F.col("n_nationkey").alias("key"), F.col("n_name").alias("value"))
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rel.recode(orders.select("o_orderkey", F.col("c_nationkey").alias("nation")),
                      "nation", codes)


@plan.add(f"{SENSOR} SELECT subject_id, ts, event_id, activity_id, "
          "CASE WHEN subject_id = 8 THEN -s1 ELSE s1 END AS s1, "
          "CASE WHEN subject_id = 8 THEN -s2 ELSE s2 END AS s2 FROM sensor")
def negate_where(spark, sf_dir):
    return rel.negate_where(sensor(spark, sf_dir), F.col("subject_id") == 8, ["s1", "s2"])


@plan.add(f"{SENSOR} SELECT * FROM sensor WHERE s1 IS NOT NULL AND s2 IS NOT NULL")
def drop_incomplete(spark, sf_dir):
    return rel.drop_incomplete(sensor(spark, sf_dir))


@plan.add(f"{SENSOR} SELECT count(*) - count(subject_id) AS subject_id, count(*) - count(ts) AS ts, "
          "count(*) - count(event_id) AS event_id, count(*) - count(activity_id) AS activity_id, "
          "count(*) - count(s1) AS s1, count(*) - count(s2) AS s2 FROM sensor")
def null_counts(spark, sf_dir):
    return rel.null_counts(sensor(spark, sf_dir))


@plan.add("SELECT * FROM orders WHERE o_orderkey % 100 = 0")
def mod_sample(spark, sf_dir):
    return rel.mod_sample(table(spark, sf_dir, "orders"), "o_orderkey", 100)


# -- joins --------------------------------------------------------------------

@plan.add("SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, o_orderdate FROM lineitem "
          "LEFT JOIN orders ON o_orderkey = l_orderkey")
def enrich(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    out = rel.enrich(lines, table(spark, sf_dir, "orders"), ["o_orderkey"],
                     ["o_custkey", "o_orderdate"])
    return out.withColumnRenamed("o_orderkey", "l_orderkey")


@plan.add(f"{BASKETS} SELECT * FROM b_op WHERE order_id NOT IN "
          "(SELECT order_id FROM b_orders WHERE eval_set IN ('test', 'train'))")
def delete_matching(spark, sf_dir):
    gone = rel.filter_in(basket_orders(spark, sf_dir), "eval_set", ["test", "train"])
    return rel.delete_matching(basket_lines(spark, sf_dir), gone, ["order_id"])


@plan.add("SELECT * FROM lineitem WHERE l_orderkey IN "
          "(SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def keep_ids(spark, sf_dir):
    done = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("l_orderkey"))
    return rel.keep_ids(table(spark, sf_dir, "lineitem"), done, ["l_orderkey"])


@plan.add("SELECT d.doc_id, coalesce(l.toxic, CASE WHEN lang = 'en' THEN 1 ELSE 0 END) AS label "
          "FROM documents d LEFT JOIN labels l USING (doc_id)")
def override_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.col("lang") == "en").cast("int").alias("label"))
    given = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return rel.override_labels(docs, given, ["doc_id"], "label")


# -- set operations -----------------------------------------------------------

@plan.add("SELECT s_name AS name, s_acctbal AS acctbal, 'supplier' AS source FROM supplier "
          "UNION ALL SELECT c_name, c_acctbal, 'customer' FROM customer")
def union_tagged(spark, sf_dir):
    parts = {name: table(spark, sf_dir, name).select(
        F.col(f"{name[0]}_name").alias("name"), F.col(f"{name[0]}_acctbal").alias("acctbal"))
        for name in ("supplier", "customer")}
    return rel.union_tagged(parts)


# -- summaries ----------------------------------------------------------------

@plan.add("SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def value_counts(spark, sf_dir):
    return rel.value_counts(table(spark, sf_dir, "events"), "event_type")


def _quartiles_sql(col: str) -> str:
    return ", ".join([f"min({col}) AS min", *[
        f"round(quantile_cont({col}, {p}), 6) AS {n}" for n, p in (
            ("q1", 0.25), ("median", 0.5), ("q3", 0.75))], f"max({col}) AS max"])


@plan.add(f"{TX}" + " UNION ALL ".join(
    f"""SELECT '{col}' AS "column", count("{col}") AS count, round(avg("{col}"), 6) AS mean,
        round(stddev_samp("{col}"), 6) AS std, {_quartiles_sql(f'"{col}"::DOUBLE')} FROM tx"""
    for col in ("Time", "V1", "V2", "Amount", "Class")))
def describe(spark, sf_dir):
    return rounded(rel.describe(transactions(spark, sf_dir),
                                ["Time", "V1", "V2", "Amount", "Class"]), 6)


@plan.add("SELECT count(*) AS count FROM lineitem")
def count_rows(spark, sf_dir):
    return rel.count_rows(table(spark, sf_dir, "lineitem"))


@plan.add("SELECT round(avg(CASE WHEN l_returnflag = 'R' AND l_quantity > 20 THEN 1.0::DOUBLE "
          "ELSE 0 END), 9) AS share FROM lineitem")
def share_where(spark, sf_dir):
    condition = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 20)
    return rounded(rel.share_where(table(spark, sf_dir, "lineitem"), condition))


WEIGHTS = f"""{SENSOR}, counts AS (SELECT activity_id, count(*) AS count FROM sensor GROUP BY 1),
weights AS (SELECT *, (SELECT sum(count)::DOUBLE / count(*) FROM counts) / count AS weight
            FROM counts)"""


@plan.add(f"{WEIGHTS} SELECT activity_id, count, round(weight, 9) AS weight FROM weights")
def class_weights(spark, sf_dir):
    return rounded(rel.class_weights(sensor(spark, sf_dir), "activity_id"))


@plan.add(f"{WEIGHTS} SELECT event_id, activity_id, round(weight, 9) AS weight "
          "FROM sensor JOIN weights USING (activity_id)")
def row_weights(spark, sf_dir):
    return rounded(rel.row_weights(sensor(spark, sf_dir), "activity_id").select(
        "event_id", "activity_id", "weight"))


@plan.add("""SELECT step, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,
  round(avg(value) - 2.576 * stddev_pop(value), 6) AS lower,
  round(avg(value) + 2.576 * stddev_pop(value), 6) AS upper
FROM (SELECT CAST(extract(hour FROM ts) AS INT) AS step, value FROM events) GROUP BY step""")
def run_band(spark, sf_dir):
    # Users are the runs, the hour of the day is the step.
    runs = table(spark, sf_dir, "events").select(F.hour("ts").alias("step"), "value")
    return rounded(rel.run_band(runs, "step", "value"), 6)


def _box_sql(scale: dict[str, str]) -> str:
    return "SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT event_type, '{col}' AS "column", round(min(x), 6) AS min,
        round(quantile_cont(x, 0.25), 6) AS q1, round(quantile_cont(x, 0.5), 6) AS median,
        round(quantile_cont(x, 0.75), 6) AS q3, round(max(x), 6) AS max, round(avg(x), 6) AS mean
        FROM (SELECT event_type, {col} {scale[col]} AS x FROM points) GROUP BY event_type"""
        for col in scale) + ")"


POINTS = "WITH points AS (SELECT event_type, value, CAST(user_id AS DOUBLE) AS u FROM events) "


def _points(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_type", "value", F.col("user_id").cast("double").alias("u"))


@plan.add(POINTS + _box_sql({"value": "", "u": ""}))
def box_stats(spark, sf_dir):
    return rounded(rel.box_stats(_points(spark, sf_dir), ["event_type"], ["value", "u"]), 6)


@plan.add(POINTS + _box_sql({"value": "/ (SELECT max(value) FROM points)",
                             "u": "/ (SELECT max(u) FROM points)"}))
def box_stats_normalised(spark, sf_dir):
    return rounded(rel.box_stats(_points(spark, sf_dir), ["event_type"], ["value", "u"],
                                 normalise=True), 6)


# -- sorts and best rows ------------------------------------------------------

@plan.add("SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
          "ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top(spark, sf_dir):
    return rel.top(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
                   ["o_totalprice"], 25, tie=["o_orderkey"])


USER_STATS = """WITH m AS (SELECT user_id AS model, round(avg(value), 6) AS mean_score,
  round(stddev_samp(value), 6) AS std_score, max(value) AS max_score FROM events GROUP BY 1)"""


def _user_stats(spark, sf_dir):
    return rounded(table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("model")).agg(
        F.avg("value").alias("mean_score"), F.stddev_samp("value").alias("std_score"),
        F.max("value").alias("max_score")), 6)


@plan.add(USER_STATS + " UNION ALL ".join(
    f" (SELECT '{m}' AS metric, * FROM m ORDER BY {m} DESC NULLS LAST, model LIMIT 1)"
    for m in ("mean_score", "std_score", "max_score")))
def best_rows(spark, sf_dir):
    return rel.best_rows(_user_stats(spark, sf_dir), ["mean_score", "std_score", "max_score"],
                         tie=["model"])


@plan.add(USER_STATS + " SELECT * FROM (SELECT *, rank() OVER (ORDER BY max_score DESC) AS rank "
          "FROM m) WHERE rank <= 3")
def ranked_models(spark, sf_dir):
    return rel.ranked_models(_user_stats(spark, sf_dir), "max_score", 3, tie=["model"])


@plan.add(f"""{TX} SELECT "Amount", id, row_number() OVER (ORDER BY "Amount", id) AS position
FROM tx WHERE "Class" = 1""")
def sorted_values(spark, sf_dir):
    return rel.sorted_values(transactions(spark, sf_dir).filter("Class = 1"), "Amount", "id")


# -- scalar functions ---------------------------------------------------------

@plan.add(f"""{TX} SELECT id, round(CASE WHEN "Amount" = 0 THEN 0.01 ELSE ln("Amount") END, 9)
  AS "LogAmount" FROM tx""")
def log_amount(spark, sf_dir):
    return rounded(transactions(spark, sf_dir).select(
        "id", c.log_amount(F.col("Amount")).alias("LogAmount")))


@plan.add(f"""{TX} SELECT id, round(sin("Time" * (2 * pi() / 86400)), 6) + 0.0 AS "TimeComponent1",
  round(cos("Time" * (2 * pi() / 86400)), 6) + 0.0 AS "TimeComponent2" FROM tx""")
def radial_time(spark, sf_dir):
    sin, cos = c.radial_time(F.col("Time"))
    return rounded(transactions(spark, sf_dir).select(
        "id", sin.alias("TimeComponent1"), cos.alias("TimeComponent2")), 6)


@plan.add(f"""{TX} SELECT id, "Time" // 86400 AS "Day", ("Time" // 3600) % 24 AS "Hour",
  ("Time" // 60) % 60 AS "Min", "Time" % 60 AS "Second", (("Time" // 3600) % 24) // 3 AS "PartOfDay"
FROM tx""")
def time_parts(spark, sf_dir):
    return transactions(spark, sf_dir).select(
        "id", *[v.alias(k) for k, v in c.time_parts(F.col("Time")).items()])


@plan.add(f"""{TX} SELECT id, round("Time" / 3600, 9) AS hours,
  round("Time" / 3600 - floor("Time" / 3600), 9) AS part FROM tx""")
def hours(spark, sf_dir):
    h = c.hours(F.col("Time"))
    return rounded(transactions(spark, sf_dir).select(
        "id", h.alias("hours"), c.frac(h).alias("part")))


@plan.add(f"""{TX} SELECT id, round(greatest(least("V1", 70.0::DOUBLE), 30.0::DOUBLE), 9) AS "V1"
FROM tx""")
def clip(spark, sf_dir):
    return rounded(transactions(spark, sf_dir).select(
        "id", c.clip(F.col("V1"), 30.0, 70.0).alias("V1")))


@plan.add("""SELECT doc_id, concat(CASE WHEN doc_id < 10 THEN '0' ELSE '' END, doc_id, ' - ', lang)
  AS label FROM documents""")
def title_label(spark, sf_dir):
    name = F.concat_ws(" - ", F.col("doc_id").cast("string"), "lang", "source", F.lit("2018"))
    return table(spark, sf_dir, "documents").select("doc_id", c.title_label(name).alias("label"))


METHODS = {"view": "minmax", "click": "meanstd", "purchase": "ranked"}


@plan.add("SELECT event_id, CASE event_type WHEN 'view' THEN 'minmax' WHEN 'click' THEN 'meanstd' "
          "WHEN 'purchase' THEN 'ranked' WHEN 'error' THEN CASE WHEN value > 10 THEN 'ranked' ELSE 'meanstd' END "
          "END AS std_method FROM events")
def std_method_label(spark, sf_dir):
    """From a parameter list written out of each event; errors write the older spelling, signups no known method."""
    known = F.create_map(*[F.lit(x) for pair in METHODS.items() for x in pair])
    new = F.format_string("'standardisation_method': '%s'", F.coalesce(known[F.col("event_type")], "event_type"))
    old = F.format_string("'ranked_standardisation': %s", F.when(F.col("value") > 10, "True").otherwise("False"))
    text = F.concat(F.lit("{'props': "), F.coalesce("props", F.lit("None")), F.lit(", "),
                    F.when(F.col("event_type") == "error", old).otherwise(new), F.lit("}"))
    return table(spark, sf_dir, "events").select("event_id", c.std_method_label(text).alias("std_method"))


# -- SQL text -----------------------------------------------------------------

@plan.add("SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders "
          "WHERE o_totalprice > 100000 GROUP BY o_custkey")
def run_sql(spark, sf_dir):
    text = ("SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM {orders} "
            "WHERE o_totalprice > :floor GROUP BY o_custkey")
    return sinks.run_sql(spark, text, {"floor": 100000}, orders=table(spark, sf_dir, "orders"))
