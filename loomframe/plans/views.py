"""Input views derived from the given tables, as DataFrames and as SQL.

Each ``SQL`` text is a list of common table expressions for the checking
engine; ``with_views("orders_view", ...)`` puts the needed ones in front.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.operators.joins import hashed_join
from loomframe.operators.ordered import (
    Ordered, groups_fit, previous, row_number, whole_count)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- baskets ------------------------------------------------------------------

def basket_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: its number in the user's history and the gap in days."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("placed"))
    ranked = Ordered(orders, ["user_id"], ["placed", "order_id"]).scan(
        order_number=row_number(), n=whole_count(), before=previous(F.col("placed")))
    return ranked.select(
        "order_id", "user_id", "order_number",
        F.when(F.col("order_number") < F.col("n"), "prior")
        .when(F.pmod("user_id", F.lit(2)) == 0, "train").otherwise("test").alias("eval_set"),
        F.date_diff("placed", "before").alias("days_since_prior_order"))


def basket_lines(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """One row per (order, product) with cart position and re-order flag.

    ``orders``: the basket orders where they are stored, so that they are not made twice.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.pmod("l_partkey", F.lit(50)).alias("product_id"),
        "l_linenumber")
    # Cheap bounds: an order has at most its raw lines, a user buys a product at
    # most once per order.
    small = groups_fit(lines, ["order_id"])
    # One row per (order, product) before the join. Lines move once, by order; copies
    # collapse on the map side where an order has very many.
    lines = (lines.repartition("order_id") if small else lines).groupBy("order_id", "product_id").agg(
        F.min("l_linenumber").alias("ln"))
    orders = (basket_orders(spark, sf_dir) if orders is None else orders).select(
        "order_id", "user_id", "order_number", F.col("eval_set").alias("source"))
    op = hashed_join(lines, orders, ["order_id"])
    op = Ordered(op, ["order_id"], ["ln", "product_id"], small=small).scan(add_to_cart_order=row_number())
    few = groups_fit(table(spark, sf_dir, "orders"), ["o_custkey"])
    # By user alone: whoever stores the lines gets those of a user together, and counts
    # per user or order then shrink before they are shuffled.
    op = Ordered(op.repartition("user_id") if few else op, ["user_id", "product_id"], ["order_number"],
                 small=few).scan(_before=previous(F.col("order_number")))
    return op.select(
        "order_id", "user_id", "order_number", "source", "product_id", "add_to_cart_order",
        F.col("_before").isNotNull().cast("int").alias("reordered"))


def basket_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return part.select(
        F.pmod(key, F.lit(50)).alias("product_id"), F.pmod(key, F.lit(10)).alias("aisle_id"),
        F.pmod(key, F.lit(5)).alias("department_id")).distinct()


# -- mail ---------------------------------------------------------------------

def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail headers; ``rcpt`` null for orders without lines."""
    receivers = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.concat(F.lit("u"), F.pmod("l_suppkey", F.lit(40)).cast("string"),
                 F.lit("@corp.com")).alias("a"))
    receivers = receivers.groupBy("id").agg(
        F.array_join(F.array_sort(F.collect_set("a")), ", ").alias("list"))  # at most 40 names
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), "o_custkey", "o_orderpriority", "o_orderdate")

    def user(number: Column) -> Column:
        return F.concat(F.lit("u"), F.pmod(number, F.lit(40)).cast("string"), F.lit("@corp.com"))

    def every(n: int, k: int = 0) -> Column:
        return F.pmod("id", F.lit(n)) == k

    nine = F.pmod("o_custkey", F.lit(9)).cast("string")
    return o.join(receivers, "id", "left").select(
        "id", user(F.col("o_custkey")).alias("sender"),
        F.replace("list", F.lit(", "), F.when(every(2), ", ").otherwise(", \r\n\t")).alias("rcpt"),
        F.when(every(3), user(F.col("o_custkey") + 7)).alias("cc"),
        F.when(every(5), F.concat(F.lit("Doe, J"), nine, F.lit(" <X"), nine,
                                  F.lit(">, Roe, K <Y>")))
        .when(every(5, 1), "").alias("bcc"),
        F.concat(F.when(every(4), "").when(every(4, 1), "RE: ").when(every(4, 2), "fw: ")
                 .otherwise("RE: FW: "), F.lit("Topic "), "o_orderpriority").alias("subject"),
        F.concat(F.date_format("o_orderdate", "EEE, dd MMM yyyy HH:mm:ss"),
                 F.lit(" -0700 (PDT)")).alias("date"))


# -- sensor series and card transactions --------------------------------------

def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("subject_id"), "ts", "event_id",
        F.when(F.weekday("ts") >= 5, 1).otherwise(0).alias("activity_id"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("s1"),
        F.col("value").alias("s2"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    value, key = F.col("value"), F.col("event_id")
    return table(spark, sf_dir, "events").select(
        key.alias("id"),
        (F.unix_timestamp(F.col("ts").cast("timestamp")) - 1704067200).cast("long").alias("Time"),
        value.alias("V1"), (value * F.pmod(key, F.lit(7))).alias("V2"),
        F.when(F.pmod(key, F.lit(50)) == 0, 0.0).otherwise(value).alias("Amount"),
        F.when((F.col("event_type") == "error") & (value > 70), 1).otherwise(0).alias("Class"))


SQL = {
    "b_orders": """b_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, rn AS order_number,
   CASE WHEN rn < n THEN 'prior' WHEN o_custkey % 2 = 0 THEN 'train' ELSE 'test' END AS eval_set,
   CAST(date_diff('day', pd, o_orderdate) AS INT) AS days_since_prior_order
  FROM (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY o_custkey) AS n,
               lag(o_orderdate) OVER w AS pd
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) x)""",
    "b_op": """b_op AS (
  SELECT order_id, user_id, order_number, source, product_id,
   row_number() OVER (PARTITION BY order_id ORDER BY ln, product_id) AS add_to_cart_order,
   CASE WHEN row_number() OVER (PARTITION BY user_id, product_id ORDER BY order_number) > 1
        THEN 1 ELSE 0 END AS reordered
  FROM (SELECT order_id, user_id, order_number, eval_set AS source, l_partkey % 50 AS product_id,
               min(l_linenumber) AS ln
        FROM lineitem JOIN b_orders ON l_orderkey = order_id GROUP BY 1,2,3,4,5) x)""",
    "b_products": """b_products AS (
  SELECT DISTINCT p_partkey % 50 AS product_id, p_partkey % 10 AS aisle_id,
         p_partkey % 5 AS department_id FROM part)""",
    "messages": """messages AS (
  SELECT o_orderkey AS id, concat('u', o_custkey % 40, '@corp.com') AS sender,
   replace(string_agg(DISTINCT 'u' || CAST(l_suppkey % 40 AS VARCHAR) || '@corp.com', ', '
             ORDER BY 'u' || CAST(l_suppkey % 40 AS VARCHAR) || '@corp.com'), ', ',
     CASE WHEN o_orderkey % 2 = 0 THEN ', ' ELSE concat(', ', chr(13), chr(10), chr(9)) END) AS rcpt,
   CASE WHEN o_orderkey % 3 = 0 THEN concat('u', (o_custkey + 7) % 40, '@corp.com') END AS cc,
   CASE WHEN o_orderkey % 5 = 0 THEN concat('Doe, J', o_custkey % 9, ' <X', o_custkey % 9,
                                            '>, Roe, K <Y>')
        WHEN o_orderkey % 5 = 1 THEN '' END AS bcc,
   concat(CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'RE: ' WHEN 2 THEN 'fw: '
               ELSE 'RE: FW: ' END, 'Topic ', o_orderpriority) AS subject,
   concat(strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S'), ' -0700 (PDT)') AS date
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
  GROUP BY o_orderkey, o_custkey, o_orderpriority, o_orderdate)""",
    "sensor": """sensor AS (
  SELECT user_id AS subject_id, ts, event_id,
   CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS activity_id,
   CASE WHEN event_type = 'error' THEN NULL ELSE value END AS s1, value AS s2 FROM events)""",
    "tx": """tx AS (
  SELECT event_id AS id,
   CAST(epoch(date_trunc('second', ts)) AS BIGINT) - 1704067200 AS "Time",
   value AS "V1", value * (event_id % 7) AS "V2",
   CASE WHEN event_id % 50 = 0 THEN 0.0::DOUBLE ELSE value END AS "Amount",
   CASE WHEN event_type = 'error' AND value > 70 THEN 1 ELSE 0 END AS "Class" FROM events)""",
}
NEEDS = {"b_op": ["b_orders"]}


def with_views(*names: str) -> str:
    """``WITH`` clause holding the named views and what they build on."""
    order: list[str] = []
    for name in names:
        order += [n for n in [*NEEDS.get(name, []), name] if n not in order]
    return "WITH " + ",\n".join(SQL[n] for n in order) + "\n"
