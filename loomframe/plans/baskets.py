"""Basket feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe.functions.columns import mixed_draw, mixed_key
from loomframe.operators import baskets as b
from loomframe.operators import relational as rel
from loomframe.plans.registry import Registry, rounded
from loomframe.plans.views import basket_lines, basket_orders, basket_products, with_views
from loomframe.session import stored

plan = Registry()

# -- pieces of SQL shared by the checks ---------------------------------------

DATED = """dated AS (
  SELECT *, CAST(coalesce(sum(coalesce(days_since_prior_order, 0)) OVER (PARTITION BY user_id
      ORDER BY order_number ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS BIGINT)
    AS days_since_first_order FROM b_orders)"""
MOVES = """moves AS (
  SELECT user_id, order_number AS num, product_id, order_id, 1 AS cur, 0 AS prev FROM b_op
  WHERE order_number >= 2
  UNION ALL
  SELECT user_id, order_number + 1, product_id, NULL, 0, 1 FROM b_op),
transitions AS (
  SELECT m.user_id, m.num AS predicted_order_num, o.order_id AS predicted_order_id, m.product_id,
         max(m.prev) AS in_prev_order, max(m.cur) AS in_cur_order
  FROM moves m JOIN b_orders o ON o.user_id = m.user_id AND o.order_number = m.num
  WHERE o.eval_set NOT IN ('test', 'train') GROUP BY ALL)"""
SCORES = """scores AS (
  SELECT user_id, predicted_order_id AS order_id, predicted_order_num AS order_num, recall, prec,
         CASE WHEN recall + prec = 0 THEN 0.0::DOUBLE
              ELSE 2 * recall * prec / nullif(recall + prec, 0) END AS f1
  FROM (SELECT user_id, predicted_order_id, predicted_order_num,
          sum(in_cur_order * in_prev_order)::DOUBLE / nullif(sum(in_cur_order), 0) AS recall,
          sum(in_cur_order * in_prev_order)::DOUBLE / nullif(sum(in_prev_order), 0) AS prec
        FROM transitions GROUP BY ALL) t)"""
USERS = """u_counts AS (
  SELECT user_id, count(DISTINCT order_id) AS orders_TOT_COUNT,
    count(DISTINCT b_op.product_id) AS prods_ordered_DIST_CNT, count(*) AS prods_ordered_TOT_CNT,
    count(DISTINCT department_id) AS departments_DIST_CNT,
    count(DISTINCT aisle_id) AS aisle_DIST_CNT
  FROM b_op JOIN b_products USING (product_id) WHERE source = 'prior' GROUP BY user_id),
u_sizes AS (
  SELECT user_id, avg(ln(c)) AS prods_per_order_LOG_AVG, stddev_pop(ln(c)) AS prods_per_order_LOG_STD
  FROM (SELECT user_id, order_id, count(*) AS c FROM b_op WHERE source = 'prior' GROUP BY ALL)
  GROUP BY user_id),
u_gaps AS (
  SELECT user_id, avg(ln(nullif(days_since_prior_order + 1, 0))) AS days_between_orders_LOG_AVG,
    stddev_pop(ln(nullif(days_since_prior_order + 1, 0))) AS days_between_orders_LOG_STD
  FROM b_orders WHERE eval_set = 'prior' GROUP BY user_id),
u_repeat AS (
  SELECT user_id, avg(f1) AS prev_ord_as_pred_F1_AVG, avg(prec) AS prev_ord_as_pred_PRECISION_AVG,
    avg(recall) AS prev_ord_as_pred_RECALL_AVG, stddev_pop(f1) AS prev_ord_as_pred_F1_STD,
    stddev_pop(prec) AS prev_ord_as_pred_PRECISION_STD,
    stddev_pop(recall) AS prev_ord_as_pred_RECALL_STD
  FROM scores GROUP BY user_id),
users AS (
  SELECT * FROM u_counts JOIN u_sizes USING (user_id) JOIN u_gaps USING (user_id)
    JOIN u_repeat USING (user_id))"""
HISTORY = """history AS (
  SELECT op.user_id, op.product_id, count(DISTINCT op.order_id) AS purchased_CNT,
    count(*) AS times, avg(ln(add_to_cart_order)) AS position_in_cart_LOG_AVG,
    stddev_pop(ln(add_to_cart_order)) AS position_in_cart_LOG_STD,
    arg_min(days_since_first_order, op.order_number) AS first_day,
    arg_max(days_since_first_order, op.order_number) AS last_day
  FROM b_op op JOIN dated o ON o.order_id = op.order_id WHERE source = 'prior' GROUP BY ALL)"""
PRODUCTS = """p_counts AS (
  SELECT product_id, count(DISTINCT user_id) AS orders_CNT,
    count(DISTINCT CASE WHEN reordered = 1 THEN user_id END) AS reorders_CNT,
    count(DISTINCT CASE WHEN reordered = 1 THEN user_id END)::DOUBLE / count(DISTINCT user_id)
      AS proportion_reordered_PROP,
    count(*)::DOUBLE / (SELECT count(*) FROM b_orders WHERE eval_set = 'prior')
      AS occurances_per_order_PROP
  FROM b_op WHERE source = 'prior' GROUP BY product_id),
p_delay AS (
  SELECT product_id,
    ln(nullif((1 + sum(CASE WHEN times > 1 THEN last_day - first_day END))::DOUBLE
       / nullif(sum(CASE WHEN times > 1 THEN times - 1 END), 0), 0)) AS delay_between_reorders_LOG_AVG
  FROM history GROUP BY product_id)"""
PAIRS = """pairs AS (
  SELECT h.user_id, h.product_id, purchased_CNT,
    purchased_CNT::DOUBLE / orders_TOT_COUNT AS proportion_of_orders_containing_PROP,
    position_in_cart_LOG_AVG, position_in_cart_LOG_STD,
    c.days_since_first_order - last_day AS days_since_last_purchased_CNT,
    CASE WHEN times > 1 THEN ln(nullif(1 + last_day - first_day, 0)) / (times - 1) END
      AS delay_between_purchases_LOG_AVG
  FROM history h JOIN users u ON u.user_id = h.user_id
  JOIN dated c ON c.user_id = h.user_id AND c.order_number = u.orders_TOT_COUNT + 1)"""
FEATURE_ROWS = f"""feature_rows AS (
  SELECT pairs.user_id, pairs.product_id, t.order_id, t.eval_set,
    {", ".join(b.FEATURES)},
    CASE WHEN EXISTS (SELECT 1 FROM b_op x WHERE x.order_id = t.order_id
                      AND x.product_id = pairs.product_id) THEN 1 ELSE 0 END AS target
  FROM pairs JOIN p_counts USING (product_id) JOIN p_delay USING (product_id)
  JOIN users USING (user_id)
  JOIN b_orders t ON t.user_id = pairs.user_id AND t.eval_set IN ('test', 'train'))"""
ALL_STEPS = ",\n".join([DATED, MOVES, SCORES, USERS, HISTORY, PRODUCTS, PAIRS, FEATURE_ROWS])
BASE = with_views("b_op", "b_products")


def rounded_sql(cte: str, keys: list[str], values: list[str], source: str, digits: int = 9) -> str:
    cols = [*keys, *[f"round({v}, {digits}) AS {v}" for v in values]]
    return f"{BASE}, {cte} SELECT {', '.join(cols)} FROM {source}"


def _user_doubles() -> list[str]:
    return [c for c in b.USER_FEATURES if c.endswith(("_AVG", "_STD"))]


def _op(spark, sf_dir, orders=None):
    """The basket lines as the stored table they are in production."""
    return stored(basket_lines(spark, sf_dir, orders))


def _products(spark, sf_dir):
    """Written once, so that plans know how small the table is."""
    return stored(basket_products(spark, sf_dir))


# -- orders -------------------------------------------------------------------

@plan.add(f"{BASE}, {DATED} SELECT * FROM dated")
def days_since_first(spark, sf_dir):
    return b.days_since_first(basket_orders(spark, sf_dir))


@plan.add(f"""{BASE}, {DATED}
SELECT op.product_id, op.order_id, op.user_id, op.order_number, days_since_first_order,
  CASE WHEN reordered = 1 THEN coalesce(days_since_first_order - lag(days_since_first_order) OVER (
    PARTITION BY op.product_id, op.user_id ORDER BY op.order_number), 0) END
    AS days_since_prior_product_order
FROM b_op op JOIN dated o ON o.order_id = op.order_id""")
def days_since_prior_product(spark, sf_dir):
    orders = b.days_since_first(basket_orders(spark, sf_dir))
    return b.days_since_prior_product(basket_lines(spark, sf_dir), orders)


@plan.add(f"""{BASE} SELECT user_id, count(*) AS count, max(order_number) AS max FROM b_orders
WHERE eval_set <> 'prior' GROUP BY user_id HAVING count(*) <> max(order_number)""")
def check_order_numbers(spark, sf_dir):
    # Without the prior orders the numbering of most users has holes.
    orders = rel.filter_in(basket_orders(spark, sf_dir), "eval_set", ["prior"], negate=True)
    return b.check_order_numbers(orders)


# -- repeat scores ------------------------------------------------------------

@plan.add(f"""{BASE} SELECT c.user_id, c.order_number, c.order_id, c.product_id,
  CASE WHEN p.product_id IS NULL THEN 0 ELSE 1 END AS in_prev_order
FROM b_op c LEFT JOIN b_op p ON p.user_id = c.user_id AND p.product_id = c.product_id
  AND p.order_number = c.order_number - 1 WHERE c.order_number >= 2""")
def previous_basket_join(spark, sf_dir):
    return b.previous_basket_join(basket_lines(spark, sf_dir))


@plan.add(f"{BASE}, {MOVES} SELECT * FROM transitions")
def basket_transitions(spark, sf_dir):
    return b.basket_transitions(basket_orders(spark, sf_dir), basket_lines(spark, sf_dir))


@plan.add(f"""{BASE}, {MOVES}, {SCORES} SELECT user_id, order_id, order_num,
  round(recall, 9) AS prev_ord_as_pred_RECALL, round(prec, 9) AS prev_ord_as_pred_PRECISION,
  round(f1, 9) AS prev_ord_as_pred_F1 FROM scores""")
def basket_f1(spark, sf_dir):
    return rounded(b.basket_f1(basket_transitions(spark, sf_dir)))


@plan.add(f"""{BASE}, {MOVES} SELECT user_id, predicted_order_id, predicted_order_num,
  CAST(sum(in_cur_order) AS BIGINT) AS actual_count,
  CAST(sum(in_prev_order) AS BIGINT) AS predicted_count
FROM transitions GROUP BY ALL HAVING sum(in_cur_order) = 0 OR sum(in_prev_order) = 0""")
def check_basket_counts(spark, sf_dir):
    return b.check_basket_counts(basket_transitions(spark, sf_dir))


# -- user features ------------------------------------------------------------

@plan.add(f"{BASE}, {MOVES}, {SCORES}, {USERS} SELECT * FROM u_counts")
def user_counts(spark, sf_dir):
    return b.user_counts(_op(spark, sf_dir), _products(spark, sf_dir))


@plan.add(rounded_sql(f"{MOVES}, {SCORES}, {USERS}", ["user_id"],
                      ["prods_per_order_LOG_AVG", "prods_per_order_LOG_STD"], "u_sizes"))
def user_basket_size_stats(spark, sf_dir):
    return rounded(b.user_basket_size_stats(basket_lines(spark, sf_dir)))


@plan.add(rounded_sql(f"{MOVES}, {SCORES}, {USERS}", ["user_id"],
                      ["days_between_orders_LOG_AVG", "days_between_orders_LOG_STD"], "u_gaps"))
def user_gap_stats(spark, sf_dir):
    return rounded(b.user_gap_stats(basket_orders(spark, sf_dir)))


@plan.add(rounded_sql(f"{MOVES}, {SCORES}, {USERS}", ["user_id"],
                      [c for c in b.USER_FEATURES if c.startswith("prev_ord")], "u_repeat"))
def user_repeat_stats(spark, sf_dir):
    return rounded(b.user_repeat_stats(b.basket_f1(basket_transitions(spark, sf_dir))))


@plan.add(rounded_sql(f"{MOVES}, {SCORES}, {USERS}",
                      ["user_id", *[c for c in b.USER_FEATURES if c not in _user_doubles()]],
                      _user_doubles(), "users"))
def join_features(spark, sf_dir):
    return rounded(b.user_features(basket_orders(spark, sf_dir), _op(spark, sf_dir),
                                   _products(spark, sf_dir)))


# -- product and pair features ------------------------------------------------

@plan.add(rounded_sql(f"{DATED}, {HISTORY}, {PRODUCTS}",
                      ["product_id", "orders_CNT", "reorders_CNT"],
                      ["proportion_reordered_PROP", "occurances_per_order_PROP"], "p_counts"))
def product_counts(spark, sf_dir):
    return rounded(b.product_counts(basket_lines(spark, sf_dir), basket_orders(spark, sf_dir)))


def _history(spark, sf_dir, op):
    return b.purchase_history(op, b.days_since_first(basket_orders(spark, sf_dir)))


@plan.add(rounded_sql(f"{DATED}, {HISTORY}, {PRODUCTS}", ["product_id"],
                      ["delay_between_reorders_LOG_AVG"], "p_delay"))
def product_reorder_delay(spark, sf_dir):
    return rounded(b.product_reorder_delay(_history(spark, sf_dir, basket_lines(spark, sf_dir))))


PAIR_STEPS = f"{DATED}, {MOVES}, {SCORES}, {USERS}, {HISTORY}, {PAIRS}"


@plan.add(rounded_sql(PAIR_STEPS, ["user_id", "product_id", "purchased_CNT"],
                      ["proportion_of_orders_containing_PROP", "position_in_cart_LOG_AVG",
                       "position_in_cart_LOG_STD"], "pairs"))
def user_product_counts(spark, sf_dir):
    op = _op(spark, sf_dir)
    users = b.user_features(basket_orders(spark, sf_dir), op, _products(spark, sf_dir))
    return rounded(b.user_product_counts(_history(spark, sf_dir, op), users, hot_from=op))


@plan.add(rounded_sql(PAIR_STEPS, ["user_id", "product_id", "days_since_last_purchased_CNT"],
                      ["delay_between_purchases_LOG_AVG"], "pairs"))
def user_product_recency(spark, sf_dir):
    op, orders = _op(spark, sf_dir), basket_orders(spark, sf_dir)
    dated = b.days_since_first(orders)
    users = b.user_features(orders, op, _products(spark, sf_dir))
    return rounded(b.user_product_recency(_history(spark, sf_dir, op), dated, users, hot_from=op))


# -- the whole matrix and what is built on it ---------------------------------

def feature_matrix(spark, sf_dir):
    orders = stored(basket_orders(spark, sf_dir))
    return b.all_features(orders, _op(spark, sf_dir, orders), _products(spark, sf_dir))


@plan.add(f"{BASE}, {ALL_STEPS} SELECT user_id, product_id, order_id, eval_set, target, "
          + ", ".join(f"round({c}, 9) AS {c}" if c.endswith(("_AVG", "_STD", "_PROP")) else c
                      for c in b.FEATURES) + " FROM feature_rows")
def all_features(spark, sf_dir):
    return rounded(feature_matrix(spark, sf_dir))


@plan.add(f"{BASE}, {ALL_STEPS} SELECT user_id, product_id, order_id, target FROM feature_rows")
def label_by_presence(spark, sf_dir):
    return feature_matrix(spark, sf_dir).select("user_id", "product_id", "order_id", "target")


@plan.add(f"""{BASE}, {ALL_STEPS} SELECT user_id, order_id, product_id, target,
  CASE WHEN proportion_of_orders_containing_PROP > 0.5::DOUBLE THEN 1 ELSE 0 END AS prediction
FROM feature_rows""")
def baseline_historical(spark, sf_dir):
    return b.baseline_historical(feature_matrix(spark, sf_dir))


@plan.add(f"""{BASE}, {ALL_STEPS} SELECT user_id, order_id, product_id, target,
  CASE WHEN CAST(concat('0x', substr(md5(concat('3:', order_id, '-', product_id)), 1, 8)) AS BIGINT)
     / 4294967296.0::DOUBLE < coalesce((prods_ordered_TOT_CNT::DOUBLE / orders_TOT_COUNT)
     / prods_ordered_DIST_CNT, 0) THEN 1 ELSE 0 END AS prediction
FROM feature_rows""")
def baseline_random(spark, sf_dir):
    pair = F.concat_ws("-", F.col("order_id").cast("string"), F.col("product_id").cast("string"))
    return b.baseline_random(feature_matrix(spark, sf_dir), mixed_draw(mixed_key(pair, 3)))


@plan.add(f"""{BASE}, {ALL_STEPS} SELECT order_id, coalesce(string_agg(
  CASE WHEN proportion_of_orders_containing_PROP > 0.1::DOUBLE THEN CAST(product_id AS VARCHAR) END,
  ' ' ORDER BY product_id), '') AS products FROM feature_rows GROUP BY order_id""")
def basket_strings(spark, sf_dir):
    chosen = F.col("proportion_of_orders_containing_PROP") > 0.1
    return b.basket_strings(feature_matrix(spark, sf_dir).withColumn("order", chosen.cast("int")))


@plan.add(f"{BASE}, {ALL_STEPS} SELECT DISTINCT user_id, order_id FROM feature_rows")
def distinct_keys(spark, sf_dir):
    return rel.distinct_keys(feature_matrix(spark, sf_dir), ["user_id", "order_id"])


@plan.add(f"""{BASE}, {ALL_STEPS} SELECT user_id, product_id, order_id, eval_set, target, """
          + ", ".join(f"round(coalesce({c}, -1), 9) AS {c}"
                      if c.endswith(("_AVG", "_STD", "_PROP")) else f"coalesce({c}, -1) AS {c}"
                      for c in b.FEATURES) + " FROM feature_rows")
def fill_missing(spark, sf_dir):
    return rounded(rel.fill_missing(feature_matrix(spark, sf_dir), -1))
