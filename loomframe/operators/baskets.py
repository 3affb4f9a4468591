"""Shopping-basket features and the score of 'same basket again'.

Inputs: ``orders(order_id, user_id, order_number, eval_set, days_since_prior_order)``,
``op(order_id, user_id, order_number, source, product_id, add_to_cart_order, reordered)``
with one row per (order, product), and ``products(product_id, aisle_id, department_id)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.functions.columns import safe_ratio
from loomframe.operators.joins import hashed_join, lookup_join, skew_join
from loomframe.operators.ordered import Ordered, first_row, groups_fit, previous, run_sum
from loomframe.operators.relational import label_by_presence
from loomframe.session import stored

# The feature names a model trained on these tables expects.
USER_FEATURES = [
    "orders_TOT_COUNT", "prods_ordered_DIST_CNT", "prods_ordered_TOT_CNT",
    "departments_DIST_CNT", "aisle_DIST_CNT", "prods_per_order_LOG_AVG",
    "prods_per_order_LOG_STD", "days_between_orders_LOG_AVG", "days_between_orders_LOG_STD",
    "prev_ord_as_pred_F1_AVG", "prev_ord_as_pred_PRECISION_AVG", "prev_ord_as_pred_RECALL_AVG",
    "prev_ord_as_pred_F1_STD", "prev_ord_as_pred_PRECISION_STD", "prev_ord_as_pred_RECALL_STD",
]
PRODUCT_FEATURES = [
    "orders_CNT", "reorders_CNT", "proportion_reordered_PROP", "occurances_per_order_PROP",
    "delay_between_reorders_LOG_AVG",
]
PAIR_FEATURES = [
    "purchased_CNT", "proportion_of_orders_containing_PROP", "position_in_cart_LOG_AVG",
    "position_in_cart_LOG_STD", "days_since_last_purchased_CNT",
    "delay_between_purchases_LOG_AVG",
]
FEATURES = PAIR_FEATURES + PRODUCT_FEATURES + USER_FEATURES


def _prior(df: DataFrame, flag: str = "source") -> DataFrame:
    return df.filter(F.col(flag) == "prior")


def _ln_stats(value, name: str) -> list:
    return [F.avg(F.ln(value)).alias(f"{name}_LOG_AVG"),
            F.stddev_pop(F.ln(value)).alias(f"{name}_LOG_STD")]


# -- order history ------------------------------------------------------------

def days_since_first(orders: DataFrame) -> DataFrame:
    """Add ``days_since_first_order``: summed gaps, 0 on the user's first order."""
    gap = F.coalesce(F.col("days_since_prior_order"), F.lit(0)).cast("long")
    out = Ordered(orders, ["user_id"], ["order_number"]).scan(
        _sum=run_sum(gap), _first=first_row(gap))
    return out.withColumn("days_since_first_order", F.col("_sum") - F.col("_first")).drop(
        "_sum", "_first")


def with_days(op: DataFrame, orders: DataFrame) -> DataFrame:
    """Basket lines with the day of their order, from ``days_since_first`` orders."""
    return hashed_join(op, orders.select("order_id", "days_since_first_order"), ["order_id"])


def days_since_prior_product(op: DataFrame, orders: DataFrame) -> DataFrame:
    """Days since the user last bought the product: null for a first purchase,
    0 for a re-order whose earlier purchase is not in the table."""
    lines = with_days(op, orders)
    seen = Ordered(lines, ["product_id", "user_id"], ["order_number"]).scan(
        _before=previous(F.col("days_since_first_order")))
    gap = F.coalesce(F.col("days_since_first_order") - F.col("_before"), F.lit(0))
    return seen.select(
        "product_id", "order_id", "user_id", "order_number", "days_since_first_order",
        F.when(F.col("reordered") == 1, gap).alias("days_since_prior_product_order"))


# -- basket repeat scores -----------------------------------------------------

def previous_basket_join(op: DataFrame) -> DataFrame:
    """Each line from the second order on, with 1 when the order before had the product."""
    before = op.select("user_id", "product_id", (F.col("order_number") + 1).alias("order_number"),
                       F.lit(1).alias("in_prev_order"))
    lines = op.filter(F.col("order_number") >= 2).select(
        "user_id", "order_number", "order_id", "product_id")
    return lines.join(before, ["user_id", "product_id", "order_number"], "left").withColumn(
        "in_prev_order", F.coalesce("in_prev_order", F.lit(0)))


def basket_transitions(orders: DataFrame, op: DataFrame) -> DataFrame:
    """Every product in an order or in the one before it, with both flags.

    Lines and orders move once, by user. Each order becomes one row with the list of its
    products, which meets the list of the order before it on the next row. Only when a
    user has very many orders, or an order very many lines, are rows dealt out instead.
    """
    num, known = "predicted_order_num", F.col("user_id").isNotNull()
    lines = op.filter(known).select("user_id", F.col("order_number").alias(num), "product_id")
    target = _prior(orders, "eval_set").filter(known).select(
        "user_id", F.col("order_number").alias(num), F.col("order_id").alias("predicted_order_id"))
    rows = lines.withColumns({"_order": F.lit(None).cast(target.schema["predicted_order_id"].dataType),
                              "_line": F.lit(True)}).unionByName(
        target.select("user_id", num, F.lit(None).cast(lines.schema["product_id"].dataType).alias("product_id"),
                      F.col("predicted_order_id").alias("_order"), F.lit(False).alias("_line")))
    if groups_fit(orders, ["user_id"]) and groups_fit(rows, ["user_id", num]):
        return _transitions_by_lists(rows, num)
    return _transitions_by_rows(rows, num)


def _transitions_by_lists(rows: DataFrame, num: str) -> DataFrame:
    product = F.col("product_id")
    # Lists leave nulls out: a line without product and an order without id are told apart.
    unnamed = F.max(F.col("_line") & product.isNull())
    each = rows.repartition("user_id").groupBy("user_id", num).agg(
        F.collect_list("product_id").alias("_own"), unnamed.alias("_unnamed"),
        F.collect_list(F.when(~F.col("_line"), F.struct("_order"))).alias("_targets"))
    each = each.withColumn("_own", F.when(F.col("_unnamed"), F.array_append("_own", F.lit(None).cast(
        rows.schema["product_id"].dataType))).otherwise(F.col("_own")))
    w = Window.partitionBy("user_id").orderBy(num)
    follows = F.lag(num).over(w) == F.col(num) - 1
    each = each.withColumn("_prev", F.when(follows, F.lag("_own").over(w)))
    each = each.filter((F.col(num) >= 2) & (F.size("_targets") > 0))
    own, prev = F.col("_own"), F.coalesce("_prev", F.slice("_own", 1, 0))

    def part(prev_flag: int, cur_flag: int, products) -> Column:
        return F.struct(F.lit(prev_flag).alias("prev"), F.lit(cur_flag).alias("cur"), products.alias("products"))

    # The functions on lists give each product once.
    parts = F.array(part(1, 1, F.array_intersect(own, prev)), part(0, 1, F.array_except(own, prev)),
                    part(1, 0, F.array_except(prev, own)))
    each = each.select("user_id", num, F.explode("_targets").alias("_target"), parts.alias("_parts"))
    each = each.select("user_id", num, "_target", F.explode("_parts").alias("_part"))
    return each.select("user_id", num, F.col("_target._order").alias("predicted_order_id"),
                       F.explode("_part.products").alias("product_id"), F.col("_part.prev").alias("in_prev_order"),
                       F.col("_part.cur").alias("in_cur_order"))


def _transitions_by_rows(rows: DataFrame, num: str) -> DataFrame:
    """One aggregate over the lines and the lines moved on by one order stands for the
    two-way outer join."""
    # A line counts for its own order and the next one, a target order for itself.
    own = F.struct(F.lit(0).alias("step"), F.lit(0).alias("prev"), F.col("_line").cast("int").alias("cur"))
    after = F.struct(F.lit(1).alias("step"), F.lit(1).alias("prev"), F.lit(0).alias("cur"))
    rows = rows.withColumn("_for", F.explode(F.when(F.col("_line"), F.array(own, after)).otherwise(F.array(own))))
    rows = rows.withColumn(num, F.col(num) + F.col("_for.step")).filter(F.col(num) >= 2)
    pairs = rows.groupBy("user_id", num, "product_id", "_line", "_order").agg(
        F.max("_for.prev").alias("in_prev_order"), F.max("_for.cur").alias("in_cur_order"),
        F.count(F.lit(1)).alias("_times"))
    # Copies of a target order give copies of its rows, as a join does.
    found = F.collect_list(F.when(~F.col("_line"), F.struct(F.col("_order"), F.col("_times"))))
    pairs = pairs.withColumn("_targets", found.over(Window.partitionBy("user_id", num)))
    copies = F.flatten(F.transform("_targets", lambda t: F.array_repeat(t["_order"], t["_times"].cast("int"))))
    return pairs.filter(F.col("_line")).select(
        "user_id", num, F.explode(copies).alias("predicted_order_id"), "product_id", "in_prev_order", "in_cur_order")


def _basket_sums(transitions: DataFrame) -> DataFrame:
    cur, prev = F.col("in_cur_order"), F.col("in_prev_order")
    return transitions.groupBy("user_id", "predicted_order_id", "predicted_order_num").agg(
        F.sum(cur).alias("actual_count"), F.sum(prev).alias("predicted_count"),
        F.sum(cur * prev).alias("_both"))


def basket_f1(transitions: DataFrame) -> DataFrame:
    """Recall, precision and F1 of predicting an order by the one before it."""
    r, p = F.col("prev_ord_as_pred_RECALL"), F.col("prev_ord_as_pred_PRECISION")
    f1 = F.when(r + p == 0, F.lit(0.0)).otherwise(F.try_divide(2 * r * p, r + p))
    return _basket_sums(transitions).select(
        "user_id", F.col("predicted_order_id").alias("order_id"),
        F.col("predicted_order_num").alias("order_num"),
        F.try_divide("_both", "actual_count").alias("prev_ord_as_pred_RECALL"),
        F.try_divide("_both", "predicted_count").alias("prev_ord_as_pred_PRECISION"),
    ).withColumn("prev_ord_as_pred_F1", f1)


def check_basket_counts(transitions: DataFrame) -> DataFrame:
    """Predicted orders with no actual or no predicted product."""
    return _basket_sums(transitions).drop("_both").filter(
        (F.col("actual_count") == 0) | (F.col("predicted_count") == 0))


def check_order_numbers(orders: DataFrame) -> DataFrame:
    """Users whose orders are not numbered 1..n."""
    return orders.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("count"), F.max("order_number").alias("max")).filter(
        F.col("count") != F.col("max"))


# -- user features ------------------------------------------------------------

def purchase_pairs(op: DataFrame) -> DataFrame:
    """Per (user, product) the prior purchases and whether one was a re-order."""
    return _prior(op).groupBy("user_id", "product_id").agg(
        F.count(F.lit(1)).alias("times"), F.max("reordered").alias("again"))


def order_sizes(op: DataFrame, products: DataFrame) -> DataFrame:
    """Lines of each prior order, and how many of them are of known products."""
    known = products.select("product_id").distinct().withColumn("_known", F.lit(1))
    lines = lookup_join(_prior(op).select("user_id", "order_id", "product_id"), known, ["product_id"], "left",
                        hot_from=op)
    return lines.groupBy("user_id", "order_id").agg(
        F.count(F.lit(1)).alias("_size"), F.count("_known").alias("_known"))


def user_counts(op: DataFrame, products: DataFrame, pairs: DataFrame | None = None,
                sizes: DataFrame | None = None) -> DataFrame:
    """Orders, distinct products, lines, departments and aisles per user.

    Pairs and orders are counted from the much smaller (user, product) and (user, order)
    tables, so lines are never copied once per distinct count; nor are pairs, unless a
    user has very many.
    """
    # Lines bound the pairs where these are not at hand.
    few = groups_fit(op if pairs is None else pairs, ["user_id"])
    pairs = purchase_pairs(op) if pairs is None else pairs
    sizes = order_sizes(op, products) if sizes is None else sizes
    # A pair is there once: its product counts on one of the rows the product has.
    rank = F.row_number().over(Window.partitionBy("product_id").orderBy("department_id", "aisle_id"))
    known = lookup_join(pairs.select("user_id", "product_id", "times"),
                        products.withColumn("_one", (rank == 1).cast("int")), ["product_id"], hot_from=op)
    if few:  # a user's departments and aisles make small sets
        departments, aisles = [F.size(F.collect_set(c)).cast("long") for c in ("department_id", "aisle_id")]
    else:
        known = known.groupBy("user_id", "department_id", "aisle_id").agg(
            F.sum("_one").alias("_one"), F.sum("times").alias("times"))
        departments, aisles = [F.count_distinct(c) for c in ("department_id", "aisle_id")]
    wares = known.groupBy("user_id").agg(
        F.sum("_one").alias("prods_ordered_DIST_CNT"), F.sum("times").alias("prods_ordered_TOT_CNT"),
        departments.alias("departments_DIST_CNT"), aisles.alias("aisle_DIST_CNT"))
    counts = sizes.filter(F.col("_known") > 0).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("orders_TOT_COUNT"))
    return counts.join(wares, "user_id").select("user_id", *USER_FEATURES[:5])


def user_basket_size_stats(op: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    if sizes is None:
        sizes = _prior(op).groupBy("user_id", "order_id").agg(F.count(F.lit(1)).alias("_size"))
    return sizes.groupBy("user_id").agg(*_ln_stats(F.col("_size"), "prods_per_order"))


def user_gap_stats(orders: DataFrame) -> DataFrame:
    return _prior(orders, "eval_set").groupBy("user_id").agg(
        *_ln_stats(F.col("days_since_prior_order") + 1, "days_between_orders"))


def user_repeat_stats(scores: DataFrame) -> DataFrame:
    measures = [f"prev_ord_as_pred_{m}" for m in ("F1", "PRECISION", "RECALL")]
    return scores.groupBy("user_id").agg(
        *[F.avg(m).alias(f"{m}_AVG") for m in measures],
        *[F.stddev_pop(m).alias(f"{m}_STD") for m in measures])


def join_features(frames: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """Inner join of feature tables that each hold a key once."""
    return reduce(lambda a, b: a.join(b, key), frames)


def user_features(orders: DataFrame, op: DataFrame, products: DataFrame,
                  pairs: DataFrame | None = None) -> DataFrame:
    scores = basket_f1(basket_transitions(orders, op))
    sizes = stored(order_sizes(op, products))
    return join_features([user_counts(op, products, pairs, sizes), user_basket_size_stats(op, sizes),
                          user_gap_stats(orders), user_repeat_stats(scores)], "user_id")


# -- product features ---------------------------------------------------------

def product_counts(op: DataFrame, orders: DataFrame,
                   pairs: DataFrame | None = None) -> DataFrame:
    """Buyers, re-buyers, their ratio, and lines per prior order."""
    total = _prior(orders, "eval_set").agg(F.count(F.lit(1))).scalar()
    pairs = purchase_pairs(op) if pairs is None else pairs
    # One row per buyer of the product: plain counts are the distinct counts.
    return pairs.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("orders_CNT"),
        F.count_if(F.col("again") == 1).alias("reorders_CNT"), F.sum("times").alias("_lines"),
    ).select("product_id", "orders_CNT", "reorders_CNT",
             F.try_divide("reorders_CNT", "orders_CNT").alias("proportion_reordered_PROP"),
             F.try_divide(F.col("_lines"), total).alias("occurances_per_order_PROP"))


def purchase_history(op: DataFrame, orders: DataFrame) -> DataFrame:
    """Per (user, product): purchases, cart position, first and last day.

    ``op`` has one row per (order, product), so purchases are orders.
    """
    n, day = F.col("order_number"), F.col("days_since_first_order")
    lines = with_days(_prior(op).select("order_id", "user_id", "order_number", "product_id", "add_to_cart_order",
                                        "reordered"), orders)
    if groups_fit(orders, ["user_id"]):  # a user's pairs lie together for the joins and counts by user
        lines = lines.repartition("user_id")
    return lines.groupBy("user_id", "product_id").agg(
        F.count(F.lit(1)).alias("times"), F.max("reordered").alias("again"),
        *_ln_stats(F.col("add_to_cart_order"), "position_in_cart"),
        F.min_by(day, n).alias("first_day"), F.max_by(day, n).alias("last_day"))


def product_reorder_delay(history: DataFrame) -> DataFrame:
    """ln((1 + days between first and last purchase) / re-orders), over all users."""
    again = history.withColumns({
        "_days": F.when(F.col("times") > 1, F.col("last_day") - F.col("first_day")),
        "_reorders": F.when(F.col("times") > 1, F.col("times") - 1)})
    sums = again.groupBy("product_id").agg(
        F.sum("_days").alias("_days"), F.sum("_reorders").alias("_reorders"))
    return sums.select("product_id", F.ln(F.try_divide(F.col("_days") + 1, F.col("_reorders")))
                       .alias("delay_between_reorders_LOG_AVG"))


def product_features(op: DataFrame, orders: DataFrame, history: DataFrame) -> DataFrame:
    return product_counts(op, orders, history).join(product_reorder_delay(history), "product_id")


# -- user-product features ----------------------------------------------------

def user_product_counts(history: DataFrame, users: DataFrame,
                        hot_from: DataFrame | None = None) -> DataFrame:
    """Orders with the product, their share of the user's orders, cart position."""
    own = users.select("user_id", "orders_TOT_COUNT")
    return skew_join(history, own, ["user_id"], hot_from=hot_from).select(
        "user_id", "product_id", F.col("times").alias("purchased_CNT"),
        F.try_divide("times", "orders_TOT_COUNT").alias(
            "proportion_of_orders_containing_PROP"),
        "position_in_cart_LOG_AVG", "position_in_cart_LOG_STD")


def current_orders(orders: DataFrame, users: DataFrame) -> DataFrame:
    """The order after the user's last prior one, per user."""
    nth = users.select("user_id", (F.col("orders_TOT_COUNT") + 1).alias("order_number"))
    return orders.join(nth, ["user_id", "order_number"]).select(
        "user_id", F.col("days_since_first_order").alias("current_day"))


def _recency() -> list:
    n = F.col("times")
    delay = F.ln(1 + F.col("last_day") - F.col("first_day")) / F.nullif(n - 1, F.lit(0))
    return [(F.col("current_day") - F.col("last_day")).alias("days_since_last_purchased_CNT"),
            F.when(n > 1, delay).alias("delay_between_purchases_LOG_AVG")]


def user_product_recency(history: DataFrame, orders: DataFrame, users: DataFrame,
                         hot_from: DataFrame | None = None) -> DataFrame:
    """Days from the last purchase to the current order; ln(days spanned) per re-order."""
    return skew_join(history, current_orders(orders, users), ["user_id"],
                     hot_from=hot_from).select("user_id", "product_id", *_recency())


# -- the whole feature matrix -------------------------------------------------

def all_features(orders: DataFrame, op: DataFrame, products: DataFrame) -> DataFrame:
    """Feature matrix of every (user, product) bought before, for the user's test
    or train order, with 1 in ``target`` when that order holds the product.

    ``op`` and ``orders`` are read several times: pass stored tables.
    """
    dated = days_since_first(orders)
    # The largest intermediate result, read by three branches: written once.
    history = stored(purchase_history(op, dated))
    # Read by two branches, one row per user; and one row per product, small enough to be
    # sent to all tasks unless there are very many.
    users = stored(user_features(orders, op, products, history))
    wares = stored(product_features(op, orders, history))
    wanted = orders.filter(F.col("eval_set").isin("test", "train")).select(
        "user_id", "order_id", "eval_set")
    # The narrow history meets users' orders, lines and products before the wide table of users.
    rows = skew_join(history, join_features([users.select("user_id"), wanted], "user_id"), ["user_id"],
                     hot_from=history)
    # Lines of earlier orders cannot match: the filter reaches the scan.
    recent = op.filter(F.col("source") != "prior")
    rows = label_by_presence(rows, recent, ["order_id", "product_id"])
    rows = lookup_join(rows, wares, ["product_id"], hot_from=history)
    per_user = join_features([users, current_orders(dated, users)], "user_id")
    share = F.try_divide("times", "orders_TOT_COUNT")
    rows = skew_join(rows, per_user, ["user_id"], hot_from=history).withColumns(
        {"purchased_CNT": F.col("times"), "proportion_of_orders_containing_PROP": share})
    return rows.select("*", *_recency()).select(
        "user_id", "product_id", "order_id", "eval_set", *FEATURES, "target")


# -- predictions to baskets ---------------------------------------------------

def basket_strings(predictions: DataFrame) -> DataFrame:
    """Per order the predicted product ids, ascending, joined by blanks."""
    chosen = F.when(F.col("order") == 1, F.col("product_id"))
    # One order's products: the cell of the output file is this list.
    return predictions.groupBy("order_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(chosen)),
                                 lambda p: p.cast("string")), " ").alias("products"))


def baseline_historical(features: DataFrame) -> DataFrame:
    """Predict what was in more than half of the user's orders."""
    return features.select(
        "user_id", "order_id", "product_id", "target",
        (F.col("proportion_of_orders_containing_PROP") > 0.5).cast("int").alias("prediction"))


def baseline_random(features: DataFrame, draw) -> DataFrame:
    """Predict with the chance that a random basket of usual size has the product."""
    rate = safe_ratio(safe_ratio(F.col("prods_ordered_TOT_CNT"), F.col("orders_TOT_COUNT")),
                      F.col("prods_ordered_DIST_CNT"))
    return features.select("user_id", "order_id", "product_id", "target",
                           (draw < rate).cast("int").alias("prediction"))
