"""Intermediate models: one row per order, per person, per seller.

Each child table is aggregated to order grain *before* it meets the orders, so
the joins never fan out and every join input is already hash-partitioned by
``order_id`` (the aggregates' own shuffle), which Spark reuses for the joins.
Person and seller metrics are single grouping-sets passes (see below), so no
join result is evaluated twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import avg_exact, elapsed_days, interval_days, ratio
from ..operators.grouping import top_row_per_key
from ..operators.windows import Key


def _not_excluded(col: str, excluded) -> F.Column:
    # `status != 'x'` / NOT IN: a NULL status is dropped too (three-valued logic)
    return ~F.col(col).isin(list(excluded))


def order_item_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.round(F.sum("item_price"), 2).alias("total_items_price"),
        F.round(F.sum("freight_cost"), 2).alias("total_freight"),
        F.count("item_sequence").alias("item_count"))


def order_payment_totals(payments: DataFrame) -> DataFrame:
    """Per order: total paid, most installments and the dominant payment type
    (largest amount; ties → lowest payment_seq, then type). The choice is a minimum
    of (amount, seq, type) structs, which combines map-side."""
    dominant = F.min(F.struct((-F.col("payment_amount")).alias("a"), F.col("payment_seq").alias("s"), F.col("payment_type").alias("t")))["t"]
    return payments.groupBy("order_id").agg(
        F.round(F.sum("payment_amount"), 2).alias("total_payment"),
        F.max("installments").alias("max_installments"),
        dominant.alias("primary_payment_type"))


def order_review_totals(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        avg_exact("score", 1).alias("avg_review_score"),
        F.bool_or("is_low_score").alias("has_low_score"),
        F.count(F.lit(1)).alias("review_count"))


def int_orders_enriched(stg_orders: DataFrame, stg_customers: DataFrame, stg_order_items: DataFrame,
                        stg_order_payments: DataFrame, stg_order_reviews: DataFrame) -> DataFrame:
    o = stg_orders
    c = stg_customers.select("customer_id", "customer_unique_id",
                             F.col("city").alias("customer_city"), F.col("state").alias("customer_state"))
    oa, pa, ra = (order_item_totals(stg_order_items), order_payment_totals(stg_order_payments),
                  order_review_totals(stg_order_reviews))
    j = (o.join(c, "customer_id")
          .join(oa, "order_id", "left").join(pa, "order_id", "left").join(ra, "order_id", "left"))
    delivered, estimated, purchased = F.col("delivered_at"), F.col("estimated_delivery_at"), F.col("purchased_at")
    return j.select(
        "order_id", "customer_id", "customer_unique_id", "customer_city", "customer_state",
        "order_status", "purchased_at", "approved_at", "shipped_at", "delivered_at", "estimated_delivery_at",
        F.coalesce("total_items_price", F.lit(0)).cast("decimal(28,2)").alias("total_items_price"),
        F.coalesce("total_freight", F.lit(0)).cast("decimal(28,2)").alias("total_freight"),
        F.coalesce("item_count", F.lit(0)).alias("item_count"),
        F.coalesce("total_payment", F.lit(0)).cast("decimal(28,2)").alias("total_payment"),
        "primary_payment_type",
        F.coalesce("max_installments", F.lit(1)).alias("max_installments"),
        "avg_review_score",
        F.coalesce("has_low_score", F.lit(False)).alias("has_low_score"),
        F.coalesce("review_count", F.lit(0)).alias("review_count"),
        elapsed_days(delivered, estimated, 1).alias("delivery_delay_days"),
        F.coalesce(delivered > estimated, F.lit(False)).alias("is_late_delivery"),
        elapsed_days(delivered, purchased, 1).alias("total_delivery_days"))


def customer_preferred_state(base: DataFrame) -> DataFrame:
    """Most frequent state per person; ties → state name ascending."""
    counts = base.groupBy("customer_unique_id", "customer_state").agg(F.count(F.lit(1)).alias("state_orders"))
    best = top_row_per_key(counts, ["customer_unique_id"],
                           [Key("state_orders", True), Key("customer_state", False, False)])
    return best.select("customer_unique_id", F.col("customer_state").alias("preferred_state"))


def _sum_if(cond, c) -> F.Column:
    return F.sum(F.when(cond, F.col(c) if isinstance(c, str) else c))


def _mode_if(cond, value: str, count: str) -> F.Column:
    """Value with the highest count among rows where ``cond``; ties → value
    ascending, NULL last (``min_by`` skips rows whose ordering is NULL)."""
    v = F.col(value)
    return F.min_by(v, F.when(cond, F.struct((-F.col(count)).alias("c"), v.isNull().alias("n"), v.alias("v"))))


def int_customer_metrics(oe: DataFrame, excluded=("canceled",)) -> DataFrame:
    """Lifetime metrics per person in one pass over the orders.

    A single grouping-sets aggregation emits one row per (person, order) with
    that order's partial sums, and one row per (person, state) with its row
    count; one per-person aggregation then combines them. Distinct orders are
    the count of (person, order) rows, so no DISTINCT aggregate, no second
    scan of the order model and no join back for the preferred state.
    """
    base = oe.where(_not_excluded("order_status", excluded) & F.col("purchased_at").isNotNull())
    keys = ["customer_unique_id", "order_id", "customer_state"]
    g = base.groupingSets([["customer_unique_id", "order_id"], ["customer_unique_id", "customer_state"]], *keys).agg(
        F.grouping_id().alias("_gid"),
        F.count(F.lit(1)).alias("_rows"),
        F.sum("total_payment").alias("_pay"), F.count("total_payment").alias("_npay"),
        F.min("purchased_at").alias("_first"), F.max("purchased_at").alias("_last"),
        F.sum(F.col("avg_review_score").cast("decimal(20,4)")).alias("_rev"),
        F.count("avg_review_score").alias("_nrev"))
    per_order, per_state = F.col("_gid") == 1, F.col("_gid") == 2
    per = g.groupBy("customer_unique_id").agg(
        F.count(F.when(per_order, 1)).alias("total_orders"),
        _sum_if(per_order, "_pay").alias("_pay"), _sum_if(per_order, "_npay").alias("_npay"),
        F.min(F.when(per_order, F.col("_first"))).alias("first_order_at"),
        F.max(F.when(per_order, F.col("_last"))).alias("last_order_at"),
        _sum_if(per_order, "_rev").alias("_rev"), _sum_if(per_order, "_nrev").alias("_nrev"),
        _mode_if(per_state, "customer_state", "_rows").alias("preferred_state"))
    life = interval_days("last_order_at", "first_order_at")
    return per.select(
        "customer_unique_id", "total_orders",
        F.round("_pay", 2).alias("total_spend"),
        F.round(F.col("_pay") / F.nullif(F.col("_npay"), F.lit(0)), 2).alias("avg_order_value"),
        "first_order_at", "last_order_at",
        life.alias("customer_lifetime_days"),
        F.when(F.col("total_orders") > 1, ratio(life, F.col("total_orders") - 1, 0)).alias("avg_days_between_orders"),
        F.round(F.col("_rev") / F.nullif(F.col("_nrev"), F.lit(0)), 2).alias("avg_review_score"),
        "preferred_state")


def seller_top_category(base: DataFrame) -> DataFrame:
    """Category with the most item revenue per seller; ties → name ascending."""
    rev = base.groupBy("seller_id", "category_name_en").agg(F.sum("item_price").alias("category_revenue"))
    best = top_row_per_key(rev, ["seller_id"], [Key("category_revenue", True), Key("category_name_en", False, False)])
    return best.select("seller_id", F.col("category_name_en").alias("top_category"))


def _items_of_open_orders(stg_order_items: DataFrame, stg_products: DataFrame, oe: DataFrame,
                          excluded) -> DataFrame:
    """Item rows of non-excluded orders with their order's context and, when the
    product is known, its category (one join pass shared by both aggregates)."""
    ctx = oe.where(_not_excluded("order_status", excluded)).select(
        "order_id", "avg_review_score", "is_late_delivery", "delivery_delay_days", "has_low_score")
    prods = stg_products.select("product_id", "category_name_en", F.lit(True).alias("_has_product"))
    return (stg_order_items.select("order_id", "seller_id", "product_id", "item_sequence", "item_price",
                                   "freight_cost")
            .join(ctx, "order_id")
            .join(prods, "product_id", "left")
            .withColumn("_has_product", F.coalesce("_has_product", F.lit(False))))


def int_seller_metrics(stg_order_items: DataFrame, stg_products: DataFrame, oe: DataFrame,
                       excluded=("canceled",)) -> DataFrame:
    """Per-seller volume, revenue, satisfaction and delivery metrics, and the
    seller's top category, from one pass over the item rows.

    One grouping-sets aggregation emits (seller, order) rows with the order's
    partial sums and (seller, category) rows with category revenue; a single
    per-seller aggregation combines them (distinct orders = number of (seller,
    order) rows). The item ⋈ order ⋈ product join is evaluated once.
    """
    base = _items_of_open_orders(stg_order_items, stg_products, oe, excluded)
    late = F.col("is_late_delivery")
    # category is NULL only for items whose product is unknown: they count for
    # the seller but cannot be its top category (the original joins products)
    cat = F.when(F.col("_has_product"), F.col("category_name_en"))
    base = base.withColumn("_cat", cat)
    keys = ["seller_id", "order_id", "_cat"]
    g = base.groupingSets([["seller_id", "order_id"], ["seller_id", "_cat"]], *keys).agg(
        F.grouping_id().alias("_gid"),
        F.count(F.lit(1)).alias("_items"),
        F.sum("item_price").alias("_rev"), F.count("item_price").alias("_nprice"),
        F.sum(F.col("avg_review_score").cast("decimal(20,4)")).alias("_revw"), F.count("avg_review_score").alias("_nrevw"),
        F.count(F.when(F.col("has_low_score"), 1)).alias("_low"),
        F.count(F.when(late, 1)).alias("_late"),
        F.sum(F.when(late, F.col("delivery_delay_days").cast("decimal(20,4)"))).alias("_late_days"),
        F.count(F.when(late, F.col("delivery_delay_days"))).alias("_nlate_days"))
    # (seller, order) rows are added up by hash first: the choice of a category keeps strings, which
    # makes an aggregation sort its rows, so it gets one row per seller and one per category of it
    parts = ["_items", "_rev", "_nprice", "_revw", "_nrevw", "_low", "_late", "_late_days", "_nlate_days"]
    g = g.groupBy("seller_id", "_gid", "_cat").agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(c) for c in parts])
    per_order = F.col("_gid") == 1
    per_cat = (F.col("_gid") == 2) & F.col("_cat").isNotNull()
    per = g.groupBy("seller_id").agg(
        _sum_if(per_order, "_rows").alias("total_orders"),
        _sum_if(per_order, "_items").alias("total_items_sold"),
        _sum_if(per_order, "_rev").alias("_rev"), _sum_if(per_order, "_nprice").alias("_nprice"),
        _sum_if(per_order, "_revw").alias("_revw"), _sum_if(per_order, "_nrevw").alias("_nrevw"),
        _sum_if(per_order, "_low").alias("low_score_orders"),
        _sum_if(per_order, "_late").alias("late_delivery_count"),
        _sum_if(per_order, "_late_days").alias("_late_days"), _sum_if(per_order, "_nlate_days").alias("_nlate_days"),
        F.min_by(F.col("_cat"), F.when(per_cat, F.struct((-F.col("_rev")).alias("r"), F.col("_cat").alias("c"))))
         .alias("top_category"))
    return per.select(
        "seller_id", "total_orders", "total_items_sold",
        F.round("_rev", 2).alias("total_revenue"),
        F.round(F.col("_rev") / F.nullif(F.col("_nprice"), F.lit(0)), 2).alias("avg_item_price"),
        ratio("_rev", "total_orders", 2).alias("avg_revenue_per_order"),
        F.round(F.col("_revw") / F.nullif(F.col("_nrevw"), F.lit(0)), 2).alias("avg_review_score"),
        "low_score_orders",
        ratio("low_score_orders", "total_orders", 1, factor=100).alias("low_score_rate_pct"),
        "late_delivery_count",
        ratio("late_delivery_count", "total_orders", 1, factor=100).alias("late_delivery_rate_pct"),
        F.round(F.col("_late_days") / F.nullif(F.col("_nlate_days"), F.lit(0)), 1).alias("avg_days_late"),
        "top_category")
