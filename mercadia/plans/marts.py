"""Mart models: monthly revenue, customer segments, product performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import avg_exact, interval_days, month_start, ratio
from ..operators.grouping import segment_by_recency
from ..session import cut_lineage
from ..operators.ranking import ntile_by_cuts, rank_by_bins
from ..operators.windows import Key, period_over_period, running_total
from .intermediate import _items_of_open_orders, _not_excluded


def mart_monthly_revenue(oe: DataFrame, excluded=("canceled", "unavailable")) -> DataFrame:
    """One row per calendar month present; MoM against the previous present
    month; YTD running sums restart each year. Month grain is bounded by the
    calendar, so its windows run in a single small task."""
    return monthly_windows(monthly_base(oe, excluded))


def monthly_base(oe: DataFrame, excluded=("canceled", "unavailable")) -> DataFrame:
    """The mart's measures of each month on its own."""
    base = (oe.where(_not_excluded("order_status", excluded) & F.col("purchased_at").isNotNull())
              .withColumn("month", month_start("purchased_at")))
    # One grouping-sets pass: (month, order) rows carry the order's partial sums,
    # (month, person) rows mark a distinct customer; per month, distinct counts
    # are row counts (no DISTINCT aggregate, one pass over the orders).
    keys = ["month", "order_id", "customer_unique_id"]
    g = base.groupingSets([["month", "order_id"], ["month", "customer_unique_id"]], *keys).agg(
        F.grouping_id().alias("_gid"),
        F.sum("total_payment").alias("_pay"), F.count("total_payment").alias("_npay"),
        F.sum("total_items_price").alias("_items"), F.sum("total_freight").alias("_freight"),
        F.count(F.when(F.col("is_late_delivery"), 1)).alias("_late"),
        F.sum(F.col("avg_review_score").cast("decimal(20,4)")).alias("_rev"), F.count("avg_review_score").alias("_nrev"))
    per_order, per_person = F.col("_gid") == 1, F.col("_gid") == 2

    def s_(c):
        return F.sum(F.when(per_order, F.col(c)))

    m = g.groupBy("month").agg(
        F.count(F.when(per_order, 1)).alias("total_orders"),
        F.count(F.when(per_person & F.col("customer_unique_id").isNotNull(), 1)).alias("unique_customers"),
        F.round(s_("_pay"), 2).alias("total_revenue"),
        F.round(s_("_pay") / F.nullif(s_("_npay"), F.lit(0)), 2).alias("avg_order_value"),
        F.round(s_("_items"), 2).alias("total_items_revenue"),
        F.round(s_("_freight"), 2).alias("total_freight_revenue"),
        s_("_late").alias("late_delivery_count"),
        F.round(s_("_rev") / F.nullif(s_("_nrev"), F.lit(0)), 2).alias("avg_review_score"))
    return m.withColumn("late_delivery_rate_pct", ratio("late_delivery_count", "total_orders", 1, factor=100))


def monthly_windows(m: DataFrame) -> DataFrame:
    """The mart from its base: the measures that look at other months."""
    m = period_over_period(m, ["month"], ["total_revenue", "total_orders"],
                           prev_names={"total_revenue": "prev_month_revenue", "total_orders": "prev_month_orders"},
                           pct_names={"total_revenue": "mom_revenue_growth_pct",
                                      "total_orders": "mom_orders_growth_pct"})
    m = running_total(m.withColumn("_year", F.year("month")), ["month"],
                      {"total_revenue": "ytd_revenue", "total_orders": "ytd_orders"}, partition=["_year"])
    return m.select("month", "total_orders", "unique_customers", "total_revenue", "avg_order_value",
                    "total_items_revenue", "total_freight_revenue", "late_delivery_count",
                    "late_delivery_rate_pct", "avg_review_score", "prev_month_revenue", "prev_month_orders",
                    "mom_revenue_growth_pct", "mom_orders_growth_pct", "ytd_revenue", "ytd_orders")


VALUE_TIERS = {1: "high_value", 2: "mid_value", 3: "low_value", 4: "at_risk_value"}  # fixed labels


def mart_customer_segments(customer_metrics: DataFrame, recent: int = 180, lapsed: int = 365,
                           tiles: int = 4) -> DataFrame:
    """Recency segment per person against the latest non-canceled purchase, and
    spend quartile (NTILE over the whole customer base; ties in spend → customer id).

    The metrics are written once. The quartiles come from exact cut points, found by
    histograms of the spend column; rows don't move for them. The reference instant is
    the latest non-canceled purchase; every such purchase is some person's
    ``last_order_at`` (same filter), so it is read from the written metrics too.
    """
    cm = ntile_by_cuts(cut_lineage(customer_metrics, "customer_metrics"), Key("total_spend", True, True),
                       "customer_unique_id", tiles, "spend_quartile")
    ref = cm.agg(F.max("last_order_at")).scalar()
    cm = (cm.withColumn("reference_date_used", ref)
          .withColumn("days_since_last_order", interval_days(F.col("reference_date_used"), F.col("last_order_at"))))
    cm = cm.withColumn("customer_segment",
                       segment_by_recency("total_orders", "days_since_last_order", recent, lapsed, "unknown"))
    tier = F.lit(None).cast("string")
    for q, label in VALUE_TIERS.items():
        tier = F.when(F.col("spend_quartile") == q, label).otherwise(tier)
    return cm.select("customer_unique_id", "customer_segment", "total_orders",
                     F.round("total_spend", 2).alias("total_spend"),
                     F.round("avg_order_value", 2).alias("avg_order_value"),
                     "first_order_at", "last_order_at", "days_since_last_order", "customer_lifetime_days",
                     "avg_days_between_orders", F.round("avg_review_score", 2).alias("avg_review_score"),
                     "preferred_state", "spend_quartile", tier.alias("value_tier"), "reference_date_used")


def mart_product_performance(stg_order_items: DataFrame, stg_products: DataFrame, oe: DataFrame,
                             excluded=("canceled",)) -> DataFrame:
    base = _items_of_open_orders(stg_order_items, stg_products, oe, excluded).where(F.col("_has_product"))
    ps = base.groupBy("product_id", F.col("category_name_en").alias("category")).agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count("item_sequence").alias("units_sold"),
        F.round(F.sum("item_price"), 2).alias("total_revenue"),
        avg_exact("item_price", 2).alias("avg_unit_price"),
        F.round(F.sum("freight_cost"), 2).alias("total_freight"),
        avg_exact("avg_review_score", 2).alias("avg_review_score"),
        F.count(F.when(F.col("has_low_score"), 1)).alias("low_score_order_count"),
        F.count(F.when(F.col("is_late_delivery"), 1)).alias("late_delivery_count"))
    ps = (ps.withColumn("low_score_rate_pct", ratio("low_score_order_count", "total_orders", 1, factor=100))
            .withColumn("late_delivery_rate_pct", ratio("late_delivery_count", "total_orders", 1, factor=100)))
    # Written once; histograms of the sort columns give the bins, so a rank costs one
    # exchange by bin, and the two by revenue share theirs.
    ps = cut_lineage(ps.withColumn("_quality", F.col("avg_review_score") * F.col("total_revenue")), "product_sales")
    totals = ps.groupBy(F.col("category").alias("_category")).agg(F.sum("total_revenue").alias("category_total_revenue"))
    ps = rank_by_bins(ps, Key("total_revenue", True, True), {"revenue_rank": [], "category_revenue_rank": ["category"]}, "product_id")
    ps = rank_by_bins(ps, Key("_quality", True, False), {"quality_adjusted_rank": []}, "product_id")
    ps = (ps.join(totals, F.col("category").eqNullSafe(F.col("_category")))
          .withColumn("category_revenue_share_pct", ratio("total_revenue", "category_total_revenue", 2, factor=100)))
    return ps.select("product_id", "category", "total_orders", "units_sold", "total_revenue", "avg_unit_price",
                     "total_freight", "avg_review_score", "low_score_order_count", "low_score_rate_pct",
                     "late_delivery_count", "late_delivery_rate_pct", "category_revenue_share_pct",
                     "revenue_rank", "category_revenue_rank", "quality_adjusted_rank")
