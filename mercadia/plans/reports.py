"""Analytical reports over the raw source tables.

The reports join items with payments per order, and the fan-out of that join
is part of their answer (a category's payment sum counts each payment once per
item of the order). Rather than materialising items × payments, payments are
reduced to one row per order (count and sums) and items to one row per (order,
category); each row then carries the other side's multiplicity. Same numbers,
join inputs no larger than the item table, and a hot order reaches the order
joins as at most one row per category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import elapsed_days, exact, ratio, times
from ..operators.grouping import cohort_retention, top_k
from ..operators.windows import Key, pareto, period_over_period


def _open(o: DataFrame, excluded) -> DataFrame:
    return o.where(~F.col("order_status").isin(list(excluded)))


def _payments_per_order(p: DataFrame) -> DataFrame:
    v = exact("payment_value")
    t = F.col("payment_type")
    return p.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_n_pay"),
        F.count(v).alias("_n_val"),
        F.sum(v).alias("_paid"),
        F.sum(F.when(t == "credit_card", v)).alias("_cc"),
        F.sum(F.when(t == "boleto", v)).alias("_boleto"),
        F.sum(F.when(~t.isin("credit_card", "boleto"), v)).alias("_other"))


def _items_with_category(i: DataFrame, pr: DataFrame, t: DataFrame, translated_only: bool,
                         fallback: str = "uncategorized") -> DataFrame:
    """Item rows with their product's English category. ``translated_only``
    keeps products whose category has a translation (inner join)."""
    tr = t.select("product_category_name", F.col("product_category_name_english").alias("_en"))
    prod = pr.select("product_id", "product_category_name").join(
        tr, "product_category_name", "inner" if translated_only else "left")
    cat = F.col("_en") if translated_only else F.coalesce(F.col("_en"), F.lit(fallback))
    return (i.select("order_id", "order_item_id", "product_id", "price", "freight_value")
             .join(prod.select("product_id", cat.alias("category")), "product_id"))


def _per_order_category(items: DataFrame) -> DataFrame:
    """Item rows reduced to one row per (order, category) before they meet any
    order-level table: item count, non-null item ids and money sums.

    Combined map-side, so an order holding a third of all items reaches the
    order joins as at most one row per category — no task receives it whole.
    """
    return items.groupBy("order_id", "category").agg(
        F.count(F.lit(1)).alias("_n_items"), F.count("order_item_id").alias("_n_ids"),
        F.sum(exact("price")).alias("_price"), F.sum(exact("freight_value")).alias("_freight"))


# ---------------------------------------------------------------- A1


def a1_monthly_revenue(o: DataFrame, p: DataFrame, excluded=("canceled",)) -> DataFrame:
    """Payments by purchase (year, month) with change against the previous
    present month. Payments are summed per order before the join."""
    ts = F.col("order_purchase_timestamp")
    orders = _open(o, excluded).where(ts.isNotNull()).select(
        "order_id", F.year(ts).alias("year"), F.month(ts).alias("month"))
    pay = p.groupBy("order_id").agg(F.sum(exact("payment_value")).alias("_paid"))
    m = orders.join(pay, "order_id").groupBy("year", "month").agg(F.round(F.sum("_paid"), 2).alias("total_revenue"))
    m = period_over_period(m, ["year", "month"], ["total_revenue"],
                           prev_names={"total_revenue": "prev_month_revenue"},
                           pct_names={"total_revenue": "mom_change_pct"})
    return m.select("year", "month", "total_revenue", "prev_month_revenue", "mom_change_pct")


def a1_peak_month(monthly: DataFrame) -> DataFrame:
    """Month with the greatest revenue (first in calendar order on ties)."""
    return top_k(monthly, [Key("total_revenue", True, False)], 1, ["year", "month"])


def a1_period_label(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn("period", F.concat_ws("-", F.col("year").cast("string"),
                                                    F.lpad(F.col("month").cast("string"), 2, "0")))


# ---------------------------------------------------------------- A2


def a2_top_categories(o: DataFrame, i: DataFrame, p: DataFrame, pr: DataFrame, t: DataFrame, k: int = 10,
                      excluded=("canceled",)) -> DataFrame:
    """Translated categories by payment revenue (payments counted once per
    item of their order, as the five-way join does); top k."""
    per_oc = _per_order_category(_items_with_category(i, pr, t, translated_only=True))
    orders = _open(o, excluded).select("order_id").join(_payments_per_order(p), "order_id")
    j = per_oc.join(orders, "order_id")
    # per (category, order) again — on the join's own order_id partitioning, so
    # no exchange — which keeps the counts exact even if an order row repeats
    per_order = j.groupBy("category", "order_id").agg(
        F.sum(F.col("_n_ids") * F.col("_n_pay")).alias("_items_sold"),
        F.sum(times("_paid", "_n_items")).alias("_rev"))
    agg = per_order.groupBy("category").agg(
        F.count(F.lit(1)).alias("distinct_orders"),
        F.sum("_items_sold").alias("total_items_sold"),
        F.sum("_rev").alias("_rev"))
    out = agg.select("category", "distinct_orders", F.coalesce("total_items_sold", F.lit(0)).alias("total_items_sold"),
                     F.round("_rev", 2).alias("total_revenue"),
                     ratio("_rev", "distinct_orders", 2).alias("avg_order_value"))
    return top_k(out, [Key("total_revenue", True, True)], k, ["category"])


def a2_ranked(top: DataFrame) -> DataFrame:
    """1..k display rank on the (already limited, k-row) top list."""
    w = Window.orderBy(F.col("total_revenue").desc_nulls_first(), F.col("category"))
    return top.withColumn("rank", F.row_number().over(w))


# ---------------------------------------------------------------- A3


def a3_cohort_retention(o: DataFrame, c: DataFrame, offsets=(1, 2, 3), excluded=("canceled",)) -> DataFrame:
    ts = F.col("order_purchase_timestamp")
    act = (_open(o, excluded).where(ts.isNotNull()).select("customer_id", ts.alias("ts"))
           .join(c.select("customer_id", "customer_unique_id"), "customer_id"))
    out = cohort_retention(act, "customer_unique_id", "ts", offsets)
    return out.withColumn("cohort_month", F.col("cohort_month").cast("timestamp_ntz"))


def a3_retention_rates(cohorts: DataFrame, offsets=(1, 2, 3)) -> DataFrame:
    cols = [ratio(f"retained_m{k}", "cohort_size", 2, factor=100).alias(f"retention_m{k}_pct") for k in offsets]
    return cohorts.select(F.date_format("cohort_month", "yyyy-MM").alias("cohort_label"), "cohort_size",
                          *[f"retained_m{k}" for k in offsets], *cols)


# ---------------------------------------------------------------- B


def _delivered_orders(o: DataFrame) -> DataFrame:
    d, e = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    late = d > e
    return o.where(d.isNotNull()).select(
        "order_id", F.coalesce(late, F.lit(False)).alias("_late"),
        F.when(late, elapsed_days(d, e, 12)).alias("_late_days"))


def _b_finish(cs: DataFrame) -> DataFrame:
    """Shares, ranks and rates from per-category sums (category grain: the
    windows here see one row per category)."""
    cs = pareto(cs, "category", "_rev", scale=2, share="revenue_share_pct", cumulative="cumulative_revenue_pct")
    late_rate = ratio("late_count", "total_orders", 1, factor=100)
    cs = cs.withColumn("late_rate_pct", late_rate)
    cs = (cs.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.col("_rev").desc_nulls_first())))
            .withColumn("late_rank", F.rank().over(Window.orderBy(F.col("late_rate_pct").desc_nulls_first()))))
    return cs.select(
        "revenue_rank", "category", "total_orders", F.round("_rev", 2).alias("total_revenue"),
        "revenue_share_pct", "cumulative_revenue_pct",
        ratio("_rev", "total_orders", 2).alias("avg_order_value"),
        F.round("_cc", 2).alias("credit_card_revenue"), F.round("_boleto", 2).alias("boleto_revenue"),
        ratio("_cc", F.col("_cc") + F.col("_boleto"), 1, factor=100).alias("credit_card_share_pct"),
        "late_count", "late_rate_pct", "avg_days_late", "late_rank")


def b_category_analytics(o: DataFrame, i: DataFrame, p: DataFrame, pr: DataFrame, t: DataFrame) -> DataFrame:
    """Category analytics over delivered orders in one join pass (the optimised
    form). Item price sums count once per payment row, payment sums once per
    item row, and the late-days average is weighted the same way.

    Items are reduced per (order, category) before the order join, so per
    category the distinct orders are just rows (no DISTINCT aggregate) and a
    hot order never reaches one task whole.
    """
    per_oc = _per_order_category(_items_with_category(i, pr, t, translated_only=False))
    orders = _delivered_orders(o).join(_payments_per_order(p), "order_id")
    j = per_oc.join(orders, "order_id")
    rows = F.col("_n_items") * F.col("_n_pay")           # joined rows of this order in this category
    late_rows = F.when(F.col("_late"), rows)
    # per (category, order) on the join's own order_id partitioning (no exchange);
    # exact even if an order row repeats
    per_order = j.groupBy("category", "order_id").agg(
        F.sum(times("_price", "_n_pay")).alias("_rev"),
        F.sum(times("_cc", "_n_items")).alias("_cc"),
        F.sum(times("_boleto", "_n_items")).alias("_boleto"),
        F.max("_late").alias("_late"),
        F.sum(F.col("_late_days") * late_rows).alias("_late_day_rows"),
        F.sum(late_rows).alias("_late_rows"))
    cs = per_order.groupBy("category").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("_rev").alias("_rev"), F.sum("_cc").alias("_cc"), F.sum("_boleto").alias("_boleto"),
        F.count(F.when(F.col("_late"), 1)).alias("late_count"),
        F.round(F.sum("_late_day_rows") / F.nullif(F.sum("_late_rows"), F.lit(0)), 1).alias("avg_days_late"))
    return _b_finish(cs)


def b_category_analytics_original(o: DataFrame, i: DataFrame, p: DataFrame, pr: DataFrame,
                                  t: DataFrame) -> DataFrame:
    """The unoptimised form: three separate per-category aggregates joined on
    category. Revenue and the late metrics come from items × orders without
    payments, so on orders with several payments it differs from the optimised
    form (which multiplies prices by payments)."""
    per_oc = _per_order_category(_items_with_category(i, pr, t, translated_only=False))
    # two two-way joins on order_id, each of which splits where an order is hot
    delivered = per_oc.join(_delivered_orders(o), "order_id")
    per_order = delivered.groupBy("category", "order_id").agg(
        F.sum("_price").alias("_rev"), F.max("_late").alias("_late"),
        F.sum(F.col("_late_days") * F.col("_n_items")).alias("_late_day_rows"),
        F.sum(F.when(F.col("_late"), F.col("_n_items"))).alias("_late_rows"),
        F.sum("_n_items").alias("_n_items"))
    b = per_order.groupBy("category").agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("_rev").alias("_rev"),
        F.count(F.when(F.col("_late"), 1)).alias("late_count"),
        F.round(F.sum("_late_day_rows") / F.nullif(F.sum("_late_rows"), F.lit(0)), 1).alias("avg_days_late"))
    ps = (per_order.select("category", "order_id", "_n_items").join(_payments_per_order(p), "order_id").groupBy("category")
          .agg(F.sum(times("_cc", "_n_items")).alias("_cc"), F.sum(times("_boleto", "_n_items")).alias("_boleto")))
    return _b_finish(b.join(ps, "category"))


def b_top20_late(analytics: DataFrame, k: int = 20, by: str = "late_rate_pct") -> DataFrame:
    """Top k categories by late-delivery rate (``by='revenue_rank'``: the first
    k by revenue rank)."""
    if by == "revenue_rank":
        return top_k(analytics, [Key("revenue_rank")], k, ["category"])
    return top_k(analytics, [Key(by, True, False)], k, ["revenue_rank", "category"])
