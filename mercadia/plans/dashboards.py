"""Dashboard datasets, the chart queries over them, and dashboard filters.

``ds_order_enriched`` groups the seven-table join (items × payments × reviews
per order) to order × category. As in the reports, payments and reviews are
reduced to one row per order and items to one row per (order, category) first;
each row carries the multiplicities of the other sides, which reproduces the
sums of the full join without building it.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import elapsed_days, exact, interval_days, ratio, times
from ..operators.grouping import segment_by_recency, top_k
from ..operators.windows import Key, period_over_period
from ..session import cut_lineage
from .reports import _items_with_category, _open, _payments_per_order, _per_order_category


def _month(ts) -> F.Column:
    """DATE_TRUNC('month', ts) kept as a zone-less timestamp."""
    return F.trunc(F.col(ts).cast("date"), "month").cast("timestamp_ntz")


def ds_order_enriched(o: DataFrame, c: DataFrame, i: DataFrame, pr: DataFrame, t: DataFrame, p: DataFrame,
                      r: DataFrame, excluded=("canceled",)) -> DataFrame:
    per_oc = _per_order_category(_items_with_category(i, pr, t, translated_only=False))
    pay = _payments_per_order(p)
    rev = r.groupBy("order_id").agg(F.count(F.lit(1)).alias("_n_rev"),
                                    F.sum(F.col("review_score").cast("decimal(20,0)")).alias("_score_sum"),
                                    F.count("review_score").alias("_score_n"))
    d, e, ts = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"), "order_purchase_timestamp"
    orders = _open(o, excluded).select(
        "order_id", "customer_id", "order_status",
        _month(ts).alias("order_month"), F.col(ts).alias("ordered_at"),
        d.alias("delivered_at"), e.alias("estimated_at"),
        F.coalesce(d > e, F.lit(False)).alias("is_late"),
        elapsed_days(d, e, 1).alias("delay_days"))
    cust = c.select("customer_id", "customer_unique_id", "customer_state", "customer_city")
    order_level = (orders.join(cust, "customer_id")
                         .join(pay, "order_id", "left").join(rev, "order_id", "left"))
    keys = ["order_id", "order_status", "order_month", "ordered_at", "delivered_at", "estimated_at",
            "customer_unique_id", "customer_state", "customer_city", "is_late", "delay_days"]
    # Equal order rows become one, with their number and sums, before they meet the categories:
    # rows of (order, category) are unique, so nothing as large as they are is grouped after the join.
    order_level = order_level.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_same"), F.max("_n_pay").alias("_n_pay"), F.max("_n_rev").alias("_n_rev"),
        *[F.sum(x).alias(x) for x in ("_paid", "_cc", "_boleto", "_other", "_score_n")],
        F.sum("_score_sum").cast("decimal(30,0)").alias("_score_sum"))
    j = per_oc.join(order_level, "order_id")
    n = F.col("_n_items")                                       # item rows of this order in this category
    wp = F.greatest(F.coalesce("_n_pay", F.lit(0)), F.lit(1))   # rows each item meets on the payment side
    wr = F.greatest(F.coalesce("_n_rev", F.lit(0)), F.lit(1))   # … and on the review side

    def total(c: str, times_each) -> F.Column:
        return F.round(times(c, times_each).cast("decimal(38,8)"), 2)

    return j.select(
        *keys[:9], "category",
        total("_price", wp * wr * F.col("_same")).alias("items_revenue"),
        total("_freight", wp * wr * F.col("_same")).alias("freight_revenue"),
        total("_paid", n * wr).alias("total_payment"),
        total("_cc", n * wr).alias("credit_card_payment"),
        total("_boleto", n * wr).alias("boleto_payment"),
        total("_other", n * wr).alias("other_payment"),
        "is_late", "delay_days",
        F.round(F.col("_score_sum") * (n * wp) / F.nullif(F.col("_score_n") * (n * wp), F.lit(0)), 1)
         .alias("avg_review_score"))


def ds_customer_segments(o: DataFrame, c: DataFrame, p: DataFrame, recent: int = 180, lapsed: int = 365,
                         excluded=("canceled",)) -> DataFrame:
    """Per (person, state): orders, spend, last order, recency segment with
    'churned' as the catch-all. Only orders with at least one payment row count."""
    pay = p.groupBy("order_id").agg(F.sum(exact("payment_value")).alias("_paid"))
    base = (_open(o, excluded).select("order_id", "customer_id", "order_purchase_timestamp")
            .join(pay, "order_id").join(c.select("customer_id", "customer_unique_id", "customer_state"),
                                        "customer_id"))
    cs = base.groupBy("customer_unique_id", "customer_state").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.round(F.sum("_paid"), 2).alias("total_spend"),
        F.max("order_purchase_timestamp").alias("last_order_at"))
    # Two passes over the summary (its max, then each row): write it once to the
    # shared checkpoint folder so the joins beneath are not evaluated twice.
    cs = cut_lineage(cs, "ds_customer_summary")
    max_date = cs.agg(F.max("last_order_at")).scalar()
    days = interval_days(max_date, F.col("last_order_at"))
    return cs.select("customer_unique_id", "customer_state", "total_orders", "total_spend", "last_order_at",
                     days.alias("days_since_last_order"),
                     segment_by_recency("total_orders", days, recent, lapsed, "churned").alias("segment"))


def ds_kpi_metrics(o: DataFrame, p: DataFrame, excluded=("canceled", "unavailable")) -> DataFrame:
    """Per purchase month: revenue, distinct orders and the mean *payment row*."""
    pay = _payments_per_order(p)
    j = _open(o, excluded).select("order_id", _month("order_purchase_timestamp").alias("month")).join(pay, "order_id")
    g = j.groupBy("month").agg(F.sum("_paid").alias("_paid"), F.sum("_n_val").alias("_n"),
                               F.count_distinct("order_id").alias("total_orders"))
    return g.select("month", F.round("_paid", 2).alias("total_revenue"), "total_orders",
                    F.round(F.col("_paid") / F.nullif(F.col("_n"), F.lit(0)), 2).alias("avg_order_value"))


# ---------------------------------------------------------------- charts


def _kpi(kpi: DataFrame, metric: F.Column, name: str, lag: int = 1) -> DataFrame:
    """Big-number card: the metric per month, its value ``lag`` months earlier
    in the series and the % change (time series skips months without data)."""
    s = kpi.where(F.col("month").isNotNull()).groupBy("month").agg(metric.alias(name))
    return period_over_period(s, ["month"], [name], lag=lag, scale=2,
                              prev_names={name: f"prev_{name}"}, pct_names={name: f"{name}_change_pct"})


def chart_kpi_revenue(kpi: DataFrame) -> DataFrame:
    return _kpi(kpi, F.sum("total_revenue"), "total_revenue")


def chart_kpi_orders(kpi: DataFrame) -> DataFrame:
    return _kpi(kpi, F.sum("total_orders"), "total_orders")


def chart_kpi_aov(kpi: DataFrame) -> DataFrame:
    return _kpi(kpi, F.round(F.sum("avg_order_value") / F.count("avg_order_value"), 2), "avg_order_value")


def chart_revenue_trend(ds: DataFrame) -> DataFrame:
    return (ds.where(F.col("order_month").isNotNull()).groupBy("order_month")
              .agg(F.sum("total_payment").alias("total_payment")))


def chart_top_categories(ds: DataFrame, k: int = 10) -> DataFrame:
    s = ds.groupBy("category").agg(F.sum("total_payment").alias("total_payment"))
    return top_k(s, [Key("total_payment", True, False)], k, ["category"])


def chart_order_status(o: DataFrame) -> DataFrame:
    """Orders per status and share of all orders. One row per status (a handful),
    so the total is a window over the grouped rows, not a second scan."""
    s = o.groupBy("order_status").agg(F.count(F.lit(1)).alias("order_count"))
    total = F.sum("order_count").over(Window.partitionBy())
    return s.withColumn("share_pct", ratio(F.col("order_count"), total, 2, factor=100))


def chart_payment_mix(ds: DataFrame) -> DataFrame:
    return (ds.where(F.col("order_month").isNotNull()).groupBy("order_month").agg(
        F.sum("credit_card_payment").alias("credit_card_payment"),
        F.sum("boleto_payment").alias("boleto_payment"),
        F.sum("other_payment").alias("other_payment")))


def chart_late_rate(ds: DataFrame, k: int = 15) -> DataFrame:
    s = ds.where(F.col("delivered_at").isNotNull()).groupBy("category").agg(
        F.sum(F.when(F.col("is_late"), 1).otherwise(0)).alias("_late"),
        F.count_distinct("order_id").alias("_orders"))
    s = s.select("category", ratio("_late", "_orders", 1, factor=100).alias("late_rate_pct"))
    return top_k(s, [Key("late_rate_pct", True, False)], k, ["category"])


def chart_orders_by_state(ds: DataFrame, k: int = 10) -> DataFrame:
    s = ds.groupBy("customer_state").agg(F.count_distinct("order_id").alias("order_count"))
    return top_k(s, [Key("order_count", True, False)], k, ["customer_state"])


def chart_segment_mix(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(F.count(F.lit(1)).alias("customer_count"))


# ---------------------------------------------------------------- filters

DEFAULT_DATE_RANGE = ("2016-01-01", "2018-09-01")  # fixed default of the time filter


def dashboard_filters(df: DataFrame, date_range=DEFAULT_DATE_RANGE, category=None, status=None, state=None,
                      time_column: str = "ordered_at") -> DataFrame:
    """Dashboard filter bar as predicates: half-open time range, multi-select
    value lists. A filter whose column the dataset lacks is out of its scope
    and skipped; ``None`` means "all". A cross-filter click is the same
    equality predicate."""
    cols = set(df.columns)
    out = df
    if date_range is not None and time_column in cols:
        lo, hi = (datetime.fromisoformat(str(x)) if not isinstance(x, (date, datetime)) else x for x in date_range)
        out = out.where((F.col(time_column) >= F.lit(lo).cast("timestamp_ntz"))
                        & (F.col(time_column) < F.lit(hi).cast("timestamp_ntz")))
    for col, values in (("category", category), ("order_status", status), ("customer_state", state)):
        if values is not None and col in cols:
            out = out.where(F.col(col).isin(list(values)))
    return out


# Each chart's number, time column and function; the charts that a filter affects (time: all).
CHARTS = {
    "kpi_revenue": (1, "month", chart_kpi_revenue), "kpi_orders": (1, "month", chart_kpi_orders), "kpi_aov": (1, "month", chart_kpi_aov),
    "revenue_trend": (2, "ordered_at", chart_revenue_trend), "top_categories": (3, "ordered_at", chart_top_categories),
    "order_status": (4, "order_purchase_timestamp", chart_order_status), "payment_mix": (5, "ordered_at", chart_payment_mix),
    "late_rate": (6, "ordered_at", chart_late_rate), "orders_by_state": (7, "ordered_at", chart_orders_by_state),
    "segment_mix": (8, "last_order_at", chart_segment_mix),
}
FILTER_SCOPES = {"category": {3, 5, 6, 8}, "status": {1, 2, 3, 4, 5}, "state": {1, 7, 8}}


def chart(name: str, dataset: DataFrame, date_range=None, **filters) -> DataFrame:
    """A chart over its dataset under the filter bar: ``category``, ``status`` and ``state``
    are lists of values or None, and reach the charts of their scope only; the time
    range reaches all, by the time column of the chart's dataset. A filter in scope
    whose column the dataset lacks does nothing."""
    if unknown := filters.keys() - FILTER_SCOPES.keys():
        raise ValueError(f"no such filter: {sorted(unknown)}")
    number, time_column, function = CHARTS[name]
    own = {f: v if number in FILTER_SCOPES[f] else None for f, v in filters.items()}
    return function(dashboard_filters(dataset, date_range, time_column=time_column, **own))
