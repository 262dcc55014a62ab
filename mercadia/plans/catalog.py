"""Named queries over the bound test tables: one entry per report, model,
dataset, chart, check and reusable operator. Each returns a DataFrame with
canonical output types (decimal → double, integers → bigint) so results compare
across engines."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import grouping as gr
from ..operators import quality as dq
from ..operators.distinct import dense_numbers, distinct_bitmaps, distinct_counts, roll_up
from ..operators.gate import Gate, RuleBroken, in_range, not_null, publish_gated
from ..operators.ranking import ntile_by_cuts, rank_by_bins
from ..operators.skew import heavy_keys, skew_chain
from ..operators.windows import Key, global_window, pareto, period_over_period, running_total
from ..functions.exprs import pg_initcap, safe_pct
from ..session import configure, ensure_checkpoint_dir
from ..session import cut_lineage
from ..sources.binding import BINDINGS, load_bound_tables
from ..sources.readers import (footer_row_counts, publish, publish_bucketed, read_csv_quarantine, read_csv_table, read_parquet_table,
                               write_replace)
from ..sources.versions import read_current, replace_version
from . import dashboards as db
from . import intermediate as im
from . import refresh as rf
from . import reports as rp
from .cube import ChartCube
from .pipeline import MODEL_GATES, SEGMENTS, build_models, run_pipeline, table_row_counts


def canonical(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def bound_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Bound source DataFrames, built anew for each call: nothing outlives a query, so a
    rewritten file is seen by the next one, wherever it is stored."""
    return load_bound_tables(spark, sf_dir)


class Ctx:
    """Bound sources and lazily built models for one (session, sf_dir)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        configure(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self.src = bound_sources(spark, sf_dir)
        self._models = None

    @property
    def m(self) -> dict[str, DataFrame]:
        if self._models is None:
            self._models = build_models(self.src)
        return self._models

    def raw(self, *names):
        return [self.src[n] for n in names]


def _q(fn: Callable[[Ctx], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return canonical(fn(Ctx(spark, sf_dir)))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


T9 = "product_category_name_translation"


def _a1(c): return rp.a1_monthly_revenue(*c.raw("orders", "order_payments"))
def _a2(c): return rp.a2_top_categories(*c.raw("orders", "order_items", "order_payments", "products", T9))
def _a3(c): return rp.a3_cohort_retention(*c.raw("orders", "customers"))
def _b(c): return rp.b_category_analytics(*c.raw("orders", "order_items", "order_payments", "products", T9))
def _b_orig(c): return rp.b_category_analytics_original(*c.raw("orders", "order_items", "order_payments", "products", T9))
def _ds(c): return db.ds_order_enriched(*c.raw("orders", "customers", "order_items", "products", T9,
                                               "order_payments", "order_reviews"))
def _dcs(c): return db.ds_customer_segments(*c.raw("orders", "customers", "order_payments"))
def _kpi(c): return db.ds_kpi_metrics(*c.raw("orders", "order_payments"))


def _union(frames):
    return reduce(DataFrame.unionByName, frames)


def _key(*cols) -> F.Column:
    return F.concat_ws("|", *[F.col(x).cast("string") for x in cols])


def _dq_not_null(c):
    s = c.src
    rules = [("orders", ["order_id"]), ("order_items", ["order_id", "product_id", "price"]),
             ("order_payments", ["order_id", "payment_value"]), ("order_reviews", ["order_id", "review_score"]),
             ("customers", ["customer_id"]), ("products", ["product_id"])]
    return _union([dq.dq_not_null(s[t], cols, t) for t, cols in rules])


# fixed accepted values
ORDER_STATUSES = ["delivered", "shipped", "processing", "invoiced", "approved", "created", "unavailable", "canceled"]
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
# fixed grains of the models
GRAINS = {"int_orders_enriched": ["order_id"], "int_customer_metrics": ["customer_unique_id"], "int_seller_metrics": ["seller_id"],
          "mart_monthly_revenue": ["month"], "mart_customer_segments": ["customer_unique_id"], "mart_product_performance": ["product_id"],
          "stg_order_items": ["order_id", "item_sequence"]}


# Every stated rule on the models and sources, and each kind of rule once on an input
# derived from a source so that a known part of its rows breaks it.

def _dq_unique_grain(c):
    """Repeated keys → ``table, key, row_count``; payments do not have one row an order."""
    inputs = [(t, c.m[t], key) for t, key in GRAINS.items()] + [("stg_order_payments by order", c.m["stg_order_payments"], ["order_id"])]
    return _union([dq.dq_unique_grain(df, key).select(F.lit(t).alias("table"), _key(*key).alias("key"), "row_count") for t, df, key in inputs])


def _dq_accepted(c):
    """Values outside the documented code lists → ``table, key, column, value``."""
    orders = c.src["orders"]
    upper = orders.withColumn("order_status", F.when(F.col("order_id").endswith("77"), F.upper("order_status")).otherwise(F.col("order_status")))
    checks = [("order_payments", c.src["order_payments"], "order_id", "payment_type", PAYMENT_TYPES),
              ("orders", orders, "order_id", "order_status", ORDER_STATUSES),
              ("mart_customer_segments", c.m["mart_customer_segments"], "customer_unique_id", "customer_segment", SEGMENTS),
              ("orders with upper case", upper, "order_id", "order_status", ORDER_STATUSES)]
    return _union([dq.dq_accepted_values(df, col, values, [key]).select(
        F.lit(t).alias("table"), F.col(key).alias("key"), F.lit(col).alias("column"), F.col(col).alias("value"))
        for t, df, key, col, values in checks])


def _dq_range(c):
    """Values outside their range → ``table, key, column, value``."""
    payments = c.m["stg_order_payments"]
    checks = [("stg_order_reviews", c.m["stg_order_reviews"], ["review_id"], "score", 1, 5),
              ("stg_order_payments", payments, ["order_id", "payment_seq"], "payment_amount", 0, None),
              ("stg_order_payments less 1000", payments.withColumn("payment_amount", F.col("payment_amount") - 1000),
               ["order_id", "payment_seq"], "payment_amount", 0, None)]
    return _union([dq.dq_range(df, col, lo, hi, key).select(
        F.lit(t).alias("table"), _key(*key).alias("key"), F.lit(col).alias("column"), F.col(col).cast("double").alias("value"))
        for t, df, key, col, lo, hi in checks])


def _dq_relationship(c):
    """Child rows without a parent → ``relation, key, value``."""
    s, m = c.src, c.m
    checks = [("orders.customer_id", s["orders"], s["customers"], "customer_id", ["order_id"]),
              ("order_items.order_id", s["order_items"], s["orders"], "order_id", ["order_id", "order_item_id"]),
              ("order_payments.order_id", s["order_payments"], s["orders"], "order_id", ["order_id", "payment_sequential"]),
              ("stg_order_items.product_id", m["stg_order_items"], m["stg_products"], "product_id", ["order_id", "item_sequence"]),
              ("order_items.order_id without some orders", s["order_items"], s["orders"].where(~F.col("order_id").endswith("99")),
               "order_id", ["order_id", "order_item_id"])]
    return _union([dq.dq_relationship(child, parent, key, keep=[x for x in keep if x != key]).select(
        F.lit(name).alias("relation"), _key(*keep).alias("key"), F.col(key).alias("value")) for name, child, parent, key, keep in checks])


def _scratch(c, name: str) -> str:
    """A fresh folder for a round trip, inside the shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(c.spark).rstrip('/')}/mercadia-io/{uuid.uuid4().hex}/{name}"


def _csv_round_trip(c):
    """Bound orders written as CSV (header, one file per table as in the source
    export) and read back with the declared schema."""
    path = _scratch(c, "orders.csv")
    (c.src["orders"].write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
     .csv(path))
    return read_csv_table(c.spark, path, "orders")


def _write_replace_round_trip(c):
    path = _scratch(c, "order_payments")
    write_replace(c.src["order_items"], path)        # an older version of the target (another table) …
    write_replace(c.src["order_payments"], path)     # … is dropped and replaced, not appended to
    return c.spark.read.parquet(path)


def _pipeline_marts(c):
    """All three marts of one run of the whole graph, as ``mart, key, orders, revenue``."""
    built = run_pipeline(c.src, materialise_root=_scratch(c, "models"))
    return _union([built[mart].select(F.lit(mart).alias("mart"), F.col(key).cast("string").alias("key"), F.col("total_orders").alias("orders"),
                                      F.col(revenue).cast("double").alias("revenue"))
                   for mart, key, revenue in (("mart_monthly_revenue", "month", "total_revenue"),
                                              ("mart_customer_segments", "customer_unique_id", "total_spend"),
                                              ("mart_product_performance", "product_id", "total_revenue"))])


def _parquet_round_trip(c):
    path = _scratch(c, "source")
    write_replace(c.src["order_payments"], f"{path}/order_payments.parquet")
    return read_parquet_table(c.spark, f"{path}/order_payments.parquet")


def _csv_quarantine(c):
    """Orders as CSV in which a known part has no time where one should be → ``kind, order_id``."""
    path = _scratch(c, "orders_with_errors.csv")
    time = F.col("order_purchase_timestamp").cast("string")
    (c.src["orders"].withColumn("order_purchase_timestamp", F.when(F.col("order_id").endswith("77"), "not a time").otherwise(time))
     .write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    good, bad = read_csv_quarantine(c.spark, path, "orders", quarantine=_scratch(c, "quarantine"))
    return good.select(F.lit("good").alias("kind"), "order_id").unionByName(
        bad.select(F.lit("bad").alias("kind"), F.split("line", ",")[0].alias("order_id")))


def _version_round_trip(c):
    root = _scratch(c, "order_payments")
    replace_version(c.src["order_items"], root)
    replace_version(c.src["order_payments"], root)
    return read_current(c.spark, root)


def _footer_counts(c):
    names = sorted({t for _, tables in BINDINGS.values() for t in tables})
    return footer_row_counts(c.spark, {n: f"{c.sf_dir.rstrip('/')}/{n}.parquet" for n in names})


def _gated_marts(c):
    """Two marts of a run whose tables are published only if they keep their rules."""
    built = run_pipeline(c.src, _scratch(c, "gated"), select=["mart_monthly_revenue", "mart_customer_segments"], gates=MODEL_GATES)
    return _union([built[mart].select(F.lit(mart).alias("mart"), F.col(key).cast("string").alias("key"), F.col("total_orders").alias("orders"))
                   for mart, key in (("mart_monthly_revenue", "month"), ("mart_customer_segments", "customer_unique_id"))])


def _broken_gate(c):
    """What a gate counts in the pass that writes payments of which some break its rules → ``rule, rows``."""
    payments = c.m["stg_order_payments"].withColumn("payment_amount", F.col("payment_amount") - 1000)
    gate = Gate((not_null("order_id"), in_range("payment_amount", 0), in_range("installments", 1, 10)))
    try:
        _, counts = publish_gated(payments, _scratch(c, "broken"), gate)
        counts.pop("rows")
    except RuleBroken as e:
        counts = {r.name: 0 for r in gate.rules} | e.counts
    return c.spark.createDataFrame(sorted(counts.items()), "rule string, rows long")


def _refreshed(c, root: str) -> None:
    """A refresh over older sources (one month's payments are missing), then one over these."""
    old = dict(c.src)
    month = c.src["orders"].where(F.date_format("order_purchase_timestamp", "yyyy-MM") == "1996-03").select("order_id")
    old["order_payments"] = old["order_payments"].join(month, "order_id", "left_anti")
    rf.refresh_models(old, root)
    rf.refresh_models(c.src, root)


def _refresh_orders(c):
    root = _scratch(c, "refreshed")
    _refreshed(c, root)
    return rf.read_orders(c.spark, root)


def _refresh_monthly(c):
    root = _scratch(c, "refreshed")
    _refreshed(c, root)
    return rf.read_monthly_mart(c.spark, root)


def _bucketed_sellers(c):
    """Seller metrics from tables bucketed by order: the item-order join has no exchange."""
    run, buckets = uuid.uuid4().hex[:12], int(c.spark.conf.get("spark.sql.shuffle.partitions"))
    items, orders = (publish_bucketed(c.m[m], f"{m}_{run}", "order_id", buckets, _scratch(c, m)) for m in ("stg_order_items", "int_orders_enriched"))
    return im.int_seller_metrics(items, c.m["stg_products"], orders)


def _items_of_a_heavy_order(c):
    """Item rows of which a third is given to one order."""
    moved = F.when(F.col("order_id").cast("bigint") % 3 == 0, F.lit("7")).otherwise(F.col("order_id"))
    return c.src["order_items"].select(moved.alias("order_id"), F.col("order_id").alias("sold_in"), "order_item_id", "product_id", "price")


def _skew_chain(c):
    orders = c.src["orders"].select("order_id", "order_status")
    payments = c.src["order_payments"].select("order_id", "payment_sequential", "payment_value")
    return skew_chain(_items_of_a_heavy_order(c), [(orders, "inner"), (payments, "left")], "order_id")


def _heavy(c):
    """Orders and sellers with at least a hundredth of the item rows."""
    items = c.src["order_items"]
    return _union([heavy_keys(df, key, 0.01).select(F.lit(key).alias("key"), F.col(key).alias("value"), "rows")
                   for df, key in ((_items_of_a_heavy_order(c), "order_id"), (items, "seller_id"))])


def _product_items(c):
    items = c.m["stg_order_items"].groupBy("product_id").agg(F.count(F.lit(1)).alias("items"))
    return cut_lineage(items.join(c.m["stg_products"].select("product_id", F.col("category_name_en").alias("category")), "product_id"), "product_items")


def _distinct_rollup(c):
    """Distinct orders by month and category, and by year, category and in all from the same bitmaps."""
    orders = c.src["orders"].where("order_purchase_timestamp IS NOT NULL").select("order_id", F.date_format("order_purchase_timestamp", "yyyy-MM").alias("month"))
    items = c.src["order_items"].select("order_id", "product_id").join(
        c.m["stg_products"].select("product_id", F.col("category_name_en").alias("category")), "product_id")
    rows = items.join(orders, "order_id").join(dense_numbers(orders, "order_id"), "order_id")
    fine = cut_lineage(distinct_bitmaps(rows.select("month", "category", "_number"), ["month", "category"]), "distinct_bitmaps")
    levels = [(fine, ["month", "category"]), (roll_up(fine.withColumn("year", F.left("month", F.lit(4))), ["year", "category"]), ["year"]),
              (fine, ["category"]), (fine, [])]
    return _union([distinct_counts(b, dims, "orders").select(F.lit(" ".join(dims)).alias("level"), F.concat_ws("|", *dims).alias("key"), "orders")
                   for b, dims in levels])


# fixed filter bars, under which every chart of the dataset is asked for
FILTER_BARS = {
    "all": {},
    "two categories in 1995": {"category": ["Promo", "Small"], "date_range": ("1995-01-01", "1996-01-01")},
    "delivered, two states": {"status": ["delivered"], "state": ["nation_0", "nation_3"]},
    "categories, status and a quarter": {"category": ["uncategorized", "Economy"], "status": ["delivered", "shipped"], "date_range": ("1996-04-01", "1996-07-01")},
}
CUBE_CHARTS = {"revenue_trend": ("order_month", ["total_payment"]), "top_categories": ("category", ["total_payment"]),
               "payment_mix": ("order_month", ["credit_card_payment", "boleto_payment", "other_payment"]),
               "late_rate": ("category", ["late_rate_pct"]), "orders_by_state": ("customer_state", ["order_count"])}


def _chart_cube(c):
    """All charts of the dataset under several filter bars, from one summary → ``bar, chart, key, measure, value``."""
    cube = ChartCube.build(_ds(c))
    out = []
    for bar, filters in FILTER_BARS.items():
        for name, (key, measures) in CUBE_CHARTS.items():
            stacked = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])).alias("m")
            out.append(cube.chart(name, **filters).select(F.lit(bar).alias("bar"), F.lit(name).alias("chart"), F.col(key).cast("string").alias("key"), stacked)
                       .select("bar", "chart", "key", "m.measure", "m.value"))
    return _union(out)


def _sub_cent(c):
    """Payments per installments in thousandths of the amount: sub-cent measures."""
    return (c.m["stg_order_payments"].where("installments IS NOT NULL").groupBy("installments")
            .agg((F.sum("payment_amount").cast("decimal(18,2)") * F.lit(Decimal("0.00001"))).cast("decimal(28,8)").alias("amount")))


def _segments_by_recency(c):
    """Against the latest order of all people."""
    people = c.m["int_customer_metrics"]
    latest = people.agg(F.max("last_order_at").cast("date")).scalar()
    return people.select("customer_unique_id", gr.segment_by_recency(
        "total_orders", F.datediff(latest, F.col("last_order_at").cast("date"))).alias("segment"))


def _global_window_nulls(c):
    """Measures with NULLs: items' freight per product, NULL where it is below 500."""
    per = c.m["stg_order_items"].groupBy("product_id").agg(F.sum("freight_cost").alias("f"), F.count(F.lit(1)).alias("items"))
    per = per.select("product_id", "items", F.when(F.col("f") >= 500, F.col("f")).alias("freight"))
    return global_window(per, [Key("freight", True, False)], ["product_id"], partition_by=["items"], rank="rank", row_number="row_number",
                         running={"freight": "running_freight"}, group_sum={"freight": "items_freight"})


def _items_revenue_by_product(c):
    """Item revenue per product over the whole item table (operator input)."""
    return (c.m["stg_order_items"].groupBy("product_id")
            .agg(F.sum("item_price").alias("revenue"), F.count(F.lit(1)).alias("items")))


QUERIES: dict[str, Callable[[Ctx], DataFrame]] = {
    # sources
    "table_row_counts": lambda c: table_row_counts(c.src),
    "read_parquet_table": _parquet_round_trip,
    "read_csv_table": _csv_round_trip,
    "write_table_replace": _write_replace_round_trip,
    "materialise_view": lambda c: publish(c.m["stg_products"], "stg_products", "view"),
    "materialise_table": lambda c: publish(c.m["mart_monthly_revenue"], "mart_monthly_revenue", "table",
                                           path=_scratch(c, "mart_monthly_revenue")),
    "model_graph": _pipeline_marts,
    "replace_version": _version_round_trip,
    "read_csv_quarantine": _csv_quarantine,
    "footer_row_counts": _footer_counts,
    "model_graph_gated": _gated_marts,
    "dq_gate_counts": _broken_gate,
    "refresh_orders": _refresh_orders,
    "refresh_monthly_revenue": _refresh_monthly,
    "int_seller_metrics_bucketed": _bucketed_sellers,
    # reports
    "a1_monthly_revenue": _a1,
    "a1_peak_month": lambda c: rp.a1_peak_month(_a1(c)),
    "a1_period_label": lambda c: rp.a1_period_label(_a1(c)),
    "a2_top_categories": _a2,
    "a2_ranked": lambda c: rp.a2_ranked(_a2(c)),
    "a3_cohort_retention": _a3,
    "a3_retention_rates": lambda c: rp.a3_retention_rates(_a3(c)),
    "b_category_analytics": _b,
    "b_category_analytics_original": _b_orig,
    "b_top20_late": lambda c: rp.b_top20_late(_b(c)),
    "b_top20_revenue": lambda c: rp.b_top20_late(_b(c), by="revenue_rank"),
    # staging
    "stg_orders": lambda c: c.m["stg_orders"],
    "stg_customers": lambda c: c.m["stg_customers"],
    "stg_order_items": lambda c: c.m["stg_order_items"],
    "stg_order_payments": lambda c: c.m["stg_order_payments"],
    "stg_order_reviews": lambda c: c.m["stg_order_reviews"],
    "stg_products": lambda c: c.m["stg_products"],
    # intermediate
    "order_item_totals": lambda c: im.order_item_totals(c.m["stg_order_items"]),
    "order_payment_totals": lambda c: im.order_payment_totals(c.m["stg_order_payments"]),
    "order_review_totals": lambda c: im.order_review_totals(c.m["stg_order_reviews"]),
    "int_orders_enriched": lambda c: c.m["int_orders_enriched"],
    "customer_preferred_state": lambda c: im.customer_preferred_state(
        c.m["int_orders_enriched"].where((F.col("order_status") != "canceled") & F.col("purchased_at").isNotNull())),
    "int_customer_metrics": lambda c: c.m["int_customer_metrics"],
    "seller_top_category": lambda c: im.seller_top_category(im._items_of_open_orders(
        c.m["stg_order_items"], c.m["stg_products"], c.m["int_orders_enriched"], ("canceled",))
        .where(F.col("_has_product"))),
    "int_seller_metrics": lambda c: c.m["int_seller_metrics"],
    # marts
    "mart_monthly_revenue": lambda c: c.m["mart_monthly_revenue"],
    "mart_customer_segments": lambda c: c.m["mart_customer_segments"],
    "mart_product_performance": lambda c: c.m["mart_product_performance"],
    # dashboards
    "ds_order_enriched": _ds,
    "ds_customer_segments": _dcs,
    "ds_kpi_metrics": _kpi,
    "chart_kpi_revenue": lambda c: db.chart_kpi_revenue(_kpi(c)),
    "chart_kpi_orders": lambda c: db.chart_kpi_orders(_kpi(c)),
    "chart_kpi_aov": lambda c: db.chart_kpi_aov(_kpi(c)),
    "chart_revenue_trend": lambda c: db.chart_revenue_trend(_ds(c)),
    "chart_top_categories": lambda c: db.chart_top_categories(_ds(c)),
    "chart_order_status": lambda c: db.chart_order_status(c.src["orders"]),
    "chart_payment_mix": lambda c: db.chart_payment_mix(_ds(c)),
    "chart_late_rate": lambda c: db.chart_late_rate(_ds(c)),
    "chart_orders_by_state": lambda c: db.chart_orders_by_state(_ds(c)),
    "chart_segment_mix": lambda c: db.chart_segment_mix(_dcs(c)),
    "dashboard_filters": lambda c: db.dashboard_filters(_ds(c), date_range=("1996-01-01", "2000-01-01"),
                                                        status=["delivered", "shipped"]),
    "chart_revenue_trend_category": lambda c: db.chart("revenue_trend", _ds(c), category=["Promo", "Economy"]),
    "chart_orders_by_state_state": lambda c: db.chart("orders_by_state", _ds(c), state=["nation_0", "nation_3"]),
    "chart_late_rate_two_filters": lambda c: db.chart("late_rate", _ds(c), category=["Promo", "Small", "uncategorized"],
                                                      date_range=("1995-01-01", "1997-01-01")),
    "chart_top_categories_category": lambda c: db.chart("top_categories", _ds(c), category=["Promo", "Economy"]),
    "chart_payment_mix_status": lambda c: db.chart("payment_mix", _ds(c), status=["delivered"]),
    "chart_kpi_orders_time": lambda c: db.chart("kpi_orders", _kpi(c), date_range=("1996-01-01", "1997-01-01")),
    "chart_order_status_time": lambda c: db.chart("order_status", c.src["orders"], date_range=("1996-01-01", "1997-01-01"), state=["x"]),
    "chart_payment_mix_state": lambda c: db.chart("payment_mix", _ds(c), state=["x"]),
    "chart_cube": _chart_cube,
    # data quality
    "dq_unique_grain": _dq_unique_grain,
    "dq_not_null": _dq_not_null,
    "dq_accepted_values": _dq_accepted,
    "dq_range": _dq_range,
    "dq_relationship": _dq_relationship,
    # reusable operators on bound tables
    "top_row_per_key": lambda c: gr.top_row_per_key(
        c.m["stg_order_payments"].select("order_id", "payment_seq", "payment_type", "payment_amount"),
        ["order_id"], [Key("payment_amount", True), Key("payment_seq")]),
    "period_over_period": lambda c: period_over_period(
        c.m["stg_orders"].where(F.col("purchased_at").isNotNull())
        .groupBy(F.year("purchased_at").alias("year")).agg(F.count(F.lit(1)).alias("orders")),
        ["year"], ["orders"]),
    "running_total": lambda c: running_total(
        c.m["stg_order_payments"].groupBy("payment_type").agg(F.sum("payment_amount").alias("amount")),
        [Key("amount", True), "payment_type"], {"amount": "running_amount"}),
    "pareto": lambda c: pareto(
        c.m["stg_order_payments"].groupBy("payment_type").agg(F.sum("payment_amount").alias("amount")),
        "payment_type", "amount"),
    "cohort_retention": lambda c: gr.cohort_retention(
        c.m["int_orders_enriched"].where(F.col("purchased_at").isNotNull()), "customer_unique_id", "purchased_at",
        (1, 2, 3, 6, 12)),
    "segment_by_recency": _segments_by_recency,
    "filter_sum": lambda c: c.m["stg_order_payments"].groupBy("installments").agg(*gr.filter_sum(
        "payment_amount", "payment_type",
        {"credit_card": "credit_card", "boleto": "boleto", "other": ["credit_card", "boleto"]})),
    "safe_pct": lambda c: c.m["int_orders_enriched"].select(
        "order_id", safe_pct("total_freight", "total_items_price", 2).alias("freight_pct")),
    "top_k": lambda c: gr.top_k(_items_revenue_by_product(c), [Key("revenue", True)], 25, ["product_id"]),
    "global_window": lambda c: global_window(
        _items_revenue_by_product(c), [Key("items", True)], ["product_id"], rank="rank", row_number="row_number",
        ntile=("quartile", 4), running={"revenue": "running_revenue"}),
    "global_window_nulls": _global_window_nulls,
    "heavy_keys": _heavy,
    "skew_chain": _skew_chain,
    "ntile_by_cuts": lambda c: ntile_by_cuts(_product_items(c), Key("items", True), "product_id", 10, "decile"),
    "rank_by_bins": lambda c: rank_by_bins(_product_items(c), Key("items", True), {"rank": [], "category_rank": ["category"]}, "product_id"),
    "distinct_rollup": _distinct_rollup,
    "sub_cent_shares": lambda c: pareto(_sub_cent(c), "installments", "amount"),
    "sub_cent_changes": lambda c: period_over_period(_sub_cent(c), ["installments"], ["amount"]),
    "sub_cent_safe_pct": lambda c: c.m["stg_order_payments"].select(
        "order_id", "payment_seq", safe_pct(F.col("payment_amount") * F.lit(Decimal("0.00001")), F.lit(Decimal("0.004")), 2).alias("pct")),
    "pg_initcap": lambda c: c.src["customers"].select(
        "customer_id", pg_initcap(F.concat_ws(" ", "customer_city", "customer_state")).alias("city_state")),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _q(v) for k, v in QUERIES.items()}
