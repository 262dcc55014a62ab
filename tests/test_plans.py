"""Plan shape and exact-arithmetic checks."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

import __spark_entry__ as E
from mercadia.functions.exprs import ratio, safe_pct

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    df.count()
    return df._jdf.queryExecution().executedPlan().toString()


def test_ratio_rounds_half_away_from_zero_exactly(spark):
    rnd = random.Random(11)
    pairs = [(rnd.randint(-10**9, 10**9), rnd.randint(1, 10**6)) for _ in range(3000)]
    pairs += [(1005, 1000), (-1005, 1000), (1, 8), (-1, 8), (201, 20000), (5, 0)]
    df = spark.createDataFrame([(Decimal(n) / 100, Decimal(d) / 100) for n, d in pairs],
                               "n decimal(18,2), d decimal(18,2)")
    got = df.select("n", "d", ratio("n", "d", 2).alias("r"), safe_pct("n", "d", 1).alias("p")).collect()

    def ref(n, d, k, f=1):
        if d == 0:
            return None
        q = (n * f / d).quantize(Decimal(1).scaleb(-k), rounding=ROUND_HALF_UP)  # half away from zero
        return q

    from decimal import getcontext
    getcontext().prec = 60
    bad = [(r.n, r.d) for r in got if r.r != ref(r.n, r.d, 2) or r.p != ref(r.n, r.d, 1, 100)]
    assert not bad, bad[:5]


def test_scans_read_only_needed_columns(spark):
    plan = _plan(E.queries()["b_category_analytics"](spark, SF))
    # lineitem has 11 columns; report B needs three of them
    scans = [ln for ln in plan.splitlines() if "lineitem.parquet" in ln]
    assert scans and all("ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>" in ln
                         for ln in scans)


def test_filters_reach_physical_source_scans(spark, tmp_dir):
    """With the sources stored as tables (as in a deployment, not derived on
    the fly), report B's predicates are pushed into the Parquet scans."""
    from mercadia.plans import reports as rp
    from mercadia.plans.catalog import bound_sources
    src = bound_sources(spark, SF)
    names = ["orders", "order_items", "order_payments", "products", "product_category_name_translation"]
    for n in names:
        src[n].write.parquet(f"{tmp_dir}/{n}")
    t = {n: spark.read.parquet(f"{tmp_dir}/{n}") for n in names}
    plan = _plan(rp.b_category_analytics(t["orders"], t["order_items"], t["order_payments"], t["products"],
                                         t["product_category_name_translation"]))
    orders_scan = [ln for ln in plan.splitlines() if "/orders]" in ln or "/orders," in ln]
    assert orders_scan and "IsNotNull(order_delivered_customer_date)" in orders_scan[0]
    assert "ReadSchema: struct<order_id:string,order_delivered_customer_date:timestamp_ntz," in orders_scan[0]


def test_single_task_exchanges_stand_above_a_bounded_grain_only(spark):
    """A stage of one task may follow an aggregate by category or month, or a sum of everything."""
    for name in ["a2_top_categories", "ds_order_enriched", "int_orders_enriched", "int_seller_metrics", "int_customer_metrics",
                 "b_category_analytics", "b_category_analytics_original", "mart_monthly_revenue"]:
        lines = _plan(E.queries()[name](spark, SF)).splitlines()
        for i, ln in enumerate(lines):
            if "Exchange SinglePartition" in ln:
                below = " ".join(lines[i + 1:i + 6])
                assert any(f"Aggregate(keys=[{k}" in below for k in ("category", "month", "]")) or "keys=[]" in below, (name, ln, below)


def test_dimension_lookups_are_broadcast_and_fact_joins_are_not(spark):
    plan = _plan(E.queries()["stg_products"](spark, SF))
    assert "BroadcastHashJoin" in plan                      # translation: a code list
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # static plan: size estimates only
    try:
        from mercadia.plans.catalog import bound_sources
        from mercadia.plans.pipeline import build_models
        df = build_models(bound_sources(spark, "/root/testdata/sf0.1"))["int_orders_enriched"]
        static = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # items, payments and reviews meet the orders by shuffle; none of the three is broadcast
    assert static.count("SortMergeJoin") >= 3
    assert all("order_id" not in ln for ln in static.splitlines() if "BroadcastHashJoin" in ln)


def test_hot_order_join_is_split_by_adaptive_execution(spark, tmp_dir):
    """Pipeline path: items meet the *materialised* order model in a two-way
    join, so AQE splits an order holding a third of the items across tasks."""
    from datetime import datetime as dt

    from mercadia.plans import intermediate as im
    from mercadia.plans import staging as st
    from tests.conftest import make
    n = 3000
    o = make(spark, "orders", [{"order_id": str(k), "customer_id": str(k), "order_status": "delivered",
                                "order_purchase_timestamp": dt(2017, 1, 1),
                                "order_delivered_customer_date": dt(2017, 1, 5 + k % 20),
                                "order_estimated_delivery_date": dt(2017, 1, 15)} for k in range(n)])
    c = make(spark, "customers", [{"customer_id": str(k), "customer_unique_id": f"u{k % 500}"} for k in range(n)])
    i = make(spark, "order_items", [{"order_id": "0" if j < 20000 else str(j % n), "order_item_id": j,
                                     "product_id": f"p{j % 50}", "seller_id": f"s{j % 30}", "price": 1.0 + j % 7,
                                     "freight_value": 1.0} for j in range(60000)])
    pr = make(spark, "products", [{"product_id": f"p{j}", "product_category_name": "cama"} for j in range(50)])
    t = make(spark, "product_category_name_translation",
             [{"product_category_name": "cama", "product_category_name_english": "bed"}])
    items, prods = st.stg_order_items(i), st.stg_products(pr, t)
    oe = im.int_orders_enriched(st.stg_orders(o), st.stg_customers(c), items,
                                st.stg_order_payments(make(spark, "order_payments", [])),
                                st.stg_order_reviews(make(spark, "order_reviews", [])))
    oe.write.parquet(f"{tmp_dir}/oe")
    oe_t = spark.read.parquet(f"{tmp_dir}/oe")
    expected = sorted(map(tuple, im.int_seller_metrics(items, prods, oe).collect()))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = im.int_seller_metrics(items, prods, oe_t)
        got = sorted(map(tuple, df.collect()))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan
    assert got == expected


def test_order_dataset_groups_orders_before_they_meet_categories(spark):
    """After the join with categories nothing is grouped by all columns of the orders: rows of
    (order, category) are too many for one task's hash map."""
    plan = E.queries()["ds_order_enriched"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    keys = [ln.split("Aggregate [", 1)[1].split("]", 1)[0] for ln in plan.splitlines() if "Aggregate [" in ln]
    assert any("customer_city" in k for k in keys)
    assert not any("customer_city" in k and "category" in k for k in keys)


def test_partitions_after_a_shuffle_are_small(spark):
    from mercadia.session import configure
    assert configure(spark).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16MB"


def test_repeated_order_rows_count_each(spark):
    from datetime import datetime as dt

    from mercadia.plans import dashboards as db
    from tests.conftest import make
    o = make(spark, "orders", [{"order_id": "1", "customer_id": "c", "order_status": "delivered", "order_purchase_timestamp": dt(2017, 1, 1)}] * 2)
    c = make(spark, "customers", [{"customer_id": "c", "customer_unique_id": "u"}])
    i = make(spark, "order_items", [{"order_id": "1", "order_item_id": j, "product_id": "p", "price": 1.5, "freight_value": 0.25} for j in (1, 2)])
    pr = make(spark, "products", [{"product_id": "p", "product_category_name": "cama"}])
    t = make(spark, "product_category_name_translation", [{"product_category_name": "cama", "product_category_name_english": "bed"}])
    p = make(spark, "order_payments", [{"order_id": "1", "payment_sequential": j, "payment_type": "boleto", "payment_value": 2.0} for j in (1, 2, 3)])
    r = make(spark, "order_reviews", [{"order_id": "1", "review_id": f"r{s}", "review_score": s} for s in (2, 3)])
    row = db.ds_order_enriched(o, c, i, pr, t, p, r).collect()
    assert len(row) == 1  # 2 order rows, 2 items, 3 payments, 2 reviews
    assert [float(row[0][k]) for k in ("items_revenue", "freight_revenue", "total_payment", "boleto_payment", "avg_review_score")] == [36, 6, 48, 48, 2.5]
    assert row[0].credit_card_payment is None
