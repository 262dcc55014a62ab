"""Inline fixtures for cases the bound test data lacks (FIXTURES.md §4)."""

from datetime import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from mercadia.plans import dashboards as db
from mercadia.plans import intermediate as im
from mercadia.plans import marts as mt
from mercadia.plans import reports as rp
from mercadia.plans import staging as st
from tests.conftest import make

TR = [{"product_category_name": "cama", "product_category_name_english": "bed"},
      {"product_category_name": "mesa", "product_category_name_english": "table"}]


def _order(oid, ts, status="delivered", delivered=None, estimated=None, customer=None):
    return {"order_id": oid, "customer_id": customer or f"c{oid}", "order_status": status,
            "order_purchase_timestamp": ts, "order_delivered_customer_date": delivered,
            "order_estimated_delivery_date": estimated}


def _pay(oid, value, seq=1, ptype="credit_card", inst=1):
    return {"order_id": oid, "payment_sequential": seq, "payment_type": ptype, "payment_installments": inst,
            "payment_value": Decimal(str(value))}


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_mom_uses_previous_present_month_and_zero_guard(spark):
    o = make(spark, "orders", [_order("1", dt(2016, 10, 5)), _order("2", dt(2016, 12, 5)),
                               _order("3", dt(2017, 1, 5)), _order("4", dt(2017, 2, 5))])
    p = make(spark, "order_payments", [_pay("1", "100.00"), _pay("2", "150.00"), _pay("3", "0.00"),
                                       _pay("4", "10.00")])
    out = {(r.year, r.month): r for r in rp.a1_monthly_revenue(o, p).collect()}
    assert out[(2016, 10)].mom_change_pct is None                      # first row
    assert out[(2016, 12)].prev_month_revenue == Decimal("100.00")     # 2016-11 absent: previous present row
    assert out[(2016, 12)].mom_change_pct == Decimal("50.00")
    assert out[(2017, 1)].mom_change_pct == Decimal("-100.00")
    assert out[(2017, 2)].mom_change_pct is None                       # previous month is 0 → NULL, no error


def test_split_payment_fans_out(spark):
    o = make(spark, "orders", [_order("1", dt(2017, 1, 1), delivered=dt(2017, 1, 9), estimated=dt(2017, 1, 10))])
    i = make(spark, "order_items", [
        {"order_id": "1", "order_item_id": 1, "product_id": "p1", "price": 10.0, "freight_value": 1.0},
        {"order_id": "1", "order_item_id": 2, "product_id": "p1", "price": 20.0, "freight_value": 1.0}])
    p = make(spark, "order_payments", [_pay("1", "25.00", 1), _pay("1", "5.00", 2, "boleto")])
    pr = make(spark, "products", [{"product_id": "p1", "product_category_name": "cama"}])
    t = make(spark, "product_category_name_translation", TR)
    a2 = rp.a2_top_categories(o, i, p, pr, t).collect()[0]
    assert a2.total_revenue == Decimal("60.00")      # 30 paid, counted once per item
    assert a2.total_items_sold == 4                    # 2 items × 2 payments
    b = rp.b_category_analytics(o, i, p, pr, t).collect()[0]
    assert b.total_revenue == Decimal("60.00")        # 30 of prices, counted once per payment
    assert b.credit_card_revenue == Decimal("50.00") and b.boleto_revenue == Decimal("10.00")
    orig = rp.b_category_analytics_original(o, i, p, pr, t).collect()[0]
    assert orig.total_revenue == Decimal("30.00")     # the unoptimised form does not multiply prices


def test_b_original_equals_optimised_with_one_payment_per_order(spark):
    o = make(spark, "orders", [
        _order(str(k), dt(2017, 1, k), delivered=dt(2017, 2, k), estimated=dt(2017, 1, 20)) for k in (1, 2, 3)])
    i = make(spark, "order_items", [
        {"order_id": str(k), "order_item_id": 1, "product_id": f"p{k}", "price": 10.0 * k, "freight_value": 1.0}
        for k in (1, 2, 3)])
    p = make(spark, "order_payments", [_pay(str(k), f"{10 * k}.00", 1, "boleto" if k == 2 else "credit_card")
                                       for k in (1, 2, 3)])
    pr = make(spark, "products", [{"product_id": "p1", "product_category_name": "cama"},
                                  {"product_id": "p2", "product_category_name": "cama"},
                                  {"product_id": "p3", "product_category_name": "mesa"}])
    t = make(spark, "product_category_name_translation", TR)
    a = sorted(rp.b_category_analytics(o, i, p, pr, t).collect())
    b = sorted(rp.b_category_analytics_original(o, i, p, pr, t).collect())
    assert a == b


def test_untranslated_category(spark):
    o = make(spark, "orders", [_order("1", dt(2017, 1, 1), delivered=dt(2017, 1, 2), estimated=dt(2017, 1, 3))])
    i = make(spark, "order_items", [
        {"order_id": "1", "order_item_id": 1, "product_id": "p1", "price": 10.0, "freight_value": 1.0},
        {"order_id": "1", "order_item_id": 2, "product_id": "p2", "price": 20.0, "freight_value": 1.0}])
    p = make(spark, "order_payments", [_pay("1", "30.00", 1, "voucher")])
    pr = make(spark, "products", [{"product_id": "p1", "product_category_name": "unknown_pt"},
                                  {"product_id": "p2", "product_category_name": None}])
    t = make(spark, "product_category_name_translation", TR)
    assert rp.a2_top_categories(o, i, p, pr, t).count() == 0
    b = rp.b_category_analytics(o, i, p, pr, t).collect()
    assert [r.category for r in b] == ["uncategorized"]
    assert b[0].credit_card_share_pct is None          # no card and no boleto payment (S7)
    assert b[0].credit_card_revenue is None


def test_staging_filters_and_blanks(spark):
    items = make(spark, "order_items", [
        {"order_id": None, "product_id": "p", "price": 1.0}, {"order_id": "1", "product_id": None, "price": 1.0},
        {"order_id": "1", "product_id": "p", "price": None}, {"order_id": "1", "product_id": "p", "price": 2.005,
                                                              "freight_value": None}])
    s = st.stg_order_items(items).collect()
    assert len(s) == 1 and s[0].item_price == Decimal("2.01") and s[0].total_item_cost is None
    pays = make(spark, "order_payments", [_pay("1", "-1.00"), _pay("1", "3.00"), {"order_id": "1"}])
    assert [r.payment_amount for r in st.stg_order_payments(pays).collect()] == [Decimal("3.00")]
    rev = make(spark, "order_reviews", [
        {"review_id": "a", "order_id": "1", "review_score": 2, "review_comment_title": "",
         "review_comment_message": "  "},
        {"review_id": "b", "order_id": "1", "review_score": 3, "review_comment_title": "\tx",
         "review_comment_message": " ok "},
        {"review_id": "c", "order_id": "1", "review_score": None}])
    r = {x.review_id: x for x in st.stg_order_reviews(rev).collect()}
    assert set(r) == {"a", "b"}
    assert r["a"].review_title is None and r["a"].review_message is None and r["a"].is_low_score
    assert r["b"].review_title == "\tx" and r["b"].review_message == "ok" and not r["b"].is_low_score


def test_initcap_like_postgres(spark):
    c = make(spark, "customers", [
        {"customer_id": "1", "customer_city": "mogi-guacu", "customer_state": "sp"},
        {"customer_id": "2", "customer_city": "SANTA BARBARA D'OESTE", "customer_state": "sp"},
        {"customer_id": "3", "customer_city": "são paulo", "customer_state": "sp"},
        {"customer_id": None, "customer_city": "x"}])
    got = dict(rows(st.stg_customers(c), "customer_id", "city"))
    assert got == {"1": "Mogi-Guacu", "2": "Santa Barbara D'Oeste", "3": "São Paulo"}
    assert {r.state for r in st.stg_customers(c).collect()} == {"SP"}


def _stg(spark, orders, customers, items=(), pays=(), revs=()):
    return (st.stg_orders(make(spark, "orders", orders)), st.stg_customers(make(spark, "customers", customers)),
            st.stg_order_items(make(spark, "order_items", list(items))),
            st.stg_order_payments(make(spark, "order_payments", list(pays))),
            st.stg_order_reviews(make(spark, "order_reviews", list(revs))))


def test_order_without_children_gets_defaults(spark):
    oe = im.int_orders_enriched(*_stg(spark, [_order("1", dt(2017, 1, 1))],
                                      [{"customer_id": "c1", "customer_unique_id": "u1"}])).collect()[0]
    assert (oe.total_items_price, oe.total_freight, oe.item_count, oe.total_payment) == (0, 0, 0, 0)
    assert oe.max_installments == 1 and oe.has_low_score is False and oe.review_count == 0
    assert oe.avg_review_score is None and oe.primary_payment_type is None
    assert oe.is_late_delivery is False and oe.delivery_delay_days is None


def test_primary_payment_type_tie_breaks_on_sequence(spark):
    pays = make(spark, "order_payments", [_pay("1", "5.00", 1, "boleto"), _pay("1", "20.00", 3, "voucher"),
                                          _pay("1", "20.00", 2, "credit_card")])
    r = im.order_payment_totals(st.stg_order_payments(pays)).collect()[0]
    assert r.primary_payment_type == "credit_card" and r.total_payment == Decimal("45.00")


def test_late_is_after_the_estimate_instant(spark):
    o = [_order("1", dt(2017, 1, 1), delivered=dt(2017, 1, 10, 15, 0), estimated=dt(2017, 1, 10)),
         _order("2", dt(2017, 1, 1), delivered=dt(2017, 1, 9, 12, 0), estimated=dt(2017, 1, 10))]
    c = [{"customer_id": "c1", "customer_unique_id": "u"}, {"customer_id": "c2", "customer_unique_id": "u"}]
    got = {r.order_id: r for r in im.int_orders_enriched(*_stg(spark, o, c)).collect()}
    assert got["1"].is_late_delivery and got["1"].delivery_delay_days == Decimal("0.6")
    assert not got["2"].is_late_delivery and got["2"].delivery_delay_days == Decimal("-0.5")


def test_repeated_product_rate_can_exceed_100(spark):
    o = [_order("1", dt(2017, 1, 1))]
    c = [{"customer_id": "c1", "customer_unique_id": "u"}]
    items = [{"order_id": "1", "order_item_id": k, "product_id": "p", "seller_id": "s", "price": 10.0,
              "freight_value": 1.0} for k in (1, 2, 3)]
    revs = [{"review_id": "r", "order_id": "1", "review_score": 1}]
    s = _stg(spark, o, c, items, [_pay("1", "30.00")], revs)
    oe = im.int_orders_enriched(*s)
    prods = st.stg_products(make(spark, "products", [{"product_id": "p", "product_category_name": "cama"}]),
                            make(spark, "product_category_name_translation", TR))
    pp = mt.mart_product_performance(s[2], prods, oe).collect()[0]
    assert pp.low_score_order_count == 3 and pp.low_score_rate_pct == Decimal("300.0")
    sm = im.int_seller_metrics(s[2], prods, oe).collect()[0]
    assert sm.low_score_rate_pct == Decimal("300.0") and sm.top_category == "bed"


def test_recency_edges_and_ntile_with_fewer_rows_than_tiles(spark):
    ref = dt(2018, 1, 1)
    orders, customers = [], []
    for n, days in enumerate([180, 181, 365, 366]):
        for j, ts in enumerate([dt(2015, 1, 1), ref - _days(days)]):
            oid = f"{n}-{j}"
            orders.append(_order(oid, ts, customer=f"c{oid}"))
            customers.append({"customer_id": f"c{oid}", "customer_unique_id": f"u{n}"})
    orders.append(_order("ref", ref, customer="cref"))
    customers.append({"customer_id": "cref", "customer_unique_id": "uref"})
    oe = im.int_orders_enriched(*_stg(spark, orders, customers, pays=[_pay(o["order_id"], "1.00")
                                                                      for o in orders]))
    seg = mt.mart_customer_segments(im.int_customer_metrics(oe))
    got = dict(rows(seg, "customer_unique_id", "customer_segment"))
    assert got == {"u0": "returning", "u1": "at_risk", "u2": "at_risk", "u3": "churned", "uref": "new"}
    # 5 people, 4 tiles: first tile gets 2
    q = sorted(r.spend_quartile for r in seg.collect())
    assert q == [1, 1, 2, 3, 4]
    three = seg.where(F.col("customer_unique_id").isin("u0", "u1", "u2"))
    from mercadia.operators.windows import Key, global_window
    nt = global_window(three.drop("spend_quartile"), [Key("total_spend", True)], ["customer_unique_id"],
                       ntile=("t", 4))
    assert sorted(r.t for r in nt.collect()) == [1, 2, 3]


def _days(n):
    from datetime import timedelta
    return timedelta(days=n)


def test_equal_spend_ties_are_deterministic(spark):
    from mercadia.operators.windows import Key, global_window
    df = spark.createDataFrame([(f"u{k}", 10) for k in range(4)], "id string, spend int")
    a = rows(global_window(df, [Key("spend", True)], ["id"], rank="r", row_number="n"), "id", "r", "n")
    assert sorted(a) == [("u0", 1, 1), ("u1", 1, 2), ("u2", 1, 3), ("u3", 1, 4)]


def test_dashboard_filters_scope(spark):
    o = make(spark, "orders", [_order("1", dt(2017, 1, 1)), _order("2", dt(2019, 1, 1)),
                               _order("3", dt(2017, 5, 1), status="shipped")])
    out = db.dashboard_filters(o.withColumnRenamed("order_purchase_timestamp", "ordered_at"),
                               status=["delivered"], state=["SP"])  # no customer_state column → skipped
    assert [r.order_id for r in out.collect()] == ["1"]


def test_customer_segments_dashboard_catch_all(spark):
    o = make(spark, "orders", [_order("1", dt(2017, 1, 1), customer="c1"), _order("2", dt(2017, 1, 2), customer="c2"),
                               _order("3", dt(2018, 1, 1), customer="c3")])
    c = make(spark, "customers", [{"customer_id": "c1", "customer_unique_id": "u1", "customer_state": "sp"},
                                  {"customer_id": "c2", "customer_unique_id": "u1", "customer_state": "sp"},
                                  {"customer_id": "c3", "customer_unique_id": "u2", "customer_state": "rj"}])
    p = make(spark, "order_payments", [_pay("1", "1.00"), _pay("2", "2.00"), _pay("3", "3.00")])
    got = dict(rows(db.ds_customer_segments(o, c, p), "customer_unique_id", "segment"))
    assert got == {"u1": "at_risk", "u2": "new"}


def test_hot_order_matches_brute_force_join(spark):
    """One order holds a third of all item rows; report B must equal the literal
    five-way join (with its fan-out) evaluated by Spark SQL."""
    n_orders, n_items = 300, 3000
    o = make(spark, "orders", [_order(str(k), dt(2017, 1, 1), delivered=dt(2017, 1, 5 + k % 20),
                                      estimated=dt(2017, 1, 15)) for k in range(n_orders)])
    i = make(spark, "order_items", [
        {"order_id": "0" if j < n_items // 3 else str(j % n_orders), "order_item_id": j, "product_id": f"p{j % 40}",
         "price": 1.0 + j % 7, "freight_value": 1.0} for j in range(n_items)])
    p = make(spark, "order_payments", [_pay(str(k), f"{5 + k % 9}.00", s, "boleto" if (k + s) % 3 == 0 else "credit_card")
                                       for k in range(n_orders) for s in range(1, 1 + k % 3 + 1)])
    pr = make(spark, "products", [{"product_id": f"p{j}", "product_category_name": ["cama", "mesa", "x"][j % 3]}
                                  for j in range(40)])
    t = make(spark, "product_category_name_translation", TR)
    for name, df in {"o": o, "i": i, "p": p, "pr": pr, "t": t}.items():
        df.createOrReplaceTempView(f"hot_{name}")
    brute = spark.sql("""
        SELECT COALESCE(t.product_category_name_english, 'uncategorized') AS category,
               COUNT(DISTINCT oi.order_id) AS total_orders,
               ROUND(SUM(CAST(oi.price AS DECIMAL(18,2))), 2) AS total_revenue,
               ROUND(SUM(op.payment_value) FILTER (WHERE op.payment_type = 'credit_card'), 2) AS credit_card_revenue,
               ROUND(SUM(op.payment_value) FILTER (WHERE op.payment_type = 'boleto'), 2) AS boleto_revenue,
               COUNT(DISTINCT CASE WHEN o.order_delivered_customer_date > o.order_estimated_delivery_date
                                   THEN o.order_id END) AS late_count
        FROM hot_pr p LEFT JOIN hot_t t ON t.product_category_name = p.product_category_name
        JOIN hot_i oi ON oi.product_id = p.product_id
        JOIN hot_o o ON o.order_id = oi.order_id
        JOIN hot_p op ON op.order_id = oi.order_id
        WHERE o.order_delivered_customer_date IS NOT NULL
        GROUP BY 1""")
    cols = ["category", "total_orders", "total_revenue", "credit_card_revenue", "boleto_revenue", "late_count"]
    ours = rp.b_category_analytics(o, i, p, pr, t).select(*cols)
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, brute.collect()))


def test_repeated_order_row_keeps_distinct_counts(spark):
    """An order row that appears twice multiplies sums (as the join does) but
    is still one distinct order."""
    row = _order("1", dt(2017, 1, 1), delivered=dt(2017, 1, 20), estimated=dt(2017, 1, 10))
    o = make(spark, "orders", [row, row])
    i = make(spark, "order_items", [{"order_id": "1", "order_item_id": 1, "product_id": "p1", "price": 10.0,
                                     "freight_value": 1.0}])
    p = make(spark, "order_payments", [_pay("1", "10.00")])
    pr = make(spark, "products", [{"product_id": "p1", "product_category_name": "cama"}])
    t = make(spark, "product_category_name_translation", TR)
    b = rp.b_category_analytics(o, i, p, pr, t).collect()[0]
    assert (b.total_orders, b.late_count, b.total_revenue, b.credit_card_revenue) == (1, 1, Decimal("20.00"),
                                                                                     Decimal("20.00"))
    a2 = rp.a2_top_categories(o, i, p, pr, t).collect()[0]
    assert (a2.distinct_orders, a2.total_items_sold, a2.total_revenue) == (1, 2, Decimal("20.00"))
