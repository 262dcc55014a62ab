"""Versioned tables, gates, incremental refresh, quarantine, footers and buckets."""

import os
import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mercadia.operators.gate import Gate, RuleBroken, accepted, in_range, not_null, publish_gated
from mercadia.plans import refresh as rf
from mercadia.plans.catalog import Ctx
from mercadia.plans.pipeline import MODEL_GATES, run_pipeline
from mercadia.sources.readers import footer_row_counts, publish_bucketed, read_csv_quarantine
from mercadia.sources.versions import current_version, drop_versions, is_versioned, read_current, replace_version, write_version

SF = "/root/testdata/sf0.001"


def same(a, b):
    return Counter(map(tuple, a.collect())) == Counter(map(tuple, b.select(*a.columns).collect()))


# --- versions

def test_a_reader_never_misses_the_table(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    replace_version(spark.range(100), root)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(read_current(spark, root).count())

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in (200, 300, 400):
            replace_version(spark.range(n), root)
    finally:
        stop.set()
        reader.join()
    assert seen and set(seen) <= {100, 200, 300, 400} and seen == sorted(seen)
    assert read_current(spark, root).count() == 400


def test_versions_are_whole_and_kept(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    assert current_version(spark, root) is None and not is_versioned(spark, root)
    with pytest.raises(FileNotFoundError):
        read_current(spark, root)
    first = replace_version(spark.range(5), root)
    old = read_current(spark, root)
    replace_version(read_current(spark, root).where("id < 3"), root)  # may read what it replaces
    assert old.count() == 5 and read_current(spark, root).count() == 3  # an old reader goes on as before
    with pytest.raises(Exception):  # noqa: B017
        replace_version(spark.range(5).select(F.raise_error(F.lit("broken")).alias("id")), root)
    assert read_current(spark, root).count() == 3
    write_version(spark.range(9), root)  # written, not published
    assert read_current(spark, root).count() == 3
    assert first in drop_versions(spark, root, keep=1) and read_current(spark, root).count() == 3
    assert len([d for d in os.listdir(root) if d.startswith("v-")]) == 1


# --- gates

def test_a_broken_rule_blocks_its_table(spark, tmp_dir):
    root = f"{tmp_dir}/m"
    gate = Gate((not_null("k"), accepted("s", ["a", "b"]), in_range("v", 0, 10)), ("k",), 2)
    good = spark.createDataFrame([(1, "a", 0), (2, None, 10), (3, "b", None)], "k int, s string, v int")
    table, counts = publish_gated(good, root, gate)
    assert same(table, good) and counts["rows"] == 3 and not any(n for name, n in counts.items() if name != "rows")
    bad = spark.createDataFrame([(1, "a", -1), (1, "c", 11), (None, "b", 5)], "k int, s string, v int")
    with pytest.raises(RuleBroken) as e:
        publish_gated(bad, root, gate, "m")
    assert e.value.counts == {"k is not null": 1, "s is one of 2 values": 1, "v from 0 to 10": 2, "k unique": 2}
    with pytest.raises(RuleBroken, match="at least 2 rows"):
        publish_gated(good.limit(1), root, gate)
    assert same(read_current(spark, root), good)  # still the one before


def test_gate_counts_in_the_writing_pass(spark, tmp_dir):
    """Each row is evaluated once: by the write that also counts."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(1000).mapInArrow(count, "id long")
    publish_gated(df, f"{tmp_dir}/g", Gate((in_range("id", 0),), (), 1))
    assert seen.value == 1000


def test_a_broken_input_ends_the_run(spark, tmp_dir):
    src = dict(Ctx(spark, SF).src)
    built = run_pipeline(src, f"{tmp_dir}/models", select=["mart_monthly_revenue"], gates=MODEL_GATES)
    before = built["mart_monthly_revenue"].count()
    src["order_reviews"] = src["order_reviews"].withColumn("review_score", F.lit(9))
    with pytest.raises(RuleBroken, match="int_orders_enriched.*avg_review_score"):
        run_pipeline(src, f"{tmp_dir}/models", select=["mart_monthly_revenue"], gates=MODEL_GATES)
    assert read_current(spark, f"{tmp_dir}/models/mart_monthly_revenue").count() == before
    with pytest.raises(ValueError):
        run_pipeline(src, gates=MODEL_GATES)


# --- incremental refresh

def files_of(root):
    return {(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_only_changed_months_are_rewritten(spark, tmp_dir):
    c = Ctx(spark, SF)
    src = dict(c.src)
    month = F.date_format("order_purchase_timestamp", "yyyy-MM")
    months = [r[0] for r in src["orders"].select(month).distinct().orderBy(month).collect()]
    all_months = {m or rf.NO_MONTH for m in months}
    assert set(rf.refresh_models(src, tmp_dir)) == all_months
    assert rf.refresh_models(src, tmp_dir) == []
    before = files_of(f"{tmp_dir}/int_orders_enriched")
    one = next(m for m in months if m)
    in_month = src["orders"].where(month == one).select("order_id")
    src["order_items"] = src["order_items"].join(in_month, "order_id", "left_anti")  # a month loses its items
    assert rf.refresh_models(src, tmp_dir) == [one]
    after = files_of(f"{tmp_dir}/int_orders_enriched")
    assert {d.rsplit("=", 1)[1] for d, _ in before.items() ^ after.items() for d in [d[0]]} == {one}
    full = Ctx(spark, SF)
    full.src = src
    assert same(rf.read_orders(spark, tmp_dir).drop(rf.MONTH), full.m["int_orders_enriched"])
    assert same(rf.read_monthly_mart(spark, tmp_dir), full.m["mart_monthly_revenue"])


def test_months_that_go_and_refreshes_cut_short(spark, tmp_dir, monkeypatch):
    src = dict(Ctx(spark, SF).src)
    rf.refresh_models(src, tmp_dir)
    month = F.date_format("order_purchase_timestamp", "yyyy-MM")
    gone = src["orders"].select(month.alias("m")).where("m IS NOT NULL").agg(F.max("m")).first()[0]
    less = dict(src)
    less["orders"] = src["orders"].where(F.coalesce(month, F.lit("")) != gone)
    assert rf.refresh_models(less, tmp_dir) == [gone]
    assert rf.read_orders(spark, tmp_dir).where(F.col(rf.MONTH) == gone).count() == 0
    with monkeypatch.context() as m:  # ends after the old data went, before the new is there
        m.setattr(rf, "_overwrite_months", lambda *a: 1 / 0)
        changed = dict(less)
        changed["order_reviews"] = less["order_reviews"].where(F.lit(False))
        with pytest.raises(ZeroDivisionError):
            rf.refresh_models(changed, tmp_dir)
    rf.refresh_models(less, tmp_dir)  # the sources as they were: months without a mark are done again
    full = Ctx(spark, SF)
    full.src = less
    assert same(rf.read_orders(spark, tmp_dir).drop(rf.MONTH), full.m["int_orders_enriched"])


# --- quarantine, footers, buckets

def test_bad_lines_are_kept_apart(spark, tmp_dir):
    from pyspark.sql import types as T
    os.makedirs(f"{tmp_dir}/t.csv")
    with open(f"{tmp_dir}/t.csv/part-1.csv", "w") as f:
        f.write('a,n,t\nx,1,2017-01-01 10:00:00\ny,two,2017-01-01 10:00:00\n"q, r",3,2017-01-02 00:00:00\nonly one\nz,4,2017-01-03 00:00:00,too,many\n,,\n')
    with open(f"{tmp_dir}/t.csv/part-2.csv", "w") as f:
        f.write("a,n,t\nlast,5,yesterday\n")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("t", T.TimestampNTZType())])
    keep = f"{tmp_dir}/quarantine"
    good, bad = read_csv_quarantine(spark, f"{tmp_dir}/t.csv", schema, keep)
    assert sorted(((r.a, r.n) for r in good.collect()), key=str) == [("q, r", 3), ("x", 1), (None, None)]
    assert sorted(r.line for r in bad.collect()) == ["last,5,yesterday", "only one", "y,two,2017-01-01 10:00:00", "z,4,2017-01-03 00:00:00,too,many"]
    assert {r.file.rsplit("/", 1)[1] for r in bad.where("line LIKE 'last%'").collect()} == {"part-2.csv"}
    assert good.select("a").count() == good.count() == 3  # whatever is asked for
    read_csv_quarantine(spark, f"{tmp_dir}/t.csv", schema, keep)
    assert spark.read.parquet(keep).count() == 8 and spark.read.parquet(keep).select("loaded_at").distinct().count() == 2


def test_counts_come_from_the_footers(spark):
    names = ["orders", "lineitem", "nation"]
    counts = footer_row_counts(spark, {n: f"{SF}/{n}.parquet" for n in names})
    assert {r.table: r.row_count for r in counts.collect()} == {n: spark.read.parquet(f"{SF}/{n}.parquet").count() for n in names}
    plan = counts._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("PushedAggregation: [COUNT(*)]") == 3 and "ReadSchema: struct<count(*):bigint>" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_bucketed_tables_join_without_an_exchange(spark, tmp_dir):
    from mercadia.plans.intermediate import _items_of_open_orders
    from mercadia.plans.marts import mart_product_performance
    c = Ctx(spark, SF)
    items = publish_bucketed(c.m["stg_order_items"], "bucketed_items", "order_id", 8, f"{tmp_dir}/items")
    orders = publish_bucketed(c.m["int_orders_enriched"], "bucketed_orders", "order_id", 8, f"{tmp_dir}/orders")
    assert same(items, c.m["stg_order_items"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _items_of_open_orders(items, c.m["stg_products"], orders, ("canceled",))._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(order_id" not in plan and "SortMergeJoin [order_id" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert same(mart_product_performance(items, c.m["stg_products"], orders), c.m["mart_product_performance"])
    publish_bucketed(c.m["stg_order_items"].limit(10), "bucketed_items", "order_id", 8, f"{tmp_dir}/items2")
    assert spark.table("bucketed_items").count() == 10


def test_refresh_of_most_months_filters_no_source_and_of_few_shuffles_no_ids(spark):
    src = dict(Ctx(spark, SF).src)
    now = {r[rf.MONTH]: (r["input_rows"], r["fingerprint"]) for r in rf.fingerprints(src).collect()}
    plan = lambda months: rf._models_of(src, months, now)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan(list(now))
    one = plan(["1996-03"])
    assert one.count("LeftSemi") == 3 and one.count("rightHint=(strategy=broadcast)") == 3


def test_fingerprints_add_up_whole_hashes(spark):
    from decimal import Decimal
    df = spark.createDataFrame([("a", i) for i in range(-50, 50)] + [(None, 1)], "order_id string, x int")
    hashed = [(r.order_id, r.h) for r in df.select("order_id", F.xxhash64(F.lit("s"), "order_id", "x").alias("h")).collect()]
    got = {r.order_id: (r.h, r.n) for r in rf._added_up(rf._hashed(df, "s", F.col("order_id")), "order_id", "h", "n").collect()}
    assert got == {k: (Decimal(sum(h for o, h in hashed if o == k)), sum(o == k for o, _ in hashed)) for k in ("a", None)}


def test_seller_rows_are_added_up_by_hash_before_a_category_is_chosen(spark):
    """What chooses the category sorts its input: that is one row per seller and category, not one per order."""
    from mercadia.plans.intermediate import int_seller_metrics
    items = spark.sql("SELECT string(id) AS order_id, string(id % 3) AS seller_id, string(id % 5) AS product_id, int(1) AS item_sequence, "
                      "CAST(id AS decimal(18,2)) AS item_price, CAST(1 AS decimal(18,2)) AS freight_cost FROM range(60)")
    products = spark.sql("SELECT string(id) AS product_id, IF(id < 2, 'a', 'b') AS category_name_en FROM range(4)")
    orders = spark.sql("SELECT string(id) AS order_id, IF(id % 10 = 0, 'canceled', 'delivered') AS order_status, "
                       "CAST(id % 5 AS decimal(10,1)) AS avg_review_score, id % 2 = 0 AS is_late_delivery, "
                       "CAST(id AS decimal(10,1)) AS delivery_delay_days, id % 4 = 0 AS has_low_score FROM range(60)")
    out = int_seller_metrics(items, products, orders)
    plan = out._jdf.queryExecution().executedPlan().toString()
    sorting = plan[plan.index("SortAggregate"):]
    first = next(line for line in sorting.splitlines() if "HashAggregate" in line)
    assert "keys=[seller_id" in first and "order_id" not in first and "_gid" in first and "_cat" in first
    rows = {r.seller_id: r for r in out.collect()}
    mine = [i for i in range(60) if i % 10 and i % 3 == 1]
    assert rows["1"].total_orders == rows["1"].total_items_sold == len(mine) and rows["1"].total_revenue == sum(mine)
    revenue = {c: sum(i for i in mine if i % 5 in ps) for c, ps in (("a", (0, 1)), ("b", (2, 3)))}
    assert rows["1"].top_category == max(revenue, key=revenue.get) and rows["1"].low_score_orders == sum(i % 4 == 0 for i in mine)
