"""Readers, writers, publication and the ordered pipeline run."""

import os

from pyspark.sql import functions as F

from mercadia.plans.catalog import bound_sources, canonical
from mercadia.plans.pipeline import MODEL_GRAPH, run_pipeline, table_row_counts
from mercadia.sources import publish, read_csv_table, write_replace
from mercadia.sources.schemas import SOURCE_TABLES

SF = "/root/testdata/sf0.001"


def test_csv_round_trip(spark, tmp_dir):
    src = bound_sources(spark, SF)
    reviews = src["order_reviews"]
    path = os.path.join(tmp_dir, "order_reviews.csv")
    reviews.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    back = read_csv_table(spark, path, "order_reviews")
    assert back.schema == reviews.schema
    # CSV cannot tell '' from NULL; compare the non-text columns exactly
    cols = ["review_id", "order_id", "review_score", "review_creation_date", "review_answer_timestamp"]
    assert back.select(*cols).exceptAll(reviews.select(*cols)).count() == 0
    assert back.count() == reviews.count()


def test_write_replace_overwrites(spark, tmp_dir):
    df = spark.range(10)
    target = os.path.join(tmp_dir, "t")
    write_replace(df, target)
    write_replace(spark.range(3), target)
    assert spark.read.parquet(target).count() == 3


def test_publish_view_and_table(spark, tmp_dir):
    v = publish(spark.range(4), "mercadia_test_view", "view")
    assert spark.table("mercadia_test_view").count() == 4 and v.count() == 4
    t = publish(spark.range(5), "mercadia_test_table", "table", path=os.path.join(tmp_dir, "tbl"))
    assert t.count() == 5


def test_pipeline_runs_in_order_and_materialises(spark, tmp_dir):
    built = run_pipeline(bound_sources(spark, SF), materialise_root=tmp_dir,
                         select=["mart_monthly_revenue", "int_customer_metrics"])
    assert list(built) == [n for n, *_ in MODEL_GRAPH if n in built]
    assert "mart_product_performance" not in built
    assert os.path.isdir(os.path.join(tmp_dir, "int_orders_enriched"))
    assert os.path.isdir(os.path.join(tmp_dir, "mart_monthly_revenue"))
    m = built["mart_monthly_revenue"]
    # YTD of the last month of a year equals that year's sum
    last = m.groupBy(F.year("month").alias("y")).agg(F.max("month").alias("month"), F.sum("total_revenue").alias("s"))
    chk = last.join(m, "month").where(F.col("s") != F.col("ytd_revenue"))
    assert chk.count() == 0


def test_row_counts_cover_nine_tables(spark):
    rc = {r.table: r.row_count for r in table_row_counts(bound_sources(spark, SF)).collect()}
    assert set(rc) == set(SOURCE_TABLES) and rc["product_category_name_translation"] == 5


def test_model_grains_are_unique(spark):
    from mercadia.operators.quality import dq_unique_grain
    from mercadia.plans.pipeline import build_models
    m = build_models(bound_sources(spark, SF))
    for name, key in [("int_orders_enriched", ["order_id"]), ("int_customer_metrics", ["customer_unique_id"]),
                      ("int_seller_metrics", ["seller_id"]), ("mart_monthly_revenue", ["month"])]:
        assert dq_unique_grain(m[name], key).count() == 0, name


def test_cohort_sizes_sum_to_people(spark):
    import __spark_entry__ as E
    a3 = E.queries()["a3_cohort_retention"](spark, SF)
    src = bound_sources(spark, SF)
    people = (src["orders"].where((F.col("order_status") != "canceled") & F.col("order_purchase_timestamp").isNotNull())
              .join(src["customers"], "customer_id").select("customer_unique_id").distinct().count())
    assert a3.agg(F.sum("cohort_size")).first()[0] == people


def test_canonical_types(spark):
    df = canonical(spark.sql("SELECT CAST(1 AS INT) a, CAST(1.5 AS DECIMAL(10,2)) b, 'x' c"))
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "double", "string"]


def test_reports_from_csv_sources_match_parquet_bound(spark, tmp_dir):
    """The original input is one CSV per table: write the bound tables as CSV,
    load them with the declared schemas and rerun two reports end to end."""
    from mercadia.plans import reports as rp
    from mercadia.sources import load_tables
    src = bound_sources(spark, SF)
    for name in SOURCE_TABLES:
        (src[name].write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
         .csv(os.path.join(tmp_dir, f"{name}.csv")))
    csv = load_tables(spark, tmp_dir, fmt="csv")
    for t in SOURCE_TABLES:
        assert csv[t].count() == src[t].count(), t
    a = rp.a1_monthly_revenue(csv["orders"], csv["order_payments"])
    b = rp.a1_monthly_revenue(src["orders"], src["order_payments"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    names = ["orders", "order_items", "order_payments", "products", "product_category_name_translation"]
    x = rp.b_category_analytics(*[csv[n] for n in names])
    y = rp.b_category_analytics(*[src[n] for n in names])
    assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_report_invariants_on_bound_data(spark):
    import __spark_entry__ as E
    q = E.queries()
    b = q["b_category_analytics"](spark, SF)
    assert b.agg(F.max("cumulative_revenue_pct")).first()[0] == 100.0
    assert abs(b.agg(F.sum("revenue_share_pct")).first()[0] - 100.0) < 0.05 * b.count()
    seg = q["mart_customer_segments"](spark, SF)
    sizes = [r["count"] for r in seg.groupBy("spend_quartile").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1
    pp = q["mart_product_performance"](spark, SF)
    # walking products in rank order, revenue never increases (neighbour check on a small test table)
    from pyspark.sql import Window
    w = Window.orderBy("revenue_rank", "product_id")
    bad = pp.withColumn("_prev", F.lag("total_revenue").over(w)).where(F.col("_prev") < F.col("total_revenue"))
    assert bad.count() == 0
    # category shares add up to 100 per category (up to rounding)
    sums = pp.groupBy("category").agg(F.sum("category_revenue_share_pct").alias("s"), F.count(F.lit(1)).alias("n"))
    assert sums.where(F.abs(F.col("s") - 100) > 0.005 * F.col("n")).count() == 0


def test_full_pipeline_matches_named_queries(spark, tmp_dir):
    import __spark_entry__ as E
    built = run_pipeline(bound_sources(spark, SF), materialise_root=tmp_dir)
    assert list(built) == [n for n, *_ in MODEL_GRAPH]
    q = E.queries()
    for name in ["int_seller_metrics", "mart_customer_segments", "mart_product_performance"]:
        a, b = canonical(built[name]), q[name](spark, SF)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_cut_lineage_writes_into_the_checkpoint_folder(spark):
    from mercadia.session import cut_lineage, ensure_checkpoint_dir
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.struct(F.col("id").alias("x")).alias("s"))
    out = cut_lineage(df, "probe")
    from urllib.parse import urlparse
    root = urlparse(ensure_checkpoint_dir(spark)).path.rstrip("/")
    files = [urlparse(f).path for f in out.inputFiles()]
    assert files and all(f.startswith(root + "/mercadia-tables/") for f in files)
    assert out.exceptAll(df).count() == 0 and df.exceptAll(out).count() == 0


def test_cut_lineage_leaves_no_shuffle_files(spark):
    import time

    from mercadia.session import SHUFFLE_CLEANUP, cut_lineage
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffle_files():
        return {n for n in (str(b) for b in disk.getAllBlocks().mkString(" ").split()) if n.startswith("shuffle_")}
    before, setting = shuffle_files(), spark.conf.get(SHUFFLE_CLEANUP)
    df = spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count()
    out = cut_lineage(df, "probe")
    for _ in range(50):  # they are deleted in the background
        if not (left := shuffle_files() - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert out.count() == df.count() == 100


def test_entries_see_rewritten_files(spark, tmp_dir):
    """Nothing is kept between two calls of a query in one session."""
    import os
    import shutil

    from mercadia.plans.catalog import queries
    folder = f"{tmp_dir}/live"
    os.makedirs(folder)
    for name in os.listdir(SF):  # the files alone: the test data's folder may be read-only
        shutil.copyfile(f"{SF}/{name}", f"{folder}/{name}")
    q = queries()
    before = q["int_orders_enriched"](spark, folder).count(), q["mart_monthly_revenue"](spark, folder).agg({"total_orders": "sum"}).first()[0]
    some = spark.read.parquet(f"{SF}/orders.parquet").where("o_orderkey % 5 = 0")
    write_replace(some, f"{folder}/orders.parquet")
    after = q["int_orders_enriched"](spark, folder).count(), q["mart_monthly_revenue"](spark, folder).agg({"total_orders": "sum"}).first()[0]
    assert after[0] == some.count() < before[0] and after[1] < before[1]


def test_write_replace_may_read_its_target_and_survives_a_failed_load(spark, tmp_dir):
    import pytest
    from pyspark.sql import functions as F
    path = f"{tmp_dir}/t"
    write_replace(spark.range(10), path)
    write_replace(spark.read.parquet(path).where("id < 4"), path)
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(Exception):  # noqa: B017
        write_replace(spark.range(5).select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert spark.read.parquet(path).count() == 4


def test_jdbc_asks_for_a_parallel_read(spark):
    import pytest

    from mercadia.sources.readers import read_jdbc_table
    with pytest.raises(ValueError, match="numPartitions"):
        read_jdbc_table(spark, "t", {"url": "jdbc:x"})


def test_filters_reach_the_charts_of_their_scope(spark):
    import pytest

    from mercadia.plans import dashboards as db
    ds = spark.createDataFrame([("o1", "2017-01-01", "a", "delivered", "SP", 5), ("o2", "2017-02-01", "b", "shipped", "RJ", 7)],
                               "order_id string, order_month string, category string, order_status string, customer_state string, total_payment long")
    trend = lambda **f: sorted(tuple(r) for r in db.chart("revenue_trend", ds, **f).collect())
    assert trend(category=["a"], state=["SP"]) == [("2017-01-01", 5), ("2017-02-01", 7)]  # out of scope
    assert trend(status=["shipped"]) == [("2017-02-01", 7)]
    assert [tuple(r) for r in db.chart("orders_by_state", ds, status=["shipped"], state=["SP"]).collect()] == [("SP", 1)]
    with pytest.raises(ValueError):
        db.chart("revenue_trend", ds, city=["x"])
