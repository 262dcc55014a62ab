"""Differential and invariant tests for the reusable operators."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercadia.operators import grouping as gr
from mercadia.operators import quality as dq
from mercadia.operators.windows import Key, global_window, pareto


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    # one category and one value each hold well over a third of the rows
    rows = [(i, rnd.choice(["hot"] * 5 + ["b", "c"]), rnd.choice([7] * 6 + [1, 2, None, 3]), float(rnd.randint(-5, 9)))
            for i in range(4000)]
    return spark.createDataFrame(rows, "id long, cat string, v int, m double")


@pytest.mark.parametrize("part", [None, ["cat"]])
@pytest.mark.parametrize("nulls_first", [True, False])
@pytest.mark.parametrize("n", [1, 5, 16])
def test_global_window_equals_plain_window(spark, skewed, part, nulls_first, n):
    key = Key("v", True, nulls_first)
    out = global_window(skewed, [key], ["id"], partition_by=part, rank="rk", row_number="rn",
                        ntile=None if part else ("nt", 4), running={"m": "run"}, num_partitions=n)
    w = Window.orderBy(key.sort())
    w2 = Window.orderBy(key.sort(), F.col("id"))
    if part:
        w, w2 = w.partitionBy(*part), w2.partitionBy(*part)
    ref = (skewed.withColumn("rk", F.rank().over(w)).withColumn("rn", F.row_number().over(w2))
           .withColumn("run", F.sum("m").over(w2.rowsBetween(Window.unboundedPreceding, 0))))
    cols = ["id", "rk", "rn", "run"]
    if not part:
        ref = ref.withColumn("nt", F.ntile(4).over(w2))
        cols.append("nt")
    assert out.select(*cols).exceptAll(ref.select(*cols)).count() == 0
    assert out.count() == skewed.count()


def test_global_window_moves_only_the_range_summary_through_one_task(spark, skewed):
    out = global_window(skewed, [Key("v", True)], ["id"], rank="rk")
    out.count()
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    singles = [i for i, ln in enumerate(lines) if "Exchange SinglePartition" in ln]
    # the only single-task step is the window over the per-range summary (one row per range)
    assert singles and all("key=[_pid" in lines[i + 1] for i in singles)


def test_top_row_per_key_limits_each_task(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 3, "w"), ("a", 1, "z"), ("b", None, "q"), ("b", 2, "r")],
                               "k string, n int, s string")
    agg = gr.top_row_per_key(df, ["k"], [Key("n", True), Key("s")])
    win = gr.top_row_per_key(df, ["k"], [Key("s", True)])
    assert sorted(map(tuple, agg.collect())) == [("a", 3, "w"), ("b", 2, "r")]
    assert sorted(map(tuple, win.collect())) == [("a", 1, "z"), ("b", 2, "r")]
    assert "WindowGroupLimit" in agg._jdf.queryExecution().executedPlan().toString()
    least = spark.createDataFrame([("a", -(1 << 31), "x"), ("a", 5, "y")], "k string, n int, s string")
    assert [tuple(r) for r in gr.top_row_per_key(least, ["k"], [Key("n", True)]).collect()] == [("a", 5, "y")]


def test_cohort_retention_counts_exact_months(spark):
    from datetime import datetime as dt
    df = spark.createDataFrame([("p1", dt(2017, 1, 5)), ("p1", dt(2017, 2, 1)), ("p1", dt(2017, 4, 9)),
                                ("p2", dt(2017, 1, 30)), ("p2", dt(2017, 3, 1)), ("p3", dt(2017, 2, 2))],
                               "p string, ts timestamp_ntz")
    got = {r.cohort_month.isoformat(): tuple(r)[1:] for r in gr.cohort_retention(df, "p", "ts").collect()}
    assert got == {"2017-01-01": (2, 1, 1, 1), "2017-02-01": (1, 0, 0, 0)}


def test_pareto_ends_at_100(spark):
    df = spark.createDataFrame([(k, float(v)) for k, v in zip("abcde", [5, 1, 3, 3, 8])], "k string, m double")
    out = pareto(df, "k", "m").orderBy(F.col("cumulative_pct")).collect()
    assert float(out[-1].cumulative_pct) == 100.0
    assert [r.k for r in out] == ["e", "a", "c", "d", "b"]


def test_filter_sum_is_null_without_matches(spark):
    df = spark.createDataFrame([(1, "boleto", 5.0), (1, None, 2.0), (2, "voucher", 1.0)], "g int, t string, v double")
    out = {r.g: r for r in df.groupBy("g").agg(*gr.filter_sum("v", "t", {"cc": "credit_card", "b": "boleto",
                                                                        "o": ["credit_card", "boleto"]})).collect()}
    assert out[1].cc is None and out[1].b == 5.0 and out[1].o is None
    assert out[2].o == 1.0


def test_quality_checks(spark):
    df = spark.createDataFrame([("1", 1, "x"), ("1", 1, "y"), ("2", 9, None), (None, 2, "z")], "k string, s int, t string")
    assert [tuple(r) for r in dq.dq_unique_grain(df, ["k", "s"]).collect()] == [("1", 1, 2)]
    nn = {r.column: r.null_rows for r in dq.dq_not_null(df, ["k", "t"], "t1").collect()}
    assert nn == {"k": 1, "t": 1}
    assert dq.dq_accepted_values(df, "t", ["x", "y"]).count() == 1
    assert [r.s for r in dq.dq_range(df, "s", 1, 5).collect()] == [9]
    parent = spark.createDataFrame([("1",)], "k string")
    assert sorted(r.k for r in dq.dq_relationship(df, parent, "k").collect()) == ["2"]


def test_recommended_conf_scales_with_input():
    from mercadia.session import recommended_conf
    assert recommended_conf(10 << 30)["spark.sql.shuffle.partitions"] == "200"          # floor
    assert recommended_conf(100 << 40)["spark.sql.shuffle.partitions"] == str(100 << 12)  # 100 TiB / 256 MiB, no cap
    assert recommended_conf(1 << 40)["spark.sql.shuffle.partitions"] == "4096"          # 1 TB / 256 MB


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(-3, 3)),
                           st.one_of(st.none(), st.integers(-5, 5))), min_size=0, max_size=120)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=_rows, n=st.integers(1, 9), partitioned=st.booleans(), desc=st.booleans(), nulls_first=st.booleans())
def test_global_window_property(spark, rows, n, partitioned, desc, nulls_first):
    df = spark.createDataFrame([(i, g, v, m) for i, (g, v, m) in enumerate(rows)], "id long, g string, v int, m int")
    key = Key("v", desc, nulls_first)
    part = ["g"] if partitioned else None
    out = global_window(df, [key], ["id"], partition_by=part, rank="rk", row_number="rn",
                        ntile=None if partitioned else ("nt", 3), running={"m": "run"},
                        group_sum={"m": "tot"}, num_partitions=n)
    w = Window.orderBy(key.sort())
    w2 = Window.orderBy(key.sort(), F.col("id"))
    wall = Window.partitionBy(*(part or []))
    if part:
        w, w2 = w.partitionBy(*part), w2.partitionBy(*part)
    ref = (df.withColumn("rk", F.rank().over(w)).withColumn("rn", F.row_number().over(w2))
             .withColumn("run", F.sum("m").over(w2.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("tot", F.sum("m").over(wall)))
    cols = ["id", "rk", "rn", "run", "tot"]
    if not part:
        ref = ref.withColumn("nt", F.ntile(3).over(w2))
        cols.append("nt")
    got = sorted(tuple(r) for r in out.select(*cols).collect())
    exp = sorted(tuple(r) for r in ref.select(*cols).collect())
    assert got == exp


_kv = st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.one_of(st.none(), st.integers(-2, 2)),
                         st.one_of(st.none(), st.sampled_from(["x", "y", "z"])), st.integers(0, 10**6)),
               min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=_kv, desc=st.booleans(), nf=st.booleans())
def test_top_row_per_key_property(spark, rows, desc, nf):
    df = spark.createDataFrame(rows, "k string, n int, s string, id long")
    order = [Key("n", desc, nf), Key("s", False, False), Key("id")]
    got = sorted(tuple(r) for r in gr.top_row_per_key(df, ["k"], order).collect())
    w = Window.partitionBy("k").orderBy(*[x.sort() for x in order])
    exp = sorted(tuple(r) for r in df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r").collect())
    assert got == exp


def test_global_window_with_null_measures(spark):
    from mercadia.operators.windows import global_window
    rows = [(i, "ab"[i % 2], None if i % 5 == 0 or i < 6 else i % 7) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, g string, m long")
    got = global_window(df, [Key("m", False, True)], ["id"], partition_by=["g"], running={"m": "run"}, group_sum={"m": "whole"}, num_partitions=4)
    w = Window.partitionBy("g").orderBy(F.col("m").asc_nulls_first(), "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("run", F.sum("m").over(w)).withColumn("whole", F.sum("m").over(Window.partitionBy("g")))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    none = global_window(df.withColumn("m", F.lit(None).cast("long")), [Key("id")], [], group_sum={"m": "whole"}, num_partitions=3)
    assert {r.whole for r in none.collect()} == {None}


def test_small_measures_keep_their_digits(spark):
    from mercadia.functions.exprs import exact, ratio, safe_pct, times
    r = spark.range(1).select(safe_pct(F.lit(0.001), F.lit(0.004)).alias("a"), safe_pct(F.lit(0.0049), F.lit(0.01)).alias("b"),
                              ratio(F.lit(1), F.lit(0), 2).alias("c"), times(exact(F.lit(1.004)), F.lit(1000)).alias("d")).first()
    assert (float(r.a), float(r.b), r.c, float(r.d)) == (25.0, 49.0, None, 1004.0)


def test_cohorts_leave_out_null_people(spark):
    from datetime import datetime as dt
    df = spark.createDataFrame([(None, dt(2017, 1, 5)), (None, dt(2017, 2, 5)), ("p", dt(2017, 1, 30))], "p string, ts timestamp_ntz")
    assert [tuple(r)[1:] for r in gr.cohort_retention(df, "p", "ts").collect()] == [(1, 0, 0, 0)]
