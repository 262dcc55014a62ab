"""Skewed joins, ranks without a total order, distinct bitmaps, the chart cube."""

import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercadia.operators.distinct import bitmap_index, dense_numbers, distinct_bitmaps, distinct_counts, index_counts, roll_up
from mercadia.operators.ranking import cut_rows, integer_key, ntile_by_cuts, rank_by_bins, value_bins
from mercadia.operators.skew import PIECE, SkewedKey, heavy_keys, skew_chain
from mercadia.operators.windows import Key

SF = "/root/testdata/sf0.001"


def same(a, b):
    return Counter(map(tuple, a.collect())) == Counter(map(tuple, b.select(*a.columns).collect()))


# --- skewed joins

@pytest.fixture()
def chain(spark):
    """60,000 items of which one order holds a third, and its partners."""
    items = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("string").alias("order_id"), F.col("id").alias("item"))
    orders = spark.range(4000).select(F.col("id").cast("string").alias("order_id"), (F.col("id") % 5).alias("status"))
    payments = spark.range(6000).select((F.col("id") % 3000).cast("string").alias("order_id"), F.col("id").alias("payment"))
    return items, orders, payments


def test_heavy_keys_are_counted_exactly(spark, chain):
    items = chain[0]
    # the one order, and its own rows besides
    assert [tuple(r) for r in heavy_keys(items, "order_id", 0.01).collect()] == [("7", 20_000 + items.where("order_id = 7 AND item % 3 <> 0").count())]
    rnd = random.Random(3)
    values = [int(rnd.paretovariate(0.7)) for _ in range(40_000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5000, "k long").repartition(6)
    for share in (0.002, 0.02, 0.3):
        want = {k: n for k, n in Counter(values).items() if n >= share * 45_000}
        assert {r.k: r.rows for r in heavy_keys(df, "k", share).collect()} == want
    assert heavy_keys(df.where(F.lit(False)), "k").collect() == []
    with pytest.raises(ValueError):
        heavy_keys(df, "k", 0.0)


@pytest.fixture()
def sixteen(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # neither coalesced nor split: the plan's own partitions
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def rows_by_task(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_a_chain_with_a_heavy_order_is_dealt_evenly(spark, chain, sixteen):
    items, orders, payments = chain
    plain = (items.join(orders.hint("shuffle_merge"), "order_id").join(payments.hint("shuffle_merge"), "order_id", "left"))
    salted = skew_chain(items, [(orders, "inner"), (payments, "left")], "order_id", keep_piece=True)
    assert same(plain, salted.drop(PIECE))
    before, after = rows_by_task(plain), rows_by_task(salted)
    assert len(after) == 16 and after[-1] <= 2 * after[8] < before[-1]
    # one exchange for each input; the second join and a grouping on the same keys add none
    text = salted.groupBy("order_id", PIECE).count()._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 3, text


def test_a_chain_keeps_nulls_and_rows_without_partners(spark):
    big = spark.createDataFrame([(k, i) for i, k in enumerate(["a"] * 50 + ["b", None, "c", "c"])], "k string, i int")
    left = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3), (None, 4)], "k string, x int")
    for how in ("inner", "left"):
        assert same(skew_chain(big, [(left, how)], "k", tasks=4), big.join(left, "k", how))
    assert skew_chain(big.where("i < 0"), [(left, "left")], "k").collect() == []
    assert SkewedKey(big, "k", tasks=4).rows == {"a": 50}
    with pytest.raises(ValueError):
        skew_chain(big, [(left, "full")], "k")


# --- ranks

def values_of(spark, kind, n=3000):
    rnd = random.Random(kind)
    if kind == "ties":
        v = [rnd.choice([None, 5, 5, 5, 5, 7]) for _ in range(n)]
    elif kind == "wide":
        v = [rnd.choice([-1, 1]) * 10 ** rnd.randint(0, 14) + rnd.randint(0, 99) for _ in range(n)]
    elif kind == "nulls":
        v = [None] * n
    else:
        v = [rnd.randint(-50, 4000) for _ in range(n)]
    data = [(f"id{i * 7919 % n:05d}", None if x is None else Decimal(x) / 100, rnd.choice("xyz")) for i, x in enumerate(v)]
    return spark.createDataFrame(data, "id string, amount decimal(20,2), grp string").repartition(5)


def in_order(rows, key):
    """Rows (id, amount, grp, ..) in the order of the key, then the id."""
    first = (not key.descending) if key.nulls_first is None else key.nulls_first
    sign = -1 if key.descending else 1
    return sorted(rows, key=lambda r: ((r.amount is None) != first, 0 if r.amount is None else sign * r.amount, r.id))


@pytest.mark.parametrize(("kind", "key"), [("ties", Key("amount", True, True)), ("wide", Key("amount")), ("even", Key("amount", True, False)),
                                           ("nulls", Key("amount")), ("ties", Key("amount", False, False))])
def test_ntile_and_rank_without_order(spark, kind, key):
    df = values_of(spark, kind, 900).cache()
    rows = in_order(df.collect(), key)
    tile = {r.id: r.t for r in ntile_by_cuts(df, key, "id", 4, "t", few=30).collect()}
    assert tile == {r.id: i // 225 + 1 for i, r in enumerate(rows)}
    want, seen = {}, Counter()
    for i, r in enumerate(rows):
        tied = i and rows[i - 1].amount == r.amount
        whole = want[rows[i - 1].id][0] if tied else i + 1
        before = [x for x in rows[:i] if x.grp == r.grp]
        own = want[before[-1].id][1] if before and before[-1].amount == r.amount else seen[r.grp] + 1
        seen[r.grp] += 1
        want[r.id] = whole, own
    for per_bin in (None, 10):
        got = rank_by_bins(df, key, {"r": [], "g": ["grp"]}, "id", per_bin)
        assert {r.id: (r.r, r.g) for r in got.collect()} == want, per_bin


def test_ntile_of_few_rows_and_integer_ties(spark):
    df = spark.createDataFrame([(i, 1) for i in range(-3, 2)] + [(None, 1)], "id int, v int")
    for tiles, want in ((4, [1, 1, 2, 2, 3, 4]), (9, [1, 2, 3, 4, 5, 6])):
        got = {r.id: r.t for r in ntile_by_cuts(df, Key("v"), "id", tiles, "t", few=2).collect()}
        assert [got[k] for k in (None, -3, -2, -1, 0, 1)] == want
    none = df.where("v < 0")
    assert ntile_by_cuts(none, Key("v"), "id", 4, "t").collect() == [] == rank_by_bins(none, Key("v"), {"r": []}, "id").collect()
    assert cut_rows(df, Key("v"), "id", [1, 2, 6], few=1) == [(1, None), (1, -3), (1, 1)]
    with pytest.raises(ValueError):
        cut_rows(df, Key("v"), "id", [7])
    with pytest.raises(TypeError):
        integer_key(df.withColumn("d", F.lit(1.5)), Key("d"))


def test_bins_hold_few_rows_or_one_value(spark):
    rnd = random.Random(9)
    v = [rnd.randint(0, 10 ** 12) if i % 3 else 123_456 for i in range(9000)]
    df = spark.createDataFrame([(x,) for x in v], "u long")
    bins = value_bins(df, 100)
    own = bins.numbered(df, "u", "b").groupBy("b").agg(F.count("u").alias("n"), F.min("u").alias("lo"), F.max("u").alias("hi")).orderBy("b").collect()
    assert [r.n for r in own] == bins.rows and sum(bins.rows) == 9000
    assert all(r.n <= 100 or r.lo == r.hi == 123_456 for r in own) and all(a.hi < b.lo for a, b in zip(own, own[1:], strict=False))


def test_rank_plans_have_no_range_exchange(spark):
    df = values_of(spark, "even", 300)
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString()
    assert plan(ntile_by_cuts(df, Key("amount"), "id", 4, "t")).count("Exchange") == plan(df).count("Exchange")
    ranked = plan(rank_by_bins(df, Key("amount"), {"r": [], "g": ["grp"]}, "id"))
    assert "rangepartitioning" not in ranked and "hashpartitioning(_bin" in ranked


def test_marts_rank_without_a_range_exchange(spark):
    import __spark_entry__ as E
    for name in ("mart_customer_segments", "mart_product_performance"):
        df = E.queries()[name](spark, SF)
        assert "rangepartitioning" not in df._jdf.queryExecution().executedPlan().toString()


# --- distinct bitmaps

def test_bitmaps_roll_up_exactly(spark):
    rnd = random.Random(4)
    rows = [(f"o{rnd.randint(0, 70_000)}", rnd.randint(1, 24), rnd.choice("abc")) for _ in range(120_000)] + [(None, 1, "a")]
    df = spark.createDataFrame(rows, "id string, month int, cat string").repartition(7)
    numbers = dense_numbers(df, "id")
    n = numbers.agg(F.count("_number"), F.countDistinct("_number"), F.min("_number"), F.max("_number")).first()
    ids = len({r[0] for r in rows if r[0]})
    assert tuple(n) == (ids, ids, 0, ids - 1) and ids > 32_768
    numbered = df.join(numbers, "id", "left")
    fine = distinct_bitmaps(numbered, ["month", "cat"])
    for bitmaps, dims in ((fine, ["month", "cat"]), (fine, ["cat"]), (roll_up(fine, ["month"]), ["month"]), (roll_up(fine, ["cat"]), [])):
        want = df.groupBy(*dims).agg(F.countDistinct("id").alias("distinct_count"))
        assert same(distinct_counts(bitmaps, dims), want), dims


def test_an_index_counts_under_filters(spark):
    rnd = random.Random(5)
    rows = [(i % 900, rnd.choice(["a", "b", "c", None]), rnd.choice("xy")) for i in range(3000)]
    status = {i: rnd.choice(["ok", "late"]) for i in range(900)}
    df = spark.createDataFrame([(k, c, s, status[k]) for k, c, s in rows], "_number long, cat string, state string, status string")
    index = bitmap_index(df, {"cat": "cat", "state": "state", "status": "status"})
    for where in ({}, {"status": ["ok"]}, {"cat": ["a", "b"], "status": ["late"]}, {"state": ["x"], "cat": ["zz"]}):
        got = {r.value: r.distinct_count for r in index_counts(index, "cat", where).collect()}
        own: dict = {}
        for k in {k for k, _, _ in rows}:
            cats, states = ({r[j] for r in rows if r[0] == k} for j in (1, 2))
            if all({"status": {status[k]}, "cat": cats, "state": states}[d] & set(v) for d, v in where.items()):
                for c in cats:
                    if "cat" not in where or c in where["cat"]:
                        own[c] = own.get(c, 0) + 1
        assert got == own, where


# --- the chart cube

def test_cube_answers_as_the_dataset(spark):
    from mercadia.plans import dashboards as db
    from mercadia.plans.catalog import Ctx, _ds
    from mercadia.plans.cube import BY, ChartCube
    cube = ChartCube.build(_ds(Ctx(spark, SF)))
    bars = [{}, {"category": ["Promo"], "status": ["shipped", "delivered"]}, {"state": ["nation_1"], "date_range": ("1994-02-01", "1996-12-01")},
            {"category": ["none"]}, {"date_range": ("1994-02-01", "1994-02-20")}]
    for bar, names in zip(bars, [list(BY), ["top_categories", "late_rate"], ["orders_by_state", "revenue_trend"], ["late_rate"], ["payment_mix"]], strict=True):
        for name in names:
            got, want = cube.chart(name, **bar), db.chart(name, cube.dataset, **bar)
            assert got.columns == want.columns
            as_text = lambda df: sorted(str(tuple(r)) for r in df.collect())
            assert as_text(got) == as_text(want), (name, bar)
    assert not cube.answers(("1994-02-01", "1994-02-20")) and cube.answers(("1994-02-01", "1995-01-01"))
    # a filtered chart reads the summaries, not the dataset
    files = cube.chart("late_rate", category=["Promo"]).inputFiles()
    assert any("chart_index" in f for f in files) and not any("chart_dataset" in f for f in files)
    with pytest.raises(ValueError):
        cube.chart("late_rate", city=["x"])
