"""Incremental refresh of the order model and the monthly mart, by month.

The order model is kept as one Parquet folder for each purchase month. A refresh first takes a
fingerprint of each month's inputs: every source row that bears on an order is
hashed, hashes are added up by order (tasks add up their own first), then by the month of the
order. Only months whose fingerprint differs from that of the last refresh are built and
overwritten (dynamic partition overwrite); months without orders are dropped. Their rows
of the monthly base follow, and the mart's windows run over the few rows of that.

A month's mark is taken away before its data is touched and set again once it is written. A
refresh that was cut short leaves months without a mark, and the next one does them again.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.versions import _fs, current_version, read_current, replace_version
from . import staging as stg
from .intermediate import int_orders_enriched
from .marts import monthly_base, monthly_windows

#: The partition of orders without a purchase time.
NO_MONTH = "none"
MONTH = "purchase_month"
#: Input rows of the changed months up to which the ids of their orders are broadcast; more are shuffled.
BROADCAST_ROWS = 4_000_000


def _month_of(ts) -> F.Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM"), F.lit(NO_MONTH))


def _hashed(df: DataFrame, source: str, order: F.Column) -> DataFrame:
    """``order_id, high, low``: each row's hash, in two halves that add up as longs without overflow."""
    return (df.select(order.alias("order_id"), F.xxhash64(F.lit(source), *df.columns).alias("h"))
            .select("order_id", F.shiftright("h", 32).alias("high"), F.col("h").bitwiseAND(0xFFFFFFFF).alias("low")))


def _added_up(hashed: DataFrame, key: str, out: str, n: str) -> DataFrame:
    """``key, out, n``: the sum of the hashes of each key's rows (a key has less than 2**31), and their number."""
    sums = hashed.groupBy(key).agg(F.sum("high").alias("high"), F.sum("low").alias("low"), F.count(F.lit(1)).alias(n))
    whole = F.col("high").cast("decimal(19,0)") * F.lit(Decimal(1 << 32)) + F.col("low").cast("decimal(19,0)")
    return sums.select(key, whole.cast("decimal(38,0)").alias(out), n)


def fingerprints(src: dict[str, DataFrame]) -> DataFrame:
    """``purchase_month, input_rows, fingerprint`` of the sources of the order model."""
    o, c = src["orders"], src["customers"]
    months = o.where("order_id IS NOT NULL").select("order_id", "customer_id", _month_of("order_purchase_timestamp").alias(MONTH))
    by_customer = _hashed(c, "customers", F.col("customer_id")).withColumnRenamed("order_id", "customer_id")
    rows = [_hashed(src[t], t, F.col("order_id")) for t in ("orders", "order_items", "order_payments", "order_reviews")]
    per_order = _added_up(reduce(DataFrame.unionByName, rows), "order_id", "h", "n")
    per_customer = _added_up(by_customer, "customer_id", "hc", "nc")
    joined = months.join(per_order, "order_id").join(per_customer, "customer_id", "left")
    total = F.sum(F.col("h") + F.coalesce("hc", F.lit(0)))
    return joined.groupBy(MONTH).agg(F.sum(F.col("n") + F.coalesce("nc", F.lit(0))).alias("input_rows"), total.cast("string").alias("fingerprint"))


def _models_of(src: dict[str, DataFrame], months: list[str], now: dict[str, tuple[int, str]]) -> DataFrame:
    """``int_orders_enriched`` of the orders of some months, with their month. ``now`` has the
    input rows of each month: an order has one at least, so they bound the orders."""
    orders = src["orders"].where(_month_of("order_purchase_timestamp").isin(months))
    rows = sum(now[m][0] for m in months)
    if 2 * rows > sum(n for n, _ in now.values()):
        of = src.__getitem__  # most of the rows are needed: sums by order are joined to the orders anyway
    else:
        ids = orders.select("order_id").distinct()
        of = lambda t: src[t].join(F.broadcast(ids) if rows <= BROADCAST_ROWS else ids, "order_id", "left_semi")
    oe = int_orders_enriched(stg.stg_orders(orders), stg.stg_customers(src["customers"]), stg.stg_order_items(of("order_items")),
                             stg.stg_order_payments(of("order_payments")), stg.stg_order_reviews(of("order_reviews")))
    return oe.withColumn(MONTH, _month_of("purchased_at"))


def _overwrite_months(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def _drop_months(spark: SparkSession, path: str, months: list[str]) -> None:
    for m in months:
        fs, folder = _fs(spark, f"{path}/{MONTH}={m}")
        fs.delete(folder, True)


def refresh_models(src: dict[str, DataFrame], root: str) -> list[str]:
    """Bring ``root/int_orders_enriched`` and ``root/monthly_base`` up to date with the sources;
    the months that were built or dropped (text, bounded by the calendar)."""
    spark = src["orders"].sparkSession
    root = root.rstrip("/")
    orders_path, base_path, marks = f"{root}/int_orders_enriched", f"{root}/monthly_base", f"{root}/fingerprints"
    now = {r[MONTH]: (r["input_rows"], r["fingerprint"]) for r in fingerprints(src).collect()}
    done = {}
    if current_version(spark, marks) is not None:
        done = {r[MONTH]: (r["input_rows"], r["fingerprint"]) for r in read_current(spark, marks).collect()}
    changed = sorted(m for m in now if now[m] != done.get(m))
    gone = sorted(done.keys() - now.keys())
    if done.keys() & {*changed, *gone}:
        _mark({m: v for m, v in done.items() if m not in changed and m not in gone}, spark, marks)
    if changed:
        # A month may have no row left to write (no order with a customer); its old rows go first.
        _drop_months(spark, orders_path, changed)
        _drop_months(spark, base_path, changed)
        files = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // len(changed))  # of each month
        _overwrite_months(_models_of(src, changed, now).repartition(MONTH, F.pmod(F.xxhash64("order_id"), F.lit(files))), orders_path)
        built = read_orders(spark, root).where(F.col(MONTH).isin(changed))
        _overwrite_months(monthly_base(built).withColumn(MONTH, _month_of("month")), base_path)
    _drop_months(spark, orders_path, gone)
    _drop_months(spark, base_path, gone)
    if changed or gone:
        _mark(now, spark, marks)
    return changed + gone


def _mark(months: dict[str, tuple[int, str]], spark: SparkSession, marks: str) -> None:
    rows = [(m, n, f) for m, (n, f) in sorted(months.items())]
    replace_version(spark.createDataFrame(rows, f"{MONTH} string, input_rows long, fingerprint string"), marks)


def read_orders(spark: SparkSession, root: str) -> DataFrame:
    """The order model with its month."""
    return spark.read.option("inferSchema", "false").parquet(f"{root.rstrip('/')}/int_orders_enriched").withColumn(MONTH, F.col(MONTH).cast("string"))


def read_monthly_mart(spark: SparkSession, root: str) -> DataFrame:
    """``mart_monthly_revenue`` from the monthly base."""
    return monthly_windows(spark.read.parquet(f"{root.rstrip('/')}/monthly_base").drop(MONTH))
