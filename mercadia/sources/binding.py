"""Binding of the generated star-schema test tables onto the marketplace sources.

The test data (orders, lineitem, customer, nation, part, supplier) has none of
the marketplace's payments, reviews, delivery instants or translations, so each
source table is derived from it by a fixed, deterministic rule. Every rule is a
row-local projection or a bounded explode, except the customer/nation lookups,
so binding adds no shuffle beyond one join of orders with customers.

The same rules exist once more as DuckDB SQL in ``oracle.sql``; integer
arithmetic only, so both engines produce identical values.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import SOURCE_SCHEMAS

# Fixed values of the binding (see FIXTURES.md §3).
STATUS_BY_CODE = {"F": "delivered", "O": "shipped", "P": "processing"}
PAYMENT_TYPE_BY_RESIDUE = ["boleto", "credit_card", "credit_card", "voucher", "debit_card"]
TRANSLATED = [("standard", "Standard"), ("promo", "Promo"), ("small", "Small"),
              ("large", "Large"), ("economy", "Economy")]  # 'medium' left untranslated on purpose


def _plus_seconds(ts: Column, secs: Column) -> Column:
    return F.timestamp_add("SECOND", secs, ts)


def _plus_days(ts: Column, days: Column) -> Column:
    return F.timestamp_add("DAY", days, ts)


def _sid(c: Column) -> Column:
    return c.cast("string")


def _conform(df: DataFrame, table: str) -> DataFrame:
    schema = SOURCE_SCHEMAS[table]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def bind_orders(orders: DataFrame) -> DataFrame:
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    sec_of_day = (k * 7919) % 86400
    code_status = F.lit(None).cast("string")
    for code, status in STATUS_BY_CODE.items():
        code_status = F.when(F.col("o_orderstatus") == code, status).otherwise(code_status)
    status = (F.when(k % 29 == 0, "canceled").when(k % 31 == 0, "unavailable")
              .when(k % 37 == 0, F.lit(None).cast("string")).otherwise(code_status))
    purchased = F.when(k % 97 != 0, _plus_seconds(day, sec_of_day))
    undelivered = k % 11 == 0
    return _conform(orders.select(
        _sid(k).alias("order_id"),
        _sid(k).alias("customer_id"),
        status.alias("order_status"),
        purchased.alias("order_purchase_timestamp"),
        F.when(k % 97 != 0, _plus_seconds(day, sec_of_day + (k * 13) % 7200)).alias("order_approved_at"),
        F.when(~undelivered, _plus_seconds(day, 86400 + sec_of_day)).alias("order_delivered_carrier_date"),
        F.when(~undelivered, _plus_seconds(day, ((k * 31) % 24 + 2) * 86400 + sec_of_day))
         .alias("order_delivered_customer_date"),
        _plus_days(day, (k * 17) % 20 + 10).alias("order_estimated_delivery_date"),
    ), "orders")


def bind_customers(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """One customer row per order: the person is ``custkey*8 + orderkey%8``."""
    o = orders.select("o_orderkey", "o_custkey")
    c = customer.select(F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment"))
    # nation is the fixed 25-row dimension; the planner broadcasts it by its measured size
    n = nation.select("n_nationkey", "n_name")
    k = F.col("o_orderkey")
    joined = (o.join(c, o.o_custkey == c.c_custkey, "left")
              .join(n, (F.col("c_nationkey") + k % 3) % 25 == F.col("n_nationkey"), "left"))
    return _conform(joined.select(
        _sid(k).alias("customer_id"),
        _sid(F.col("o_custkey") * 8 + k % 8).alias("customer_unique_id"),
        F.lpad(_sid(F.col("o_custkey") % 100000), 5, "0").alias("customer_zip_code_prefix"),
        F.concat(F.lit("vila-"), F.lower("c_mktsegment"), F.lit(" d'oeste")).alias("customer_city"),
        F.lower("n_name").alias("customer_state"),
    ), "customers")


def bind_order_items(lineitem: DataFrame) -> DataFrame:
    return _conform(lineitem.select(
        _sid(F.col("l_orderkey")).alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _sid(F.col("l_partkey")).alias("product_id"),
        _sid(F.col("l_suppkey")).alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("freight_value"),
    ), "order_items")


def bind_order_payments(orders: DataFrame) -> DataFrame:
    """1..3 payments per order splitting the order total in integer cents."""
    k = F.col("o_orderkey")
    n = 1 + k % 3
    seq = F.col("seq")
    exploded = orders.select(
        k, F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        n.alias("n"), F.explode(F.sequence(F.lit(1).cast("bigint"), n)).alias("seq"))
    # weight 1 for the first payment, 2 for the others, over 2n-1 shares; floor in cents
    value_cents = F.expr("(cents * IF(seq = 1, 1, 2)) div (2 * n - 1)")
    type_expr = F.lit(None).cast("string")
    for residue, name in enumerate(PAYMENT_TYPE_BY_RESIDUE):
        type_expr = F.when((k + seq) % 5 == residue, name).otherwise(type_expr)
    return _conform(exploded.select(
        _sid(k).alias("order_id"),
        seq.alias("payment_sequential"),
        type_expr.alias("payment_type"),
        (1 + (k + seq) % 12).alias("payment_installments"),
        (value_cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).alias("payment_value"),
    ), "order_payments")


def bind_order_reviews(orders: DataFrame) -> DataFrame:
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    n = (k % 4).cast("int")
    ex = orders.select(k, day, F.explode(F.when(n > 0, F.sequence(F.lit(1), n))).alias("seq"))
    seq = F.col("seq")

    def text(residue: Column, body: Column) -> Column:
        return (F.when(residue == 0, body).when(residue == 1, F.lit(""))
                .when(residue == 2, F.lit("  ")).otherwise(F.lit(None).cast("string")))

    created = _plus_days(day, seq)
    return _conform(ex.select(
        F.concat(F.lit("r"), _sid(k), F.lit("-"), _sid(seq)).alias("review_id"),
        _sid(k).alias("order_id"),
        (1 + (k * 7 + seq * 3) % 5).alias("review_score"),
        text((k + seq) % 4, F.concat(F.lit(" Title "), _sid(k))).alias("review_comment_title"),
        text((k + seq + 1) % 4, F.concat(F.lit("Message for order "), _sid(k), F.lit(" ")))
         .alias("review_comment_message"),
        created.alias("review_creation_date"),
        _plus_seconds(created, (k * 13) % 86400).alias("review_answer_timestamp"),
    ), "order_reviews")


def bind_products(part: DataFrame) -> DataFrame:
    p = F.col("p_partkey")
    return _conform(part.select(
        _sid(p).alias("product_id"),
        F.when(p % 41 != 0, F.lower("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.when(p % 7 != 0, F.col("p_size") * 10).alias("product_description_lenght"),
        (F.col("p_size") % 5 + 1).alias("product_photos_qty"),
        F.col("p_retailprice").alias("product_weight_g"),
        (F.col("p_size") * 1.5).alias("product_length_cm"),
        (F.col("p_size") + 0.25).alias("product_height_cm"),
        (F.col("p_retailprice") / 100).alias("product_width_cm"),
    ), "products")


def bind_translation(spark: SparkSession) -> DataFrame:
    """A local relation (planned in the JVM, with exact size statistics)."""
    rows = ", ".join("('{}', '{}')".format(pt, en) for pt, en in TRANSLATED)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(product_category_name, product_category_name_english)")


def bind_sellers(supplier: DataFrame) -> DataFrame:
    s = F.col("s_suppkey")
    return _conform(supplier.select(
        _sid(s).alias("seller_id"),
        F.lpad(_sid(s % 100000), 5, "0").alias("seller_zip_code_prefix"),
        F.lower("s_name").alias("seller_city"),
        _sid(F.col("s_nationkey")).alias("seller_state"),
    ), "sellers")


def bind_geolocation(customer: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    return _conform(customer.select(
        F.lpad(_sid(c % 100000), 5, "0").alias("geolocation_zip_code_prefix"),
        (F.col("c_acctbal") / 100).alias("geolocation_lat"),
        (-F.col("c_acctbal") / 100).alias("geolocation_lng"),
        F.lower("c_mktsegment").alias("geolocation_city"),
        _sid(F.col("c_nationkey")).alias("geolocation_state"),
    ), "geolocation")


# Each source table and the test tables it is bound from.
BINDINGS = {
    "orders": (bind_orders, ["orders"]),
    "order_items": (bind_order_items, ["lineitem"]),
    "order_payments": (bind_order_payments, ["orders"]),
    "order_reviews": (bind_order_reviews, ["orders"]),
    "customers": (bind_customers, ["orders", "customer", "nation"]),
    "products": (bind_products, ["part"]),
    "sellers": (bind_sellers, ["supplier"]),
    "geolocation": (bind_geolocation, ["customer"]),
}


class BoundTables(Mapping):
    """The marketplace source tables over test tables, each bound when it is first asked for;
    test tables are opened once, and only those that a query needs."""

    def __init__(self, spark: SparkSession, open_table: Callable[[str], DataFrame]):
        self._spark, self._open = spark, functools.cache(open_table)
        self._bound: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._bound:
            if name == "product_category_name_translation":
                self._bound[name] = bind_translation(self._spark)
            else:
                bind, tables = BINDINGS[name]
                self._bound[name] = bind(*map(self._open, tables))
        return self._bound[name]

    def __iter__(self):
        return iter([*BINDINGS, "product_category_name_translation"])

    def __len__(self) -> int:
        return len(BINDINGS) + 1


def bind_sources(spark: SparkSession, t: dict[str, DataFrame]) -> Mapping[str, DataFrame]:
    """Marketplace source tables from the test tables (keys as in ``SOURCE_TABLES``)."""
    return BoundTables(spark, t.__getitem__)


def load_bound_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The marketplace source tables over the test parquet tables under ``sf_dir``."""
    return BoundTables(spark, lambda name: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))
