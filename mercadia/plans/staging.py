"""Staging models: rename, cast, row filter. Row-local, so each is a single
projection + filter fused into the scan stage (no shuffle), except
``stg_products``' lookup of the category translation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import blank_to_null, money, pg_initcap, round_to


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_id").isNotNull()).select(
        "order_id", "customer_id", "order_status",
        F.col("order_purchase_timestamp").alias("purchased_at"),
        F.col("order_approved_at").alias("approved_at"),
        F.col("order_delivered_carrier_date").alias("shipped_at"),
        F.col("order_delivered_customer_date").alias("delivered_at"),
        F.col("order_estimated_delivery_date").alias("estimated_delivery_at"))


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.where(F.col("customer_id").isNotNull()).select(
        "customer_id", "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_code"),
        pg_initcap("customer_city").alias("city"),
        F.upper("customer_state").alias("state"))


def stg_order_items(items: DataFrame) -> DataFrame:
    keep = F.col("order_id").isNotNull() & F.col("product_id").isNotNull() & F.col("price").isNotNull()
    return items.where(keep).select(
        "order_id", F.col("order_item_id").alias("item_sequence"), "product_id", "seller_id",
        F.col("shipping_limit_date").alias("shipping_deadline"),
        money("price").alias("item_price"),
        money("freight_value").alias("freight_cost"),
        money(F.col("price") + F.col("freight_value")).alias("total_item_cost"))


def stg_order_payments(payments: DataFrame) -> DataFrame:
    v = F.col("payment_value")
    return payments.where(F.col("order_id").isNotNull() & v.isNotNull() & (v >= 0)).select(
        "order_id", F.col("payment_sequential").alias("payment_seq"), "payment_type",
        F.col("payment_installments").alias("installments"),
        money("payment_value").alias("payment_amount"))


def stg_order_reviews(reviews: DataFrame, low_score: int = 2) -> DataFrame:
    s = F.col("review_score")
    return reviews.where(F.col("order_id").isNotNull() & s.isNotNull()).select(
        "review_id", "order_id", s.cast("int").alias("score"), (s <= low_score).alias("is_low_score"),
        blank_to_null("review_comment_title").alias("review_title"),
        blank_to_null("review_comment_message").alias("review_message"),
        F.col("review_creation_date").alias("created_at"),
        F.col("review_answer_timestamp").alias("answered_at"))


def stg_products(products: DataFrame, translation: DataFrame, fallback: str = "uncategorized") -> DataFrame:
    # The translation is a catalogue of category names; the planner broadcasts it
    # by its measured size and falls back to a shuffle join if it ever is not small.
    p = products.where(F.col("product_id").isNotNull()).alias("p")
    t = translation.alias("t")
    joined = p.join(t, F.col("p.product_category_name") == F.col("t.product_category_name"), "left")
    return joined.select(
        F.col("p.product_id").alias("product_id"),
        F.coalesce(F.col("t.product_category_name_english"), F.lit(fallback)).alias("category_name_en"),
        F.col("p.product_category_name").alias("category_name_pt"),
        F.col("p.product_name_lenght").alias("product_name_length"),
        F.col("p.product_description_lenght").alias("description_length"),
        F.col("p.product_photos_qty").alias("photos_count"),
        round_to("p.product_weight_g", 0).alias("weight_grams"),
        round_to("p.product_length_cm", 1).alias("length_cm"),
        round_to("p.product_height_cm", 1).alias("height_cm"),
        round_to("p.product_width_cm", 1).alias("width_cm"))


def stage_all(src: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_orders": stg_orders(src["orders"]),
        "stg_customers": stg_customers(src["customers"]),
        "stg_order_items": stg_order_items(src["order_items"]),
        "stg_order_payments": stg_order_payments(src["order_payments"]),
        "stg_order_reviews": stg_order_reviews(src["order_reviews"]),
        "stg_products": stg_products(src["products"], src["product_category_name_translation"]),
    }
