"""Explicit schemas of the nine marketplace source tables.

Types are declared rather than inferred: identifiers and ZIP prefixes are
strings (leading zeros survive), lifecycle instants are zone-less timestamps,
money arrives as double and becomes decimal(18,2) in staging.
"""

from pyspark.sql import types as T

S, I, D, TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType()


def _schema(*cols):
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "orders": _schema(
        ("order_id", S), ("customer_id", S), ("order_status", S),
        ("order_purchase_timestamp", TS), ("order_approved_at", TS),
        ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
        ("order_estimated_delivery_date", TS)),
    "order_items": _schema(
        ("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
        ("shipping_limit_date", TS), ("price", D), ("freight_value", D)),
    "order_payments": _schema(
        ("order_id", S), ("payment_sequential", I), ("payment_type", S),
        ("payment_installments", I), ("payment_value", D)),
    "order_reviews": _schema(
        ("review_id", S), ("order_id", S), ("review_score", I), ("review_comment_title", S),
        ("review_comment_message", S), ("review_creation_date", TS), ("review_answer_timestamp", TS)),
    "customers": _schema(
        ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
        ("customer_city", S), ("customer_state", S)),
    "products": _schema(
        ("product_id", S), ("product_category_name", S), ("product_name_lenght", I),
        ("product_description_lenght", I), ("product_photos_qty", I), ("product_weight_g", D),
        ("product_length_cm", D), ("product_height_cm", D), ("product_width_cm", D)),
    "sellers": _schema(
        ("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S)),
    "geolocation": _schema(
        ("geolocation_zip_code_prefix", S), ("geolocation_lat", D), ("geolocation_lng", D),
        ("geolocation_city", S), ("geolocation_state", S)),
    "product_category_name_translation": _schema(
        ("product_category_name", S), ("product_category_name_english", S)),
}

# Load order used by row counts (fixed values).
SOURCE_TABLES = ["orders", "order_items", "order_payments", "order_reviews", "customers",
                 "products", "sellers", "geolocation", "product_category_name_translation"]
