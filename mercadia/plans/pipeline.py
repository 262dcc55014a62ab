"""Model graph: staging → intermediate → mart, run in dependency order.

Staging and intermediate models are views (lazy plans). ``int_orders_enriched``
feeds six consumers, so it is written once (a table in the shared warehouse
or a path under ``materialise_root``) and read back; that also cuts the
lineage of everything downstream. Marts are fully refreshed tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.gate import Gate, accepted, in_range, not_null, publish_gated
from ..sources.readers import publish
from ..sources.schemas import SOURCE_TABLES
from . import intermediate as im
from . import marts as mt
from . import staging as stg

# (name, layer, materialisation, upstream models) in dependency order
MODEL_GRAPH = [
    ("stg_orders", "staging", "view", ["orders"]),
    ("stg_customers", "staging", "view", ["customers"]),
    ("stg_order_items", "staging", "view", ["order_items"]),
    ("stg_order_payments", "staging", "view", ["order_payments"]),
    ("stg_order_reviews", "staging", "view", ["order_reviews"]),
    ("stg_products", "staging", "view", ["products", "product_category_name_translation"]),
    ("int_orders_enriched", "intermediate", "table",
     ["stg_orders", "stg_customers", "stg_order_items", "stg_order_payments", "stg_order_reviews"]),
    ("int_customer_metrics", "intermediate", "view", ["int_orders_enriched"]),
    ("int_seller_metrics", "intermediate", "view", ["stg_order_items", "stg_products", "int_orders_enriched"]),
    ("mart_monthly_revenue", "mart", "table", ["int_orders_enriched"]),
    ("mart_customer_segments", "mart", "table", ["int_customer_metrics"]),
    ("mart_product_performance", "mart", "table", ["stg_order_items", "stg_products", "int_orders_enriched"]),
]


# fixed rules of the published models: codes, ranges, keys
SEGMENTS = ["new", "returning", "at_risk", "churned"]
MODEL_GATES = {
    "int_orders_enriched": Gate((not_null("order_id"), not_null("customer_unique_id"), in_range("total_payment", 0), in_range("avg_review_score", 1, 5)),
                                ("order_id",), 1),
    "mart_monthly_revenue": Gate((not_null("month"), in_range("total_orders", 1), in_range("late_delivery_rate_pct", 0, 100)), ("month",), 1),
    "mart_customer_segments": Gate((not_null("customer_unique_id"), accepted("customer_segment", SEGMENTS), in_range("spend_quartile", 1, 4)),
                                   ("customer_unique_id",), 1),
    "mart_product_performance": Gate((not_null("product_id"), not_null("category"), in_range("revenue_rank", 1)), ("product_id",), 1),
}


class _LazyModels(dict):
    """Model name → DataFrame, each built on first access (building a mart with
    a distributed window runs a checkpoint job, so only what is used is built)."""

    def __init__(self, builders):
        super().__init__()
        self._builders = builders

    def __missing__(self, name):
        df = self._builders[name](self)
        self[name] = df
        return df

    def names(self):
        return list(self._builders)


def build_models(src: dict[str, DataFrame], enriched: DataFrame | None = None) -> dict[str, DataFrame]:
    """All twelve models as lazily built DataFrames (nothing is written).

    ``enriched`` replaces ``int_orders_enriched`` with an already materialised
    copy (a DataFrame, or a zero-argument callable producing one on first use)."""
    builders = {
        "stg_orders": lambda m: stg.stg_orders(src["orders"]),
        "stg_customers": lambda m: stg.stg_customers(src["customers"]),
        "stg_order_items": lambda m: stg.stg_order_items(src["order_items"]),
        "stg_order_payments": lambda m: stg.stg_order_payments(src["order_payments"]),
        "stg_order_reviews": lambda m: stg.stg_order_reviews(src["order_reviews"]),
        "stg_products": lambda m: stg.stg_products(src["products"], src["product_category_name_translation"]),
    }
    builders.update({
        "int_orders_enriched": (lambda m: enriched() if callable(enriched) else enriched) if enriched is not None
        else (lambda m: im.int_orders_enriched(
            m["stg_orders"], m["stg_customers"], m["stg_order_items"], m["stg_order_payments"],
            m["stg_order_reviews"])),
        "int_customer_metrics": lambda m: im.int_customer_metrics(m["int_orders_enriched"]),
        "int_seller_metrics": lambda m: im.int_seller_metrics(m["stg_order_items"], m["stg_products"],
                                                              m["int_orders_enriched"]),
        "mart_monthly_revenue": lambda m: mt.mart_monthly_revenue(m["int_orders_enriched"]),
        "mart_customer_segments": lambda m: mt.mart_customer_segments(m["int_customer_metrics"]),
        "mart_product_performance": lambda m: mt.mart_product_performance(m["stg_order_items"], m["stg_products"],
                                                                          m["int_orders_enriched"]),
    })
    return _LazyModels(builders)


def run_pipeline(src: dict[str, DataFrame], materialise_root: str | None = None,
                 select: list[str] | None = None, gates: dict[str, Gate] | None = None) -> dict[str, DataFrame]:
    """Run the graph in order, publishing each model as its layer says.

    Tables go to ``materialise_root/<name>`` when given, else to the session's
    warehouse. ``select`` limits the run to these models and their upstreams. With
    ``gates`` (``MODEL_GATES``, for the stated rules) tables are versioned folders under
    ``materialise_root``; a model that breaks a rule is not published and ends
    the run (``RuleBroken``), so nothing downstream of it is built.
    """
    if gates and not materialise_root:
        raise ValueError("gated tables are versioned folders: they need a materialise_root")
    wanted = _closure(select) if select else {n for n, *_ in MODEL_GRAPH}
    built: dict[str, DataFrame] = {}
    models = build_models(src)
    for name, _layer, kind, _deps in MODEL_GRAPH:
        if name not in wanted:
            continue
        df = models[name]
        path = f"{materialise_root.rstrip('/')}/{name}" if (materialise_root and kind == "table") else None
        if gates and kind == "table":
            built[name], _ = publish_gated(df, path, gates.get(name, Gate()), name)
            built[name].createOrReplaceTempView(name)
        else:
            built[name] = publish(df, name, kind, path)
        if name == "int_orders_enriched":
            models = build_models(src, built[name])
    return built


def _closure(names: list[str]) -> set[str]:
    deps = {n: d for n, _l, _k, d in MODEL_GRAPH}
    out: set[str] = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n in out or n not in deps:
            continue
        out.add(n)
        stack.extend(deps[n])
    return out


def table_row_counts(tables: dict[str, DataFrame], names: list[str] | None = None) -> DataFrame:
    """``table, row_count`` for each source table (one counting job per table,
    unioned; each count is a map-side partial aggregate)."""
    parts = [tables[n].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table"), "row_count")
             for n in (names or SOURCE_TABLES)]
    return reduce(DataFrame.unionByName, parts)
