"""Grouping operators: first row per key, filtered sums, top-k, cohort
retention and recency segmentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import month_index
from .windows import _keys

def top_row_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """DISTINCT ON (keys) … ORDER BY keys, order: one row per key.

    ``row_number() = 1`` over the keys. Spark plans it with a limit of one row per
    key and task below the exchange, so a key holding a third of all rows reaches
    its final task as one row from each.
    """
    w = Window.partitionBy(*keys).orderBy(*[k.sort() for k in _keys(order)])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def filter_sum(measure: str, by: str, values: dict[str, object]) -> list[Column]:
    """SUM(measure) FILTER (WHERE by = value) for each ``alias → value``.

    A value may be a list, meaning ``by NOT IN (list)`` (null ``by`` excluded).
    Like FILTER, a sum with no matching row is NULL.
    """
    out = []
    for alias, v in values.items():
        cond = (~F.col(by).isin(list(v))) if isinstance(v, (list, tuple)) else (F.col(by) == F.lit(v))
        out.append(F.sum(F.when(cond, F.col(measure))).alias(alias))
    return out


def top_k(df: DataFrame, order: list, k: int, tie_break: list | None = None) -> DataFrame:
    """ORDER BY … LIMIT k with a unique tie-break, planned as a distributed
    take-ordered (each task keeps k rows, the driver merges n·k)."""
    sorts = [x.sort() for x in _keys(order) + _keys(tie_break)]
    return df.orderBy(*sorts).limit(k)


def cohort_retention(activity: DataFrame, person: str, ts: str, offsets=(1, 2, 3),
                     cohort: str = "cohort_month", size: str = "cohort_size",
                     retained: str = "retained_m{}") -> DataFrame:
    """First-activity month per person and how many were active exactly k
    calendar months later.

    One shuffle by person: the set of active month indexes per person is
    bounded by the calendar span (not by order volume) and is built map-side
    first, so a person with a third of all orders is still a small set. A
    second, tiny shuffle groups by cohort month. Activity of a NULL person counts
    nowhere.
    """
    per_person = (activity.where(F.col(person).isNotNull()).select(F.col(person).alias("_p"), month_index(F.col(ts)).alias("_m"))
                  .groupBy("_p").agg(F.array_sort(F.collect_set("_m")).alias("_months")))
    first = F.col("_months")[0]
    flags = [F.array_contains("_months", first + k).cast("int").alias(f"_r{k}") for k in offsets]
    per_person = per_person.select(first.alias("_first"), *flags)
    # month index back to the first day of that month
    year = F.floor((F.col("_first") - 1) / 12).cast("int")
    month = (F.col("_first") - year * 12).cast("int")
    agg = per_person.groupBy("_first").agg(F.count(F.lit(1)).alias(size),
                                           *[F.sum(f"_r{k}").cast("bigint").alias(retained.format(k))
                                             for k in offsets])
    return agg.select(F.make_date(year, month, F.lit(1)).alias(cohort), size,
                      *[retained.format(k) for k in offsets])


def segment_by_recency(orders, days, recent: int = 180, lapsed: int = 365, fallback: str = "unknown") -> Column:
    """new (one order) / returning (≤ recent days) / at_risk (≤ lapsed) /
    churned (> lapsed) for 2+ orders; anything else gets ``fallback``."""
    o = F.col(orders) if isinstance(orders, str) else orders
    d = F.col(days) if isinstance(days, str) else days
    repeat = o > 1
    return (F.when(o == 1, "new")
             .when(repeat & (d <= recent), "returning")
             .when(repeat & (d > recent) & (d <= lapsed), "at_risk")
             .when(repeat & (d > lapsed), "churned")
             .otherwise(fallback))
