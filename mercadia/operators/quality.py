"""Data-quality checks as Spark jobs that return the violating rows (or, for
``dq_not_null``, the count of rows each rule removes). An empty result means
the rule holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dq_unique_grain(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once → key columns + ``row_count``."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count"))
              .where(F.col("row_count") > 1))


def dq_not_null(df: DataFrame, columns: list[str], table: str = "") -> DataFrame:
    """Rows a NOT NULL filter removes, per column → ``table, column, null_rows``.

    One pass over the table: every column's null count is one aggregate."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    stacked = F.stack(F.lit(len(columns)), *[x for c in columns for x in (F.lit(c), F.col(c))])
    return counts.select(stacked.alias("column", "null_rows")).select(
        F.lit(table).alias("table"), "column", F.col("null_rows").cast("bigint").alias("null_rows"))


def dq_accepted_values(df: DataFrame, column: str, values: list[str], keep: list[str] | None = None) -> DataFrame:
    """Rows whose non-null ``column`` is outside ``values``."""
    cols = (keep or []) + [column]
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values)).select(*cols)


def dq_range(df: DataFrame, column: str, low=None, high=None, keep: list[str] | None = None) -> DataFrame:
    """Rows whose non-null ``column`` lies outside [low, high]."""
    c = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return df.where(c.isNotNull() & bad).select(*((keep or []) + [column]))


def dq_relationship(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None,
                    keep: list[str] | None = None) -> DataFrame:
    """Child rows whose non-null foreign key has no parent row (left anti join)."""
    pk = parent_key or key
    p = parent.select(F.col(pk).alias("_pk"))
    c = child.where(F.col(key).isNotNull())
    return c.join(p, c[key] == p["_pk"], "left_anti").select(*((keep or []) + [key]))
