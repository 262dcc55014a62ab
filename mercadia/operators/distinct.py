"""COUNT(DISTINCT) that re-aggregates: bitmaps over dense numbers.

A distinct count cannot be added up; a set of numbers can be united. Ids get dense
numbers once; a group's distinct ids are then bitmaps of 32,768 numbers each (4 KB), made by
Spark's bitmap aggregates in tasks first and OR-ed after. Rolled up to coarser groups, they
are OR-ed again, and any filter on the finer groups applies before; the counts stay exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

NUMBER = "_number"


def dense_numbers(ids: DataFrame, key: str, out: str = NUMBER) -> DataFrame:
    """``key, out``: the distinct non-null values of ``key``, numbered from 0 without gaps.

    Written once: a task numbers its own rows, and moves them on by what the tasks
    before it hold (one row a task).
    """
    own = ids.where(F.col(key).isNotNull()).select(key).distinct().select(key, F.monotonically_increasing_id().alias("_id"))
    placed = cut_lineage(own.select(key, F.shiftright("_id", 33).alias("_task"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_at")), "dense_numbers")
    held = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_held"))
    upto = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    starts = held.select("_task", F.coalesce(F.sum("_held").over(upto), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_task").select(key, (F.col("_start") + F.col("_at")).alias(out))


def distinct_bitmaps(df: DataFrame, dims: list[str], number: str = NUMBER) -> DataFrame:
    """``dims, _bucket, _bits``: the distinct numbers of each group, as bitmaps by bucket."""
    return (df.where(F.col(number).isNotNull()).select(*dims, F.bitmap_bucket_number(number).alias("_bucket"), F.bitmap_bit_position(number).alias("_bit"))
            .groupBy(*dims, "_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits")))


def roll_up(bitmaps: DataFrame, dims: list[str]) -> DataFrame:
    """Bitmaps of coarser groups: those of the groups that fall together, united."""
    return bitmaps.groupBy(*dims, "_bucket").agg(F.bitmap_or_agg("_bits").alias("_bits"))


def distinct_counts(bitmaps: DataFrame, dims: list[str], out: str = "distinct_count") -> DataFrame:
    """``dims, out``: the exact number of distinct ids of each group of ``dims``."""
    united = roll_up(bitmaps, dims)
    return united.groupBy(*dims).agg(F.sum(F.bitmap_count("_bits")).alias(out))


def bitmap_index(df: DataFrame, dims: dict[str, object], number: str = NUMBER) -> DataFrame:
    """``dim, value, _bucket, _bits``: for each value of each dimension the numbers that have it.

    ``dims`` maps a dimension to its column (text) or condition-valued expression; a
    number may have several values of one dimension. A filter on any of them is an OR of
    its values' bitmaps; filters together are an AND. Its size is that of the values
    in use times the buckets, not that of their combinations.
    """
    one = F.array(*[F.struct(F.lit(d).alias("dim"), (F.col(c) if isinstance(c, str) else c).cast("string").alias("value")) for d, c in dims.items()])
    rows = df.select(F.col(number), F.explode(one).alias("_d")).select(number, F.col("_d.dim").alias("dim"), F.col("_d.value").alias("value"))
    return distinct_bitmaps(rows, ["dim", "value"], number)


def index_counts(index: DataFrame, by: str, where: dict[str, list], out: str = "distinct_count") -> DataFrame:
    """``value, out``: for each value of dimension ``by`` how many numbers have it and, of each
    dimension in ``where``, one of the values given. Of ``by`` itself only these are left."""
    kept = index.where(F.col("dim") == by).select("value", "_bucket", "_bits")
    for dim, values in where.items():
        if dim == by:
            kept = kept.where(F.col("value").isin([str(v) for v in values]))
            continue
        allowed = roll_up(index.where((F.col("dim") == dim) & F.col("value").isin([str(v) for v in values])), []).select("_bucket", F.col("_bits").alias("_also"))
        both = F.array("_bits", "_also")
        kept = (kept.join(allowed, "_bucket").select("value", "_bucket", F.explode(both).alias("_bits"))
                .groupBy("value", "_bucket").agg(F.bitmap_and_agg("_bits").alias("_bits")))
    return kept.groupBy("value").agg(F.sum(F.bitmap_count("_bits")).alias(out)).where(F.col(out) > 0)
