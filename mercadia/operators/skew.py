"""Joins on a key of which a few values hold much of the rows.

Adaptive execution splits a skewed join of two shuffled inputs, but not a chain of
joins that reuses one shuffle. Here the heavy values are found first, by a
frequent-items sketch that tasks fill and merge, and counted exactly. Only their rows are
dealt over several pieces, by a hash of the row; the partners' rows of these values are
copied to every piece. All other rows stay as they are. A chain of joins on (key,
piece) then has one exchange for each input and no hot task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = "_piece"
#: Pieces a task's fair share is cut into; the more, the more even hashing deals them.
PIECES_PER_TASK = 16


def heavy_keys(df: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """``key, rows``: the non-null values with at least ``share`` of all rows, counted exactly.

    The sketch tracks 32 / share items. Its error is below a ninth of share, so
    it misses no such value; what it names is at most 2 / share values, which are counted in a
    second pass over the key column. ``share`` is 0.0001 at least.
    """
    if not 0.0001 <= share <= 1:
        raise ValueError("share: from 0.0001 to 1")
    named = F.expr(f"approx_top_k(`{key}`, {math.ceil(2 / share)}, {1 << math.ceil(math.log2(32 / share))})")
    keys = df.where(F.col(key).isNotNull()).select(key)
    total = df.agg(F.count(F.lit(1)).alias("_all"))
    candidates = keys.agg(named.alias("_top")).select(F.explode("_top").alias("_t")).select(F.col("_t.item").alias(key))
    counted = keys.join(F.broadcast(candidates), key).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(F.broadcast(total)).where(F.col("rows") >= F.lit(share) * F.col("_all")).select(key, "rows")


class SkewedKey:
    """The heavy values of a join key, with the pieces that each is dealt over.

    ``pieces`` (``key, rows, pieces``) has at most 1 / share rows and is broadcast. A
    value's pieces hold about a ``PIECES_PER_TASK``-th of a task's fair share each.
    """

    def __init__(self, big: DataFrame, key: str, share: float | None = None, tasks: int | None = None):
        spark = big.sparkSession
        tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
        share = max(0.0001, min(0.5, share or 1 / (4 * tasks)))
        self.key = key
        found = heavy_keys(big, key, share)
        all_rows = big.count()
        rows = found.collect()  # 1 / share at most
        self.rows = {r[key]: r["rows"] for r in rows}
        n = F.ceil(F.col("rows") * F.lit(tasks * PIECES_PER_TASK) / F.lit(max(1, all_rows))).cast("int")
        schema = f"`{key}` {dict(big.dtypes)[key]}, rows long"
        self.pieces = spark.createDataFrame([(k, n_) for k, n_ in self.rows.items()], schema).withColumn("pieces", n)

    def _with(self, df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(self.pieces.select(F.col(self.key), "pieces")), self.key, "left")

    def dealt(self, df: DataFrame, by: list[str] | None = None) -> DataFrame:
        """``df`` with each row's piece: by a hash of the columns ``by`` (all, if not given), so
        that a task that is run again deals as before. Rows that are equal there share a piece."""
        spread: Column = F.pmod(F.xxhash64(*(by or df.columns)), F.col("pieces")).cast("int")
        return self._with(df).withColumn(PIECE, F.when(F.col("pieces").isNull(), 0).otherwise(spread)).drop("pieces")

    def copied(self, df: DataFrame) -> DataFrame:
        """``df`` with each row of a heavy value once for every piece."""
        every = F.sequence(F.lit(0), F.coalesce(F.col("pieces"), F.lit(1)) - 1)
        return self._with(df).withColumn(PIECE, F.explode(every)).drop("pieces")


def skew_chain(big: DataFrame, partners: list[tuple[DataFrame, str]], key: str, by: list[str] | None = None,
               share: float | None = None, tasks: int | None = None, keep_piece: bool = False) -> DataFrame:
    """``big`` joined with each partner on ``key`` (``inner`` or ``left``), as the plain chain joins.

    The result is partitioned by (key, piece); with ``keep_piece`` it carries the piece, for
    a partial aggregate on that partitioning. A partner's copies are fewer than the
    rows its heavy values join to. ``share``: from which part of ``big`` on a value counts
    as heavy; by default a quarter of a task's fair share.
    """
    if wrong := {how for _, how in partners} - {"inner", "left"}:
        raise ValueError(f"big's rows are dealt once each; cannot join {sorted(wrong)}")
    skewed = SkewedKey(big, key, share, tasks)
    out = skewed.dealt(big, by)
    for partner, how in partners:
        out = out.join(skewed.copied(partner).hint("shuffle_merge"), [key, PIECE], how)
    return out if keep_piece else out.drop(PIECE)
