"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair gets a hash, read as a uniform u in (0, 1); the key goes
to the shard with the least ``-ln(u) / weight``. A shard's share is its weight's
share. A pair's score does not depend on the other shards, so adding a shard
moves rows only into it, and removing one moves only its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercadia.llm.common import numbered

SEED = 20_240_601


def _race(key: Column, shard: int, weight: float, seed: int) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard), F.lit(seed)), 11).cast("double") + F.lit(0.5)) \
        / F.lit(float(1 << 53))
    return F.struct((-F.ln(u) / F.lit(float(weight))).alias("score"), F.lit(shard).alias("shard"))


def rendezvous_shard(key: Column, weights: list[float], seed: int = SEED) -> Column:
    """Shard number (int) of ``key`` among ``len(weights)`` shards.

    Shards of weight 0 get no row; at least one weight must be positive, none
    negative. Equal scores go to the smaller shard. A null key is a key like any
    other: all of them go to one shard.
    """
    if not weights or any(w < 0 for w in weights) or not any(w > 0 for w in weights):
        raise ValueError("weights: none negative, one positive at least")
    return F.array_min(F.array(*[_race(key, i, w, seed) for i, w in enumerate(weights) if w > 0]))["shard"]


def shard_records(df: DataFrame, key_col: str, weights: list[float], grown_weight: float | None = None,
                  seed: int = SEED, rows_per_block: int = 65_536) -> DataFrame:
    """Rows with ``shard`` (int), ``slot`` (long, gapless from 0 in each shard) and
    ``grown_shard`` (int: the shard once a shard of ``grown_weight``, by default
    the mean weight, is added).

    Rows of one key, repeats and null keys included, share a shard and each has a
    slot of its own. An empty table gives none. Columns of ``df`` named like the
    new ones are replaced. The hash is computed row by row without a shuffle; only
    numbering the slots moves rows, in blocks of about ``rows_per_block`` by a hash of the whole
    row, so that the rows of one key are split too.
    """
    grown = [*weights, sum(weights) / len(weights) if grown_weight is None else grown_weight]
    rest = [F.col(f"`{c}`") for c in df.columns if c not in ("shard", "slot", "grown_shard", key_col)]
    key = F.col(f"`{key_col}`")
    sharded = df.select(key, *rest, rendezvous_shard(key, weights, seed).alias("shard"),
                        rendezvous_shard(key, grown, seed).alias("grown_shard"))
    return numbered(sharded, ["shard"], [F.xxhash64(key, *rest)], [key], "slot", rows_per_block)
