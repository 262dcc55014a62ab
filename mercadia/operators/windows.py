"""Window operators.

``period_over_period``, ``running_total`` and ``pareto`` are meant for inputs
whose row count is bounded by calendar or catalogue size (months, categories):
their un-partitioned windows run in one task, which is fine for hundreds of
rows. ``global_window`` is the scalable form for entity-grain inputs (products,
customers), where a window without PARTITION BY would pull everything into one
task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import ratio
from ..session import cut_lineage, ensure_checkpoint_dir


@dataclass(frozen=True)
class Key:
    """One sort key: column name, direction and null placement."""

    name: str
    descending: bool = False
    nulls_first: bool | None = None  # None → Spark default (first for asc, last for desc)

    def sort(self) -> Column:
        c = F.col(self.name)
        nf = (not self.descending) if self.nulls_first is None else self.nulls_first
        if self.descending:
            return c.desc_nulls_first() if nf else c.desc_nulls_last()
        return c.asc_nulls_first() if nf else c.asc_nulls_last()


def _keys(spec) -> list[Key]:
    out = []
    for k in spec or []:
        if isinstance(k, Key):
            out.append(k)
        elif isinstance(k, str):
            out.append(Key(k))
        else:
            out.append(Key(*k))
    return out


def period_over_period(df: DataFrame, order: list, measures: list[str], partition: list[str] | None = None,
                       lag: int = 1, scale: int = 2, prev_names: dict[str, str] | None = None,
                       pct_names: dict[str, str] | None = None) -> DataFrame:
    """Previous present row's value and the % change against it.

    Compares with the previous *row* in order (a missing period is simply
    absent), so the first row and any row after a zero value get NULL change.
    """
    w = Window.orderBy(*[k.sort() for k in _keys(order)])
    if partition:
        w = w.partitionBy(*partition)
    prev_names = prev_names or {m: f"prev_{m}" for m in measures}
    pct_names = pct_names or {m: f"{m}_change_pct" for m in measures}
    out = df
    for m in measures:
        out = out.withColumn(prev_names[m], F.lag(m, lag).over(w))
    for m in measures:
        out = out.withColumn(pct_names[m], ratio(F.col(m) - F.col(prev_names[m]), F.col(prev_names[m]),
                                                 scale, factor=100))
    return out


def running_total(df: DataFrame, order: list, measures: dict[str, str],
                  partition: list | None = None) -> DataFrame:
    """SUM(m) OVER (PARTITION BY … ORDER BY … ROWS UNBOUNDED PRECEDING..CURRENT ROW)."""
    w = Window.orderBy(*[k.sort() for k in _keys(order)]).rowsBetween(Window.unboundedPreceding, 0)
    if partition:
        w = w.partitionBy(*partition)
    out = df
    for m, name in measures.items():
        out = out.withColumn(name, F.sum(m).over(w))
    return out


def pareto(df: DataFrame, key: str, measure: str, scale: int = 2, tie_break: str | None = None,
           share: str = "share_pct", cumulative: str = "cumulative_pct", rank: str | None = None) -> DataFrame:
    """Share of the grand total and running (Pareto) share, largest first.

    For inputs of catalogue size (one row per category): the grand total is one
    whole-set window aggregate computed once, next to the running sum, over rows
    that are already aggregated, so the upstream join is not evaluated a second
    time. The running sum orders by measure desc (nulls first), then
    ``tie_break`` (default: ``key``) so equal measures get a deterministic
    cumulative value.
    """
    order = [Key(measure, True, True), Key(tie_break or key)]
    out = running_total(df, order, {measure: "_running"})
    out = out.withColumn("_total", F.sum(measure).over(Window.partitionBy()))
    out = (out.withColumn(share, ratio(F.col(measure), F.col("_total"), scale, factor=100))
              .withColumn(cumulative, ratio(F.col("_running"), F.col("_total"), scale, factor=100))
              .drop("_running", "_total"))
    if rank:
        out = out.withColumn(rank, F.rank().over(Window.orderBy(F.col(measure).desc())))
    return out


def _idiv(a: Column, b) -> Column:
    """Integer division of non-negative integers (exact: 18 fractional digits kept)."""
    b = b if isinstance(b, Column) else F.lit(b)
    return (a.cast("decimal(20,0)") / b.cast("decimal(20,0)")).cast("bigint")


def ntile_of(rn: Column, n: Column, tiles: int) -> Column:
    """NTILE(tiles) from a 1-based row number and the row count (the first
    N % tiles buckets get one extra row)."""
    q = _idiv(n, tiles)
    r = n - q * tiles
    big = r * (q + 1)
    first = _idiv(rn - 1, q + 1) + 1
    rest = r + _idiv(rn - 1 - big, F.when(q > 0, q)) + 1
    return F.when(rn <= big, first).otherwise(rest)


def global_window(df: DataFrame, order: list, tie_break: list, partition_by: list[str] | None = None,
                  rank: str | None = None, row_number: str | None = None,
                  ntile: tuple[str, int] | None = None, running: dict[str, str] | None = None,
                  group_sum: dict[str, str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """RANK / ROW_NUMBER / NTILE / running SUM / whole-group SUM over a large
    input without funnelling it through one task.

    1. Range-partition on (partition keys, order keys, tie-break). The
       tie-break makes the sort key unique, so even a group or a tie holding a
       third of all rows is cut into evenly sized ranges.
    2. Inside each range: position, group start, tie start and running sums
       (one sort per range), then written once as a table in the shared
       checkpoint folder, so every later pass sees the same ranges (range bounds
       are sampled) and the summary pass reads only the columns it needs.
    3. A summary of one row per range (bounded by the number of ranges) gives
       each range the rows/sums of its first group that precede it, the rows of
       its first tie that precede it and the sums of its last group that
       follow it; it is broadcast back.

    ``rank`` orders by ``order`` only (ties share a rank); ``row_number``,
    ``ntile`` and ``running`` order by ``order`` then ``tie_break``;
    ``group_sum`` gives every row the total of a measure over its whole
    partition group (SUM() OVER (PARTITION BY …)), also when the group spans
    ranges. NULL measures are skipped, as SUM does. The number of ranges defaults to
    the shuffle width.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    part = list(partition_by or [])
    okeys, tkeys = _keys(order), _keys(tie_break)
    if ntile and part:
        raise ValueError("ntile is supported for whole-set windows only")
    running = dict(running or {})
    group_sum = dict(group_sum or {})
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A measure runs as its value with NULL as 0, and as a count of its non-NULL
    # rows: like SUM, a total is NULL until a row has a value.
    types = dict(df.dtypes)
    measures = list(dict.fromkeys([*running, *group_sum]))
    values = {m: f"_v{i}" for i, m in enumerate(measures)}
    counts = {m: f"_k{i}" for i, m in enumerate(measures)}
    columns = df.columns
    df = df.select("*", *[F.coalesce(F.col(m), F.lit(0).cast(types[m])).alias(values[m]) for m in measures],
                   *[F.col(m).isNotNull().cast("bigint").alias(counts[m]) for m in measures])
    asked_running, asked_group = running, group_sum
    running = [x for m in measures for x in (values[m], counts[m])]
    group_sum = [x for m in asked_group for x in (values[m], counts[m])]
    sort = [F.col(p).asc_nulls_first() for p in part] + [k.sort() for k in okeys + tkeys]

    group_key = F.struct(*[F.col(p) for p in part]) if part else F.struct(F.lit(0).alias("g"))
    tie_key = F.struct(*([F.col(p) for p in part] + [F.col(k.name) for k in okeys]))

    ranged = (df.repartitionByRange(n, *sort)
                .select("*", F.spark_partition_id().alias("_pid"), group_key.alias("_g"), tie_key.alias("_t"))
                .repartitionByRange(n, "_pid"))
    w = Window.partitionBy("_pid").orderBy(*sort)
    wcum = w.rowsBetween(Window.unboundedPreceding, 0)
    # layer 1: position, group/tie starts flags, running sums within the range
    local = ranged.select(
        "*", F.row_number().over(w).alias("_pos"),
        F.coalesce(~F.lag("_g").over(w).eqNullSafe(F.col("_g")), F.lit(True)).alias("_new_g"),
        F.coalesce(~F.lag("_t").over(w).eqNullSafe(F.col("_t")), F.lit(True)).alias("_new_t"),
        F.coalesce(~F.lead("_g").over(w).eqNullSafe(F.col("_g")), F.lit(True)).alias("_end_g"),
        *[F.sum(m).over(wcum).alias(f"_cum_{m}") for m in running])
    # layer 2: where the current group / tie started, and the running sum before the group
    local = local.select(
        "*", F.last(F.when(F.col("_new_g"), F.col("_pos")), True).over(wcum).alias("_gstart"),
        F.last(F.when(F.col("_new_t"), F.col("_pos")), True).over(wcum).alias("_tstart"),
        *[F.last(F.when(F.col("_new_g"), F.col(f"_cum_{m}") - F.col(m)), True).over(wcum).alias(f"_base_{m}")
          for m in running])
    keep = [c for c in local.columns if c not in ("_new_g", "_new_t") and not c.startswith(("_cum_", "_base_"))]
    local = local.select(
        *keep, (F.col("_pos") - F.col("_gstart") + 1).alias("_rn_in_g"),
        (F.col("_tstart") - F.col("_gstart") + 1).alias("_rank_in_g"),
        (F.col("_pos") - F.col("_tstart") + 1).alias("_rn_in_t"),
        *[(F.col(f"_cum_{m}") - F.col(f"_base_{m}")).alias(f"_run_{m}") for m in running])
    if group_sum:
        # the group's sum inside this range = its running sum at the group's last row here
        wfwd = w.rowsBetween(0, Window.unboundedFollowing)
        local = local.select(
            "*", *[F.first(F.when(F.col("_end_g"), F.col(f"_run_{m}")), True).over(wfwd).alias(f"_gloc_{m}")
                   for m in group_sum])
    local = cut_lineage(local.drop("_end_g"), "global_window")

    last_aggs = [F.max_by(F.col(f"_run_{m}"), F.col("_pos")).alias(f"_last_run_{m}") for m in running]
    last_aggs += [F.min_by(F.col(f"_gloc_{m}"), F.col("_pos")).alias(f"_first_gsum_{m}") for m in group_sum]
    summary = local.groupBy("_pid").agg(
        F.count(F.lit(1)).alias("_cnt"),
        F.min_by("_g", "_pos").alias("_g_first"),
        F.min_by("_t", "_pos").alias("_t_first"),
        F.max_by("_g", "_pos").alias("_g_last"),
        F.max_by("_t", "_pos").alias("_t_last"),
        F.max_by("_rn_in_g", "_pos").alias("_last_g_cnt"),
        F.max_by("_rn_in_t", "_pos").alias("_last_t_cnt"),
        *last_aggs)
    # The summary has one row per non-empty range: a single-task window over it is bounded by n.
    ws = Window.orderBy("_pid")
    upto = ws.rowsBetween(Window.unboundedPreceding, 0)
    s = summary.select(
        "*", F.sum(F.coalesce((~F.lag("_g_last").over(ws).eqNullSafe(F.col("_g_last"))).cast("int"), F.lit(1)))
        .over(upto).alias("_isl_g"),
        F.sum(F.coalesce((~F.lag("_t_last").over(ws).eqNullSafe(F.col("_t_last"))).cast("int"), F.lit(1)))
        .over(upto).alias("_isl_t"))
    wg = Window.partitionBy("_isl_g").orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    wt = Window.partitionBy("_isl_t").orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    s = s.select("*", F.sum("_last_g_cnt").over(wg).alias("_chain_g_cnt"),
                 F.sum("_last_t_cnt").over(wt).alias("_chain_t_cnt"),
                 *[F.sum(f"_last_run_{m}").over(wg).alias(f"_chain_run_{m}") for m in running])
    if group_sum:
        # rows of a range's last group that lie in later ranges: a run of
        # following ranges starting with that group (reverse islands on _g_first)
        wr = Window.orderBy(F.col("_pid").desc())
        s = s.select("*", F.sum(F.coalesce((~F.lag("_g_first").over(wr).eqNullSafe(F.col("_g_first"))).cast("int"),
                                           F.lit(1))).over(wr.rowsBetween(Window.unboundedPreceding, 0))
                     .alias("_isl_f"))
        wf = Window.partitionBy("_isl_f").orderBy(F.col("_pid").desc()).rowsBetween(Window.unboundedPreceding, 0)
        s = s.select("*", *[F.sum(f"_first_gsum_{m}").over(wf).alias(f"_chain_f_{m}") for m in group_sum])
    cont_g = F.lag("_g_last").over(ws).eqNullSafe(F.col("_g_first"))
    cont_t = F.lag("_t_last").over(ws).eqNullSafe(F.col("_t_first"))
    offs = s.select(
        "_pid", "_g_first", "_t_first",
        F.when(cont_g, F.lag("_chain_g_cnt").over(ws)).otherwise(0).alias("_off_g"),
        F.when(cont_t, F.lag("_chain_t_cnt").over(ws)).otherwise(0).alias("_off_t"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_total"),
        *[F.when(cont_g, F.lag(f"_chain_run_{m}").over(ws)).otherwise(0).alias(f"_off_run_{m}")
          for m in running],
        *[F.when(F.lead("_g_first").over(ws).eqNullSafe(F.col("_g_last")), F.lead(f"_chain_f_{m}").over(ws))
          .otherwise(0).alias(f"_after_{m}") for m in group_sum],
        "_g_last")

    out = local.join(F.broadcast(offs), "_pid")
    in_first_g = F.col("_g").eqNullSafe(F.col("_g_first"))
    in_first_t = F.col("_t").eqNullSafe(F.col("_t_first"))
    g_off = F.when(in_first_g, F.col("_off_g")).otherwise(0)
    rn = F.col("_rn_in_g") + g_off
    new_cols = []
    if rank:
        new_cols.append((F.col("_rank_in_g") + g_off
                         - F.when(in_first_t, F.col("_off_t")).otherwise(0)).cast("bigint").alias(rank))
    if row_number:
        new_cols.append(rn.cast("bigint").alias(row_number))
    if ntile:
        name, tiles = ntile
        new_cols.append(ntile_of(rn, F.col("_total"), tiles).cast("bigint").alias(name))
    in_last_g = F.col("_g").eqNullSafe(F.col("_g_last"))

    def upto(x):
        return F.col(f"_run_{x}") + F.when(in_first_g, F.col(f"_off_run_{x}")).otherwise(0)

    def whole(x):
        return (F.col(f"_gloc_{x}") + F.when(in_first_g, F.col(f"_off_run_{x}")).otherwise(0)
                + F.when(in_last_g, F.col(f"_after_{x}")).otherwise(0))

    for total, asked in ((upto, asked_running), (whole, asked_group)):
        new_cols += [F.when(total(counts[m]) > 0, total(values[m])).alias(name) for m, name in asked.items()]
    return out.select(*columns, *new_cols)
