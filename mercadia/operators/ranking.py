"""RANK and NTILE of large inputs without a total order.

Rounds of histograms find where rows stand: each round counts rows by cell, tasks
add up their own counts first, and cells that still hold too much are divided
further, until they are small or hold one value. What rounds read is the sort
column; no rows move. Then

* ``ntile_by_cuts`` knows the last row of each tile exactly and places every
  row by comparing it with these, without an exchange;
* ``rank_by_bins`` knows how many rows come before each cell and ranks inside cells, with
  one exchange by cell. A cell of one value needs no ranking: its rows are dealt at will.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .windows import Key

#: Cells of a histogram, and of those that divide a cell of it; rows of a cell that the driver may look at itself.
CELLS, SUB_CELLS, FEW_ROWS = 1024, 64, 10_000


def integer_key(df: DataFrame, key: Key) -> Column:
    """The sort column as a bigint that ascends in the key's order; NULL stays NULL.

    Integers, decimals (times ten to their scale) and dates and timestamps (days,
    microseconds) map one to one; values beyond 18 digits raise.
    """
    dtype = df.schema[key.name].dataType
    c = F.col(key.name)
    if isinstance(dtype, T.DecimalType):
        u = (c * F.lit(10 ** dtype.scale).cast("decimal(38,0)")).cast("bigint") if dtype.scale else c.cast("bigint")
    elif isinstance(dtype, T.IntegralType):
        u = c.cast("bigint")
    elif isinstance(dtype, T.DateType):
        u = F.unix_date(c).cast("bigint")
    elif isinstance(dtype, T.TimestampType):
        u = F.unix_micros(c)
    elif isinstance(dtype, T.TimestampNTZType):
        u = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c)
    else:
        raise TypeError(f"cannot rank by {key.name}: {dtype.simpleString()}")
    return -u if key.descending else u


def _nulls_first(key: Key) -> bool:
    return (not key.descending) if key.nulls_first is None else key.nulls_first


# ------------------------------------------------------------------ cut points


@dataclass
class _Search:
    """Where the row of one rank is looked for: values lo to hi, ``before`` rows below lo."""

    rank: int
    lo: int
    hi: int
    before: int
    rows: int


def _narrow(rows: DataFrame, searches: list[_Search], few: int) -> None:
    """Histogram rounds over ``u`` until each search has one value, or few rows."""
    while True:
        spans = sorted({(s.lo, s.hi) for s in searches if s.lo < s.hi and s.rows > few})
        if not spans:
            return
        cell = F.lit(None).cast("bigint")
        width = {}
        for i, (lo, hi) in enumerate(spans):
            width[lo, hi] = w = -(-(hi - lo + 1) // CELLS)
            inside = F.expr(f"{i * CELLS}L + (u - {lo}L) div {w}L")
            cell = F.when(F.col("u").between(lo, hi), inside).otherwise(cell)
        counted = dict(map(tuple, rows.select(cell.alias("cell")).where("cell IS NOT NULL").groupBy("cell").count().collect()))
        for s in searches:
            if (s.lo, s.hi) not in width:
                continue
            i, w = spans.index((s.lo, s.hi)), width[s.lo, s.hi]
            for k in range(CELLS):
                n = counted.get(i * CELLS + k, 0)
                if s.before + n >= s.rank:
                    s.lo, s.hi, s.rows = s.lo + k * w, min(s.hi, s.lo + (k + 1) * w - 1), n
                    break
                s.before += n


def _tie_at(rows: DataFrame, at: int, few: int):
    """The ``at``-th (from 1) of the ids ``t`` of ``rows`` in ascending order, NULL first: by one
    more character a round, or by cells of integers, until few are left."""
    nulls = rows.where("t IS NULL").count()
    if at <= nulls:
        return None
    at, rows = at - nulls, rows.select("t").where("t IS NOT NULL")
    if isinstance(rows.schema["t"].dataType, T.IntegralType):
        rows = rows.select(F.col("t").cast("bigint").alias("u"))
        lo, hi, n = rows.agg(F.min("u"), F.max("u"), F.count("u")).first()
        s = _Search(at, lo, hi, 0, n)
        _narrow(rows, [s], few)
        if s.lo == s.hi:
            return s.lo
        return sorted(r[0] for r in rows.where(F.col("u").between(s.lo, s.hi)).collect())[at - s.before - 1]
    prefix, before = "", 0
    n = rows.count()
    while n > few:
        size = len(prefix)
        own = rows.where(F.col("t").startswith(prefix)) if prefix else rows
        counted = own.groupBy(F.substring("t", 1, size + 1).alias("p")).count().orderBy("p").collect()
        for p, n in counted:
            if before + n >= at:
                break
            before += n
        if len(p) == size:  # ids that end here
            return p
        prefix = p
    own = rows.where(F.col("t").startswith(prefix)) if prefix else rows
    return sorted((r[0] for r in own.collect()), key=lambda t: t.encode())[at - before - 1]


def cut_rows(df: DataFrame, key: Key, tie: str, ranks: list[int], few: int = FEW_ROWS) -> list[tuple[int | None, object]]:
    """For each rank (from 1) in the order of ``key`` then ``tie`` (ascending, NULL first, unique;
    text or integer): the row there, as its integer key (None for NULL) and its tie."""
    rows = df.select(integer_key(df, key).alias("u"), F.col(tie).alias("t"))
    lo, hi, n, n_all = rows.agg(F.min("u"), F.max("u"), F.count("u"), F.count(F.lit(1))).first()
    nulls = n_all - n
    first = nulls if _nulls_first(key) else 0     # rows of NULL that come before all values
    out: dict[int, tuple[int | None, object]] = {}
    searches = []
    for r in sorted(set(ranks)):
        if not 1 <= r <= n_all:
            raise ValueError(f"rank {r} of {n_all} rows")
        if r <= first or r > first + n:
            out[r] = None, _tie_at(rows.where("u IS NULL"), r if r <= first else r - n, few)
        else:
            searches.append(_Search(r - first, lo, hi, 0, n))
    _narrow(rows, searches, few)
    for s in searches:
        own = rows.where(F.col("u").between(s.lo, s.hi))
        if s.rows <= few:
            tied = [tuple(r) for r in own.collect()]
            tied.sort(key=lambda r: (r[0], r[1] is not None, r[1].encode() if isinstance(r[1], str) else r[1] or 0))
            out[s.rank + first] = tied[s.rank - s.before - 1]
        else:
            out[s.rank + first] = s.lo, _tie_at(own, s.rank - s.before, few)
    return [out[r] for r in ranks]


def ntile_by_cuts(df: DataFrame, key: Key, tie: str, tiles: int, out: str, few: int = FEW_ROWS) -> DataFrame:
    """NTILE(``tiles``) over all rows in the order of ``key`` then ``tie`` (unique), as ``out``.

    ``df`` is read several times (its sort columns) and should be a written table. Each row is
    compared with the last row of each tile; it does not move.
    """
    n = df.count()
    ends, at = [], 0
    for t in range(tiles - 1):
        at += n // tiles + (t < n % tiles)
        if 0 < at < n and (not ends or ends[-1] != at):
            ends.append(at)
    # with fewer rows than tiles every row is a tile of its own, and the numbers still count up
    cuts = cut_rows(df, key, tie, ends, few) if ends else []
    u, t = integer_key(df, key), F.col(tie)
    after = F.lit(1)
    for cu, ct in cuts:
        later = t.isNotNull() if ct is None else F.coalesce(t > F.lit(ct), F.lit(False))
        if cu is None:
            beyond = (u.isNull() & later) | (u.isNotNull() if _nulls_first(key) else F.lit(False))
        else:
            beyond = F.coalesce((u > F.lit(cu)) | ((u == F.lit(cu)) & later), F.lit(not _nulls_first(key)))
        after = after + beyond.cast("int")
    return df.withColumn(out, after.cast("bigint"))


# ------------------------------------------------------------------ bins


@dataclass
class Bins:
    """Cells of the values of a sort key, each with few rows or one value, numbered in order.

    A level is a small table: what each cell of a divided span is, the number of a bin or a
    span of the next level with its first value and the width of its cells.
    """

    lo: int = 0
    width: int = 1
    levels: list[DataFrame] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)      # of each bin
    single: list[bool] = field(default_factory=list)   # one value only

    def _placed(self, df: DataFrame, u: str) -> DataFrame:
        """``df`` with each row's bin so far, and its span of the last level (NULL once it has a bin)."""
        out = df.select("*", F.when(F.col(u).isNotNull(), F.lit(0)).cast("bigint").alias("_span"), F.lit(self.lo).cast("bigint").alias("_lo"),
                        F.lit(self.width).cast("bigint").alias("_width"), F.lit(None).cast("bigint").alias("_number"))
        for level in self.levels:
            cells = F.broadcast(level)  # of the non-empty cells of spans that hold more than a bin
            inside = F.call_function("div", F.col(u) - F.col("_lo"), F.col("_width"))
            out = (out.withColumn("_cell", inside).join(cells, (F.col("_span") == F.col("_of")) & (F.col("_cell") == F.col("_at")), "left")
                   .select(*df.columns, F.col("_next").alias("_span"), F.col("_next_lo").alias("_lo"), F.col("_next_width").alias("_width"),
                           F.coalesce("_number", "_bin").alias("_number")))
        return out

    def numbered(self, df: DataFrame, u: str, out: str) -> DataFrame:
        """``df`` with the bin of its integer key ``u`` as ``out`` (NULL for NULL)."""
        return self._placed(df, u).select(*df.columns, F.col("_number").alias(out))


_LEVEL = "_of long, _at long, _bin long, _next long, _next_lo long, _next_width long"


def value_bins(rows: DataFrame, rows_per_bin: int) -> Bins:
    """Bins of the non-null bigint column ``u`` of ``rows``, with ``rows_per_bin`` rows at most each
    unless they are all one value. As many rounds as it takes; a round counts the rows of the
    cells of those spans that still hold too many, of which there are fewer than rows / rows_per_bin."""
    spark = rows.sparkSession
    rows = rows.where("u IS NOT NULL").select("u")
    lo, hi, n = rows.agg(F.min("u"), F.max("u"), F.count("u")).first()
    out = Bins()
    if not n:
        return out
    cut = CELLS
    out.lo, out.width = lo, -(-(hi - lo + 1) // cut)
    spans = [((), lo, hi, out.width)]        # path of cell numbers, first and last value, width of a cell
    final: list[tuple[tuple[int, ...], int, bool]] = []
    tables: list[list[list]] = []             # of each level: of, at, path, or what comes next
    while spans:
        counted = (out._placed(rows, "u").where("_span IS NOT NULL")
                   .groupBy("_span", F.call_function("div", F.col("u") - F.col("_lo"), F.col("_width")).alias("_at")).count().collect())
        cut, below, table = SUB_CELLS, [], []
        for of, at, k in sorted(map(tuple, counted)):
            path, a, last, width = spans[of]
            a = a + at * width
            b = min(last, a + width - 1)
            if k > rows_per_bin and a < b:
                w = -(-(b - a + 1) // cut)
                table.append([of, at, None, len(below), a, w])
                below.append(((*path, at), a, b, w))
            else:
                table.append([of, at, (*path, at), None, None, None])
                final.append(((*path, at), k, a == b))
        tables.append(table)
        # bins have no numbers yet; the next round needs to know its spans only
        out.levels.append(spark.createDataFrame([(of, at, None, *rest) for of, at, _, *rest in table if rest[0] is not None], _LEVEL))
        spans = below
    number: dict[tuple[int, ...], int] = {}
    for path, k, single in sorted(final):
        whole = bool(out.rows) and out.rows[-1] + k <= rows_per_bin  # neighbours that are small together are one bin
        if whole:
            out.rows[-1] += k
            out.single[-1] = False
        else:
            out.rows.append(k)
            out.single.append(single)
        number[path] = len(out.rows) - 1
    out.levels = [spark.createDataFrame([(of, at, None if path is None else number[path], *rest) for of, at, path, *rest in table], _LEVEL) for table in tables]
    return out


def rank_by_bins(df: DataFrame, key: Key, ranks: dict[str, list[str]], tie: str, rows_per_bin: int | None = None) -> DataFrame:
    """RANK() in the order of ``key``: for each ``name: partition columns`` (none: over all rows) a
    column ``name``. ``tie`` names a column by whose hash rows of one value are dealt.

    ``df`` is read several times and should be a written table. One exchange, by bin;
    what it needs besides is the number of rows of each (partition, bin), which should be
    bounded by the catalogue times the number of bins and is joined by its measured size.
    """
    spark = df.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_u", integer_key(df, key))
    nulls_first = _nulls_first(key)
    if rows_per_bin is None:
        rows_per_bin = max(1, -(-df.count() // (4 * width)))
    bins = value_bins(keyed.select(F.col("_u").alias("u")), rows_per_bin)
    last = len(bins.rows)
    one_value = F.col("_bin").isin([-1, last, *[i for i, (s, k) in enumerate(zip(bins.single, bins.rows, strict=True)) if s and k > rows_per_bin]])
    binned = bins.numbered(keyed, "_u", "_b").withColumn("_bin", F.coalesce("_b", F.lit(-1 if nulls_first else last).cast("bigint"))).drop("_b")
    dealt = F.when(one_value, F.pmod(F.xxhash64(tie), F.lit(4 * width)).cast("int")).otherwise(0)
    out = binned.withColumn("_part", dealt)
    own = ["_bin", "_part"]
    for i, (name, part) in enumerate(ranks.items()):
        held = binned.groupBy(*part, "_bin").agg(F.count(F.lit(1)).alias("_held"))
        upto = Window.partitionBy(*part).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
        before = held.select(*[F.col(p).alias(f"_p{i}_{j}") for j, p in enumerate(part)], F.col("_bin").alias(f"_b{i}"),
                             F.coalesce(F.sum("_held").over(upto), F.lit(0)).alias(f"_before{i}"))
        # equal values, and NULLs, rank alike, wherever they were dealt
        out = out.withColumn(f"_in{i}", F.rank().over(Window.partitionBy(*own, *part).orderBy("_u")))
        same = F.col("_bin") == F.col(f"_b{i}")
        for j, p in enumerate(part):
            same = same & F.col(p).eqNullSafe(F.col(f"_p{i}_{j}"))
        out = out.join(before, same).withColumn(name, (F.col(f"_in{i}") + F.col(f"_before{i}")).cast("bigint"))
    return out.select(*df.columns, *ranks)
