"""The dashboard's charts from one summary of their dataset.

The charts over ``ds_order_enriched`` share one refresh: the dataset is evaluated once, and
two small tables are kept of it.

* ``sums``, a cuboid by month, category, status and state: the payment sums, and
  the late rows among the delivered ones;
* ``index``, a bitmap index over dense order numbers by the same dimensions and by
  delivered or not: distinct orders under any filter.

A chart under filters reads these alone if its time range starts and ends with
months; any other range is answered from the dataset itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ratio
from ..operators.distinct import bitmap_index, dense_numbers, index_counts
from ..operators.grouping import top_k
from ..operators.windows import Key
from ..session import cut_lineage
from . import dashboards as db

#: Charts of the dataset, and the dimension of each.
BY = {"revenue_trend": "month", "top_categories": "category", "payment_mix": "month", "late_rate": "category", "orders_by_state": "state"}
# The dataset's columns of the dimensions; filters go by the same names.
COLUMNS = {"month": "order_month", "category": "category", "status": "order_status", "state": "customer_state"}
_PAYMENTS = ["total_payment", "credit_card_payment", "boleto_payment", "other_payment"]


def _instant(x) -> datetime:
    return x if isinstance(x, datetime) else datetime(x.year, x.month, x.day) if isinstance(x, date) else datetime.fromisoformat(str(x))


def _is_month_start(t: datetime) -> bool:
    return (t.day, t.hour, t.minute, t.second, t.microsecond) == (1, 0, 0, 0, 0)


def _months(first: datetime, end: datetime) -> list[str]:
    """The months from one month start up to another, as the index has them."""
    n = range(first.year * 12 + first.month - 1, end.year * 12 + end.month - 1)
    return [f"{i // 12:04d}-{i % 12 + 1:02d}" for i in n]


@dataclass
class ChartCube:
    """Summaries of one state of the dataset; ``dataset`` answers what they cannot."""

    dataset: DataFrame
    sums: DataFrame
    index: DataFrame

    @staticmethod
    def build(dataset: DataFrame) -> ChartCube:
        """From rows with distinct (order_id, category). The dataset is evaluated and written once
        (``dataset`` is the written table); the summaries are written too."""
        ds = cut_lineage(dataset, "chart_dataset")
        month, delivered = F.date_format("order_month", "yyyy-MM"), F.col("delivered_at").isNotNull()
        sums = (ds.select(month.alias("month"), *[F.col(c).alias(d) for d, c in COLUMNS.items() if d != "month"], *_PAYMENTS,
                          (delivered & F.col("is_late")).cast("long").alias("late"), delivered.cast("long").alias("delivered"))
                .groupBy(*COLUMNS).agg(*[F.sum(c).alias(c) for c in [*_PAYMENTS, "late", "delivered"]], F.count(F.lit(1)).alias("rows")))
        numbered = ds.join(dense_numbers(ds, "order_id"), "order_id")
        index = bitmap_index(numbered, {"month": month, "category": "category", "status": "order_status", "state": "customer_state",
                                        "delivered": F.when(delivered, "yes")})
        return ChartCube(ds, cut_lineage(sums, "chart_sums"), cut_lineage(index, "chart_index"))

    def answers(self, date_range) -> bool:
        """Whether the summaries can tell this time range."""
        return date_range is None or all(_is_month_start(_instant(x)) for x in date_range)

    def chart(self, name: str, date_range=None, **filters) -> DataFrame:
        """As ``dashboards.chart(name, dataset, date_range, **filters)``."""
        if name not in BY or not self.answers(date_range):
            return db.chart(name, self.dataset, date_range, **filters)
        if unknown := filters.keys() - db.FILTER_SCOPES.keys():
            raise ValueError(f"no such filter: {sorted(unknown)}")
        number = db.CHARTS[name][0]
        where = {f: list(v) for f, v in filters.items() if v is not None and number in db.FILTER_SCOPES[f]}
        if date_range is not None:
            where["month"] = _months(*map(_instant, date_range))
        return getattr(self, f"_{name}")(where)

    def _kept(self, where: dict[str, list]) -> DataFrame:
        kept: Column = F.lit(True)
        for d, values in where.items():
            kept = kept & F.col(d).isin(values)
        return self.sums.where(kept)

    def _by_month(self, where, columns: list[str]) -> DataFrame:
        at = F.to_timestamp_ntz(F.concat("month", F.lit("-01 00:00:00"))).alias("order_month")
        return (self._kept(where).where("month IS NOT NULL").groupBy("month").agg(*[F.sum(c).alias(c) for c in columns]).select(at, *columns))

    def _revenue_trend(self, where) -> DataFrame:
        return self._by_month(where, ["total_payment"])

    def _payment_mix(self, where) -> DataFrame:
        return self._by_month(where, _PAYMENTS[1:])

    def _top_categories(self, where, k: int = 10) -> DataFrame:
        s = self._kept(where).groupBy("category").agg(F.sum("total_payment").alias("total_payment"))
        return top_k(s, [Key("total_payment", True, False)], k, ["category"])

    def _late_rate(self, where, k: int = 15) -> DataFrame:
        late = self._kept(where).groupBy("category").agg(F.sum("late").alias("_late"))
        orders = index_counts(self.index, "category", {**where, "delivered": ["yes"]}, "_orders").select(F.col("value").alias("category"), "_orders")
        s = orders.join(late, "category").select("category", ratio("_late", "_orders", 1, factor=100).alias("late_rate_pct"))
        return top_k(s, [Key("late_rate_pct", True, False)], k, ["category"])

    def _orders_by_state(self, where, k: int = 10) -> DataFrame:
        s = index_counts(self.index, "state", where, "order_count").select(F.col("value").alias("customer_state"), "order_count")
        return top_k(s, [Key("order_count", True, False)], k, ["customer_state"])
