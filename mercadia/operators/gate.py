"""Data quality as a gate: rules counted in the pass that writes a model.

A rule is an aggregate: how many rows break it. ``DataFrame.observe`` counts all rules
of a model while its rows are written; there is no second scan. Only when the write is
done and no rule is broken does the version become the current one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.versions import read_current, switch_version, write_version


@dataclass(frozen=True)
class Rule:
    """A name and the condition of the rows that break it (NULL: not broken), made when it is used."""

    name: str
    broken: Callable[[], Column]


def not_null(column: str) -> Rule:
    return Rule(f"{column} is not null", lambda: F.col(column).isNull())


def accepted(column: str, values: list) -> Rule:
    return Rule(f"{column} is one of {len(values)} values", lambda: F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def in_range(column: str, low=None, high=None) -> Rule:
    def broken() -> Column:
        c = F.col(column)
        return (F.lit(False) if low is None else c < F.lit(low)) | (F.lit(False) if high is None else c > F.lit(high))
    return Rule(f"{column} from {low} to {high}", broken)


@dataclass(frozen=True)
class Gate:
    """What a model must keep to be published: its rules, its key and its least number of rows."""

    rules: tuple[Rule, ...] = ()
    unique: tuple[str, ...] = ()
    least_rows: int = 0


class RuleBroken(ValueError):
    """A model that was written but not published. ``counts``: rows that break each rule."""

    def __init__(self, model: str, counts: dict[str, int], version: str):
        self.model, self.counts, self.version = model, counts, version
        super().__init__(f"{model}: " + "; ".join(f"{name}: {n} rows break it" for name, n in counts.items()))


def publish_gated(df: DataFrame, root: str, gate: Gate, model: str = "model") -> tuple[DataFrame, dict[str, int]]:
    """Write a model as a new version of ``root`` and publish it if it keeps its rules.

    Returns the published table and the counts (``rows``, and broken rows by rule). With a
    broken rule, or too few rows, the version before stays the current one, the written
    folder is left for inspection, and ``RuleBroken`` is raised. A key that must not repeat
    is the one rule that takes a shuffle, of the written keys.
    """
    seen = Observation(f"gate-{uuid.uuid4().hex}")
    metrics = [F.count(F.lit(1)).alias("rows")] + [F.count(F.when(r.broken(), 1)).alias(f"r{i}") for i, r in enumerate(gate.rules)]
    version = write_version(df.observe(seen, *metrics), root)
    got = seen.get
    counts = {r.name: got[f"r{i}"] for i, r in enumerate(gate.rules)}
    if gate.unique:
        keys = df.sparkSession.read.parquet(f"{root.rstrip('/')}/{version}").groupBy(*gate.unique).agg(F.count(F.lit(1)).alias("_n"))
        counts[f"{', '.join(gate.unique)} unique"] = keys.where("_n > 1").agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    if got["rows"] < gate.least_rows:
        counts[f"at least {gate.least_rows} rows"] = gate.least_rows - got["rows"]
    if broken := {k: n for k, n in counts.items() if n}:
        raise RuleBroken(model, broken, version)
    switch_version(df.sparkSession, root, version)
    return read_current(df.sparkSession, root), {"rows": got["rows"], **counts}
