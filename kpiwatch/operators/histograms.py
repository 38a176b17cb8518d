"""Stored day histograms of the turnaround times.

A day's histogram has one row for each (dated, vertical, order_type, metric, key prefix): how many values share the
prefix, and the least and greatest of them.  They are written once a day, merge over any span of days, and serve any
quantile: only rows near the wanted ranks are still read from the mart.

```
tat mart --(once a day)--> day histograms --merge over days--> picks --near rows of the mart--> exact quantiles
```
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiwatch import schemas
from kpiwatch.operators.percentiles import SHIFTS, histograms, merged, percentiles_radix
from kpiwatch.operators.turnaround import SECONDS
from kpiwatch.sources.sinks import read_stored, replace_days, replace_table

COLUMNS = [*schemas.KEYS, "metric", "prefix", "n", "low", "high", "shift"]


def day_histograms(tat: DataFrame) -> DataFrame:
    """The histograms of each day of a turnaround mart; ``shift`` names the digit they count."""
    return histograms(tat, schemas.KEYS, SECONDS).withColumn("shift", F.lit(SHIFTS[0]))


def store_histograms(tat: DataFrame, path: str, all_days: bool = False) -> None:
    """Write the histograms of ``tat``'s days, replacing exactly those days (``all_days``: the whole table)."""
    if all_days:
        replace_table(day_histograms(tat), path, partition_by=["dated"])
    else:
        replace_days(day_histograms(tat).hint("rebalance", "dated"), path)


def load_histograms(spark: SparkSession, path: str) -> DataFrame:
    """Stored histograms; raises if any counts another digit than this version does."""
    hist = read_stored(spark, path)
    other = hist.where(F.col("shift") != SHIFTS[0]).select("shift").first()
    if other is not None:
        raise ValueError(f"{path} counts prefixes of shift {other.shift}, not {SHIFTS[0]}; store it anew")
    return hist.select(*COLUMNS)


def period_seconds(tat: DataFrame, hist: DataFrame, start=None, end=None, keys: Sequence[str] = ("vertical", "order_type"),
                   q: float = 0.9) -> DataFrame:
    """round(percentile_cont(q)) of each duration over the days from ``start`` to ``end`` (both included; None: open).

    The histograms of those days are merged over every key but ``keys``; of the mart, only rows near the ranks are read.
    """
    for bound, test in ((start, ">="), (end, "<=")):
        if bound is not None:
            cond = F.expr(f"dated {test} DATE'{bound}'")
            tat, hist = tat.where(cond), hist.where(cond)
    found = percentiles_radix(tat, list(keys), SECONDS, q, hist=merged(hist, list(keys)))
    return found.select(*keys, *[F.round(c).alias(c) for c in SECONDS])
