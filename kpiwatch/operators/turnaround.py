"""p90 turnaround per (dated, vertical, order_type): seconds, then "M.SS" minutes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kpiwatch.functions.columns import day_filter_sql, minutes_seconds_sql
from kpiwatch.operators.percentiles import percentiles

# output seconds column -> mart column
SECONDS = {
    "dialed_sec": "first_dialed_tat",
    "attempted_sec": "first_attempted_time",
    "connected_sec": "first_connected_time",
}
# minutes column -> seconds column
MINUTES = {"dialed_tat": "dialed_sec", "attempted_tat": "attempted_sec", "connected_tat": "connected_sec"}


def tat_seconds(tat: DataFrame, as_of=None, day=None, q: float = 0.9,
                method: str = "radix", all_days: bool = False, hist: DataFrame | None = None) -> DataFrame:
    """round(percentile_cont(q)) of each duration, grouped by the raw keys
    (vertical and order type keep their case here).  ``hist``: stored histograms of ``tat`` (see
    :func:`kpiwatch.operators.percentiles.histograms`), filtered to the same days."""
    cond = day_filter_sql("dated", as_of, day, all_days)
    if cond is not None:
        tat = tat.where(cond)
        hist = hist if hist is None else hist.where(cond)
    keys = ["dated", "vertical", "order_type"]
    p = percentiles(tat, keys, SECONDS, q, method, hist)
    return p.selectExpr(*keys, *[f"round({c}) AS {c}" for c in SECONDS])


def tat_minutes(seconds: DataFrame) -> DataFrame:
    """Seconds -> "M.SS" minutes; only the vertical is lower-cased."""
    return seconds.selectExpr(
        "dated", "lower(vertical) AS vertical", "order_type",
        *[f"{minutes_seconds_sql(s)} AS {m}" for m, s in MINUTES.items()])
