"""Funnel percentages over the aggregated dialed mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwatch.functions.columns import day_filter_sql, percent_of_sql

COUNTERS = ("total_requests", "unique_request", "unique_requests_dialed",
            "unique_requests_attempted", "unique_requests_connected")
# counter summed -> output name
SUM_NAMES = {"total_requests": "total_request"}
# percent column -> numerator counter; the denominator is unique_request
PERCENTS = {
    "dialed_pct": "unique_requests_dialed",
    "attempted_pct": "unique_requests_attempted",
    "connected_pct": "unique_requests_connected",
}


def funnel_pct(dialed: DataFrame, as_of=None, day=None,
               counters: Sequence[str] = COUNTERS,
               percents: dict[str, str] | None = None,
               denominator: str = "unique_request", all_days: bool = False) -> DataFrame:
    """Sum the counters per (dated, lower(vertical), lower(order_type)) and turn
    them into percentages of ``denominator`` (DECIMAL, two digits).

    The day predicate sits on the grouping key ``dated``, so Catalyst pushes it
    below the aggregate into the scan (partition filter on a table partitioned
    by ``dated``).
    """
    percents = PERCENTS if percents is None else percents
    cond = day_filter_sql("dated", as_of, day, all_days)
    if cond is not None:
        dialed = dialed.where(cond)
    summed = (dialed.selectExpr("dated", "lower(vertical) AS vertical", "lower(order_type) AS order_type",
                                *counters)
              .groupBy("dated", "vertical", "order_type")
              .agg(*[F.sum(c).alias(c) for c in counters]))
    return summed.selectExpr(
        "dated", "vertical", "order_type",
        *[f"{c} AS {SUM_NAMES.get(c, c)}" for c in counters],
        *[f"{percent_of_sql(num, denominator)} AS {name}" for name, num in percents.items()],
    )
