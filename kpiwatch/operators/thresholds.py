"""Metric join and threshold attachment."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kpiwatch import schemas

KEYS = ["dated", "vertical", "order_type"]
DIM_KEYS = ["vertical", "order_type"]


def join_metrics(funnel: DataFrame, minutes: DataFrame) -> DataFrame:
    """Funnel row plus its three turnaround minutes; a key present in only one
    input is dropped (inner join)."""
    return funnel.join(minutes.select(*KEYS, "dialed_tat", "attempted_tat", "connected_tat"),
                       KEYS, "inner")


def attach_thresholds(metrics: DataFrame, thresholds: DataFrame,
                      threshold_columns=tuple(schemas.THRESHOLD_COLUMNS)) -> DataFrame:
    """Left join on (vertical, order_type); unmatched rows get NULL thresholds.

    Only the keys and the threshold columns of ``thresholds`` are kept (extra
    columns of the table are dropped).  A broadcast hint set when the table was
    loaded (size checked) carries through.  Keys are compared as stored:
    threshold keys are expected in lower case.
    """
    dim = thresholds.select(*DIM_KEYS, *threshold_columns)
    return metrics.join(dim, DIM_KEYS, "left")
