"""The alert plan: marts + thresholds -> alert rows.

```
thresholds ----------------------------------------------------.
dialed -- day filter -- sum per (dated, lower keys) -- pct ---.   |
                                               inner join ----+-- left join -- one-pass breaches -- sort
tat ---- day filter -- p90 per (dated, raw keys) -- M.SS ------'
```

The two aggregations are the only shuffles over mart-sized data; everything
after them runs on one row per (dated, vertical, order_type).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from kpiwatch.operators.breaches import ALERT_COLUMNS, RULES, breaches, breaches_union
from kpiwatch.operators.funnel import funnel_pct
from kpiwatch.operators.thresholds import attach_thresholds, join_metrics
from kpiwatch.operators.turnaround import tat_minutes, tat_seconds


@dataclass(frozen=True)
class AlertConfig:
    as_of: object = None        # report the day before this date
    day: object = None          # or report exactly this day; neither: yesterday, by the session's date
    all_days: bool = False      # or report every day (a backfill)
    q: float = 0.9              # percentile of the turnaround times
    percentile: str = "radix"   # "radix" (bounded tasks) or "hash" (a group's values in one task)
    form: str = "one_pass"      # "one_pass" or "union" (a row per rule, then the filter)
    rules: tuple = RULES

    def __post_init__(self):
        if self.form not in ("one_pass", "union"):
            raise ValueError(f"unknown form {self.form!r}")


def metrics(dialed: DataFrame, tat: DataFrame, cfg: AlertConfig = AlertConfig()) -> DataFrame:
    funnel = funnel_pct(dialed, as_of=cfg.as_of, day=cfg.day, all_days=cfg.all_days)
    minutes = tat_minutes(tat_seconds(tat, as_of=cfg.as_of, day=cfg.day, q=cfg.q, method=cfg.percentile,
                                      all_days=cfg.all_days))
    return join_metrics(funnel, minutes)


def metrics_with_thresholds(dialed: DataFrame, tat: DataFrame, thresholds: DataFrame,
                            cfg: AlertConfig = AlertConfig()) -> DataFrame:
    return attach_thresholds(metrics(dialed, tat, cfg), thresholds)


def alerts(dialed: DataFrame, tat: DataFrame, thresholds: DataFrame,
           cfg: AlertConfig = AlertConfig(), ordered: bool = True) -> DataFrame:
    """Alert rows (dated, vertical, order_type, metric_name, metric_value,
    metric_threshold), sorted by the first four columns."""
    final = metrics_with_thresholds(dialed, tat, thresholds, cfg)
    rows = breaches(final, cfg.rules) if cfg.form == "one_pass" else breaches_union(final, cfg.rules)
    return rows.orderBy(*ALERT_COLUMNS[:4]) if ordered else rows
