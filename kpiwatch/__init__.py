"""kpiwatch: KPI threshold alerting on Spark.

Fact marts -> funnel percentages and exact percentile turnaround times per
(day, vertical, order type) -> threshold join -> one-pass breach detection ->
ordered, nested JSON alert messages.  Every stage is a DataFrame -> DataFrame
function built from Spark's built-in operators.
"""

from kpiwatch.plans.alert import AlertConfig, alerts, metrics_with_thresholds
from kpiwatch.plans.sql import alert_sql, alerts_sql

__all__ = ["AlertConfig", "alert_sql", "alerts", "alerts_sql", "metrics_with_thresholds"]
