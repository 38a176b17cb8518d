"""Breach detection: one alert row per metric outside its threshold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from kpiwatch.functions.columns import _quote, metric_text_sql

@dataclass(frozen=True)
class Rule:
    name: str        # metric_name shown in the alert
    column: str      # measured column
    threshold: str   # threshold column
    above: bool      # True: alert when value > threshold; False: when value < threshold
    unit: str        # appended to the value text

    def breached_sql(self) -> str:
        return f"{self.column} {'>' if self.above else '<'} {self.threshold}"


# Columns of an alert row; metric names, units and directions of the six alert rules.
ALERT_COLUMNS = ["dated", "vertical", "order_type", "metric_name", "metric_value", "metric_threshold"]
RULES = (
    Rule("Dialed %", "dialed_pct", "dialed_pct_threshold", False, " %"),
    Rule("Attempted %", "attempted_pct", "attempted_pct_threshold", False, " %"),
    Rule("Connected %", "connected_pct", "connected_pct_threshold", False, " %"),
    Rule("Dialed Tat", "dialed_tat", "dialed_tat_threshold", True, " min"),
    Rule("Attempted Tat", "attempted_tat", "attempted_tat_threshold", True, " min"),
    Rule("Connected Tat", "connected_tat", "connected_tat_threshold", True, " min"),
)


def breach(final: DataFrame, rule: Rule) -> DataFrame:
    """Alert rows of one rule (NULL value or threshold never alerts)."""
    return final.where(rule.breached_sql()).selectExpr(
        "dated", "vertical", "order_type",
        f"{_quote(rule.name)} AS metric_name",
        f"{metric_text_sql(rule.column, rule.unit)} AS metric_value",
        f"CAST({rule.threshold} AS DOUBLE) AS metric_threshold")


def breaches_union(final: DataFrame, rules=RULES) -> DataFrame:
    """SQL-shaped form: every rule's row first, then one filter.  ``stack``
    makes the rows of all rules from one reading of ``final``, where one
    UNION ALL branch per rule would read it once each."""
    rows = ", ".join(f"{_quote(r.name)}, {metric_text_sql(r.column, r.unit)}, "
                     f"CAST({r.threshold} AS DOUBLE), {r.breached_sql()}" for r in rules)
    return (final.selectExpr("dated", "vertical", "order_type",
                             f"stack({len(rules)}, {rows}) AS (metric_name, metric_value, metric_threshold, _hit)")
            .where("_hit").drop("_hit"))


def breaches_sql(rules=RULES) -> str:
    """``inline`` of the breached rules' (metric_name, metric_value,
    metric_threshold) structs, as SQL text: the array of all rules is filtered
    on the breach flag before anything is exploded."""
    structs = ",\n  ".join(
        f"named_struct('metric_name', {_quote(r.name)}, "
        f"'metric_value', {metric_text_sql(r.column, r.unit)}, "
        f"'metric_threshold', CAST({r.threshold} AS DOUBLE), "
        f"'_hit', {r.breached_sql()})"
        for r in rules)
    kept = ("named_struct('metric_name', m.metric_name, 'metric_value', m.metric_value, "
            "'metric_threshold', m.metric_threshold)")
    return (f"inline(transform(filter(array(\n  {structs}),\n  m -> coalesce(m._hit, false)),\n"
            f"  m -> {kept}))")


def breaches(final: DataFrame, rules=RULES) -> DataFrame:
    """One pass over ``final``: every row carries an array of its breached
    metrics (filtered before it is exploded), then ``inline`` turns the array
    into alert rows.  Same rows as :func:`breaches_union`."""
    return final.selectExpr("dated", "vertical", "order_type", breaches_sql(rules))
