"""The alert query and the message stage as Spark SQL statements.

For users who run the job as SQL: ``alert_sql`` returns the statement (one
pass over the breaches), built from the same expression helpers as the
DataFrame plan; ``alerts_sql`` runs it on DataFrames with ``spark.sql``.  The
statement by itself takes its percentiles from Spark's ``percentile_cont``, whose
state is a group's distinct values; given a relation of percentiles
(``alerts_sql`` gives those of :func:`kpiwatch.operators.percentiles.percentiles_radix`,
which have bounded tasks) it joins that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kpiwatch import schemas
from kpiwatch.functions.columns import day_filter_sql, minutes_seconds_sql, percent_of_sql
from kpiwatch.operators import message as m
from kpiwatch.operators.breaches import RULES, breaches_sql
from kpiwatch.operators.funnel import COUNTERS, PERCENTS, SUM_NAMES
from kpiwatch.operators.percentiles import percentiles
from kpiwatch.operators.turnaround import MINUTES, SECONDS
from kpiwatch.sources.dimensions import DEFAULT_OWNER


def alert_sql(dialed: str = "{dialed}", tat: str = "{tat}", thresholds: str = "{thresholds}",
              as_of=None, day=None, q: float = 0.9, rules=RULES, ordered: bool = True,
              all_days: bool = False, p90: str | None = None) -> str:
    """Spark SQL text of the alert query over the three named relations.  ``p90`` names a relation of
    percentiles (the keys, and a column of seconds for each of ``SECONDS``) to use instead of ``tat``.

    The defaults are ``spark.sql`` format placeholders, so DataFrames can be
    passed as keyword arguments; table names work as well.
    """
    cond = day_filter_sql("dated", as_of, day, all_days)
    where = f"WHERE {cond}" if cond else ""
    sums = ",\n    ".join(f"sum({c}) AS {SUM_NAMES.get(c, c)}" for c in COUNTERS)
    pcts = ",\n    ".join(f"{percent_of_sql(f'sum({num})', 'sum(unique_request)')} AS {name}"
                          for name, num in PERCENTS.items())
    keys = ", ".join(schemas.KEYS)
    quantiles = ",\n    ".join(f"percentile_cont({q}D) WITHIN GROUP (ORDER BY CAST({src} AS DOUBLE)) AS {out}"
                              for out, src in SECONDS.items())
    percentiles_of = p90 or f"(\n  SELECT {keys},\n    {quantiles}\n  FROM {tat} {where}\n  GROUP BY {keys})"
    mins = ",\n    ".join(f"{minutes_seconds_sql(f'round({sec})')} AS {m}" for m, sec in MINUTES.items())
    thr_cols = ", ".join(f"t.{c}" for c in schemas.THRESHOLD_COLUMNS)
    order = "\nORDER BY 1, 2, 3, 4" if ordered else ""
    return f"""
WITH funnel AS (
  SELECT dated, lower(vertical) AS vertical, lower(order_type) AS order_type,
    {sums},
    {pcts}
  FROM {dialed} {where}
  GROUP BY 1, 2, 3),
p90 AS (
  SELECT dated, lower(vertical) AS vertical, order_type,
    {mins}
  FROM {percentiles_of}),
judged AS (
  SELECT m.*, {thr_cols}
  FROM (SELECT * FROM funnel JOIN p90 USING (dated, vertical, order_type)) m
  LEFT JOIN {thresholds} t ON m.vertical = t.vertical AND m.order_type = t.order_type)
SELECT dated, vertical, order_type, {breaches_sql(rules)}
FROM judged{order}"""


def alerts_sql(spark: SparkSession, dialed: DataFrame, tat: DataFrame, thresholds: DataFrame,
               as_of=None, day=None, q: float = 0.9, ordered: bool = True, all_days: bool = False) -> DataFrame:
    """Run :func:`alert_sql` on DataFrames, with the percentiles of bounded tasks."""
    cond = day_filter_sql("dated", as_of, day, all_days)
    p90 = percentiles(tat.where(cond) if cond else tat, schemas.KEYS, SECONDS, q)
    return spark.sql(alert_sql(as_of=as_of, day=day, q=q, ordered=ordered, all_days=all_days, p90="{p90}"),
                     dialed=dialed, p90=p90, thresholds=thresholds)


def message_sql(alerts: str = "{alerts}", owners: str = "{owners}", links: str = "{links}") -> str:
    """Spark SQL text of the message stage: one ``(dated, payload)`` row per
    day with alerts, built from the same block expressions as
    :mod:`kpiwatch.operators.message`."""
    return f"""
WITH per_vertical AS (
  SELECT dated, vertical,
    sort_array(collect_list(struct(order_type, metric_name, metric_value, metric_threshold))) AS _alerts
  FROM {alerts} GROUP BY dated, vertical),
dressed AS (
  SELECT p.dated, p.vertical, p._alerts,
    coalesce(o.tag, (SELECT tag FROM {owners} WHERE vertical = '{DEFAULT_OWNER}')) AS owner_tag,
    {m._link_sql("pct_url")} AS pct_link,
    {m._link_sql("tat_url")} AS tat_link
  FROM per_vertical p
  LEFT JOIN {owners} o ON o.vertical = p.vertical
  LEFT JOIN {links} l ON l.vertical = p.vertical),
per_day AS (
  SELECT dated, sort_array(collect_list(struct(vertical, {m._vertical_blocks_sql()} AS blocks))) AS _vs
  FROM dressed GROUP BY dated)
SELECT dated, to_json(named_struct('blocks',
  concat(array({m.HEADER_SQL}, {m.DIVIDER_SQL}), flatten(transform(_vs, v -> v.blocks))))) AS payload
FROM per_day"""


def messages_sql(spark: SparkSession, alerts: DataFrame, owners: DataFrame, links: DataFrame) -> DataFrame:
    """Run :func:`message_sql` on DataFrames."""
    return spark.sql(message_sql(), alerts=alerts, owners=owners, links=links)
