"""Registered queries: each takes (spark, data_dir) and returns a DataFrame.

All of them read the shared tables of ``data_dir`` (marts are derived from
``events`` or ``lineitem/orders/customer``), so their work grows with the data.
Column names equal those of :mod:`kpiwatch.plans.oracle`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiwatch import schemas
from kpiwatch.operators import message
from kpiwatch.operators.breaches import RULES, breach
from kpiwatch.operators.funnel import funnel_pct
from kpiwatch.operators.histograms import load_histograms, period_seconds, store_histograms
from kpiwatch.operators.turnaround import tat_minutes, tat_seconds
from kpiwatch.plans.alert import AlertConfig, alerts, metrics, metrics_with_thresholds
from kpiwatch.plans.oracle import EVENTS_AS_OF, ORDERS_DAY, PERIOD_QUANTILES, PERIOD_START
from kpiwatch.plans.sql import alerts_sql, messages_sql
from kpiwatch.sources import dimensions as dims
from kpiwatch.sources import runs
from kpiwatch.sources.marts import events_dialed, events_marts, orders_marts
from kpiwatch.sources.messages import read_messages, store_messages
from kpiwatch.sources.sinks import append_table, read_stored, replace_table, shared_dir, write_payloads
from kpiwatch.sources.tables import fetch, read_table

Query = Callable[[SparkSession, str], DataFrame]

DAY = AlertConfig(as_of=EVENTS_AS_OF)
ALL_DAYS = AlertConfig(all_days=True)
PCTS = ("dialed_pct", "attempted_pct", "connected_pct")


def _pct_double(df: DataFrame) -> DataFrame:
    """Percent columns as DOUBLE for comparison (the text keeps the DECIMAL)."""
    return df.withColumns({c: F.col(c).cast("double") for c in PCTS})


def funnel_pct_q(spark, d):
    dialed, _ = events_marts(spark, d)
    return _pct_double(funnel_pct(dialed, as_of=EVENTS_AS_OF))


def tat_p90_seconds_q(spark, d):
    _, tat = events_marts(spark, d)
    return tat_seconds(tat, as_of=EVENTS_AS_OF)


def tat_p90_sorted_q(spark, d):
    _, tat = events_marts(spark, d)
    return tat_seconds(tat, all_days=True)


def _stored_histograms(spark, d, name: str):
    """The turnaround mart, and its day histograms, stored and loaded."""
    _, tat = events_marts(spark, d)
    path = _sink_path(spark, d, f"histograms_{name}")
    store_histograms(tat, path, all_days=True)
    return tat, load_histograms(spark, path)


def tat_p90_histograms_q(spark, d):
    """Every day's p90 from stored day histograms and the rows near the ranks."""
    tat, hist = _stored_histograms(spark, d, "days")
    return tat_seconds(tat, all_days=True, hist=hist)


def tat_period_quantiles_q(spark, d):
    """Quantiles over a span of days: the days' histograms merged, one set of histograms for all quantiles."""
    tat, hist = _stored_histograms(spark, d, "period")
    out = None
    for q in PERIOD_QUANTILES:
        part = period_seconds(tat, hist, PERIOD_START, EVENTS_AS_OF, q=q).withColumn("q", F.lit(q))
        out = part if out is None else out.unionByName(part)
    return out


def tat_minutes_q(spark, d):
    _, tat = events_marts(spark, d)
    return tat_minutes(tat_seconds(tat, as_of=EVENTS_AS_OF))


def dialed_tat_join_q(spark, d):
    return _pct_double(metrics(*events_marts(spark, d), DAY))


def _stored_dimension(spark, d, df: DataFrame, name: str) -> DataFrame:
    """A dimension as the job gets it: stored, loaded and its keys checked."""
    path = _sink_path(spark, d, f"dimension_{name}")
    replace_table(df, path)
    return dims.load_dimension(spark, path, {"thresholds": schemas.THRESHOLDS, "owners": schemas.OWNERS, "links": schemas.LINKS}[name])


def threshold_join_q(spark, d):
    thresholds = _stored_dimension(spark, d, dims.events_thresholds(spark), "thresholds")
    return _pct_double(metrics_with_thresholds(*events_marts(spark, d), thresholds, DAY))


def _breach_q(rule) -> Query:
    def q(spark, d):
        final = metrics_with_thresholds(*events_marts(spark, d), dims.events_thresholds(spark), DAY)
        return breach(final, rule)
    q.__name__ = f"breach_{rule.column}_q"
    return q


def _events_alerts(spark, d, cfg: AlertConfig, ordered: bool = True) -> DataFrame:
    return alerts(*events_marts(spark, d), dims.events_thresholds(spark), cfg, ordered)


def alerts_union_q(spark, d):
    return _events_alerts(spark, d, AlertConfig(as_of=EVENTS_AS_OF, form="union"))


def alerts_day_q(spark, d):
    return _events_alerts(spark, d, DAY)


def alerts_all_days_q(spark, d):
    return _events_alerts(spark, d, ALL_DAYS)


def alerts_all_days_sorted_q(spark, d):
    """Cross-check of the radix percentile: the same alerts by Spark's own aggregate."""
    return _events_alerts(spark, d, AlertConfig(all_days=True, percentile="hash"))


def alerts_day_sql_q(spark, d):
    """The flagship as one Spark SQL statement."""
    return alerts_sql(spark, *events_marts(spark, d), dims.events_thresholds(spark), as_of=EVENTS_AS_OF)


def alerts_orders_all_sql_q(spark, d):
    return alerts_sql(spark, *orders_marts(spark, d), dims.orders_thresholds(spark), all_days=True)


def alert_payload_sql_q(spark, d):
    """Alerts and messages of every day, both as Spark SQL statements."""
    a = alerts_sql(spark, *events_marts(spark, d), dims.events_thresholds(spark), ordered=False, all_days=True)
    return messages_sql(spark, a, dims.owners(spark), dims.links(spark))


def alerts_orders_month_q(spark, d):
    return alerts(*orders_marts(spark, d), dims.orders_thresholds(spark), AlertConfig(day=ORDERS_DAY))


def alerts_orders_all_q(spark, d):
    return alerts(*orders_marts(spark, d), dims.orders_thresholds(spark), ALL_DAYS)


def _message_input(spark, d):
    return _events_alerts(spark, d, ALL_DAYS, ordered=False), dims.owners(spark), dims.links(spark)


def report_window_q(spark, d):
    return message.report_window(_events_alerts(spark, d, ALL_DAYS, ordered=False))


def alert_owners_q(spark, d):
    a, _, _ = _message_input(spark, d)
    owners = _stored_dimension(spark, d, dims.owners(spark), "owners")
    return message.with_owner(a, owners).select(*schemas.ALERT.fieldNames(), "owner_tag")


def alert_links_q(spark, d):
    a, _, _ = _message_input(spark, d)
    links = _stored_dimension(spark, d, dims.links(spark), "links")
    return message.vertical_links(a, links)


def alert_blocks_q(spark, d):
    return message.alert_blocks(*_message_input(spark, d))


def alert_payload_q(spark, d):
    return message.alert_payload(*_message_input(spark, d))


def _sink_path(spark, d, name) -> str:
    tag = d.rstrip("/").rsplit("/", 1)[-1].replace(".", "_")
    return shared_dir(spark, f"kpiwatch_sinks/{name}_{tag}")


def sink_replace_q(spark, d):
    """Replace a table with the dialed mart (partitioned by day), read it back."""
    path = _sink_path(spark, d, "dialed_replace")
    replace_table(events_dialed(read_table(spark, d, "events")), path, partition_by=["dated"])
    return read_stored(spark, path).select(*schemas.DIALED.fieldNames())


def sink_append_q(spark, d):
    """Create the table from the first half of the days, append the rest, read back."""
    path = _sink_path(spark, d, "dialed_append")
    mart = events_dialed(read_table(spark, d, "events"))
    split = F.lit(EVENTS_AS_OF).cast("date")
    replace_table(mart.where(F.col("dated") < split), path)
    append_table(mart.where(F.col("dated") >= split), path)
    return read_stored(spark, path).select(*schemas.DIALED.fieldNames())


def sink_messages_q(spark, d):
    """Store every day's message, store one day again, read back: each day has one."""
    path = _sink_path(spark, d, "messages")
    messages = message.alert_payload(*_message_input(spark, d))
    replace_table(messages, path, partition_by=["dated"])
    write_payloads(read_stored(spark, path).where(F.col("dated") == F.date_sub(F.lit(EVENTS_AS_OF).cast("date"), 1)), f"{path}_day")
    write_payloads(read_stored(spark, f"{path}_day"), path)
    return read_stored(spark, path).select("dated", "payload")


def sink_messages_source_q(spark, d):
    """The same through the message data source: all days, then one of them again, then an empty write."""
    path = _sink_path(spark, d, "message_source")
    messages = message.alert_payload(*_message_input(spark, d))
    store_messages(messages, path, "overwrite")
    store_messages(read_messages(spark, path).where(F.col("dated") == F.date_sub(F.lit(EVENTS_AS_OF).cast("date"), 1)), path)
    store_messages(read_messages(spark, path).limit(0), path)
    return read_messages(spark, path)


def alerts_committed_q(spark, d):
    """Alerts and messages stored together: a backfill, a run of one day over it, and a run that was never
    committed; read back, every day is that of its last committed run."""
    root = _sink_path(spark, d, f"runs_{runs.new_run()}")
    a, owners, links = _message_input(spark, d)
    runs.store_run(spark, root, {"alerts": a, "messages": message.alert_payload(a, owners, links)})
    on = dt.date.fromisoformat(EVENTS_AS_OF) - dt.timedelta(days=1)
    one = _events_alerts(spark, d, DAY, ordered=False)
    runs.store_run(spark, root, {"alerts": one, "messages": message.alert_payload(one, owners, links)}, on, on)
    runs.stage(one.where("metric_threshold > 1"), root, runs.new_run(), "alerts")
    return runs.committed(spark, root, "alerts", schemas.ALERT)


def lowercase_columns_q(spark, d):
    """A query whose result comes back in upper case (as warehouses answer),
    normalised to lower-case column names."""
    customer = read_table(spark, d, "customer")
    upper = ", ".join(f"{c} AS {c.upper()}" for c in customer.columns)
    return fetch(spark, f"SELECT {upper} FROM {{customer}}", customer=customer)


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "funnel_pct": funnel_pct_q,
        "tat_p90_seconds": tat_p90_seconds_q,
        "tat_p90_sorted": tat_p90_sorted_q,
        "tat_p90_histograms": tat_p90_histograms_q,
        "tat_period_quantiles": tat_period_quantiles_q,
        "tat_minutes": tat_minutes_q,
        "dialed_tat_join": dialed_tat_join_q,
        "threshold_join": threshold_join_q,
    }
    for r in RULES:
        out[f"breach_{r.column}"] = _breach_q(r)
    out.update({
        "alerts_union": alerts_union_q,
        "alerts_day": alerts_day_q,
        "alerts_all_days": alerts_all_days_q,
        "alerts_all_days_sorted": alerts_all_days_sorted_q,
        "alerts_orders_month": alerts_orders_month_q,
        "alerts_orders_all": alerts_orders_all_q,
        "alerts_day_sql": alerts_day_sql_q,
        "alerts_orders_all_sql": alerts_orders_all_sql_q,
        "report_window": report_window_q,
        "alert_owners": alert_owners_q,
        "alert_links": alert_links_q,
        "alert_blocks": alert_blocks_q,
        "alert_payload": alert_payload_q,
        "alert_payload_sql": alert_payload_sql_q,
        "sink_replace": sink_replace_q,
        "sink_append": sink_append_q,
        "sink_messages": sink_messages_q,
        "sink_messages_source": sink_messages_source_q,
        "alerts_committed": alerts_committed_q,
        "lowercase_columns": lowercase_columns_q,
    })
    return out
