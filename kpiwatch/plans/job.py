"""The scheduled alert job: load, compute, store.

``python -m kpiwatch.plans.job --dialed ... --tat ... --thresholds ... --owners ... --links ...
--alerts-out ... --messages-out ... [--as-of YYYY-MM-DD | --day YYYY-MM-DD | --all-days]``

Sources are catalog names or paths (Parquet), or JDBC queries through
``load_table``.  Alert rows and messages go to tables partitioned by ``dated``;
a re-run of a day replaces that day only.
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kpiwatch import schemas
from kpiwatch.operators.message import alert_payload
from kpiwatch.plans.alert import AlertConfig, alerts
from kpiwatch.sources import runs
from kpiwatch.sources.dimensions import load_dimension
from kpiwatch.functions.columns import report_day_sql
from kpiwatch.sources.sinks import replace_table, write_payloads
from kpiwatch.sources.tables import conform, load_table


def load_inputs(spark: SparkSession, dialed: str, tat: str, thresholds: str, owners: str,
                links: str) -> tuple[DataFrame, ...]:
    return (conform(load_table(spark, dialed), schemas.DIALED),
            conform(load_table(spark, tat), schemas.TAT),
            load_dimension(spark, thresholds, schemas.THRESHOLDS),
            load_dimension(spark, owners, schemas.OWNERS),
            load_dimension(spark, links, schemas.LINKS))


def _report_day(spark: SparkSession, cfg: AlertConfig) -> dt.date | None:
    """The one reported day, by the session's date where none is given; None for all days."""
    if cfg.all_days:
        return None
    return spark.sql(f"SELECT {report_day_sql(cfg.as_of, cfg.day)} AS d").first().d


def run_job(spark: SparkSession, dialed: str, tat: str, thresholds: str, owners: str, links: str,
            alerts_out: str, messages_out: str, cfg: AlertConfig) -> None:
    """Compute the alert rows and the day messages and store both.

    A one-day run replaces exactly that day in both outputs, also when the day
    no longer has alerts; a run over all days replaces both outputs.  The
    messages are a (dated, payload) Parquet table, payload NULL on a day
    without alerts.
    """
    d, t, thr, own, lnk = load_inputs(spark, dialed, tat, thresholds, owners, links)
    day = _report_day(spark, cfg)
    if day is not None:
        cfg = replace(cfg, as_of=None, day=day)  # one date for all steps, also past midnight
    rows = alerts(d, t, thr, cfg, ordered=False)
    if day is None:
        replace_table(rows, alerts_out, partition_by=["dated"])
    else:
        # Static partition path: replaced even when the day has no rows now.
        replace_table(rows.drop("dated"), f"{alerts_out}/dated={day.isoformat()}")
    # The messages are built from the stored rows, not by recomputing the plan.
    stored = spark.read.schema(schemas.ALERT).parquet(alerts_out)
    if day is None:
        replace_table(alert_payload(stored, own, lnk), messages_out, partition_by=["dated"])
    else:
        messages = alert_payload(stored.where(F.col("dated") == F.lit(day)), own, lnk)
        wanted = spark.createDataFrame([(day,)], "dated date")
        write_payloads(wanted.join(messages, "dated", "left"), messages_out)


FIGURES = "dated date, name string, value long"


def _observed(o: Observation, names: list[str]) -> dict[str, int]:
    """The observed counts; 0 where Spark knew the observed rows to be none before it read any, as on a day that the
    mart doesn't have: such a plan has nothing left to observe, and asking for its metrics raises."""
    try:
        return o.get
    except Py4JJavaError:
        return dict.fromkeys(names, 0)


def run_committed(spark: SparkSession, dialed: str, tat: str, thresholds: str, owners: str, links: str,
                  root: str, cfg: AlertConfig) -> str:
    """Like :func:`run_job`, but alerts, messages and the run's figures become visible together or not at all
    (:mod:`kpiwatch.sources.runs`).  Returns the run's id.

    The figures (turnaround rows read, alerts stored, alerts per rule) are observed while the job reads and
    writes; no pass is made for them.  They are dated with the reported day, or the day of the run in a backfill.
    """
    d, t, thr, own, lnk = load_inputs(spark, dialed, tat, thresholds, owners, links)
    day = _report_day(spark, cfg)
    if day is not None:
        cfg = replace(cfg, as_of=None, day=day)
        t = t.where(F.col("dated") == F.lit(day))
    read, kept, run = Observation("tat"), Observation("alerts"), runs.new_run()
    t = t.observe(read, F.count(F.lit(1)).alias("tat_rows_read"))
    names = ["alerts", *(f"alerts: {r.name}" for r in cfg.rules)]
    counts = [F.count(F.lit(1)), *(F.count_if(F.col("metric_name") == r.name) for r in cfg.rules)]
    rows = alerts(d, t, thr, cfg, ordered=False).observe(kept, *[c.alias(n) for n, c in zip(names, counts)])
    runs.stage(rows, root, run, "alerts")
    staged = spark.read.schema(schemas.ALERT).parquet(f"{root}/alerts/run={run}")
    runs.stage(alert_payload(staged, own, lnk), root, run, "messages")
    on = day or spark.sql("SELECT current_date() AS d").first().d
    figures = [(on, name, value) for name, value in {**_observed(read, ["tat_rows_read"]), **_observed(kept, names)}.items()]
    runs.stage(spark.createDataFrame(figures, FIGURES), root, run, "figures")
    runs.commit(spark, root, run, day, day)
    return run


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description="KPI threshold alert job")
    for name in ("dialed", "tat", "thresholds", "owners", "links", "alerts-out", "messages-out"):
        p.add_argument(f"--{name}", required=True)
    when = p.add_mutually_exclusive_group()
    when.add_argument("--as-of", help="report the day before this date (default: the session's date)")
    when.add_argument("--day", help="report this day")
    when.add_argument("--all-days", action="store_true", help="report every day (backfill)")
    p.add_argument("--percentile", choices=("radix", "hash"), default="radix")
    a = p.parse_args(argv)
    cfg = AlertConfig(as_of=a.as_of, day=a.day, all_days=a.all_days, percentile=a.percentile)
    spark = SparkSession.builder.appName("kpiwatch-alerts").getOrCreate()
    run_job(spark, a.dialed, a.tat, a.thresholds, a.owners, a.links, a.alerts_out, a.messages_out, cfg)


if __name__ == "__main__":
    main()
