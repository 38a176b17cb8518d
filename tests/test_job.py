import json

from kpiwatch import schemas
from kpiwatch.plans.alert import AlertConfig
from kpiwatch.plans.job import run_job
from kpiwatch.sources import dimensions as dims
from kpiwatch.sources.marts import events_marts
from kpiwatch.sources.sinks import replace_table


def test_scheduled_job_stores_rows_and_one_message(spark, small_dir, tmp_path):
    d, t = events_marts(spark, small_dir)
    paths = {n: str(tmp_path / n) for n in ("dialed", "tat", "thr", "owners", "links", "alerts", "msgs")}
    replace_table(d, paths["dialed"], partition_by=["dated"])
    replace_table(t, paths["tat"], partition_by=["dated"])
    replace_table(dims.events_thresholds(spark), paths["thr"])
    replace_table(dims.owners(spark), paths["owners"])
    replace_table(dims.links(spark), paths["links"])
    args = [paths[n] for n in ("dialed", "tat", "thr", "owners", "links", "alerts", "msgs")]
    run_job(spark, *args, AlertConfig(as_of="2024-01-16"))
    run_job(spark, *args, AlertConfig(as_of="2024-01-16"))  # idempotent re-run
    run_job(spark, *args, AlertConfig(as_of="2024-01-17"))  # another day is added
    stored = spark.read.parquet(paths["alerts"])
    assert stored.where("dated = DATE'2024-01-15'").count() == 5   # FIXTURES.md: sf0.001 alerts_day
    msgs = {str(r.dated): r.payload for r in spark.read.parquet(paths["msgs"]).collect()}
    assert set(msgs) == {"2024-01-15", "2024-01-16"}
    blocks = json.loads(msgs["2024-01-15"])["blocks"]
    assert sum(1 for b in blocks if "fields" in b) == 5

    # Thresholds that nothing breaches: re-running the day clears its rows and message.
    relaxed = spark.createDataFrame([], schemas.THRESHOLDS)
    replace_table(relaxed, paths["thr"])
    run_job(spark, *args, AlertConfig(as_of="2024-01-16"))
    stored = spark.read.parquet(paths["alerts"])
    assert stored.where("dated = DATE'2024-01-15'").count() == 0
    assert stored.where("dated = DATE'2024-01-16'").count() > 0
    msgs = {str(r.dated): r.payload for r in spark.read.parquet(paths["msgs"]).collect()}
    assert msgs["2024-01-15"] is None and msgs["2024-01-16"] is not None


def test_command_line_entry(spark, small_dir, tmp_path):
    from kpiwatch.plans.job import main
    d, t = events_marts(spark, small_dir)
    p = {n: str(tmp_path / n) for n in ("dialed", "tat", "thr", "owners", "links", "alerts", "msgs")}
    replace_table(d, p["dialed"], partition_by=["dated"])
    replace_table(t, p["tat"], partition_by=["dated"])
    replace_table(dims.events_thresholds(spark), p["thr"])
    replace_table(dims.owners(spark), p["owners"])
    replace_table(dims.links(spark), p["links"])
    main(["--dialed", p["dialed"], "--tat", p["tat"], "--thresholds", p["thr"], "--owners", p["owners"],
          "--links", p["links"], "--alerts-out", p["alerts"], "--messages-out", p["msgs"], "--all-days"])
    assert spark.read.parquet(p["alerts"]).count() == 281          # FIXTURES.md: sf0.001 alerts_all_days
    assert spark.read.parquet(p["msgs"]).where("payload IS NOT NULL").count() == \
        spark.read.parquet(p["alerts"]).select("dated").distinct().count()
