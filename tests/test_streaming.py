import json

from pyspark.sql import functions as F

from kpiwatch import schemas
from kpiwatch.sources import dimensions as dims
from kpiwatch.sources.marts import events_marts
from kpiwatch.sources.sinks import append_table
from kpiwatch.streaming import run_incremental
from kpiwatch.streaming.daily import days_report, store_days


def test_incremental_run_reports_each_landed_day_once(spark, small_dir, tmp_path):
    dialed, tat = events_marts(spark, small_dir)
    dpath, tpath, out, cp = (str(tmp_path / n) for n in ("dialed", "tat", "payload", "cp"))
    thr, owners, links = dims.events_thresholds(spark), dims.owners(spark), dims.links(spark)

    def land(day):
        pick = F.col("dated") == F.lit(day).cast("date")
        append_table(tat.where(pick), tpath, partition_by=["dated"])
        append_table(dialed.where(pick), dpath, partition_by=["dated"])

    def run():
        q = run_incremental(spark, dpath, tpath, out, thr, owners, links, checkpoint=cp)
        q.awaitTermination(300)
        assert q.exception() is None

    # Both mart tables exist (empty) before anything lands.
    append_table(dialed.limit(0), dpath, partition_by=["dated"])
    append_table(tat.limit(0), tpath, partition_by=["dated"])
    pick15 = F.col("dated") == F.lit("2024-01-15").cast("date")
    append_table(dialed.where(pick15), dpath, partition_by=["dated"])   # funnel lands first
    run()
    first = {str(r.dated): r.payload for r in spark.read.parquet(out).collect()}
    assert first == {"2024-01-15": None}                                 # no turnaround yet: no metrics
    append_table(tat.where(pick15), tpath, partition_by=["dated"])       # turnaround lands later
    run()
    land("2024-01-16")
    land("2024-01-17")
    run()
    run()  # nothing new: no change
    got = spark.read.parquet(out).collect()
    assert sorted(str(r.dated) for r in got) == ["2024-01-15", "2024-01-16", "2024-01-17"]
    for r in got:
        blocks = json.loads(r.payload)["blocks"]
        assert blocks[0]["type"] == "header" and blocks[-1]["type"] == "divider"


def test_days_table_prunes_the_marts_at_run_time(spark, small_dir, tmp_path):
    dialed, tat = events_marts(spark, small_dir)
    dpath, tpath, days_path = (str(tmp_path / n) for n in ("dialed", "tat", "days"))
    append_table(dialed, dpath, partition_by=["dated"])
    append_table(tat, tpath, partition_by=["dated"])
    one = dialed.where("dated = DATE'2024-01-15'")
    days = store_days(one, days_path, 7)
    store_days(dialed, days_path, 8)
    assert [str(r.dated) for r in days.collect()] == ["2024-01-15"]
    read = spark.read.schema(schemas.DIALED).parquet(dpath).join(days, "dated", "left_semi")
    assert "dynamicpruning" in read._jdf.queryExecution().executedPlan().toString()
    got = days_report(spark, dpath, tpath, days, dims.events_thresholds(spark), dims.owners(spark), dims.links(spark)).collect()
    assert [str(r.dated) for r in got] == ["2024-01-15"] and got[0].payload
