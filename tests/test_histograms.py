"""Stored day histograms: equal to a direct run, replaced by day, reused for other quantiles."""

import pytest
from pyspark.sql import functions as F

from kpiwatch import schemas
from kpiwatch.operators import histograms as hg
from kpiwatch.operators import percentiles as module
from kpiwatch.operators.turnaround import tat_seconds
from kpiwatch.sources.marts import events_marts
from kpiwatch.sources.sinks import replace_table


@pytest.fixture(scope="module")
def mart(spark, small_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("hist")
    _, t = events_marts(spark, small_dir)
    replace_table(t, f"{base}/tat", partition_by=["dated"])
    return spark.read.schema(schemas.TAT).parquet(f"{base}/tat"), str(base)


def rows(df):
    return sorted(map(str, df.collect()))


def test_days_from_histograms_equal_a_direct_run(spark, mart):
    tat, base = mart
    hg.store_histograms(tat, f"{base}/all", all_days=True)
    hist = hg.load_histograms(spark, f"{base}/all")
    assert rows(tat_seconds(tat, all_days=True, hist=hist)) == rows(tat_seconds(tat, all_days=True))
    assert rows(tat_seconds(tat, day="2024-01-15", hist=hist)) == rows(tat_seconds(tat, day="2024-01-15"))


def test_period_merges_days_and_a_second_quantile_reads_no_mart_in_its_first_pass(spark, mart, monkeypatch):
    tat, base = mart
    hg.store_histograms(tat, f"{base}/period", all_days=True)
    hist = hg.load_histograms(spark, f"{base}/period")
    span = tat.where("dated BETWEEN DATE'2024-01-05' AND DATE'2024-01-11'")
    seen = []
    monkeypatch.setattr(module, "near_rows", lambda df, *a, f=module.near_rows: seen.append(df) or f(df, *a))
    for q in (0.5, 0.9):
        direct = span.groupBy("vertical", "order_type").agg(
            *[F.round(F.percentile(src, q)).alias(out) for out, src in hg.SECONDS.items()])
        assert rows(hg.period_seconds(tat, hist, "2024-01-05", "2024-01-11", q=q)) == rows(direct)
    # What is read of the mart is narrowed by the days and by the values looked for.
    for df in seen:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "dated" in plan and "GreaterThanOrEqual(" in plan
    first = spark.sql(module._picks_sql("SELECT vertical, order_type, metric AS _metric, prefix AS _p, n AS _w, low AS _lo, high AS _hi FROM {h}",
                                        "vertical, order_type, _metric", 0.9), h=module.merged(hist, ["vertical", "order_type"]))
    assert f"{base}/tat" not in first._jdf.queryExecution().executedPlan().toString()


def test_writing_a_day_again_replaces_that_day_only(spark, mart):
    tat, base = mart
    path = f"{base}/daily"
    for day in ("2024-01-14", "2024-01-15", "2024-01-15"):
        hg.store_histograms(tat.where(F.col("dated") == day), path)
    hist = hg.load_histograms(spark, path)
    days = tat.where("dated IN (DATE'2024-01-14', DATE'2024-01-15')")
    assert hist.agg(F.sum("n")).first()[0] == days.selectExpr("count(first_dialed_tat) + count(first_attempted_time) + count(first_connected_time)").first()[0]
    assert rows(tat_seconds(days, all_days=True, hist=hist)) == rows(tat_seconds(days, all_days=True))


def test_another_digit_is_refused(spark, mart):
    tat, base = mart
    replace_table(hg.day_histograms(tat).withColumn("shift", F.lit(50)), f"{base}/other")
    with pytest.raises(ValueError, match="shift 50"):
        hg.load_histograms(spark, f"{base}/other")


def test_empty_mart(spark, mart):
    tat, base = mart
    hg.store_histograms(tat.where("false"), f"{base}/none", all_days=True)
    hist = spark.read.schema(hg.day_histograms(tat).schema).parquet(f"{base}/none")
    assert hg.period_seconds(tat.where("false"), hist).collect() == []
