"""Physical plan checks: scans, pushdown, pruning, no Expand."""

import re

import pyarrow as pa
import pytest

from kpiwatch import schemas
from kpiwatch.operators.funnel import funnel_pct
from kpiwatch.plans.alert import AlertConfig, alerts
from kpiwatch.sources import dimensions as dims
from kpiwatch.sources.marts import events_marts
from kpiwatch.sources.sinks import replace_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString() + "\n" + \
        df._jdf.queryExecution().optimizedPlan().toString()


def formatted(df):
    import io, contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark, small_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("marts")
    d, t = events_marts(spark, small_dir)
    replace_table(d, f"{base}/dialed", partition_by=["dated"])
    replace_table(t, f"{base}/tat", partition_by=["dated"])
    return (spark.read.schema(schemas.DIALED).parquet(f"{base}/dialed"),
            spark.read.schema(schemas.TAT).parquet(f"{base}/tat"))


def scans(text):
    return len(re.findall(r"^\(\d+\) Scan parquet", text, flags=re.M))


def test_one_pass_scans_each_mart_once_and_prunes_partitions(spark, stored):
    df = alerts(*stored, dims.events_thresholds(spark), AlertConfig(as_of="2024-01-16"))
    text = formatted(df)
    assert scans(text) == 1                     # the funnel mart; the turnaround mart was read for its percentiles
    assert text.count("PartitionFilters: [isnotnull(dated") == 1
    assert "BroadcastExchange" in text          # thresholds are small by their bytes
    assert len(df.collect()) == 5               # FIXTURES.md: sf0.001 alerts_day


def test_union_form_scans_no_more(spark, stored):
    one = alerts(*stored, dims.events_thresholds(spark), AlertConfig(all_days=True))
    union = alerts(*stored, dims.events_thresholds(spark), AlertConfig(all_days=True, form="union"))
    assert scans(formatted(union)) == scans(formatted(one))
    assert sorted(one.collect()) == sorted(union.collect())


def test_unknown_form_and_two_days_are_refused(spark, stored):
    with pytest.raises(ValueError):
        AlertConfig(form="onepass")
    with pytest.raises(ValueError):
        alerts(*stored, dims.events_thresholds(spark), AlertConfig(as_of="2024-01-16", day="2024-01-15"))


def test_default_day_is_yesterday_and_prunes(spark, stored):
    df = alerts(*stored, dims.events_thresholds(spark), AlertConfig())
    yesterday = spark.sql("SELECT date_sub(current_date(), 1) AS d").first().d
    assert df.collect() == [] and scans(formatted(df)) == 0   # no turnaround of that day: nothing is left to read
    text = formatted(funnel_pct(stored[0]))
    assert "PartitionFilters: [isnotnull(dated" in text and f"= {yesterday}" in text


def test_percentile_pass_scans_the_day_once_and_reads_only_its_columns(spark, stored):
    """Every pass reads the mart once, pruned to the day; a later pass also by the values it looks for."""
    from kpiwatch.operators import percentiles as module
    from kpiwatch.operators.turnaround import SECONDS
    day = stored[1].where("dated = DATE'2024-01-15'")
    group = "`dated`, `vertical`, `order_type`, _metric"
    counters = module._counted_sql(f"({module._valued_sql(schemas.KEYS, SECONDS)})", group, module.SHIFTS[0])
    picks = spark.sql(module._picks_sql(counters, group, 0.9), df=day)
    text = formatted(picks)
    assert scans(text) == 1 and "PartitionFilters: [isnotnull(dated" in text
    few = picks.toArrow()
    few = few.set_column(few.schema.get_field_index("_open"), "_open", pa.array([True] * few.num_rows))
    some, wanted = module._narrowed(stored[1], few, schemas.KEYS, {"dialed_sec": "first_dialed_tat"})
    near = module.near_rows(some, spark.createDataFrame(few), schemas.KEYS, wanted, module.SHIFTS[0])
    text = formatted(near)
    assert scans(text) == 1 and re.search(r"PartitionFilters: \[[^\n]*2024-01-15", text)
    assert "GreaterThanOrEqual(first_dialed_tat" in text and "first_connected_time" not in text
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_nothing_is_broadcast_and_nothing_is_quadratic_without_small_tables(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = alerts(*stored, dims.events_thresholds(spark), AlertConfig(all_days=True))
        text = formatted(df)
        for bad in ("Broadcast", "CartesianProduct", "ObjectHashAggregate"):
            assert bad not in text, bad
        assert text.count("SortMergeJoin") >= 2
        assert len(df.collect()) == 281             # FIXTURES.md: sf0.001 alerts_all_days
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_raw_day_filter_reaches_the_scan_and_columns_are_pruned(spark, small_dir):
    df = alerts(*events_marts(spark, small_dir), dims.events_thresholds(spark),
                AlertConfig(as_of="2024-01-16"))
    text = formatted(df)
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in text and "LessThan(ts,2024-01-16T00:00)" in text
    for schema in re.findall(r"ReadSchema: (struct<[^\n]*>)", text):
        assert "props" not in schema and "event_id" not in schema


def test_marts_count_distinct_without_expand(spark, small_dir):
    d, _ = events_marts(spark, small_dir)
    assert "Expand" not in formatted(d)


def test_sql_form_plans_like_the_dataframe_form(spark, stored):
    from kpiwatch.plans.sql import alerts_sql
    df = alerts_sql(spark, *stored, dims.events_thresholds(spark), as_of="2024-01-16")
    text = formatted(df)
    assert scans(text) == 1 and text.count("PartitionFilters: [isnotnull(dated") == 1
    one = alerts(*stored, dims.events_thresholds(spark), AlertConfig(as_of="2024-01-16"))
    assert df.columns == one.columns
    assert sorted(df.collect()) == sorted(one.collect())


def test_no_registered_query_plans_a_cross_join_or_expand(spark, small_dir):
    from kpiwatch.plans.queries import queries
    for name, fn in queries().items():
        text = formatted(fn(spark, small_dir))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Expand"):
            assert bad not in text, (name, bad)
