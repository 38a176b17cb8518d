"""Outputs that become visible together: alerts, messages and figures of a run."""

import datetime as dt

import pytest

from kpiwatch import schemas
from kpiwatch.plans import job
from kpiwatch.plans.alert import AlertConfig
from kpiwatch.sources import dimensions as dims
from kpiwatch.sources import runs
from kpiwatch.sources.marts import events_marts
from kpiwatch.sources.sinks import replace_table
from kpiwatch.sources.tables import lowercase_columns

PAIR = "dated date, x int"


@pytest.fixture(scope="module")
def inputs(spark, small_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("runs")
    d, t = events_marts(spark, small_dir)
    for name, df in (("dialed", d), ("tat", t)):
        replace_table(df, f"{base}/{name}", partition_by=["dated"])
    for name, df in (("thr", dims.events_thresholds(spark)), ("owners", dims.owners(spark)), ("links", dims.links(spark))):
        replace_table(df, f"{base}/{name}")
    return [f"{base}/{n}" for n in ("dialed", "tat", "thr", "owners", "links")]


def both(spark, root):
    a = runs.committed(spark, root, "alerts", schemas.ALERT)
    m = runs.committed(spark, root, "messages", spark.createDataFrame([], "dated date, payload string").schema)
    return sorted(map(str, a.collect())), sorted(map(str, m.collect()))


def test_failure_between_the_writes_leaves_the_old_pair(spark, inputs, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    assert both(spark, root) == ([], [])
    job.run_committed(spark, *inputs, root, AlertConfig(day="2024-01-15"))
    old = both(spark, root)
    assert len(old[0]) == 5 and len(old[1]) == 1                     # FIXTURES.md: sf0.001 alerts_day
    changed = list(inputs)
    changed[2] = str(tmp_path / "thr")
    replace_table(spark.createDataFrame([], schemas.THRESHOLDS), changed[2])

    def broken(*_):
        raise RuntimeError("lost between the writes")

    with monkeypatch.context() as m:
        m.setattr(job, "alert_payload", broken)
        with pytest.raises(RuntimeError):
            job.run_committed(spark, *changed, root, AlertConfig(day="2024-01-15"))
    assert both(spark, root) == old                                   # alerts were staged, nothing is visible
    job.run_committed(spark, *inputs, root, AlertConfig(day="2024-01-16"))
    assert set(old[0]) < set(both(spark, root)[0])                    # another day is added
    job.run_committed(spark, *inputs, root, AlertConfig(all_days=True))
    assert len(both(spark, root)[0]) == 281                           # FIXTURES.md: sf0.001 alerts_all_days


def test_figures_are_observed_in_the_job(spark, inputs, tmp_path):
    root = str(tmp_path / "out")
    job.run_committed(spark, *inputs, root, AlertConfig(day="2024-01-15"))
    rows = runs.committed(spark, root, "figures", spark.createDataFrame([], job.FIGURES).schema).collect()
    figures = {r.name: r.value for r in rows}
    assert {r.dated for r in rows} == {dt.date(2024, 1, 15)}
    assert figures["alerts"] == 5 and sum(v for k, v in figures.items() if k.startswith("alerts: ")) == 5
    assert figures["tat_rows_read"] == spark.read.parquet(inputs[1]).where("dated = DATE'2024-01-15'").count()
    job.run_committed(spark, *inputs, root, AlertConfig(day="1999-01-01"))  # a day without rows has figures, too
    rows = runs.committed(spark, root, "figures", spark.createDataFrame([], job.FIGURES).schema)
    assert {r.name: r.value for r in rows.where("dated = DATE'1999-01-01'").collect()}["alerts"] == 0


def test_last_run_that_covers_a_day_wins(spark, tmp_path):
    root = str(tmp_path / "out")
    day = lambda n: dt.date(2024, 1, n)
    frame = lambda rows: spark.createDataFrame([(day(n), x) for n, x in rows], PAIR)
    read = lambda: sorted((r.dated.day, r.x) for r in runs.committed(spark, root, "o", frame([]).schema).collect())
    runs.store_run(spark, root, {"o": frame([(1, 1), (2, 2), (3, 3)])})
    runs.store_run(spark, root, {"o": frame([(2, 20)])}, day(2), day(2))
    runs.stage(frame([(1, 99)]), root, runs.new_run(), "o")          # never committed
    assert read() == [(1, 1), (2, 20), (3, 3)]
    runs.store_run(spark, root, {"o": frame([(1, 7)])}, day(1), day(3))
    assert read() == [(1, 7)]                                         # days 2 and 3 are covered and empty now
    runs.store_run(spark, root, {"o": frame([])})
    assert read() == []


def test_names_that_differ_only_in_case_are_refused(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS b").toDF("a", "A")
    with pytest.raises(ValueError, match="differ only in case"):
        lowercase_columns(df)
