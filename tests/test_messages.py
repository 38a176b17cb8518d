import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kpiwatch.sources.messages import read_messages, store_messages


def _rows(spark, rows, parts=2):
    return spark.createDataFrame([(dt.date.fromisoformat(d) if d else None, p) for d, p in rows], "dated date, payload string").repartition(parts)


def _held(spark, path):
    got = [(str(r.dated), r.payload) for r in read_messages(spark, path).collect()]
    assert len(got) == len({d for d, _ in got})
    return dict(got)


def test_days_are_replaced_and_overwritten(spark, tmp_path):
    p = str(tmp_path / "m")
    assert _held(spark, p) == {}
    store_messages(_rows(spark, [("2024-01-01", "a\nb"), ("2024-01-02", "ü\"")], 3), p)
    store_messages(_rows(spark, [("2024-01-02", None), ("2024-01-03", "")]), p)
    assert _held(spark, p) == {"2024-01-01": "a\nb", "2024-01-02": None, "2024-01-03": ""}
    store_messages(_rows(spark, []), p)
    assert len(_held(spark, p)) == 3
    store_messages(_rows(spark, [("2024-02-01", "x" * 100_000)]), f"file:{p}", "overwrite")
    assert _held(spark, p) == {"2024-02-01": "x" * 100_000}


@pytest.mark.parametrize("bad", [[("2024-01-02", "b"), ("2024-01-02", "c")], [("2024-01-02", "b"), (None, "c")]])
def test_refused_write_leaves_what_was_there(spark, tmp_path, bad):
    p = str(tmp_path / "m")
    store_messages(_rows(spark, [("2024-01-01", "a")]), p)
    with pytest.raises(PySparkException, match="more than one message|without a day"):
        store_messages(_rows(spark, bad, 4), p)
    assert _held(spark, p) == {"2024-01-01": "a"}
    assert len(os.listdir(f"{p}/runs")) == 1


def test_aborted_task_leaves_what_was_there(spark, tmp_path):
    p = str(tmp_path / "m")
    store_messages(_rows(spark, [("2024-01-01", "a")]), p)
    days = spark.range(0, 40, numPartitions=4).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("dated"), F.when(F.col("id") == 35, F.raise_error(F.lit("lost on the way"))).otherwise("new").alias("payload"))
    with pytest.raises(Exception, match="lost on the way"):
        store_messages(days, p)
    assert _held(spark, p) == {"2024-01-01": "a"}
