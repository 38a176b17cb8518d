from kpiwatch.sources.sinks import append_table, read_stored, replace_table, shared_dir, write_payloads
from kpiwatch.sources.tables import conform, lowercase_columns
from kpiwatch import schemas

import pytest


def test_replace_replaces_schema(spark, tmp_path):
    p = str(tmp_path / "t")
    replace_table(spark.createDataFrame([(1, "a")], "x long, y string"), p)
    replace_table(spark.createDataFrame([(2.5,)], "z double"), p)
    df = read_stored(spark, p)
    assert df.columns == ["z"] and df.count() == 1


def test_append_creates_then_appends(spark, tmp_path):
    p = str(tmp_path / "a")
    append_table(spark.createDataFrame([(1,)], "x long"), p)
    append_table(spark.createDataFrame([(2,), (3,)], "x long"), p)
    assert sorted(r.x for r in read_stored(spark, p).collect()) == [1, 2, 3]


def test_catalog_table_append_matches_by_name(spark):
    spark.sql("DROP TABLE IF EXISTS kpi_sink_t")
    append_table(spark.createDataFrame([(1, "a")], "x long, y string"), "kpi_sink_t")
    append_table(spark.createDataFrame([("b", 2)], "y string, x long"), "kpi_sink_t")
    assert sorted(tuple(r) for r in spark.table("kpi_sink_t").collect()) == [(1, "a"), (2, "b")]


def test_payload_sink_keeps_one_message_per_day(spark, tmp_path):
    import datetime as dt
    p = str(tmp_path / "msg")
    rows = [(dt.date(2024, 1, 15), "a"), (dt.date(2024, 1, 16), "b")]
    write_payloads(spark.createDataFrame(rows, "dated date, payload string"), p)
    again = spark.createDataFrame([(dt.date(2024, 1, 15), "c")], "dated date, payload string")
    write_payloads(again, p)
    write_payloads(again, p)
    assert sorted((str(r.dated), r.payload) for r in spark.read.parquet(p).collect()) == [("2024-01-15", "c"), ("2024-01-16", "b")]


@pytest.fixture
def dynamic_overwrite(spark):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    yield
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_replace_leaves_no_old_partition_in_a_dynamic_session(spark, tmp_path, dynamic_overwrite):
    p = str(tmp_path / "t")
    for d in (1, 2):
        replace_table(spark.createDataFrame([(d, "x")], "dated int, v string"), p, partition_by=["dated"])
    assert [r.dated for r in read_stored(spark, p).collect()] == [2]


def test_catalog_table_replace(spark, dynamic_overwrite):
    spark.sql("DROP TABLE IF EXISTS kpi_sink_r")
    replace_table(spark.createDataFrame([(1, "a")], "x long, y string"), "kpi_sink_r", partition_by=["y"])
    replace_table(spark.createDataFrame([(2, "b")], "z long, y string"), "kpi_sink_r", partition_by=["y"])
    assert [tuple(r) for r in spark.table("kpi_sink_r").select("z", "y").collect()] == [(2, "b")]


def test_path_append_matches_by_name_and_refuses_other_columns(spark, tmp_path):
    p = str(tmp_path / "a")
    append_table(spark.createDataFrame([(1, "a")], "x long, y string"), p)
    append_table(spark.createDataFrame([("b", 2)], "y string, x long"), p)
    assert sorted(tuple(r) for r in read_stored(spark, p).collect()) == [(1, "a"), (2, "b")]
    for other in ("x long", "x string, y string", "x long, z string"):
        with pytest.raises(ValueError):
            append_table(spark.createDataFrame([], other), p)


def test_jdbc_reads_are_split_through_a_subquery():
    from kpiwatch.sources.tables import jdbc_options
    assert jdbc_options("SELECT 1", {"url": "u"}) == {"url": "u", "query": "SELECT 1"}
    split = {"url": "u", "partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3"}
    assert jdbc_options("SELECT id FROM t", split) == {**split, "dbtable": "(SELECT id FROM t) q"}


def test_lowercase_and_conform(spark):
    df = spark.createDataFrame([(1, "x")], "N_NATIONKEY long, N_NAME string")
    assert lowercase_columns(df).columns == ["n_nationkey", "n_name"]
    with pytest.raises(ValueError):
        conform(df, schemas.OWNERS)


def test_shared_dir_uses_checkpoint_dir(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_fetch_runs_sql_and_lowercases(spark, small_dir):
    from kpiwatch.sources.tables import fetch, read_table
    nation = read_table(spark, small_dir, "nation")
    df = fetch(spark, "SELECT N_NATIONKEY AS N_KEY FROM {t} WHERE n_regionkey = :r", t=nation, args={"r": 1})
    assert df.columns == ["n_key"] and df.count() == 5
