import pytest

from kpiwatch import schemas
from kpiwatch.sources import dimensions as dims
from kpiwatch.sources.sinks import replace_table


def test_load_dimension_from_csv_conforms(spark, tmp_path):
    p = str(tmp_path / "owners.csv")
    (spark.createDataFrame([("click", "<@A>", "extra"), ("default", "<@B>", "x")],
                           "VERTICAL string, TAG string, note string")
     .write.option("header", True).csv(p))
    owners = dims.load_dimension(spark, p, schemas.OWNERS, fmt="csv", options={"header": "true"})
    assert owners.columns == ["vertical", "tag"]
    assert sorted(tuple(r) for r in owners.collect()) == [("click", "<@A>"), ("default", "<@B>")]


def test_no_dimension_is_hinted(spark):
    for df in (dims.events_thresholds(spark), dims.owners(spark), dims.links(spark)):
        assert "broadcast" not in df._jdf.queryExecution().analyzed().toString().lower()


@pytest.mark.parametrize("schema, rows", [
    (schemas.OWNERS, [("default", "<@A>"), ("click", "<@B>"), ("click", "<@C>")]),
    (schemas.LINKS, [("click", "c", "u", "v"), ("click", "c", "u", "w")]),
    (schemas.THRESHOLDS, [("click", "instant", *[1.0] * 6), ("click", "instant", *[2.0] * 6)]),
])
def test_repeated_keys_are_refused_at_load(spark, tmp_path, schema, rows):
    replace_table(spark.createDataFrame(rows, schema), str(tmp_path / "d"))
    with pytest.raises(ValueError, match="repeated"):
        dims.load_dimension(spark, str(tmp_path / "d"), schema)


def test_missing_default_owner_is_refused_at_load(spark, tmp_path):
    replace_table(spark.createDataFrame([("click", "<@B>")], schemas.OWNERS), str(tmp_path / "d"))
    with pytest.raises(ValueError, match="default"):
        dims.load_dimension(spark, str(tmp_path / "d"), schemas.OWNERS)


def test_values_keep_quotes_and_nulls(spark):
    df = dims.local_dimension(spark, [("o'hara", "a\\b")], schemas.OWNERS)
    assert [tuple(r) for r in df.collect()] == [("o'hara", "a\\b")]
