"""Driver contract: entry, registry and SQL oracle agree at sf0.001."""

import importlib.util
import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _load(name, path):
    spec = importlib.util.spec_from_file_location(name, path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


entry_mod = _load("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
check = _load("check_oracle", os.path.join(ROOT, "tools", "check_oracle.py"))


def test_entry_flagship(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["dated", "vertical", "order_type", "metric_name", "metric_value", "metric_threshold"]
    assert df.count() == 5


OWN = sorted(n for n in entry_mod.queries() if not n.startswith("op") and n != "pipeline")  # the optional part has its own tests


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, small_dir, name):
    df = entry_mod.queries()[name](spark, small_dir)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    rel = check.duck(small_dir).sql(entry_mod.oracle_sql()[name])
    dcols, dtypes, drows = rel.columns, rel.types, rel.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert check.type_diff(df.schema, dcols, dtypes) == {}
    assert len(srows) == len(drows)
    assert check.digest(scols, srows)[0] == check.digest(dcols, drows)[0]
