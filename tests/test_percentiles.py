import math
import random
import struct

import pytest
from hypothesis import given, settings, strategies as st

from kpiwatch.operators import percentiles as module
from kpiwatch.operators.percentiles import histograms, merged, order_key, percentiles, percentiles_hash, percentiles_radix


def _cont(values, q):
    xs = sorted(v for v in values if v is not None)
    if not xs:
        return None
    pos = (len(xs) - 1) * q
    lo, hi = int(pos // 1), int(-(-pos // 1))
    if lo == hi or xs[lo] == xs[hi]:
        return xs[lo]
    return (hi - pos) * xs[lo] + (pos - lo) * xs[hi]


def test_percentile_cont_example(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 2.0), ("g", None), ("g", 4.0)], "k string, x double")
    for fn in (percentiles_hash, percentiles_radix):
        assert fn(df, ["k"], {"p": "x"}, 0.9).first().p == pytest.approx(3.6)


def test_all_null_group_is_kept(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "k string, x double")
    got = {r.k: r.p for r in percentiles_radix(df, ["k"], {"p": "x"}).collect()}
    assert got == {"a": None, "b": 1.0}


def test_hot_group_of_distinct_doubles(spark):
    # one group holds most rows, and no two of its values are equal
    rng = random.Random(7)
    rows = [("hot", rng.random() * 1000) for _ in range(3000)] + [("cold", float(i)) for i in range(7)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r.k: r.p for r in percentiles_radix(df, ["k"], {"p": "x"}, 0.9).collect()}
    assert got["hot"] == pytest.approx(_cont([x for k, x in rows if k == "hot"], 0.9), rel=1e-12)
    assert got["cold"] == pytest.approx(_cont(list(range(7)), 0.9))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(-50, 50).map(float))),
                min_size=1, max_size=60),
       st.sampled_from([0.0, 0.1, 0.5, 0.9, 1.0]))
def test_radix_matches_hash_and_definition(spark, rows, q):
    df = spark.createDataFrame(rows, "k string, x double")
    h = {r.k: r.p for r in percentiles_hash(df, ["k"], {"p": "x"}, q).collect()}
    s = {r.k: r.p for r in percentiles_radix(df, ["k"], {"p": "x"}, q).collect()}
    assert h.keys() == s.keys()
    for k in h:
        want = _cont([x for kk, x in rows if kk == k], q)
        for got in (h[k], s[k]):
            assert (got is None and want is None) or got == pytest.approx(want)


def test_null_key_is_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "k string, x double")
    h = sorted((r.k or "", r.p) for r in percentiles_hash(df, ["k"], {"p": "x"}, 0.5).collect())
    s = sorted((r.k or "", r.p) for r in percentiles_radix(df, ["k"], {"p": "x"}, 0.5).collect())
    assert h == s == [("", 2.0), ("a", 2.0)]


def test_values_of_all_sizes_and_signs(spark):
    xs = [0.0, -0.0, 1e-300, -1e-300, 1e300, -1e300, 0.5, 0.5000001, -0.5, 60.0, 60.0, 61.0]
    df = spark.createDataFrame([("g", x) for x in xs], "k string, x double")
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        assert percentiles_radix(df, ["k"], {"p": "x"}, q).first().p == pytest.approx(_cont(xs, q), rel=1e-9, abs=1e-305)


def _struct_key(x):
    """The double's bits as an ordered integer, from its bytes."""
    if x is None:
        return None
    if math.isnan(x):
        return 2**63 - 1
    bits = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -bits if x < 0 else bits


@settings(max_examples=12, deadline=None)
@given(st.lists(st.floats(allow_nan=True, allow_infinity=True, allow_subnormal=True), min_size=1, max_size=200))
def test_key_is_the_doubles_bits(spark, xs):
    powers = [2.0**e * f for e in (-1074, -1023, -1022, -52, -3, 0, 1, 10, 29, 49, 52, 1023) for f in (1, 1 + 2**-52, 1 - 2**-53)]
    xs = xs + powers + [-p for p in powers] + [0.0, -0.0, 5e-324, 1.7976931348623157e308, math.inf, -math.inf, math.nan]
    df = spark.createDataFrame([(float(x),) for x in xs] + [(None,)], "x double")
    for r in order_key(df, "x", "key").collect():
        assert r.key == _struct_key(r.x), r


@pytest.mark.parametrize("q", [0.0, 0.3, 0.5, 0.9, 1.0])
def test_nan_is_last_and_infinities_have_their_places(spark, q):
    groups = {"nan": [1.0, math.nan, 2.0, 3.0], "inf": [-math.inf, 1.0, 2.0, math.inf, 5.0], "all": [math.nan] * 3,
              "two": [math.inf, math.inf, -1.0], "mix": [math.inf, math.nan, math.nan, -math.inf, 0.0, None]}
    df = spark.createDataFrame([(k, x) for k, xs in groups.items() for x in xs], "k string, x double")
    got = {r.k: r.p for r in percentiles_radix(df, ["k"], {"p": "x"}, q).collect()}
    hashed = {r.k: r.p for r in percentiles_hash(df, ["k"], {"p": "x"}, q).collect()}
    for k, xs in groups.items():
        ordered = sorted((x for x in xs if x is not None), key=_struct_key)
        pos = (len(ordered) - 1) * q
        a, b = ordered[math.floor(pos)], ordered[math.ceil(pos)]
        want = a if _struct_key(a) == _struct_key(b) else (math.ceil(pos) - pos) * a + (pos - math.floor(pos)) * b
        assert _struct_key(got[k]) == _struct_key(want) == _struct_key(hashed[k]), k


def test_many_distinct_values_close_together(spark, monkeypatch):
    """10**5 values within 0.01 percent, and as many within the last bits of the key: every digit is needed."""
    df = spark.range(100_000).selectExpr("id", "1000D + id * 1e-6 AS x", "1D + id * 2.220446049250313e-16D AS y")
    near = df.selectExpr("'g' AS k", "CASE WHEN id % 3 = 0 THEN NULL ELSE x END AS x", "y")
    passes = []
    monkeypatch.setattr(module, "near_rows", lambda *a, f=module.near_rows: passes.append(a[4]) or f(*a))
    for q in (0.123, 0.5, 0.9):
        got = percentiles_radix(near, ["k"], {"px": "x", "py": "y"}, q).first()
        want = percentiles_hash(near, ["k"], {"px": "x", "py": "y"}, q).first()
        assert (got.px, got.py) == (want.px, want.py)
    assert set(passes) == {44, 29, 14}


def test_whole_seconds_need_one_pass(spark, monkeypatch):
    monkeypatch.setattr(module, "near_rows", lambda *a: pytest.fail("a second pass"))
    df = spark.range(5000).selectExpr("id % 4 AS k", "CAST(id * 7919 % 100 AS DOUBLE) AS x")
    got = sorted(map(tuple, percentiles_radix(df, ["k"], {"p": "x"}, 0.9).collect()))
    assert got == sorted(map(tuple, percentiles_hash(df, ["k"], {"p": "x"}, 0.9).collect()))


def test_only_rows_near_the_ranks_are_shuffled(spark, tmp_path, monkeypatch):
    """The picks go to the scan: up to the join, the mart's side has no exchange and no sort."""
    spark.range(20_000).selectExpr("id % 5 AS k", "rand(3) * 1000 AS x", "rand(4) AS unused").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    seen = []
    monkeypatch.setattr(module, "near_rows", lambda *a, f=module.near_rows: seen.append(f(*a)) or seen[-1])
    percentiles_radix(df, ["k"], {"p": "x"}, 0.9).collect()
    assert seen
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange") == 1 and "BroadcastExchange" in plan
    assert "unused" not in plan
    assert seen[0].count() < 20_000 / 20


def test_many_groups_go_by_the_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(module, "DRIVER_PICKS", 10)
    df = spark.range(9000).selectExpr("id % 300 AS k", "rand(5) AS x")
    df = df.where("k != 7").cache()
    got = sorted(map(tuple, percentiles_radix(df, ["k"], {"p": "x"}, 0.9).collect()))
    assert got == sorted(map(tuple, percentiles_hash(df, ["k"], {"p": "x"}, 0.9).collect())) and len(got) == 299


def test_no_task_orders_values(spark):
    """What windows order are counters of one digit: no plan sorts by the value or the key."""
    df = spark.range(1000).selectExpr("id % 3 AS k", "rand(1) AS x")
    text = module._picks_sql("SELECT k, metric AS _metric, prefix AS _p, n AS _w, low AS _lo, high AS _hi FROM {hist}", "k, _metric", 0.9)
    plan = spark.sql(text, hist=histograms(df, ["k"], {"p": "x"}))._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and all("_key" not in line and "_x" not in line for line in plan.splitlines() if "Sort " in line)


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, x double")
    assert percentiles(df, ["k"], {"p": "x"}).collect() == []


def test_histograms_merge_over_days_and_serve_any_quantile(spark):
    df = spark.range(6000).selectExpr("id % 6 AS day", "id % 3 AS k", "CASE WHEN id % 11 != 0 THEN exp(rand(2) * 9) END AS x")
    df = df.cache()
    stored = histograms(df, ["day", "k"], {"p": "x"}).cache()
    for q in (0.1, 0.5, 0.9):
        whole = merged(stored, ["k"])
        got = sorted(map(tuple, percentiles_radix(df, ["k"], {"p": "x"}, q, hist=whole).collect()))
        assert got == sorted(map(tuple, percentiles_hash(df, ["k"], {"p": "x"}, q).collect()))
        by_day = sorted(map(tuple, percentiles_radix(df, ["day", "k"], {"p": "x"}, q, hist=stored).collect()))
        assert by_day == sorted(map(tuple, percentiles_radix(df, ["day", "k"], {"p": "x"}, q).collect()))
