import datetime as dt

from kpiwatch.functions import day_filter_sql, metric_text, minutes_seconds, percent_of, percent_of_sql, report_start

# seconds -> "M.SS" (FIXTURES.md section 3)
CASES = [(0.0, 0.0), (5.0, 0.05), (59.0, 0.59), (60.0, 0.6), (61.0, 1.01), (125.0, 2.05),
         (3599.0, 59.59), (-61.0, -0.61), (None, None)]


def test_minutes_seconds(spark):
    df = spark.createDataFrame([(s,) for s, _ in CASES], "s double")
    got = [r[0] for r in df.select(minutes_seconds("s")).collect()]
    assert got == [m for _, m in CASES]


def test_percent_is_exact_decimal_and_zero_safe(spark):
    df = spark.createDataFrame([(2, 3), (7, 8), (191, 200), (1, 0)], "a long, b long")
    out = df.select(percent_of("a", "b").alias("p"), metric_text(percent_of_sql("a", "b"), " %").alias("t"))
    assert str(out.schema["p"].dataType) == "DecimalType(27,2)"
    rows = out.collect()
    assert [r.t for r in rows] == ["66.67 %", "87.50 %", "95.50 %", None]


def test_tat_text_is_double_text(spark):
    df = spark.createDataFrame([(10.0,), (1.05,), (0.6,)], "m double")
    assert [r[0] for r in df.select(metric_text("m", " min")).collect()] == ["10.0 min", "1.05 min", "0.6 min"]


def test_day_filter(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 15),), (dt.date(2024, 1, 16),)], "dated date")
    assert df.where(day_filter_sql("dated", as_of="2024-01-16")).count() == 1
    assert df.where(day_filter_sql("dated", day="2024-01-16")).collect()[0].dated == dt.date(2024, 1, 16)
    assert day_filter_sql("dated", all_days=True) is None
    assert day_filter_sql("dated") == "dated = date_sub(current_date(), 1)"


def test_report_start(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 15),)], "dated date")
    assert df.select(report_start("dated")).first()[0] == "2024-01-08"


# --- properties against plain-Python definitions ------------------------------

from decimal import ROUND_HALF_UP, Decimal  # noqa: E402

from hypothesis import given, settings, strategies as st  # noqa: E402

from kpiwatch.functions.columns import template_sql  # noqa: E402


def _mss(s):
    if s is None:
        return None
    if s > 60:
        m, r = divmod(int(s), 60)
        return float(Decimal(m * 100 + r) / 100)
    return float((Decimal(int(s)) / 100).quantize(Decimal("0.01"), ROUND_HALF_UP))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-500, 100000).map(float)), min_size=1, max_size=40))
def test_minutes_seconds_matches_definition(spark, secs):
    df = spark.createDataFrame([(s,) for s in secs], "s double")
    assert [r[0] for r in df.select(minutes_seconds("s")).collect()] == [_mss(s) for s in secs]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(0, 10**9)), min_size=1, max_size=40))
def test_percent_is_half_up_of_the_exact_ratio(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r[0] for r in df.select(percent_of("a", "b")).collect()]
    want = [None if b == 0 else (Decimal(100 * a) / Decimal(b)).quantize(Decimal("0.01"), ROUND_HALF_UP)
            for a, b in pairs]
    assert got == want


def test_template_sql_quotes_literals(spark):
    text = template_sql("it's {x} \\ done", x="upper(v)")
    df = spark.createDataFrame([("ok",)], "v string")
    assert df.selectExpr(f"{text} AS t").first().t == "it's OK \\ done"
