"""Exact continuous percentiles per group (``percentile_cont``).

* ``radix`` (the default): selection by key prefix, coarse first.  A double has an order-preserving 64-bit
  key (:func:`order_key`); NaN comes last, as in Spark's own order.  The first pass counts, for each group, the
  values of each key prefix and keeps their least and greatest value: a histogram (:func:`histograms`), by
  plain hash aggregation with map-side combining.  The running counts name the one or two prefixes that hold the
  ranks around q*(n-1) (the *picks*).  A pick whose least and greatest value are equal, or whose rank is its first
  or last, is settled.  For the others, a further pass reads only rows that share a pick's prefix and
  counts the next digit of their keys.  After four digits the key is whole, so every pick is settled; data
  in whole seconds seldom needs a second pass.  What a task puts in order are one group's counters, at most
  2**20 of them, never a bucket's values.
* ``hash``: Spark's ``percentile`` aggregate, whose state is one group's distinct values.  Kept as a
  cross-check for small groups.

The picks of a pass (two rows at most for each group and metric) are what the next pass filters the mart by.  Up to
``DRIVER_PICKS`` rows of them pass through the driver, so that Spark knows their size: below its broadcast
threshold they go to the scan, and no other row of the mart is shuffled.  Beyond ``DRIVER_PICKS`` they
are stored in the cluster's shared folder, and Spark joins by their stored size.  What a pass reads is narrowed before
that join by plain predicates on the mart's columns, which reach its partitions and files: the days (or other keys) that have
an open pick, where they are few, and the range of values of the open picks of each measured column.

Each pass is one SQL statement, as building a plan step by step costs more than running it on a day's data.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwatch.sources.sinks import shared_dir

#: Low bits of the key that are left out in each pass: digits of 20, 15, 15 and 14 bits.  The first has the sign,
#: the exponent and 8 bits of the fraction: values of one bucket differ by 1/256 of their size at most.
SHIFTS = (44, 29, 14, 0)

#: Up to so many distinct keys with an open pick are told to the scan as a list.
LISTED = 50

#: Picks that may pass through the driver (some 100 bytes each).
DRIVER_PICKS = 100_000

# Fixed values of the IEEE 754 double format.
_LEAST_NORMAL = "2.2250738585072014E-308D"
_GREATEST = "1.7976931348623157E308D"
_FRACTION = "4503599627370496"          # 2**52
_INFINITY_KEY = "9218868437227405312"   # 2047 * 2**52
_NAN_KEY = "9223372036854775807"


def percentiles_hash(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str],
                     q: float = 0.9) -> DataFrame:
    """``percentile(x, q)`` per keys for every ``{output: input}`` column."""
    return df.groupBy(*keys).agg(
        *[F.percentile(F.col(src), F.lit(q)).alias(out) for out, src in columns.items()])


def _q(names: Sequence[str], of: str = "") -> str:
    return ", ".join(f"{of}`{n}`" for n in names)


def _key_sql(relation: str, kept: str, x: str = "_x", key: str = "_key") -> str:
    """The ``kept`` columns of ``relation`` and ``key``: a BIGINT ordered like the doubles of ``x``.

    The magnitude is the double's bit pattern, put together from exponent and fraction (exact, as scaling by
    a power of two is), negative for negative numbers.  -0.0 equals 0.0, NaN is greatest, NULL stays NULL.
    The logarithm may be off by one at a power of two; the powers themselves are exact.
    """
    return f"""SELECT {kept}, CASE WHEN isnan({x}) THEN {_NAN_KEY} ELSE CASE WHEN {x} < 0 THEN -1 ELSE 1 END *
    CASE WHEN abs({x}) > {_GREATEST} THEN {_INFINITY_KEY}
      WHEN abs({x}) < {_LEAST_NORMAL} THEN CAST(abs({x}) * pow(2D, 537) * pow(2D, 537) AS BIGINT)
      ELSE (_e + 1023) * {_FRACTION} + CAST((abs({x}) / pow(2D, _e) - 1) * {_FRACTION} AS BIGINT) END END AS {key}
  FROM (SELECT {kept}, _e + CASE WHEN pow(2D, _e) > abs({x}) THEN -1 WHEN pow(2D, _e + 1) <= abs({x}) THEN 1 ELSE 0 END AS _e
    FROM (SELECT {kept}, CASE WHEN abs({x}) BETWEEN {_LEAST_NORMAL} AND {_GREATEST} THEN floor(log2(abs({x}))) ELSE 0 END AS _e
      FROM {relation}))"""


def order_key(df: DataFrame, x: str, key: str) -> DataFrame:
    """``df`` with the order-preserving key of a double column."""
    return df.sparkSession.sql(_key_sql("{df}", _q(df.columns), x, key), df=df)


def _valued_sql(keys: Sequence[str], columns: Mapping[str, str], where: str = "") -> str:
    """keys, _metric, _x, _key of ``{df}``: one row for each measured value (NULL included)."""
    stack = ", ".join(f"'{out}', CAST(`{src}` AS DOUBLE)" for out, src in columns.items())
    stacked = f"(SELECT {_q(keys)}, stack({len(columns)}, {stack}) AS (_metric, _x) FROM {{df}} {where})"
    return _key_sql(stacked, f"{_q(keys)}, _metric, _x")


def _counted_sql(relation: str, by: str, shift: int) -> str:
    """Counters of the next digit: values (_w), least (_lo) and greatest (_hi), per ``by`` and prefix (_p)."""
    return (f"SELECT {by}, shiftright(_key, {shift}) AS _p, count(_x) AS _w, min(_x) AS _lo, max(_x) AS _hi "
            f"FROM {relation} GROUP BY {by}, shiftright(_key, {shift})")


def histograms(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """keys, metric, prefix, n, low, high: the first digit's counters of every measured column.

    A group whose values are all NULL has one row with prefix NULL and n = 0.  They merge: :func:`merged` adds up
    those of several days or parts, and any quantile can be picked from them (``hist`` of :func:`percentiles_radix`).
    """
    counted = _counted_sql(f"({_valued_sql(keys, columns)})", f"{_q(keys)}, _metric", SHIFTS[0])
    text = f"SELECT {_q(keys)}, _metric AS metric, _p AS prefix, _w AS n, _lo AS low, _hi AS high FROM ({counted})"
    return df.sparkSession.sql(text, df=df)


def merged(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Histograms added up over every key but ``keys``."""
    return hist.groupBy(*keys, "metric", "prefix").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def _within(rank: str) -> str:
    return f"(_base <= {rank} AND {rank} < _base + _w)"


def _told(rank: str) -> str:
    """Whether a pick's least and greatest value tell the value at a rank inside it."""
    return f"(_lo = _hi OR {rank} = _base OR {rank} = _base + _w - 1)"


def _value(rank: str) -> str:
    return f"CASE WHEN {_within(rank)} AND {_told(rank)} THEN CASE WHEN _lo = _hi OR {rank} = _base THEN _lo ELSE _hi END END"


def _picks_sql(counters: str, group: str, q: float | None) -> str:
    """The counters that hold a wanted rank, with what they tell of its value.

    With ``q``, ranks are those of whole groups; else counters carry _pos, _r0, _r1 and _from (the _base) of the pick
    (_pick) that they divide.  A group without values has no position and keeps its empty counter.
    """
    if q is None:
        ranked = (f"SELECT {group}, _p, _w, _lo, _hi, _pos, _r0, _r1, _from - _w "
                  f"+ sum(_w) OVER (PARTITION BY {group}, _pick ORDER BY _p ROWS UNBOUNDED PRECEDING) AS _base FROM ({counters})")
    else:
        pos = f"CAST(_n - 1 AS DOUBLE) * {float(q)!r}D"
        ranked = f"""SELECT {group}, _p, _w, _lo, _hi, _base, CASE WHEN _n > 0 THEN {pos} END AS _pos,
    floor({pos}) AS _r0, ceil({pos}) AS _r1
  FROM (SELECT {group}, _p, _w, _lo, _hi, sum(_w) OVER (PARTITION BY {group}) AS _n,
      sum(_w) OVER (PARTITION BY {group} ORDER BY _p NULLS FIRST ROWS UNBOUNDED PRECEDING) - _w AS _base
    FROM ({counters}))"""
    return f"""SELECT {group}, _p, _pos, _base, _r0, _r1, _lo, _hi, {_value("_r0")} AS _v0, {_value("_r1")} AS _v1,
    ({_within("_r0")} AND NOT {_told("_r0")}) OR ({_within("_r1")} AND NOT {_told("_r1")}) AS _open
  FROM ({ranked}) WHERE {_within("_r0")} OR {_within("_r1")} OR _pos IS NULL"""


def _stored(picks: DataFrame) -> DataFrame:
    """Picks beyond what may pass through the driver, in the cluster's shared folder."""
    path = shared_dir(picks.sparkSession, f"kpiwatch_picks/{uuid.uuid4().hex}")
    picks.write.parquet(path)
    return picks.sparkSession.read.parquet(path)


def _narrowed(df: DataFrame, still: pa.Table, keys: Sequence[str], columns: Mapping[str, str]) -> tuple[DataFrame, dict[str, str]]:
    """The rows of ``df`` that an open pick may hold, by key lists and value ranges, and the columns that have one."""
    for key in keys:
        values = still.column(key).unique().to_pylist()
        if len(values) <= LISTED:
            some = F.col(key).isin([v for v in values if v is not None])
            df = df.where(some | F.col(key).isNull() if None in values else some)
    wanted, ranges = {}, None
    for out, src in columns.items():
        mine = [r for r in still.select(["_metric", "_lo", "_hi"]).to_pylist() if r["_metric"] == out]
        if mine:
            wanted[out] = src
            low, high = min(r["_lo"] for r in mine), [r["_hi"] for r in mine]
            x = F.col(src).cast("double")
            here = x >= low if any(map(math.isnan, high)) else (x >= low) & (x <= max(high))
            ranges = here if ranges is None else ranges | here
    return df.where(ranges), wanted


def near_rows(df: DataFrame, picks: DataFrame, keys: Sequence[str], columns: Mapping[str, str], shift: int) -> DataFrame:
    """The values that share an open pick's prefix, with the pick's ranks.  Null-safe: NULL in a key is a group."""
    on = " AND ".join(f"v.`{c}` <=> p.`{c}`" for c in [*keys, "_metric"])
    return df.sparkSession.sql(
        f"SELECT {_q(keys, 'v.')}, v._metric, v._x, v._key, p._p AS _pick, p._pos, p._base AS _from, p._r0, p._r1 "
        f"FROM ({_valued_sql(keys, columns)}) v "
        f"JOIN {{picks}} p ON {on} AND shiftright(v._key, {shift}) = p._p AND p._open", df=df, picks=picks)


def _assembled(parts: Sequence[pa.Table], keys: Sequence[str], columns: Mapping[str, str]) -> pa.Table:
    """One row per group from settled picks that are few enough for the driver."""
    found: dict[tuple, dict[str, list]] = {}
    for part in parts:
        for r in part.to_pylist():
            one = found.setdefault(tuple(r[k] for k in keys), {}).setdefault(r["_metric"], [r["_pos"], None, None])
            one[1:] = [one[1] if r["_v0"] is None else r["_v0"], one[2] if r["_v1"] is None else r["_v1"]]

    def value(pos: float | None, v0: float | None, v1: float | None) -> float | None:
        if pos is None or v0 == v1 or (math.isnan(v0) and math.isnan(v1)):
            return v0
        return (math.ceil(pos) - pos) * v0 + (pos - math.floor(pos)) * v1

    names = [tuple(of) for of in found]
    data = [pa.array([n[i] for n in names], parts[0].schema.field(k).type) for i, k in enumerate(keys)]
    data += [pa.array([value(*of[out]) for of in found.values()], pa.float64()) for out in columns]
    return pa.table(data, names=[*keys, *columns])


def percentiles_radix(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], q: float = 0.9,
                      hist: DataFrame | None = None) -> DataFrame:
    """Same result as :func:`percentiles_hash`, with bounded tasks.

    Runs the passes (see the module's text) and returns keys and one column for each output.  With ``hist``, the
    :func:`histograms` of ``df``, stored or merged, the first pass reads them and not ``df``.
    """
    spark, group = df.sparkSession, f"{_q(keys)}, _metric"
    if hist is None:
        counters = _counted_sql(f"({_valued_sql(keys, columns)})", group, SHIFTS[0])
        picks = spark.sql(_picks_sql(counters, group, q), df=df)
    else:
        told = f"SELECT {_q(keys)}, metric AS _metric, prefix AS _p, n AS _w, low AS _lo, high AS _hi FROM {{hist}}"
        picks = spark.sql(_picks_sql(told, group, q), hist=hist)
    local: list[pa.Table] = []
    stored: list[DataFrame] = []
    for at, shift in enumerate(SHIFTS):
        few = picks.limit(DRIVER_PICKS + 1).toArrow()
        if few.num_rows <= DRIVER_PICKS:
            local.append(few)
            still = few.filter(few.column("_open"))
            if not still.num_rows:
                break
            some, wanted = _narrowed(df, still, keys, columns)
            known = spark.createDataFrame(still)
        else:
            stored.append(_stored(picks))
            some, wanted, known = df, columns, stored[-1]
            if known.where("_open").isEmpty():
                break
        near = near_rows(some, known, keys, wanted, shift)
        counters = _counted_sql("{near}", f"{group}, _pick, _pos, _from, _r0, _r1", SHIFTS[at + 1])
        picks = spark.sql(_picks_sql(counters, group, None), near=near)
    if not stored and sum(t.num_rows for t in local) <= DRIVER_PICKS:
        return spark.createDataFrame(_assembled(local, keys, columns))
    every = None
    for part in [*stored, *(spark.createDataFrame(t) for t in local if t.num_rows)]:
        every = part if every is None else every.unionByName(part)

    def of(out: str, c: str) -> str:
        return f"max(CASE WHEN _metric = '{out}' THEN {c} END)"

    flat = ", ".join(f"{of(out, c)} AS {c}_{i}" for i, out in enumerate(columns) for c in ("_pos", "_v0", "_v1"))
    between = ", ".join(
        f"CASE WHEN _v0_{i} = _v1_{i} THEN _v0_{i} ELSE (ceil(_pos_{i}) - _pos_{i}) * _v0_{i} "
        f"+ (_pos_{i} - floor(_pos_{i})) * _v1_{i} END AS `{out}`" for i, out in enumerate(columns))
    return spark.sql(f"SELECT {_q(keys)}, {between} FROM (SELECT {_q(keys)}, {flat} FROM {{every}} GROUP BY {_q(keys)})",
                     every=every)


def percentiles(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str],
                q: float = 0.9, method: str = "radix", hist: DataFrame | None = None) -> DataFrame:
    if method == "hash":
        return percentiles_hash(df, keys, columns, q)
    if method == "radix":
        return percentiles_radix(df, keys, columns, q, hist)
    raise ValueError(f"unknown percentile method {method!r}")
