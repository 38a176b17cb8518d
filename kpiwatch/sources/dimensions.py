"""Dimension tables: thresholds, owner tags and dashboard links.

In production these are tables (``load_dimension``); the rows below are
invented test fixtures.  No dimension carries a broadcast hint: Spark decides by
bytes (``autoBroadcastJoinThreshold``, and AQE by the size it measures).  Keys
are checked when a dimension is loaded, as a repeated key would repeat alerts.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiwatch import schemas
from kpiwatch.functions.columns import _quote
from kpiwatch.sources.tables import conform, load_table

# ---------------------------------------------------------------------------
# Fixed values (invented test fixtures).
# ---------------------------------------------------------------------------

# vertical, order_type, dialed/attempted/connected pct, dialed/attempted/connected tat ("M.SS")
EVENTS_THRESHOLDS = [
    ("click", "instant", 95.0, 90.0, 60.0, 1.0, 3.0, 5.0),
    ("view", "instant", 99.0, 95.0, 80.0, 1.0, 2.0, 4.0),
    ("error", "scheduled", 90.0, 90.0, 60.0, 1.3, 2.0, 5.0),
    ("purchase", "scheduled", 99.0, 99.0, 99.0, 0.5, 0.5, 0.5),
    ("signup", "instant", None, 90.0, 60.0, 1.0, None, 3.0),
]

# The orders thresholds are one rule over segments x priorities.
ORDERS_SEGMENTS = ["automobile", "building", "furniture", "household", "machinery"]
ORDERS_PRIORITIES = ["1-urgent", "2-high", "5-low"]
ORDERS_LIMITS = (99.0, 95.0, 90.0, 1.3, 2.2, 3.5)

DEFAULT_OWNER = "default"
OWNERS = [
    ("click", "<@OWNER1>"),
    ("view", "<@OWNER2>"),
    ("purchase", "<@OWNER1>"),
    ("error", "<@OWNER3>"),
    (DEFAULT_OWNER, "<@OWNER4> <@OWNER5>"),
]

# vertical, link_value (may differ in case from the key), pct dashboard, tat dashboard
PCT_URL = "https://dash.example/pct?start_date={start}&end_date={end}&verticals={value}&period=Day"
TAT_URL = "https://dash.example/tat?vertical={value}&from={start}&to={end}"
LINKS = [
    ("click", "click", PCT_URL, TAT_URL),
    ("view", "VIEW", PCT_URL, TAT_URL),
    ("purchase", "purchase", PCT_URL, TAT_URL),
]

# ---------------------------------------------------------------------------


def orders_thresholds_rows() -> list[tuple]:
    return [(s, p, *ORDERS_LIMITS) for s, p in itertools.product(ORDERS_SEGMENTS, ORDERS_PRIORITIES)]


# The key columns of a dimension, by its schema.
KEYS = {"thresholds": ["vertical", "order_type"], "owners": ["vertical"], "links": ["vertical"]}
_KEYS_OF = ((schemas.THRESHOLDS, KEYS["thresholds"]), (schemas.OWNERS, KEYS["owners"]), (schemas.LINKS, KEYS["links"]))


def checked(df: DataFrame, schema) -> DataFrame:
    """``df``, after a look at its keys: none may repeat, and owners need the
    ``default`` row (else a heading without text would be sent)."""
    keys = next((k for s, k in _KEYS_OF if s == schema), None)
    if keys:
        repeated = df.groupBy(*keys).count().where("count > 1").first()
        if repeated is not None:
            raise ValueError(f"repeated dimension key {tuple(repeated)[:-1]}")
    if schema == schemas.OWNERS and df.where(F.col("vertical") == DEFAULT_OWNER).isEmpty():
        raise ValueError(f"owners have no {DEFAULT_OWNER!r} row")
    return df


def local_dimension(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """A dimension from rows held by the driver, as SQL VALUES, so that Spark
    knows its size."""
    types = [f.dataType.simpleString() for f in schema.fields]
    return spark.sql("SELECT * FROM " + values_sql(rows, schema.names, types, _quote))


def load_dimension(spark: SparkSession, source: str, schema=None, fmt: str | None = None,
                   options: dict | None = None) -> DataFrame:
    """A dimension table from storage, conformed to ``schema``, its keys checked."""
    df = load_table(spark, source, fmt, options=options)
    return df if schema is None else checked(conform(df, schema), schema)


def events_thresholds(spark: SparkSession) -> DataFrame:
    return local_dimension(spark, EVENTS_THRESHOLDS, schemas.THRESHOLDS)


def orders_thresholds(spark: SparkSession) -> DataFrame:
    return local_dimension(spark, orders_thresholds_rows(), schemas.THRESHOLDS)


def owners(spark: SparkSession) -> DataFrame:
    return local_dimension(spark, OWNERS, schemas.OWNERS)


def links(spark: SparkSession) -> DataFrame:
    return local_dimension(spark, LINKS, schemas.LINKS)


def values_sql(rows: list[tuple], columns: list[str], types: list[str],
               quote=lambda s: "'" + s.replace("'", "''") + "'") -> str:
    """The rows as a SQL ``VALUES`` relation; ``quote`` writes a text literal."""
    def lit(v, t):
        if v is None:
            return f"CAST(NULL AS {t})"
        if isinstance(v, str):
            return quote(v)
        return f"CAST({v!r} AS {t})"
    body = ",\n  ".join("(" + ", ".join(lit(v, t) for v, t in zip(r, types)) + ")" for r in rows)
    return f"(VALUES\n  {body}\n) AS t({', '.join(columns)})"
