"""The two input marts, derived from the shared test tables.

The job reads an aggregated funnel mart (``outbound_dialed``) and a
request-grain turnaround mart (``outbound_tat``).  These builders derive both
from ``events`` (a daily mart) and from ``lineitem/orders/customer`` (a monthly
mart) so that every query's work grows with the data.  Invented mapping:

* events: dated = day of ``ts``; vertical = event type, upper-cased for every
  fifth user (mixed case on purpose); order type from ``user_id % 3``; funnel
  stages are users with a value >= 2 / 5 / 20; turnaround = value, 2x, 3x.
* orders: dated = first day of the order month; vertical = market segment;
  order type = order priority; funnel stages are orders with a discounted line,
  a returned line, a finished line; turnaround = quantity x 2 / 3 / 5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiwatch.operators.distinct import count_flagged, distinct_counts
from kpiwatch.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed values of the invented mapping.
# ---------------------------------------------------------------------------
EVENTS_ORDER_TYPES_DIALED = ("Instant", "Scheduled", "Rental")
EVENTS_ORDER_TYPES_TAT = ("instant", "scheduled", "Rental")
EVENTS_STAGE_MIN_VALUE = (2, 5, 20)
EVENTS_TAT_FACTORS = (1, 2, 3)
ORDERS_MAX_DISCOUNT = 0.08
ORDERS_TAT_FACTORS = (2, 3, 5)
# ---------------------------------------------------------------------------

STAGES = ("unique_requests_dialed", "unique_requests_attempted", "unique_requests_connected")
TAT_COLUMNS = ("first_dialed_tat", "first_attempted_time", "first_connected_time")


def _events_vertical() -> Column:
    return F.when(F.col("user_id") % 5 == 0, F.upper("event_type")).otherwise(F.col("event_type"))


def _events_order_type(names) -> Column:
    m = F.col("user_id") % 3
    return F.when(m == 0, F.lit(names[0])).when(m == 1, F.lit(names[1])).otherwise(F.lit(names[2]))


def events_dialed(events: DataFrame) -> DataFrame:
    """Daily funnel mart over ``events``: distinct users per funnel stage."""
    rows = events.select(
        F.col("ts").cast("date").alias("dated"),
        _events_vertical().alias("vertical"),
        _events_order_type(EVENTS_ORDER_TYPES_DIALED).alias("order_type"),
        "user_id", "value",
    )
    conds = {s: F.col("value") >= v for s, v in zip(STAGES, EVENTS_STAGE_MIN_VALUE)}
    return distinct_counts(rows, ["dated", "vertical", "order_type"], "user_id", conds,
                           rows_as="total_requests", distinct_as="unique_request").select(
        "dated", "vertical", "order_type", "total_requests", "unique_request", *STAGES)


def events_tat(events: DataFrame) -> DataFrame:
    """Request-grain turnaround mart over ``events`` (one row per event)."""
    v = F.col("value")
    tat = [F.when(v >= lo, v * f).alias(c)
           for c, lo, f in zip(TAT_COLUMNS, EVENTS_STAGE_MIN_VALUE, EVENTS_TAT_FACTORS)]
    return events.select(
        F.col("ts").cast("date").alias("dated"),
        _events_vertical().alias("vertical"),
        _events_order_type(EVENTS_ORDER_TYPES_TAT).alias("order_type"),
        *tat,
    )


def _order_month() -> Column:
    return F.trunc(F.col("o_orderdate").cast("date"), "month").alias("dated")


def order_keys(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One row per order with its report keys: month, segment, priority.

    Orders meet customers before any line is joined, so the line-level data
    is shuffled once (on the order key) and never on the customer key.
    """
    return (orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
            .join(customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
            .select("o_orderkey", _order_month(), F.col("c_mktsegment").alias("vertical"),
                    "o_orderpriority"))


def orders_dialed(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Monthly funnel mart: distinct orders per (month, segment, priority) and stage.

    The per-order flags are aggregated on ``lineitem`` before the join (an order
    fixes all keys), so the join sees one row per order instead of per line and
    its input is already partitioned on the order key.
    """
    flags = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.max(F.when(F.col("l_discount") <= ORDERS_MAX_DISCOUNT, F.lit(1))).alias(STAGES[0]),
        F.max(F.when(F.col("l_returnflag") != "N", F.lit(1))).alias(STAGES[1]),
        F.max(F.when(F.col("l_linestatus") == "F", F.lit(1))).alias(STAGES[2]),
    )
    keyed = (flags.join(order_keys(orders, customer), "o_orderkey")
             .select("dated", "vertical", F.col("o_orderpriority").alias("order_type"),
                     "o_orderkey", "_rows", *STAGES))
    return count_flagged(keyed, ["dated", "vertical", "order_type"], "o_orderkey", STAGES,
                         rows_as="total_requests", distinct_as="unique_request")


def orders_tat(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Line-grain monthly turnaround mart (priority lower-cased)."""
    q = F.col("l_quantity")
    f1, f2, f3 = ORDERS_TAT_FACTORS
    lines = lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity", "l_returnflag",
                            "l_linestatus")
    return (lines.join(order_keys(orders, customer), "o_orderkey")
            .select("dated", "vertical", F.lower("o_orderpriority").alias("order_type"),
                    (q * f1).alias(TAT_COLUMNS[0]),
                    F.when(F.col("l_returnflag") != "N", q * f2).alias(TAT_COLUMNS[1]),
                    F.when(F.col("l_linestatus") == "F", q * f3).alias(TAT_COLUMNS[2])))


def events_marts(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame]:
    ev = read_table(spark, data_dir, "events")
    return events_dialed(ev), events_tat(ev)


def orders_marts(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame]:
    li, o, c = (read_table(spark, data_dir, t) for t in ("lineitem", "orders", "customer"))
    return orders_dialed(li, o, c), orders_tat(li, o, c)
