"""Fixed StructTypes of the inputs and outputs the alerting job works with."""

from pyspark.sql import types as T

KEYS = ["dated", "vertical", "order_type"]

# Already aggregated funnel mart: counters are summed again per key.
DIALED = T.StructType([
    T.StructField("dated", T.DateType(), False),
    T.StructField("vertical", T.StringType(), False),
    T.StructField("order_type", T.StringType(), False),
    T.StructField("total_requests", T.LongType(), False),
    T.StructField("unique_request", T.LongType(), False),
    T.StructField("unique_requests_dialed", T.LongType(), False),
    T.StructField("unique_requests_attempted", T.LongType(), False),
    T.StructField("unique_requests_connected", T.LongType(), False),
])

# Request-grain turnaround facts, seconds.
TAT = T.StructType([
    T.StructField("dated", T.DateType(), False),
    T.StructField("vertical", T.StringType(), False),
    T.StructField("order_type", T.StringType(), False),
    T.StructField("first_dialed_tat", T.DoubleType(), True),
    T.StructField("first_attempted_time", T.DoubleType(), True),
    T.StructField("first_connected_time", T.DoubleType(), True),
])

THRESHOLD_COLUMNS = [
    "dialed_pct_threshold", "attempted_pct_threshold", "connected_pct_threshold",
    "dialed_tat_threshold", "attempted_tat_threshold", "connected_tat_threshold",
]

THRESHOLDS = T.StructType(
    [T.StructField("vertical", T.StringType(), False),
     T.StructField("order_type", T.StringType(), False)]
    + [T.StructField(c, T.DoubleType(), True) for c in THRESHOLD_COLUMNS]
)

OWNERS = T.StructType([
    T.StructField("vertical", T.StringType(), False),
    T.StructField("tag", T.StringType(), False),
])

LINKS = T.StructType([
    T.StructField("vertical", T.StringType(), False),
    T.StructField("link_value", T.StringType(), False),
    T.StructField("pct_url", T.StringType(), False),
    T.StructField("tat_url", T.StringType(), False),
])

ALERT = T.StructType([
    T.StructField("dated", T.DateType(), True),
    T.StructField("vertical", T.StringType(), True),
    T.StructField("order_type", T.StringType(), True),
    T.StructField("metric_name", T.StringType(), True),
    T.StructField("metric_value", T.StringType(), True),
    T.StructField("metric_threshold", T.DoubleType(), True),
])

# One message block; absent parts stay NULL and are left out by to_json.
TEXT = T.StructType([
    T.StructField("type", T.StringType(), True),
    T.StructField("text", T.StringType(), True),
])
BLOCK = T.StructType([
    T.StructField("type", T.StringType(), True),
    T.StructField("text", TEXT, True),
    T.StructField("fields", T.ArrayType(TEXT, True), True),
])
