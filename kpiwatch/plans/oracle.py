"""Reference SQL for every registered query, in the DuckDB dialect.

Each text restates the job's semantics for another engine (CTEs, one
UNION ALL branch per rule, DuckDB's own quantile_cont) over views of the
shared tables, so it checks the Spark plans independently.  Two deliberate notes:

* percentages use exact half-up integer arithmetic, because DuckDB divides
  decimals in DOUBLE while Spark keeps DECIMAL (the text must read "87.50");
* a zero denominator gives NULL (no alert), in both engines;
* sums are cast to BIGINT, the type Spark gives a sum of BIGINT (DuckDB widens
  to HUGEINT).
"""

from __future__ import annotations

from kpiwatch import schemas
from kpiwatch.sources import dimensions as dims
from kpiwatch.sources import marts

EVENTS_AS_OF = "2024-01-16"
ORDERS_DAY = "1998-03-01"
PERIOD_START = "2024-01-06"
PERIOD_QUANTILES = (0.5, 0.9, 0.99)
WINDOW_DAYS = 7

# The rules and texts of this side, stated on their own so that the two sides check each other:
# (metric name, measured column, threshold column, comparison that alerts, unit).
RULES = (
    ("Dialed %", "dialed_pct", "dialed_pct_threshold", "<", " %"),
    ("Attempted %", "attempted_pct", "attempted_pct_threshold", "<", " %"),
    ("Connected %", "connected_pct", "connected_pct_threshold", "<", " %"),
    ("Dialed Tat", "dialed_tat", "dialed_tat_threshold", ">", " min"),
    ("Attempted Tat", "attempted_tat", "attempted_tat_threshold", ">", " min"),
    ("Connected Tat", "connected_tat", "connected_tat_threshold", ">", " min"),
)

_THR_TYPES = ["VARCHAR", "VARCHAR"] + ["DOUBLE"] * 6
_THR_COLS = ["vertical", "order_type", *schemas.THRESHOLD_COLUMNS]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _vertical() -> str:
    return "CASE WHEN user_id % 5 = 0 THEN upper(event_type) ELSE event_type END"


def _order_type(names) -> str:
    a, b, c = (_q(n) for n in names)
    return f"CASE WHEN user_id % 3 = 0 THEN {a} WHEN user_id % 3 = 1 THEN {b} ELSE {c} END"


def events_dialed_sql() -> str:
    d, a, c = marts.EVENTS_STAGE_MIN_VALUE
    return f"""
SELECT CAST(ts AS DATE) AS dated, {_vertical()} AS vertical,
  {_order_type(marts.EVENTS_ORDER_TYPES_DIALED)} AS order_type,
  count(*) AS total_requests, count(DISTINCT user_id) AS unique_request,
  count(DISTINCT CASE WHEN value >= {d} THEN user_id END) AS unique_requests_dialed,
  count(DISTINCT CASE WHEN value >= {a} THEN user_id END) AS unique_requests_attempted,
  count(DISTINCT CASE WHEN value >= {c} THEN user_id END) AS unique_requests_connected
FROM events GROUP BY 1, 2, 3"""


def events_tat_sql() -> str:
    (d, a, c), (f1, f2, f3) = marts.EVENTS_STAGE_MIN_VALUE, marts.EVENTS_TAT_FACTORS
    return f"""
SELECT CAST(ts AS DATE) AS dated, {_vertical()} AS vertical,
  {_order_type(marts.EVENTS_ORDER_TYPES_TAT)} AS order_type,
  CASE WHEN value >= {d} THEN value * {f1} END AS first_dialed_tat,
  CASE WHEN value >= {a} THEN value * {f2} END AS first_attempted_time,
  CASE WHEN value >= {c} THEN value * {f3} END AS first_connected_time
FROM events"""


_ORDERS_FROM = """FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey"""


def orders_dialed_sql() -> str:
    return f"""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS dated, c_mktsegment AS vertical,
  o_orderpriority AS order_type, count(*) AS total_requests, count(DISTINCT o_orderkey) AS unique_request,
  count(DISTINCT CASE WHEN l_discount <= CAST({marts.ORDERS_MAX_DISCOUNT} AS DOUBLE) THEN o_orderkey END) AS unique_requests_dialed,
  count(DISTINCT CASE WHEN l_returnflag <> 'N' THEN o_orderkey END) AS unique_requests_attempted,
  count(DISTINCT CASE WHEN l_linestatus = 'F' THEN o_orderkey END) AS unique_requests_connected
{_ORDERS_FROM} GROUP BY 1, 2, 3"""


def orders_tat_sql() -> str:
    f1, f2, f3 = marts.ORDERS_TAT_FACTORS
    return f"""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS dated, c_mktsegment AS vertical,
  lower(o_orderpriority) AS order_type, l_quantity * {f1} AS first_dialed_tat,
  CASE WHEN l_returnflag <> 'N' THEN l_quantity * {f2} END AS first_attempted_time,
  CASE WHEN l_linestatus = 'F' THEN l_quantity * {f3} END AS first_connected_time
{_ORDERS_FROM}"""


def _day_pred(as_of=None, day=None) -> str:
    if day is not None:
        return f"WHERE dated = DATE '{day}'"
    if as_of is not None:
        return f"WHERE dated = DATE '{as_of}' - 1"
    return ""


def _pct(num: str, den: str = "sum(unique_request)") -> str:
    b = f"nullif({den}, 0)"
    return (f"CAST(CAST((20000 * CAST({num} AS HUGEINT) + {b}) // (2 * {b}) AS DECIMAL(20,0)) * 0.01 "
            f"AS DECIMAL(27,2))")


def _mss(s: str) -> str:
    """As text, minutes and two digits of seconds, read as a number; up to 60 seconds have no minutes."""
    n = f"CAST({s} AS BIGINT)"
    return (f"CASE WHEN {s} > 60 THEN CAST(printf('%d.%02d', {n} // 60, {n} % 60) AS DOUBLE) "
            f"WHEN {s} IS NOT NULL THEN CAST({n} AS DOUBLE) / 100 END")


def stage_ctes(source: str = "events", as_of=None, day=None, thresholds: str | None = None) -> str:
    """CTEs mart_funnel, mart_tat, limits, funnel, p90_sec, p90_min, measured, judged."""
    if source == "events":
        dialed, tat = events_dialed_sql(), events_tat_sql()
        thr_rows = dims.EVENTS_THRESHOLDS
    else:
        dialed, tat = orders_dialed_sql(), orders_tat_sql()
        thr_rows = dims.orders_thresholds_rows()
    thr = thresholds or dims.values_sql(thr_rows, _THR_COLS, _THR_TYPES)
    pred = _day_pred(as_of, day)
    sums = ",\n      ".join(f"CAST(sum({c}) AS BIGINT) AS {n}" for c, n in (
        ("total_requests", "total_request"), ("unique_request", "unique_request"),
        ("unique_requests_dialed", "unique_requests_dialed"),
        ("unique_requests_attempted", "unique_requests_attempted"),
        ("unique_requests_connected", "unique_requests_connected")))
    limits = ", ".join(f"l.{c}" for c in schemas.THRESHOLD_COLUMNS)
    return f"""
mart_funnel AS ({dialed}),
mart_tat AS ({tat}),
limits AS (SELECT * FROM {thr}),
funnel AS (
  SELECT *,
    {_pct('unique_requests_dialed', 'unique_request')} AS dialed_pct,
    {_pct('unique_requests_attempted', 'unique_request')} AS attempted_pct,
    {_pct('unique_requests_connected', 'unique_request')} AS connected_pct
  FROM (
    SELECT dated, lower(vertical) AS vertical, lower(order_type) AS order_type,
      {sums}
    FROM mart_funnel {pred} GROUP BY ALL) s),
p90_sec AS (
  SELECT dated, vertical, order_type,
    round(quantile_cont(first_dialed_tat, 0.9)) AS dialed_sec,
    round(quantile_cont(first_attempted_time, 0.9)) AS attempted_sec,
    round(quantile_cont(first_connected_time, 0.9)) AS connected_sec
  FROM mart_tat {pred} GROUP BY ALL),
p90_min AS (
  SELECT dated, lower(vertical) AS vertical, order_type,
    {_mss('dialed_sec')} AS dialed_tat,
    {_mss('attempted_sec')} AS attempted_tat,
    {_mss('connected_sec')} AS connected_tat
  FROM p90_sec),
measured AS (
  SELECT f.*, m.dialed_tat, m.attempted_tat, m.connected_tat
  FROM funnel f JOIN p90_min m
    ON m.dated = f.dated AND m.vertical = f.vertical AND m.order_type = f.order_type),
judged AS (
  SELECT m.*, {limits}
  FROM measured m LEFT JOIN limits l ON l.vertical = m.vertical AND l.order_type = m.order_type)"""


def branch_sql(rule) -> str:
    name, column, threshold, op, unit = rule
    return f"""SELECT dated, vertical, order_type, {_q(name)} AS metric_name,
  concat(CAST({column} AS VARCHAR), {_q(unit)}) AS metric_value,
  CAST({threshold} AS DOUBLE) AS metric_threshold
FROM judged WHERE {column} {op} {threshold}"""


def breached_ctes(source="events", as_of=None, day=None) -> str:
    branches = "\n  UNION ALL\n".join(f"({branch_sql(r)})" for r in RULES)
    return stage_ctes(source, as_of, day) + f",\nbreached AS (\n{branches})"


def alerts_sql(source="events", as_of=None, day=None) -> str:
    return f"WITH {breached_ctes(source, as_of, day)}\nSELECT * FROM breached ORDER BY dated, vertical, order_type, metric_name"


_PCT_DOUBLE = ("CAST(dialed_pct AS DOUBLE) AS dialed_pct, CAST(attempted_pct AS DOUBLE) AS attempted_pct, "
               "CAST(connected_pct AS DOUBLE) AS connected_pct")
_FUNNEL_COUNTS = ("dated, vertical, order_type, total_request, unique_request, unique_requests_dialed, "
                  "unique_requests_attempted, unique_requests_connected")


def _message_ctes() -> str:
    owners = dims.values_sql(dims.OWNERS, ["vertical", "tag"], ["VARCHAR", "VARCHAR"])
    links = dims.values_sql(dims.LINKS, ["vertical", "link_value", "pct_url", "tat_url"], ["VARCHAR"] * 4)
    start = f"strftime(dv.dated - INTERVAL {WINDOW_DAYS} DAY, '%Y-%m-%d')"
    end = "strftime(dv.dated, '%Y-%m-%d')"

    return f""",
alerts AS (SELECT * FROM breached),
owners AS (SELECT * FROM {owners}),
links AS (SELECT * FROM {links}),
dv AS (SELECT DISTINCT dated, vertical FROM alerts),
dressed AS (
  SELECT dv.dated, dv.vertical,
    coalesce(o.tag, (SELECT tag FROM owners WHERE vertical = {_q(dims.DEFAULT_OWNER)})) AS owner_tag,
    'https://dash.example/pct?start_date=' || {start} || '&end_date=' || {end} || '&verticals=' || l.link_value || '&period=Day' AS pct_link,
    'https://dash.example/tat?vertical=' || l.link_value || '&from=' || {start} || '&to=' || {end} AS tat_link
  FROM dv LEFT JOIN owners o ON o.vertical = dv.vertical LEFT JOIN links l ON l.vertical = dv.vertical),
days AS (SELECT DISTINCT dated FROM alerts),
block_rows AS (
  SELECT dated, 0 AS grp, '' AS vertical, 0 AS kind, '' AS order_type, '' AS metric_name, '' AS metric_value,
    'header' AS block_type, 'plain_text' AS text_type, '🚨 Outbound Alerts' AS text,
    CAST(NULL AS VARCHAR) AS field1, CAST(NULL AS VARCHAR) AS field2 FROM days
  UNION ALL
  SELECT dated, 0, '', 1, '', '', '', 'divider', NULL, NULL, NULL, NULL FROM days
  UNION ALL
  SELECT dated, 1, vertical, 2, '', '', '', 'section', 'mrkdwn',
    '🚀 *' || upper(vertical) || '* ' || owner_tag, NULL, NULL FROM dressed
  UNION ALL
  SELECT dated, 1, vertical, 3, '', '', '', 'section', 'mrkdwn',
    '📈 *PCT Card Link:* <' || pct_link || '|View Dashboard> 📈 *TAT Card Link:* <' || tat_link || '|View Dashboard>', NULL, NULL
  FROM dressed WHERE pct_link IS NOT NULL
  UNION ALL
  SELECT dated, 1, vertical, 4, order_type, metric_name, metric_value, 'section', NULL, NULL,
    '*' || metric_name || '* (' || order_type || ')', '*' || metric_value || '*' FROM alerts
  UNION ALL
  SELECT dated, 1, vertical, 5, '', '', '', 'divider', NULL, NULL, NULL, NULL FROM dressed),
blocks AS (
  SELECT dated, row_number() OVER (PARTITION BY dated
      ORDER BY grp, vertical, kind, order_type, metric_name, metric_value) AS block_no,
    block_type, text_type, text, field1, field2
  FROM block_rows)"""


def oracle_sql() -> dict[str, str]:
    ev_day = dict(source="events", as_of=EVENTS_AS_OF)
    out: dict[str, str] = {}
    out["funnel_pct"] = (f"WITH {stage_ctes(**ev_day)}\n"
                         f"SELECT {_FUNNEL_COUNTS}, {_PCT_DOUBLE} FROM funnel")
    out["tat_p90_seconds"] = f"WITH {stage_ctes(**ev_day)}\nSELECT * FROM p90_sec"
    out["tat_p90_sorted"] = f"WITH {stage_ctes('events')}\nSELECT * FROM p90_sec"
    out["tat_p90_histograms"] = out["tat_p90_sorted"]
    out["tat_period_quantiles"] = "\nUNION ALL\n".join(
        f"SELECT vertical, order_type, round(quantile_cont(first_dialed_tat, {q})) AS dialed_sec, "
        f"round(quantile_cont(first_attempted_time, {q})) AS attempted_sec, "
        f"round(quantile_cont(first_connected_time, {q})) AS connected_sec, CAST({q} AS DOUBLE) AS q\n"
        f"FROM ({events_tat_sql()}) m WHERE dated BETWEEN DATE '{PERIOD_START}' AND DATE '{EVENTS_AS_OF}' GROUP BY 1, 2"
        for q in PERIOD_QUANTILES)
    out["tat_minutes"] = f"WITH {stage_ctes(**ev_day)}\nSELECT * FROM p90_min"
    out["dialed_tat_join"] = (f"WITH {stage_ctes(**ev_day)}\nSELECT {_FUNNEL_COUNTS}, {_PCT_DOUBLE}, "
                              "dialed_tat, attempted_tat, connected_tat FROM measured")
    out["threshold_join"] = (f"WITH {stage_ctes(**ev_day)}\nSELECT {_FUNNEL_COUNTS}, {_PCT_DOUBLE}, "
                             "dialed_tat, attempted_tat, connected_tat, "
                             + ", ".join(schemas.THRESHOLD_COLUMNS) + " FROM judged")
    for r in RULES:
        out[f"breach_{r[1]}"] = f"WITH {stage_ctes(**ev_day)}\n{branch_sql(r)}"
    out["alerts_union"] = alerts_sql(**ev_day)
    out["alerts_day"] = alerts_sql(**ev_day)
    out["alerts_all_days"] = alerts_sql("events")
    out["alerts_orders_month"] = alerts_sql("orders", day=ORDERS_DAY)
    out["alerts_orders_all"] = alerts_sql("orders")
    out["alerts_all_days_sorted"] = alerts_sql("events")
    out["alerts_day_sql"] = alerts_sql(**ev_day)
    out["alerts_orders_all_sql"] = alerts_sql("orders")
    msg = f"WITH {breached_ctes('events')}{_message_ctes()}\n"
    out["report_window"] = (f"WITH {breached_ctes('events')}\nSELECT DISTINCT dated, "
                            f"strftime(dated - INTERVAL {WINDOW_DAYS} DAY, '%Y-%m-%d') AS start_date, "
                            "strftime(dated, '%Y-%m-%d') AS end_date FROM breached")
    out["alert_owners"] = (msg + "SELECT a.*, d.owner_tag FROM alerts a JOIN dressed d "
                           "ON a.dated = d.dated AND a.vertical = d.vertical")
    out["alert_links"] = msg + "SELECT dated, vertical, pct_link, tat_link FROM dressed"
    out["alert_blocks"] = msg + "SELECT * FROM blocks"
    out["alert_payload"] = msg + """, block_json AS (
  SELECT dated, block_no, CASE
    WHEN block_type = 'divider' THEN json_object('type', block_type)
    WHEN field1 IS NULL THEN json_object('type', block_type, 'text', json_object('type', text_type, 'text', text))
    ELSE json_object('type', block_type, 'fields', json_array(
      json_object('type', 'mrkdwn', 'text', field1), json_object('type', 'mrkdwn', 'text', field2)))
  END::VARCHAR AS j FROM blocks)
SELECT dated, '{"blocks":[' || string_agg(j, ',' ORDER BY block_no) || ']}' AS payload
FROM block_json GROUP BY dated"""
    out["alert_payload_sql"] = out["alert_payload"]
    mart = f"SELECT * FROM ({events_dialed_sql()}) m"
    out["sink_replace"] = mart
    out["sink_append"] = mart
    out["sink_messages"] = out["sink_messages_source"] = out["alert_payload"]
    out["alerts_committed"] = alerts_sql("events")
    out["lowercase_columns"] = "SELECT * FROM customer"
    return out
