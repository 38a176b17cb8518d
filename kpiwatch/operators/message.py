"""Alert message assembly: owner tags, dashboard links, ordered blocks, JSON.

One pass over the alert rows: alerts are grouped per (dated, vertical), joined
with the owner and link dimensions, turned into that vertical's block list,
then grouped per day into one ordered message.  Both groupings are bounded by
the dimension tables (alerts of a day <= rules x threshold rows), not by the
data volume: ``dimensions.load_dimension`` refuses a dimension with repeated keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiwatch import schemas
from kpiwatch.functions.columns import _quote, iso_date_sql, report_start_sql, template_sql
from kpiwatch.sources.dimensions import DEFAULT_OWNER

# ---------------------------------------------------------------------------
# Message texts and block types.
# ---------------------------------------------------------------------------
HEADER_TEXT = "🚨 Outbound Alerts"
HEADING_TEXT = "🚀 *{vertical}* {tag}"
LINKS_TEXT = "📈 *PCT Card Link:* <{pct}|View Dashboard> 📈 *TAT Card Link:* <{tat}|View Dashboard>"
ALERT_NAME_TEXT = "*{metric_name}* ({order_type})"
ALERT_VALUE_TEXT = "*{metric_value}*"
WINDOW_DAYS = 7
# ---------------------------------------------------------------------------

BLOCK_TYPE = schemas.BLOCK.simpleString()


def _text_sql(kind: str, text: str) -> str:
    return f"named_struct('type', {_quote(kind)}, 'text', {text})"


def _block_sql(kind: str, text: str = "NULL", fields: str = "NULL") -> str:
    """One block as SQL, cast to the block type so every block has one type."""
    return f"CAST(named_struct('type', {_quote(kind)}, 'text', {text}, 'fields', {fields}) AS {BLOCK_TYPE})"


HEADER_SQL = _block_sql("header", _text_sql("plain_text", _quote(HEADER_TEXT)))
DIVIDER_SQL = _block_sql("divider")


def report_window(alerts: DataFrame) -> DataFrame:
    """Per reported day: the dashboard window start (7 days before) and end."""
    return alerts.select("dated").distinct().selectExpr(
        "dated", f"{report_start_sql('dated', WINDOW_DAYS)} AS start_date",
        f"{iso_date_sql('dated')} AS end_date")


def _default_tag(owners: DataFrame) -> Column:
    return owners.where(F.col("vertical") == DEFAULT_OWNER).select("tag").scalar()


def with_owner(df: DataFrame, owners: DataFrame) -> DataFrame:
    """Add ``owner_tag``: the vertical's tag, else the ``default`` row's tag
    (a scalar subquery, evaluated once)."""
    tags = owners.select("vertical", F.col("tag").alias("_tag"))
    return (df.join(tags, "vertical", "left")
            .withColumn("owner_tag", F.coalesce(F.col("_tag"), _default_tag(owners)))
            .drop("_tag"))


def _link_sql(template: str) -> str:
    """The dashboard URL of the row's vertical and day: the links table's own
    template, with {start}, {end} and {value} filled in."""
    fields = (("start", report_start_sql("dated", WINDOW_DAYS)), ("end", iso_date_sql("dated")), ("value", "link_value"))
    for name, value in fields:
        # The braces as characters: spark.sql would take them for parameters of its own.
        template = f"replace({template}, concat(char(123), '{name}', char(125)), {value})"
    return template


def with_links(df: DataFrame, links: DataFrame) -> DataFrame:
    """Add ``pct_link`` and ``tat_link`` for the row's vertical and day (NULL
    when the vertical has no link row)."""
    dim = links.select("vertical", "link_value", "pct_url", "tat_url")
    return (df.join(dim, "vertical", "left")
            .withColumns({"pct_link": F.expr(_link_sql("pct_url")),
                          "tat_link": F.expr(_link_sql("tat_url"))})
            .drop("link_value", "pct_url", "tat_url"))


def vertical_links(alerts: DataFrame, links: DataFrame) -> DataFrame:
    """One row per (dated, vertical) with alerts: its two dashboard links."""
    return with_links(alerts.select("dated", "vertical").distinct(), links)


def _vertical_blocks_sql() -> str:
    heading = _block_sql("section", _text_sql(
        "mrkdwn", template_sql(HEADING_TEXT, vertical="upper(vertical)", tag="owner_tag")))
    link = _block_sql("section", _text_sql(
        "mrkdwn", template_sql(LINKS_TEXT, pct="pct_link", tat="tat_link")))
    alert = _block_sql("section", fields=(
        "array("
        + _text_sql("mrkdwn", template_sql(ALERT_NAME_TEXT, metric_name="a.metric_name",
                                           order_type="a.order_type")) + ", "
        + _text_sql("mrkdwn", template_sql(ALERT_VALUE_TEXT, metric_value="a.metric_value")) + ")"))
    return (f"concat(array({heading}), "
            f"CASE WHEN pct_link IS NOT NULL THEN array({link}) ELSE array() END, "
            f"transform(_alerts, a -> {alert}), array({DIVIDER_SQL}))")


def vertical_blocks(alerts: DataFrame, owners: DataFrame, links: DataFrame) -> DataFrame:
    """One row per (dated, vertical): heading, links (if any), one block per
    alert in (order_type, metric_name, metric_value) order, divider."""
    grouped = alerts.groupBy("dated", "vertical").agg(F.expr(
        "sort_array(collect_list(struct(order_type, metric_name, metric_value, metric_threshold)))"
    ).alias("_alerts"))
    dressed = with_links(with_owner(grouped, owners), links)
    return dressed.selectExpr("dated", "vertical", f"{_vertical_blocks_sql()} AS blocks")


def day_blocks(alerts: DataFrame, owners: DataFrame, links: DataFrame) -> DataFrame:
    """One row per day with alerts: the whole ordered block list (header,
    divider, then every vertical in name order).  A day without alerts has no
    row, so no message."""
    per_day = vertical_blocks(alerts, owners, links).groupBy("dated").agg(
        F.expr("sort_array(collect_list(struct(vertical, blocks)))").alias("_vs"))
    return per_day.selectExpr(
        "dated", f"concat(array({HEADER_SQL}, {DIVIDER_SQL}), flatten(transform(_vs, v -> v.blocks))) AS blocks")


def alert_blocks(alerts: DataFrame, owners: DataFrame, links: DataFrame) -> DataFrame:
    """Flat view of the blocks: (dated, block_no, block_type, text_type, text,
    field1, field2), numbered from 1 within each day."""
    return (day_blocks(alerts, owners, links)
            .selectExpr("dated", "posexplode(blocks) AS (pos, b)")
            .selectExpr("dated", "CAST(pos + 1 AS BIGINT) AS block_no", "b.type AS block_type", "b.text.type AS text_type",
                        "b.text.text AS text", "b.fields[0].text AS field1", "b.fields[1].text AS field2"))


def alert_payload(alerts: DataFrame, owners: DataFrame, links: DataFrame) -> DataFrame:
    """One JSON message per day: ``{"blocks": [...]}``; absent parts omitted."""
    return day_blocks(alerts, owners, links).selectExpr(
        "dated", "to_json(named_struct('blocks', blocks)) AS payload")
