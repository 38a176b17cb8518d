from kpiwatch.functions.columns import (
    day_filter_sql,
    iso_date_sql,
    metric_text,
    metric_text_sql,
    minutes_seconds,
    minutes_seconds_sql,
    percent_of,
    percent_of_sql,
    report_start,
    report_start_sql,
)

__all__ = ["day_filter_sql", "iso_date_sql", "metric_text", "metric_text_sql",
           "minutes_seconds", "minutes_seconds_sql", "percent_of", "percent_of_sql", "report_start",
           "report_start_sql"]
