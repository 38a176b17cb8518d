"""Column helpers.  Each is one built-in Spark SQL expression (so it stays in
whole-stage codegen; none is a UDF).  They take column names or SQL
expressions as text: the ``*_sql`` forms return the expression text, to be
combined into one ``selectExpr``; the plain forms wrap it in a Column.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _date_sql(d) -> str:
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.isoformat()[:10]
    return f"DATE '{d}'"


def percent_of_sql(numerator: str, denominator: str, scale: int = 2) -> str:
    """round(100 * numerator / denominator, scale) in exact decimal arithmetic.

    ``100.0`` is DECIMAL(4,1), so with BIGINT sums the result is DECIMAL(27,2)
    and its text keeps two digits ("87.50").  A zero denominator gives NULL
    (so no alert) instead of a division error.
    """
    return f"round(100.0 * ({numerator}) / nullif({denominator}, 0), {scale})"


def percent_of(numerator: str, denominator: str, scale: int = 2) -> Column:
    return F.expr(percent_of_sql(numerator, denominator, scale))


def minutes_seconds_sql(seconds: str) -> str:
    """Seconds -> "M.SS" pseudo-decimal minutes as DOUBLE (125 -> 2.05).

    Only values strictly above 60 are split into minutes, so 60 renders as 0.6
    while 61 renders as 1.01.  NULL stays NULL.
    """
    s = f"({seconds})"
    # Whole minutes, then what is left over as hundredths; up to 60 nothing counts as a minute.
    whole = f"CASE WHEN {s} > 60 THEN floor({s} / 60) ELSE 0 END"
    return f"CAST(round({whole} + ({s} - 60 * ({whole})) / 100, 2) AS DOUBLE)"


def minutes_seconds(seconds: str) -> Column:
    return F.expr(minutes_seconds_sql(seconds))


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def template_sql(template: str, quote=None, joiner: str | None = None, **fields: str) -> str:
    """A ``{name}`` text template as one SQL string expression.

    Literal parts become string literals and every ``{name}`` the SQL
    expression ``fields[name]``; by default they are joined with Spark's
    ``concat`` (NULL in, NULL out).  ``quote`` and ``joiner`` let the same
    template be written for another SQL dialect (e.g. ``||``).
    """
    import string
    quote = quote or _quote
    parts = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(quote(literal))
        if name is not None:
            parts.append(f"({fields[name]})")
    if joiner is not None:
        return f" {joiner} ".join(parts)
    return f"concat({', '.join(parts)})"


def metric_text_sql(value: str, unit: str) -> str:
    """Value text plus unit, e.g. '87.50 %' or '1.05 min'."""
    return f"concat(CAST(({value}) AS STRING), {_quote(unit)})"


def metric_text(value: str, unit: str) -> Column:
    return F.expr(metric_text_sql(value, unit))


def day_filter_sql(dated: str, as_of=None, day=None, all_days: bool = False) -> str | None:
    """Predicate selecting one reporting day.

    ``day`` names the day itself; ``as_of`` reports on the day before it.  With
    neither it is yesterday, by the session's ``current_date``.  Every day is
    reported only with ``all_days`` (None is returned).
    """
    if sum((as_of is not None, day is not None, all_days)) > 1:
        raise ValueError("give one of as_of, day and all_days")
    if all_days:
        return None
    return f"{dated} = {report_day_sql(as_of, day)}"


def report_day_sql(as_of=None, day=None) -> str:
    """The one reported day as a SQL expression."""
    if day is not None:
        return _date_sql(day)
    return f"date_sub({'current_date()' if as_of is None else _date_sql(as_of)}, 1)"


def iso_date_sql(d: str) -> str:
    return f"date_format({d}, 'yyyy-MM-dd')"


def report_start_sql(dated: str, days: int = 7) -> str:
    """Start of the dashboard window: ``days`` before the reported day."""
    return iso_date_sql(f"date_sub({dated}, {days})")


def report_start(dated: str, days: int = 7) -> Column:
    return F.expr(report_start_sql(dated, days))
