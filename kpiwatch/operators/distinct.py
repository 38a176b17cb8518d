"""Conditional distinct counts without Spark's Expand rewrite.

``count(DISTINCT CASE WHEN cond THEN entity END)`` for several conditions makes
Spark expand every input row once per distinct aggregate before the shuffle.
Counting per (keys, entity) first and then per keys gives the same numbers with
two ordinary partial/final aggregations and no row multiplication: a hot key
is spread over its entities, and a hot (key, entity) collapses map-side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entity_flags(df: DataFrame, keys: Sequence[str], entity: str,
                 conditions: Mapping[str, Column], rows: str = "_rows") -> DataFrame:
    """Level 1: one row per (keys, entity) with its row count and, per condition,
    1 when any of its rows meets it (else NULL)."""
    return df.groupBy(*keys, entity).agg(
        F.count(F.lit(1)).alias(rows),
        *[F.max(F.when(cond, F.lit(1))).alias(name) for name, cond in conditions.items()],
    )


def count_flagged(flags: DataFrame, keys: Sequence[str], entity: str, flag_names: Sequence[str],
                  rows: str = "_rows", rows_as: str = "rows", distinct_as: str = "entities",
                  names: Mapping[str, str] | None = None) -> DataFrame:
    """Level 2: per keys, total rows, distinct non-NULL entities, and distinct
    entities carrying each flag (NULL entities are not counted, as in SQL)."""
    names = dict(names or {})
    ent = F.col(entity)
    return flags.groupBy(*keys).agg(
        F.sum(rows).alias(rows_as),
        F.count(ent).alias(distinct_as),
        *[F.count(F.when(F.col(f) == 1, ent)).alias(names.get(f, f)) for f in flag_names],
    )


def distinct_counts(df: DataFrame, keys: Sequence[str], entity: str,
                    conditions: Mapping[str, Column], rows_as: str = "rows",
                    distinct_as: str = "entities") -> DataFrame:
    """Per keys: ``count(*)``, ``count(DISTINCT entity)`` and, for every named
    condition, ``count(DISTINCT CASE WHEN condition THEN entity END)``."""
    flags = entity_flags(df, keys, entity, conditions)
    return count_flagged(flags, keys, entity, list(conditions), rows_as=rows_as,
                         distinct_as=distinct_as)
