"""Table loading: Parquet/ORC/CSV paths, catalog tables and JDBC queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_path(base_dir: str, name: str) -> str:
    return f"{base_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory (``<dir>/<name>.parquet``)."""
    return spark.read.parquet(table_path(base_dir, name))


def load_table(spark: SparkSession, source: str, fmt: str | None = None,
               schema: T.StructType | None = None, options: dict | None = None) -> DataFrame:
    """Load a table by catalog name, by path, or as a JDBC query.

    * ``fmt=None`` and no path separator: catalog table (``spark.table``).
    * ``fmt="jdbc"``: ``source`` is the query text; connection settings go in
      ``options`` (url, user, ...).  Given ``partitionColumn``, ``lowerBound``,
      ``upperBound`` and ``numPartitions``, the read is split; without, it is one task.
    * otherwise ``source`` is a path read with ``fmt`` (default parquet).
    """
    options = dict(options or {})
    if fmt == "jdbc":
        return lowercase_columns(spark.read.format("jdbc").options(**jdbc_options(source, options)).load())
    if fmt is None and "/" not in source and ":" not in source:
        return spark.table(source)
    reader = spark.read.format(fmt or "parquet").options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(source)


def jdbc_options(query: str, options: dict) -> dict:
    """Reader options for a query.  Spark refuses ``query`` beside
    ``partitionColumn``, so a read that is to be split names it as a subquery."""
    if any(k.lower() == "partitioncolumn" for k in options):
        return {**options, "dbtable": f"({query}) q"}
    return {**options, "query": query}


def fetch(spark: SparkSession, query: str, **args) -> DataFrame:
    """Run a SQL query (with optional named parameters or DataFrame
    arguments) and return its result with lower-case column names."""
    return lowercase_columns(spark.sql(query, **args))


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Rename every column to lower case (warehouses often return upper case).

    Names that differ only in case would become one name that nothing can address, so they raise.
    """
    low = [c.lower() for c in df.columns]
    twice = sorted({c for c in low if low.count(c) > 1})
    if twice:
        raise ValueError(f"columns differ only in case: {twice}")
    return df.toDF(*[c.lower() for c in df.columns])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns in order, cast to its types.

    Column names are matched case-insensitively; extra columns are dropped and a
    missing one raises, so a mart with the wrong shape fails at planning time.
    """
    by_lower = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in by_lower]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df.select([F.col(by_lower[f.name.lower()]).cast(f.dataType).alias(f.name)
                      for f in schema.fields])
