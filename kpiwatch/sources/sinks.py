"""Table sinks: replace and append, plus the message sink.

Writes are parallel per partition.  Partitioned writes are rebalanced first, so
files get the session's advisory partition size in bytes, whatever a row weighs;
``max_records_per_file`` bounds them by rows as well, where that is wanted.
"""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

JDBC_BATCH = 100_000  # rows per insert


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def store_table(df: DataFrame, target: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Sequence[str] | None = None,
                max_records_per_file: int = 0,
                options: dict | None = None) -> None:
    """Write ``df`` to a catalog table or a path.

    ``mode="overwrite"`` replaces the table, schema included, also in a session
    whose partition overwrite mode is dynamic; ``"append"`` adds rows, matches
    columns by name, and creates the table when it does not exist.  Appending
    other columns or types than a path holds raises.  ``fmt="jdbc"`` writes to
    a database given in ``options`` (url, dbtable, ...; ``batchsize`` rows per insert).
    """
    if fmt == "jdbc":
        opts = {"batchsize": str(JDBC_BATCH), **(options or {})}
        df.write.mode(mode).format("jdbc").options(**opts).save()
        return
    if partition_by:
        # AQE rebalances the rows on the partition columns before the write:
        # a large day is split over several tasks and small days are merged,
        # so each directory gets few, well-sized files.
        df = df.hint("rebalance", *partition_by)
    if mode == "append" and _is_path(target):
        df = _as_stored(df, target, fmt)
    writer = df.write.mode(mode).format(fmt).options(**(options or {}))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if _is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(target)


def _as_stored(df: DataFrame, path: str, fmt: str) -> DataFrame:
    """``df`` in the column order of what ``path`` holds, if anything; raises if columns or types differ."""
    try:
        held = df.sparkSession.read.format(fmt).load(path).schema
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return df
        raise
    new = {f.name: f.dataType for f in df.schema.fields}
    if new != {f.name: f.dataType for f in held.fields}:
        raise ValueError(f"{path} holds {held.simpleString()}, not {df.schema.simpleString()}")
    return df.select(*held.names)


def replace_table(df: DataFrame, target: str, **kw) -> None:
    store_table(df, target, mode="overwrite", **kw)


def append_table(df: DataFrame, target: str, **kw) -> None:
    store_table(df, target, mode="append", **kw)


def read_stored(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(target) if _is_path(target) else spark.table(target)


def write_payloads(payloads: DataFrame, path: str) -> None:
    """Message sink: a (dated, payload) table partitioned by day.

    Writing a day again replaces its message, so a re-run never stores it twice.
    Sending the text on to a chat webhook is left to the consumer; no network
    call is made from Spark tasks.
    """
    replace_days(payloads.select("dated", "payload"), path)


def replace_days(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite exactly the ``dated`` partitions present in ``df``.

    Give ``df`` a row for every day being replaced (e.g. a NULL payload for a
    day without message): dynamic partition overwrite only touches partitions
    that receive rows, so a re-run whose result for a day became empty still
    replaces that day.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dated").format(fmt).save(path))


def shared_dir(spark: SparkSession, sub: str) -> str:
    """A folder for job outputs on storage that every executor sees: under
    ``spark.checkpoint.dir``.  Where that is unset, a local session (tests) gets
    a scratch folder; on a cluster it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="kpiwatch-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{sub}"
