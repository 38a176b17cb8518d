"""Incremental scheduled run with Structured Streaming.

The job reports on days as their mart partitions land.  Both mart
directories are read as file streams; each micro-batch names the days that
changed in either, and ``foreachBatch`` recomputes the alerts and the message of exactly
those days from the stored marts (pruned at run time by a stored table of the batch's days), then overwrites
those days' message partitions: a (dated, payload) Parquet table, with a NULL
payload for a day that no longer has alerts.  With ``availableNow`` a scheduler run
processes whatever landed since the last run and stops; the checkpoint (in
the cluster's shared ``spark.checkpoint.dir``) records what was done, so a
retried or restarted run neither skips nor duplicates a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kpiwatch import schemas
from kpiwatch.operators.message import alert_payload
from kpiwatch.plans.alert import AlertConfig, alerts
from kpiwatch.sources.sinks import shared_dir, write_payloads


def days_report(spark: SparkSession, dialed_path: str, tat_path: str, days: DataFrame,
                thresholds: DataFrame, owners: DataFrame, links: DataFrame,
                cfg: AlertConfig = AlertConfig(all_days=True)) -> DataFrame:
    """(dated, payload) for each row of ``days`` (dated, distinct), from the stored marts; the
    payload is NULL for a day without alerts (no message).

    The marts are read by a semi join with ``days``: where that is a filtered table, as a run's
    days are, Spark prunes the marts' partitions by it at run time."""
    dialed = spark.read.schema(schemas.DIALED).parquet(dialed_path).join(days, "dated", "left_semi")
    tat = spark.read.schema(schemas.TAT).parquet(tat_path).join(days, "dated", "left_semi")
    messages = alert_payload(alerts(dialed, tat, thresholds, cfg, ordered=False), owners, links)
    return days.join(messages, "dated", "left")


def store_days(batch: DataFrame, path: str, epoch_id: int) -> DataFrame:
    """The distinct days of a micro-batch, stored as that epoch's partition of a days table and read back.

    A retried epoch replaces its partition, so it reports on the same days again."""
    days = batch.select("dated").where("dated IS NOT NULL").distinct()
    (days.select("dated", F.lit(epoch_id).cast("long").alias("epoch")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path))
    stored = batch.sparkSession.read.schema("dated date, epoch long").parquet(path)
    return stored.where(F.col("epoch") == epoch_id).select("dated")


def run_incremental(spark: SparkSession, dialed_path: str, tat_path: str, payload_path: str,
                    thresholds: DataFrame, owners: DataFrame, links: DataFrame,
                    checkpoint: str | None = None, cfg: AlertConfig = AlertConfig(all_days=True),
                    available_now: bool = True, max_files_per_trigger: int | None = 1000) -> StreamingQuery:
    """Start the incremental alert stream; returns the running query."""
    checkpoint = checkpoint or shared_dir(spark, "kpiwatch_streams/daily_alerts")

    def watch(path, schema):
        reader = spark.readStream.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.parquet(path).select("dated")

    # A landing in either mart makes its days due again, so a day whose
    # turnaround files arrive after its funnel files is recomputed.
    landed = watch(dialed_path, schemas.DIALED).unionByName(watch(tat_path, schemas.TAT))

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        # The days touched by this batch are a table, not a list on the driver.
        days = store_days(batch, f"{checkpoint.rstrip('/')}-days", epoch_id)
        if days.isEmpty():
            return
        report = days_report(batch.sparkSession, dialed_path, tat_path, days, thresholds, owners, links, cfg)
        write_payloads(report, payload_path)

    writer = (landed.writeStream.foreachBatch(per_batch)
              .option("checkpointLocation", checkpoint)
              .queryName("kpiwatch_daily_alerts"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
