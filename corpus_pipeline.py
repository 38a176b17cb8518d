"""The corpus pipeline: five of the training-data operators, one after another, over `documents`.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and is written
as Parquet under the shared checkpoint folder before the next one reads it. All but the last return
the columns of `documents`.

Stages that run Python set BATCH in the session: an executor holds each running task's batch twice or more, as Arrow
buffers beside the heap and in the worker. By default a batch has 10000 rows up to 64 MB, and workers keep
much of that when they are idle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from kpiwatch.llm import decontam, neardup, pieces, pii, toxicity
from kpiwatch.llm.common import read_table, shared_folder

#: Bytes of rows that go to a Python worker at a time.
BATCH = "4m"


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier scores as toxic."""
    _small_batches(spark)
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, linked at a similarity of 0.8 or more."""
    _small_batches(spark)
    return neardup.deduplicated(docs, neardup.STAGE_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a window of a benchmark item."""
    return decontam.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind, in brackets."""
    return pii.masked(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, sample, ids, log_prob, inclusion, ids_crc32, round_trip: the sampled segmentations of each text."""
    _small_batches(spark)
    return pieces.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("sentencepiece", encode_pieces),
]

#: Stages that train or sample can't be told in SQL; the tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the last one's rows."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
