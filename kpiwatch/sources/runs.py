"""All-or-nothing outputs: a run's tables become visible together, by one commit row.

```
<root>/<output>/run=<run>/...   staged by each run, never touched again
<root>/commits/...              one row a run: seq, run, the first and last day it covers
```

A run stages every output under its own id and then appends one row to ``commits``.  That append is a single file, which
Spark's committer puts in place at once, so readers see all of a run's outputs or none.  A reader takes, for each day, the
output of the last committed run that covers it; a covered day without rows is an empty day.  A run that fails before its
commit leaves files that no reader resolves.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS = "seq long, run string, first date, last date"


def new_run() -> str:
    return uuid.uuid4().hex


def stage(df: DataFrame, root: str, run: str, output: str) -> None:
    """Write one output (with a ``dated`` column) of a run; nobody reads it before :func:`commit`."""
    df.hint("rebalance").write.mode("overwrite").parquet(f"{root}/{output}/run={run}")


def commits(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(COMMITS).parquet(f"{root}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMITS)


def commit(spark: SparkSession, root: str, run: str, first=None, last=None) -> None:
    """Make a run's outputs visible for the days from ``first`` to ``last`` (None: every day, a backfill)."""
    seq = (commits(spark, root).agg(F.max("seq")).first()[0] or 0) + 1
    spark.createDataFrame([(seq, run, first, last)], COMMITS).coalesce(1).write.mode("append").parquet(f"{root}/commits")


def committed(spark: SparkSession, root: str, output: str, schema: T.StructType) -> DataFrame:
    """The committed rows of one output: for each day, those of the last run that covers it.

    The commit rows (one a run) decide, so the join with them prunes the folders of other runs.
    """
    known = commits(spark, root)
    if known.isEmpty():
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    rows = spark.read.schema(full).option("basePath", f"{root}/{output}").parquet(f"{root}/{output}")
    # A run covers its days only, whatever it has staged; of those, only days between the first and the last stored one matter.
    low, high = (F.lit(x).cast("date") for x in rows.agg(F.min("dated"), F.max("dated")).first())
    spans = known.select("seq", "run", F.greatest("first", low).alias("first"), F.least("last", high).alias("last")).where("first <= last")
    covered = spans.select("seq", "run", F.explode(F.sequence("first", "last")).alias("dated"))
    latest = covered.groupBy("dated").agg(F.max(F.struct("seq", "run")).alias("latest")).select("dated", "latest.run")
    return rows.join(latest, ["dated", "run"], "left_semi").select(*schema.fieldNames())


def store_run(spark: SparkSession, root: str, outputs: Mapping[str, DataFrame], first=None, last=None) -> str:
    """Stage all outputs and commit them together; returns the run's id."""
    run = new_run()
    for output, df in outputs.items():
        stage(df, root, run, output)
    commit(spark, root, run, first, last)
    return run
