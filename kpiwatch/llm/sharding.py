"""Sharding by vector bin packing: bytes, tokens and rows of the shards are balanced jointly.

Law `bytes`: the shards' sizes are near equal. Texts that are equal go together, as one group, unless
the group is too heavy for that.

1. One aggregation gives each distinct text its vector (bytes, tokens, rows).
2. Groups are hashed into BUNDLES bundles. A group with more than the share 1 / (PIECES * shards) of
   any total leaves its bundle and is dealt by doc_id and copy (the number of a row among the rows equal to
   it) into pieces that are below it, so one text, or one repeated row, that holds a third of all rows
   can't unbalance the shards. Both kinds are counted: at most BUNDLES bundles and 3 * PIECES * shards
   heavy groups come to the driver, whatever the input.
3. The units are placed one by one, heaviest first, where the dot product of the unit's vector with
   the shard's residual capacity is highest (both as shares of the totals). Shards that are within
   the byte limit come first.
4. Rows get gapless slots: rows are dealt into runs of about RUN rows by hash of doc_id, text and copy,
   counted, and numbered within their run; no task holds a shard, or all copies of a row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiwatch.llm.common import cut
from kpiwatch.llm.vectors import stored

SHARDS = 8
BUNDLES = 4096
PIECES = 8
RUN = 2_000
#: Equal rows are numbered in this many parts, so that no task numbers all copies of a row.
PARTS = 1024
#: A shard may exceed its even share of bytes by this share while another one is below.
SLACK = 0.001

_WHITE = r"[\x20\x09-\x0D]+"


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 1; 1 for null), tokens, grp (hash of the text), text_crc32, one row per row."""
    text = F.col("text").cast("string")
    tokens = F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), _WHITE), ""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        tokens.cast("long").alias("tokens"),
        F.xxhash64(text, F.octet_length(text)).alias("grp"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )


def copies(rows: DataFrame) -> DataFrame:
    """`rows` with `copy`: a gapless number from 0 among the rows of equal doc_id and grp, whatever the partitioning.

    `rows` must be a stored table, whose `key` stays the same when a row is read again.
    """
    same = ["doc_id", "grp"]
    parted = rows.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(PARTS)).cast("int"))
    counts = parted.groupBy(*same, "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*same).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # The first part of a row starts at 0, which for a row without copies is all there is to know.
    starts = counts.select("doc_id", "grp", "part", F.sum("n").over(before).alias("start")).filter("start IS NOT NULL")
    starts = starts.select(F.col("doc_id").alias("__id"), F.col("grp").alias("__grp"), F.col("part").alias("__part"), "start")
    at = parted["doc_id"].eqNullSafe(F.col("__id")) & (parted["grp"] == F.col("__grp")) & (parted["part"] == F.col("__part"))
    within = Window.partitionBy(*same, "part").orderBy("key")
    number = F.coalesce("start", F.lit(0)) + F.row_number().over(within) - 1
    return parted.join(starts, at, "left").withColumn("copy", number).drop("__id", "__grp", "__part", "start", "part", "key")


def place(units: np.ndarray, shards: int = SHARDS, slack: float = SLACK) -> np.ndarray:
    """The shard of each unit; `units` has a row (bytes, tokens, rows) for each."""
    total = np.maximum(units.sum(axis=0), 1)
    share = units / total
    left = np.full((shards, share.shape[1]), 1 / shards)
    out = np.zeros(len(units), np.int32)
    for i in np.lexsort((np.arange(len(units)), -share.max(axis=1))):
        fits = left[:, 0] - share[i, 0] >= -slack / shards
        fit = left @ share[i]
        # Where the unit fits nowhere, the shard with most bytes left takes it.
        to = np.argmax(np.where(fits, fit, -np.inf)) if fits.any() else np.argmax(left[:, 0])
        out[i] = to
        left[to] -= share[i]
    return out


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per row of `docs`.

    Null texts have size 1 and the crc32 of an empty text; they form one group. Repeated rows are
    numbered as copies and placed like any others. Slots are gapless from 0 in each shard, ordered by run, doc_id,
    text and copy. Nothing hangs on the table's partitioning.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    # Keys are written out before they are used, and so are the numbers of the copies.
    rows = cut(copies(stored(sizes(docs).withColumn("key", F.monotonically_increasing_id()))))
    groups = cut(rows.groupBy("grp").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("n")))
    most = [float(x or 0) / (PIECES * shards) for x in groups.agg(F.sum("size"), F.sum("tokens"), F.sum("n")).first()]
    # At most 3 * PIECES * shards groups can be heavy: each holds that share of one of three totals.
    over = F.greatest(*(F.ceil(F.col(c) / F.lit(max(m, 1.0))) for c, m in zip(("size", "tokens", "n"), most)))
    heavy = F.broadcast(groups.select("grp", over.cast("int").alias("pieces")).filter("pieces > 1"))
    piece = F.pmod(F.xxhash64("doc_id", "grp", "copy", F.lit("piece")), F.col("pieces"))
    name = F.when(F.col("pieces").isNull(), F.pmod(F.xxhash64("grp"), F.lit(BUNDLES))).otherwise(F.xxhash64("grp", piece))
    named = rows.join(heavy, "grp", "left").withColumn("unit", F.struct(F.col("pieces").isNotNull().alias("heavy"), name.alias("name")))
    units = named.groupBy("unit").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("n")).orderBy("unit").collect()
    to = place(np.array([[u["size"], u["tokens"], u["n"]] for u in units], float).reshape(-1, 3), shards)
    plan = spark.createDataFrame([(u.unit.heavy, u.unit.name, int(s)) for u, s in zip(units, to)], "heavy boolean, name long, shard int")
    # One short row for each unit, and their number is bounded.
    placed = named.select("*", "unit.*").join(F.broadcast(plan), ["heavy", "name"])
    return numbered(placed.select("doc_id", "size", "text_crc32", "grp", "copy", "shard"), sum(u["n"] for u in units)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def numbered(placed: DataFrame, n: int) -> DataFrame:
    """`placed` with `slot`: a gapless number from 0 within its shard."""
    runs = max(1, n // (SHARDS * RUN))
    # The run must be the same when a row is read again, so it hangs on the row's values only.
    run: Column = F.pmod(F.xxhash64("doc_id", "grp", "copy", F.lit("run")), F.lit(runs))
    dealt = placed.withColumn("run", run)
    counts = dealt.groupBy("shard", "run").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "run").orderBy("doc_id", "grp", "copy")
    return dealt.join(starts, ["shard", "run"]).withColumn("slot", F.col("start") + F.row_number().over(within) - 1)
