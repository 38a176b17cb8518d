"""Importance resampling towards a target set: Gumbel top-k over hashed n-gram weights, by distributed quickselect.

1. Counts: words and pairs of words are hashed into BUCKETS buckets; one reading of all documents and one of the
   target texts count them. The log ratio of the two smoothed shares is a bucket's gain (an integer, in thousandths).
2. Weights: a document's weight is the mean gain of its features, looked up in the array of gains. A Gumbel
   number from the hash of its id is added, so the k highest scores are a draw without replacement.
3. Quickselect: rows of equal results are counted as one key (score, doc_id, ...). Each round draws PIVOTS
   random keys of the range that still holds the k-th key, counts exactly what lies below, at and above
   each of them, and narrows the range, until the k-th key itself is a pivot. No order is made of what is not drawn.
4. The winners alone are sorted, in range partitions, and ranked by the partitions' counts.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiwatch.llm.common import cut, texts

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
UNIT = 1000
#: Pivot keys of one round; each cuts the range once more.
PIVOTS = 16
#: Copies of one key that one task writes out.
COPIES = 100_000

#: Lower case for A-Z; all of ASCII but letters and digits parts words. Bytes above 0x7F belong to words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: A text is taken in pieces of about so many bytes, cut between words.
_PIECE = 1_000_000

Batches = Iterator[pa.RecordBatch]


def _buckets(text: bytes) -> Iterator[np.ndarray]:
    """The buckets of all words and pairs of neighbouring words of a text, in pieces."""
    folded, at, last = text.translate(_FOLD), 0, []
    while at < len(folded):
        stop = folded.find(b" ", at + _PIECE)
        stop = len(folded) if stop < 0 else stop
        words = folded[at:stop].split()
        joined = last + words
        pairs = map(b" ".join, zip(joined, joined[1:]))
        codes = [*map(zlib.crc32, words), *map(zlib.crc32, pairs)]
        yield np.array(codes, np.uint32) % np.uint32(BUCKETS)
        at, last = stop, joined[-1:]


def bucket_counts(table: DataFrame) -> list[int]:
    """How many features of all texts fall into each bucket."""

    def count(batches: Batches) -> Batches:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in texts(batch):
                for found in _buckets(text):
                    total += np.bincount(found, minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    parts = table.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    out = [0] * BUCKETS
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """Each bucket's log ratio of smoothed target share to smoothed corpus share, in thousandths, floored."""
    s_all, t_all = sum(corpus) + BUCKETS, sum(target) + BUCKETS
    return [math.floor(UNIT * math.log(float(t + 1) * s_all / (float(s + 1) * t_all))) for s, t in zip(corpus, target)]


def _gumbel(doc_id: int) -> int:
    h = int(hashlib.sha256(f"{SEED}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-UNIT * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: list[int]) -> DataFrame:
    """doc_id, n_words, n_features, weight, score for each row of `docs`; without doc_id there is no score."""
    table = np.array(gain, np.int64)

    def score(batches: Batches) -> Batches:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            n_words, n_features, weights, scores = [], [], [], []
            for doc_id, text in zip(ids, texts(batch)):
                n = total = 0
                for found in _buckets(text):
                    n += len(found)
                    total += int(table[found].sum())
                weight = total // n if n else 0
                n_words.append((n + 1) // 2)
                n_features.append(n)
                weights.append(weight)
                scores.append(None if doc_id is None else weight + _gumbel(doc_id))
            columns = [pa.array(c, pa.int64()) for c in (ids, n_words, n_features, weights, scores)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long, score long")


#: The order of the draw: highest score first, then smallest doc_id; the rest only tells rows of one doc_id apart.
KEY = ["place", "doc_id", "n_features", "weight"]


def _key(of) -> Column:
    return F.struct(*[of(c) for c in KEY])


def kth_key(keys: DataFrame, k: int) -> tuple[tuple, int]:
    """The key that holds the k-th row in order (k from 1), and how many rows come before it.

    `keys` has KEY's columns and `copies`, the rows that a key stands for. Each round counts exactly.
    """
    low = high = None  # the k-th key lies strictly between
    before = 0
    row = lambda key: _key(lambda c: F.lit(key[KEY.index(c)]).cast("long"))
    for at in range(10_000):
        active = keys
        if low is not None:
            active = active.filter(_key(F.col) > row(low))
        if high is not None:
            active = active.filter(_key(F.col) < row(high))
        dice = F.xxhash64(*KEY, F.lit(at), F.lit(SEED))
        pivots = sorted(tuple(r[c] for c in KEY) for r in active.orderBy(dice, *KEY).limit(PIVOTS).collect())
        counted = active.agg(*[
            F.coalesce(F.sum(F.when(test, F.col("copies"))), F.lit(0)).alias(f"{name}{i}")
            for i, p in enumerate(pivots) for name, test in (("under", _key(F.col) < row(p)), ("at", _key(F.col) == row(p)))
        ]).first()
        base = before
        for i, p in enumerate(pivots):
            under = base + counted[f"under{i}"]
            if k <= under:
                high = p
                break
            if k <= under + counted[f"at{i}"]:
                return p, under
            low, before = p, under + counted[f"at{i}"]
    raise RuntimeError("the k-th key was not found")


def _ranked(winners: DataFrame) -> DataFrame:
    """`winners` (KEY, copies) with `first`, the rank of the key's first row: sorted by range, then counted up."""
    laid = cut(winners.orderBy(*KEY).withColumn("part", F.spark_partition_id()))
    sizes = laid.groupBy("part").agg(F.sum("copies").alias("n")).orderBy("part").collect()
    starts, total = {}, 0
    for r in sizes:
        starts[r.part], total = total, total + r.n
    session = winners.sparkSession
    offsets = session.createDataFrame(list(starts.items()) or [(0, 0)], "part int, start long")
    within = Window.partitionBy("part").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("copies").over(within)
    return laid.withColumn("upto", upto).join(offsets, "part").select(*KEY, "copies", (F.col("start") + F.col("upto") - F.col("copies") + 1).alias("first"))


def _rows(keys: DataFrame, copies: Column, first: Column | None) -> DataFrame:
    """A row for each copy of each key, ranked from `first` on or unranked; many copies are written by many tasks."""
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((copies - 1) / COPIES).cast("long"))).alias("chunk")
    dealt = keys.filter(copies > 0).withColumns({"__n": copies, "__first": F.lit(None).cast("long") if first is None else first}).select("*", start)
    size = F.least(F.lit(COPIES).cast("long"), F.col("__n") - F.col("chunk") * COPIES)
    each = dealt.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), size - 1)))
    return each.select("doc_id", "n_features", "weight", (-F.col("place")).alias("score"), (F.col("__first") + F.col("chunk") * COPIES + F.col("i")).alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null: not drawn): one row for each row of `docs`.

    Takes doc_id and text; other columns are ignored. Null and empty texts have no features and weight 0. A row
    without doc_id has no score and is never drawn. Repeated rows each count and may each be drawn, with ranks of their own;
    rows of one doc_id and score with different texts go by n_features, then weight. Without documents
    there are no rows; without target texts every bucket's target share is the smoothing's.
    """
    rows = scored(docs, gains(bucket_counts(docs), bucket_counts(target)))
    fits = F.col("score").isNotNull() & (F.col("n_words") >= LEAST_WORDS)
    rows = rows.withColumns({"place": -F.col("score"), "fits": fits})
    # Written once: every round of the selection reads these narrow columns. Hot keys combine before the shuffle.
    folder = cut(rows.groupBy("fits", *KEY).agg(F.count("*").alias("copies")))
    keys, others = folder.filter("fits").select(*KEY, "copies"), folder.filter("NOT fits").select(*KEY, "copies")
    n = keys.agg(F.sum("copies")).first()[0] or 0
    k = percent * n // 100
    if not k:
        return _rows(folder.select(*KEY, "copies"), F.col("copies"), None)
    last, before = kth_key(keys, k)
    edge = _key(lambda c: F.lit(last[KEY.index(c)]).cast("long"))
    drawn = F.when(_key(F.col) < edge, F.col("copies")).when(_key(F.col) == edge, F.lit(k - before)).otherwise(0).cast("long")
    split = keys.withColumn("drawn", drawn)
    winners = _ranked(split.filter("drawn > 0").select(*KEY, F.col("drawn").alias("copies")))
    lost = split.select(*KEY, (F.col("copies") - F.col("drawn")).alias("copies")).unionByName(others)
    return _rows(winners, F.col("copies"), F.col("first")).unionByName(_rows(lost, F.col("copies"), None))
