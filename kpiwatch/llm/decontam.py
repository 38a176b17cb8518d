"""Benchmark decontamination as a prefix-filtered set join on word shingles. DataFrame functions only.

Words are maximal runs of ASCII letters and digits (A-Z lower-cased) and of anything beyond ASCII. A window
is WINDOW consecutive words of an item, or the whole item where it has fewer (but some). A window
as a set of word shingles is contained in a document only if each of its shingles is. So a prefix
of one shingle is necessary, and the rarest one is taken:

1. Count the windows' shingles over all documents (shingles of SHINGLE words; shorter items use
   their own length).
2. Index each distinct window under its rarest shingle, with that shingle's offset.
3. Probe with every document's shingles. An index match at position p with offset o leaves one
   place, p - o. Positional and length bounds drop places that stick out of the document, and the
   item-sized window at the place is compared word for word.

Shingle keys are hashes of Unicode-lower-cased words: equal windows always have equal keys, and the
last step compares the words themselves, lower-cased A-Z only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiwatch.llm.common import cut

WINDOW = 10
SHINGLE = 3
#: The windows' texts and item lists are sent to all executors up to this size; beyond it, the joins shuffle.
BROADCAST_BYTES = 64 << 20

_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text as written; none for null."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), _BETWEEN), "")


def _joined(ws: Column) -> Column:
    """Words as one comparable text, lower-cased A-Z."""
    return F.translate(F.array_join(ws, " "), _UPPER, _LOWER)


def _shingles(ws: Column, k: int) -> Column:
    """Hash of each run of k words, by position."""

    def at(i: Column) -> Column:
        return F.xxhash64(*(F.lower(F.get(ws, i + j)) for j in range(k)))

    n = F.size(ws)
    return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), at)).otherwise(F.array().cast("array<bigint>"))


def windows(items: DataFrame) -> DataFrame:
    """win (text), k (shingle length), len, ws (words), items (sorted distinct ids): the distinct windows."""
    # An item may be far longer than its windows; each window is a slice.
    ws = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("ws")).filter("size(ws) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("ws") - (WINDOW - 1), F.lit(1)))
    parts = ws.select("item", "ws", F.explode(starts).alias("at")).select("item", F.expr(f"slice(ws, at, {WINDOW})").alias("ws"))
    lowered = parts.select("item", _joined(F.col("ws")).alias("win")).distinct()
    found = lowered.groupBy("win").agg(F.sort_array(F.collect_set("item")).alias("items"))
    split = found.withColumn("ws", F.split("win", " ")).withColumn("len", F.size("ws"))
    return split.withColumn("k", F.least(F.lit(SHINGLE), F.col("len")))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), words(text).alias("ws"))


def prefix_index(wins: DataFrame, docs: DataFrame, k: int, small: bool) -> DataFrame:
    """h (rarest shingle), offset, win, len, items: the windows whose shingles have k words."""
    own = wins.filter(F.col("k") == k).select("win", "len", "items", F.posexplode(_shingles(F.col("ws"), k)).alias("offset", "h"))
    wanted = own.select("h").distinct()
    wanted = F.broadcast(wanted) if small else wanted
    seen = _keyed(docs).select(F.explode(_shingles(F.col("ws"), k)).alias("h")).join(wanted, "h").groupBy("h").agg(F.count("*").alias("seen"))
    rare = F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "h", "offset")).alias("rare")
    return own.join(seen, "h", "left").groupBy("win", "len", "items").agg(rare).select("rare.h", "rare.offset", "win", "len", "items")


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), n (words), start, stop, items: every occurrence of a window.

    Besides, each row of `docs` gives one row without start, so documents without hits stay known.
    """
    wins = cut(windows(items))
    size = F.octet_length("win") + F.octet_length(F.array_join("items", ",")) + 64
    sizes = {r.k: r.bytes for r in wins.groupBy("k").agg(F.sum(size).alias("bytes")).collect()}  # k is 1 to SHINGLE
    small = sum(sizes.values()) <= BROADCAST_BYTES
    each = []
    for k in sorted(sizes):
        index = prefix_index(wins, docs, k, small)
        index = F.broadcast(index) if small else index
        probe = _keyed(docs).select("doc_id", "th", "ws", F.posexplode(_shingles(F.col("ws"), k)).alias("pos", "h"))
        placed = probe.join(index, "h").withColumn("start", F.col("pos") - F.col("offset"))
        inside = placed.filter("start >= 0 AND start + len <= size(ws)")
        same = inside.filter(_joined(F.expr("slice(ws, start + 1, len)")) == F.col("win"))
        each.append(same.select("doc_id", "th", F.size("ws").alias("n"), "start", (F.col("start") + F.col("len")).alias("stop"), "items"))
    itself = _keyed(docs).select("doc_id", "th", F.size("ws").alias("n"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("stop"), F.lit(None).cast("array<string>").alias("items"))
    return reduce(DataFrame.unionByName, each, itself)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, th: one row per row of `docs`.

    Null texts have no words and are clean. Rows that repeat a doc_id and text give equal rows, as
    many as there are. Items with null id count for hits, not for n_items. Without items (or words in them),
    every document is clean; without documents the result is empty.
    """
    span = F.when(F.col("start").isNotNull(), F.struct("start", "stop"))
    by_doc = hits(docs, items).groupBy("doc_id", "th").agg(
        F.max("n").cast("long").alias("n_words"),
        F.count(F.when(F.col("start").isNull(), 1)).alias("copies"),
        F.sort_array(F.collect_set(span)).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], a["to"]))).alias("n"), F.greatest(a["to"], s["stop"]).alias("to")),
        lambda a: a["n"].cast("long"),
    )
    done = by_doc.select("doc_id", "th", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "items", "copies")
    out = done.select("*", (F.col("n_hit") > 0).alias("contaminated"), F.explode(F.expr("array_repeat(0, int(copies))")))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "th")


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` whose text holds no window, with all their columns."""
    bad = contamination(docs, items).filter("contaminated").select(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__th": F.xxhash64(text)})
    same = keyed["__id"].eqNullSafe(bad["__id"]) & (keyed["__th"] == bad["__th"])
    return keyed.join(bad, same, "left_anti").select(*docs.columns)
