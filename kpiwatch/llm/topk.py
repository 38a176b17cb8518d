"""Exact top-k inner products by a three-phase uniform threshold over vertical score lists.

Vectors are cut into LISTS blocks of components. For a query, each block is a list of local scores
(the inner products of the block); a vector's score is the sum over the lists.

1. Gather: each list sends its TOP best entries. The vectors that were named are scored in full; the
   TOP-th best of those scores is a lower bound of the answer's last score.
2. Broadcast a safe cutoff: with the lists' lowest scores low_1..low_m, an answer must exceed its lows by
   at least bound - sum(low) in total, hence by 1/m of that in some list. Each query takes its
   cutoffs low_j + (bound - sum(low)) / m to every list, which sends all entries that reach them.
3. Resolve: an entry that one list sent and another didn't is bounded by the other's cutoff; those whose bound
   stays below the lower bound go. For what is left, the lists that didn't send it are asked for its score.
   The lists of a block lie in one group, so each pair of blocks answers with its best TOP exact scores, and
   what is ranked grows with queries times blocks, not with queries times vectors.

Queries and vectors meet in blocks: BLOCK vectors by QUERIES queries, each pair of blocks one group
of bounded size, dealt by hash. A block of queries travels to each block of vectors; nothing is
collected or broadcast whole. Scores are exact integers of any size: float64 products where they are
exact, then 64-bit ones, else Python integers. Between tasks they travel as text that sorts like the number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiwatch.llm.common import cut
from kpiwatch.llm.vectors import stored

TOP = 5
LISTS = 2
SCALE = 256
EVERY = 50
BLOCK = 4096
QUERIES = 512
_FLIP = str.maketrans("0123456789", "9876543210")


def usable_rows(embeddings: DataFrame) -> DataFrame:
    """key (unique), vec_id, e (doubles): rows whose vector holds no null and no non-finite component.

    Rows that repeat a vec_id stay rows of their own. Rows without vec_id, and empty vectors, take no part.
    """
    e = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    good = F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    e = e.filter(F.col("vec_id").isNotNull() & (F.size("e") > 0) & F.coalesce(good, F.lit(False)))
    # Written out at once: a key that is read again is the same key.
    return stored(e.select(F.monotonically_increasing_id().alias("key"), "vec_id", "e"))


def coded(n: int) -> str:
    """An integer as text whose order is the numbers' order: sign, count of digits, digits (negative ones flipped)."""
    digits = str(abs(int(n)))
    return f"p{len(digits):04d}{digits}" if n >= 0 else "n" + f"{len(digits):04d}{digits}".translate(_FLIP)


def decoded(text: str) -> int:
    return int(text[5:]) if text[0] == "p" else -int(text[5:].translate(_FLIP))


def number(code: Column) -> Column:
    """The integer of a code as decimal(38, 0); null beyond it."""
    digits = F.substring(code, 6, 10_000)
    minus = F.concat(F.lit("-"), F.translate(digits, "0123456789", "9876543210"))
    return F.when(code.startswith("p"), digits).otherwise(minus).try_cast("decimal(38,0)")


def quantised(e: np.ndarray) -> np.ndarray:
    """floor(256 * component) for each double: float64 where that is finite, else Python integers."""
    if float(np.abs(e).max(initial=0)) < 2.0**1000:
        return np.floor(e * SCALE)
    # A double beyond 2**53 is a whole number.
    whole = [int(c) * SCALE if abs(c) >= 2.0**53 else int(np.floor(c * SCALE)) for c in e.ravel().tolist()]
    return np.array(whole, object).reshape(e.shape)


def _objects(x: np.ndarray) -> np.ndarray:
    return x if x.dtype == object else np.array([int(c) for c in x.ravel().tolist()], object).reshape(x.shape)


def _kind(q: np.ndarray, x: np.ndarray) -> type:
    """The cheapest number type in which all products of q's and x's rows, and sums of a few, are exact."""
    if q.dtype == object or x.dtype == object:
        return object
    high = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(q.shape[1], 1)
    return np.float64 if high < 2**53 else np.int64 if high < 2**61 and max(np.abs(q).max(), np.abs(x).max()) < 2**62 else object


def _products(q: np.ndarray, x: np.ndarray, kind: type) -> np.ndarray:
    """Exact inner products of all rows of q with all rows of x: 64-bit, or Python integers."""
    if kind is np.float64:
        return (q @ x.T).astype(np.int64)
    if kind is np.int64:
        return q.astype(np.int64) @ x.astype(np.int64).T
    # Only rows with large components need Python integers.
    out = np.empty((len(q), len(x)), object)
    large = np.array([any(abs(c) >= 2**20 for c in row) for row in x])
    plain = np.array([all(abs(c) < 2**20 for c in row) for row in q])
    if plain.any() and (~large).any():
        out[np.ix_(plain, ~large)] = (q[plain].astype(np.int64) @ x[~large].astype(np.int64).T).astype(object)
    for of_q, of_x in ((plain, large), (~plain, np.ones(len(x), bool))):
        if of_q.any() and of_x.any():
            out[np.ix_(of_q, of_x)] = _objects(q[of_q]) @ _objects(x[of_x]).T
    return out


def _slices(width: int) -> list[slice]:
    edges = np.linspace(0, width, LISTS + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def _matrix(rows: pd.Series) -> np.ndarray:
    return quantised(np.stack(rows.to_list()).astype(np.float64))


def _met(queries: DataFrame, vectors: DataFrame, extra: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides keyed by (vb, qb): each query block with each block of vectors of the same width."""
    n, m = (max(1, -(-df.count() // size)) for df, size in ((vectors, BLOCK), (queries, QUERIES)))
    vb = F.pmod(F.xxhash64("key", F.lit("v")), F.lit(n))
    qb = F.pmod(F.xxhash64("qkey", F.lit("q")), F.lit(m))
    v = vectors.select(vb.alias("vb"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))).alias("qb"), F.size("e").alias("width"), "key", "vec_id", "e")
    q = queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("vb"), qb.alias("qb"), F.size("q").alias("width"), "qkey", "q", *extra)
    return q, v


def _top(p: np.ndarray, may: np.ndarray, top: int) -> np.ndarray:
    """Which of the entries that `may` be chosen are among their row's `top` best (ties to the left)."""
    keep = np.zeros(p.shape, bool)
    for i, row in enumerate(p):
        at = np.flatnonzero(may[i])
        if len(at) > top:
            values = row[at]
            last = sorted(values)[-top] if p.dtype == object else np.partition(values, len(at) - top)[len(at) - top]
            above = at[values > last]
            at = np.concatenate([above, at[values == last][: top - len(above)]])
        keep[i, at] = True
    return keep


def search(embeddings: DataFrame, every: int = EVERY, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: the `top` rows of highest inner product for each query row, itself left out.

    Queries are the rows whose vec_id is divisible by `every`; rows that repeat a vec_id are queries and candidates
    of their own. Ties go to the smaller vec_id; with fewer than `top` other rows of the query's width, there
    are fewer results. score is decimal(38, 0), null beyond it (ranks are exact all the same). No vectors: no rows.
    """
    vectors = usable_rows(embeddings)
    queries = vectors.filter(F.col("vec_id") % every == 0).select(F.col("key").alias("qkey"), F.col("vec_id").alias("query_id"), F.col("e").alias("q"))

    def gather(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"qkey": [], "list": [], "key": [], "vec_id": []}, dtype="int64").assign(local=pd.Series(dtype=str), low=pd.Series(dtype=str))
        if q.empty or v.empty:
            return none
        v = v.sort_values(["vec_id", "key"])
        qm, vm, q_keys, v_keys, v_ids = _matrix(q.q), _matrix(v.e), q.qkey.to_numpy(), v.key.to_numpy(), v.vec_id.to_numpy()
        others = q_keys[:, None] != v_keys[None, :]
        kind, parts = _kind(qm, vm), []
        for j, s in enumerate(_slices(vm.shape[1])):
            p = _products(qm[:, s], vm[:, s], kind)
            # A query's own entry may lower its low: the cutoffs stay safe.
            lows = [coded(x) for x in p.min(axis=1)]
            i, k = np.nonzero(_top(p, others, top))
            parts.append(pd.DataFrame({"qkey": q_keys[i], "list": j, "key": v_keys[k], "vec_id": v_ids[k], "local": [coded(x) for x in p[i, k]], "low": [lows[x] for x in i]}))
        return pd.concat(parts) if any(len(x) for x in parts) else none

    q, v = _met(queries, vectors, [])
    keys = ["vb", "qb", "width"]
    lists = cut(q.groupBy(*keys).cogroup(v.groupBy(*keys)).applyInPandas(gather, "qkey long, list long, key long, vec_id long, local string, low string"))
    best = Window.partitionBy("qkey", "list").orderBy(F.desc("local"), "vec_id", "key")
    named = lists.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= top).select("qkey", "key").distinct()
    exact = _scored(named, queries, vectors)
    # Fewer than `top` named vectors can't bound the last place: then everything must come.
    nth = Window.partitionBy("qkey").orderBy(F.desc("code"), "vec_id", "key")
    bounds = exact.withColumn("r", F.row_number().over(nth)).filter(F.col("r") == top).select("qkey", F.col("code").alias("bound"))
    lows = lists.groupBy("qkey", "list").agg(F.min("low").alias("low")).groupBy("qkey").agg(F.sort_array(F.collect_list(F.struct("list", "low"))).alias("l"))
    lows = lows.select("qkey", F.col("l.low").alias("lows"))
    known = queries.join(lows, "qkey").join(bounds, "qkey", "left")

    def collect(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"qkey": [], "key": [], "vec_id": []}, dtype="int64").assign(code=pd.Series(dtype=str))
        if q.empty or v.empty:
            return none
        v = v.sort_values(["vec_id", "key"])
        qm, vm, q_keys, v_keys, v_ids = _matrix(q.q), _matrix(v.e), q.qkey.to_numpy(), v.key.to_numpy(), v.vec_id.to_numpy()
        free = q.bound.isna().to_numpy()
        bound = np.array([0 if f else decoded(b) for f, b in zip(free, q.bound)], object)
        lows = np.array([[decoded(x) for x in row] for row in q.lows], object)
        # Rounded down, the uniform share of the excess keeps the cutoffs safe.
        cutoffs = lows + ((bound - lows.sum(axis=1)) // lows.shape[1])[:, None]
        kind = _kind(qm, vm)
        if kind is not object and max(np.abs(cutoffs).max(), np.abs(bound).max()) < 2**60:
            cutoffs, bound = cutoffs.astype(np.int64), bound.astype(np.int64)
        some = np.zeros((len(q), len(v)), bool)
        most, unsent = np.zeros(some.shape, cutoffs.dtype), np.zeros(some.shape, cutoffs.dtype)
        for j, s in enumerate(_slices(vm.shape[1])):
            p, cutoff = _products(qm[:, s], vm[:, s], kind).astype(cutoffs.dtype, copy=False), cutoffs[:, j : j + 1]
            has = (p >= cutoff).astype(bool) | free[:, None]
            some |= has
            most += np.where(has, p, cutoff)
            # What the bound lacks to the score: the lists' answers to phase 3.
            unsent += np.where(has, 0, p - cutoff)
        some &= ((most >= bound[:, None]).astype(bool) | free[:, None]) & (q_keys[:, None] != v_keys[None, :])
        exact = most + unsent
        i, k = np.nonzero(_top(exact, some, top))
        codes = [coded(x) for x in exact[i, k]]
        return pd.DataFrame({"qkey": q_keys[i], "key": v_keys[k], "vec_id": v_ids[k], "code": pd.Series(codes, dtype=object)})

    q, v = _met(known, vectors, ["lows", "bound"])
    left = cut(q.groupBy(*keys).cogroup(v.groupBy(*keys)).applyInPandas(collect, "qkey long, key long, vec_id long, code string"))
    ranked = left.withColumn("rank", F.row_number().over(nth)).filter(F.col("rank") <= top)
    return ranked.join(queries.select("qkey", "query_id"), "qkey").select("query_id", "rank", "vec_id", number(F.col("code")).alias("score"))


def _scored(pairs: DataFrame, queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """qkey, key, vec_id, code: the pairs' inner products over all components."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            codes = [coded(_products(x, y, _kind(x, y))[0, 0]) for x, y in ((quantised(q[None, :]), quantised(e[None, :])) for q, e in zip(b.q, b.e))]
            yield b[["qkey", "key", "vec_id"]].assign(code=pd.Series(codes, index=b.index, dtype=object))

    both = pairs.join(queries.select("qkey", "q"), "qkey").join(vectors, "key")
    return both.select("qkey", "key", "vec_id", "q", "e").mapInPandas(score, "qkey long, key long, vec_id long, code string")
