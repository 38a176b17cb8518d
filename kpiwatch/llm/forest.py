"""Approximate nearest neighbours by inner product: a forest of random-projection trees with one shared queue.

Largest inner product becomes nearest direction by one more component: a vector x counts as
(x / M, sqrt(1 - |x|^2 / M^2)), M the greatest length, and a query q as (q / |q|, 0).

1. Fit: SAMPLE vectors, chosen by hash, fit TREES trees in the driver. A node draws a random direction and splits
   at its median. A tree's depth grows with the table, up to DEEPEST.
2. Index: every vector goes down every tree, in tasks, to one leaf of each.
3. Search: a query has one priority queue for all trees. A node's priority is the log-probability that a neighbour
   lies below it, taking projections of neighbours as correlated with the query's (KINSHIP). The best node of
   any tree is opened next, until the leaves taken hold BUDGET times the table's vectors (LEAST at least).
4. Rerank: vectors and queries meet by leaf, in blocks, and get their exact inner products. The first leaves of each
   queue go ahead: the last place of what they find bounds what any other block need name. The best are merged over
   the leaves and trees.

Equal vectors are one: it carries the smallest ids that can be among the answers (one more than are asked for), which leaves
no answer out. So many copies of one vector cost no more than a few. A full leaf is dealt into blocks of BLOCK vectors and
QUERIES queries by hash, each pair of blocks one group of bounded size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiwatch.llm.vectors import matrix, stored, usable

TOP = 20
EVERY = 20
TREES = 8
#: Vectors that fit the trees, in the driver.
SAMPLE = 16_384
#: Vectors a leaf should hold, and the greatest depth (16 vectors of the sample for each leaf).
LEAF, DEEPEST = 256, 10
#: A search takes leaves that hold so many times the table's vectors, and so many vectors at least.
BUDGET, LEAST = 0.6, 8192
#: Leaves of each queue that are looked into first, for a bound.
AHEAD = 4
#: How far the projections of a query and its neighbours are taken to agree.
KINSHIP = 0.4
BLOCK, QUERIES = 4096, 2048
SEED = 13

Batches = Iterator[pa.RecordBatch]

# log of the normal distribution function on a grid, for priorities.
_GRID = np.linspace(-8, 8, 3201)
_LOG_PHI = np.log(np.maximum(np.cumsum(np.exp(-(_GRID**2) / 2)) / np.exp(-(_GRID**2) / 2).sum(), 1e-16))


class Forest:
    """Trees in heap order: node i has children 2i + 1 and 2i + 2; leaves follow the inner nodes."""

    def __init__(self, sample: np.ndarray, longest: float, depth: int):
        self.longest, self.depth, self.inner = longest, depth, 2**depth - 1
        rng = np.random.default_rng(SEED)
        trees = TREES if depth else 1
        points, width = self.points(sample), sample.shape[1] + 1
        self.turns = rng.standard_normal((trees, self.inner, width)).astype(np.float32)
        self.cuts, self.spread = np.zeros((trees, self.inner)), np.ones((trees, self.inner))
        for t in range(trees):
            at = np.zeros(len(points), np.int64)
            for i in range(self.inner):
                mine = np.flatnonzero(at == i)
                if len(mine):
                    along = points[mine] @ self.turns[t, i]
                    self.cuts[t, i], self.spread[t, i] = np.median(along), max(along.std(), 1e-12)
                    at[mine] = 2 * i + 1 + (along > self.cuts[t, i])

    def points(self, x: np.ndarray) -> np.ndarray:
        scaled = x / self.longest
        return np.column_stack([scaled, np.sqrt(np.maximum(1 - (scaled * scaled).sum(axis=1), 0))])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        points, out = self.points(x), np.zeros((len(x), len(self.turns)), np.int64)
        for t, turns in enumerate(self.turns):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (np.einsum("ij,ij->i", points, turns[at]) > self.cuts[t, at])
            out[:, t] = at - self.inner
        return out

    def search(self, q: np.ndarray, sizes: np.ndarray, wanted: float) -> Iterator[list[tuple[int, int]]]:
        """For each query the (tree, leaf) pairs to look into, by one queue over all trees."""
        scaled = q / np.abs(q).max(axis=1, keepdims=True)
        scaled /= np.linalg.norm(scaled, axis=1, keepdims=True)
        margin = np.einsum("ij,tkj->itk", scaled, self.turns[:, :, :-1], optimize=True)
        z = KINSHIP * (margin - self.cuts) / self.spread / np.sqrt(1 - KINSHIP**2)
        right, left = np.interp(z, _GRID, _LOG_PHI), np.interp(-z, _GRID, _LOG_PHI)
        for below, above in zip(left, right):
            queue = [(0.0, t, 0) for t in range(len(self.turns))]
            found, held = [], 0
            while queue and held < wanted:
                miss, t, node = heapq.heappop(queue)
                if node >= self.inner:
                    found.append((t, node - self.inner))
                    held += sizes[t, node - self.inner]
                else:
                    heapq.heappush(queue, (miss - below[t, node], t, 2 * node + 1))
                    heapq.heappush(queue, (miss - above[t, node], t, 2 * node + 2))
            yield found


def distinct_vectors(embeddings: DataFrame, top: int = TOP) -> tuple[DataFrame, DataFrame]:
    """(key, e, owners) and (vec_id, e, row): each distinct vector with its top + 1 smallest (vec_id, row), one for each row that has it.

    `row` numbers the rows, so rows of one vec_id stay apart. The rank limit lets Spark cut copies before they are shuffled.
    """
    rows = usable(embeddings).filter("vec_id IS NOT NULL AND exists(e, c -> c != 0)")
    rows = stored(rows.withColumns({"row": F.monotonically_increasing_id(), "e": F.transform("e", lambda c: c + F.lit(0.0))}))
    first = Window.partitionBy("e").orderBy("vec_id", "row")
    few = rows.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= top + 1)
    owners = F.sort_array(F.collect_list(F.struct("vec_id", "row"))).alias("owners")
    return stored(few.groupBy("e").agg(owners).withColumn("key", F.monotonically_increasing_id())), rows


def fit(vectors: DataFrame) -> Forest:
    """The forest of a table of distinct vectors: fitted on SAMPLE of them, which their hash chooses."""
    seen = vectors.agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("e", F.lit(0.0), lambda s, c: s + c * c))).alias("longest")).first()
    depth = min(max(int(np.log2(seen.n / LEAF)), 0), DEEPEST) if seen.n > LEAF else 0
    sample = vectors.select("e").orderBy(F.xxhash64("e", F.lit(SEED))).limit(SAMPLE).toArrow()
    return Forest(matrix(sample.column("e")), seen.longest, depth)


def _rerank(top: int):
    def rerank(q: pa.Table, v: pa.Table) -> pa.Table:
        """Of one block of a leaf, the best `top` + 1 vectors for each query, ties to the smaller first id."""
        parts: list[tuple] = []
        if q.num_rows and v.num_rows:
            qm, vm, first = matrix(q.column("q")), matrix(v.column("e")), v.column("first").to_numpy()
            bound = q.column("bound").to_numpy()
            near = qm @ vm.T
            slack = 1e-12 * np.linalg.norm(qm, axis=1) * float(np.linalg.norm(vm, axis=1).max())
            for i, row in enumerate(near):
                last = np.partition(row, len(row) - top - 1)[len(row) - top - 1] if len(row) > top + 1 else -np.inf
                some = np.flatnonzero(row >= max(last, bound[i]) - slack[i])
                exact = (vm[some] * qm[i]).sum(axis=1)
                best = np.lexsort((first[some], -exact))[: top + 1]
                parts.append((i, some[best], exact[best]))
        at = np.concatenate([[i] * len(k) for i, k, _ in parts]).astype(np.int64) if parts else np.empty(0, np.int64)
        which = np.concatenate([k for _, k, _ in parts]) if parts else np.empty(0, np.int64)
        score = np.concatenate([s for _, _, s in parts]) if parts else np.empty(0)
        return pa.table({"query": q.column("query").to_numpy()[at], "key": v.column("key").to_numpy()[which], "first": v.column("first").to_numpy()[which], "score": score})

    return rerank


def search(embeddings: DataFrame, every: int = EVERY, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: the `top` nearest that were found for each query, itself left out.

    Takes vec_id and embedding; other columns are ignored. Queries are the rows whose vec_id is divisible by `every`,
    candidates all rows but the query's own. Null, zero and empty vectors, ones with null or non-finite components, ones of a
    rarer width, and rows without vec_id take no part. Rows that share a vec_id stay apart, as queries and as candidates. Ties go
    to the smaller vec_id. With fewer candidates than `top` there are fewer rows; an empty table gives none.
    """
    vectors, rows = distinct_vectors(embeddings, top)
    asked = rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "row", "e")
    out = "query_id long, rank int, vec_id long, score double"
    if vectors.isEmpty():
        return embeddings.sparkSession.createDataFrame([], out)
    forest = fit(vectors)

    def index(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                leaves = forest.leaves(matrix(batch.column("e"))).astype(np.int32)
                offsets = pa.array(np.arange(len(leaves) + 1, dtype=np.int32) * leaves.shape[1])
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("first"), batch.column("e"), pa.ListArray.from_arrays(offsets, pa.array(leaves.ravel()))], names=["key", "first", "e", "leaves"])

    first = vectors.select("key", F.col("owners")[0]["vec_id"].alias("first"), "e")
    indexed = stored(first.mapInArrow(index, "key long, first long, e array<double>, leaves array<int>"))
    placed = indexed.select("key", "first", "e", F.posexplode("leaves").alias("tree", "leaf"))
    sizes = np.zeros((len(forest.turns), 2**forest.depth), np.int64)
    for r in placed.groupBy("tree", "leaf").count().collect():
        sizes[r.tree, r.leaf] = r["count"]
    wanted = max(BUDGET * sizes[0].sum(), LEAST)

    def look(batches: Batches) -> Batches:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                for i, found in enumerate(forest.search(matrix(part.column("q")), sizes, wanted)):
                    columns = [pa.array([part.column("query")[i].as_py()] * len(found), pa.int64()), *(pa.array([f[j] for f in found], pa.int32()) for j in (0, 1))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(range(len(found)), pa.int32())], names=["query", "tree", "leaf", "at"])

    # Equal queries are one, too: they share their answers and differ in the row left out.
    of_vector = vectors.select("key", "e").join(asked.select("e").distinct(), "e", "left_semi").select(F.col("key").alias("query"), F.col("e").alias("q"))
    of_vector = stored(of_vector)
    visits = stored(of_vector.mapInArrow(look, "query long, tree int, leaf int, at int"))
    holding = placed.groupBy("tree", "leaf").agg(F.count("*").alias("holding"))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    mine = lambda c, n: F.pmod(F.xxhash64(c), F.col(n))
    best_first = Window.partitionBy("query").orderBy(F.desc("score"), "first")

    def met(visits: DataFrame) -> DataFrame:
        """query, key, first, score: the best of each block of the visited leaves, `bound` and above."""
        asking = visits.groupBy("tree", "leaf").agg(F.count("*").alias("asking"))
        plan = holding.join(asking, ["tree", "leaf"]).select("tree", "leaf", F.ceil(F.col("holding") / BLOCK).alias("vbs"), F.ceil(F.col("asking") / QUERIES).alias("qbs"))
        v = placed.join(plan, ["tree", "leaf"]).select("tree", "leaf", mine("key", "vbs").alias("vb"), upto("qbs").alias("qb"), "key", "first", "e")
        q = visits.join(plan, ["tree", "leaf"]).join(of_vector, "query").select("tree", "leaf", mine("query", "qbs").alias("qb"), upto("vbs").alias("vb"), "query", "q", "bound")
        block = ["tree", "leaf", "vb", "qb"]
        return q.groupBy(*block).cogroup(v.groupBy(*block)).applyInArrow(_rerank(top), "query long, key long, first long, score double")

    def best_vectors(near: DataFrame) -> DataFrame:
        """The best top + 1 vectors hold the best `top` rows besides the query's own. A vector comes from several trees with one score."""
        once = near.groupBy("query", "key").agg(F.max("score").alias("score"), F.first("first").alias("first"))
        return once.withColumn("place", F.row_number().over(best_first)).filter(F.col("place") <= top + 1)

    ahead = stored(best_vectors(met(visits.filter(F.col("at") < AHEAD).withColumn("bound", F.lit(float("-inf"))))).select("query", "key", "first", "score", "place"))
    bounds = ahead.filter(F.col("place") == top + 1).select("query", F.col("score").alias("bound"))
    rest = visits.filter(F.col("at") >= AHEAD).join(bounds, "query", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    few = best_vectors(ahead.select("query", "key", "first", "score").unionByName(met(rest)))
    named = few.join(vectors.select("key", "owners"), "key").select("query", "score", F.explode("owners").alias("o")).select("query", "score", "o.vec_id", "o.row")
    best = named.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row"))).filter(F.col("place") <= top + 1)
    answers = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "row"))).alias("best"))
    keyed = asked.join(vectors.select("e", F.col("key").alias("query")), "e").select("query_id", "row", "query")
    others = F.filter("best", lambda b: b["row"] != F.col("row"))
    return (
        keyed.join(answers, "query")
        .select("query_id", F.posexplode(F.slice(others, 1, top)).alias("at", "b"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "b.vec_id", "b.score")
    )
