"""MinHash near-duplicates with tensored banding, verified on full shingle sets.

A document's set is its distinct five-word shingles over ASCII-lower-cased words (fewer words: the
whole sequence as one shingle; no words: empty, linked with nothing). Two documents are linked when
100 * |A n B| >= 85 * |A u B| (operator 9) or 80 * |A u B| (the pipeline's stage); groups are the
connected components of the links.

Tensored banding: each set gets COLLECTIONS small collections of ROWS minhashes. A table key is a
*pair* of collections, so 20 * 4 = 80 minhashes serve the 190 tables of 8 minhashes that would
otherwise need 1520. Two sets meet in a table when at least two collections agree: at similarity s
they miss each other with probability P(Binomial(20, s^4) <= 1), which is 9e-6 at s = 0.85 and
2e-8 at 0.9. The stage has 28 collections and 378 tables, which miss a pair with 8e-6 at s = 0.8 (20
would with 4e-4).

Steps, none of which emits the pairs of a group:

1. One row per document: set size, 128-bit digest of the set, collections, and an odd sketch (a
   1024-bit parity bitmap of the set). Equal sets become one class; only classes go on.
2. A collection value that one class has alone can't be part of a shared key, so it is dropped
   before the pairs are formed.
3. Each bucket (in blocks of about BLOCK members) is walked for pairs that
   meet there first and whose sketches allow the similarity. The XOR of two odd sketches has at most |A xor B| bits set, so
   the test never rejects a true link.
4. Edges are verified on full sets. Confirmed ones merge components.

The tables are walked in rounds, with components merged in between, and a bucket whose members have one root by then is
dropped. The rounds of AHEAD take a few tables, one block of a bucket at a time, and emit spanning forests only: groups of near
copies become one component there, by about one edge a member. The last round takes all tables and every pair of blocks with
different components. There a walk emits all possible edges, up to EDGES a member, else a spanning forest; where rounds went
ahead, it emits one edge for every two components first. A block that left a pair out and had an edge refuted is walked
again, told of the refuted pairs and with GROWTH times the edges, until every block is settled: no pair of different components
that meets in a bucket and is still possible is left. Which links are found doesn't depend on the earlier rounds.

An edge names the bucket where its ends meet first, the only one of the last round that looks at the pair, so a refuted pair
goes to that bucket alone and not to each of the hundreds that hold an end. Written steps of few rows are read by few tasks:
a shuffle has a file for each task, whatever little it holds.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwatch.llm.common import MIX, Hashes, cut, mixed, texts

SHINGLE = 5
ROWS = 4
SKETCH_BITS = 1024
BLOCK = 2048
#: A walk lists the possible edges of its block up to so many per member, else a spanning forest.
EDGES = 4
#: Every further walk of a block may list so many times the edges of the walk before.
GROWTH = 4
#: Rows of 24 bytes that name the texts to compare; up to so many are sent to all executors, more are shuffled.
BROADCAST_ROWS = 1_000_000
#: Rows that a task reads of a written step at least, and sets (about as large as texts).
FEW, FEW_SETS = 4_000, 500
#: No bound on the edges listed for two components.
ALL = 1 << 40
#: Words whose hashes a task remembers at a time.
REMEMBERED = 100_000
#: A link: percent * |union| <= 100 * |intersection|. The first is operator 9's.
PERCENT, STAGE_PERCENT = 85, 80
#: Collections of minhashes for each percent.
COLLECTIONS = {PERCENT: 20, STAGE_PERCENT: 28}
#: The rounds before the last for each percent, and the tables (pairs of collections) that each walks.
AHEAD = {PERCENT: (), STAGE_PERCENT: (((0, 1),), ((2, 3), (4, 5)))}


def few(written: DataFrame, rows: int = FEW) -> DataFrame:
    """A written step, read by no more tasks than give each `rows` rows."""
    return written.coalesce(max(1, math.ceil(written.count() / rows)))


def shingles(text: bytes, hashes: Hashes) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of one text."""
    words = text.lower().split()  # of bytes: A-Z only, and the white space 0x20 and 0x09-0x0D only
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    if len(words) < SHINGLE:
        total = (h * MIX[: len(words)]).sum(keepdims=True) + np.uint64(len(words))
    else:
        n = len(words) - SHINGLE + 1
        total = h[:n] * MIX[0]
        for i in range(1, SHINGLE):
            total += h[i : i + n] * MIX[i]
    return np.unique(mixed(total))


def _seeds(collections: int) -> np.ndarray:
    return mixed(np.arange(1, collections * ROWS + 1, dtype=np.uint64) * MIX[0]) | np.uint64(1)


def _collections(values: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """One value per collection of minhashes, distinct between collections."""
    low = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 4096):
        x = seeds[:, None] * values[None, at : at + 4096]
        x ^= x >> np.uint64(32)
        np.minimum(low, x.min(axis=1), out=low)
    low = low.reshape(-1, ROWS)
    return mixed((low * MIX[:ROWS]).sum(axis=1) + np.arange(len(low), dtype=np.uint64)).view(np.int64)


def _sketch(values: np.ndarray) -> bytes:
    odd = np.bincount((values >> np.uint64(40)) % np.uint64(SKETCH_BITS), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


_SIGNED = "doc_id long, th long, n int, cls binary, coll array<long>, sketch binary"


def _sign(collections: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    seeds = _seeds(collections)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(REMEMBERED)
        for batch in batches:
            n, cls, coll, sketch = [], [], [], []
            for text in texts(batch):
                values = shingles(text, hashes)
                n.append(len(values))
                some = len(values) > 0
                cls.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest() if some else None)
                coll.append(_collections(values, seeds) if some else None)
                sketch.append(coll[-1].tobytes() + _sketch(values) if some else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int32()), pa.array(cls, pa.binary()), pa.array(coll, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                names=["doc_id", "th", "n", "cls", "coll", "sketch"],
            )

    return sign


def signatures(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, th (hash of the text), n (set size), cls (digest of the set), coll, sketch (coll, then the bitmap).

    A row without doc_id takes no part in groups: its cls is null, as is that of an empty text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = rows.withColumn("th", F.xxhash64("text")).mapInArrow(_sign(COLLECTIONS[percent]), _SIGNED)
    return signed.withColumn("cls", F.when(F.col("doc_id").isNotNull(), F.col("cls")))


def _classes(signed: DataFrame) -> DataFrame:
    """One row per distinct set, with one (doc_id, th) that has it."""
    one = F.min(F.struct("doc_id", "th", "n", "coll", "sketch")).alias("one")
    return signed.filter("cls IS NOT NULL").groupBy("cls").agg(one).select("cls", "one.*")


def buckets(classes: DataFrame, percent: int = PERCENT, roots: DataFrame | None = None, tables: tuple[tuple[int, int], ...] | None = None) -> DataFrame:
    """bucket, pair (the table's two collections), part, cls, root: buckets with two roots or more, in bounded parts.

    With `tables`, only those, each block of a bucket by itself. Without, all tables,
    and a bucket of more than BLOCK members in parts that bring together every two members of different roots
    at least once: those of its most common root are dealt into blocks, the others too, and each block of the others
    meets all blocks. So a bucket of one large component and a few others costs few more rows than it has members.
    """
    c = classes.select("cls", F.posexplode("coll").alias("i", "c"))
    if tables is not None:
        c = c.filter(F.col("i").isin([i for t in tables for i in t]))
    shared = c.groupBy("c").count().filter("count > 1").select("c")
    own = c.join(shared, "c").groupBy("cls").agg(F.sort_array(F.collect_set(F.struct("i", "c"))).alias("cs")).filter("size(cs) > 1")
    own = own.withColumn("root", F.col("cls")) if roots is None else own.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    table = f"struct(xxhash64(x.c, y.c) AS bucket, x.i * {COLLECTIONS[percent]} + y.i AS pair)"
    pairs = F.expr(f"flatten(transform(cs, (x, k) -> transform(slice(cs, k + 2, size(cs)), y -> {table})))")
    keys = own.select("cls", "root", F.explode(pairs).alias("k")).select("cls", "root", "k.*")
    if tables is not None:
        keys = keys.filter(F.col("pair").isin([i * COLLECTIONS[percent] + j for i, j in tables]))
    sizes = keys.groupBy("bucket").agg(F.count("*").alias("members"), F.min("root").alias("low"), F.max("root").alias("high"))
    sizes = sizes.filter("members > 1 AND low != high").select("bucket", "members")
    mixed = keys.join(sizes, "bucket")
    if tables is not None:
        part = F.pmod(F.xxhash64("cls"), F.ceil(F.col("members") / BLOCK)).cast("int")
        return mixed.select("bucket", "pair", "cls", "root", part.alias("part"))
    small = mixed.filter(F.col("members") <= BLOCK).select("bucket", "pair", "cls", "root", F.lit(0).alias("part"))
    large = mixed.filter(F.col("members") > BLOCK)
    most = large.groupBy("bucket", "root").agg(F.count("*").alias("n")).groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("m"), F.sum("n").alias("all"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    most = most.select("bucket", F.col("m.root").alias("common"), blocks(F.col("m.n")).alias("mains"), blocks(F.col("all") - F.col("m.n")).alias("others"))
    dealt = large.join(most, "bucket").withColumn("main", F.col("root") == F.col("common"))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("cls", F.lit(1)), F.when(F.col("main"), F.col("mains")).otherwise(F.col("others"))).cast("int"))
    # A part is (block of the common root, block of others), or two blocks of others.
    parts = F.expr("""CASE WHEN main THEN transform(sequence(0, others - 1), o -> mine * others + o)
        ELSE concat(transform(sequence(0, mains - 1), m -> m * others + mine),
          transform(sequence(0, others - 1), o -> mains * others + least(mine, o) * others + greatest(mine, o))) END""")
    return small.unionByName(dealt.select("bucket", "pair", "cls", "root", F.explode(parts).alias("part")))


class _Block:
    """The members of one part of a bucket; `pair` are the two collections of its table."""

    def __init__(self, pair: int, sizes: list[int], sketches: list[bytes], percent: int):
        self.percent, collections = percent, COLLECTIONS[percent]
        self.sizes = np.array(sizes, np.int64)
        words = np.frombuffer(b"".join(sketches), np.uint64).reshape(len(sizes), -1)
        self.coll, self.bits = words[:, :collections], words[:, collections:]
        self.first, self.second = divmod(pair, collections)

    def meeting(self, u: int, v: int) -> tuple[int, int]:
        """The first two collections that two members share: those of the bucket where they meet first."""
        x, y = self.coll[u][self.coll[u] == self.coll[v]][:2].view(np.int64).tolist()
        return x, y

    def possible(self, u: int, rest: np.ndarray, first: bool = True) -> np.ndarray:
        """Which of `rest` can be linked with `u`; with `first`, of those that meet `u` in this table first.

        The first table of two sets is that of the first two collections they share, so each pair
        is looked at once, in whatever many buckets it meets.
        """
        here = rest
        if first:
            agree = self.coll[rest] == self.coll[u]
            here = rest[(agree[:, : self.second + 1].sum(axis=1) == 2) & agree[:, self.first] & agree[:, self.second]]
        a, b = self.sizes[u], self.sizes[here]
        fits = here[100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)]
        # |A xor B| <= (100 - percent) / (100 + percent) * (|A| + |B|) is the link's condition in other words.
        odd = np.bitwise_count(self.bits[fits] ^ self.bits[u]).sum(axis=1, dtype=np.int64)
        return fits[odd * (100 + self.percent) <= (100 - self.percent) * (a + self.sizes[fits])]


def _block_edges(names: list[bytes], block: _Block, roots: np.ndarray, refuted: dict[bytes, set[bytes]], most: float, each: int) -> tuple[list[tuple[bytes, bytes]], bool]:
    """Possible links between different components, and whether some were left out.

    At most `each` for every two components, up to `most` per member; else (and with `most` 0, where all pairs of the block are looked at
    and not only those that meet here first) a spanning forest, found breadth first, where reaching
    one member of a component reaches all. A member is only compared with what is not reached yet,
    so a block of true copies costs one row of comparisons, not a square.
    """
    few, all_edges, joined, more = most * len(names), [], {}, False
    for u in range(len(names) - 1 if most else 0):
        rest = u + 1 + np.flatnonzero(roots[u + 1 :] != roots[u])
        bad = refuted.get(names[u], ())
        for v in block.possible(u, rest).tolist():
            if names[v] not in bad:
                both = (min(roots[u], roots[v]), max(roots[u], roots[v]))
                if joined.get(both, 0) >= each:
                    more = True
                else:
                    joined[both] = joined.get(both, 0) + 1
                    all_edges.append((names[u], names[v]))
        if len(all_edges) > few:
            break
    else:
        if most:
            return all_edges, more
    forest = []
    unseen = np.ones(len(names), bool)
    same: dict[int, list[int]] = {}
    for i, r in enumerate(roots.tolist()):
        same.setdefault(r, []).append(i)
    for start in range(len(names)):
        if not unseen[start]:
            continue
        queue = list(same[roots[start]])
        unseen[queue] = False
        while queue:
            u = queue.pop()
            bad = refuted.get(names[u], ())
            for v in block.possible(u, np.flatnonzero(unseen), first=most > 0).tolist():
                if unseen[v] and names[v] not in bad:
                    forest.append((names[u], names[v]))
                    queue += same[roots[v]]
                    unseen[same[roots[v]]] = False
    return forest, True


def _walk(percent: int, most: float, each: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by (bucket, part) -> edges; a member row has a sketch, a refuted pair has `other`."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(group: list[dict]) -> dict[tuple, bool]:
            members = {r["cls"]: r for r in group if r["sketch"] is not None}
            refuted: dict[bytes, set[bytes]] = {}
            for r in group:
                if r["other"] is not None:
                    refuted.setdefault(r["cls"], set()).add(r["other"])
                    refuted.setdefault(r["other"], set()).add(r["cls"])
            names = list(members)
            number: dict[bytes, int] = {}
            roots = np.array([number.setdefault(members[x]["root"], len(number)) for x in names])
            if len(number) < 2:
                return {}
            block = _Block(members[names[0]]["pair"], [members[x]["n"] for x in names], [members[x]["sketch"] for x in names], percent)
            some, more = _block_edges(names, block, roots, refuted, most, each)
            at = {x: i for i, x in enumerate(names)}
            return {(min(e), max(e), *block.meeting(at[e[0]], at[e[1]]), group[0]["part"]): more for e in some}

        def out(found: dict[tuple, bool]) -> pa.RecordBatch:
            keys = sorted(found)
            columns = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32()))]
            return pa.RecordBatch.from_arrays([*columns, pa.array([found[k] for k in keys], pa.bool_())], names=["a", "b", "x", "y", "part", "more"])

        def add(found: dict[tuple, bool], group: list[dict]) -> None:
            for e, more in edges(group).items():
                found[e] = found.get(e, False) or more

        key, group, found = None, [], {}
        for batch in batches:
            for row in batch.to_pylist():
                if (row["bucket"], row["part"]) != key:
                    add(found, group)
                    key, group = (row["bucket"], row["part"]), []
                group.append(row)
            if len(found) > 50_000:
                yield out(found)
                found = {}
        add(found, group)
        yield out(found)

    return walk


def _told(dealt: DataFrame, refuted: DataFrame, ahead: bool) -> DataFrame:
    """bucket, pair, part, cls, other: the refuted pairs (a, b, bucket) for the blocks that may find them again.

    In the last round those are the blocks of the bucket where the two meet first. A round ahead looks at all pairs of its
    few buckets, and has one or two rows of each class.
    """
    pairs = refuted.select(F.col("a").alias("cls"), F.col("b").alias("other"), "bucket")
    found = dealt.join(pairs.drop("bucket"), "cls") if ahead else dealt.join(pairs, ["bucket", "cls"])
    return found.select("bucket", "pair", "part", "cls", "other")


def _possible_edges(dealt: DataFrame, classes: DataFrame, roots: DataFrame | None, refuted: DataFrame | None, percent: int, most: float, each: int) -> DataFrame:
    """a, b, bucket, open: possible edges of the blocks; bucket: where the ends meet first; open: parts whose walk gave the edge and left others out."""
    rows = dealt.drop("root").join(classes.select("cls", "n", "sketch"), "cls")
    rows = rows.withColumn("root", F.col("cls")) if roots is None else rows.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    rows = rows.select("bucket", "pair", "part", "cls", "n", "sketch", "root", F.lit(None).cast("binary").alias("other"))
    if refuted is not None:
        empty = F.lit(None).cast("binary")
        told = _told(dealt, refuted, not most)
        rows = rows.unionByName(told.select("bucket", "pair", "part", "cls", F.lit(None).cast("int").alias("n"), empty.alias("sketch"), empty.alias("root"), "other"))
    walked = rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part").mapInArrow(_walk(percent, most, each), "a binary, b binary, x long, y long, part int, more boolean")
    walked = walked.withColumn("bucket", F.xxhash64("x", "y"))
    return walked.groupBy("a", "b", "bucket").agg(F.collect_set(F.when(F.col("more"), F.col("part"))).alias("open"))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = Hashes(REMEMBERED)
    for batch in batches:
        for cls, text in zip(batch.column("cls"), texts(batch)):
            yield pa.RecordBatch.from_arrays([pa.array([cls.as_py()], pa.binary()), pa.array([shingles(text, hashes).tobytes()], pa.binary())], names=["cls", "members"])


def _compare(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("a", "b", "bucket", "open")), pa.array(linked, pa.bool_())], names=["a", "b", "bucket", "open", "linked"])

    return compare


def _verified(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b, bucket, open, linked: each edge decided on its two full sets."""
    with_a = edges.join(sets.select(F.col("cls").alias("a"), F.col("members").alias("sa")), "a")
    with_b = with_a.join(sets.select(F.col("cls").alias("b"), F.col("members").alias("sb")), "b")
    return with_b.select("a", "b", "bucket", "open", "sa", "sb").mapInArrow(_compare(percent), "a binary, b binary, bucket long, open array<int>, linked boolean")


def components(edges: DataFrame) -> DataFrame:
    """(cls, root): every node of `edges` (a < b) with the smallest node of its component.

    Alternates large-star and small-star steps; each is one aggregation and one join on the node,
    so no task holds a component. It stops when the edges no longer change.
    """
    state, now = None, cut(edges.select("a", "b").distinct())
    rows = now.count()
    while True:
        tasks = max(1, math.ceil(2 * rows / FEW))
        now = now.coalesce(tasks)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).coalesce(tasks).distinct().coalesce(tasks)
        # Every edge now points from a node (a) to a smaller one (b).
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        now = cut(small.filter("a != b").coalesce(tasks).distinct().select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).coalesce(tasks))
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen == state:
            break
        state, rows = seen, seen.n
    stars = now.select(F.col("b").alias("cls"), F.col("a").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("cls"), "root").distinct())


def _with_sets(sets: DataFrame | None, edges: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """`sets` (cls, members) and those of the ends of `edges` that it lacks."""
    nodes = edges.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    if sets is not None:
        nodes = nodes.join(sets, "cls", "left_anti")
    wanted = cut(classes.select("cls", "doc_id", "th").join(nodes, "cls", "left_semi"))
    n = wanted.count()
    if sets is not None and not n:
        return sets
    wanted = F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = text.withColumn("th", F.xxhash64("text")).join(wanted, ["doc_id", "th"]).select("cls", "text")
    more = few(cut(found.mapInArrow(_sets, "cls binary, members binary").dropDuplicates(["cls"])), FEW_SETS)
    return more if sets is None else sets.unionByName(more)


def class_roots(docs: DataFrame, signed: DataFrame, percent: int = PERCENT) -> DataFrame | None:
    """(cls, root) of all classes that have a link to another class; None where there is none."""
    classes = few(cut(_classes(signed)))
    roots = links = refuted = sets = None
    for tables in (*AHEAD[percent], None):
        dealt = few(cut(buckets(classes, percent, roots, tables)))
        most, each = (0, 0) if tables is not None else (EDGES, 1 if AHEAD[percent] else ALL)
        while True:
            edges = few(cut(_possible_edges(dealt, classes, roots, refuted, percent, most, each)))
            most, each = most * GROWTH, each * GROWTH
            if edges.isEmpty():
                break
            sets = _with_sets(sets, edges, classes, docs)
            decided = few(cut(_verified(edges, sets, percent)))
            new, bad = decided.filter("linked").select("a", "b"), decided.filter("NOT linked")
            links = new if links is None else links.unionByName(new)
            refuted = bad.select("a", "b", "bucket") if refuted is None else refuted.unionByName(bad.select("a", "b", "bucket"))
            roots = few(cut(components(links))) if not links.isEmpty() else None
            open_parts = bad.select("bucket", F.explode("open").alias("part")).distinct()
            if tables is not None or open_parts.isEmpty():
                break  # every block is settled, or will be in the last round
            # A block goes on if one of the edges it gave was refuted.
            dealt = few(cut(dealt.join(open_parts, ["bucket", "part"], "left_semi")))
    return roots


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, th, n, root, least: one row per row of `docs`; least is the smallest doc_id of root's component.

    Rows that are in no component (without doc_id, or without words) have neither root nor least. Components are
    told to classes first (`low` is written, so that a join on a large component's root can be split), then to rows.
    """
    signed = cut(signatures(docs, percent))
    roots = class_roots(docs, signed, percent)
    rows = signed.select("doc_id", "th", "n", "cls")
    first = rows.filter("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("least"))
    if roots is None:
        of_class = first.withColumn("root", F.col("cls"))
    else:
        linked = cut(first.join(roots, "cls"))
        low = cut(linked.groupBy("root").agg(F.min("least").alias("least")))
        of_class = linked.select("cls", "root").join(low, "root").select("cls", "least", "root")
        of_class = of_class.unionByName(first.join(roots, "cls", "left_anti").withColumn("root", F.col("cls")))
    of_class = cut(of_class)
    return rows.join(of_class, "cls", "left").select("doc_id", "th", "n", "root", "least")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, th, n_shingles, component_id, kept: one row per row of `docs` (doc_id, text; others are ignored).

    component_id is the smallest doc_id reachable by links. Documents without words have no links and
    are their own component. A row without doc_id takes no part: component_id is null and kept is
    true. Rows of one doc_id with different texts are separate nodes; repeated rows share a class.
    An empty table gives an empty result.
    """
    return _grouped(docs, percent).select(
        "doc_id",
        "th",
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("least", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("least", "doc_id")).alias("kept"),
    )


def deduplicated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs`, one of each group: that of the smallest doc_id (then the smallest text hash).

    Unrelated texts under one doc_id are of different groups, and each group keeps its own row. Rows
    without doc_id, and texts without words, all stay. All columns of `docs` are returned.
    """
    found = _grouped(docs, percent).filter("doc_id IS NOT NULL")
    empty = found.filter("n = 0").select("doc_id", "th")
    named = found.filter("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc_id", "th")).alias("one")).select("one.*")
    keep = named.unionByName(empty.distinct()).select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"))
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__th": F.xxhash64(F.col("text").cast("string"))})
    with_id = keyed.join(keep, ["__id", "__th"], "left_semi").dropDuplicates(["__id", "__th"])
    return with_id.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))
