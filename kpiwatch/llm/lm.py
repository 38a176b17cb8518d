"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

Counts. Every token (words by ASCII white space, A-Z lower-cased, and one end for each text) of every
training document is counted. Tokens are 64-bit keys: a hash whose low bits are the token's ending, so
a rare word's class can be told from its key.

Model. The HEAD most frequent tokens are classes of their own; the others fall into TAIL classes by
ending. With contexts of two classes, the predicted vector is r = c1 * R[w1] + c2 * R[w2] and a
class scores r . Q[w] + b[w] (a log-bilinear model with diagonal position matrices). Within a tail
class, tokens have additive-smoothed shares that leave one share for what was never seen. All
probabilities of a context sum to one: the normalisers of all class pairs are one batched product.

Training. The model sees classes only, so the triples of a class and its two context classes, with the
times they stand in all training documents, say all that it can learn from them. Spark counts them
(there are at most classes^3), and deals each triple's times evenly to a number of groups that follows
from the corpus alone. A task trains one copy of the model for each group, on triples in hash order, a
buffer at a time; Spark averages the copies, weighted by tokens. So the scores don't depend on how the table
is partitioned, but for the last digits of float sums. A triple's gradient is weighted by its times. Noise is
drawn from the class frequencies.

Scores. Tasks take the counts of at most COMMON tokens with them. The others of a document travel
as (document, token, times) to the counts, by an ordinary join, so no count is ever dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiwatch.llm.common import Hashes, Places, cut, texts

FOLDS, HELD = 5, 1
HEAD = 255
TAIL = 128  # a power of two
WIDTH = 24
EPOCHS = 2
BATCH = 4096
NOISE = 32
RATE = 0.1
#: Most tokens whose counts are sent to every task.
COMMON = 262_144
#: Bytes of text whose tokens are made at a time (one text at least).
CHUNK = 2_000_000
#: Distinct context triples a task holds before it writes them out or trains on them.
BUFFER = 1_000_000
#: An example that stands more often is split into several, dealt to different batches.
HEAVY = 64
#: Tokens of a training group, and the most groups.
GROUP = 8_000_000
GROUPS = 64


#: Constants of XXH3 (64 bits, no seed): the first bytes of its secret, XORed as each length takes them, and its primes.
_FLIP_3, _FLIP_8, _FLIP_16A, _FLIP_16B = (np.uint64(x) for x in (0x87275A9B, 0xC73AB174C5ECD5A2, 0x6782737BEA4239B9, 0xAF56BC3B0996523A))
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _short(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """XXH3 of 1 to 3 bytes, the low ones of `first`."""
    one, eight = np.uint64(0xFF), np.uint64(8)
    x = (first & one) << np.uint64(16) | (first >> eight * (n >> np.uint64(1)) & one) << np.uint64(24) | first >> eight * (n - np.uint64(1)) & one | n << eight
    x ^= _FLIP_3
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0x165667B19E3779F9)
    return x ^ x >> np.uint64(32)


def _medium(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """XXH3 of 4 to 8 bytes, the low ones of `first`."""
    low = np.uint64(0xFFFFFFFF)
    x = ((first >> np.uint64(8) * (n - np.uint64(4)) & low) + (first << np.uint64(32))) ^ _FLIP_8
    x ^= (x << np.uint64(49) | x >> np.uint64(15)) ^ (x << np.uint64(24) | x >> np.uint64(40))
    x *= np.uint64(0x9FB21C651E98DF25)
    x = (x ^ (x >> np.uint64(35)) + n) * np.uint64(0x9FB21C651E98DF25)
    return x ^ x >> np.uint64(28)


def _long(first: np.ndarray, last: np.ndarray, n: np.ndarray) -> np.ndarray:
    """XXH3 of 9 to 16 bytes, by the first and the last eight."""
    a, b, low, half = first ^ _FLIP_16A, last ^ _FLIP_16B, np.uint64(0xFFFFFFFF), np.uint64(32)
    # Both halves of the product of 64 bits, XORed.
    ll, lh, hl = (a & low) * (b & low), (a & low) * (b >> half), (a >> half) * (b & low)
    middle = (ll >> half) + (hl & low) + lh
    folded = ((a >> half) * (b >> half) + (hl >> half) + (middle >> half)) ^ (middle << half | ll & low)
    x = n + a.byteswap() + b + folded
    x = (x ^ x >> np.uint64(37)) * np.uint64(0x165667919E3779F9)
    return x ^ x >> np.uint64(32)


class Keys(Hashes):
    """64-bit key of each token (bytes; the end is empty): a hash over the class of the ending."""

    def __init__(self, most: int = 400_000):
        super().__init__(most)
        ending = np.arange(1 << 16, dtype=np.uint64)
        mask = np.uint64(TAIL - 1)
        self.ones, self.twos = _short(ending[:256], np.uint64(1)) & mask, _short(ending, np.uint64(2)) & mask

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        tail = xxhash.xxh3_64_intdigest(word[-2:]) % TAIL
        key = (xxhash.xxh3_64_intdigest(word) & ~(TAIL - 1)) | tail
        self[word] = key = key - (1 << 64) if key >= 1 << 63 else key
        return key

    def of_texts(self, some: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The keys of the texts' tokens, one text after another, and how many each has (its end included).

        Words of up to 16 bytes are hashed together; the others one by one.
        """
        sizes = np.array([len(x) + 1 for x in some])
        joined = b" ".join(some).lower() + b" "
        raw = np.frombuffer(joined + bytes(16 - len(joined) % 8), np.uint8)
        edges = np.flatnonzero(np.diff(_SPACE[raw[: len(joined)]].view(np.int8), prepend=np.int8(1)))
        start, n = edges[::2], edges[1::2] - edges[::2]
        words = raw.view("<u8")

        def eight(at: np.ndarray) -> np.ndarray:
            shift = (at & 7).astype(np.uint64) << np.uint64(3)
            at = at >> 3
            return words[at] >> shift | words[at + 1] << np.uint64(1) << (np.uint64(63) - shift)

        first, length, keys = eight(start), n.astype(np.uint64), np.empty(len(n), np.uint64)
        for i, of in ((n < 4, _short), ((n >= 4) & (n < 9), _medium)):
            i = np.flatnonzero(i)
            keys[i] = of(first[i], length[i])
        i = np.flatnonzero((n >= 9) & (n < 17))
        keys[i] = _long(first[i], eight(start[i] + n[i] - 8), length[i])
        end = start + n
        two = raw[end - 2].astype(np.int64) | raw[end - 1].astype(np.int64) << 8
        keys = (keys & ~np.uint64(TAIL - 1) | np.where(n > 1, self.twos[two], self.ones[raw[end - 1]])).view(np.int64)
        for i in np.flatnonzero(n > 16).tolist():
            keys[i] = self[joined[start[i] : end[i]]]
        counts = np.diff(np.searchsorted(start, np.cumsum(sizes)), prepend=0) + 1
        last = np.cumsum(counts) - 1
        out, is_word = np.full(len(keys) + len(some), self[b""], np.int64), np.ones(len(keys) + len(some), bool)
        is_word[last] = False
        out[is_word] = keys
        return out, counts


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """A batch's texts in runs of about CHUNK bytes, each with the number of its first row."""
    held, size, at = [], 0, 0
    for text in texts(batch):
        held.append(text)
        size += len(text)
        if size >= CHUNK:
            yield at, held
            held, size, at = [], 0, at + len(held)
    if held:
        yield at, held


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def counts(docs: DataFrame) -> DataFrame:
    """token, c: how often each token occurs in `docs` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held, size = Keys(), [], 0

        def out() -> pa.RecordBatch:
            token, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(token, pa.int64()), pa.array(c, pa.int64())], names=["token", "c"])

        for batch in batches:
            for _, some in _chunks(batch):
                held.append(keys.of_texts(some)[0])
                size += len(held[-1])
                if size >= 2 * BUFFER:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return docs.select("text").mapInArrow(count, "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class Model:
    """Classes: the sorted head tokens, then the tails. Parameters and the log normalisers of class pairs."""

    head: np.ndarray
    log_noise: np.ndarray
    R: np.ndarray
    Q: np.ndarray
    C: np.ndarray
    b: np.ndarray
    log_z: np.ndarray | None = None
    #: Once normalised: what each context class gives each class from one place and from two places before.
    near: np.ndarray | None = None
    far: np.ndarray | None = None
    #: Adagrad's sums, where several calls of `train` are one run, and the times above which an example is split.
    steps: list[np.ndarray] | None = None
    heavy: float = HEAVY

    @property
    def classes(self) -> int:
        return len(self.head) + TAIL

    def of(self, tokens: np.ndarray) -> np.ndarray:
        """The class of each token."""
        spot = np.minimum(np.searchsorted(self.head, tokens), max(len(self.head) - 1, 0))
        tail = len(self.head) + (tokens & (TAIL - 1))
        return np.where(self.head[spot] == tokens, spot, tail) if len(self.head) else tail

    def contexts(self, w: np.ndarray, end: int, starts: np.ndarray | slice = slice(0, 1)) -> tuple[np.ndarray, np.ndarray]:
        """The classes one and two places before each token; before each text, which begin at `starts`, stand ends."""
        one = np.concatenate([[end], w[:-1]])
        one[starts] = end
        two = np.concatenate([[end], one[:-1]])
        two[starts] = end
        return one, two

    def normalise(self) -> None:
        """log of the sum of exp scores, for every pair of context classes, by batches of rows."""
        n = self.classes
        self.log_z = np.empty((n, n))
        self.near, self.far = (self.C[0] * self.R) @ self.Q.T + self.b, (self.C[1] * self.R) @ self.Q.T
        for i in range(n):
            scores = self.near[i] + self.far
            top = scores.max(axis=1, keepdims=True)
            self.log_z[i] = top[:, 0] + np.log(np.exp(scores - top).sum(axis=1))

    def log_prob(self, w: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Natural log-probability of each class given its context classes."""
        return self.near[one, w] + self.far[two, w] - self.log_z[one, two]

    def start(self) -> list[np.ndarray]:
        """Adagrad's sums before the first batch."""
        return [np.full_like(x, 1e-2) for x in (self.R, self.Q, self.C, self.b)]

    def train(self, w: np.ndarray, one: np.ndarray, two: np.ndarray, rng: np.random.Generator, times: np.ndarray | None = None) -> None:
        """Noise-contrastive estimation by Adagrad; each batch shares its noise classes.

        An example weighs as much as it stands (`times`, else once): as if it were repeated.
        """
        if times is None:
            times = np.ones(len(w))
        else:
            parts = np.ceil(times / self.heavy).astype(int)
            w, one, two, times = (np.repeat(x, parts) for x in (w, one, two, times / parts))
        mean = times.mean() if len(times) else 1.0
        noise = np.exp(self.log_noise)
        grads = self.steps or self.start()

        def spread(rows: np.ndarray, g: np.ndarray) -> np.ndarray:
            k = g.shape[1]
            return np.bincount((rows[:, None] * k + np.arange(k)).ravel(), g.ravel(), self.classes * k).reshape(-1, k)

        for _ in range(EPOCHS):
            order = rng.permutation(len(w))
            for at in range(0, len(order), BATCH):
                i = order[at : at + BATCH]
                y, x1, x2, often = w[i], one[i], two[i], times[i]
                n = rng.choice(self.classes, NOISE, p=noise / noise.sum())
                r1, r2 = self.R[x1], self.R[x2]
                r = self.C[0] * r1 + self.C[1] * r2
                good = np.einsum("ij,ij->i", r, self.Q[y]) + self.b[y] - np.log(NOISE) - self.log_noise[y]
                # Single precision does for the noise part, the largest one.
                r_, Q_ = r.astype(np.float32), self.Q[n].astype(np.float32)
                bad = r_ @ Q_.T + (self.b[n] - np.log(NOISE) - self.log_noise[n]).astype(np.float32)
                dg = -often / (1 + np.exp(np.clip(good, -30, 30)))
                db = often[:, None].astype(np.float32) / (1 + np.exp(-np.clip(bad, -30, 30)))
                gr = dg[:, None] * self.Q[y] + db @ Q_
                gq = spread(y, dg[:, None] * r)
                np.add.at(gq, n, db.T @ r_)
                gb = np.bincount(y, dg, self.classes)
                np.add.at(gb, n, db.sum(axis=0))
                gR = spread(x1, gr) * self.C[0] + spread(x2, gr) * self.C[1]
                gC = np.stack([(gr * r1).sum(axis=0), (gr * r2).sum(axis=0)])
                for p, s, g in zip((self.R, self.Q, self.C, self.b), grads, (gR, gq, gC, gb)):
                    g = g / (len(i) * mean)
                    s += g * g
                    p -= RATE * g / np.sqrt(s)


def _flat(m: Model) -> np.ndarray:
    return np.concatenate([x.ravel() for x in (m.R, m.Q, m.C, m.b)])


def _unflat(m: Model, flat: np.ndarray) -> None:
    at = 0
    for name in ("R", "Q", "C", "b"):
        shape = getattr(m, name).shape
        size = int(np.prod(shape))
        setattr(m, name, flat[at : at + size].reshape(shape).copy())
        at += size


def triples(docs: DataFrame, model: Model) -> DataFrame:
    """code, c: how often each class stands after each two classes in `docs` (text); code = (one * n + two) * n + class."""
    end = int(Keys()[b""])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held, waiting, n = Keys(), [], 0, model.classes
        last = int(model.of(np.array([end]))[0])
        code, times = np.empty(0, np.int64), np.empty(0, np.int64)

        def gather() -> None:
            """Count the triples that wait into (code, times)."""
            nonlocal code, times, held, waiting
            some, c = np.unique(np.concatenate(held), return_counts=True)
            both = np.concatenate([code, some])
            order = np.argsort(both, kind="stable")
            both = both[order]
            starts = np.flatnonzero(np.diff(both, prepend=-1))
            code, times = both[starts], np.add.reduceat(np.concatenate([times, c])[order], starts)
            held, waiting = [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(times, pa.int64())], names=["code", "c"])

        for batch in batches:
            for _, some in _chunks(batch):
                t, sizes = keys.of_texts(some)
                w = model.of(t)
                one, two = model.contexts(w, last, np.cumsum(sizes) - sizes)
                held.append((one * n + two) * n + w)
                waiting += len(w)
                if waiting >= BUFFER:
                    gather()
                if len(code) >= BUFFER:
                    yield out()
                    code, times = code[:0], times[:0]
        if held:
            gather()
        if len(code):
            yield out()

    return docs.select("text").mapInArrow(count, "code long, c long").groupBy("code").agg(F.sum("c").alias("c"))


def dealt(found: DataFrame, groups: int) -> DataFrame:
    """g, code, c: each triple's times shared out among the groups, as evenly as whole numbers go."""
    first = F.pmod(F.xxhash64("code"), F.lit(groups))
    each = found.select("code", "c", first.alias("first"), F.explode(F.sequence(F.lit(0), F.least(F.col("c"), F.lit(groups)).cast("int") - 1)).alias("i"))
    more = (F.col("i") < F.col("c") % groups).cast("long")
    return each.select(((F.col("first") + F.col("i")) % groups).cast("int").alias("g"), "code", (F.floor(F.col("c") / groups) + more).cast("long").alias("c"))


def trained(docs: DataFrame, model: Model) -> Model:
    """`model` trained on all tokens of `docs`: a copy for each group of dealt triples, averaged by Spark."""
    found = cut(triples(docs, model))
    total = found.agg(F.sum("c")).first()[0] or 0
    groups = max(1, min(GROUPS, -(-total // GROUP)))
    # Above GROUPS * GROUP tokens, examples grow heavier, not more.
    heavy = max(float(HEAVY), HEAVY * total / (groups * GROUP))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, m, seen, number, n = None, None, 0, 0, model.classes
        code, times = np.empty(0, np.int64), np.empty(0, np.int64)

        def learn(most: int) -> None:
            nonlocal code, times, seen, number
            now, often = code[:most], times[:most]
            m.train(now % n, now // n // n, now // n % n, np.random.default_rng([group, number]), often)
            seen, number = seen + int(often.sum()), number + 1
            code, times = code[most:], times[most:]

        def close() -> pa.RecordBatch:
            if len(code):
                learn(len(code))
            flat = _flat(m)
            return pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat), pa.array(np.full(len(flat), float(seen)))], names=["i", "v", "n"])

        for batch in batches:
            g, some, c = (batch.column(k).to_numpy() for k in ("g", "code", "c"))
            edges = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist(), len(g)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if g[a] != group:
                    if group is not None:
                        yield close()
                    group, seen, number = int(g[a]), 0, 0
                    code, times = code[:0], times[:0]
                    m = Model(model.head, model.log_noise, *(x.copy() for x in (model.R, model.Q, model.C, model.b)), heavy=heavy)
                    m.steps = m.start()
                code, times = np.concatenate([code, some[a:b]]), np.concatenate([times, c[a:b]])
                while len(code) >= BUFFER:
                    learn(BUFFER)
        if group is not None:
            yield close()

    parts = dealt(found, groups).repartitionById(groups, "g").sortWithinPartitions("g", F.xxhash64("code", "g"), "code")
    mean = parts.mapInArrow(fit, "i int, v double, n double").groupBy("i").agg((F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("v"))
    rows = mean.orderBy("i").toPandas()  # as many as the model has parameters
    if len(rows):
        _unflat(model, rows.v.to_numpy(float))
    return model


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of `docs`.

    Null texts are empty: one end. Rows whose crc32(doc_id as text) mod FOLDS is HELD are held out; a
    null doc_id isn't. Rows that repeat a doc_id and text give equal rows. With nothing to learn from, every
    token is unseen and has probability 1 in both scores (one unseen share is all there is).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    train = rows.filter(~held_out(F.col("doc_id")))
    c = cut(counts(train))
    step = F.floor(F.log2("c") * 8).cast("int")
    sizes = {r.step: (r.n, r.v) for r in c.groupBy(step.alias("step")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}  # one row for each step of 2^(1/8)
    N, V = sum(n for n, _ in sizes.values()), sum(v for _, v in sizes.values())
    least, taken = 0, 0
    for s in sorted(sizes, reverse=True):
        taken += sizes[s][1]
        if taken > COMMON:
            least = s + 1
            break
    common = c.filter(step >= least).toPandas().sort_values("token")  # COMMON rows at most
    tokens, times = common.token.to_numpy(np.int64), common.c.to_numpy(np.int64)
    end = int(Keys()[b""])
    top = sorted(zip((-times).tolist(), tokens.tolist()))[:HEAD]
    head = np.array(sorted({t for _, t in top} | {end}), np.int64)
    tails = {r.k: (r.n, r.v) for r in c.groupBy(F.col("token").bitwiseAND(F.lit(TAIL - 1)).alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    in_tail = np.array([tails.get(k, (0, 0)) for k in range(TAIL)], float)
    own = dict(zip(tokens.tolist(), times.tolist()))
    for t in head.tolist():
        if t in own:
            in_tail[t & (TAIL - 1)] -= own[t], 1
    # log10 of a tail class's denominator: its tokens, and one share for the unseen.
    denominator = np.log10(in_tail[:, 0] + 0.5 * (in_tail[:, 1] + 1))
    mass = np.concatenate([[own.get(t, 0) for t in head.tolist()], in_tail[:, 0]]) + 0.5
    rng = np.random.default_rng(1)
    n = len(mass)
    model = Model(head, np.log(mass / mass.sum()), rng.normal(0, 0.1, (n, WIDTH)), np.zeros((n, WIDTH)), np.ones((2, WIDTH)), np.log(mass / mass.sum()))
    model = trained(train, model)
    model.normalise()
    if not N:
        model.b[:] = 0

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = Keys()
        last = int(model.of(np.array([end]))[0])
        # One entry more, for what isn't among the common tokens.
        logs = np.append(np.log10(times + 0.5), 0.0)
        order = lambda x: x.view(np.uint64) ^ np.uint64(1 << 63)
        places = Places(order(tokens), 18) if len(tokens) else None
        shares = np.concatenate([np.zeros(len(head)), denominator])
        for batch in batches:
            for at, some in _chunks(batch):
                t, sizes = keys.of_texts(some)
                starts = np.cumsum(sizes) - sizes
                w = model.of(t)
                of_class = np.add.reduceat(model.log_prob(w, *model.contexts(w, last, starts)), starts) / np.log(10)
                spot = places.of(order(t)) if places else np.zeros(len(t), np.int64)
                known = tokens[spot] == t if places else np.zeros(len(t), bool)
                log = logs[np.where(known, spot, -1)]
                base = np.add.reduceat(log, starts)
                within = np.add.reduceat(np.where(w >= len(head), log, 0.0) - shares[w], starts)
                # After the documents' rows, each row brings a document's token to its count, a document's first one marked.
                row = np.repeat(np.arange(len(some)), sizes)[~known]
                rare = t[~known]
                by = np.lexsort((rare, row))
                row, rare = row[by], rare[by]
                new = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(rare, prepend=0) != 0))
                tf, row, rare = np.diff(new, append=len(rare)), row[new], rare[new]
                more, n = len(row), len(some)
                doc, th = (x if not more else pa.concat_arrays([x, x.take(pa.array(row))]) for x in (batch.column(c).slice(at, n) for c in ("doc_id", "th")))
                token = pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(rare, pa.int64())])
                found = np.add.reduceat(known.astype(np.int64), starts)
                longs = ([sizes, tf], [found, np.zeros(more, np.int64)], [np.ones(n, np.int64), np.diff(row, prepend=-1) != 0])
                doubles = ([base, np.zeros(more)], [of_class + within, np.zeros(more)])
                columns = [pa.array(np.concatenate(x).astype(kind)) for some_columns, kind in ((longs, np.int64), (doubles, np.float64)) for x in some_columns]
                yield pa.RecordBatch.from_arrays([doc, th, token, *columns], names=["doc_id", "th", "token", "tf", "known", "copies", "base", "score"])

    made = cut(rows.withColumn("th", F.xxhash64("text")).mapInArrow(score, "doc_id long, th long, token long, tf long, known long, copies long, base double, score double"))
    log = F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    rare = made.filter("token IS NOT NULL").join(c, "token", "left")
    known = F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0)
    # Repeated rows are summed together; each gets its part. There is one sum for each (doc_id, text), so the join
    # may split a hot one's rows among tasks.
    copies = F.sum("copies")
    sums = rare.groupBy(F.col("doc_id").alias("d"), F.col("th").alias("h")).agg((F.sum(known) / copies).cast("long").alias("more"), (F.sum(log) / copies).alias("log"))
    whole = made.filter("token IS NULL").join(sums, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h")), "left")
    total = float(np.log10(N + 0.5 * (V + 1)))
    more = F.coalesce("log", F.lit(0.0))
    return whole.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("tf").alias("n_tokens"),
        (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(N).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("tf") * total).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
