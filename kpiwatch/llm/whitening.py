"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation on distributed, centred rows.

X is the matrix of the centred rows, far too tall for one machine; its width d is small. The bidiagonalisation
X V = U B alternates u = X v and v = X'u and keeps every new vector orthogonal to all earlier ones. A v has d
entries and lives in the driver. A u has one entry for each row, so it is never gathered: as
u = X p with a p of d entries, each task makes its rows' part of every earlier u anew from the rows it reads.
One reading of the rows then gives, as sums over tasks,

    w = X p,   |w|^2,   c = U'w (what is left of the earlier u in w),   X'w.

u = (w - U c) / alpha is the next left vector, alpha its length before scaling, and X'u follows from the sums;
where c was not small, w is measured again after the correction. After d steps (or when the
space is exhausted: a start from a new direction finds nothing) the SVD of the small bidiagonal B gives the
singular values s of X and, turned by V, the components: eigenvectors of the covariance X'X / n with eigenvalues
s^2 / n.

A reading returns 2d + 1 sums. No task or driver holds rows beyond one batch, and a lost task is
repeated from the stored table alone, as nothing else is state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwatch.llm.vectors import lists, matrix, stored, usable

COMPONENTS = 32
SCALE = 64
OFFSET = 1_000_000
SEED = 11
#: Singular values below this share of the matrix's Frobenius norm are noise: their components are left out.
LEAST = 1e-10

Batches = Iterator[pa.RecordBatch]


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id, x (floor(64 * c) + 1000000 for each component c, as long) of the rows that take part."""
    x = F.transform("e", lambda c: F.floor(c * SCALE).cast("long") + OFFSET)
    return usable(embeddings).select("vec_id", x.alias("x"))


class Centre:
    """n vectors with per-dimension sums; n * x - sums is exact, in longs or else in Python integers."""

    def __init__(self, n: int, sums: list[int], largest: int):
        self.n, self.sums = n, sums
        self.long = 2 * n * max(largest, 1) < 2**62

    def deviations(self, column: pa.Array) -> np.ndarray:
        x = matrix(column, np.int64)
        if self.long:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def rows(self, column: pa.Array) -> np.ndarray:
        return self.deviations(column).astype(np.float64) / self.n

    def squared(self, column: pa.Array) -> list[int]:
        """Each row's sum of squared deviations, exact."""
        d = self.deviations(column)
        if self.long and d.size and float(np.abs(d).max()) ** 2 * d.shape[1] < 2**62:
            return (d * d).sum(axis=1).tolist()
        d = d.astype(object)
        return (d * d).sum(axis=1).tolist()


def _sums(x: DataFrame, part: Callable[[pa.Array], np.ndarray], size: int) -> np.ndarray:
    """The sum over all batches of `part`, an array of `size` numbers. Tasks add up first, then Spark."""

    def run(batches: Batches) -> Batches:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += part(batch.column("x"))
        yield pa.RecordBatch.from_arrays([lists(total[None], pa.float64())], names=["v"])

    parts = x.select("x").mapInArrow(run, "v array<double>").select(F.posexplode("v").alias("at", "v"))
    out = np.zeros(size)
    for row in parts.groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[row["at"]] = row.v
    return out


def centre(x: DataFrame) -> Centre | None:
    """The table's count and exact sums; None where it is empty."""
    largest = F.greatest(F.abs(F.array_max("x").cast("decimal(38,0)")), F.abs(F.array_min("x").cast("decimal(38,0)")))
    seen = x.agg(F.count("*").alias("n"), F.max(largest).alias("largest")).first()
    if not seen.n:
        return None
    by_dimension = x.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s"))
    return Centre(seen.n, [int(r.s) for r in by_dimension.orderBy("at").collect()], int(seen.largest))


def bidiagonalise(x: DataFrame, about: Centre, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """V (a column for each step) and the upper bidiagonal B of X V = U B, both fully reorthogonalised."""
    d = len(about.sums)
    rng = np.random.default_rng(SEED)
    v_all, p_all, z_all = (np.zeros((d, 0)) for _ in range(3))  # V; P with U = X P; Z = X'U
    diagonal, above = [], []

    def read(p: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """|Xp|^2, U'Xp and X'Xp, by one reading of the rows."""
        k = p_all.shape[1]

        def part(column: pa.Array, p_all: np.ndarray = p_all) -> np.ndarray:
            rows = about.rows(column)
            w = rows @ p
            return np.concatenate([[w @ w], (rows @ p_all).T @ w, rows.T @ w])

        got = _sums(x, part, 1 + k + d)
        return got[0], got[1 : 1 + k], got[1 + k :]

    def clean(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - v_all @ (v_all.T @ v)
        return v

    def fresh() -> np.ndarray:
        v = clean(rng.standard_normal(d))
        return v / np.linalg.norm(v)

    v, beta, p_last = fresh(), 0.0, np.zeros(d)
    while v_all.shape[1] < d:
        p = v - beta * p_last
        square, c, z = read(p)
        while np.linalg.norm(c) > 1e-8 * np.sqrt(square) and np.sqrt(square) > LEAST * norm:
            p = p - p_all @ c
            square, c, z = read(p)
        p, z, alpha = p - p_all @ c, z - z_all @ c, np.sqrt(max(square - c @ c, 0.0))
        if alpha <= LEAST * norm:
            if not beta:
                break  # a new direction, orthogonal to all, finds nothing: the rest of the space is empty
            v_all, z = np.column_stack([v_all, v]), np.zeros(d)
            diagonal, above, p_last = [*diagonal, 0.0], [*above, beta], np.zeros(d)
            p_all, z_all = np.column_stack([p_all, p_last]), np.column_stack([z_all, z])
            if v_all.shape[1] < d:
                v, beta = fresh(), 0.0
            continue
        p_last, z = p / alpha, z / alpha
        v_all, p_all, z_all = (np.column_stack([m, one]) for m, one in ((v_all, v), (p_all, p_last), (z_all, z)))
        diagonal, above = [*diagonal, alpha], [*above, beta]
        if v_all.shape[1] < d:
            v = clean(z - alpha * v)
            beta = float(np.linalg.norm(v))
            v, beta = (v / beta, beta) if beta > LEAST * norm else (fresh(), 0.0)
    return v_all, np.diag(diagonal) + np.diag(above[1:], 1) if diagonal else np.zeros((0, 0))


def components(x: DataFrame, about: Centre) -> tuple[np.ndarray, np.ndarray, float]:
    """Unit eigenvectors of the covariance (columns), their eigenvalues, falling, and its trace."""
    total = _sums(x, lambda column: np.array([(about.rows(column) ** 2).sum()]), 1)[0]
    v, b = bidiagonalise(x, about, float(np.sqrt(total)))
    if not b.size or not total:
        return np.zeros((len(about.sums), 0)), np.zeros(0), 0.0
    _, s, right = np.linalg.svd(b)
    kept = s > LEAST * np.sqrt(total)
    return (v @ right.T)[:, kept], s[kept] ** 2 / about.n, total / about.n


def whitened(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained, identity_error for each row and component.

    Takes vec_id and embedding; other columns are ignored. Null vectors and vectors with null or
    non-finite entries, empty ones and ones of a rarer width take no part; entries whose integer is beyond a long count as
    the long's end. All others are returned, with null or repeated vec_id too, a row for each of up to `most` components.
    Components without variance are left out, so an empty table, one row, or equal rows alone give no rows.
    `deviation` is null where it needs more than 38 digits.
    """
    schema = "vec_id long, deviation decimal(38,0), w array<double>"
    x = stored(quantised(embeddings))
    about = centre(x)
    vectors, values, trace = components(x, about) if about else (np.zeros((0, 0)), np.zeros(0), 0.0)
    turn = vectors[:, :most] / np.sqrt(values[:most])
    k = turn.shape[1]

    def moments(column: pa.Array) -> np.ndarray:
        y = about.rows(column) @ turn
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    error, explained = 0.0, [float(e / trace) for e in values[:most]]
    if k:
        got = _sums(x, moments, k + k * k) / about.n
        covariance = got[k:].reshape(k, k) - np.outer(got[:k], got[:k])
        error = float(np.abs(covariance - np.eye(k)).max())

    def project(batches: Batches) -> Batches:
        for batch in batches:
            column = batch.column("x")
            exact = [s if s < 10**38 else None for s in about.squared(column)]
            # Without components the rows go on empty and the explosion leaves none.
            y = lists(about.rows(column) @ turn, pa.float64()) if k else pa.array([[]] * len(column), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(exact, pa.decimal128(38, 0)), y], names=["vec_id", "deviation", "w"])

    rows = x.mapInArrow(project, schema).select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    shares = F.array(*[F.lit(e) for e in explained]) if explained else F.array().cast("array<double>")
    return rows.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(about.n if about else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
