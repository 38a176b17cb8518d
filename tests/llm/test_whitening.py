import numpy as np
import pytest

import __spark_entry__ as entry
from kpiwatch.llm import whitening

RNG = np.random.default_rng(5)
COLUMNS = "vec_id long, embedding array<double>, x string, n int, component string"


def usable(rows):
    good = [(i, e) for i, e in rows if e is not None and len(e) and all(c is not None and np.isfinite(c) for c in e)]
    widths = [len(e) for _, e in good]
    common = max(set(widths), key=lambda w: (widths.count(w), w), default=0)
    return [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in e]) for i, e in good if len(e) == common]


def run(spark, rows, most=32):
    df = spark.createDataFrame([(i, None if e is None else [None if c is None else float(c) for c in e], "x", 3, "y") for i, e in rows], COLUMNS)
    return whitening.whitened(df, most).collect()


def check(got, rows, most=32):
    """Against numpy's eigenvectors of the covariance; one sign for all rows of a component."""
    good = usable(rows)
    n = len(good)
    x = np.array([e for _, e in good], dtype=np.float64)
    sums = [sum(column) for column in zip(*[e for _, e in good])]
    centred = np.array([[float(n * c - s) for c, s in zip(e, sums)] for _, e in good]) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, int((np.sqrt(np.maximum(values, 0) * n) > 1e-9 * np.linalg.norm(centred)).sum()))
    assert len(got) == n * k and x.shape[0] == n
    deviations = sorted((i or 0, sum((n * c - s) ** 2 for c, s in zip(e, sums))) for i, e in good)
    assert sorted((r.vec_id or 0, int(r.deviation)) for r in got if r.component == 1) == deviations
    for j in range(k):
        mine = sorted((r for r in got if r.component == j + 1), key=lambda r: (r.vec_id or 0, int(r.deviation), r.whitened**2))
        assert {r.n for r in mine} == {n} and max(r.identity_error for r in mine) <= 1e-4
        assert np.allclose([r.explained for r in mine], values[j] / values.sum(), rtol=1e-9)
    return centred, values, vectors, k


def components_of(got, rows, k):
    by = {(r.vec_id, r.component): r.whitened for r in got}
    return np.array([[by[i, j + 1] for j in range(k)] for i, _ in usable(rows)])


def test_against_eigenvectors(spark):
    scale = np.linspace(3, 0.2, 12)
    rows = [(i, RNG.normal(size=12) * scale) for i in range(400)]
    got = run(spark, rows, 8)
    centred, values, vectors, k = check(got, rows, 8)
    ours = components_of(got, rows, k)
    theirs = centred @ vectors[:, :k] / np.sqrt(values[:k])
    signs = np.sign((ours * theirs).sum(axis=0))
    assert k == 8 and np.abs(ours - theirs * signs).max() < 1e-9


def test_equal_eigenvalues(spark):
    """Any basis of an eigenspace will do; the whitened rows must still be uncorrelated with variance 1."""
    rows = [(2 * i + (s > 0), s * 4 * np.eye(6)[i]) for i in range(6) for s in (1, -1)]
    got = run(spark, rows)
    check(got, rows)
    ours = components_of(got, rows, 6)
    assert np.abs(ours.T @ ours / 12 - np.eye(6)).max() < 1e-9


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, [1.0, 2.0])],
        [(i, [0.5, 0.25]) for i in range(9)],  # no variance at all
        [(None, None), (1, []), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0])],
        [(i, [v, 2 * v, 7.0]) for i, v in enumerate([1.0, 2.0, 4.0, 8.0])],  # rank one, a constant
        [(7, [1.0, 2.0]), (7, [1.0, 2.0]), (7, [3.0, -2.0]), (None, [0.0, 5.0]), (9, [1.0, 2.0, 3.0]), (8, None)],  # repeated, null id, width
        [(i, [1.0, 0.0, 0.0]) for i in range(300)] + [(900 + i, RNG.normal(size=3)) for i in range(40)],  # a common vector
        [(i, [1e9 * v, -3e9 * v * v]) for i, v in enumerate(RNG.normal(size=20))],  # sums of squares beyond a long
        [(i, [c]) for i, c in enumerate((1.0, 2.0, 5.0))],
    ],
)
def test_edges(spark, rows):
    good = usable(rows)
    if len({tuple(e) for _, e in good}) < 2:
        assert run(spark, rows) == []
    else:
        check(run(spark, rows), rows)


def test_query(spark, small_dir):
    got = entry.queries()["op11_embedding_whitening"](spark, small_dir)
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    check(got.collect(), rows)
