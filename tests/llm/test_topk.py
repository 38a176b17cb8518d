import numpy as np
import pytest

from kpiwatch.llm import topk


def floor256(c):
    """floor(256 * c) by exact fractions."""
    top, bottom = float(c).as_integer_ratio()
    return top * 256 // bottom


def brute(rows, every, top):
    """The contract's formula, row by row."""
    good = [(i, [floor256(c) for c in e]) for i, e in rows if i is not None and e is not None and len(e) and all(c is not None and np.isfinite(c) for c in e)]
    out = []
    for k, (q, x) in enumerate(good):
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), v) for j, (v, y) in enumerate(good) if j != k and len(y) == len(x))
            out += [(q, r + 1, v, -s if abs(s) < 10**38 else None) for r, (s, v) in enumerate(scores[:top])]
    return sorted(out, key=str)


def run(spark, rows, every=5, top=3):
    df = spark.createDataFrame([(i, None if e is None else [None if c is None else float(c) for c in e], "q", 1) for i, e in rows], "vec_id long, embedding array<double>, query_id string, score int")
    return sorted(((r.query_id, r["rank"], r.vec_id, None if r.score is None else int(r.score)) for r in topk.search(df, every, top).collect()), key=str)


RNG = np.random.default_rng(3)


@pytest.mark.parametrize(
    "rows",
    [
        [(i, RNG.normal(size=8)) for i in range(60)],
        [(i, [0.5, -0.5, 1, 2]) for i in range(30)],  # all tied
        [(i, RNG.normal(size=8)) for i in range(40)] + [(100 + i, [1.0] * 8) for i in range(30)],  # a common vector
        [(i, [-abs(x) for x in RNG.normal(size=4)]) for i in range(20)],  # negative scores
        [(0, [1.0, 2.0]), (1, [1.0, 2.0])],
        [(0, [1.0])],
        [(0, [1.0, 2.0]), (5, [3.0]), (10, [1.0, None]), (15, [float("nan"), 1.0]), (20, [float("inf"), 1.0]), (25, None), (30, []), (None, [1.0, 2.0]), (2, [0.1, 0.2]), (2, [0.3, 0.2]), (2, [0.3, 0.2])],
        [],
        [(i, [1e13 * (i % 3), -1e13, 3e12]) for i in range(12)],  # products beyond float64's integers
        [(i % 7, RNG.normal(size=6)) for i in range(30)],  # repeated ids
        [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (5, [1.0, 1.0]), (5, [1.0, 1.0])],
        [(i, RNG.normal(size=6) * 1e6) for i in range(30)],
        [(i, RNG.normal(size=6) * (1e15 if i % 4 == 0 else 1)) for i in range(30)],
        [(0, [1.0, 0.0]), (1, [300000.0, 1.0]), (2, [400000.0, 1.0])],
        [(0, [1.0, 0.0]), (1, [2.0, 1e307]), (2, [3.0, -1e307]), (5, [0.0, 1e308]), (6, [1e-300, 5e-324]), (7, [-1e-9, 1.0])],
    ],
)
def test_against_brute_force(spark, rows):
    assert run(spark, rows) == brute(rows, 5, 3)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERIES", 4)
    rows = [(i, RNG.normal(size=6)) for i in range(80)] + [(200 + i, [0.7] * 6) for i in range(20)]
    assert run(spark, rows) == brute(rows, 5, 3)


def test_codes_sort_like_numbers(spark):
    from pyspark.sql import functions as F

    numbers = sorted({s * (10**k + d) for s in (1, -1) for k in (0, 1, 5, 18, 30, 600) for d in (-1, 0, 1)})
    codes = [topk.coded(n) for n in numbers]
    assert codes == sorted(codes) and [topk.decoded(c) for c in codes] == numbers
    df = spark.createDataFrame([(c,) for c in codes], "code string").select(topk.number(F.col("code")).alias("n"))
    assert [r.n if r.n is None else int(r.n) for r in df.collect()] == [n if abs(n) < 10**38 else None for n in numbers]


def test_a_block_answers_with_its_best_scores_only(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(topk, "cut", lambda df, cut=topk.cut: sent.append(cut(df)) or sent[-1])
    monkeypatch.setattr(topk, "BLOCK", 64)
    # Half of a vector agrees with the queries and the other half doesn't: no list's cutoff decides.
    rng = np.random.default_rng(5)
    rows = [(i, np.concatenate([x := rng.normal(size=8), rng.normal(size=8) - x])) for i in range(400)]
    assert run(spark, rows, 20, 3) == brute(rows, 20, 3)
    queries, blocks = 20, -(-400 // 64)
    assert sent[-1].count() <= 3 * queries * blocks
