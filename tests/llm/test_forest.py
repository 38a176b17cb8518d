import numpy as np
import pytest

import __spark_entry__ as entry
from kpiwatch.llm import forest

RNG = np.random.default_rng(8)


def brute(rows, every, top):
    """Each query row's `top` best other rows (scores summed like the operator's, so that ties are ties)."""
    good = [(i, np.array(e, dtype=np.float64)) for i, e in rows if i is not None and e is not None and len(e) and all(c is not None and np.isfinite(c) for c in e) and any(e)]
    widths = [len(e) for _, e in rows if e is not None and len(e) and all(c is not None and np.isfinite(c) for c in e)]
    common = max(set(widths), key=lambda w: (widths.count(w), w), default=0)
    good = [(i, e) for i, e in good if len(e) == common]
    out = []
    for at, (q, e) in enumerate(good):
        if q % every == 0:
            others = sorted((-float((e * f).sum()), v) for k, (v, f) in enumerate(good) if k != at)
            out += [(q, r, v, -s) for r, (s, v) in enumerate(others[:top], 1)]
    return sorted(out)


def run(spark, rows, every=5, top=3):
    df = spark.createDataFrame([(i, None if e is None else [None if c is None else float(c) for c in e], "q", 1) for i, e in rows], "vec_id long, embedding array<double>, query_id string, row int")
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in forest.search(df, every, top).collect())


@pytest.mark.parametrize(
    "rows",
    [
        [(i, RNG.normal(size=8)) for i in range(60)],
        [(i, [0.5, -0.5, 1, 2]) for i in range(30)],  # all tied
        [(i, RNG.normal(size=8)) for i in range(40)] + [(100 + i, [1.0] * 8) for i in range(60)],  # a common vector
        [(i, [-abs(x) for x in RNG.normal(size=4)]) for i in range(20)],
        [(0, [1.0, 2.0]), (1, [1.0, 2.0])],
        [(0, [1.0])],
        [(0, [1.0, 2.0]), (5, [3.0]), (10, [1.0, None]), (15, [float("nan"), 1.0]), (20, [float("inf"), 1.0]), (25, None), (30, []), (None, [1.0, 2.0]), (35, [0.0, -0.0]), (2, [0.1, 0.2])],
        [(5, [0.1, 0.2]), (5, [0.3, 0.2]), (5, [0.3, 0.2]), (6, [1.0, 1.0])],  # a repeated id, a repeated row
        [],
    ],
)
def test_small_tables_are_exact(spark, rows):
    """The least budget takes in a small table whole."""
    assert run(spark, rows) == brute(rows, 5, 3)


def test_small_blocks(spark, monkeypatch):
    for name, value in (("BLOCK", 16), ("QUERIES", 4), ("LEAF", 8)):
        monkeypatch.setattr(forest, name, value)
    rows = [(i, RNG.normal(size=6)) for i in range(120)] + [(200 + i, [0.7] * 6) for i in range(40)]
    assert run(spark, rows) == brute(rows, 5, 3)


def test_one_queue_for_all_trees():
    x = RNG.normal(size=(4000, 16))
    trees = forest.Forest(x, float(np.linalg.norm(x, axis=1).max()), 5)
    leaves = trees.leaves(x)
    sizes = np.stack([np.bincount(leaves[:, t], minlength=32) for t in range(forest.TREES)])
    assert (sizes.sum(axis=1) == 4000).all() and sizes.max() < 4000 / 32 * 1.2
    found = next(trees.search(x[:1], sizes, 1000))
    held = sum(sizes[t, leaf] for t, leaf in found)
    assert 1000 <= held <= 1000 + sizes.max() and len({t for t, _ in found}) > 1 and len(set(found)) == len(found)


@pytest.mark.parametrize("scaled", [False, True])
def test_recall(spark, monkeypatch, scaled):
    """Random directions in 32 dimensions, the hardest case; and lengths that differ by a factor of 3."""
    monkeypatch.setattr(forest, "LEAST", 500)
    x = RNG.normal(size=(5000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if scaled:
        x *= RNG.uniform(1, 3, size=(5000, 1))
    rows = list(enumerate(x))
    got, want = run(spark, rows, 50, 20), brute(rows, 50, 20)
    hits = {(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}
    assert len(got) == len(want) and len(hits) >= 0.9 * len(want)
    exact = {(q, v): float((x[q] * x[v]).sum()) for q, _, v, _ in got}
    assert all(exact[q, v] == s for q, _, v, s in got)
    for q in range(0, 5000, 50):
        mine = [(-s, v) for query, _, v, s in got if query == q]
        assert mine == sorted(mine)


def test_query(spark, small_dir):
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in entry.queries()["op13_projection_forest"](spark, small_dir).collect())
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    want = brute(rows, 20, 20)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    hits = {(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}
    assert len(hits) >= 0.9 * len(want)
