import random
import zlib

import pytest

from kpiwatch.llm import toxicity as tx

RNG = random.Random(2)


def corpus(n=400):
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        ws = [f"w{RNG.randrange(200)}" for _ in range(30)] + (["vilewords"] if bad else [])
        RNG.shuffle(ws)
        rows.append((i, " ".join(ws)))
        if i % 2 == 0:
            labels.append((i, int(bad)))
    return rows, labels


def tables(spark, docs, rows, labels):
    return docs(rows), spark.createDataFrame([(i, t, 1) for i, t in labels], "doc_id long, toxic int, quality int")


def test_held_out_rows_are_told_apart(spark, docs):
    rows, labels = corpus()
    out = {r.doc_id: r for r in tx.toxicity(*tables(spark, docs, rows, labels)).collect()}
    for i, _ in rows:
        assert out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert out[i].predicted == int(i % 5 == 0) == int(out[i].score >= 0.5)


def test_held_out_labels_change_nothing(spark, docs):
    rows, labels = corpus(200)
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    a, b = (sorted((r.doc_id, r.score) for r in tx.toxicity(*tables(spark, docs, rows, x)).collect()) for x in (labels, flipped))
    assert a == b


def test_edges(spark, docs):
    rows, labels = corpus(200)
    more = rows + [(900, None), (901, ""), (None, "vilewords"), (902, "vilewords " * 20000), (0, rows[0][1])]
    labelled = labels + [(None, 1), (3, None), (0, 1), (0, 0)]
    out = [(r.doc_id, r.predicted, r.score) for r in tx.toxicity(*tables(spark, docs, more, labelled)).collect()]
    assert len(out) == len(more) and all(0 <= s <= 1 for _, _, s in out)
    by = {i: p for i, p, _ in out}
    assert (by[900], by[901], by[None], by[902]) == (0, 0, 1, 1)
    assert len({s for i, _, s in out if i == 0}) == 1


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(10**9, 1)]])
def test_nothing_to_learn(spark, docs, labels):
    rows, _ = corpus(20)
    out = tx.toxicity(*tables(spark, docs, rows, labels)).collect()
    assert len(out) == 20 and len({r.score for r in out}) == 1
    assert tx.toxicity(*tables(spark, docs, [], labels)).collect() == []


def test_stage_keeps_columns_and_clean_rows(spark, docs):
    rows, labels = corpus(200)
    d, l = tables(spark, docs, rows, labels)
    out = tx.without_toxic(d, l)
    assert out.columns == d.columns and sorted(r.doc_id for r in out.collect()) == [i for i in range(200) if i % 5]


def test_query_on_held_out_labels(spark):
    from kpiwatch.llm.queries import op10_toxicity

    folder = "/root/testdata/sf0.1"
    scores = {r.doc_id: r for r in op10_toxicity(spark, folder).collect()}
    labels = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if scores[r.doc_id].held_out]
    hit = sum(scores[r.doc_id].predicted == r.toxic for r in labels)
    assert hit / len(labels) > 0.95


def test_hot_id_and_equal_rows_stay_within_the_sample(spark, docs, monkeypatch):
    """A toxic id with a third of all rows, and a row that stands 300 times, leave the fit bounded and right."""
    rows, labels = corpus(400)
    hot = next(i for i, t in labels if t and zlib.crc32(str(i).encode()) % 5)
    rows += [(hot, f"vilewords w{i % 200} w{(i * 7) % 200} x{i}") for i in range(600)] + [rows[11]] * 300
    seen = []
    real = tx.fit
    monkeypatch.setattr(tx, "MOST_POSITIVE", 60)
    monkeypatch.setattr(tx, "MOST_UNLABELLED", 600)
    monkeypatch.setattr(tx, "fit", lambda pos, unl, *a: seen.append((len(pos), len(unl))) or real(pos, unl, *a))
    out = tx.toxicity(*tables(spark, docs, rows, labels)).collect()
    assert len(out) == len(rows)
    assert all(0 < p <= 60 and 0 < u <= 400 for p, u in seen)
    bad = {i for i in range(400) if i % 5 == 0}
    assert {r.doc_id for r in out if r.predicted} == bad
