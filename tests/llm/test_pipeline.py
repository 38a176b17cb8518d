import __spark_entry__ as entry
import pyarrow as pa
import corpus_pipeline
from kpiwatch.llm import decontam, neardup, pieces, pii, toxicity
from kpiwatch.llm.common import read_table

from tests.llm.test_decontam import brute as brute_hits
from tests.llm.test_neardup import brute as brute_groups


def test_stages_against_brute_force(spark, small_dir):
    """Each stage's decisions, retold in plain Python on what its predecessor kept."""
    docs = read_table(spark, small_dir, "documents")
    labels, items = read_table(spark, small_dir, "labels"), read_table(spark, small_dir, "benchmark")
    model = toxicity.train(docs, labels)
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {i: r.text for i, r in rows.items() if model.score(r.text) < 0.5}
    kept = {i: kept[i] for i, _, _, k in brute_groups(list(kept.items()), neardup.STAGE_PERCENT) if k}
    kept = {r[0]: kept[r[0]] for r in brute_hits(list(kept.items()), [(r.item_id, r.text) for r in items.collect()]) if not r[-1]}
    frame = spark.createDataFrame(list(kept.items()), "doc_id long, text string")
    spans = {r.doc_id: r.all_spans for r in pii.personal_data(frame).collect()}
    for i, found in spans.items():
        at, out = 0, ""
        for s in sorted(found, key=lambda s: (s.start, s.stop, s.kind)):
            if s.start >= at:
                out += kept[i][at : s.start] + f"[{s.kind.upper()}]"
            at = max(at, s.stop)
        kept[i] = out + kept[i][at:]
    voc = pieces.vocabulary()
    got = {r.doc_id: pieces.decode(r.ids, voc) for r in entry.queries()["pipeline"](spark, small_dir).filter("sample = 1").collect()}
    assert got == kept


def test_stages_take_empty_tables_nulls_and_extra_columns(spark, small_dir):
    docs = read_table(spark, small_dir, "documents").selectExpr("*", "1 AS score", "'x' AS th", "2 AS n")
    odd = spark.createDataFrame([(None, None, None, None, None, 1, "x", 2), (10**6, None, "en", "s", 0, 1, "x", 2), (10**6, "", "en", "s", 0, 1, "x", 2)], docs.schema)
    for table in (docs.limit(0), docs.limit(20).unionByName(odd)):
        now = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, small_dir)
            assert now.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, now, small_dir).count() >= 0


def test_stage_names_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "sentencepiece"]
    assert {f"op{n}" for n in range(1, 14)} <= {q.split("_")[0] for q in entry.queries()} and "pipeline" in entry.queries()
    assert decontam and neardup


def test_stages_that_run_python_take_small_batches(spark, small_dir, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    for module, name in ((toxicity, "without_toxic"), (neardup, "deduplicated"), (pieces, "encode")):
        monkeypatch.setattr(module, name, lambda docs, *_: docs.mapInArrow(lambda batches: batches, docs.schema))
    stages = dict(corpus_pipeline.STAGES)
    wide = spark.range(40, numPartitions=1).selectExpr("repeat('x', 1000000) AS text")
    before = spark.conf.get(key)
    try:
        for name in ("toxicity", "near_duplicates", "sentencepiece"):
            spark.conf.set(key, "64m")
            out = stages[name](spark, wide, small_dir)
            sizes = out.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
            assert len(sizes) > 1 and max(r.n for r in sizes) < 6_000_000
    finally:
        spark.conf.set(key, before)
