import hashlib
import re

import duckdb
import pytest

from kpiwatch.llm import decontam

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    out = []
    for doc, text in docs:
        ws, hit, ids = words(text), set(), set()
        for item, t in items:
            iw = words(t)
            size = min(len(iw), 10)
            for at in range(max(len(iw) - 9, 1)) if iw else ():
                win = iw[at : at + size]
                for p in range(len(ws) - size + 1):
                    if ws[p : p + size] == win:
                        hit.update(range(p, p + size))
                        if item is not None:
                            ids.add(str(item))
        out.append((doc, len(ws), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, doc_rows, items):
    df = decontam.contamination(docs(doc_rows), spark.createDataFrame(items, "item_id long, text string, ws string, h int"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=str)


ITEMS = [(1, "a b c d e f g h i j k l", "x", 0), (2, "short one", "x", 0), (3, "Single", "x", 0), (4, None, "x", 0), (5, "...", "x", 0), (10, "É été B C D E F G H I J", "x", 0), (7, "c d e f g h i j k l m n", "x", 0), (None, "null item words", "x", 0)]
DOCS = [
    (1, "A b, c D e f g h i j"), (2, "b c d e f g h i j"), (3, "x short  ONE y short one"), (4, "single"), (5, None), (6, ""), (7, "é été b c d e f g h i j"), (8, "É ÉTÉ b c d e f g h i j"), (9, "É été b c d e f g h i"),
    (10, "a b c d e f g h i j k l m n o p " * 200), (4, "single"), (None, "null item words"), (11, "a b c d e f g h i j a b c d e f g h i j"), (12, "shortone"),
]


def test_edge_cases_against_brute_force(spark, docs):
    assert run(spark, docs, DOCS, ITEMS) == brute(DOCS, [(i, t) for i, t, *_ in ITEMS])


def test_without_broadcast(spark, docs, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    assert run(spark, docs, DOCS, ITEMS) == brute(DOCS, [(i, t) for i, t, *_ in ITEMS])


def test_empty_tables(spark, docs):
    assert run(spark, docs, [], ITEMS) == []
    assert [r[-1] for r in run(spark, docs, DOCS[:3], [])] == [False] * 3


def test_stage_drops_contaminated_rows_only(spark, docs):
    d = docs(DOCS)
    out = decontam.decontaminated(d, spark.createDataFrame(ITEMS, "item_id long, text string, ws string, h int"))
    bad = {(r[0]) for r in brute(DOCS, [(i, t) for i, t, *_ in ITEMS]) if r[-1]}
    assert out.columns == d.columns and sorted(str(r.doc_id) for r in out.collect()) == sorted(str(i) for i, _ in DOCS if i not in bad)


@pytest.mark.parametrize("name", ["op3_uniform_threshold_topk", "op6_benchmark_decontamination", "op9_minhash_near_dedup"])
def test_queries_match_their_sql(spark, small_dir, name):
    import __spark_entry__ as entry

    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    rel = con.sql(entry.oracle_sql()[name])
    df = entry.queries()[name](spark, small_dir)
    assert sorted(df.columns) == sorted(rel.columns)
    assert sorted(tuple(r) for r in df.select(*rel.columns).collect()) == sorted(rel.fetchall())
