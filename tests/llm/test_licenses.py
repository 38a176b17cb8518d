import pytest

from kpiwatch.llm import licenses


@pytest.fixture(scope="module")
def model():
    return licenses.train([f"the quick brown {w} jumps over this {w} and that" for w in "fox dog cat bird cow hen".split()] * 5)


@pytest.mark.parametrize("family", sorted(licenses.TEMPLATES))
def test_templates_are_found(model, family):
    for t in licenses.TEMPLATES[family]:
        got, prob, sure = model.predict(licenses.words(t))
        assert (got, sure) == (family, True) and prob >= licenses.SURE


@pytest.mark.parametrize("text", ["the license of the software is in the work", "public domain", "we grant free charge to any person", "ordinary prose of no kind"])
def test_other_paragraphs_are_unknown(model, text):
    assert not model.predict(licenses.words(text))[2]


def test_altered_notice_is_found_and_named(model):
    ws = licenses.words("This code is Licensed under the Apache License, Version 2.0 -- see below")
    assert model.predict(ws)[::2] == ("apache", True)


def test_scan_rows(spark, docs, model):
    rows = [(1, "prose\n\nReleased under the MIT License.\nAll rights reserved."), (2, None), (3, ""), (None, "Licensed under CC BY-NC 4.0."), (1, "prose"), (4, "x " * 50000)]
    got = sorted(((r.doc_id or 0, r.n_paragraphs, r.n_license, r.families, r.paragraphs) for r in licenses.scan(docs(rows), model).collect()))
    assert got == [(0, 1, 1, "cc-by-nc", "0:cc-by-nc"), (1, 1, 0, "", ""), (1, 3, 2, "mit,reserved", "1:mit,2:reserved"), (2, 0, 0, "", ""), (3, 0, 0, "", ""), (4, 1, 0, "", "")]
    assert licenses.scan(docs([])).collect() == []


def test_query_finds_the_planted_lines(spark, small_dir):
    from kpiwatch.llm.queries import op7_license_scan

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    found = {r.doc_id for r in op7_license_scan(spark, small_dir).collect() if r.n_license}
    assert found == {i for i, t in texts.items() if "licen" in t.lower() or "rights reserved" in t.lower()}
