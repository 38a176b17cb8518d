import hashlib
import re

import pytest

from kpiwatch.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(map(int, reversed(digits))):
        total += c if i % 2 == 0 else c * 2 - 9 * (c > 4)
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in value.split(".")), "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def base(text):
    return [(k, m.start(), m.end()) for k, rx in BASE.items() for m in re.finditer(rx, text or "") if valid(k, m.group())]


def check(rows, texts):
    for r in rows:
        want = base(texts[r.doc_id])
        said = ",".join(f"{k}:{a}:{z}" for k, a, z in want)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest(), (r.doc_id, said, r.spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(w[0] == k for w in want) for k in BASE)
        assert {x for x in said.split(",") if x} <= set(r.spans.split(","))


TRICKY = [
    None, "", "no data", "a@b.co_x@c.de x@y.z.", "a@@b.c a.b%c@d-e.f-g.h!i@j", "1.2.3.4.5.6.7.8 999.1.1.1 0255.1.1.1 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "+1 (017) 555-7713 +12 3 +4", "é😀 a@b.cd 😀 10.0.0.1", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1 2", "x" * 3000 + "@" + "y" * 3000, "9" * 20000, "1." * 6000, "4111111111111111 4111111111111111+1234567890123", "a@b.c" * 50, "+1" * 500,
]


def test_base_spans_of_tricky_texts(spark, docs):
    texts = dict(enumerate(TRICKY))
    check(pii.personal_data(docs(texts.items())).collect(), texts)


def test_query_matches_plain_python_and_is_native(spark, small_dir):
    from kpiwatch.llm.queries import op2_contextual_pii

    df = op2_contextual_pii(spark, small_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    rows = df.collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_bootstrapping_finds_what_no_base_pattern_has(spark, docs):
    rows = [(i, f"write to me at user{i}@example.com today") for i in range(30)]
    rows += [(100, "please write to me at someone99887(at)example today"), (101, "the year was 12345 long ago")]
    got = {r.doc_id: r for r in pii.personal_data(docs(rows)).collect()}
    start = rows[30][1].index("someone99887")
    assert got[100].spans == f"email:{start}:{start + len('someone99887')}" and got[100].n_email == 0
    assert got[101].spans == ""


def test_masking_keeps_columns_and_the_rest_of_the_text(spark, docs):
    d = docs([(1, "é a@b.co, 10.0.0.1!"), (2, None), (None, "x@y.zz"), (3, "clean"), (1, "é a@b.co, 10.0.0.1!")])
    out = pii.masked(d)
    assert out.columns == d.columns
    assert sorted((r.doc_id or 0, r.text, r.n_chars) for r in out.collect() if r.doc_id != 2) == [(0, "[EMAIL]", 7), (1, "é [EMAIL], [IP]!", 16), (1, "é [EMAIL], [IP]!", 16), (3, "clean", 5)]


def test_empty_table_and_repeated_rows(spark, docs):
    assert pii.personal_data(docs([])).collect() == []
    assert pii.masked(docs([])).collect() == []
    rows = pii.personal_data(docs([(1, "a@b.cd"), (1, "a@b.cd"), (None, None)])).collect()
    assert [r.n_email for r in rows if r.doc_id == 1] == [1, 1] and len(rows) == 3


@pytest.mark.parametrize("n", [63, 64, 65, 200])
def test_positions_of_many_matches(spark, docs, n):
    text = " ".join(f"u{i}@h.de" for i in range(n))
    check(pii.personal_data(docs([(1, text)])).collect(), {1: text})


@pytest.mark.parametrize("value", ["(555) 123-4567", "555 123 4567", "5551234567", "555.123.4567"])
def test_grouped_digits_are_found_in_a_learned_context(spark, docs, value):
    rows = [(i, f"please call phone +1 555 {1000000 + i} soon") for i in range(40)]
    rows += [(100, f"or call phone {value} soon"), (101, f"order 17: call phone {value} soon"), (102, f"{value} people")]
    got = {r.doc_id: r.spans for r in pii.personal_data(docs(rows)).collect()}
    for i in (100, 101):
        start = dict(rows)[i].index(value)
        assert got[i] == f"phone:{start}:{start + len(value)}"
    assert got[102] == ""


@pytest.mark.parametrize("value", ["4111111111111112", "4111 1111 1111 1112", "4111-1111-1111-1112"])
def test_cards_that_fail_luhn_are_found_in_a_learned_context(spark, docs, value):
    def card(i):
        digits = f"411111111111{i:03d}"
        return next(digits + c for c in "0123456789" if luhn(digits + c))

    rows = [(i, f"id {i} card number {card(i)} ok") for i in range(40)] + [(100, f"id 5 card number {value} ok")]
    got = {r.doc_id: r for r in pii.personal_data(docs(rows)).collect()}
    start = rows[-1][1].index(value)
    assert got[100].n_card == 0 and got[100].spans == f"card:{start}:{start + len(value)}"


def test_contexts_are_alike_for_seeds_and_candidates(spark):
    from pyspark.sql import functions as F

    texts = ["a@b.cd mail 4711 to x1@y.zz", "a@b.cd mail 4711 to user12345(at)y", "word", "", "one two " + "z" * 300 + " 55555"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select(pii._spans(F.col("text"), "email").alias("e"), pii._spans(F.col("text"), "other").alias("o")).collect()
    assert got[0].e[-1].left == "0 to" and got[1].o[-1].left == "0 to" and got[1].o[-1].value == "user12345"
    assert got[2].o == [] and got[3].o == [] and len(got[4].o[0].left) == 64


def test_many_overlapping_spans_against_plain_python(spark, docs):
    import random

    rng = random.Random(4)
    words = ["4111111111111111", "+4111111111111111", "10.0.0.1", "a1@b.cd", "12345", "x", "é😀", "55 66 77", "(555) 12", "1.2.3.4@h.de"]
    texts = {i: " ".join(rng.choice(words) for _ in range(n)) for i, n in enumerate((10, 63, 64, 65, 130, 1500))}
    rows = pii.personal_data(docs(texts.items())).collect()
    check(rows, texts)
    for r in rows:
        spans = [(s.start, s.stop) for s in r.all_spans]
        added = [(s.start, s.stop) for s in r.all_spans if (s.kind, s.start, s.stop) not in base(texts[r.doc_id])]
        known = [(a, z) for _, a, z in base(texts[r.doc_id])]
        assert not any(a < y and x < z for a, z in added for x, y in known) and len(spans) == len(known) + len(added)
    wanted = {}
    for r in rows:
        at, out, t = 0, "", texts[r.doc_id]
        for s in sorted(r.all_spans, key=lambda s: (s.start, s.stop, s.kind)):
            if s.start >= at:
                out += t[at : s.start] + f"[{s.kind.upper()}]"
            at = max(at, s.stop)
        wanted[r.doc_id] = out + t[at:]
    assert {r.doc_id: r.text for r in pii.masked(docs(texts.items())).collect()} == wanted


def test_time_grows_with_the_matches(spark, docs):
    import time

    def took(n):
        table = docs([(1, " ".join(f"tel 555 {i:07d} mail u{i}@h.de" for i in range(n)))])
        start = time.time()
        pii.masked(table).write.format("noop").mode("overwrite").save()
        return time.time() - start

    took(100)
    assert took(32000) <= 2.5 * took(16000) + 2
