import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry
from kpiwatch.llm import resample
from kpiwatch.llm.common import read_table


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(words), [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def brute(docs, target, percent=25):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000))))
    rows = []
    for i, text in docs:
        n, found = features(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        score = None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(found), weight, score, n))
    fit = sorted((r for r in rows if r[3] is not None and r[4] >= 20), key=lambda r: (-r[3], r[0], r[1], r[2]))
    drawn = fit[: percent * len(fit) // 100]
    out = [(*r[:4], place) for place, r in enumerate(drawn, 1)]
    left = Counter(r[:4] for r in rows) - Counter(r[:4] for r in drawn)
    return sorted(out + [(*r, None) for r in left.elements()], key=str)


def run(spark, docs, rows, target, percent=25):
    items = spark.createDataFrame([(str(i), t, "z") for i, t in enumerate(target)], "item_id string, text string, weight string")
    got = resample.resampled(docs(rows), items, percent)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    return sorted((tuple(r) for r in got.collect()), key=str)


def text(i, words=30):
    return " ".join(f"w{(i * 7 + k * k) % 23}" for k in range(words))


TARGET = ["w1 w2 W3, w4-w5", None, "", "Straße w1"]


@pytest.mark.parametrize(
    "rows",
    [
        [(i, text(i)) for i in range(80)],
        [(i, text(i, 15 + i % 10)) for i in range(60)],  # about 20 words
        [(i, text(1)) for i in range(50)],  # equal texts
        [(7, text(1))] * 60 + [(i, text(i)) for i in range(20)],  # one row repeated: its copies are drawn in part
        [(7, text(i)) for i in range(40)],  # one id, many texts
        [(None, text(1)), (1, None), (2, ""), (3, "., -"), (4, "ÄÖÜ ß é"), (None, None), *[(i, text(i)) for i in range(5, 30)]],
        [(1, text(1))],
        [(1, "too short")],
        [],
    ],
)
def test_against_brute_force(spark, docs, rows):
    assert run(spark, docs, rows, TARGET) == brute(rows, TARGET)


def test_without_target(spark, docs):
    rows = [(i, text(i)) for i in range(30)]
    assert run(spark, docs, rows, []) == brute(rows, [])


def test_all_drawn_and_many_rounds(spark, docs, monkeypatch):
    monkeypatch.setattr(resample, "PIVOTS", 1)
    monkeypatch.setattr(resample, "COPIES", 3)
    rows = [(i // 2, text(i // 2)) for i in range(70)]
    for percent in (100, 50, 3):
        assert run(spark, docs, rows, TARGET, percent) == brute(rows, TARGET, percent)


def test_long_text_in_pieces(spark, docs, monkeypatch):
    rows = [(1, "Lorem, ipsum-dolor é " * 60_000), *[(i, text(i)) for i in range(2, 12)]]
    assert run(spark, docs, rows, TARGET) == brute(rows, TARGET)
    whole = [int(b) for part in resample._buckets(rows[0][1].encode()) for b in part]
    assert Counter(whole) == Counter(features(rows[0][1])[1])


def test_query(spark, small_dir):
    got = entry.queries()["op12_importance_resampling"](spark, small_dir).collect()
    docs = [(r.doc_id, r.text) for r in read_table(spark, small_dir, "documents").collect()]
    items = [r.text for r in read_table(spark, small_dir, "benchmark").collect()]
    assert sorted(map(tuple, got), key=str) == brute(docs, items)
