import math
from collections import Counter

import pytest

from kpiwatch.llm import pieces as P


@pytest.fixture(scope="module")
def voc():
    return P.vocabulary()


def paths(text, voc):
    """All segmentations of a short text with their log-probabilities, by plain recursion."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.MODEL)
    ids = {sp.id_to_piece(i).replace("▁", " "): i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    s, out = " " + text, []

    def go(at, way, w):
        if at == len(s):
            out.append((tuple(way), w))
        for to in range(at + 1, len(s) + 1):
            if s[at:to] in ids:
                i = ids[s[at:to]]
                go(to, [*way, i], w + float(voc.logp[i]))

    go(0, [], 0.0)
    total = math.log(sum(math.exp(w) for _, w in out))
    return {k: w - total for k, w in out}


@pytest.mark.parametrize("text", ["cat", "a b", "hello", "  x"])
def test_lattice_against_all_paths(voc, text):
    want = paths(text, voc)
    got = {}
    for key in range(60):
        for ids, phi, _ in P.sample([text], [key], 4, voc)[0]:
            got[tuple(ids)] = phi
    for k, phi in got.items():
        assert phi == pytest.approx(want[k], abs=1e-9)
    assert sum(map(math.exp, got.values())) > 0.99


def test_samples_are_distinct_and_distributed_without_replacement(voc):
    want = {k: math.exp(v) for k, v in paths("cat", voc).items()}
    n, first, second, weight = 3000, Counter(), Counter(), Counter()
    for key in range(n):
        (a, b) = P.sample(["cat"], [key * 7919 + 1], 2, voc)[0]
        assert a[0] != b[0]
        first[tuple(a[0])] += 1
        second[tuple(b[0])] += 1
        for ids, _, q in (a, b):
            weight[tuple(ids)] += 1 / q / n
    for k, p in want.items():
        if p > 0.05:
            assert first[k] / n == pytest.approx(p, abs=0.04)
            assert second[k] / n == pytest.approx(sum(r * p / (1 - r) for j, r in want.items() if j != k), abs=0.04)
            assert weight[k] == pytest.approx(1, abs=0.05)  # inclusion scores are unbiased


def test_rows_do_not_depend_on_their_neighbours(voc):
    texts = ["hello there", "", "some longer text\nwith lines", "日本 ▁ \x00 é"]
    keys = [3, 4, 5, 6]
    together = P.sample(texts, keys, 3, voc)
    assert together == [P.sample([t], [k], 3, voc)[0] for t, k in zip(texts, keys)]


TEXTS = [(1, None), (2, ""), (3, " "), (4, "plain words"), (5, "\n\n tabs\tand   spaces \n"), (6, "日本語 ▁ 😀 \x00é"), (7, "x" * 3000), (None, "no id"), (4, "plain words"), (8, "word " * 20000)]


def test_round_trip_and_edges(spark, docs, voc):
    rows = P.encode(docs(TEXTS), 3).collect()
    texts = dict((i, t or "") for i, t in TEXTS)
    assert all(r.round_trip and P.decode(r.ids, voc) == texts[r.doc_id] for r in rows)
    by_doc = Counter(r.doc_id for r in rows)
    assert by_doc[1] == by_doc[2] == 1 and by_doc[4] == 6 and by_doc[8] == 3
    assert len({tuple(r.ids) for r in rows if r.doc_id == 4}) == 3 and {r.inclusion for r in rows if r.doc_id == 2} == {1.0}
    assert P.encode(docs([])).collect() == []


def test_query_round_trips_everything(spark, small_dir):
    from kpiwatch.llm.queries import op8_sentencepiece_sampling

    rows = op8_sentencepiece_sampling(spark, small_dir).collect()
    assert all(r.round_trip for r in rows)
    assert len({r.doc_id for r in rows}) == spark.read.parquet(f"{small_dir}/documents.parquet").count()


def test_lattices_are_kept_from_chunk_to_chunk(voc, monkeypatch):
    texts = ["hello there", "some longer text\nwith lines", "日本 ▁ \x00 é 😀"]
    made = []
    add = P.Lattices._add
    monkeypatch.setattr(P.Lattices, "_add", lambda self, size, codes: made.append(len(size)) or add(self, size, codes))
    kept = P.Lattices(voc)
    first, again = (P._sampled(texts, [3, 4, 5], 3, kept) for _ in range(2))
    more = P._sampled([*texts, "hello new words"], [3, 4, 5, 6], 3, kept)
    assert made == [len(kept.number) - 2, 2]
    plain = lambda found: [[(ids.tolist(), *rest) for ids, *rest in x] for x in found]
    assert plain(first) == plain(again) == plain(more)[:3] == [[(ids, *rest) for ids, *rest in x] for x in P.sample(texts, [3, 4, 5], 3, voc)]
    monkeypatch.setattr(P, "REMEMBERED", 1)
    assert plain(P._sampled(texts, [3, 4, 5], 3, kept)) == plain(first) and len(kept.number) == made[-1]


def test_round_trips_tell_what_decodes(voc):
    texts = ["日本 é", "", "plain words", "other"]
    ids = [P.np.array(x[0][0], P.np.int32) for x in P.sample(texts, [1, 2, 3, 4], 1, voc)]
    assert P._round_trips(ids, texts, voc) == [True] * 4
    assert P._round_trips(ids, [*texts[:3], "another"], voc) == [True] * 3 + [False]


def test_blocks_are_those_of_the_pattern(voc):
    import re

    texts = ["", "  two  gaps \n x\n\n", "\n", "a\nb c", "日本  語\n ", "a b a b"]
    kept = P.Lattices(voc)
    number, size = {}, {}
    for text, got in zip(texts, kept.blocks(texts)):
        want = re.findall(r"\n| +[^ \n]*|[^ \n]+", " " + text)
        assert [len(b) for b in want] == kept.size[got].tolist()
        for b, n in zip(want, got.tolist()):
            assert number.setdefault(b, n) == n and size.setdefault(n, b) == b


def test_blocks_that_many_chunks_have_stay_when_others_are_forgotten(voc, monkeypatch):
    made = []
    add = P.Lattices._add
    monkeypatch.setattr(P.Lattices, "_add", lambda self, size, codes: made.append(len(size)) or add(self, size, codes))
    monkeypatch.setattr(P, "REMEMBERED", 60)
    kept = P.Lattices(voc)
    texts = ["two common", "two common", " ".join(f"rare{i}" for i in range(20)), "two common"]
    got = [[(ids.tolist(), *rest) for ids, *rest in P._sampled([text], [5], 3, kept)[0]] for text in texts]
    assert made == [2, 20] and kept.nodes <= 60 // 2
    assert got == [P.sample([text], [5], 3, voc)[0] for text in texts]
