import random

import numpy as np
import pytest

from kpiwatch.llm import neardup as nd

RNG = random.Random(5)


def words(n, rng=RNG):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def shingle_set(text):
    ws = (text or "").encode().lower().split()
    return set() if not ws else {tuple(ws)} if len(ws) < 5 else {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)}


def brute(rows, percent=85):
    """doc_id -> smallest reachable doc_id, by comparing all pairs."""
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        least[find(x)] = min(least.get(find(x), i), i)
    return sorted((i, len(s), least[find(x)], i == least[find(x)]) for x, (i, s) in enumerate(sets))


def edited(ws, n, rng=RNG):
    out = list(ws)
    for p in rng.sample(range(len(ws)), n):
        out[p] = f"e{rng.randrange(10**6)}"
    return out


def corpus():
    rows = [(i, " ".join(words(60))) for i in range(20)]
    a, b = words(300), words(200)
    rows += [(100 + i, " ".join(edited(a, i % 9))) for i in range(60)]  # a large group of near copies
    rows += [(200 + i, " ".join(b)) for i in range(40)]  # exact copies
    chain = words(120)
    for i in range(15):  # neighbours are linked, the ends are not
        rows.append((300 + i, " ".join(chain)))
        chain = edited(chain, 1)
    c = words(40)
    rows += [(400 + i, " ".join(c + words(25))) for i in range(30)]  # a shared passage, no links
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "One two"), (504, "one TWO"), (505, "one two three four"), (506, "É é"), (507, "é é"), (508, " ".join(words(5000)))]
    return rows


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect() if r.doc_id is not None)


def test_against_brute_force(spark, docs):
    rows = corpus()
    assert got(nd.near_duplicates(docs(rows))) == brute(rows)


def test_forests_and_block_pairs_lose_no_link(spark, docs, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 16)
    monkeypatch.setattr(nd, "EDGES", 0.1)
    monkeypatch.setattr(nd, "BROADCAST_ROWS", 0)
    rows = corpus()
    assert got(nd.near_duplicates(docs(rows))) == brute(rows)


def test_stage_keeps_one_of_each_group(spark, docs):
    plain = corpus()
    rows = plain + [(None, "no id"), (None, "no id"), (503, "One two"), (500, "other text of a repeated id")]
    d = docs(rows)
    out = nd.deduplicated(d)
    assert out.columns == d.columns
    kept = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    assert kept == sorted([i for i, _, _, k in brute(plain) if k] + [500])
    assert sum(r.doc_id is None for r in out.collect()) == 2


def test_empty_table(spark, docs):
    assert nd.near_duplicates(docs([])).collect() == []
    assert nd.deduplicated(docs([])).collect() == []


def test_odd_sketch_never_rejects_a_link():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, 150).astype(np.uint64) * np.uint64(3))
        b = np.union1d(rng.choice(a, len(a) - rng.integers(0, 14), replace=False), rng.integers(0, 2**63, rng.integers(0, 10)).astype(np.uint64))
        x = np.bitwise_count(np.frombuffer(nd._sketch(a), np.uint8) ^ np.frombuffer(nd._sketch(b), np.uint8)).sum()
        assert x <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (3, 9), (9, 8), (4, 5)], [(i, i + 1) for i in range(1, 40)], [(1, i) for i in range(2, 30)]])
def test_components(spark, edges):
    rows = [(bytes([a]), bytes([b])) for a, b in edges]
    found = {r.cls[0]: r.root[0] for r in nd.components(spark.createDataFrame(rows, "a binary, b binary")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in edges:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert found == root


def test_stage_keeps_unrelated_texts_of_one_id(spark, docs):
    rng = random.Random(8)
    alone, other, third = (words(120, rng) for _ in range(3))
    rows = [(7, " ".join(alone)), (7, " ".join(other)), (7, " ".join(third)), (8, " ".join(edited(other, 1, rng))), (9, " ".join(edited(third, 1, rng)))]
    rows.append(rows[0])
    assert sorted((r.doc_id, r.text) for r in nd.deduplicated(docs(rows)).collect()) == sorted(rows[:3])


def test_pipeline_stage_links_from_four_fifths_on(spark, docs):
    import corpus_pipeline

    a, b, c = ([f"{k}{i}" for i in range(300)] for k in "abc")
    near = lambda ws, k: [f"e{i}" if i % 40 == 20 and i < 40 * k else w for i, w in enumerate(ws)]
    rows = [(1, a), (2, near(a, 6)), (3, b), (4, near(b, 5)), (5, c), (6, near(c, 7))]  # 0.816, 0.844 and 0.788
    d = docs([(i, " ".join(ws)) for i, ws in rows])
    assert [k for *_, k in got(nd.near_duplicates(d))] == [True] * 6
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, d, "").collect()) == [1, 3, 5, 6]


@pytest.mark.parametrize("size", [100, 500, 2000])
def test_edges_of_a_near_copy_group_stay_in_proportion(spark, docs, monkeypatch, size):
    """In the pipeline's stage: at most two edges a member over all rounds, and one component."""
    percent = nd.STAGE_PERCENT
    rng = random.Random(size)
    base = words(400, rng)
    rows = [(i, " ".join(edited(base, 1 + i % 3, rng))) for i in range(size)]
    counts = []
    monkeypatch.setattr(nd, "_possible_edges", lambda *a, f=nd._possible_edges: counts.append(f(*a)) or counts[-1])
    found = nd.near_duplicates(docs(rows), percent).collect()
    assert {r.component_id for r in found} == {0} and sum(r.kept for r in found) == 1
    assert sum(e.count() for e in counts) <= 2 * size


def test_a_bucket_of_one_component_and_few_others_is_dealt_in_proportion(spark, monkeypatch):
    """A full bucket's rows grow with its members, and every two members of different roots meet in a part."""
    monkeypatch.setattr(nd, "BLOCK", 32)
    coll = [1, 2, 3, 4, *range(100, 116)]
    name = lambda i: i.to_bytes(4, "big")
    classes = spark.createDataFrame([(name(i), coll if i < 2 else coll[:4] + [10_000 + 20 * i + k for k in range(16)]) for i in range(1000)], "cls binary, coll array<long>")
    roots = spark.createDataFrame([(name(i), name(0)) for i in range(980)], "cls binary, root binary")
    found = nd.buckets(classes, nd.PERCENT, roots).collect()
    by_bucket = {}
    for r in found:
        by_bucket.setdefault((r.bucket, r.pair), {}).setdefault(r.part, set()).add(bytes(r.cls))
    assert by_bucket
    for parts in by_bucket.values():
        members = set().union(*parts.values())
        others = {m for m in members if int.from_bytes(m, "big") >= 980}
        assert len(members) == 1000 and max(map(len, parts.values())) < 100
        assert sum(map(len, parts.values())) < 1000 + 2 * 20 * (1000 / 32 + 2)
        for o in others:
            assert set().union(*(p for p in parts.values() if o in p)) == members


def test_few_walks_settle_a_block_of_refuted_pairs(spark, docs, monkeypatch):
    """Two groups whose sketches allow links that the full sets refute need walks that grow, not one for each pair."""
    monkeypatch.setattr(nd._Block, "possible", lambda self, u, rest, first=True: rest)
    rng = random.Random(4)
    base = words(60, rng)
    rows = [(i, " ".join(base + words(40, rng))) for i in range(40)]
    counts = []
    monkeypatch.setattr(nd, "_possible_edges", lambda *a, f=nd._possible_edges: counts.append(1) or f(*a))
    assert got(nd.near_duplicates(docs(rows), nd.STAGE_PERCENT)) == brute(rows, 80)
    assert len(counts) <= 8


def test_stage_percent_against_brute_force(spark, docs):
    rows = corpus()
    assert got(nd.near_duplicates(docs(rows), nd.STAGE_PERCENT)) == brute(rows, 80)


def test_a_refuted_pair_is_told_to_the_bucket_of_its_first_meeting_only(spark, docs, monkeypatch):
    """Members of a group and texts just below the limit, whose pairs the sketches allow: not told to every bucket of an end."""
    rng = random.Random(11)
    base = words(400, rng)
    near = lambda k: [f"e{rng.randrange(10**6)}" if i in at else w for at in [rng.sample(range(5, 390, 5), k)] for i, w in enumerate(base)]
    rows = [(i, " ".join(near(4 if i < 16 else 5))) for i in range(24)]
    told, walks, walk = spark.sparkContext.accumulator(0), [], nd._walk

    def counted(*a):
        walks.append(a)
        inner = walk(*a)

        def count(batches):
            def seen():
                for batch in batches:
                    told.add(len(batch) - batch.column("other").null_count)
                    yield batch

            yield from inner(seen())

        return count

    monkeypatch.setattr(nd, "_walk", counted)
    refuted = []
    monkeypatch.setattr(nd, "_verified", lambda *a, f=nd._verified: refuted.append(nd.cut(f(*a))) or refuted[-1])
    assert got(nd.near_duplicates(docs(rows), nd.STAGE_PERCENT)) == brute(rows, 80)
    pairs = sum(r.filter("NOT linked").count() for r in refuted)
    assert pairs > 20 and 0 < told.value <= pairs * len(walks)


def test_an_edge_names_the_bucket_of_its_first_meeting(spark, docs):
    rng = random.Random(12)
    base = words(200, rng)
    d = docs([(i, " ".join(edited(base, 1 + i % 3, rng))) for i in range(30)])
    classes = nd._classes(nd.signatures(d)).cache()
    edges = nd._possible_edges(nd.buckets(classes), classes, None, None, nd.PERCENT, nd.EDGES, nd.ALL)
    coll = {bytes(r.cls): r.coll for r in classes.collect()}
    found = edges.selectExpr("a", "b", "bucket", "open").collect()
    firsts = {(bytes(r.a), bytes(r.b)): [x for x, y in zip(coll[bytes(r.a)], coll[bytes(r.b)]) if x == y][:2] for r in found}
    hashed = spark.createDataFrame([(*k, *v) for k, v in firsts.items()], "a binary, b binary, x long, y long").selectExpr("a", "b", "xxhash64(x, y) AS h").collect()
    assert found and {(bytes(r.a), bytes(r.b)): r.bucket for r in found} == {(bytes(r.a), bytes(r.b)): r.h for r in hashed}
