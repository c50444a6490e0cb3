from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shipwright.llm import ngram_join as J
from shipwright.llm import shingles as S
from tests.llm.conftest import shingle_set


def brute_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        shared = defaultdict(int)
        for x in s:
            for j in holders[x]:
                if j > i:
                    shared[j] += 1
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def crafted(rnd):
    """Near-copy groups, unrelated texts around one passage, edits at the threshold, texts of a few common words."""
    words = [f"w{i}" for i in range(300)]
    pick = lambda n, v=words: [rnd.choice(v) for _ in range(n)]
    texts, passage, base = [], pick(60), pick(150)
    for _ in range(150):
        w = pick(rnd.randrange(20, 300))
        p = rnd.randrange(len(w))
        texts.append(w[:p] + passage + w[p:])
    for _ in range(120):
        w = list(base)
        for _ in range(rnd.randrange(0, 9)):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        texts.append(w[:rnd.randrange(110, 151)])
    for n in (3, 4, 5, 6, 8, 9, 12, 13, 18, 25, 40, 90, 200):
        for _ in range(4):
            b = pick(n)
            for _ in range(4):
                w = list(b)
                for _ in range(rnd.randrange(0, 2 + n // 40)):
                    w[rnd.randrange(len(w))] = rnd.choice(words)
                texts.append(w + pick(int(len(w) * rnd.choice([0, 0, .1, .2, .24]))))
    texts += [pick(rnd.randrange(5, 14), words[:3]) for _ in range(80)]
    return [(i, " ".join(w)) for i, w in enumerate(texts)]


def test_components_match_brute_force(spark, rnd):
    rows = crafted(rnd)
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicate_components(df).collect()}
    assert got == brute_components(rows)


def test_popular_signatures_lose_no_link(spark, rnd, monkeypatch):
    monkeypatch.setattr(J, "POPULAR", 3)
    rows = crafted(rnd)[:330]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicate_components(df).collect()}
    assert got == brute_components(rows)


def test_popular_signature_is_dealt_in_bounded_tiles(spark, monkeypatch):
    """Texts of a template share most signatures and no link: none of their groups lands in one task."""
    monkeypatch.setattr(J, "POPULAR", 40)
    tiles = J.dealt(spark.createDataFrame([(7, i, i) for i in range(300)] + [(8, i, i) for i in range(30)], "sig long, id long, label long")).collect()
    groups = defaultdict(list)
    for r in tiles:
        groups[r.sig, r.low, r.high].append((r.block, r.id))
    assert max(map(len, groups.values())) < 80 and len(groups[8, 0, 0]) == 30
    met = defaultdict(int)
    for (sig, low, high), rows in groups.items():
        for a, i in rows:
            for b, j in rows:
                if i < j and (low == high or a != b):
                    met[sig, i, j] += 1
    assert len(met) == 300 * 299 // 2 + 30 * 29 // 2 and set(met.values()) == {1}
    rows = [(i, f"one two three four five six seven eight w{i}") for i in range(200)] + [(200 + i, f"one two three four five six seven eight w{i} x") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicate_components(df).collect()}
    assert got == brute_components(rows) and got[200][1] == 0


def test_odd_rows(spark, odd_docs):
    got = sorted(((str(r.doc_id), r.n_shingles, r.component_id) for r in J.near_duplicate_components(odd_docs).collect()), key=str)
    assert got == sorted([("1", 3, 1), ("2", 0, 2), ("3", 0, 3), ("None", 3, None), ("4", 0, 4), ("5", 997, 5), ("6", 3, 1),
                          ("6", 3, 1), ("7", 1, 7)], key=str)
    assert J.near_duplicate_components(odd_docs.limit(0)).count() == 0


def test_similar_sets_always_share_a_signature(rnd):
    """Pairs right at the threshold, of all small sizes, meet in some signature."""
    gen = np.random.default_rng(3)
    for size in [*range(4, 60), 100, 200, 333]:
        for _ in range(6):
            a = np.unique(gen.integers(0, 1 << 63, size, dtype=np.uint64))
            for larger in range(size, size * 100 // 80 + 1):
                both = -(-80 * (size + larger) // 180)           # smallest intersection that links
                if both > size:
                    continue
                b = np.unique(np.r_[a[:both], gen.integers(0, 1 << 63, larger - both, dtype=np.uint64)])
                sig_a, sig_b = (set(np.concatenate(J.signatures(x)[0]).tolist()) for x in (a, b))
                assert sig_a & sig_b or J.most_different(len(a), len(b)) == 0, (size, larger)


def test_sketch_never_exceeds_the_difference():
    gen = np.random.default_rng(5)
    for n in (5, 50, 700):
        a = np.unique(gen.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.r_[a[n // 10:], gen.integers(0, 1 << 63, n // 9, dtype=np.uint64)])
        marks = J.fold([J.sketch(a), J.sketch(b)])
        assert int(np.bitwise_count(marks[0] ^ marks[1]).sum()) <= len(np.setxor1d(a, b))


def test_signature_stream_across_batches():
    rows = [(1, 5), (2, 1), (2, 1), (2, 3), (2, 4), (3, 9), (4, 2), (4, 7), (4, 7), (5, 1)]
    want = [(2, 1, 1), (2, 3, 1), (2, 4, 1), (4, 2, 2), (4, 7, 2)]
    for size in range(1, len(rows) + 1):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i:i + size])], ["sig", "id"]) for i in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in J._shared_only(iter(batches)) for r in b.to_pylist()]
        assert sorted(set(got)) == want, (size, got)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 499)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.label for r in J.components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 499: 499, 500: 499}


def test_shingles_follow_the_definition(rnd):
    texts = ["", None, "a", "A b", "a b c d e", "a  b c\x0bd e f", "x" * 100 + " b c d e", "É B c D e F", "a b c d e f"]
    values, offsets = S.shingle_sets(pa.array(texts).slice(0, len(texts)))
    sizes = [len(shingle_set(t)) for t in texts]
    assert np.diff(offsets).tolist() == sizes


def _roots(pairs, start):
    up = dict(start)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


def test_forest_joins_what_all_pairs_join(rnd):
    """Any split and tile size: as many components as with all possible pairs, by fewer pairs than rows."""
    gen = np.random.default_rng(9)
    sets = []
    for _ in range(6):
        base = gen.integers(0, 1 << 63, 60, dtype=np.uint64)
        sets += [np.unique(np.r_[base[rnd.randrange(1, 12):], gen.integers(0, 1 << 63, rnd.randrange(1, 9), dtype=np.uint64)]) for _ in range(12)]
    rnd.shuffle(sets)
    n = len(sets)
    ids, sizes, marks = np.arange(n) * 3, np.array(list(map(len, sets))), [J.sketch(s) for s in sets]
    for labels in (ids, ids - ids % 6):
        start = {int(i): int(l) for i, l in zip(ids, labels)} | {int(l): int(l) for l in labels}
        for split in (0, 20):
            for tile in (7, 256):
                got = [[(int(p), int(q)) for a, b in J._close_pairs(ids, labels, sizes, marks, split, forest, tile) for p, q in zip(a, b)]
                       for forest in (True, False)]
                assert _roots(got[0], start) == _roots(got[1], start)
                assert set(got[0]) <= set(got[1]) and len(got[0]) < n and len(got[0]) < len(got[1])
    assert not list(J._close_pairs(ids, ids * 0, sizes, marks, forest=True))


def test_merged_labels(spark):
    labels = spark.createDataFrame([(i, i - i % 3) for i in range(9)] + [(21, 20), (20, 20)], "id long, label long")
    links = spark.createDataFrame([(4, 7), (21, 30), (31, 32), (0, 1)], "a long, b long")
    got = sorted((r.id, r.label) for r in J.merged(labels, links).collect())
    want = [(0, 0), (1, 0), (2, 0)] + [(i, 3) for i in range(3, 9)] + [(20, 20), (21, 20), (30, 20), (31, 31), (32, 31)]
    assert got == want
    assert sorted((r.id, r.label) for r in J.merged(labels, links.limit(0)).collect()) == sorted((r.id, r.label) for r in labels.collect())
