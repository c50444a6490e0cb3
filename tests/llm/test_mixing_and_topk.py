import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shipwright.llm import mixing, topk


def corpus(spark, rnd, sizes=(600, 150, 50, 10)):
    rows, i = [], 0
    for s, n in enumerate(sizes):
        for _ in range(n):
            rows.append((i, f"s{s}", " ".join(["w"] * rnd.randrange(1, 40))))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4), rows


def brute_exponent(shares, target, limit):
    def entropy(a):
        w = [p ** a for p in shares]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)

    def epochs(a):
        r = [p ** (a - 1) for p in shares]
        return max(r) / min(r)

    def bisect(good, lo, hi):            # good at lo
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if good(mid) else (lo, mid)
        return lo

    a = 1.0 if entropy(1.0) >= target * math.log(len(shares)) else bisect(lambda x: entropy(x) >= target * math.log(len(shares)), 0, 1)
    return a if epochs(a) <= limit else bisect(lambda x: epochs(x) <= limit, 1.0, 0.0)


@pytest.mark.parametrize("target, limit", [(0.8, 100.0), (0.95, 3.0), (0.1, 4.0), (1.0, 1e9)])
def test_exponent_by_bisection(spark, rnd, target, limit):
    df, rows = corpus(spark, rnd)
    sources = mixing.source_plan(mixing.keyed(df).drop("text"), target, limit).collect()
    total = sum(s.tokens for s in sources)
    want = brute_exponent([s.tokens / total for s in sources], target, limit)
    assert all(abs(s.exponent - want) < 1e-6 for s in sources)
    z = sum((s.tokens / total) ** want for s in sources)
    for s in sources:
        assert abs(s.weight - (s.tokens / total) ** want / z) < 1e-6
        assert s.budget / s.tokens <= limit * 1.001 + 1 / s.tokens and s.budget >= s.tokens


def test_stream_holds_the_weights_in_every_block(spark, rnd, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_TOKENS", 700)
    df, rows = corpus(spark, rnd)
    out = mixing.mixed_stream(df, target_entropy=0.9, max_epochs=8.0, block_tokens=6000).collect()
    by_source, weight = defaultdict(int), {}
    copies = defaultdict(set)
    for r in out:
        by_source[r.source] += r.n_tokens
        weight[r.source] = r.weight
        copies[r.doc_id].add(r.epoch)
    assert set(copies) == {r[0] for r in rows}                              # each document at least once
    assert all(e == set(range(len(e))) for e in copies.values())           # whole epochs first
    total = sum(by_source.values())
    assert all(abs(by_source[s] / total - w) < 0.01 for s, w in weight.items())
    per_source = defaultdict(set)
    for r in rows:
        per_source[r[1]].add(len(copies[r[0]]))
    assert all(max(c) - min(c) <= 1 for c in per_source.values())
    blocks = {r.block for r in out}
    for b in blocks:
        part = [r for r in out if r.block == b]
        assert sorted(r.slot for r in part) == list(range(len(part)))
        tokens = sum(r.n_tokens for r in part)
        for s, w in weight.items():
            assert abs(sum(r.n_tokens for r in part if r.source == s) / tokens - w) < 0.05
    docs = mixing.mixed_documents(df, target_entropy=0.9, max_epochs=8.0)
    assert {r.doc_id: r["count"] for r in docs.groupBy("doc_id").count().collect()} == {i: len(e) for i, e in copies.items()}
    assert docs.columns == df.columns


def test_given_budget_cuts_large_sources(spark, rnd):
    df, rows = corpus(spark, rnd)
    out = mixing.mixed_stream(df, target_entropy=0.97, max_epochs=50.0, budget=4000).collect()
    assert abs(sum(r.n_tokens for r in out) - 4000) < 4 * 40
    assert len({r.doc_id for r in out if r.source == "s0"}) < 600


def test_mixing_odd_rows(spark, odd_docs):
    out = mixing.mixed_documents(odd_docs)
    got = out.groupBy("size").count().collect()
    assert {r["size"] for r in got} == {r["size"] for r in odd_docs.collect()} and out.columns == odd_docs.columns
    assert mixing.mixed_stream(odd_docs).count() == out.count()
    assert mixing.mixed_documents(odd_docs.limit(0)).count() == 0 and mixing.mixed_stream(odd_docs.limit(0)).count() == 0
    blank = odd_docs.withColumn("text", F.lit(None).cast("string"))
    assert mixing.mixed_stream(blank).count() == 9


def test_mixing_runs_no_python(spark, odd_docs):
    plan = mixing.mixed_stream(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_top_k(rows, k):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in ok:
        if i % 10 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ok if j != i and len(w) == len(v))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "STRIP", 7)
    monkeypatch.setattr(topk, "FAN", 3)
    gen = np.random.default_rng(2)
    rows = [(i, [float(x) for x in gen.integers(-2, 3, 6) / 4]) for i in range(230)]       # many equal scores
    rows += [(300, None), (310, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (320, [float("nan")] * 6), (330, [float("inf")] * 6), (None, [1.0] * 6),
             (340, [0.5, 0.25]), (341, [0.5, 0.5]), (350, []), (360, [1e9, -1e9, 3e8, 1e9, 1e9, 1e9])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.exact_top_k(df, F.col("id") % 10 == 0, k=4, tile_rows=20, query_rows=9).collect()
    assert sorted(map(tuple, got)) == brute_top_k(rows, 4)
    assert topk.exact_top_k(df.limit(0), F.col("id") % 10 == 0).count() == 0
    few = topk.exact_top_k(df.filter("vec_id <= 3"), F.col("id") % 10 == 0, k=10).collect()
    assert len(few) == 3


def test_top_k_beyond_float_range_is_exact():
    q = np.array([[2.0 ** 30, 1.0]])
    s = np.array([[2.0 ** 30, 1.0], [2.0 ** 30, 2.0], [2.0 ** 30, 0.0]])
    ((_, ids, scores),) = topk.tile_hits(np.array([9]), q, np.array([1, 2, 3]), s, 3)
    assert ids.tolist() == [2, 1, 3] and scores.tolist() == [2 ** 60 + 2, 2 ** 60 + 1, 2 ** 60]
