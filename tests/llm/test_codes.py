import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shipwright.llm import codes


def brute(rows, entries=64, rounds=2, parts=16, scale=256):
    """Whole-number k-means by definition: {(vec_id, place among equals): (code, error, label_error, digest)}."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for dim in {len(v) for _, v, _ in kept}:
        mine = sorted((r for r in kept if len(r[1]) == dim), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        step = -(-dim // parts)
        xs = []
        for _, v, _ in mine:
            whole = [math.floor(scale * x) for x in v] + [0] * (step * parts - dim)
            xs.append([whole[p * step:(p + 1) * step] for p in range(parts)])
        books = [[x[p] for x in xs[:entries]] for p in range(parts)]

        def nearest(x, book):
            d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in book]
            return min(range(len(d)), key=lambda j: (d[j], j)), min(d)
        for _ in range(rounds):
            for p in range(parts):
                code = [nearest(x[p], books[p])[0] for x in xs]
                for e in range(len(books[p])):
                    held = [x[p] for x, c in zip(xs, code) if c == e]
                    if held:
                        books[p] = books[p][:e] + [[sum(c) // len(held) for c in zip(*held)]] + books[p][e + 1:]
        sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        for r, x in zip(mine, xs):
            found = [nearest(x[p], books[p]) for p in range(parts)]
            out.append((r[0], "".join(f"{c:02x}" for c, _ in found), sum(d for _, d in found), r[2], sha))
    totals = {}
    for _, _, e, lab, _ in out:
        totals[lab] = totals.get(lab, 0) + e
    top = (1 << 63) - 1
    return sorted([(i, c, min(e, top), min(totals[lab], top), s) for i, c, e, lab, s in out], key=str)


def compressed(df, **kw):
    return sorted(map(tuple, codes.compress(df, **kw).collect()), key=str)


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


@pytest.mark.parametrize("dim, entries, rounds", [(64, 64, 2), (32, 16, 4), (20, 8, 3), (16, 64, 0)])
def test_codes_as_by_brute_force(spark, rnd, dim, entries, rounds):
    centres = [[rnd.gauss(0, 0.3) for _ in range(dim)] for _ in range(12)]
    rows = [(i, [c + rnd.gauss(0, 0.05) for c in centres[i % 12]], rnd.choice([None, 1, 2])) for i in range(250)]
    df = frame(spark, rows).repartition(4)
    assert compressed(df, entries=entries, rounds=rounds) == brute(rows, entries, rounds)


def test_ties_and_copies(spark, rnd):
    # components on a coarse grid: equal distances and equal codebook entries everywhere
    rows = [(i, [rnd.choice([-0.5, 0.0, 0.5]) for _ in range(32)], i % 2) for i in range(200)]
    rows += [(7, rows[7][1], 1), (7, [0.25] * 32, None), (None, [0.0] * 32, None), (None, [0.5] * 32, 5)]
    assert compressed(frame(spark, rows).repartition(3)) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [1.0, None] * 8, 1), (3, [nan] * 16, 1), (4, [inf] * 16, None), (5, [0.1] * 16, None), (6, [-0.1] * 16, None),
            (7, [], 3), (8, [1.5, 2.5], 3), (9, [1e30] * 16, 4), (10, [-1e300, 1e300] * 8, 4), (11, [1e300] * 16, 4), (12, [5e-324] * 16, 4)]
    assert compressed(frame(spark, rows)) == brute(rows)
    assert compressed(frame(spark, rows).filter("vec_id < 0")) == [] and compressed(frame(spark, rows[:4])) == []
    extra = frame(spark, rows).select("*", F.lit(1).alias("code"), F.lit("x").alias("v"), F.lit(2).alias("error"), F.lit(3).alias("id"))
    assert compressed(extra) == brute(rows)
    with pytest.raises(ValueError):
        codes.compress(frame(spark, rows), entries=300)


def test_bounds_skip_most_distances_and_carry_their_stamps(spark, rnd):
    centres = [[rnd.gauss(0, 1) for _ in range(64)] for _ in range(64)]
    rows = [(i, [c + rnd.gauss(0, 0.05) for c in centres[i % 64]], 0) for i in range(2000)]
    _, _, states = codes.train_and_assign(frame(spark, rows), rounds=3)
    scanned = [s.agg(F.sum("scanned")).first()[0] for s in states]
    assert scanned[0] == 2000 * 16 * 64 and all(s < 0.3 * scanned[0] for s in scanned[1:])
    stamps = {b for r in states[-1].select("stamp").collect() for b in bytes(r.stamp)}
    assert 0 in stamps and len(stamps) > 1                       # bounds of several rounds side by side


def test_net_ways_are_tighter_than_their_sum(rnd):
    there = np.array([[[0.0], [100.0]]])
    away = np.array([[[40.0], [100.0]]])
    h = codes.History([there, away, there])
    assert h.fallen(0).max() == 0.0                                # went and came back
    by_rounds = codes.History([there, away]).fallen(0) + codes.History([away, there]).fallen(0)
    assert by_rounds.max() >= 80.0


def test_many_labels_are_joined_in_salts(spark, rnd, monkeypatch):
    rows = [(i, [rnd.gauss(0, 1) for _ in range(16)], i % 50 if i % 3 else None) for i in range(300)]
    want = brute(rows)
    monkeypatch.setattr(codes, "sized", lambda df: df)
    assert compressed(frame(spark, rows)) == want
    assert compressed(frame(spark, [(i, v, lab) for i, v, lab in rows], "float")) == brute(
        [(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in rows])
