import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shipwright.operators import quantiles as QU


def medians(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    return {r.g: r.m for r in QU.exact_median(df, ["g"], "v", "m").collect()}


def brute(rows):
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    return {g: statistics.median(v) for g, v in groups.items()}


def test_medians_of_odd_groups(spark):
    rnd = random.Random(5)
    rows = [("even", float(v)) for v in (4, 1, 9, 2)] + [("odd", 3.5), ("odd", -1.0), ("odd", 2.25), ("one", 7.0), ("gone", None)]
    rows += [("same", 1.5)] * 9 + [(None, 8.0), (None, 6.0)]
    rows += [("far", v) for v in (1e-9, 2e-9, 3e-9, 4e-9, 1e12, 1e15)]                # nearly all in one bucket, twice
    rows += [("halves", v) for v in [0.0] * 50 + [10.0] * 50]                          # the two middle ranks lie far apart
    rows += [("many", round(rnd.lognormvariate(0, 3), 3)) for _ in range(5001)]
    assert medians(spark, rows) == brute(rows)
    assert medians(spark, []) == {}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.floats(-1e6, 1e6, allow_subnormal=False)), max_size=40))
def test_medians_as_by_definition(spark, rows):
    assert medians(spark, rows) == pytest.approx(brute(rows))


def test_a_million_rows_of_one_group_without_a_buffer(spark):
    # 1,000,003 is prime: every value once, in no order
    df = spark.range(1_000_003).select(F.lit("g").alias("g"), ((F.col("id") * 7919) % 1_000_003 / 86400).alias("v"))
    out = QU.exact_median(df, ["g"], "v", "m")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not any(w in plan for w in ("percentile", "median", "collect_list", "collect_set"))
    assert out.first().m == 500_001 / 86400
    # what the last step counts is a sliver of the group
    widest = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" in widest and "HashAggregate" in widest


def test_unused_medians_cost_nothing(spark):
    from shipwright.registry import warehouse
    from tests.conftest import SF001
    mart = warehouse(spark, SF001)["mart_delivery_time_weekly_region"]
    plan = mart.select("week_start", "avg_delivery_days")._jdf.queryExecution().optimizedPlan().toString()
    assert "bucket" not in plan


def test_sketches_roll_up_within_their_rank_error(spark):
    rnd = random.Random(9)
    rows = [(f"r{i % 3}", f"s{i % 12}", rnd.lognormvariate(1, 1.5)) for i in range(60_000)]
    df = spark.createDataFrame(rows, "region string, state string, v double").repartition(7)
    stored = QU.sketch_table(df, ["region", "state"], "v")
    assert {r.n for r in stored.collect()} == {5000}
    bound = 3 * QU.rank_error()             # three times the error that 99 of 100 answers keep
    for by in (["region", "state"], ["region"]):
        merged = QU.merge_sketches(stored, by)
        whole = QU.sketch_table(df, by, "v")
        for share in (0.1, 0.5, 0.9):
            for sketches in (merged, whole):
                ranks = QU.rank_range(df, by, "v", sketches.withColumn("q", QU.sketch_quantile("sketch", share)), "q").collect()
                assert len(ranks) == (12 if len(by) == 2 else 3)
                assert all(r.low - bound <= share <= r.high + bound for r in ranks)
    exact = QU.exact_median(df, ["region"], "v", "m")
    q = {r.region: r.q for r in QU.merge_sketches(stored, ["region"]).withColumn("q", QU.sketch_quantile()).collect()}
    assert any(q[r.region] != r.m for r in exact.collect())                # it is an approximation
    sizes = [r.s for r in QU.merge_sketches(stored, ["region"]).select(F.length("sketch").alias("s")).collect()]
    assert max(sizes) < 10_000                                              # of 20,000 doubles
