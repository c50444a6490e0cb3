import statistics

import pytest
from pyspark.sql import functions as F

from shipwright.operators import skew


@pytest.fixture()
def shuffled_joins(spark):
    """Joins by shuffle, and partitions as they come."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def skewed(spark, n=60_000):
    """A third of the rows without a key, a third with one key."""
    key = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 997).cast("string")))
    left = spark.range(n).select(F.col("id").alias("order_id"), key.alias("seller"))
    right = spark.range(900).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("seller"), F.col("id").alias("x")).union(
        spark.createDataFrame([("hot", -1), (None, -2)], "seller string, x long"))
    return left, right


def rows_by_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_no_task_has_much_more_than_the_median(spark, shuffled_joins):
    left, right = skewed(spark)
    heavy = skew.heavy_keys(left, "seller")
    assert [r[0] for r in heavy.collect()] == ["hot"]
    out = skew.spread_left_join(left, right, "seller", "order_id", heavy)
    sizes = rows_by_task(out)
    assert sum(sizes) == 60_000 and max(sizes) <= 2 * statistics.median(sizes)
    plain = rows_by_task(left.join(right, "seller", "left"))
    assert max(plain) > 5 * statistics.median(plain)


def test_rows_are_those_of_the_plain_join(spark):
    left, right = skewed(spark, 3000)
    want = sorted(left.join(right, "seller", "left").select("order_id", "seller", "x").collect())
    for heavy in (None, skew.heavy_keys(left, "seller"), skew.heavy_keys(left.limit(0), "seller")):
        out = skew.spread_left_join(left, right, "seller", "order_id", heavy)
        assert out.columns == ["seller", "order_id", "x"] and sorted(out.select("order_id", "seller", "x").collect()) == want
    twice = right.union(right.filter("seller = 'hot'"))                    # a key that the dimension has twice
    assert skew.spread_left_join(left, twice, "seller", "order_id", skew.heavy_keys(left, "seller")).count() == left.join(twice, "seller", "left").count()


def test_heavy_keys_are_few(spark):
    df = spark.range(100_000).select((F.col("id") % 150).alias("k"))
    assert skew.heavy_keys(df, "k", share=200).count() == 150 and skew.heavy_keys(df, "k", share=100).count() == 0
    assert skew.heavy_keys(df.filter("k < 0"), "k").count() == 0
