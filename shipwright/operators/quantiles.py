"""Medians of groups of any size: exact ones by distributed selection, approximate ones from mergeable sketches.

Exact selection never holds a group. A group's range of values is cut into buckets, rows are counted by (group,
bucket), and only the buckets that hold the middle ranks are cut again; after ``LEVELS`` cuts the distinct values left are
counted and the one or two in the middle are taken. Every step is an aggregation that starts in the map
tasks, and what a window orders is a group's bucket counts, not its rows.

A sketch (KLL) is a few kilobytes whatever the group's size. Sketches are kept per finest group and merged for coarser
ones, so a roll-up reads no rows. Its rank error is bounded by ``rank_error(k)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS, LEVELS = 1024, 2
SKETCH_K = 200


def _bucket(value, low, high):
    """Bucket of a value between low and high, from 0; never falls as the value grows, and low and high lie in different ones."""
    share = (F.col(value) - F.col(low)) / (F.col(high) - F.col(low))
    return F.when(F.col(low) == F.col(high), F.lit(0)).otherwise(F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))).cast("int")


def _ranked(counted: DataFrame, by: list[str], step: str) -> DataFrame:
    """Keeps the rows (group, ..., c) in which one of the wanted ranks lies; ranks count from 0 inside ``below``."""
    upto = F.sum("c").over(Window.partitionBy(*by).orderBy(step).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counted.withColumn("upto", F.col("below") + upto)
    before = F.col("upto") - F.col("c")

    def here(rank):
        return (F.col(rank) >= before) & (F.col(rank) < F.col("upto"))

    return placed.withColumns({"below": before}).filter(here("lower") | here("upper"))


def exact_median(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """(by..., name): the median of the non-null values of each group; the mean of the middle two for an even number.

    Groups without a value get no row. Values are doubles without NaN. NULL is a group like any other.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    n = F.col("n")
    # a group's open ranges: at first all of it, with the ranks of its middle
    ranges = rows.groupBy(*by).agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.count("*").alias("n")).select(
        *by, "lo", "hi", F.floor((n - 1) / 2).alias("lower"), F.floor(n / 2).alias("upper"), F.lit(0).cast("long").alias("below"))
    for _ in range(LEVELS):
        inside = _inside(rows, ranges, by).withColumn("bucket", _bucket("_v", "lo", "hi"))
        counted = inside.groupBy(*by, "lo", "hi", "lower", "upper", "below", "bucket").agg(
            F.count("*").alias("c"), F.min("_v").alias("from"), F.max("_v").alias("to"))
        middle = _ranked(counted, [*by, "lo"], "bucket")
        ranges = middle.select(*by, F.col("from").alias("lo"), F.col("to").alias("hi"), "lower", "upper", "below")
    left = _inside(rows, ranges, by).groupBy(*by, "lo", "lower", "upper", "below", "_v").agg(F.count("*").alias("c"))
    middle = _ranked(left, [*by, "lo"], "_v")
    # one row holds both ranks, or two hold one each
    return middle.groupBy(*by).agg(F.avg("_v").alias(name))


def _inside(rows: DataFrame, ranges: DataFrame, by: list[str]) -> DataFrame:
    """Rows within their group's open ranges, with those; two ranges of a group don't overlap."""
    a, b = rows.alias("a"), ranges.alias("b")
    same = F.lit(True)
    for k in by:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    joined = a.join(b, same & (F.col("a._v") >= F.col("b.lo")) & (F.col("a._v") <= F.col("b.hi")))
    return joined.select("a.*", *[f"b.{c}" for c in ("lo", "hi", "lower", "upper", "below")])


def rank_error(k: int = SKETCH_K) -> float:
    """Normalised rank error of a KLL sketch that 99 of 100 answers keep (published bound for one quantile)."""
    return 2.296 / k ** 0.9021


def sketch_table(df: DataFrame, by: list[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """(by..., n, sketch): a mergeable sketch of each group's non-null values."""
    rows = df.filter(F.col(value).isNotNull())
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: list[str], k: int = SKETCH_K) -> DataFrame:
    """Sketches of coarser groups from stored ones; no row is read."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_quantile(sketch="sketch", share: float = 0.5):
    return F.kll_sketch_get_quantile_double(sketch, F.lit(share))


def rank_range(df: DataFrame, by: list[str], value: str, answers: DataFrame, answer: str) -> DataFrame:
    """(by..., n, low, high): share of values below the group's answer, and of those not above it; its true rank lies between."""
    rows = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    met = rows.join(answers.select(*by, F.col(answer).alias("_a")), by)
    return met.groupBy(*by).agg(F.count("*").alias("n"), (F.count_if(F.col("_v") < F.col("_a")) / F.count("*")).alias("low"),
                                (F.count_if(F.col("_v") <= F.col("_a")) / F.count("*")).alias("high"))
