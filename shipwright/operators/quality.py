"""Data-quality checks. Each returns the violating rows: empty means the check passes.

Checks are ordinary filters and aggregations, so they run distributed over the checked table.
Comparisons of two row counts are computed in one aggregation over a tagged union, not a
cross join.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, column: str, tasks: int | None = None) -> DataFrame:
    """Values occurring more than once (NULLs excluded).

    ``tasks`` deals the values of a key to so many tasks before they are counted. Without it their number follows from
    shuffled bytes, and 64 MB of short keys that compress well are millions of groups in one task.
    """
    values = df.filter(F.col(column).isNotNull()).select(column)
    if tasks is not None:
        values = values.repartition(tasks, column)
    return values.groupBy(column).agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Distinct values outside the accepted list, with their counts (NULL is not checked)."""
    return (df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*list(values)))
              .groupBy(column).agg(F.count(F.lit(1)).alias("n_records")))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (anti join)."""
    keys = parent.select(F.col(field).alias("_parent_key")).distinct()
    return (child.filter(F.col(column).isNotNull())
                 .join(keys, F.col(column) == F.col("_parent_key"), "left_anti"))


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < 0)


def between(df: DataFrame, column: str, lo, hi) -> DataFrame:
    return df.filter((F.col(column) < lo) | (F.col(column) > hi))


def row_count_matches(df: DataFrame, other: DataFrame) -> DataFrame:
    """One row (model_rows, compare_rows) when the two counts differ."""
    tagged = (df.select(F.lit(1).alias("_a"), F.lit(0).alias("_b"))
                .unionByName(other.select(F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    counts = tagged.agg(F.sum("_a").cast("long").alias("model_rows"), F.sum("_b").cast("long").alias("compare_rows"))
    # an empty union still yields one row of NULL sums; compare them as 0
    counts = counts.select(F.coalesce("model_rows", F.lit(0)).alias("model_rows"),
                           F.coalesce("compare_rows", F.lit(0)).alias("compare_rows"))
    return counts.filter(F.col("model_rows") != F.col("compare_rows"))


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def count_above(df: DataFrame, condition, threshold: int, name: str = "missing") -> DataFrame:
    """Global HAVING: one row with the count when more than ``threshold`` rows match, else none."""
    return (df.filter(condition).agg(F.count(F.lit(1)).alias(name))
              .filter(F.col(name) > threshold))
