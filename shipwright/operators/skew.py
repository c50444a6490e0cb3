"""Left joins on keys that many rows share, or that many rows lack.

An equality join sends all rows of a key to one task, and all rows without a key to one as well, though they can't
match. Here the rows without a key are spread by a hash of another column, and so are the rows of heavy keys, whose
few dimension rows are copied to every slot. Heavy keys are found by a counted pass over the key column alone: a key
is heavy if it has more than its share of the rows, so there are fewer than ``SHARE`` of them, whatever the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 200          # a key with more than one row in so many is heavy
SLOTS = 64           # tasks that a heavy key's rows, or the rows without a key, are spread over
SENT_ROWS = 500_000  # rows of a dimension, a few columns each, that may be sent to every executor


def heavy_keys(df: DataFrame, key: str, share: int = SHARE) -> DataFrame:
    """The keys that more than 1/share of the rows hold; NULL is none of them."""
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.filter(F.col(key).isNotNull() & (F.col("_n") * share > total)).select(F.col(key).alias("_heavy"))


def has_unique_keys(df: DataFrame, key: str) -> bool:
    """Whether no value of ``key`` occurs twice (NULLs aside). One job over the key column, when the plan is made."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").isEmpty()


def is_small(df: DataFrame) -> bool:
    """Whether a frame has at most ``SENT_ROWS`` rows. One job, when the plan is made."""
    return df.count() <= SENT_ROWS


def spread_left_join(left: DataFrame, right: DataFrame, key: str, by: str, heavy: DataFrame | None = None, slots: int = SLOTS,
                     unique: bool = False) -> DataFrame:
    """``left.join(right, key, "left")`` with rows without a key, and of the ``heavy`` keys, spread by ``by``.

    ``heavy`` (one column) must be a list of proven size, as ``heavy_keys`` gives it; it is broadcast. Without it only
    rows without a key are spread, which costs nothing. ``unique``: the caller has seen (``has_unique_keys``) that ``right``
    has a key once; the plan then says so, and readers that use no column of ``right`` don't run the join.
    """
    slot = F.pmod(F.xxhash64(F.col(by)), F.lit(slots)).cast("int")
    spread = F.col(key).isNull()
    dimension = right.withColumn("_slot", F.lit(0))
    if heavy is not None:
        hot = F.broadcast(heavy.toDF("_heavy"))
        left = left.join(hot, left[key] == F.col("_heavy"), "left")
        spread = spread | F.col("_heavy").isNotNull()
        copies = F.when(F.col("_heavy").isNotNull(), F.sequence(F.lit(0), F.lit(slots - 1))).otherwise(F.array(F.lit(0)))
        dimension = right.join(hot, right[key] == F.col("_heavy"), "left").withColumn("_slot", F.explode(copies)).drop("_heavy")
    if unique:
        dimension = dimension.dropDuplicates([key, "_slot"])
    placed = left.withColumn("_slot", F.when(spread, slot).otherwise(F.lit(0)))
    return placed.join(dimension, [key, "_slot"], "left").drop("_slot", "_heavy")
