"""Calendar and weekly time-series preparation.

A "panel" is a long DataFrame keyed by (series, region_level, region_code, week_start) with a
``value`` and a ``volume`` column. Every operator here is a grouped or windowed DataFrame
transform partitioned by series/region, so regions are processed in parallel and no series is
ever brought to the driver. The only global steps (tail trimming, censoring) run on the weekly
totals, whose size is bounded by the number of calendar weeks, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEVEL_STATE, LEVEL_MACRO, LEVEL_COUNTRY = "state", "macro_region", "country"
COUNTRY_CODE = "BR"
SERIES_KEYS = ("series", "region_level", "region_code")


def date_spine(dates: DataFrame, column: str) -> DataFrame:
    """One row per day of the whole years that ``column`` spans (a calendar; no rows without a date)."""
    ends = dates.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).filter(F.col("lo").isNotNull())
    first, last = F.to_date(F.trunc("lo", "year")), F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1)
    return ends.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date_day"))


def build_panel(mart: DataFrame, series: str, value_col: str, weight_col: str | None, aggregate: str) -> DataFrame:
    """State, macro-region and country series of one weekly mart in a single aggregation.

    GROUPING SETS computes all three levels from one scan and one shuffle; the level is read
    from ``grouping_id`` (never from NULL keys, which would confuse a NULL macro-region with a
    rolled-up one). ``aggregate`` is ``sum`` or ``weighted_mean`` (weights = ``weight_col``).
    State and macro rows with a NULL key are dropped; their volume still counts nationally.
    """
    volume = F.col(weight_col) if weight_col else F.col(value_col)
    m = mart.select(F.col("week_start"), F.col("state_code"), F.col("macro_region"),
                    F.col(value_col).cast("double").alias("_v"), volume.cast("double").alias("_w"))
    # a state's own row passes through the same grouping (one row per state and week)
    grouped = m.groupingSets(
        [["week_start", "state_code", "macro_region"], ["week_start", "macro_region"], ["week_start"]],
        "week_start", "state_code", "macro_region")
    if aggregate == "sum":
        value = F.sum("_v")
    elif aggregate == "weighted_mean":
        value = F.try_divide(F.sum(F.col("_v") * F.col("_w")), F.sum("_w"))
    else:
        raise ValueError(f"unknown aggregate {aggregate!r}")
    agg = grouped.agg(value.alias("value"), F.max("_v").alias("_own"), F.sum("_w").alias("volume"),
                      F.grouping_id().alias("_gid"))
    # a state row is the mart row itself: keep its value as is (v*w/w can differ in the last bit)
    agg = agg.withColumn("value", F.when(F.col("_gid") == 0, F.col("_own")).otherwise(F.col("value")))
    level = (F.when(F.col("_gid") == 0, F.lit(LEVEL_STATE))
              .when(F.col("_gid") == 2, F.lit(LEVEL_MACRO)).otherwise(F.lit(LEVEL_COUNTRY)))
    code = (F.when(F.col("_gid") == 0, F.col("state_code"))
             .when(F.col("_gid") == 2, F.col("macro_region")).otherwise(F.lit(COUNTRY_CODE)))
    out = agg.select(F.lit(series).alias("series"), level.alias("region_level"), code.alias("region_code"),
                     F.col("week_start"), "value", "volume")
    return out.filter(F.col("region_code").isNotNull())


def weekly_totals(panel: DataFrame) -> DataFrame:
    return panel.groupBy("series", "week_start").agg(F.sum("volume").alias("total"))


def trim_incomplete_tail(panel: DataFrame, share: float = 0.7, lookback: int = 8) -> DataFrame:
    """Drop trailing weeks whose total volume collapses below ``share`` x trailing median.

    Scanning back from the last week, the first week (index > lookback) whose total is at least
    ``share`` times the median of the ``lookback`` weeks before it is kept with everything
    earlier. Fewer than 10 weeks, or no such week: unchanged.
    """
    totals = weekly_totals(panel)
    w = Window.partitionBy("series").orderBy("week_start")
    t = (totals.withColumn("i", F.row_number().over(w) - 1)
               .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("series")))
               .withColumn("ref", F.percentile("total", 0.5).over(w.rowsBetween(-lookback, -1))))
    cut = (t.groupBy("series")
            .agg(F.max(F.when((F.col("i") > lookback) & (F.col("total") >= F.lit(share) * F.col("ref")),
                              F.col("week_start"))).alias("keep_until"),
                 F.max("n").alias("n")))
    cut = cut.select("series", F.when(F.col("n") >= 10, F.col("keep_until")).alias("keep_until"))
    return (panel.join(cut, "series", "left")
                 .filter(F.col("keep_until").isNull() | (F.col("week_start") <= F.col("keep_until")))
                 .drop("keep_until"))


def censor_tail(panel: DataFrame, weeks: int = 1) -> DataFrame:
    """Drop the last ``weeks`` distinct weeks of each series (right-censored observations).

    A series with no more weeks than that has no observation that is surely complete; its last
    ``weeks`` weeks go, which leaves none. The weeks of a series are calendar-sized, so they are kept as one sorted array.
    """
    if weeks <= 0:
        return panel
    seen = panel.groupBy("series").agg(F.sort_array(F.collect_set("week_start"), asc=False).alias("_weeks"))
    cutoff = seen.select(F.col("series").alias("_s"), F.get("_weeks", weeks).alias("_cut"))
    return panel.join(cutoff, F.col("series") == F.col("_s")).filter(F.col("week_start") <= F.col("_cut")).drop("_s", "_cut")


def complete_weeks(panel: DataFrame, aggregate: str) -> DataFrame:
    """Every region on every Monday between the series' first and last week.

    Sum series fill gaps with 0; mean series carry the last value forward, then the first
    value backward. Volume gaps are 0. Each region row carries its series' bounds (a window over the few
    region rows) and explodes its own weeks, so regions and weeks are never joined.
    """
    ends = panel.groupBy(*SERIES_KEYS).agg(F.min("week_start").alias("_lo"), F.max("week_start").alias("_hi"))
    of_series = Window.partitionBy("series")
    ends = ends.select(*SERIES_KEYS, F.min("_lo").over(of_series).alias("_lo"), F.max("_hi").over(of_series).alias("_hi"))
    grid = ends.select(*SERIES_KEYS, F.explode(F.sequence("_lo", "_hi", F.expr("interval 7 days"))).alias("week_start"))
    full = grid.join(panel, [*SERIES_KEYS, "week_start"], "left")
    if aggregate == "sum":
        value = F.coalesce(F.col("value"), F.lit(0.0))
    else:
        w = Window.partitionBy(*SERIES_KEYS).orderBy("week_start")
        value = F.coalesce(F.last("value", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
                           F.first("value", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    return full.select(*SERIES_KEYS, "week_start", value.alias("value"),
                       F.coalesce(F.col("volume"), F.lit(0.0)).alias("volume"))
