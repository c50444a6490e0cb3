"""The forecast run and the forecast marts.

``run_forecasts`` is the whole weekly forecasting job: for each series spec it prepares the
panel from its mart, backtests every candidate model on every region, selects champions and
publishes forecasts. It returns the four output tables as DataFrames; ``append_run`` writes
them to append-only parquet tables (run identity is a driver-side literal, so a retried task
writes the same values).
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shipwright.functions import expr as X
from shipwright.operators import forecast as FC
from shipwright.operators import timeseries as TS

OUTPUT_TABLES = ("forecast_demand_weekly_region", "forecast_delivery_time_weekly_region", "forecast_accuracy",
                 "forecast_runs")


def built_panel(wh, spec: FC.SeriesSpec) -> DataFrame:
    return TS.build_panel(wh[spec.mart], spec.name, spec.value_column, spec.weight_column, spec.aggregate)


def trimmed_panel(wh, spec: FC.SeriesSpec, cfg: FC.ForecastConfig) -> DataFrame:
    return TS.trim_incomplete_tail(built_panel(wh, spec), cfg.incomplete_tail_share)


def censored_panel(wh, spec: FC.SeriesSpec, cfg: FC.ForecastConfig) -> DataFrame:
    panel = trimmed_panel(wh, spec, cfg)
    if spec.aggregate == "weighted_mean" and cfg.censor_tail_weeks_for_weighted_mean > 0:
        panel = TS.censor_tail(panel, cfg.censor_tail_weeks_for_weighted_mean)
    return panel


def completed_panel(wh, spec: FC.SeriesSpec, cfg: FC.ForecastConfig) -> DataFrame:
    return TS.complete_weeks(censored_panel(wh, spec, cfg), spec.aggregate)


def new_run_identity() -> tuple[str, datetime]:
    """12-hex run id and UTC run time, fixed on the driver once per run."""
    return uuid.uuid4().hex[:12], datetime.now(UTC).replace(tzinfo=None, microsecond=0)


def run_forecasts(wh, cfg: FC.ForecastConfig | None = None, run_id: str | None = None,
                  run_at: datetime | None = None, checkpoint: bool = True) -> dict[str, DataFrame]:
    """All forecast outputs of one run, lazily (except the small per-series checkpoint).

    The completed panel of a spec is checkpointed to the shared checkpoint folder when
    ``checkpoint`` is set: it is tiny (regions x weeks) but feeds many branches of the backtest,
    and cutting the lineage there keeps the whole mart computation from being repeated per
    branch or after a lost executor.
    """
    cfg = cfg or FC.ForecastConfig()
    if run_id is None or run_at is None:
        rid, rat = new_run_identity()
        run_id, run_at = run_id or rid, run_at or rat
    outputs: dict[str, DataFrame] = {}
    accuracies, runs = [], []
    def one(spec):
        panel = completed_panel(wh, spec, cfg)
        if checkpoint:
            panel = panel.checkpoint(eager=True)
        return panel, FC.forecast_series(panel, spec, cfg, run_id, run_at, checkpoint=checkpoint)

    # the series are independent: their eager steps (checkpoints, pooled-model fits) run as
    # concurrent Spark jobs
    with ThreadPoolExecutor(max_workers=len(cfg.series)) as pool:
        done = list(pool.map(one, cfg.series))
    for spec, (panel, res) in zip(cfg.series, done):
        outputs[spec.output_table] = res.forecasts
        accuracies.append(res.accuracy)
        runs.append(FC.run_summary(spec, cfg, panel, res.accuracy, run_id, run_at))
    outputs["forecast_accuracy"] = reduce(DataFrame.unionByName, accuracies)
    outputs["forecast_runs"] = reduce(DataFrame.unionByName, runs)
    return outputs


def append_run(outputs: dict[str, DataFrame], root: str, run_id: str) -> list[dict]:
    """Append a run's outputs to the tables ``forecasts.*`` in one commit: readers see all four or none of them.

    The same run appended again replaces its rows.
    """
    from shipwright.sources import sinks
    return sinks.append_run(outputs, root, "forecasts", run_id)


# ------------------------------------------------------------------------ forecast marts
def _actuals(wh) -> DataFrame:
    """Realised weekly actuals of both series at state, macro-region and country level."""
    demand = TS.build_panel(wh["mart_demand_weekly_region"], FC.DEMAND.name, "orders", None, "sum")
    delivery = TS.build_panel(wh["mart_delivery_time_weekly_region"], FC.DELIVERY_TIME.name, "avg_delivery_days",
                              "delivered_orders", "weighted_mean")
    return demand.unionByName(delivery).select("series", "region_level", "region_code", "week_start",
                                               F.col("value").alias("actual"))


def forecast_vs_actual(wh, forecasts_demand: DataFrame, forecasts_delivery: DataFrame) -> DataFrame:
    """Every published forecast joined to its realised actual (NULL while the week is unobserved)."""
    f = forecasts_demand.unionByName(forecasts_delivery)
    f = f.withColumn("_wk", X.to_date("week_start"))
    a = _actuals(wh).withColumnRenamed("week_start", "_wk")
    j = f.join(a, ["series", "region_level", "region_code", "_wk"], "left")
    err = F.col("actual") - F.col("forecast")
    return j.select("run_id", "run_at", "series", "region_level", "region_code", "model_name", "origin_week",
                    F.col("_wk").alias("week_start"), "horizon_weeks", "forecast", "forecast_lower", "forecast_upper",
                    "backtest_wape", "actual", err.alias("error"), F.abs(err).alias("abs_error"),
                    X.safe_divide(F.abs(err), F.abs("actual")).alias("abs_pct_error"),
                    X.in_interval("actual", "forecast_lower", "forecast_upper").alias("within_interval"))


def accuracy_latest(accuracy: DataFrame, runs: DataFrame) -> DataFrame:
    """Accuracy rows of the latest run per series (inner join on (series, max run_at))."""
    latest = runs.groupBy("series").agg(F.max("run_at").alias("run_at"))
    a = accuracy.join(latest, ["series", "run_at"], "inner")
    return a.select("run_id", "run_at", "series", "region_level", "region_code", "model_name", "is_champion",
                    "horizon_weeks", "n_folds", "mae", "smape", "wape", "bias", "train_end_week", "n_train_weeks")


def demand_actual_vs_forecast(wh, forecasts_demand: DataFrame, runs: DataFrame, start: str) -> DataFrame:
    """National weekly orders next to the latest run's country forecast (full outer join)."""
    actual = wh["mart_demand_weekly_region"].groupBy("week_start").agg(F.sum("orders").alias("orders"))
    latest = (runs.filter(F.col("series") == FC.DEMAND.name)
                  .orderBy(F.col("run_at").desc()).limit(1).select(F.col("run_id").alias("_run")))
    fc = (forecasts_demand.filter(F.col("region_level") == TS.LEVEL_COUNTRY)
                          .join(latest, F.col("run_id") == F.col("_run"), "left_semi")
                          .select(X.to_date("week_start").alias("_fw"), "forecast", "forecast_lower",
                                  "forecast_upper", "model_name"))
    j = actual.join(fc, actual.week_start == fc._fw, "full")
    wk = F.coalesce("week_start", "_fw")
    return (j.filter(wk >= F.to_date(F.lit(start)))
             .select(wk.alias("week_start"), F.col("orders").cast("double").alias("orders"), "forecast",
                     "forecast_lower", "forecast_upper", "model_name")
             .orderBy(F.col("week_start").asc_nulls_last()))


def demand_chart_frame(frame: DataFrame) -> DataFrame:
    """Chart rule: actual orders only before the first forecast week.

    The frame has one row per calendar week, so the whole-frame window that finds the first
    forecast week is bounded by the calendar, not by the data.
    """
    first_fc = F.min(F.when(F.col("forecast").isNotNull(), F.col("week_start"))).over(Window.partitionBy())
    j = frame.withColumn("_first", first_fc)
    keep_actual = F.col("_first").isNull() | (F.col("week_start") < F.col("_first"))
    return j.select("week_start", F.when(keep_actual, F.col("orders")).alias("orders"), "forecast",
                    "forecast_lower", "forecast_upper", "model_name")


def forecast_accuracy_by_region(latest: DataFrame, series: str = FC.DEMAND.name) -> DataFrame:
    return (latest.filter((F.col("series") == series) & (F.col("region_level") == TS.LEVEL_MACRO)
                          & F.col("is_champion") & (F.col("horizon_weeks") == 0))
                  .select("region_code", "model_name", "wape", "smape", "bias")
                  .orderBy(F.col("wape").asc_nulls_last()))


def forecast_series_weekly(fva: DataFrame, series: str = FC.DEMAND.name, level: str = TS.LEVEL_COUNTRY) -> DataFrame:
    """Weekly sums of actual / forecast / bounds for one series and level."""
    return (fva.filter((F.col("series") == series) & (F.col("region_level") == level))
               .groupBy("week_start")
               .agg(F.sum("actual").alias("actual"), F.sum("forecast").alias("forecast"),
                    F.sum("forecast_lower").alias("forecast_lower"), F.sum("forecast_upper").alias("forecast_upper")))


def accuracy_drilldown(latest: DataFrame) -> DataFrame:
    return (latest.groupBy("series", "region_code", "model_name", "horizon_weeks")
                  .agg(F.avg("wape").alias("wape"), F.avg("smape").alias("smape"), F.avg("bias").alias("bias")))


def realised_wape(fva: DataFrame) -> DataFrame:
    """Forecast-page measures: demand forecast and actual totals over all weeks, and the WAPE over every
    row (of any series) that has an actual."""
    demand = F.col("series") == FC.DEMAND.name
    known = F.col("actual").isNotNull()
    return fva.agg(X.safe_divide(F.sum(F.when(known, F.col("abs_error"))), F.sum("actual")).alias("realised_wape"),
                   F.sum(F.when(demand, F.col("forecast"))).alias("forecast_orders"),
                   F.sum(F.when(demand, F.col("actual"))).alias("actual_orders"))


def champion_backtest_wape(latest: DataFrame) -> DataFrame:
    """Mean pooled backtest WAPE of the champions of the latest run."""
    champions = latest.filter(F.col("is_champion") & (F.col("horizon_weeks") == 0))
    return champions.agg(F.avg("wape").alias("champion_backtest_wape"))
