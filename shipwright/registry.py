"""Named queries over a data directory: the public catalogue of what the engine computes.

Each entry is ``(spark, sf_dir) -> DataFrame``. Queries build a fresh model context over the
given directory so every one of them reads the whole input tables.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

# importing the model modules registers them
from shipwright.plans import core, intermediate, marts, staging  # noqa: F401
from shipwright.plans import dashboard as dash
from shipwright.plans.warehouse import Warehouse
from shipwright.session import ship_package
from shipwright.sources.testbed import TABLES as TESTBED_TABLES

# The test data spans 1995-2001; the dashboard range lies inside it.
DASH_RANGE = ("1997-01-01", "1999-12-31")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    ship_package(spark)
    return Warehouse.from_testdata(spark, sf_dir)


def _model_query(name: str):
    QUERIES[name] = lambda spark, sf_dir: warehouse(spark, sf_dir)[name]


for _m in ("stg_orders", "stg_customers", "stg_sellers", "stg_products", "stg_order_items", "stg_order_payments",
           "stg_order_reviews", "stg_geolocation_zip", "int_order_items_agg", "int_order_payments_agg",
           "int_order_reviews_latest", "int_order_distance", "dim_customers", "dim_sellers", "dim_products",
           "dim_regions", "dim_dates", "fct_orders", "fct_order_items", "mart_kpi_daily_region",
           "mart_unit_economics_monthly", "mart_demand_weekly_region", "mart_delivery_time_weekly_region",
           "mart_seller_performance", "mart_category_monthly"):
    _model_query(_m)


@query("dash_headline")
def _dash_headline(spark, sf_dir):
    return dash.headline(warehouse(spark, sf_dir), *DASH_RANGE)


@query("dash_weekly_service")
def _dash_weekly_service(spark, sf_dir):
    return dash.weekly_service(warehouse(spark, sf_dir), *DASH_RANGE)


@query("dash_monthly_unit_economics")
def _dash_monthly(spark, sf_dir):
    return dash.monthly_unit_economics(warehouse(spark, sf_dir), *DASH_RANGE)


@query("dash_state_scorecard")
def _dash_states(spark, sf_dir):
    return dash.state_scorecard(warehouse(spark, sf_dir), *DASH_RANGE)


@query("dash_cost_mix")
def _dash_cost_mix(spark, sf_dir):
    return dash.cost_mix(warehouse(spark, sf_dir))


@query("kpi_measures")
def _kpi_measures(spark, sf_dir):
    return dash.kpi_measures(warehouse(spark, sf_dir))


@query("kpi_prior_year")
def _kpi_prior_year(spark, sf_dir):
    return dash.kpi_prior_year(warehouse(spark, sf_dir))


@query("kpi_previous_period")
def _kpi_previous_period(spark, sf_dir):
    return dash.kpi_previous_period(warehouse(spark, sf_dir), *DASH_RANGE)


# ------------------------------------------------------------------ data-quality checks
from shipwright.plans import quality_suite as dq  # noqa: E402

_DQ = {
    "dq_unique": dq.unique_violations,
    "dq_not_null": dq.not_null_violations,
    "dq_accepted_values": dq.accepted_values_violations,
    "dq_relationships": dq.relationship_violations,
    "dq_non_negative": dq.non_negative_violations,
    "dq_between": dq.between_violations,
    "dq_row_count_matches": dq.row_count_violations,
    "dq_unique_combination": dq.unique_combination_violations,
    "dq_margin_components": dq.margin_components,
    "dq_delivered_timestamp": dq.delivered_without_timestamp,
    "dq_kpi_reconcile": dq.kpi_reconcile,
}
for _name, _fn in _DQ.items():
    QUERIES[_name] = (lambda f: lambda spark, sf_dir: f(warehouse(spark, sf_dir)))(_fn)


@query("dq_suite")
def _dq_suite(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    build_for_checks(wh, _scratch(spark, "dq"))
    return dq.failures_by_test(wh)


_PROBE_FNS = {
    "dq_probe_suite": dq.failures_by_test, "dq_probe_unique": dq.unique_violations, "dq_probe_not_null": dq.not_null_violations,
    "dq_probe_accepted_values": dq.accepted_values_violations, "dq_probe_relationships": dq.relationship_violations,
    "dq_probe_non_negative": dq.non_negative_violations, "dq_probe_between": dq.between_violations,
    "dq_probe_row_count_matches": dq.row_count_violations, "dq_probe_unique_combination": dq.unique_combination_violations,
}
for _name, _fn in _PROBE_FNS.items():
    QUERIES[_name] = (lambda f: lambda spark, sf_dir: f(warehouse(spark, sf_dir), dq.PROBES))(_fn)
for _name, _fn in {"dq_probe_margin_components": dq.margin_components, "dq_probe_delivered_timestamp": dq.delivered_without_timestamp,
                   "dq_probe_kpi_reconcile": dq.kpi_reconcile}.items():
    QUERIES[_name] = (lambda f: lambda spark, sf_dir: f(dq.spoilt(warehouse(spark, sf_dir))))(_fn)


# ------------------------------------------------------------------ forecasting
from datetime import datetime  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from shipwright.operators import forecast as FC  # noqa: E402
from shipwright.operators import quantiles as QU  # noqa: E402
from shipwright.operators import timeseries as TS  # noqa: E402
from shipwright.plans import forecasting as FP  # noqa: E402

# A fixed run identity keeps registered forecast queries reproducible; real runs draw a new one.
TESTBED_RUN = ("testbed0001", datetime(2026, 1, 1))
CFG = FC.ForecastConfig()


_RUNS: dict = {}


def _state_of(spark, sf_dir):
    """Names, sizes and times of the input files, listed without reading them."""
    files = spark.read.format("binaryFile").load([f"{sf_dir}/{t}.parquet" for t in TESTBED_TABLES])
    return tuple(sorted((r.path, r.length, r.modificationTime) for r in files.select("path", "length", "modificationTime").collect()))


def _run(spark, sf_dir, cfg=CFG):
    """The outputs of one forecast run, computed once and written; all readers of a session share the files
    as long as the input files are the same."""
    key = (spark.sparkContext.applicationId, sf_dir, _state_of(spark, sf_dir), cfg)
    if key not in _RUNS:
        root = _scratch(spark, "run")
        out = FP.run_forecasts(warehouse(spark, sf_dir), cfg, *TESTBED_RUN)
        FP.append_run(out, root, TESTBED_RUN[0])
        _RUNS[key] = {name: SINK.read_table(spark, root, "forecasts", name) for name in out}
    return _RUNS[key]


QUERIES["panel_demand"] = lambda spark, sf_dir: FP.built_panel(warehouse(spark, sf_dir), FC.DEMAND)
QUERIES["panel_delivery"] = lambda spark, sf_dir: FP.built_panel(warehouse(spark, sf_dir), FC.DELIVERY_TIME)
QUERIES["trim_incomplete_tail"] = lambda spark, sf_dir: FP.trimmed_panel(warehouse(spark, sf_dir), FC.DEMAND, CFG)
QUERIES["censor_tail"] = lambda spark, sf_dir: FP.censored_panel(warehouse(spark, sf_dir), FC.DELIVERY_TIME, CFG)
QUERIES["complete_weeks_demand"] = lambda spark, sf_dir: FP.completed_panel(warehouse(spark, sf_dir), FC.DEMAND, CFG)
QUERIES["complete_weeks_delivery"] = lambda spark, sf_dir: FP.completed_panel(
    warehouse(spark, sf_dir), FC.DELIVERY_TIME, CFG)


def _arrays(spark, sf_dir, spec=FC.DEMAND):
    return FC.series_arrays(FP.completed_panel(warehouse(spark, sf_dir), spec, CFG))


def _folds(spark, sf_dir, spec):
    o = FC.rolling_origins(_arrays(spark, sf_dir, spec), CFG.horizon_weeks, CFG.backtest_folds, CFG.min_history_weeks)
    return o.withColumn("origin", F.col("origin").cast("long"))


def _candidates(spark, sf_dir, spec):
    return FC.candidate_models(_arrays(spark, sf_dir, spec), spec.min_weekly_volume, CFG.pooled_model)


def _longs(rows):
    return rows.withColumns({"origin": F.col("origin").cast("long"), "h": F.col("h").cast("long")})


def _model_rows(spark, sf_dir, spec, model_name):
    """Backtest + refit forecasts of one model on every region of a series (no gating)."""
    return _longs(FC.backtest_rows(_arrays(spark, sf_dir, spec), CFG.horizon_weeks, CFG.backtest_folds, CFG.min_history_weeks,
                                   F.array(F.lit(model_name)), spec.non_negative))


def _staged(df, tag):
    """A small frame (regions x weeks) written once, so that the branches over it don't repeat the marts."""
    path = _scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _pooled_rows(spark, sf_dir, spec):
    """Backtest + refit forecasts of the pooled model on every state (no volume gate)."""
    panel = _staged(FP.completed_panel(warehouse(spark, sf_dir), spec, CFG), "panel")
    return _longs(FC.pooled_gbm_rows(panel, FC.series_arrays(panel), spec, CFG, F.array(F.lit(FC.POOLED_NAME))))


def _backtest(spark, sf_dir, spec):
    rows = FC.backtest_rows(_arrays(spark, sf_dir, spec), CFG.horizon_weeks, CFG.backtest_folds, CFG.min_history_weeks,
                            FC.candidate_array(spec.min_weekly_volume), spec.non_negative)
    return _longs(rows.filter(~F.col("is_refit")))


def _metrics(spark, sf_dir, spec):
    return FC.accuracy_summary(_backtest(spark, sf_dir, spec)).filter(F.col("horizon_weeks") == 0)


def _residuals(spark, sf_dir, spec):
    return FC.residual_quantiles(_backtest(spark, sf_dir, spec), CFG.interval_quantiles)


def _champions(spark, sf_dir, spec):
    cands = FC.candidate_models(_arrays(spark, sf_dir, spec), spec.min_weekly_volume)
    return FC.champions(cands, FC.accuracy_summary(_backtest(spark, sf_dir, spec)))


def _features(spark, sf_dir, spec):
    mean_series = spec.aggregate == "weighted_mean"
    panel = FP.completed_panel(warehouse(spark, sf_dir), spec, CFG)
    return FC.pooled_features(panel, log_target=not mean_series, with_volume=mean_series).withColumn("t", F.col("t").cast("long"))


_BY_SERIES = {
    "rolling_origin_folds": _folds, "candidate_models": _candidates, "model_pooled_gbm": _pooled_rows,
    "model_moving_average": lambda *a: _model_rows(*a, FC.MA_NAME), "model_seasonal_naive": lambda *a: _model_rows(*a, FC.SEASONAL_NAME),
    "model_holt_damped": lambda *a: _model_rows(*a, FC.HOLT_NAME), "backtest_univariate": _backtest, "metrics_by_model": _metrics,
    "residual_quantiles": _residuals, "champion_models": _champions, "pooled_features": _features,
}
for _name, _fn in _BY_SERIES.items():
    for _tag, _spec in (("", FC.DEMAND), ("_delivery", FC.DELIVERY_TIME)):
        QUERIES[_name + _tag] = (lambda f, spec: lambda spark, sf_dir: f(spark, sf_dir, spec))(_fn, _spec)


# Readers of a run: of the reference configuration, and (uni_) of one with the three univariate models only.
UNI_CFG = dataclasses.replace(CFG, pooled_model=False)


def _fva(wh, out):
    return FP.forecast_vs_actual(wh, out["forecast_demand_weekly_region"], out["forecast_delivery_time_weekly_region"])


def _latest(wh, out):
    return FP.accuracy_latest(out["forecast_accuracy"], out["forecast_runs"])


def _dvf(wh, out):
    return FP.demand_actual_vs_forecast(wh, out["forecast_demand_weekly_region"], out["forecast_runs"], DASH_RANGE[0])


_RUN_READERS = {
    "forecast_accuracy": lambda wh, out: out["forecast_accuracy"],
    "forecast_publish": lambda wh, out: out["forecast_demand_weekly_region"],
    "forecast_publish_delivery": lambda wh, out: out["forecast_delivery_time_weekly_region"],
    "forecast_runs": lambda wh, out: out["forecast_runs"],
    "mart_forecast_vs_actual": _fva,
    "mart_forecast_accuracy_latest": _latest,
    "dash_demand_actual_vs_forecast": _dvf,
    "dash_demand_chart": lambda wh, out: FP.demand_chart_frame(_dvf(wh, out)),
    "dash_forecast_accuracy": lambda wh, out: FP.forecast_accuracy_by_region(_latest(wh, out)),
    "dash_forecast_series": lambda wh, out: FP.forecast_series_weekly(_fva(wh, out)),
    "dash_accuracy_drilldown": lambda wh, out: FP.accuracy_drilldown(_latest(wh, out)),
    "realised_wape": lambda wh, out: FP.realised_wape(_fva(wh, out)),
    "champion_backtest_wape": lambda wh, out: FP.champion_backtest_wape(_latest(wh, out)),
}
for _name, _fn in _RUN_READERS.items():
    for _tag, _cfg in (("", CFG), ("uni_", UNI_CFG)):
        QUERIES[_tag + _name] = (lambda f, cfg: lambda spark, sf_dir: f(warehouse(spark, sf_dir), _run(spark, sf_dir, cfg)))(_fn, _cfg)


@query("uni_dq_forecast_marts")
def _dq_forecast(spark, sf_dir):
    wh, out = warehouse(spark, sf_dir), _run(spark, sf_dir, UNI_CFG)
    wh.override("mart_forecast_vs_actual", _fva(wh, out))
    wh.override("mart_forecast_accuracy_latest", _latest(wh, out))
    return dq.failures_by_test(wh, dq.FORECAST_DECLARED)


# ------------------------------------------------------------------ query-log analytics
from shipwright.operators import querylog as QL  # noqa: E402
from shipwright.sources import testbed_logs as LOGS  # noqa: E402


@query("log_sql_normalise")
def _log_norm(spark, sf_dir):
    return LOGS.statements(spark, sf_dir).select("stmt_id", QL.normalise("sql").alias("sql_key"))


@query("log_sql_tables")
def _log_tables(spark, sf_dir):
    s = LOGS.statements(spark, sf_dir)
    return s.select("stmt_id", F.posexplode(QL.referenced_tables(QL.statement_body("sql"))).alias("pos", "table_name"))


@query("log_sql_audit")
def _log_audit(spark, sf_dir):
    return QL.audit(LOGS.statements(spark, sf_dir), LOGS.allowed_tables(spark))


@query("log_grounding")
def _log_grounding(spark, sf_dir):
    return QL.grounding(LOGS.answers(spark, sf_dir), LOGS.tool_calls(spark, sf_dir))


@query("log_tool_budget")
def _log_budget(spark, sf_dir):
    return QL.tool_budget(LOGS.tool_calls(spark, sf_dir))


@query("log_history_trim")
def _log_history(spark, sf_dir):
    return QL.history_trim(LOGS.messages(spark, sf_dir))


@query("log_strip_mentions")
def _log_mentions(spark, sf_dir):
    m = LOGS.messages(spark, sf_dir).filter(F.col("role") == "user")
    return m.select("session", "seq", QL.strip_mentions("text").alias("text"))


@query("log_usage_totals")
def _log_usage(spark, sf_dir):
    return QL.usage_totals(LOGS.usage(spark, sf_dir))


@query("log_history_marks")
def _log_history_marks(spark, sf_dir):
    return QL.history_marks(LOGS.messages(spark, sf_dir))


# ------------------------------------------------------------------ sources, sinks, catalogue
import uuid as _uuid  # noqa: E402

from shipwright.plans.build import build_for_checks, build_warehouse  # noqa: E402
from shipwright.session import scratch_root  # noqa: E402
from shipwright.sources import catalog as CAT  # noqa: E402
from shipwright.sources import commits as COMMITS  # noqa: E402
from shipwright.sources import csv_io as CSV  # noqa: E402
from shipwright.sources import sinks as SINK  # noqa: E402


def _scratch(spark, tag):
    return scratch_root(spark, f"{tag}-{_uuid.uuid4().hex[:8]}")


def _csv_files(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    root = _scratch(spark, "csv")
    return wh, {t: CSV.write_csv(wh[t].select(*CSV.schema_of(t).names), f"{root}/{t}") for t in CSV.RAW_SCHEMAS}


def _scan(table):
    def run(spark, sf_dir):
        wh = warehouse(spark, sf_dir)
        path = CSV.write_csv(wh[table].select(*CSV.schema_of(table).names), f"{_scratch(spark, 'csv')}/{table}")
        return CSV.read_csv_typed(spark, path, table)
    return run


QUERIES["scan_csv_typed"] = _scan("raw_orders")
for _t in CSV.RAW_SCHEMAS:
    if _t != "raw_orders":
        QUERIES["scan_csv_" + _t.removeprefix("raw_")] = _scan(_t)


@query("scan_header_check")
def _scan_header(spark, sf_dir):
    """Header verdict of every raw table next to the number of rows read under that header."""
    _, paths = _csv_files(spark, sf_dir)
    report = CSV.header_report(spark, paths).groupBy("table").agg(
        F.max("header").alias("header"), F.min("ok").alias("ok"))
    counts = reduce(DataFrame.unionByName, [
        CSV.read_csv_typed(spark, p, t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table"), "rows") for t, p in paths.items()])
    return report.join(counts, "table")


@query("load_row_counts")
def _load_counts(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    sources = {t: wh[t] for t in CSV.RAW_SCHEMAS}
    root = _scratch(spark, "load")
    CSV.load_raw_layer(spark, sources, root)
    return CSV.load_report(spark, root)


@query("materialize_mart")
def _materialize(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return SINK.materialize(wh["mart_kpi_daily_region"], _scratch(spark, "wh"), "analytics", "mart_kpi_daily_region")


def _appended(spark, sf_dir, cfg, again=False):
    """Two runs appended: all four output tables of each, the second a week later; ``again`` repeats both."""
    out = _run(spark, sf_dir, cfg)
    later = {name: df.withColumns({"run_id": F.lit("testbed0002"), "run_at": F.col("run_at") + F.expr("interval 7 days")})
             for name, df in out.items()}
    root = _scratch(spark, "fc")
    for _ in range(2 if again else 1):
        FP.append_run(out, root, TESTBED_RUN[0])
        FP.append_run(later, root, "testbed0002")
    return root


def _appended_runs(spark, sf_dir, cfg):
    return SINK.read_table(spark, _appended(spark, sf_dir, cfg), "forecasts", "forecast_runs")


QUERIES["forecast_append_runs"] = lambda spark, sf_dir: _appended_runs(spark, sf_dir, CFG)
QUERIES["uni_append_runs"] = lambda spark, sf_dir: _appended_runs(spark, sf_dir, UNI_CFG)


def _run_counts(spark, root):
    return reduce(DataFrame.unionByName, [
        SINK.read_table(spark, root, "forecasts", t).groupBy("run_id").agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(t).alias("table_name"), "run_id", "rows") for t in FP.OUTPUT_TABLES])


@query("uni_append_counts")
def _append_counts(spark, sf_dir):
    """Rows by run of each appended forecast table."""
    return _run_counts(spark, _appended(spark, sf_dir, UNI_CFG))


@query("uni_append_repeated")
def _append_repeated(spark, sf_dir):
    """The same when both runs were appended twice."""
    return _run_counts(spark, _appended(spark, sf_dir, UNI_CFG, again=True))


def _built(spark, sf_dir):
    """The whole warehouse written, the forecast tables of a three-model run appended beside it; their row counts as recorded."""
    wh = warehouse(spark, sf_dir)
    root = _scratch(spark, "wh")
    build_warehouse(wh, root)
    FP.append_run(_run(spark, sf_dir, UNI_CFG), root, TESTBED_RUN[0])
    for name in FP.OUTPUT_TABLES:
        SINK.read_table(spark, root, "forecasts", name).createOrReplaceTempView(SINK.view_name("forecasts", name))
    return COMMITS.recorded(spark, root)


@query("catalog_tables")
def _catalog_tables(spark, sf_dir):
    return CAT.catalog_tables(spark, recorded=_built(spark, sf_dir))


@query("catalog_columns")
def _catalog_columns(spark, sf_dir):
    """Columns with row counts and descriptions from a documentation frame."""
    recorded = _built(spark, sf_dir)
    docs = spark.createDataFrame(list(CAT.COLUMN_DOCS), "table_name string, column_name string, description string")
    return CAT.catalog_columns(spark, docs).join(CAT.catalog_tables(spark, recorded=recorded).select("table_schema", "table_name", "row_count"),
                                                 ["table_schema", "table_name"])


BOUNDED_SQL = ("select customer_state, count(*) as orders, avg(delivery_days) as avg_days "
               "from analytics.fct_orders where order_status <> 'analytics.fct_orders' group by customer_state")
BOUNDED_OVER_SQL = "select order_id from fct_orders where is_delivered"


def _bounded(statement, max_rows):
    def run(spark, sf_dir):
        wh = warehouse(spark, sf_dir)
        paths = build_warehouse(wh, _scratch(spark, "wh"), ("fct_orders",))
        return QL.run_bounded(spark, statement, {"analytics.fct_orders": paths["fct_orders"]}, LOGS.allowed_tables(spark), max_rows)
    return run


QUERIES["bounded_query"] = _bounded(BOUNDED_SQL, QL.MAX_ROWS)


@query("bounded_query_truncated")
def _bounded_over(spark, sf_dir):
    """More rows than the bound: which ones come is open, so their number and the mark are the result."""
    rows = _bounded(BOUNDED_OVER_SQL, QL.MAX_ROWS)(spark, sf_dir)
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.min("_truncated").alias("truncated"), F.count_distinct("order_id").alias("orders"))


@query("rows_to_json")
def _rows_to_json(spark, sf_dir):
    m = warehouse(spark, sf_dir)["mart_category_monthly"].select(
        "month_start", "category_name", "orders", F.col("gmv").cast("decimal(18,2)").alias("gmv"),
        F.col("category_name").cast("binary").alias("raw_name"), F.col("month_start").cast("timestamp_ntz").alias("at"))
    return m.select("month_start", "category_name", QL.json_row(m).alias("row_json"))


@query("agg_approx_median")
def _approx_median(spark, sf_dir):
    """Approximate median per week and state; rank error at most 1/200 of a group."""
    f = warehouse(spark, sf_dir)["fct_orders"].filter(F.col("is_delivered") & F.col("delivery_days").isNotNull())
    return (f.groupBy(F.col("purchase_week").alias("week_start"), F.col("customer_state").alias("state_code"))
             .agg(F.percentile_approx("delivery_days", 0.5, F.lit(200)).alias("median_delivery_days_approx")))


@query("sketch_median_rollup")
def _sketch_rollup(spark, sf_dir):
    """Median delivery days by state, macro-region and country from stored weekly sketches, judged by exact ranks.

    The answers themselves vary with the sketch's coin tosses; whether their true rank is within its error doesn't.
    """
    wh = warehouse(spark, sf_dir)
    stored = SINK.materialize(wh["delivery_time_sketches"], _scratch(spark, "sketches"), "analytics", "delivery_time_sketches")
    answers = marts.delivery_time_rollup(stored)
    rows = marts.delivered_with_days(wh)
    levels = {"state": F.col("customer_state"), "macro_region": F.col("customer_macro_region"), "country": F.lit(TS.COUNTRY_CODE)}
    each = reduce(DataFrame.unionByName, [rows.select(F.lit(k).alias("region_level"), c.alias("region_code"), "delivery_days") for k, c in levels.items()])
    by = ["region_level", "region_code"]
    ranks = QU.rank_range(each, by, "delivery_days", answers, "median_delivery_days")
    bound = 3 * QU.rank_error()
    return answers.join(ranks.drop("n"), by, "left").select(
        *by, "orders", ((F.col("low") <= 0.5 + bound) & (F.col("high") >= 0.5 - bound)).alias("within_rank_error"))


def drift_model(y, horizon):
    """Example user model for the plug-in: last value plus the mean weekly change."""
    import numpy as np
    step = (y[-1] - y[0]) / max(len(y) - 1, 1)
    return y[-1] + step * np.arange(1, horizon + 1)


@query("model_custom_pandas")
def _custom_pandas(spark, sf_dir):
    panel = FP.completed_panel(warehouse(spark, sf_dir), FC.DEMAND, CFG)
    return FC.custom_model_forecasts(panel, drift_model, "drift", CFG.horizon_weeks)
