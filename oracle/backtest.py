"""Oracle SQL for the three univariate models, the backtest, champions, a three-model run and what reads it.

Written from the definitions: the damped trend model is a recursive query over the weeks (its state after a
week doesn't depend on the backtest origin), everything else joins weeks by their index.
"""

from oracle.forecast import FOLDS, FORECAST_CTES, H, MIN_HISTORY
from oracle.models import with_models

KEYS = "series, region_level, region_code"
PHI, SEASON, GATE = 0.9, 52, 5.0
ALPHAS, BETAS = (0.2, 0.4, 0.6, 0.8), (0.05, 0.1, 0.2, 0.4)
GRID = ", ".join(f"({4 * i + j}, cast({a} as double), cast({b} as double))" for i, a in enumerate(ALPHAS) for j, b in enumerate(BETAS))
DAMP = ", ".join(f"({h}, cast({sum(PHI ** j for j in range(1, h + 1))!r} as double))" for h in range(1, H + 1))
RUN_ID, RUN_AT = "testbed0001", "timestamp '2026-01-01 00:00:00'"
DASH_START = "1997-01-01"


def same(a, b):
    return " and ".join(f"{a}.{k} = {b}.{k}" for k in KEYS.split(", "))


def series_ctes(s):
    """CTEs ending in bt_{s}: candidate, origin and horizon rows of one series."""
    return [
        (f"ix_{s}", f"""select *, row_number() over (partition by {KEYS} order by week_start) - 1 as t,
                   count(*) over (partition by {KEYS}) as n from complete_{s}"""),
        (f"og_{s}", f"""select distinct {KEYS}, n, case when k = {FOLDS} then n - 1 else n - {H} - k - 1 end as origin, k = {FOLDS} as is_refit
            from ix_{s}, range(0, {FOLDS + 1}) r(k) where k = {FOLDS} or n - {H} - k >= {MIN_HISTORY}"""),
        (f"win_{s}", f"""select o.series, o.region_level, o.region_code, o.n, o.origin, o.is_refit,
                   avg(c.value) filter (where c.t > o.origin - 4) as level, sum(c.value) filter (where c.t > o.origin - 4) as recent,
                   coalesce(sum(c.value) filter (where c.t between o.origin - {SEASON + 3} and o.origin - {SEASON}), 0) as before
            from og_{s} o join ix_{s} c on {same('o', 'c')} and c.t <= o.origin group by all"""),
        (f"holt_{s}", f"""
            select {KEYS}, 0 as t, g, alpha, beta, value as level,
                   (select x.value from ix_{s} x where {same('x', 'a')} and x.t = 1) - value as trend, cast(0 as double) as sse
            from ix_{s} a, (values {GRID}) grid(g, alpha, beta) where a.t = 0
            union all
            select h.series, h.region_level, h.region_code, h.t + 1, h.g, h.alpha, h.beta,
                   h.alpha * y.value + (1.0 - h.alpha) * (h.level + {PHI} * h.trend),
                   h.beta * ((h.alpha * y.value + (1.0 - h.alpha) * (h.level + {PHI} * h.trend)) - h.level)
                       + (1.0 - h.beta) * {PHI} * h.trend,
                   h.sse + (y.value - (h.level + {PHI} * h.trend)) * (y.value - (h.level + {PHI} * h.trend))
            from holt_{s} h join ix_{s} y on {same('h', 'y')} and y.t = h.t + 1"""),
        (f"best_{s}", f"""select o.series, o.region_level, o.region_code, o.origin, o.is_refit, h.level, h.trend
            from og_{s} o join holt_{s} h on {same('o', 'h')} and h.t = o.origin
            qualify row_number() over (partition by o.series, o.region_level, o.region_code, o.origin, o.is_refit order by h.sse, h.g) = 1"""),
        (f"all_{s}", f"""
            select w.series, w.region_level, w.region_code, 'moving_average_4' as model_name, w.origin, w.is_refit, d.h, w.level as f
            from win_{s} w, (values {DAMP}) d(h, damp)
            union all
            select w.series, w.region_level, w.region_code, 'seasonal_naive_yoy', w.origin, w.is_refit, d.h,
                   case when w.origin + 1 < {SEASON + 4} then w.level
                        else y.value * least(greatest(case when w.before > 0 then w.recent / w.before else 1.0 end, 0.25), 4.0) end
            from win_{s} w cross join (values {DAMP}) d(h, damp)
            left join ix_{s} y on {same('y', 'w')} and y.t = w.origin + d.h - {SEASON}
            union all
            select b.series, b.region_level, b.region_code, 'holt_damped', b.origin, b.is_refit, d.h, b.level + d.damp * b.trend
            from best_{s} b, (values {DAMP}) d(h, damp)"""),
        (f"fc_{s}", f"""select a.series, a.region_level, a.region_code, a.model_name, cast(a.origin as bigint) as origin, a.is_refit,
                   cast(a.h as bigint) as h, greatest(a.f, 0.0) as forecast, y.value as actual
            from all_{s} a left join ix_{s} y on {same('y', 'a')} and y.t = a.origin + a.h"""),
        (f"cand_{s}", f"""select v.series, v.region_level, v.region_code, m.model_name, m.ord
            from (select {KEYS}, avg(volume) as mean_vol from ix_{s} where t >= n - 12 group by {KEYS}) v
            join (values ('moving_average_4', 0), ('seasonal_naive_yoy', 1), ('holt_damped', 2)) m(model_name, ord)
              on m.ord = 0 or v.mean_vol >= {GATE}"""),
        (f"bt_{s}", f"select f.* from fc_{s} f join cand_{s} c on {same('f', 'c')} and f.model_name = c.model_name"),
        (f"acc_{s}", f"""
            select {KEYS}, model_name, cast(case when grouping(h) = 1 then 0 else h end as bigint) as horizon_weeks,
                   cast(case when grouping(h) = 1 then count(distinct origin) else count(*) end as bigint) as n_folds,
                   avg(abs(actual - forecast)) as mae,
                   avg(case when abs(actual) + abs(forecast) = 0 then 0.0
                            else 2.0 * abs(forecast - actual) / (abs(actual) + abs(forecast)) end) as smape,
                   case when sum(abs(actual)) > 0 then sum(abs(actual - forecast)) / sum(abs(actual)) else 'nan'::double end as wape,
                   avg(forecast - actual) as bias
            from bt_{s} where not is_refit group by grouping sets (({KEYS}, model_name, h), ({KEYS}, model_name))"""),
        (f"res_{s}", f"""select {KEYS}, model_name, h, quantile_cont(actual - forecast, 0.1) as q_lo, quantile_cont(actual - forecast, 0.9) as q_hi
            from bt_{s} where not is_refit group by {KEYS}, model_name, h"""),
        (f"champ_{s}", f"""select c.series, c.region_level, c.region_code, c.model_name as champion, coalesce(a.wape, 'inf'::double) as backtest_wape
            from cand_{s} c left join acc_{s} a on {same('a', 'c')} and a.model_name = c.model_name and a.horizon_weeks = 0
            qualify row_number() over (partition by c.series, c.region_level, c.region_code
                order by case when isnan(a.wape) then 2 when a.wape is null then 1 else 0 end, a.wape, c.ord) = 1"""),
        (f"span_{s}", f"""select series, min(week_start) as lo, max(week_start) as hi, count(distinct week_start) as weeks,
                   count(distinct region_level || '/' || region_code) as regions from complete_{s} group by series"""),
        (f"pub_{s}", f"""
            select '{RUN_ID}' as run_id, {RUN_AT} as run_at, b.series, b.region_level, b.region_code, c.champion as model_name,
                   cast(s.hi as timestamp) as origin_week, cast(s.hi + cast(b.h * 7 as integer) as timestamp) as week_start,
                   b.h as horizon_weeks, b.forecast,
                   greatest(least(b.forecast + coalesce(q.q_lo, 0.0), b.forecast), 0.0) as forecast_lower,
                   greatest(b.forecast + coalesce(q.q_hi, 0.0), b.forecast) as forecast_upper, c.backtest_wape
            from bt_{s} b join champ_{s} c on {same('b', 'c')} and b.model_name = c.champion
            join span_{s} s on s.series = b.series
            left join res_{s} q on {same('b', 'q')} and q.model_name = b.model_name and q.h = b.h
            where b.is_refit"""),
        (f"table_{s}", f"""
            select '{RUN_ID}' as run_id, {RUN_AT} as run_at, a.series, a.region_level, a.region_code, a.model_name, a.horizon_weeks,
                   a.n_folds, a.mae, a.smape, a.wape, a.bias, a.model_name = c.champion as is_champion,
                   cast(s.hi as timestamp) as train_end_week, s.weeks as n_train_weeks
            from acc_{s} a join champ_{s} c on {same('a', 'c')} join span_{s} s on s.series = a.series"""),
        (f"runs_{s}", f"""
            select '{RUN_ID}' as run_id, {RUN_AT} as run_at, s.series, cast(s.lo as timestamp) as train_start_week,
                   cast(s.hi as timestamp) as train_end_week, s.regions as n_regions, cast({H} as bigint) as horizon_weeks,
                   cast({FOLDS} as bigint) as backtest_folds, m.med as median_champion_wape, m.country_model as country_champion_model,
                   m.country_wape as country_champion_wape,
                   '{{"horizon_weeks": 8, "backtest_folds": 6, "min_history_weeks": 20, "incomplete_tail_share": 0.7}}' as config_json
            from span_{s} s left join (
                select series, median(wape) as med, max(case when region_level = 'country' then model_name end) as country_model,
                       max(case when region_level = 'country' then wape end) as country_wape
                from table_{s} where is_champion and horizon_weeks = 0 group by series) m on m.series = s.series"""),
    ]


RUN_CTES = [
    ("pub", "select * from pub_demand union all select * from pub_delivery"),
    ("accuracy", "select * from table_demand union all select * from table_delivery"),
    ("runs", "select * from runs_demand union all select * from runs_delivery"),
    ("fva", """
        select f.run_id, f.run_at, f.series, f.region_level, f.region_code, f.model_name, f.origin_week,
               cast(f.week_start as date) as week_start, f.horizon_weeks, f.forecast, f.forecast_lower, f.forecast_upper, f.backtest_wape,
               a.value as actual, a.value - f.forecast as error, abs(a.value - f.forecast) as abs_error,
               case when a.value <> 0 then abs(a.value - f.forecast) / abs(a.value) end as abs_pct_error,
               case when a.value is not null then a.value between f.forecast_lower and f.forecast_upper end as within_interval
        from pub f left join (select * from panel_demand union all select * from panel_delivery) a
          on a.series = f.series and a.region_level = f.region_level and a.region_code = f.region_code
         and a.week_start = cast(f.week_start as date)"""),
    ("latest", """
        select a.run_id, a.run_at, a.series, a.region_level, a.region_code, a.model_name, a.is_champion, a.horizon_weeks, a.n_folds,
               a.mae, a.smape, a.wape, a.bias, a.train_end_week, a.n_train_weeks
        from accuracy a join (select series, max(run_at) as run_at from runs group by series) r on r.series = a.series and r.run_at = a.run_at"""),
    ("dvf", f"""
        select coalesce(o.week_start, f.week_start) as week_start, cast(o.orders as double) as orders, f.forecast, f.forecast_lower,
               f.forecast_upper, f.model_name
        from (select week_start, sum(orders) as orders from mart_demand_weekly_region group by week_start) o
        full join (select cast(week_start as date) as week_start, forecast, forecast_lower, forecast_upper, model_name
                   from pub where series = 'demand_orders' and region_level = 'country') f on f.week_start = o.week_start
        where coalesce(o.week_start, f.week_start) >= date '{DASH_START}'"""),
]


def sql(final, *series, run=False):
    ctes = [*FORECAST_CTES, *[c for s in (("demand", "delivery") if run else series) for c in series_ctes(s)], *(RUN_CTES if run else [])]
    text = with_models(", " + ",\n".join(f"{n} as ({q})" for n, q in ctes) + "\n" + final)
    head, _, rest = text.lstrip().partition(" ")
    assert head.lower() == "with"
    return "with recursive " + rest


BACKTEST_ORACLE = {}
for _s, _tag in (("demand", ""), ("delivery", "_delivery")):
    for _key, _model in (("model_moving_average", "moving_average_4"), ("model_seasonal_naive", "seasonal_naive_yoy"), ("model_holt_damped", "holt_damped")):
        BACKTEST_ORACLE[_key + _tag] = sql(f"select * from fc_{_s} where model_name = '{_model}'", _s)
    BACKTEST_ORACLE["backtest_univariate" + _tag] = sql(f"select * from bt_{_s} where not is_refit", _s)
    BACKTEST_ORACLE["metrics_by_model" + _tag] = sql(f"select * from acc_{_s} where horizon_weeks = 0", _s)
    BACKTEST_ORACLE["residual_quantiles" + _tag] = sql(f"select * from res_{_s}", _s)
    BACKTEST_ORACLE["champion_models" + _tag] = sql(f"select * from champ_{_s}", _s)
BACKTEST_ORACLE["rolling_origin_folds_delivery"] = sql(
    f"select {KEYS}, cast(origin as bigint) as origin, is_refit from og_delivery", "delivery")
BACKTEST_ORACLE["candidate_models_delivery"] = sql(f"""
    select {KEYS}, model_name from cand_delivery
    union all select {KEYS}, 'pooled_gbm' from cand_delivery where model_name = 'holt_damped' and region_level = 'state'""", "delivery")
BACKTEST_ORACLE |= {
    "uni_forecast_accuracy": sql("select * from accuracy", run=True),
    "uni_forecast_publish": sql("select * from pub_demand", run=True),
    "uni_forecast_publish_delivery": sql("select * from pub_delivery", run=True),
    "uni_forecast_runs": sql("select * from runs", run=True),
    "uni_append_runs": sql("select * from runs union all select * replace ('testbed0002' as run_id, run_at + interval 7 day as run_at) from runs", run=True),
    "uni_mart_forecast_vs_actual": sql("select * from fva", run=True),
    "uni_mart_forecast_accuracy_latest": sql("select * from latest", run=True),
    "uni_dash_demand_actual_vs_forecast": sql("select * from dvf", run=True),
    "uni_dash_demand_chart": sql("""
        select week_start, case when week_start < (select min(week_start) from dvf where forecast is not null)
                                  or not exists (select 1 from dvf where forecast is not null) then orders end as orders,
               forecast, forecast_lower, forecast_upper, model_name from dvf""", run=True),
    "uni_dash_forecast_accuracy": sql("""
        select region_code, model_name, wape, smape, bias from latest
        where series = 'demand_orders' and region_level = 'macro_region' and is_champion and horizon_weeks = 0""", run=True),
    "uni_dash_forecast_series": sql("""
        select week_start, sum(actual) as actual, sum(forecast) as forecast, sum(forecast_lower) as forecast_lower,
               sum(forecast_upper) as forecast_upper
        from fva where series = 'demand_orders' and region_level = 'country' group by week_start""", run=True),
    "uni_dash_accuracy_drilldown": sql("""
        select series, region_code, model_name, horizon_weeks, avg(wape) as wape, avg(smape) as smape, avg(bias) as bias
        from latest group by series, region_code, model_name, horizon_weeks""", run=True),
    "uni_realised_wape": sql("""
        select sum(abs_error) / nullif(sum(actual), 0) as realised_wape, sum(forecast) filter (where series = 'demand_orders') as forecast_orders,
               sum(actual) filter (where series = 'demand_orders') as actual_orders from fva""", run=True),
    "uni_champion_backtest_wape": sql("""
        select avg(wape) as champion_backtest_wape from latest where is_champion and horizon_weeks = 0""", run=True),
}

BACKTEST_ORACLE["model_custom_pandas"] = sql("""
    select series, region_level, region_code, 'drift' as model_name, cast(h as bigint) as h,
           last_y + (last_y - first_y) / greatest(n - 1, 1) * h as forecast
    from (select series, region_level, region_code, n, max(value) filter (where t = 0) as first_y, max(value) filter (where t = n - 1) as last_y
          from ix_demand group by series, region_level, region_code, n) e, range(1, 9) r(h)""", "demand")
BACKTEST_ORACLE["pooled_features_delivery"] = sql("""
    , f as (
        select series, region_code, week_start, t, value as v, avg(value) over (w rows between 4 preceding and 1 preceding) as level_4,
               avg(value) over (w rows between 8 preceding and 1 preceding) as level_8,
               sin(2 * pi() * weekofyear(week_start) / 52.18) as woy_sin, cos(2 * pi() * weekofyear(week_start) / 52.18) as woy_cos,
               lag(value, 1) over w as lag_1, lag(value, 2) over w as lag_2, lag(value, 3) over w as lag_3, lag(value, 4) over w as lag_4,
               lag(value, 6) over w as lag_6, lag(value, 8) over w as lag_8, lag(ln(1 + volume), 1) over w as exog_log_volume
        from ix_delivery where region_level = 'state' window w as (partition by region_code order by week_start))
    select series, region_code, week_start, t, v - level_4 as target, woy_sin, woy_cos, level_4, level_8, lag_1, lag_2, lag_3, lag_4,
           lag_6, lag_8, exog_log_volume from f where t >= 8""", "delivery")

BACKTEST_ORACLE["uni_dq_forecast_marts"] = sql("\nunion all\n".join(
    f"select '{t}__{m}__{c}' as test_id, '{m}' as model, '{c}' as column_name, '{t}' as test, cast(count(*) as bigint) as failures from ({v}) v"
    for t, m, c, v in [
        ("accepted_values", "mart_forecast_vs_actual", "series", "select distinct series from fva where series not in ('demand_orders', 'delivery_days')"),
        ("accepted_values", "mart_forecast_vs_actual", "region_level",
         "select distinct region_level from fva where region_level not in ('state', 'macro_region', 'country')"),
        ("between", "mart_forecast_vs_actual", "horizon_weeks", "select 1 from fva where horizon_weeks not between 1 and 52"),
        ("not_null", "mart_forecast_vs_actual", "forecast", "select 1 from fva where forecast is null"),
        ("not_null", "mart_forecast_accuracy_latest", "wape", "select 1 from latest where wape is null"),
        ("non_negative", "mart_forecast_accuracy_latest", "wape", "select 1 from latest where wape < 0")]), run=True)
