"""Oracle SQL for panel preparation, folds, candidate gating and the moving-average model."""

from oracle.models import with_models

H, FOLDS, MIN_HISTORY, SHARE = 8, 6, 20, 0.7


def panel_sql(series, mart, value, weight, aggregate):
    w = weight or value
    if aggregate == "sum":
        agg = f"sum(cast({value} as double))"
    else:
        agg = (f"case when sum(cast({w} as double)) = 0 then null "
               f"else sum(cast({value} as double) * cast({w} as double)) / sum(cast({w} as double)) end")
    return f"""
        select '{series}' as series, 'state' as region_level, state_code as region_code, week_start,
               cast({value} as double) as value, cast({w} as double) as volume
        from {mart} where state_code is not null
        union all
        select '{series}', 'macro_region', macro_region, week_start, {agg}, sum(cast({w} as double))
        from {mart} where macro_region is not null group by macro_region, week_start
        union all
        select '{series}', 'country', 'BR', week_start, {agg}, sum(cast({w} as double))
        from {mart} group by week_start"""


def trim_sql(p):
    return f"""
        select p.* from {p} p
        left join (
            select series, case when max(n) >= 10 then max(case when i > 8 and total >= {SHARE} * ref
                                                                then week_start end) end as keep_until
            from (select series, week_start, total,
                         row_number() over (partition by series order by week_start) - 1 as i,
                         count(*) over (partition by series) as n,
                         median(total) over (partition by series order by week_start
                                             rows between 8 preceding and 1 preceding) as ref
                  from (select series, week_start, sum(volume) as total from {p} group by series, week_start) tot) t
            group by series) c on p.series = c.series
        where c.keep_until is null or p.week_start <= c.keep_until"""


def censor_sql(p):
    return f"""
        select p.* from {p} p
        join (select series, week_start as cut
              from (select series, week_start, dense_rank() over (partition by series order by week_start desc) as r
                    from (select distinct series, week_start from {p}) d) x
              where r = 2) c on p.series = c.series
        where p.week_start <= c.cut"""


def complete_sql(p, aggregate):
    keys = "f.series, f.region_level, f.region_code"
    if aggregate == "sum":
        value = "coalesce(f.value, 0.0)"
    else:
        win = f"partition by {keys} order by f.week_start"
        value = (f"coalesce(last_value(f.value ignore nulls) over ({win} rows between unbounded preceding and current row), "
                 f"first_value(f.value ignore nulls) over ({win} rows between current row and unbounded following))")
    return f"""
        select {keys}, f.week_start, {value} as value, coalesce(f.volume, 0.0) as volume
        from (select g.series, g.region_level, g.region_code, g.week_start, p.value, p.volume
              from (select r.series, r.region_level, r.region_code, w.week_start
                    from (select distinct series, region_level, region_code from {p}) r
                    join (select series, cast(unnest(generate_series(lo, hi, interval 7 day)) as date) as week_start
                          from (select series, min(week_start) as lo, max(week_start) as hi from {p} group by series) b
                         ) w on r.series = w.series) g
              left join {p} p on g.series = p.series and g.region_level = p.region_level
                             and g.region_code = p.region_code and g.week_start = p.week_start) f"""


FORECAST_CTES = [
    ("panel_demand", panel_sql("demand_orders", "mart_demand_weekly_region", "orders", None, "sum")),
    ("panel_delivery", panel_sql("delivery_days", "mart_delivery_time_weekly_region", "avg_delivery_days",
                                 "delivered_orders", "weighted_mean")),
    ("trim_demand", trim_sql("panel_demand")),
    ("trim_delivery", trim_sql("panel_delivery")),
    ("censor_delivery", censor_sql("trim_delivery")),
    ("complete_demand", complete_sql("trim_demand", "sum")),
    ("complete_delivery", complete_sql("censor_delivery", "weighted_mean")),
    ("indexed_demand", """
        select *, row_number() over (partition by series, region_level, region_code order by week_start) - 1 as t,
               count(*) over (partition by series, region_level, region_code) as n
        from complete_demand"""),
    ("origins_demand", f"""
        select series, region_level, region_code, n,
               case when k = {FOLDS} then n - 1 else n - {H} - k - 1 end as origin, k = {FOLDS} as is_refit
        from (select distinct series, region_level, region_code, n from indexed_demand) s, range(0, {FOLDS + 1}) r(k)
        where k = {FOLDS} or n - {H} - k - 1 + 1 >= {MIN_HISTORY}"""),
]


def with_forecast(final_select: str) -> str:
    extra = ",\n".join(f"{n} as ({s})" for n, s in FORECAST_CTES)
    return with_models(f", {extra}\n{final_select}")


FORECAST_ORACLE = {
    "panel_demand": with_forecast("select * from panel_demand"),
    "panel_delivery": with_forecast("select * from panel_delivery"),
    "trim_incomplete_tail": with_forecast("select * from trim_demand"),
    "censor_tail": with_forecast("select * from censor_delivery"),
    "complete_weeks_demand": with_forecast("select * from complete_demand"),
    "complete_weeks_delivery": with_forecast("select * from complete_delivery"),
    "rolling_origin_folds": with_forecast(
        "select series, region_level, region_code, cast(origin as bigint) as origin, is_refit from origins_demand"),
    "candidate_models": with_forecast("""
        select s.series, s.region_level, s.region_code, m.model_name
        from (select series, region_level, region_code, avg(volume) as mean_vol
              from indexed_demand where t >= n - 12 group by series, region_level, region_code) s
        join (values ('moving_average_4', 0), ('seasonal_naive_yoy', 1), ('holt_damped', 2), ('pooled_gbm', 3)) m(model_name, ord)
          on m.ord = 0 or (s.mean_vol >= 5.0 and (m.ord < 3 or s.region_level = 'state'))"""),
    "model_moving_average": with_forecast(f"""
        , ma as (
            select o.series, o.region_level, o.region_code, o.origin, o.is_refit, o.n, avg(c.value) as level
            from origins_demand o join indexed_demand c
              on c.series = o.series and c.region_level = o.region_level and c.region_code = o.region_code
             and c.t between o.origin - 3 and o.origin
            group by o.series, o.region_level, o.region_code, o.origin, o.is_refit, o.n)
        select ma.series, ma.region_level, ma.region_code, 'moving_average_4' as model_name,
               cast(ma.origin as bigint) as origin, ma.is_refit, cast(hh.h as bigint) as h,
               greatest(ma.level, 0.0) as forecast, a.value as actual
        from ma cross join range(1, {H + 1}) hh(h)
        left join indexed_demand a on a.series = ma.series and a.region_level = ma.region_level
             and a.region_code = ma.region_code and a.t = ma.origin + hh.h"""),
}

FORECAST_ORACLE["pooled_features"] = with_forecast("""
    , f as (
        select series, region_code, week_start, ln(1 + greatest(value, 0.0)) as v,
               row_number() over w - 1 as t,
               avg(ln(1 + greatest(value, 0.0))) over (w rows between 4 preceding and 1 preceding) as level_4,
               avg(ln(1 + greatest(value, 0.0))) over (w rows between 8 preceding and 1 preceding) as level_8,
               sin(2 * pi() * weekofyear(week_start) / 52.18) as woy_sin,
               cos(2 * pi() * weekofyear(week_start) / 52.18) as woy_cos,
               lag(ln(1 + greatest(value, 0.0)), 1) over w as lag_1, lag(ln(1 + greatest(value, 0.0)), 2) over w as lag_2,
               lag(ln(1 + greatest(value, 0.0)), 3) over w as lag_3, lag(ln(1 + greatest(value, 0.0)), 4) over w as lag_4,
               lag(ln(1 + greatest(value, 0.0)), 6) over w as lag_6, lag(ln(1 + greatest(value, 0.0)), 8) over w as lag_8
        from complete_demand where region_level = 'state'
        window w as (partition by series, region_level, region_code order by week_start))
    select series, region_code, week_start, t, v - level_4 as target, woy_sin, woy_cos, level_4, level_8,
           lag_1, lag_2, lag_3, lag_4, lag_6, lag_8
    from f where t >= 8""")
