"""Oracle SQL per registered query key (DuckDB dialect, over the pre-registered test tables)."""

from oracle.models import money, ratio, with_models

DASH = ("1997-01-01", "1999-12-31")

ORACLE: dict[str, str] = {}

for _m in ("stg_orders", "stg_customers", "stg_sellers", "stg_products", "stg_order_items", "stg_order_payments",
           "stg_order_reviews", "stg_geolocation_zip", "int_order_items_agg", "int_order_payments_agg",
           "int_order_reviews_latest", "int_order_distance", "dim_customers", "dim_sellers", "dim_products",
           "dim_regions", "dim_dates", "fct_orders", "fct_order_items", "mart_kpi_daily_region",
           "mart_unit_economics_monthly", "mart_demand_weekly_region", "mart_delivery_time_weekly_region",
           "mart_seller_performance", "mart_category_monthly"):
    ORACLE[_m] = with_models(f"select * from {_m}")

_RANGE = f"date_day between date '{DASH[0]}' and date '{DASH[1]}'"
_WEIGHTED = ratio(money("avg_delivery_days * delivered_orders"), "sum(delivered_orders)")

ORACLE["dash_headline"] = with_models(f"""
    select cast(sum(orders) as bigint) as orders, cast(sum(delivered_orders) as bigint) as delivered_orders,
           {ratio('sum(on_time_orders)::double', 'sum(delivered_orders)')} as on_time_rate,
           {ratio(money('contribution_margin'), 'sum(orders)')} as margin_per_order,
           {ratio(money('delivery_cost'), 'sum(delivered_orders)')} as cost_per_delivery,
           {money('gmv')} as gmv, {money('delivery_cost')} as delivery_cost,
           {money('contribution_margin')} as contribution_margin
    from mart_kpi_daily_region where {_RANGE}""")

ORACLE["dash_weekly_service"] = with_models(f"""
    select d.week_start, k.macro_region, cast(sum(k.delivered_orders) as bigint) as delivered_orders,
           {ratio('sum(k.on_time_orders)::double', 'sum(k.delivered_orders)')} as on_time_rate,
           {ratio(money('k.avg_delivery_days * k.delivered_orders'), 'sum(k.delivered_orders)')} as avg_delivery_days
    from mart_kpi_daily_region k join dim_dates d on k.date_day = d.date_day
    where k.{_RANGE}
    group by d.week_start, k.macro_region order by 1, 2""")

ORACLE["dash_monthly_unit_economics"] = with_models(f"""
    select month_start, cast(sum(orders) as bigint) as orders,
           {ratio(money('contribution_margin'), 'sum(orders)')} as margin_per_order,
           {ratio(money('delivery_cost'), 'sum(delivered_orders)')} as cost_per_delivery,
           {ratio(money('platform_revenue'), 'sum(orders)')} as revenue_per_order,
           {ratio(money('platform_cost'), 'sum(orders)')} as cost_per_order,
           {ratio(money('gmv'), 'sum(orders)')} as avg_order_value
    from mart_unit_economics_monthly where month_start between date '{DASH[0]}' and date '{DASH[1]}'
    group by month_start order by 1""")

ORACLE["dash_state_scorecard"] = with_models(f"""
    select state_code, macro_region, cast(sum(orders) as bigint) as orders,
           {ratio('sum(on_time_orders)::double', 'sum(delivered_orders)')} as on_time_rate,
           {_WEIGHTED} as avg_delivery_days,
           {ratio(money('contribution_margin'), 'sum(orders)')} as margin_per_order,
           {ratio(money('delivery_cost'), 'sum(delivered_orders)')} as cost_per_delivery,
           {ratio(money('gmv'), 'sum(orders)')} as avg_order_value
    from mart_kpi_daily_region where {_RANGE}
    group by state_code, macro_region order by 3 desc""")

ORACLE["dash_cost_mix"] = with_models(f"""
    select month_start, {money('delivery_cost')} as delivery_cost, {money('payment_fees')} as payment_fees,
           {money('handling_cost')} as handling_cost
    from mart_unit_economics_monthly group by month_start""")

_MEASURES = f"""
           cast(sum(orders) as bigint) as orders, cast(sum(delivered_orders) as bigint) as delivered_orders,
           {money('gmv')} as gmv,
           {ratio('sum(on_time_orders)::double', 'sum(delivered_orders)')} as on_time_rate,
           {_WEIGHTED} as avg_delivery_days,
           {money('contribution_margin')} as contribution_margin,
           {ratio(money('contribution_margin'), 'sum(orders)')} as margin_per_order,
           {ratio(money('delivery_cost'), 'sum(delivered_orders)')} as cost_per_delivery,
           {ratio(money('gmv'), 'sum(orders)')} as avg_order_value,
           {ratio(money('freight_revenue'), money('gmv'))} as freight_to_gmv,
           {ratio(money('contribution_margin'), money('platform_revenue'))} as contribution_margin_pct"""

ORACLE["kpi_measures"] = with_models(f"""
    select macro_region, {_MEASURES} from mart_kpi_daily_region group by macro_region""")

ORACLE["kpi_prior_year"] = with_models(f"""
    , monthly as (
        select cast(date_trunc('month', date_day) as date) as month_start, cast(sum(orders) as bigint) as orders,
               {ratio('sum(on_time_orders)::double', 'sum(delivered_orders)')} as on_time_rate,
               {ratio(money('contribution_margin'), 'sum(orders)')} as margin_per_order
        from mart_kpi_daily_region group by 1)
    select m.month_start, m.orders, m.on_time_rate, m.margin_per_order,
           p.orders as orders_py, p.on_time_rate as on_time_rate_py, p.margin_per_order as margin_per_order_py,
           m.margin_per_order - p.margin_per_order as margin_per_order_delta_py
    from monthly m left join monthly p on m.month_start = cast(p.month_start + interval 12 month as date)""")

ORACLE["kpi_previous_period"] = with_models(f"""
    , bounds as (select date '{DASH[0]}' as s, date '{DASH[1]}' as e,
                        date_diff('day', date '{DASH[0]}', date '{DASH[1]}') + 1 as len)
    select case when k.date_day between b.s and b.e then 'current' else 'previous' end as period, {_MEASURES}
    from mart_kpi_daily_region k, bounds b
    where k.date_day between b.s and b.e or k.date_day between b.s - cast(b.len as integer) and b.s - 1
    group by 1""")

from oracle.quality import QUALITY_ORACLE  # noqa: E402

ORACLE.update(QUALITY_ORACLE)

from oracle.forecast import FORECAST_ORACLE  # noqa: E402

ORACLE.update(FORECAST_ORACLE)

from oracle.backtest import BACKTEST_ORACLE  # noqa: E402

ORACLE.update(BACKTEST_ORACLE)

from oracle.querylog import LOG_ORACLE  # noqa: E402

ORACLE.update(LOG_ORACLE)

from oracle.io import IO_ORACLE  # noqa: E402

ORACLE.update(IO_ORACLE)
