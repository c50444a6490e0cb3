"""Oracle SQL for the source, sink and catalogue queries. Headers, tables and column lists are stated here again."""

from oracle.backtest import sql
from oracle.models import with_models

HEADERS = {
    "raw_customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state",
    "raw_geolocation": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state",
    "raw_order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value",
    "raw_order_payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value",
    "raw_order_reviews": "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
                         "review_answer_timestamp",
    "raw_orders": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
                  "order_delivered_customer_date,order_estimated_delivery_date",
    "raw_products": "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,"
                    "product_weight_g,product_length_cm,product_height_cm,product_width_cm",
    "raw_sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state",
    "raw_category_translation": "product_category_name,product_category_name_english",
}
ANALYTICS = ("dim_regions dim_dates dim_customers dim_sellers dim_products fct_orders fct_order_items mart_kpi_daily_region "
             "mart_unit_economics_monthly mart_demand_weekly_region mart_delivery_time_weekly_region mart_seller_performance "
             "mart_category_monthly").split()
FORECASTS = {"forecast_demand_weekly_region": "pub_demand", "forecast_delivery_time_weekly_region": "pub_delivery",
             "forecast_accuracy": "accuracy", "forecast_runs": "runs"}
N_COLUMNS = {"dim_regions": 4, "dim_dates": 8, "dim_customers": 9, "dim_sellers": 12, "dim_products": 11, "fct_orders": 50,
             "fct_order_items": 25, "mart_kpi_daily_region": 28, "mart_unit_economics_monthly": 25, "mart_demand_weekly_region": 9,
             "mart_delivery_time_weekly_region": 12, "mart_seller_performance": 15, "mart_category_monthly": 11,
             "forecast_demand_weekly_region": 13, "forecast_delivery_time_weekly_region": 13, "forecast_accuracy": 15, "forecast_runs": 12}

_UNION = "\nunion all\n"
# Descriptions of documented columns, as (table, column): text.
DOCS = {
    ("fct_orders", "contribution_margin"): "platform revenue less platform cost",
    ("fct_orders", "delivery_days"): "days from purchase to delivery, delivered orders only",
    ("fct_orders", "distance_km"): "great-circle distance between customer and primary seller",
    ("mart_kpi_daily_region", "on_time_rate"): "delivered on or before the estimated date, share of delivered orders",
    ("dim_dates", "iso_day_of_week"): "1 Monday to 7 Sunday",
    ("forecast_accuracy", "horizon_weeks"): "weeks ahead; 0 pools all horizons",
    ("forecast_accuracy", "wape"): "sum of absolute errors over sum of absolute actuals",
}
_TYPES = "map {'VARCHAR': 'string', 'BIGINT': 'bigint', 'INTEGER': 'int', 'DOUBLE': 'double', 'DATE': 'date', 'TIMESTAMP': 'timestamp_ntz', 'BOOLEAN': 'boolean'}"


def _columns(schema, table, source):
    """A table's columns and types as the engine itself names them, in order."""
    return f"""select '{schema}' as table_schema, '{table}' as table_name, u.n as column_name, u.t, (select count(*) from {source}) as row_count,
        row_number() over () - 1 as ordinal
        from (unpivot (select typeof(columns(*)) from {source} limit 1) on columns(*) into name n value t) u"""


_COLUMNS = _UNION.join([_columns("analytics", t, t) for t in ANALYTICS] + [_columns("forecasts", t, q) for t, q in FORECASTS.items()])
_DOCUMENTED = " ".join(f"when table_name = '{t}' and column_name = '{c}' then '{d}'" for (t, c), d in DOCS.items())

_COUNTS = _UNION.join(
    [f"select 'analytics' as table_schema, '{t}' as table_name, {N_COLUMNS[t]} as n_columns, count(*) as row_count from {t}" for t in ANALYTICS]
    + [f"select 'forecasts', '{t}', {N_COLUMNS[t]}, count(*) from {q}" for t, q in FORECASTS.items()])

IO_ORACLE = {
    "scan_csv_typed": with_models("select * from raw_orders"),
    **{"scan_csv_" + t.removeprefix("raw_"): with_models(f"select {h} from {t}") for t, h in HEADERS.items() if t != "raw_orders"},
    # the files hold whole seconds
    "scan_csv_order_reviews": with_models(f"""select {HEADERS['raw_order_reviews']} from (select * replace (
        date_trunc('second', review_creation_date) as review_creation_date,
        date_trunc('second', review_answer_timestamp) as review_answer_timestamp) from raw_order_reviews) r"""),
    "scan_header_check": with_models(_UNION.join(
        f"select '{t}' as \"table\", '{h}' as header, true as ok, count(*) as rows from {t}" for t, h in HEADERS.items())),
    "load_row_counts": with_models(_UNION.join(
        f"select '{t}' as \"table\", count(*) as rows, count(*) as expected, true as ok from {t}" for t in HEADERS)),
    "materialize_mart": with_models("select * from mart_kpi_daily_region"),
    "catalog_tables": sql(f"select *, cast(null as varchar) as error from ({_COUNTS}) c", run=True),
    "uni_append_counts": sql(_UNION.join(
        f"select '{t}' as table_name, r.run_id, count(*) as rows from {q}, (values ('testbed0001'), ('testbed0002')) r(run_id) group by r.run_id"
        for t, q in FORECASTS.items()), run=True),
    "catalog_columns": sql(f"""select table_schema, table_name, cast(ordinal as integer) as ordinal, column_name, ({_TYPES})[t] as data_type,
        case {_DOCUMENTED} else '' end as description, row_count from ({_COLUMNS}) c""", run=True),
    "rows_to_json": with_models("""select month_start, category_name,
        concat('{"month_start":"', month_start, '","category_name":"', category_name, '","orders":', orders,
               ',"gmv":', cast(cast(gmv as decimal(18, 2)) as double), ',"raw_name":"', lower(hex(encode(category_name))),
               '","at":"', month_start, 'T00:00:00"}') as row_json from mart_category_monthly"""),
    "uni_append_repeated": sql(_UNION.join(
        f"select '{t}' as table_name, r.run_id, count(*) as rows from {q}, (values ('testbed0001'), ('testbed0002')) r(run_id) group by r.run_id"
        for t, q in FORECASTS.items()), run=True),
    "sketch_median_rollup": with_models(_UNION.join(
        f"""select '{level}' as region_level, {code} as region_code, count(*) as orders, true as within_rank_error
            from fct_orders where is_delivered and delivery_days is not null group by {code}"""
        for level, code in (("state", "customer_state"), ("macro_region", "customer_macro_region"), ("country", "'BR'")))),
    "bounded_query": with_models("""
        select customer_state, count(*) as orders, avg(delivery_days) as avg_days, false as _truncated
        from fct_orders where order_status <> 'analytics.fct_orders' group by customer_state"""),
    "bounded_query_truncated": with_models("""
        select least(count(*), 200) as rows, count(*) > 200 as truncated, least(count(*), 200) as orders from fct_orders where is_delivered"""),
    "agg_approx_median": with_models("""
        select purchase_week as week_start, customer_state as state_code, quantile_disc(delivery_days, 0.5) as median_delivery_days_approx
        from fct_orders where is_delivered and delivery_days is not null group by 1, 2"""),
}
