"""Oracle SQL for the data-quality checks, generated from the declared test list."""

from oracle.models import with_models
from shipwright.plans.quality_suite import DECLARED, test_id

# first column of each model (the record key reported for row-level violations)
FIRST_COLUMN = {
    "int_order_items_agg": "order_id", "int_order_payments_agg": "order_id", "int_order_reviews_latest": "order_id",
    "int_order_distance": "order_id", "mart_kpi_daily_region": "date_day", "mart_unit_economics_monthly": "month_start",
    "mart_demand_weekly_region": "week_start", "mart_delivery_time_weekly_region": "week_start",
    "mart_seller_performance": "seller_id", "dim_regions": "state_code", "dim_dates": "date_day",
    "dim_customers": "customer_id", "dim_sellers": "seller_id", "dim_products": "product_id", "fct_orders": "order_id",
    "fct_order_items": "order_item_key", "stg_orders": "order_id", "stg_customers": "customer_id",
    "stg_sellers": "seller_id", "stg_order_items": "order_item_key", "stg_order_payments": "payment_key",
    "stg_order_reviews": "review_key", "stg_products": "product_id", "stg_geolocation_zip": "zip_prefix",
}


def _lit_list(values):
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def violation_sql(m, c, test, arg) -> str:
    """SELECT returning the violating rows/groups of one declared test."""
    if test == "unique":
        return f"select {c} from {m} where {c} is not null group by {c} having count(*) > 1"
    if test == "not_null":
        return f"select * from {m} where {c} is null"
    if test == "non_negative":
        return f"select * from {m} where {c} < 0"
    if test == "between":
        return f"select * from {m} where {c} < {arg[0]} or {c} > {arg[1]}"
    if test == "accepted_values":
        return f"select {c} from {m} where {c} is not null and {c} not in ({_lit_list(arg)}) group by {c}"
    if test == "relationships":
        return (f"select * from {m} ch where ch.{c} is not null and not exists "
                f"(select 1 from {arg[0]} pa where pa.{arg[1]} = ch.{c})")
    if test == "unique_combination":
        cols = ", ".join(arg)
        return f"select {cols} from {m} group by {cols} having count(*) > 1"
    if test == "row_count_matches":
        return (f"select 1 from (select count(*) as n from {m}) a, (select count(*) as n from {arg}) b "
                f"where a.n <> b.n")
    raise ValueError(test)


def _of(test):
    return [d for d in DECLARED if d[2] == test]


def _union(parts):
    return with_models("\nunion all\n".join(parts))


QUALITY_ORACLE = {
    "dq_suite": _union([
        f"select '{test_id(*d)}' as test_id, '{d[0]}' as model, "
        f"{repr(d[1]) if d[1] else 'cast(null as varchar)'} as column_name, '{d[2]}' as test, "
        f"cast(count(*) as bigint) as failures from ({violation_sql(*d)}) v"
        for d in DECLARED]),
    "dq_unique": _union([
        f"select '{m}' as model, '{c}' as column_name, cast({c} as varchar) as value, count(*) as n_records "
        f"from {m} where {c} is not null group by {c} having count(*) > 1" for m, c, _, _ in _of("unique")]),
    "dq_not_null": _union([
        f"select '{m}' as model, '{c}' as column_name, cast({FIRST_COLUMN[m]} as varchar) as record_key "
        f"from {m} where {c} is null" for m, c, _, _ in _of("not_null")]),
    "dq_accepted_values": _union([
        f"select '{m}' as model, '{c}' as column_name, cast({c} as varchar) as value, count(*) as n_records "
        f"from {m} where {c} is not null and {c} not in ({_lit_list(a)}) group by {c}"
        for m, c, _, a in _of("accepted_values")]),
    "dq_relationships": _union([
        f"select '{m}' as model, '{c}' as column_name, cast(ch.{c} as varchar) as value, count(*) as n_records "
        f"from {m} ch where ch.{c} is not null and not exists (select 1 from {a[0]} pa where pa.{a[1]} = ch.{c}) "
        f"group by ch.{c}" for m, c, _, a in _of("relationships")]),
    "dq_non_negative": _union([
        f"select '{m}' as model, '{c}' as column_name, cast({FIRST_COLUMN[m]} as varchar) as record_key, "
        f"cast({c} as double) as value from {m} where {c} < 0" for m, c, _, _ in _of("non_negative")]),
    "dq_between": _union([
        f"select '{m}' as model, '{c}' as column_name, cast({FIRST_COLUMN[m]} as varchar) as record_key, "
        f"cast({c} as double) as value from {m} where {c} < {a[0]} or {c} > {a[1]}"
        for m, c, _, a in _of("between")]),
    "dq_row_count_matches": _union([
        f"select '{m}' as model, '{a}' as compare_model, a.n as model_rows, b.n as compare_rows "
        f"from (select count(*) as n from {m}) a, (select count(*) as n from {a}) b where a.n <> b.n"
        for m, _, _, a in _of("row_count_matches")]),
    "dq_unique_combination": _union([
        f"select '{m}' as model, '{','.join(a)}' as combination, "
        f"concat_ws('|', {', '.join(f'cast({x} as varchar)' for x in a)}) as key_values, count(*) as n_records "
        f"from {m} group by {', '.join(a)} having count(*) > 1" for m, _, _, a in _of("unique_combination")]),
    "dq_margin_components": with_models(
        "select order_id from fct_orders where abs(contribution_margin - (platform_revenue - platform_cost)) > 0.001"),
    "dq_delivered_timestamp": with_models(
        "select count(*) as missing from fct_orders where is_delivered and delivered_at is null having count(*) > 10"),
    "dq_kpi_reconcile": with_models(
        "select m.n as mart_orders, f.n as fct_orders from (select cast(sum(orders) as bigint) as n "
        "from mart_kpi_daily_region) m, (select count(*) as n from fct_orders where not is_canceled) f "
        "where m.n <> f.n"),
}

QUALITY_ORACLE |= {
    "dq_probe_suite": _union([
        f"select '{i}' as test_id, '{m}' as model, {c} as column_name, '{t}' as test, cast(count(*) as bigint) as failures from ({v}) v"
        for i, m, c, t, v in [
            ("unique__raw_order_reviews__review_id", "raw_order_reviews", "'review_id'", "unique",
             "select review_id from raw_order_reviews group by 1 having count(*) > 1"),
            ("not_null__raw_orders__order_approved_at", "raw_orders", "'order_approved_at'", "not_null",
             "select 1 from raw_orders where order_approved_at is null"),
            ("accepted_values__fct_orders__order_status", "fct_orders", "'order_status'", "accepted_values",
             "select distinct order_status from fct_orders where order_status not in ('delivered', 'shipped')"),
            ("relationships__raw_customers__customer_zip_code_prefix", "raw_customers", "'customer_zip_code_prefix'", "relationships",
             "select 1 from raw_customers where customer_zip_code_prefix not in (select geolocation_zip_code_prefix from raw_geolocation)"),
            ("non_negative__fct_orders__delivery_delay_days", "fct_orders", "'delivery_delay_days'", "non_negative",
             "select 1 from fct_orders where delivery_delay_days < 0"),
            ("between__fct_orders__delivery_delay_days", "fct_orders", "'delivery_delay_days'", "between",
             "select 1 from fct_orders where abs(delivery_delay_days) > 3"),
            ("row_count_matches__stg_order_reviews__raw_order_reviews", "stg_order_reviews", "cast(null as varchar)", "row_count_matches",
             "select 1 where (select count(*) from stg_order_reviews) <> (select count(*) from raw_order_reviews)"),
            ("unique_combination__raw_order_items__product_id_seller_id", "raw_order_items", "cast(null as varchar)", "unique_combination",
             "select 1 from raw_order_items group by product_id, seller_id having count(*) > 1"),
        ]]),
    "dq_probe_unique": with_models("""select 'raw_order_reviews' as model, 'review_id' as column_name, cast(review_id as varchar) as value,
        count(*) as n_records from raw_order_reviews group by review_id having count(*) > 1"""),
    "dq_probe_not_null": with_models("""select 'raw_orders' as model, 'order_approved_at' as column_name, cast(order_id as varchar) as record_key
        from raw_orders where order_approved_at is null"""),
    "dq_probe_accepted_values": with_models("""select 'fct_orders' as model, 'order_status' as column_name, order_status as value,
        count(*) as n_records from fct_orders where order_status not in ('delivered', 'shipped') group by order_status"""),
    "dq_probe_relationships": with_models("""select 'raw_customers' as model, 'customer_zip_code_prefix' as column_name,
        customer_zip_code_prefix as value, count(*) as n_records from raw_customers c
        where not exists (select 1 from raw_geolocation g where g.geolocation_zip_code_prefix = c.customer_zip_code_prefix) group by 3"""),
    "dq_probe_non_negative": with_models("""select 'fct_orders' as model, 'delivery_delay_days' as column_name,
        cast(order_id as varchar) as record_key, cast(delivery_delay_days as double) as value from fct_orders where delivery_delay_days < 0"""),
    "dq_probe_between": with_models("""select 'fct_orders' as model, 'delivery_delay_days' as column_name,
        cast(order_id as varchar) as record_key, cast(delivery_delay_days as double) as value from fct_orders where abs(delivery_delay_days) > 3"""),
    "dq_probe_row_count_matches": with_models("""select 'stg_order_reviews' as model, 'raw_order_reviews' as compare_model, a.n as model_rows,
        b.n as compare_rows from (select count(*) as n from stg_order_reviews) a, (select count(*) as n from raw_order_reviews) b where a.n <> b.n"""),
    "dq_probe_unique_combination": with_models("""select 'raw_order_items' as model, 'product_id,seller_id' as combination,
        product_id || '|' || seller_id as key_values, count(*) as n_records from raw_order_items group by product_id, seller_id having count(*) > 1"""),
    "dq_probe_margin_components": with_models("""select order_id from fct_orders
        where abs(contribution_margin + case when n_items = 2 then 1 else 0 end - (platform_revenue - platform_cost)) > 0.001"""),
    "dq_probe_delivered_timestamp": with_models("""select count(*) as missing from fct_orders
        where is_delivered and (delivered_at is null or n_items = 3) having count(*) > 10"""),
    "dq_probe_kpi_reconcile": with_models("""select m.n as mart_orders, f.n as fct_orders
        from (select cast(sum(orders) as bigint) as n from mart_kpi_daily_region where orders > 1) m,
             (select count(*) as n from fct_orders where not is_canceled) f where m.n <> f.n"""),
}
