"""Analytics marts: KPI, unit economics, demand, delivery, seller and category roll-ups.

Each mart is one hash aggregation over a fact table (partial aggregation map-side, one shuffle
on the group keys). Ratio KPIs are always re-derived from summed numerators and
denominators, never averaged.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipwright.functions import expr as X
from shipwright.operators.quantiles import exact_median, merge_sketches, sketch_quantile, sketch_table
from shipwright.operators.timeseries import COUNTRY_CODE
from shipwright.plans.core import CANCELED_STATUSES
from shipwright.plans.warehouse import model


def n_rows():
    return F.count(F.lit(1))


def on_time_rate(on_time="is_on_time", delivered="is_delivered"):
    return X.safe_divide(F.sum(X.bool_to_int(on_time)), F.sum(X.bool_to_int(delivered)))


def avg_when_delivered(col, delivered="is_delivered"):
    return F.avg(F.when(F.col(delivered), F.col(col)))


def cost_per_delivery():
    return X.safe_divide(X.exact_sum(F.when(F.col("is_delivered"), F.col("delivery_cost"))),
                         F.sum(X.bool_to_int("is_delivered")))


def counted_apart(df: DataFrame, keys: list[str], counted: str) -> DataFrame:
    """Every row twice: with its values but not ``counted``, marked by ``_row``, and with keys and ``counted`` alone.

    A distinct count beside other aggregates takes one row a key and counted value through the shuffle, with all buffers.
    Here those rows hold NULL values, and the values of a key meet in one row a task. Rows are to be counted by ``_row``.
    """
    part = F.col("_part")
    twice = df.withColumn("_part", F.explode(F.array(F.lit(0), F.lit(1))))
    values = [F.when(part == int(c == counted), F.col(c)).alias(c) for c in df.columns if c not in keys]
    return twice.select(*keys, *values, F.when(part == 0, F.lit(1)).alias("_row"))


@model("mart_kpi_daily_region")
def mart_kpi_daily_region(wh):
    o = counted_apart(wh["fct_orders"].filter(~F.col("is_canceled")), ["purchase_date", "customer_state", "customer_macro_region"],
                      "customer_unique_id")
    return (o.groupBy(F.col("purchase_date").alias("date_day"), F.col("customer_state").alias("state_code"),
                      F.col("customer_macro_region").alias("macro_region"))
             .agg(F.count("_row").alias("orders"),
                  F.sum(X.bool_to_int("is_delivered")).cast("long").alias("delivered_orders"),
                  F.sum(X.bool_to_int("is_canceled")).cast("long").alias("canceled_orders"),
                  F.sum("n_items").alias("items"),
                  F.count_distinct("customer_unique_id").alias("customers"),
                  F.sum(X.bool_to_int("is_on_time")).cast("long").alias("on_time_orders"),
                  F.sum(X.bool_to_int(F.col("is_on_time") == F.lit(False))).cast("long").alias("late_orders"),
                  on_time_rate().alias("on_time_rate"),
                  avg_when_delivered("delivery_days").alias("avg_delivery_days"),
                  avg_when_delivered("delivery_delay_days").alias("avg_delivery_delay_days"),
                  F.avg("estimated_days").alias("avg_estimated_days"),
                  F.avg("review_score").alias("avg_review_score"),
                  X.exact_sum("gmv").alias("gmv"),
                  X.exact_sum("freight_value").alias("freight_revenue"),
                  X.exact_sum("take_revenue").alias("take_revenue"),
                  X.exact_sum("platform_revenue").alias("platform_revenue"),
                  X.exact_sum("delivery_cost").alias("delivery_cost"),
                  X.exact_sum("payment_fee").alias("payment_fees"),
                  X.exact_sum("handling_cost").alias("handling_cost"),
                  X.exact_sum("platform_cost").alias("platform_cost"),
                  X.exact_sum("contribution_margin").alias("contribution_margin"),
                  X.safe_divide(X.exact_sum("contribution_margin"), F.count("_row")).alias("margin_per_order"),
                  X.safe_divide(X.exact_sum("gmv"), F.count("_row")).alias("avg_order_value"),
                  cost_per_delivery().alias("cost_per_delivery"),
                  X.safe_divide(X.exact_sum("freight_value"), X.exact_sum("gmv")).alias("freight_to_gmv_ratio")))


@model("mart_unit_economics_monthly")
def mart_unit_economics_monthly(wh):
    o = wh["fct_orders"].filter(~F.col("is_canceled"))
    return (o.groupBy(F.col("purchase_month").alias("month_start"), F.col("customer_state").alias("state_code"),
                      F.col("customer_macro_region").alias("macro_region"))
             .agg(n_rows().alias("orders"),
                  F.sum("n_items").alias("items"),
                  F.sum(X.bool_to_int("is_delivered")).cast("long").alias("delivered_orders"),
                  X.exact_sum("gmv").alias("gmv"),
                  X.exact_sum("take_revenue").alias("take_revenue"),
                  X.exact_sum("freight_revenue").alias("freight_revenue"),
                  X.exact_sum("platform_revenue").alias("platform_revenue"),
                  X.exact_sum("delivery_cost").alias("delivery_cost"),
                  X.exact_sum("payment_fee").alias("payment_fees"),
                  X.exact_sum("handling_cost").alias("handling_cost"),
                  X.exact_sum("platform_cost").alias("platform_cost"),
                  X.exact_sum("contribution_margin").alias("contribution_margin"),
                  X.safe_divide(X.exact_sum("gmv"), n_rows()).alias("avg_order_value"),
                  X.safe_divide(F.sum("n_items"), n_rows()).alias("items_per_order"),
                  X.safe_divide(X.exact_sum("platform_revenue"), n_rows()).alias("revenue_per_order"),
                  X.safe_divide(X.exact_sum("platform_cost"), n_rows()).alias("cost_per_order"),
                  X.safe_divide(X.exact_sum("contribution_margin"), n_rows()).alias("margin_per_order"),
                  X.safe_divide(X.exact_sum("contribution_margin"), X.exact_sum("platform_revenue"))
                  .alias("contribution_margin_pct"),
                  cost_per_delivery().alias("cost_per_delivery"),
                  X.safe_divide(X.exact_sum("freight_value"), X.exact_sum("gmv")).alias("freight_to_gmv_ratio"),
                  on_time_rate().alias("on_time_rate"),
                  avg_when_delivered("delivery_days").alias("avg_delivery_days")))


@model("mart_demand_weekly_region")
def mart_demand_weekly_region(wh):
    o = counted_apart(wh["fct_orders"], ["purchase_week", "customer_state", "customer_macro_region"], "customer_unique_id")
    return (o.groupBy(F.col("purchase_week").alias("week_start"), F.col("customer_state").alias("state_code"),
                      F.col("customer_macro_region").alias("macro_region"))
             .agg(F.count("_row").alias("orders"),
                  F.sum(X.bool_to_int("is_canceled")).cast("long").alias("canceled_orders"),
                  F.sum("n_items").alias("items"),
                  X.exact_sum("gmv").alias("gmv"),
                  X.exact_sum("freight_value").alias("freight_value"),
                  F.count_distinct("customer_unique_id").alias("customers")))


def delivered_with_days(wh):
    return wh["fct_orders"].filter(F.col("is_delivered") & F.col("delivery_days").isNotNull())


@model("mart_delivery_time_weekly_region")
def mart_delivery_time_weekly_region(wh):
    """Means in one aggregation; the medians are selected without holding a group and join by its key.

    A reader that doesn't use the median doesn't compute it: the join is dropped, as its key is unique.
    """
    # a struct is one key without NULL whatever its parts are, so the join is a plain equality on a unique key
    o = delivered_with_days(wh).withColumn("_key", F.struct("purchase_week", "customer_state", "customer_macro_region"))
    means = (o.groupBy("_key")
              .agg(n_rows().alias("delivered_orders"),
                   F.avg("delivery_days").alias("avg_delivery_days"),
                   F.avg("transit_days").alias("avg_transit_days"),
                   F.avg("handling_days").alias("avg_handling_days"),
                   F.avg("estimated_days").alias("avg_estimated_days"),
                   F.avg("delivery_delay_days").alias("avg_delivery_delay_days"),
                   F.avg("distance_km").alias("avg_distance_km"),
                   X.safe_divide(F.sum(X.bool_to_int("is_on_time")), n_rows()).alias("on_time_rate")))
    middle = exact_median(o, ["_key"], "delivery_days", "median_delivery_days")
    return means.join(middle, "_key", "left").select(
        F.col("_key.purchase_week").alias("week_start"), F.col("_key.customer_state").alias("state_code"),
        F.col("_key.customer_macro_region").alias("macro_region"), "delivered_orders", "avg_delivery_days", "median_delivery_days",
        "avg_transit_days", "avg_handling_days", "avg_estimated_days", "avg_delivery_delay_days", "avg_distance_km", "on_time_rate")


@model("delivery_time_sketches")
def delivery_time_sketches(wh):
    """A mergeable sketch of delivery days per week and state, to be kept beside the mart."""
    return sketch_table(delivered_with_days(wh), ["purchase_week", "customer_state", "customer_macro_region"], "delivery_days")


def delivery_time_rollup(sketches):
    """(region_level, region_code, orders, median_delivery_days) of states, macro-regions and the country from stored sketches."""
    levels = {"state": F.col("customer_state"), "macro_region": F.col("customer_macro_region"), "country": F.lit(COUNTRY_CODE)}
    parts = [merge_sketches(sketches.withColumns({"region_level": F.lit(level), "region_code": code}), ["region_level", "region_code"])
             for level, code in levels.items()]
    return reduce(DataFrame.unionByName, parts).select("region_level", "region_code", F.col("n").alias("orders"),
                                                       sketch_quantile().alias("median_delivery_days"))


@model("mart_seller_performance")
def mart_seller_performance(wh):
    """(seller, order) pairs meet their order on order_id, are summed by seller, and sellers join last:
    nothing is joined by seller before it is one row a seller. Lines that come from files meet by order first, once for both; lines
    laid out by order are read instead where the line fact, which left joins them, was written with as many rows: one for each."""
    columns = ["seller_id", "order_id", "price", "freight_value"]
    items = wh["fct_order_items"].select(*columns)
    rows = wh.written_rows("fct_order_items")
    if rows is not None and rows == wh.written_rows("order_lines"):
        items = wh["order_lines"].select(*columns)
    elif wh.is_written("fct_order_items"):
        items = items.repartition("order_id")
    per_seller_order = (items.groupBy("seller_id", "order_id")
                             .agg(X.exact_sum("price").alias("gmv"), X.exact_sum("freight_value").alias("freight_value"),
                                  n_rows().alias("items")))
    orders = wh["fct_orders"].select("order_id", "is_delivered", "is_on_time", "delivery_days", "handling_days",
                                     "review_score")
    s = wh["dim_sellers"].select("seller_id", "seller_state", "seller_macro_region", "seller_city",
                                 "first_sale_date", "last_sale_date")
    sold = (per_seller_order.join(orders, "order_id", "left").groupBy("seller_id")
             .agg(F.count("order_id").alias("orders"),
                  F.sum("items").alias("items"),
                  X.exact_sum("gmv").alias("gmv"),
                  X.exact_sum("freight_value").alias("freight_value"),
                  X.safe_divide(X.exact_sum("gmv"), F.count("order_id")).alias("avg_order_gmv"),
                  on_time_rate().alias("on_time_rate"),
                  avg_when_delivered("delivery_days").alias("avg_delivery_days"),
                  F.avg("handling_days").alias("avg_handling_days"),
                  F.avg("review_score").alias("avg_review_score")))
    return (s.join(sold, "seller_id", "left").withColumn("orders", F.coalesce("orders", F.lit(0).cast("long")))
             .select("seller_id", "seller_state", "seller_macro_region", "seller_city", "orders", "items", "gmv",
                     "freight_value", "avg_order_gmv", "on_time_rate", "avg_delivery_days", "avg_handling_days",
                     "avg_review_score", "first_sale_date", "last_sale_date"))


@model("mart_category_monthly")
def mart_category_monthly(wh):
    items = counted_apart(wh["fct_order_items"].filter(~F.col("order_status").isin(*CANCELED_STATUSES)),
                          ["purchase_month", "category_name"], "order_id")
    return (items.groupBy(F.col("purchase_month").alias("month_start"), "category_name")
                 .agg(F.count_distinct("order_id").alias("orders"),
                      F.count("_row").alias("items"),
                      X.exact_sum("price").alias("gmv"),
                      X.exact_sum("freight_value").alias("freight_value"),
                      X.safe_divide(X.exact_sum("price"), F.count("_row")).alias("avg_item_price"),
                      X.safe_divide(X.exact_sum("freight_value"), X.exact_sum("price")).alias("freight_to_gmv_ratio"),
                      on_time_rate().alias("on_time_rate"),
                      avg_when_delivered("delivery_days").alias("avg_delivery_days"),
                      F.avg("review_score").alias("avg_review_score")))
