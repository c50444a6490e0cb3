"""Dashboard reads (B1-B8) and KPI measures with filter context.

All reads run over the marts, which are small (date x state grain), but they are written as
ordinary aggregations so they stay distributed when the marts are large.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shipwright.functions import expr as X

DEFAULT_RANGE = ("2017-01-01", "2018-08-31")


def _d(s):
    return F.to_date(F.lit(s))


def _ratio(num, den):
    return X.safe_divide(num, den)


def _weighted(value="avg_delivery_days", weight="delivered_orders"):
    """Weighted mean re-aggregation sum(v*w)/sum(w), NULL on zero weight."""
    return _ratio(X.exact_sum(F.col(value) * F.col(weight)), F.sum(weight))


def headline(wh, start=DEFAULT_RANGE[0], end=DEFAULT_RANGE[1]):
    k = wh.between("mart_kpi_daily_region", "date_day", start, end)
    return k.agg(F.sum("orders").alias("orders"),
                 F.sum("delivered_orders").alias("delivered_orders"),
                 _ratio(F.sum("on_time_orders").cast("double"), F.sum("delivered_orders")).alias("on_time_rate"),
                 _ratio(X.exact_sum("contribution_margin"), F.sum("orders")).alias("margin_per_order"),
                 _ratio(X.exact_sum("delivery_cost"), F.sum("delivered_orders")).alias("cost_per_delivery"),
                 X.exact_sum("gmv").alias("gmv"),
                 X.exact_sum("delivery_cost").alias("delivery_cost"),
                 X.exact_sum("contribution_margin").alias("contribution_margin"))


def weekly_service(wh, start=DEFAULT_RANGE[0], end=DEFAULT_RANGE[1]):
    """Daily KPIs re-grained to weeks through the calendar dimension."""
    k = wh.between("mart_kpi_daily_region", "date_day", start, end)
    d = wh["dim_dates"].select("date_day", "week_start")
    return (k.join(d, "date_day", "inner")
             .groupBy("week_start", "macro_region")
             .agg(F.sum("delivered_orders").alias("delivered_orders"),
                  _ratio(F.sum("on_time_orders").cast("double"), F.sum("delivered_orders")).alias("on_time_rate"),
                  _weighted().alias("avg_delivery_days"))
             .orderBy(F.col("week_start").asc_nulls_last(), F.col("macro_region").asc_nulls_last()))


def monthly_unit_economics(wh, start=DEFAULT_RANGE[0], end=DEFAULT_RANGE[1]):
    u = wh.between("mart_unit_economics_monthly", "month_start", start, end)
    return (u.groupBy("month_start")
             .agg(F.sum("orders").alias("orders"),
                  _ratio(X.exact_sum("contribution_margin"), F.sum("orders")).alias("margin_per_order"),
                  _ratio(X.exact_sum("delivery_cost"), F.sum("delivered_orders")).alias("cost_per_delivery"),
                  _ratio(X.exact_sum("platform_revenue"), F.sum("orders")).alias("revenue_per_order"),
                  _ratio(X.exact_sum("platform_cost"), F.sum("orders")).alias("cost_per_order"),
                  _ratio(X.exact_sum("gmv"), F.sum("orders")).alias("avg_order_value"))
             .orderBy(F.col("month_start").asc_nulls_last()))


def state_scorecard(wh, start=DEFAULT_RANGE[0], end=DEFAULT_RANGE[1]):
    k = wh.between("mart_kpi_daily_region", "date_day", start, end)
    return (k.groupBy("state_code", "macro_region")
             .agg(F.sum("orders").alias("orders"),
                  _ratio(F.sum("on_time_orders").cast("double"), F.sum("delivered_orders")).alias("on_time_rate"),
                  _weighted().alias("avg_delivery_days"),
                  _ratio(X.exact_sum("contribution_margin"), F.sum("orders")).alias("margin_per_order"),
                  _ratio(X.exact_sum("delivery_cost"), F.sum("delivered_orders")).alias("cost_per_delivery"),
                  _ratio(X.exact_sum("gmv"), F.sum("orders")).alias("avg_order_value"))
             .orderBy(F.col("orders").desc_nulls_last()))


def cost_mix(wh):
    """Monthly cost mix: delivery, payment fees, handling."""
    u = wh["mart_unit_economics_monthly"]
    return (u.groupBy("month_start")
             .agg(X.exact_sum("delivery_cost").alias("delivery_cost"),
                  X.exact_sum("payment_fees").alias("payment_fees"),
                  X.exact_sum("handling_cost").alias("handling_cost"))
             .orderBy("month_start"))


# --------------------------------------------------------------------------- KPI measures
def kpi_measure_columns():
    """The measure set evaluated in whatever filter context the caller's grouping defines."""
    orders = F.sum("orders")
    delivered = F.sum("delivered_orders")
    gmv = X.exact_sum("gmv")
    margin = X.exact_sum("contribution_margin")
    return [
        orders.alias("orders"),
        delivered.alias("delivered_orders"),
        gmv.alias("gmv"),
        _ratio(F.sum("on_time_orders"), delivered).alias("on_time_rate"),
        _weighted().alias("avg_delivery_days"),
        margin.alias("contribution_margin"),
        _ratio(margin, orders).alias("margin_per_order"),
        _ratio(X.exact_sum("delivery_cost"), delivered).alias("cost_per_delivery"),
        _ratio(gmv, orders).alias("avg_order_value"),
        _ratio(X.exact_sum("freight_revenue"), gmv).alias("freight_to_gmv"),
        _ratio(margin, X.exact_sum("platform_revenue")).alias("contribution_margin_pct"),
    ]


def kpi_measures(wh, by=("macro_region",)):
    return wh["mart_kpi_daily_region"].groupBy(*by).agg(*kpi_measure_columns())


def kpi_prior_year(wh):
    """Monthly measures next to the same month one year earlier (same-period-last-year)."""
    k = wh["mart_kpi_daily_region"].withColumn("month_start", X.month_start("date_day"))
    cur = k.groupBy("month_start").agg(
        F.sum("orders").alias("orders"),
        _ratio(F.sum("on_time_orders"), F.sum("delivered_orders")).alias("on_time_rate"),
        _ratio(X.exact_sum("contribution_margin"), F.sum("orders")).alias("margin_per_order"))
    prev = cur.select(F.add_months("month_start", 12).alias("month_start"),
                      F.col("orders").alias("orders_py"), F.col("on_time_rate").alias("on_time_rate_py"),
                      F.col("margin_per_order").alias("margin_per_order_py"))
    return (cur.join(prev, "month_start", "left")
               .withColumn("margin_per_order_delta_py", F.col("margin_per_order") - F.col("margin_per_order_py")))


def kpi_previous_period(wh, start=DEFAULT_RANGE[0], end=DEFAULT_RANGE[1]):
    """Measures for [start, end] and for the equally long period just before it."""
    s, e = _d(start), _d(end)
    length = F.datediff(e, s) + 1
    k = wh["mart_kpi_daily_region"]
    period = (F.when(F.col("date_day").between(s, e), F.lit("current"))
               .when(F.col("date_day").between(F.date_sub(s, length), F.date_sub(s, 1)), F.lit("previous")))
    return (k.withColumn("period", period).filter(F.col("period").isNotNull())
             .groupBy("period").agg(*kpi_measure_columns()))
