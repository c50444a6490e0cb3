"""Core star schema: dimensions and the two fact tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shipwright.functions import expr as X
from shipwright.operators.skew import SHARE, heavy_keys, spread_left_join
from shipwright.operators.timeseries import date_spine
from shipwright.plans.intermediate import PRODUCT_COLUMNS, distance_or_null, geo_point
from shipwright.plans.warehouse import model

CANCELED_STATUSES = ("canceled", "unavailable")


@model("dim_regions")
def dim_regions(wh):
    # a seed of a few dozen states; Spark broadcasts it by its estimated size
    return wh["seed_state_regions"].select("state_code", "state_name", "macro_region", "capital_city")


@model("dim_customers")
def dim_customers(wh):
    c = wh["stg_customers"]
    r = wh["dim_regions"].select(F.col("state_code").alias("customer_state"),
                                 F.col("state_name").alias("customer_state_name"),
                                 F.col("macro_region").alias("customer_macro_region"))
    g = geo_point(wh, "customer")
    return (c.join(r, "customer_state", "left")
             .join(g, c.customer_zip_prefix == g.customer_zip, "left")
             .select("customer_id", "customer_unique_id", "customer_zip_prefix", "customer_city", "customer_state",
                     "customer_state_name", "customer_macro_region", "customer_lat", "customer_lng"))


@model("seller_activity")
def seller_activity(wh):
    i = wh["stg_order_items"].select("order_id", "seller_id", "price")
    o = wh["stg_orders"].select("order_id", "purchased_at")
    return (i.join(o, "order_id", "inner")
             .groupBy("seller_id")
             .agg(F.count_distinct("order_id").alias("lifetime_orders"),
                  X.exact_sum("price").alias("lifetime_gmv"),
                  F.min(X.to_date("purchased_at")).alias("first_sale_date"),
                  F.max(X.to_date("purchased_at")).alias("last_sale_date")))


@model("dim_sellers")
def dim_sellers(wh):
    s = wh["stg_sellers"]
    r = wh["dim_regions"].select(F.col("state_code").alias("seller_state"),
                                 F.col("state_name").alias("seller_state_name"),
                                 F.col("macro_region").alias("seller_macro_region"))
    g = geo_point(wh, "seller")
    a = wh["seller_activity"]
    return (s.join(r, "seller_state", "left")
             .join(g, s.seller_zip_prefix == g.seller_zip, "left")
             .join(a, "seller_id", "left")
             .select("seller_id", "seller_zip_prefix", "seller_city", "seller_state", "seller_state_name",
                     "seller_macro_region", "seller_lat", "seller_lng",
                     F.coalesce("lifetime_orders", F.lit(0)).alias("lifetime_orders"),
                     F.coalesce("lifetime_gmv", F.lit(0.0)).alias("lifetime_gmv"),
                     "first_sale_date", "last_sale_date"))


@model("dim_products")
def dim_products(wh):
    return wh["stg_products"].select(
        "product_id", "category_name", "category_name_pt", "product_name_length", "product_description_length",
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
        "product_volume_cm3")


@model("dim_dates")
def dim_dates(wh):
    spine = date_spine(wh["stg_orders"], "purchase_date")
    d = F.col("date_day")
    return spine.select(
        d, F.year(d).cast("long").alias("year"), F.quarter(d).cast("long").alias("quarter"),
        F.month(d).cast("long").alias("month"), X.month_start(d).alias("month_start"),
        X.week_start(d).alias("week_start"), X.iso_day_of_week(d).cast("long").alias("iso_day_of_week"),
        (X.iso_day_of_week(d) >= 6).alias("is_weekend"))


FCT_ORDER_COLUMNS = [
    "order_id", "customer_id", "customer_unique_id", "customer_state", "customer_macro_region", "customer_city",
    "primary_seller_id", "seller_state", "seller_macro_region", "primary_category_name", "order_status",
    "purchased_at", "purchase_date", "purchase_week", "purchase_month", "approved_at", "delivered_to_carrier_at",
    "delivered_at", "delivered_date", "estimated_delivery_at", "estimated_delivery_date", "is_delivered",
    "is_canceled", "approval_hours", "handling_days", "transit_days", "delivery_days", "estimated_days",
    "delivery_delay_days", "carrier_handover_delay_days", "n_items", "n_sellers", "gmv", "freight_value",
    "total_weight_g", "payment_value", "primary_payment_type", "max_installments", "review_score", "distance_km",
    "is_on_time", "take_revenue", "freight_revenue", "delivery_cost", "payment_fee", "handling_cost",
    "platform_revenue", "platform_cost", "contribution_margin", "cost_per_delivery",
]


def heavy_sellers(wh):
    """Sellers with more than their share of all lines (their number is bounded).

    Counted on the lines, which needs neither their numbers nor the roll-up by order; a seller's orders are no more than its
    lines. The share is a quarter of that of orders, for baskets of several lines.
    """
    return heavy_keys(wh["stg_order_items"].select("seller_id"), "seller_id", share=4 * SHARE)


@model("order_base")
def order_base(wh):
    """One row per order with everything that its other columns follow from.

    Every input but the two dimensions is keyed by order_id, so after the customer lookup the
    four order-grain roll-ups join on one hash partitioning of order_id (no re-shuffle between
    them). Customer and seller coordinates come with their dimensions, so the distance is
    computed in place rather than by re-joining the distance model (same values: both use
    the zip-prefix centroids of the same customer and primary seller). Where each seller, customer and product is there
    once, as a rule, a reader without their columns (the weekly marts, line items, margins) runs none of those joins.
    """
    o = wh["stg_orders"].drop("delivered_date", "estimated_delivery_date")      # they follow from their times
    c = wh.lookup("dim_customers", "customer_id", "customer_unique_id", "customer_state", "customer_macro_region",
                  "customer_city", "customer_lat", "customer_lng")
    i = wh["int_order_items_agg"].select("order_id", "primary_seller_id", "primary_category_name", "n_items",
                                         "n_sellers", "gmv", "freight_value", "total_weight_g", "shipping_limit_at")
    pay = wh["int_order_payments_agg"].select("order_id", "payment_value", "primary_payment_type", "max_installments")
    r = wh["int_order_reviews_latest"].select("order_id", "review_score")
    s = wh["dim_sellers"].select(F.col("seller_id").alias("primary_seller_id"), "seller_state",
                                 "seller_macro_region", "seller_lat", "seller_lng")

    by_order = (o.join(c, "customer_id", "left")
                 .join(i, "order_id", "left")
                 .join(pay, "order_id", "left")
                 .join(r, "order_id", "left"))
    once = wh.has_unique("dim_sellers", "seller_id")
    if once and wh.is_small("dim_sellers"):
        base = by_order.join(F.broadcast(s.dropDuplicates(["primary_seller_id"])), "primary_seller_id", "left")
    else:
        # orders without items have no seller, and a few sellers may have a large part of all orders
        base = spread_left_join(by_order, s, "primary_seller_id", "order_id", heavy_sellers(wh), unique=once)

    distance = distance_or_null("customer_lat", "customer_lng", "seller_lat", "seller_lng")
    return base.withColumn("distance_km", distance).drop("customer_lat", "customer_lng", "seller_lat", "seller_lng")


def order_facts(wh, base):
    """The fact table's columns from rows of ``order_base``, row by row."""
    p = wh.params
    delivered = F.col("order_status") == "delivered"
    df = base.withColumns({
        "delivered_date": X.to_date("delivered_at"),
        "estimated_delivery_date": X.to_date("estimated_delivery_at"),
        "purchase_week": X.week_start("purchase_date"),
        "purchase_month": X.month_start("purchase_date"),
        "is_delivered": delivered,
        "is_canceled": F.col("order_status").isin(*CANCELED_STATUSES),
        "approval_hours": X.hours_between("purchased_at", "approved_at"),
        "handling_days": X.days_between("approved_at", "delivered_to_carrier_at"),
        "transit_days": X.days_between("delivered_to_carrier_at", "delivered_at"),
        "delivery_days": X.days_between("purchased_at", "delivered_at"),
        "estimated_days": X.days_between("purchased_at", "estimated_delivery_at"),
        "delivery_delay_days": X.days_between("estimated_delivery_at", "delivered_at"),
        "carrier_handover_delay_days": X.days_between("shipping_limit_at", "delivered_to_carrier_at"),
        "n_items": F.coalesce("n_items", F.lit(0)),
        "n_sellers": F.coalesce("n_sellers", F.lit(0)),
        "gmv": F.coalesce("gmv", F.lit(0.0)),
        "freight_value": F.coalesce("freight_value", F.lit(0.0)),
        "total_weight_g": F.coalesce("total_weight_g", F.lit(0.0)),
        "payment_value": F.coalesce("payment_value", F.lit(0.0)),
    })
    df = df.withColumns({
        "is_on_time": F.when(F.col("is_delivered") & F.col("delivered_at").isNotNull()
                             & F.col("estimated_delivery_at").isNotNull(),
                             F.col("delivered_date") <= F.col("estimated_delivery_date")),
        "take_revenue": F.col("gmv") * F.lit(p["marketplace_take_rate"]),
        "freight_revenue": F.col("freight_value"),
        "delivery_cost": F.col("freight_value") * F.lit(p["delivery_cost_ratio"]),
        "payment_fee": F.col("payment_value") * F.lit(p["payment_processing_rate"]),
        "handling_cost": F.lit(p["handling_cost_per_order"])
                         + F.greatest(F.col("n_items") - 1, F.lit(0)) * F.lit(p["handling_cost_per_extra_item"]),
    })
    df = df.withColumns({
        "platform_revenue": F.col("take_revenue") + F.col("freight_revenue"),
        "platform_cost": F.col("delivery_cost") + F.col("payment_fee") + F.col("handling_cost"),
    })
    df = df.withColumns({
        "contribution_margin": (F.col("take_revenue") + F.col("freight_revenue"))
                               - (F.col("delivery_cost") + F.col("payment_fee") + F.col("handling_cost")),
        "cost_per_delivery": F.when(F.col("is_delivered"), F.col("delivery_cost")),
    })
    return df.select(*FCT_ORDER_COLUMNS)


@model("fct_orders")
def fct_orders(wh):
    """One row per order: timing, service level and unit economics."""
    return order_facts(wh, wh["order_base"])


@model("fct_order_items")
def fct_order_items(wh):
    """One row per line with its order's, product's and seller's columns.

    Lines meet their order where they lie (by order_id), then the two dimensions; a small one comes to them. Lines laid out by a
    build have their product's columns. What follows from other columns (the key, the freight ratio, the dates of the purchase) is
    made after the last join, so it doesn't travel.
    """
    o = wh["fct_orders"].select("order_id", "customer_state", "customer_macro_region", "order_status", "purchased_at",
                                "is_delivered", "is_on_time", "delivery_days", "review_score")
    s = wh.lookup("dim_sellers", "seller_id", "seller_state", "seller_macro_region")
    if wh.is_written("order_lines"):
        lines = wh["order_lines"].join(o, "order_id", "left")
    else:
        p = wh.lookup("dim_products", "product_id", *PRODUCT_COLUMNS)
        lines = wh["stg_order_items"].drop("order_item_key").join(o, "order_id", "left").join(p, "product_id", "left")
    purchase_date = X.to_date("purchased_at")
    return (lines.join(s, "seller_id", "left")
             .select(X.surrogate_key("order_id", "order_item_id").alias("order_item_key"),
                     "order_id", "order_item_id", "product_id", "seller_id", "category_name",
                     "seller_state", "seller_macro_region", "customer_state", "customer_macro_region", "order_status",
                     "is_delivered", "is_on_time", "purchased_at", purchase_date.alias("purchase_date"),
                     X.week_start(purchase_date).alias("purchase_week"), X.month_start(purchase_date).alias("purchase_month"),
                     "shipping_limit_at", "price", "freight_value",
                     X.safe_divide("freight_value", "price").alias("freight_ratio"),
                     "product_weight_g", "product_volume_cm3", "delivery_days", "review_score"))
