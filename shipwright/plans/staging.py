"""Staging models: typed, renamed and lightly cleaned copies of the raw tables (views)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shipwright.functions import expr as X
from shipwright.plans.warehouse import model

# Bounding box of valid coordinates (fixed values).
LAT_RANGE = (-34.0, 6.0)
LNG_RANGE = (-74.0, -34.0)


@model("stg_orders")
def stg_orders(wh):
    o = wh["raw_orders"]
    return o.select(
        "order_id", "customer_id",
        F.lower("order_status").alias("order_status"),
        F.col("order_purchase_timestamp").alias("purchased_at"),
        F.col("order_approved_at").alias("approved_at"),
        F.col("order_delivered_carrier_date").alias("delivered_to_carrier_at"),
        F.col("order_delivered_customer_date").alias("delivered_at"),
        F.col("order_estimated_delivery_date").alias("estimated_delivery_at"),
        X.to_date("order_purchase_timestamp").alias("purchase_date"),
        X.to_date("order_delivered_customer_date").alias("delivered_date"),
        X.to_date("order_estimated_delivery_date").alias("estimated_delivery_date"),
    )


@model("stg_customers")
def stg_customers(wh):
    return wh["raw_customers"].select(
        "customer_id", "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("customer_zip_prefix"),
        F.lower("customer_city").alias("customer_city"),
        F.upper("customer_state").alias("customer_state"),
    )


@model("stg_sellers")
def stg_sellers(wh):
    return wh["raw_sellers"].select(
        "seller_id",
        F.col("seller_zip_code_prefix").alias("seller_zip_prefix"),
        F.lower("seller_city").alias("seller_city"),
        F.upper("seller_state").alias("seller_state"),
    )


@model("stg_products")
def stg_products(wh):
    p = wh["raw_products"].alias("p")
    t = wh["raw_category_translation"].alias("t")
    return (p.join(t, F.col("p.product_category_name") == F.col("t.product_category_name"), "left")
             .select(F.col("p.product_id").alias("product_id"),
                     F.col("p.product_category_name").alias("category_name_pt"),
                     F.coalesce(F.col("t.product_category_name_english"), F.col("p.product_category_name"),
                                F.lit("unknown")).alias("category_name"),
                     F.col("p.product_name_lenght").alias("product_name_length"),
                     F.col("p.product_description_lenght").alias("product_description_length"),
                     F.col("p.product_photos_qty").alias("product_photos_qty"),
                     "p.product_weight_g", "p.product_length_cm", "p.product_height_cm", "p.product_width_cm",
                     (F.col("p.product_length_cm") * F.col("p.product_height_cm") * F.col("p.product_width_cm"))
                     .alias("product_volume_cm3")))


@model("stg_order_items")
def stg_order_items(wh):
    return wh["raw_order_items"].select(
        X.surrogate_key("order_id", "order_item_id").alias("order_item_key"),
        "order_id", "order_item_id", "product_id", "seller_id",
        F.col("shipping_limit_date").alias("shipping_limit_at"),
        "price", "freight_value",
    )


@model("stg_order_payments")
def stg_order_payments(wh):
    return wh["raw_order_payments"].select(
        X.surrogate_key("order_id", "payment_sequential").alias("payment_key"),
        "order_id", "payment_sequential",
        F.lower("payment_type").alias("payment_type"),
        "payment_installments", "payment_value",
    )


def review_order(*leading):
    """Latest answer first, then latest creation; the remaining columns break ties so the pick is total."""
    return list(leading) + [F.col("review_score").desc(), F.col("review_comment_title").asc_nulls_last(),
                            F.col("review_comment_message").asc_nulls_last()]


@model("stg_order_reviews")
def stg_order_reviews(wh):
    r = wh["raw_order_reviews"]
    w = Window.partitionBy("review_id", "order_id").orderBy(
        *review_order(F.col("review_answer_timestamp").desc_nulls_last(),
                      F.col("review_creation_date").desc_nulls_last()))
    return (r.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
             .select(X.surrogate_key("review_id", "order_id").alias("review_key"),
                     "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
                     F.col("review_creation_date").alias("review_created_at"),
                     F.col("review_answer_timestamp").alias("review_answered_at")))


@model("stg_geolocation_zip")
def stg_geolocation_zip(wh):
    g = wh["raw_geolocation"]
    return (g.filter(F.col("geolocation_lat").between(*LAT_RANGE) & F.col("geolocation_lng").between(*LNG_RANGE))
             .groupBy(F.col("geolocation_zip_code_prefix").alias("zip_prefix"))
             .agg(F.avg("geolocation_lat").alias("latitude"),
                  F.avg("geolocation_lng").alias("longitude"),
                  F.min(F.lower("geolocation_city")).alias("city"),
                  F.min(F.upper("geolocation_state")).alias("state"),
                  F.count(F.lit(1)).alias("n_points")))
