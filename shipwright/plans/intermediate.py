"""Intermediate models: order-level roll-ups that the fact table joins 1:1 on order_id."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shipwright.functions import expr as X
from shipwright.plans.staging import review_order
from shipwright.plans.warehouse import model


def _first_line(seq_col: str, value_col: str):
    """Value on the order's first line. A conditional aggregate instead of a self-join:
    same answer when (order, seq) is unique, no second scan and no fan-out when it is not."""
    return F.min(F.when(F.col(seq_col) == 1, F.col(value_col)))


PRODUCT_COLUMNS = ("category_name", "product_weight_g", "product_volume_cm3")


@model("order_lines")
def order_lines(wh):
    """Lines, without their key, with their product's columns; they stay where they lie (by order_id).

    A small product dimension comes to the lines. A large one meets pairs of ids only, and each order gets its basket's products
    as a map (bounded by the basket, like its sets). Where products are there twice, or lines have no order, whole lines meet products.
    """
    lines = wh["stg_order_items"].drop("order_item_key")
    # the dimension has the rows of stg_products; a build has written it by now
    products = wh.lookup("dim_products", "product_id", *PRODUCT_COLUMNS)
    if not wh.has_unique("dim_products", "product_id") or wh.is_small("dim_products") or wh.has_null("stg_order_items", "order_id"):
        return lines.join(products, "product_id", "left").select(*lines.columns, *PRODUCT_COLUMNS)
    pairs = wh["stg_order_items"].select("order_id", "product_id").join(products, "product_id")
    # pairs meet before they are put together: a map task has few lines of an order, and sets are wider than pairs
    baskets = pairs.repartition("order_id").groupBy("order_id").agg(
        F.map_from_entries(F.collect_set(F.struct("product_id", F.struct(*PRODUCT_COLUMNS)))).alias("_products"))
    placed = lines.join(baskets, "order_id", "left").withColumn("_product", F.try_element_at("_products", "product_id"))
    return placed.select(*lines.columns, *[F.col("_product")[c].alias(c) for c in PRODUCT_COLUMNS])


@model("int_order_items_agg")
def int_order_items_agg(wh):
    return (wh["order_lines"].groupBy("order_id")
                  .agg(F.count(F.lit(1)).alias("n_items"),
                       # sets bounded by the basket: one pass, where two distinct counts would expand every line
                       F.size(F.collect_set("product_id")).cast("long").alias("n_distinct_products"),
                       F.size(F.collect_set("seller_id")).cast("long").alias("n_sellers"),
                       X.exact_sum("price").alias("gmv"),
                       X.exact_sum("freight_value").alias("freight_value"),
                       F.sum(F.coalesce("product_weight_g", F.lit(0.0))).alias("total_weight_g"),
                       F.sum(F.coalesce("product_volume_cm3", F.lit(0.0))).alias("total_volume_cm3"),
                       F.max("shipping_limit_at").alias("shipping_limit_at"),
                       _first_line("order_item_id", "seller_id").alias("primary_seller_id"),
                       _first_line("order_item_id", "category_name").alias("primary_category_name")))


@model("int_order_payments_agg")
def int_order_payments_agg(wh):
    p = wh["stg_order_payments"]
    return (p.groupBy("order_id")
             .agg(X.exact_sum("payment_value").alias("payment_value"),
                  F.count(F.lit(1)).alias("n_payments"),
                  F.max("payment_installments").alias("max_installments"),
                  _first_line("payment_sequential", "payment_type").alias("primary_payment_type"),
                  X.exact_sum(X.bool_to_int(F.col("payment_type") == "voucher") * F.col("payment_value"))
                  .alias("voucher_value")))


@model("int_order_reviews_latest")
def int_order_reviews_latest(wh):
    r = wh["stg_order_reviews"]
    w = Window.partitionBy("order_id").orderBy(
        *review_order(F.col("review_answered_at").desc_nulls_last(), F.col("review_created_at").desc_nulls_last()),
        F.col("review_id").asc())
    # one row an order already; said in the plan (no further shuffle), so that readers without review columns skip the join
    return (r.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
             .select("order_id", "review_id", "review_score", "review_created_at", "review_answered_at",
                     F.col("review_comment_message").isNotNull().alias("has_comment"))
             .dropDuplicates(["order_id"]))


def geo_point(wh, prefix: str):
    g = wh["stg_geolocation_zip"]
    return g.select(F.col("zip_prefix").alias(f"{prefix}_zip"),
                    F.col("latitude").alias(f"{prefix}_lat"), F.col("longitude").alias(f"{prefix}_lng"))


def distance_or_null(clat, clng, slat, slng):
    return F.when(F.col(clat).isNull() | F.col(slat).isNull(), F.lit(None).cast("double")) \
            .otherwise(X.haversine_km(clat, clng, slat, slng))


@model("int_order_distance")
def int_order_distance(wh):
    o = wh["stg_orders"].select("order_id", "customer_id")
    c = wh["stg_customers"].select("customer_id", "customer_zip_prefix")
    ia = wh["int_order_items_agg"].select("order_id", "primary_seller_id")
    s = wh["stg_sellers"].select(F.col("seller_id").alias("primary_seller_id"), "seller_zip_prefix")
    base = o.join(c, "customer_id", "inner").join(ia, "order_id", "left")
    out = (base.join(geo_point(wh, "cg"), base.customer_zip_prefix == F.col("cg_zip"), "left")
               .join(s, "primary_seller_id", "left"))
    out = out.join(geo_point(wh, "sg"), out.seller_zip_prefix == F.col("sg_zip"), "left")
    return out.select("order_id",
                      F.col("cg_lat").alias("customer_lat"), F.col("cg_lng").alias("customer_lng"),
                      F.col("sg_lat").alias("seller_lat"), F.col("sg_lng").alias("seller_lng"),
                      distance_or_null("cg_lat", "cg_lng", "sg_lat", "sg_lng").alias("distance_km"))
