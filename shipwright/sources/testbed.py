"""Adapter from the driver's TPC-H-like parquet tables to the nine marketplace raw tables.

The engine's models expect the marketplace raw layer (orders, items, payments, reviews,
products, sellers, customers, geolocation, category translation) plus the state -> region
seed. The test tables are re-shaped into that layer with deterministic integer arithmetic
only, so any SQL engine given the same rules produces the same rows. Every raw table is
derived from a given table and grows with it.

All frames are lazy; Catalyst prunes the parquet columns each model does not use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Fixed mapping of TPC-H order priority to a marketplace payment type.
PAYMENT_TYPE_BY_PRIORITY = {
    "1-URGENT": "credit_card",
    "2-HIGH": "boleto",
    "3-MEDIUM": "voucher",
    "4-NOT SPECIFIED": "debit_card",
    "5-LOW": "not_defined",
}
# Part types with no English translation (their category falls back to the raw name).
UNTRANSLATED_TYPES = ("PROMO", "STANDARD")


_READS: dict = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table of the test directory; one reader per (application, path) so the file
    listing and footer reads happen once, however many raw tables use it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)   # a later session may reuse the id() of a stopped one
    if key not in _READS:
        _READS[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _READS[key]


def _zip(key) -> F.Column:
    return F.lpad((key % 100).cast("string"), 5, "0")


def _secs(n, ts) -> F.Column:
    return F.timestamp_add("SECOND", n, ts)


def regions_seed(spark, sf_dir) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
             .select(F.col("n_name").alias("state_code"),
                     F.lower("n_name").alias("state_name"),
                     F.col("r_name").alias("macro_region"),
                     F.concat(F.lit("capital of "), F.lower("n_name")).alias("capital_city")))


def customers(spark, sf_dir) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
             .select(F.col("c_custkey").cast("string").alias("customer_id"),
                     F.floor(F.col("c_custkey") / 2).cast("string").alias("customer_unique_id"),
                     _zip(F.col("c_custkey")).alias("customer_zip_code_prefix"),
                     F.col("c_mktsegment").alias("customer_city"),
                     F.lower("n_name").alias("customer_state")))


def sellers(spark, sf_dir) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    n = read(spark, sf_dir, "nation")
    return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
             .select(F.col("s_suppkey").cast("string").alias("seller_id"),
                     _zip(F.col("s_suppkey")).alias("seller_zip_code_prefix"),
                     F.concat(F.lit("City "), (F.col("s_suppkey") % 7).cast("string")).alias("seller_city"),
                     F.col("n_name").alias("seller_state")))


def geolocation(spark, sf_dir) -> DataFrame:
    """One point per customer and per supplier; keys = 7 (mod 20) have no point at all."""
    c = read(spark, sf_dir, "customer")
    s = read(spark, sf_dir, "supplier")
    n = read(spark, sf_dir, "nation")
    cust = (c.filter(F.col("c_custkey") % 20 != 7)
             .join(n, c.c_nationkey == n.n_nationkey, "left")
             .select(_zip(F.col("c_custkey")).alias("geolocation_zip_code_prefix"),
                     (F.lit(-40.0) + (F.col("c_custkey") * 7 % 500) / F.lit(10.0)).alias("geolocation_lat"),
                     (F.lit(-80.0) + (F.col("c_custkey") * 13 % 500) / F.lit(10.0)).alias("geolocation_lng"),
                     F.col("c_mktsegment").alias("geolocation_city"),
                     F.lower("n_name").alias("geolocation_state")))
    supp = (s.filter(F.col("s_suppkey") % 20 != 7)
             .join(n, s.s_nationkey == n.n_nationkey, "left")
             .select(_zip(F.col("s_suppkey")).alias("geolocation_zip_code_prefix"),
                     (F.lit(-40.0) + (F.col("s_suppkey") * 11 % 500) / F.lit(10.0)).alias("geolocation_lat"),
                     (F.lit(-80.0) + (F.col("s_suppkey") * 17 % 500) / F.lit(10.0)).alias("geolocation_lng"),
                     F.concat(F.lit("City "), (F.col("s_suppkey") % 7).cast("string")).alias("geolocation_city"),
                     F.col("n_name").alias("geolocation_state")))
    return cust.unionByName(supp)


def orders(spark, sf_dir) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    status = (F.when(F.col("o_orderstatus") == "F", "delivered")
               .when(F.col("o_orderstatus") == "O", "shipped")
               .when(k % 3 == 0, "canceled")
               .when(k % 3 == 1, "unavailable")
               .otherwise("processing"))
    purchased = _secs(k * 7919 % 86400, F.col("o_orderdate"))
    approved = F.when(k % 97 != 0, _secs(k % 7200, purchased))
    carrier = F.when(status.isin("delivered", "shipped"), F.timestamp_add("DAY", 1 + k % 5, approved))
    delivered = F.when((status == "delivered") & (k % 2003 != 0),
                       _secs(k % 3600, F.timestamp_add("DAY", 3 + k % 40, purchased)))
    estimated = F.date_add(F.to_date(purchased), (15 + k % 20).cast("int")).cast("timestamp_ntz")
    return o.select(k.cast("string").alias("order_id"),
                    F.col("o_custkey").cast("string").alias("customer_id"),
                    F.upper(status).alias("order_status"),
                    purchased.alias("order_purchase_timestamp"),
                    approved.alias("order_approved_at"),
                    carrier.alias("order_delivered_carrier_date"),
                    delivered.alias("order_delivered_customer_date"),
                    estimated.alias("order_estimated_delivery_date"))


def order_items(spark, sf_dir) -> DataFrame:
    """Line items; the item number is re-derived so (order_id, order_item_id) is unique.

    Lines meet by order_id itself, so roll-ups and joins by order find them in place; the other ids become texts afterwards.
    """
    li = read(spark, sf_dir, "lineitem").withColumn("order_id", F.col("l_orderkey").cast("string"))
    w = Window.partitionBy("order_id").orderBy("l_linenumber", "l_partkey", "l_suppkey",
                                               "l_extendedprice", "l_shipdate")
    freight = (F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(4,2)")).cast("double")
    numbered = li.withColumn("_number", F.row_number().over(w))
    return numbered.select("order_id",
                           F.col("_number").cast("long").alias("order_item_id"),
                           F.col("l_partkey").cast("string").alias("product_id"),
                           F.col("l_suppkey").cast("string").alias("seller_id"),
                           F.col("l_shipdate").alias("shipping_limit_date"),
                           F.col("l_extendedprice").alias("price"),
                           freight.alias("freight_value"))


def order_payments(spark, sf_dir) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    ptype = F.lit(None).cast("string")
    for prio, name in PAYMENT_TYPE_BY_PRIORITY.items():
        ptype = F.when(F.col("o_orderpriority") == prio, F.lit(name)).otherwise(ptype)
    first = o.select(k.cast("string").alias("order_id"), F.lit(1).cast("long").alias("payment_sequential"),
                     F.upper(ptype).alias("payment_type"), (1 + k % 10).cast("long").alias("payment_installments"),
                     F.col("o_totalprice").alias("payment_value"))
    voucher = (o.filter(k % 4 == 0)
                .select(k.cast("string").alias("order_id"), F.lit(2).cast("long").alias("payment_sequential"),
                        F.lit("voucher").alias("payment_type"), F.lit(1).cast("long").alias("payment_installments"),
                        F.lit(10.0).alias("payment_value")))
    return first.unionByName(voucher)


def order_reviews(spark, sf_dir) -> DataFrame:
    """Reviews from the event stream: many rows per (review, order) and tied answer times."""
    e = read(spark, sf_dir, "events")
    return e.select(F.concat(F.col("user_id").cast("string"), F.lit("-"), (F.col("event_id") % 3).cast("string"))
                     .alias("review_id"),
                    F.col("user_id").cast("string").alias("order_id"),
                    (1 + F.col("event_id") % 5).cast("long").alias("review_score"),
                    F.col("event_type").alias("review_comment_title"),
                    F.when(F.col("event_id") % 4 != 0, F.col("props")).alias("review_comment_message"),
                    F.col("ts").alias("review_creation_date"),
                    F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("review_answer_timestamp"))


def products(spark, sf_dir) -> DataFrame:
    p = read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    size = F.col("p_size")
    return p.select(k.cast("string").alias("product_id"),
                    F.when(k % 37 != 0, F.lower("p_type")).alias("product_category_name"),
                    F.length("p_name").cast("long").alias("product_name_lenght"),
                    (F.length("p_brand") * 10).cast("long").alias("product_description_lenght"),
                    (1 + k % 4).alias("product_photos_qty"),
                    F.when(k % 50 != 0, size * F.lit(100.0)).alias("product_weight_g"),
                    (F.lit(10.0) + size % 30).alias("product_length_cm"),
                    (F.lit(2.0) + size % 15).alias("product_height_cm"),
                    (F.lit(5.0) + size % 20).alias("product_width_cm"))


def category_translation(spark, sf_dir) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return (p.filter(~F.col("p_type").isin(*UNTRANSLATED_TYPES))
             .select(F.lower("p_type").alias("product_category_name"),
                     F.concat(F.lower("p_type"), F.lit("_goods")).alias("product_category_name_english"))
             .distinct())


RAW_BUILDERS = {
    "raw_customers": customers,
    "raw_geolocation": geolocation,
    "raw_order_items": order_items,
    "raw_order_payments": order_payments,
    "raw_order_reviews": order_reviews,
    "raw_orders": orders,
    "raw_products": products,
    "raw_sellers": sellers,
    "raw_category_translation": category_translation,
    "seed_state_regions": regions_seed,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The raw layer (plus the region seed) as lazy DataFrames over ``sf_dir``."""
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}


def lazy_raw_tables(spark: SparkSession, sf_dir: str) -> dict:
    """Raw layer as builders: a table is only constructed when a model reads it."""
    return {name: (lambda b=build: b(spark, sf_dir)) for name, build in RAW_BUILDERS.items()}
