"""Typed CSV ingestion of the raw layer.

Files are read with a declared schema (never inferred): header line present, timestamps as
``yyyy-MM-dd HH:mm:ss`` zone-less, empty fields as NULL, quoted fields may hold doubled quotes and (in
free-text tables) newlines, zip prefixes stay strings so leading zeros survive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shipwright.sources import commits
from shipwright.sources.first_lines import first_lines

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
BOM = "﻿"

# Declared raw schemas (column order is the header order).
RAW_SCHEMAS = {
    "raw_customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
                     "customer_city string, customer_state string",
    "raw_geolocation": "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
                       "geolocation_city string, geolocation_state string",
    "raw_order_items": "order_id string, order_item_id bigint, product_id string, seller_id string, "
                       "shipping_limit_date timestamp_ntz, price double, freight_value double",
    "raw_order_payments": "order_id string, payment_sequential bigint, payment_type string, "
                          "payment_installments bigint, payment_value double",
    "raw_order_reviews": "review_id string, order_id string, review_score bigint, review_comment_title string, "
                         "review_comment_message string, review_creation_date timestamp_ntz, "
                         "review_answer_timestamp timestamp_ntz",
    "raw_orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
                  "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
                  "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
    "raw_products": "product_id string, product_category_name string, product_name_lenght bigint, "
                    "product_description_lenght bigint, product_photos_qty bigint, product_weight_g double, "
                    "product_length_cm double, product_height_cm double, product_width_cm double",
    "raw_sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    "raw_category_translation": "product_category_name string, product_category_name_english string",
}


def schema_of(table: str) -> StructType:
    return StructType.fromDDL(RAW_SCHEMAS[table])


# Tables with free text, whose quoted fields may hold newlines; only their files must be read whole by one task.
FREE_TEXT = ("raw_order_reviews",)


def _options(reader_or_writer):
    return (reader_or_writer.option("header", True).option("quote", '"')
            .option("escape", '"').option("timestampNTZFormat", TIMESTAMP_FORMAT).option("nullValue", "")
            .option("emptyValue", None))


def read_csv_typed(spark: SparkSession, path: str, table: str, strict: bool = True) -> DataFrame:
    """Read a raw CSV with its declared schema. ``strict`` fails on malformed rows and, via
    ``enforceSchema=false``, on a header that does not name the declared columns."""
    r = _options(spark.read.schema(schema_of(table))).option("multiLine", table in FREE_TEXT)
    if strict:
        r = r.option("mode", "FAILFAST").option("enforceSchema", False)
    return r.csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    """Overwrite ``path`` with the frame as headed CSV (idempotent re-load)."""
    _options(df.write.mode("overwrite")).csv(path)
    return path


def header_report(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Compare the first line of every file with the declared columns (a leading BOM is tolerated).

    Files are read up to their first line end only. Output: table, file, header, ok; an empty file has no header and is not ok.
    """
    declared = F.create_map(*[F.lit(x) for table in paths for x in (table, ",".join(schema_of(table).names))])
    header = F.regexp_replace("line", f"^{BOM}", "")
    return first_lines(spark, paths).select("table", "file", header.alias("header"),
                                            F.coalesce(header == declared[F.col("table")], F.lit(False)).alias("ok"))


def row_count_report(loaded: dict[str, DataFrame], expected: dict[str, DataFrame | int]) -> DataFrame:
    """(table, rows, expected, ok) for every loaded table, counted in one pass over all of them.

    ``expected`` is a declared number of rows or the frame the table was loaded from.
    """
    one = F.lit(1).cast("long")
    none = F.lit(0).cast("long")
    parts = []
    for table, df in loaded.items():
        parts.append(df.select(F.lit(table).alias("table"), one.alias("rows"), none.alias("expected")))
        want = expected[table]
        parts.append(df.sparkSession.range(1).select(F.lit(table).alias("table"), none.alias("rows"), F.lit(want).cast("long").alias("expected"))
                     if isinstance(want, int) else want.select(F.lit(table).alias("table"), none.alias("rows"), one.alias("expected")))
    out = reduce(DataFrame.unionByName, parts).groupBy("table").agg(F.sum("rows").alias("rows"), F.sum("expected").alias("expected"))
    return out.withColumn("ok", F.col("rows") == F.col("expected"))


def load_raw_layer(spark: SparkSession, sources: dict[str, DataFrame], root: str, expected: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """Load each source as CSV into ``raw.{table}`` under ``root``, all in one commit, and read it back typed.

    Readers of the layer see the earlier load until every table of this one is written; a repeated load replaces it.
    The manifest keeps the rows written and the rows of the source (or the declared number of rows).
    """
    watched, writes = {}, []
    for table, df in sources.items():
        watched[table] = Observation()
        df = df.observe(watched[table], F.count(F.lit(1)).alias("rows")).select(*schema_of(table).names)
        writes.append(commits.Write("raw", table, df, writer=write_csv))
    commit = commits.new_commit()
    entries = commits.write_all(root, commit, writes)
    for e in entries:
        name = e["table_name"]
        e["measures"]["expected"] = (expected or {}).get(name, watched[name].get.get("rows", 0))
    commits.publish(spark, root, commit, entries)
    return {e["table_name"]: read_csv_typed(spark, f"{root.rstrip('/')}/{e['folder']}", e["table_name"]) for e in entries}


def load_report(spark: SparkSession, root: str) -> DataFrame:
    """(table, rows, expected, ok) of the last load, as recorded while it was written."""
    live = commits.live_entries(spark, root).filter("schema_name = 'raw'")
    return live.select(F.col("table_name").alias("table"), "rows", F.col("measures")["expected"].alias("expected")).withColumn(
        "ok", F.col("rows") == F.col("expected"))
