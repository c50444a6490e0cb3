"""Warehouse catalogue (S9-S10): tables, columns, row counts and column documentation.

The listing itself is metadata (a few dozen tables); row counts are those recorded by the commits that wrote
the tables, or one pass over the registered views.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOG_PREFIXES = ("dim_", "fct_", "mart_", "forecast_")

# Descriptions of columns whose meaning the name doesn't give away: (table, column, description).
COLUMN_DOCS = (
    ("fct_orders", "contribution_margin", "platform revenue less platform cost"),
    ("fct_orders", "delivery_days", "days from purchase to delivery, delivered orders only"),
    ("fct_orders", "distance_km", "great-circle distance between customer and primary seller"),
    ("mart_kpi_daily_region", "on_time_rate", "delivered on or before the estimated date, share of delivered orders"),
    ("dim_dates", "iso_day_of_week", "1 Monday to 7 Sunday"),
    ("forecast_accuracy", "horizon_weeks", "weeks ahead; 0 pools all horizons"),
    ("forecast_accuracy", "wape", "sum of absolute errors over sum of absolute actuals"),
)


def catalog_views(spark: SparkSession, schemas=("analytics", "forecasts")) -> list[tuple[str, str]]:
    """(schema, table) of the registered ``schema__table`` views whose name has a catalogue prefix."""
    out = []
    for t in spark.catalog.listTables():
        if "__" not in t.name:
            continue
        schema, table = t.name.split("__", 1)
        if schema in schemas and table.startswith(CATALOG_PREFIXES):
            out.append((schema, table))
    return sorted(out)


def catalog_tables(spark: SparkSession, schemas=("analytics", "forecasts"), recorded: DataFrame | None = None) -> DataFrame:
    """One row per catalogued table: schema, name, column count, row count; a view that fails to
    resolve is listed with its error and no counts.

    ``recorded`` has row counts (table_schema, table_name, row_count) measured while tables were written; tables it hasn't
    are counted, all in one pass.
    """
    known = set() if recorded is None else {(r.table_schema, r.table_name) for r in recorded.select("table_schema", "table_name").collect()}
    listed, counted = [], []
    for schema, table in catalog_views(spark, schemas):
        try:
            df = spark.table(f"{schema}__{table}")
            listed.append((schema, table, len(df.columns), None))
        except Exception as e:  # noqa: BLE001 - whatever is wrong with it is reported
            listed.append((schema, table, None, str(e).splitlines()[0]))
            continue
        if (schema, table) not in known:
            counted.append(df.select(F.lit(schema).alias("table_schema"), F.lit(table).alias("table_name")))
    keys = ["table_schema", "table_name"]
    tables = spark.createDataFrame(listed, "table_schema string, table_name string, n_columns int, error string")
    counts = [] if recorded is None else [recorded.select(*keys, "row_count")]
    if counted:
        counts.append(reduce(DataFrame.unionByName, counted).groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")))
    if counts:
        tables = tables.join(reduce(DataFrame.unionByName, counts), keys, "left")
    else:
        tables = tables.withColumn("row_count", F.lit(None).cast("long"))
    # a resolved table without rows gives none to count
    return tables.select(*keys, "n_columns", F.coalesce("row_count", F.when(F.col("error").isNull(), F.lit(0))).cast("long").alias("row_count"), "error")


def catalog_columns(spark: SparkSession, docs: DataFrame | None = None, schemas=("analytics", "forecasts"),
                    max_columns: int | None = None) -> DataFrame:
    """Columns of every catalogued table with their description ('' when undocumented).

    With ``max_columns`` a table lists that many columns and one more row that counts the others.
    """
    rows = []
    for schema, table in catalog_views(spark, schemas):
        for i, f in enumerate(spark.table(f"{schema}__{table}").schema.fields):
            rows.append((schema, table, i, f.name, f.dataType.simpleString()))
    cols = spark.createDataFrame(rows, "table_schema string, table_name string, ordinal int, column_name string, "
                                       "data_type string")
    if docs is not None:
        cols = cols.join(docs.select("table_name", "column_name", "description"), ["table_name", "column_name"], "left")
    else:
        cols = cols.withColumn("description", F.lit(None).cast("string"))
    cols = cols.withColumn("description", F.coalesce("description", F.lit("")))
    if max_columns is None:
        return cols
    more = (cols.filter(F.col("ordinal") >= max_columns).groupBy("table_schema", "table_name")
                .agg(F.count(F.lit(1)).alias("_n"))
                .select("table_schema", "table_name", F.lit(max_columns).alias("ordinal"),
                        F.concat(F.lit("... "), F.col("_n").cast("string"), F.lit(" more columns")).alias("column_name"),
                        F.lit("").alias("data_type"), F.lit("").alias("description")))
    return cols.filter(F.col("ordinal") < max_columns).unionByName(more)
