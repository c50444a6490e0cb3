"""Build the warehouse: materialise table models as parquet and register them as views.

Views (staging, intermediate) stay lazy; dimensions, facts and marts are written once, in
dependency order, and every later model reads the written files. Readers of the warehouse see the
build when all of it is there. Row counts and the row-level data tests are measured while writing. Each table is read back
right after its write, so downstream plans start from files instead of the whole chain, and a
lost executor only recomputes from the last written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from shipwright.functions import expr as X
from shipwright.plans import quality_suite as dq
from shipwright.plans.core import order_facts
from shipwright.plans.intermediate import PRODUCT_COLUMNS
from shipwright.sources import commits
from shipwright.sources.commits import Write
from shipwright.sources.sinks import view_name

TABLE_MODELS = (
    "dim_regions", "dim_dates", "dim_customers", "dim_sellers", "dim_products",
    "fct_orders", "fct_order_items",
    "mart_kpi_daily_region", "mart_unit_economics_monthly", "mart_demand_weekly_region",
    "mart_delivery_time_weekly_region", "mart_seller_performance", "mart_category_monthly",
)

# Tables that date-bound reads should not read whole: (date column, columns that rows are ordered by inside a month's files).
# Files go to folders by month; a date column that is a month already names the folders itself.
BY_MONTH: dict[str, tuple[str, list[str]]] = {
    "fct_orders": ("purchase_date", ["customer_state", "purchase_date"]),
    "mart_kpi_daily_region": ("date_day", ["state_code", "date_day"]),
    "mart_unit_economics_monthly": ("month_start", ["state_code"]),
}
MONTH_FOLDER = "in_month"


# Tables of one step read only tables of earlier steps, so they are written side by side.
STEPS = (
    ("dim_regions", "dim_dates", "dim_customers", "dim_sellers", "dim_products"),
    ("fct_orders",),
    ("fct_order_items", "mart_kpi_daily_region", "mart_unit_economics_monthly", "mart_demand_weekly_region",
     "mart_delivery_time_weekly_region"),
    ("mart_seller_performance", "mart_category_monthly"),
)


# Views that several data tests and later models read: written too when a whole suite runs over them.
VIEW_STEPS = (
    ("stg_orders", "stg_customers", "stg_sellers", "stg_products", "stg_order_items", "stg_order_payments", "stg_order_reviews",
     "stg_geolocation_zip"),
    ("int_order_items_agg", "int_order_payments_agg", "int_order_reviews_latest", "int_order_distance"),
)


# Tables that all read lines by order: with more than one of them to write, lines are laid out by order once, for all.
LINE_READERS = ("dim_sellers", "fct_orders", "fct_order_items")


# Models whose rows are laid out before the columns that follow from others are made: (model of the rows, what makes the rest).
MADE_IN_PLACE = {"fct_orders": ("order_base", order_facts)}


def by_month(df: DataFrame, date: str, order: list[str], finish=None) -> tuple[DataFrame, str]:
    """The frame laid out for month folders, and the folder column; ``finish`` makes further columns of rows in place.

    Rows meet by month; adaptive execution cuts a month that is too large for one task. Inside a file they are in order,
    so that row-group statistics let a filter on the leading columns skip most of it.
    """
    month = date if date == "month_start" else MONTH_FOLDER
    if month != date:
        df = df.withColumn(month, X.month_start(date))
    placed = df.hint("rebalance", month)
    if finish is not None:
        placed = finish(placed).withColumn(month, X.month_start(date))
    return placed.sortWithinPartitions(month, *order), month


def lay_out_lines(wh, root: str) -> None:
    """Writes numbered lines with their product's columns in buckets by order, and points the context at them.

    Their readers (roll-up and line fact, seller activity and mart, the staging view) find lines in place. There are as many buckets as
    shuffle partitions, so that orders meet them in the partitions they are in. The files are a working table of this build: no
    manifest names them, and the session's catalogue only learns of them to read the buckets.
    """
    spark, lines = wh.spark, wh["order_lines"]
    name = f"order_lines_{commits.new_commit()}"
    (lines.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "order_id").sortBy("order_id")
          .option("path", f"{root.rstrip('/')}/working/{name}").option("compression", "zstd").saveAsTable(name))
    placed = spark.table(name)
    spark.sql(f"drop table {name}")                 # of the name; the files stay
    wh.staged("order_lines", placed, placed.count())
    if wh.has_unique("dim_products", "product_id") and not wh.is_given("stg_order_items"):       # one row a line
        wh.raw["raw_order_items"] = placed.withColumnRenamed("shipping_limit_at", "shipping_limit_date").drop(*PRODUCT_COLUMNS)


def _write_steps(wh, root: str, schema: str, steps, layouts) -> dict[str, str]:
    """Writes the models step by step into folders nobody reads yet, then publishes all of them at once."""
    spark, commit = wh.spark, commits.new_commit()
    entries, months, columns = [], {}, {}
    for step in steps:
        writes = []
        for name in step:                               # plans are put together one at a time
            df = wh[name]
            columns[name] = df.columns
            measures = dq.row_measures(name)
            if name in layouts:
                finish = None
                if name in MADE_IN_PLACE and not wh.is_given(name):
                    rows, make = MADE_IN_PLACE[name]
                    df, finish = wh[rows], lambda placed, make=make: make(wh, placed)
                df, months[name] = by_month(df, *layouts[name], finish)
            writes.append(Write(schema, name, df, partition_by=(months[name],) if name in months else (), measures=measures))
        done = commits.write_all(root, commit, writes)
        for e in done:
            name = e["table_name"]
            wh.written(name, spark.read.parquet(f"{root.rstrip('/')}/{e['folder']}"), columns[name], months.get(name), e["measures"], e["rows"])
        entries += done
    commits.publish(spark, root, commit, entries)
    for name in columns:
        wh[name].createOrReplaceTempView(view_name(schema, name))
    return {e["table_name"]: f"{root.rstrip('/')}/{e['folder']}" for e in entries}


def build_warehouse(wh, root: str, tables=TABLE_MODELS, layouts=None) -> dict[str, str]:
    """Write every table model under ``{root}/analytics`` and point the context at the files."""
    steps = [[name for name in step if name in tables] for step in STEPS]
    if not wh.is_written("order_lines") and sum(t in tables and not wh.is_given(t) for t in LINE_READERS) > 1:
        lay_out_lines(wh, root)
    return _write_steps(wh, root, "analytics", steps, BY_MONTH if layouts is None else layouts)


def build_for_checks(wh, root: str) -> None:
    """Write every model that data tests read, views included, so that each is computed once for all its tests."""
    lay_out_lines(wh, root)
    _write_steps(wh, root, "staging", VIEW_STEPS, {})
    build_warehouse(wh, root)
