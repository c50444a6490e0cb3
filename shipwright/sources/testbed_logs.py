"""Assistant log tables derived from the driver's ``conversations`` table.

The test data has conversations but no SQL log, so one is derived with fixed rules: every
conversation row yields one statement (its form chosen by (conv_id*7 + turn) mod 16 from the
list below, filled with a table, a word and a number taken from the row), two tool calls
(describe, then run), a message (user turns of every third conversation carry a mention) and a
usage record; every conversation yields one final answer. All tables grow with the input.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shipwright.sources.testbed import read

# The allow-list of the log's warehouse, the tables statements draw from, and
# the statement forms ({t} table, {w} a word of the message, {n} the message length).
ALLOWED_TABLES = ("analytics.fct_orders", "analytics.mart_kpi_daily_region", "analytics.dim_regions",
                  "forecasts.forecast_runs")
STATEMENT_TABLES = ("fct_orders", "mart_kpi_daily_region", "dim_regions")
STATEMENT_FORMS = (
    "select {t}.* from analytics.{t} where {t}.region = '{w}'",
    "/* {w} */ SELECT\tcount(1) AS c\nFROM {t};  -- {n}",
    "with recent as (select * from {t} limit {n}), top as (select * from recent) select avg(x) from top",
    "select max(v) from `acme-{n}`.analytics.{t}",
    "update analytics.{t} set v = {n}",
    "select a from {t}; select b from {t}",
    "select l.* from {t} l join staging.{w}_{n} r on l.k = r.k",
    "select * from glob('/tmp/{w}/*')",
    "select v from '/tmp/{w}.parquet'",
    "with gone as (truncate table {t}) select * from gone",
    "select * from analytics.unknown_{w}",
    "select {n} + 1",
    " \n ",
    "select 'drop {w}; delete' as note, dropped_at from {t}",
    "select * from analytics.{t} as a left join forecasts.forecast_runs as b using (k)",
    "select * from {t} natural join \"forecasts\".\"forecast_runs\" -- {w}",
)
UNGROUNDED_SQL = "select sum(never_run) from analytics.dim_regions"


def form_parts(form: str) -> list[str]:
    """Split a form into literal text and placeholder names ({t}, {w}, {n})."""
    return [p for p in re.split(r"(\{[twn]\})", form) if p != ""]


def _statement(conv, turn, text) -> F.Column:
    t = F.element_at(F.array(*[F.lit(x) for x in STATEMENT_TABLES]),
                     (conv % len(STATEMENT_TABLES) + 1).cast("int"))
    w = F.lower(F.regexp_extract(text, "([A-Za-z]+)", 1))
    n = F.length(text).cast("string")
    vals = {"{t}": t, "{w}": w, "{n}": n}
    k = (conv * 7 + turn) % len(STATEMENT_FORMS)
    out = F.lit(None).cast("string")
    for i, form in enumerate(STATEMENT_FORMS):
        parts = [vals.get(p, F.lit(p)) for p in form_parts(form)] or [F.lit("")]
        out = F.when(k == i, F.concat(*parts)).otherwise(out)
    return out


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations")
    return c.select((F.col("conv_id") * 100 + F.col("turn")).alias("stmt_id"),
                    _statement(F.col("conv_id"), F.col("turn"), F.col("text")).alias("sql"))


def allowed_tables(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in ALLOWED_TABLES], "table_name string")


def tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations")
    x = c.select("conv_id", "turn", "text", F.explode(F.array(F.lit(0), F.lit(1))).alias("j"))
    ok = (F.col("j") == 0) | ((F.col("conv_id") + F.col("turn")) % 4 != 0)
    return x.select(F.col("conv_id").alias("turn"), (F.col("turn") * 2 + F.col("j")).alias("seq"),
                    F.when(F.col("j") == 0, F.lit("describe_table")).otherwise(F.lit("run_sql")).alias("tool"),
                    F.when(F.col("j") == 1, _statement(F.col("conv_id"), F.col("turn"), F.col("text"))).alias("sql"),
                    ok.alias("ok"),
                    F.when(ok, F.length("text") % 5).cast("long").alias("row_count"))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations")
    last = Window.partitionBy("conv_id").orderBy(F.col("turn").desc())
    lr = c.withColumn("_r", F.row_number().over(last)).filter("_r = 1")
    conv = F.col("conv_id")
    stmt = _statement(conv, F.col("turn"), F.col("text"))
    return lr.select(conv.alias("turn"),
                     F.when(conv % 6 == 0, F.lit("refused")).otherwise(F.lit("answered")).alias("status"),
                     F.when(conv % 5 == 1, F.lit(UNGROUNDED_SQL))
                      .otherwise(F.concat(F.lit("  "), F.upper(stmt), F.lit(" ;"))).alias("sql"),
                     F.when(conv % 12 == 0, F.lit("out of scope")).alias("refusal_reason"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations")
    mention = (F.col("role") == "user") & (F.col("conv_id") % 3 == 0)
    return c.select(F.col("conv_id").alias("session"), F.col("turn").alias("seq"), "role",
                    F.when(mention, F.concat(F.lit("<@U"), F.col("conv_id").cast("string"), F.lit("X> "), F.col("text")))
                     .otherwise(F.col("text")).alias("text"))


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("session"), F.col("turn").alias("seq"),
                    F.when(F.col("turn") % 5 != 0, F.length("text")).cast("long").alias("input_tokens"),
                    (F.length("text") % 97).cast("long").alias("output_tokens"))
