"""The declared data tests of the warehouse, and functions that run them.

Each declaration is (model, column, test, argument). A suite reads every model once, whatever the number of its
tests: a row gives one event (test, key, side) for each test it has a say in, and one grouped aggregate over the events of
all models decides uniqueness, combinations, anti-joins and counts together. Row-level tests (not_null, non_negative,
between) that were measured while the model was written need no event at all, nor do counts of two models whose rows were.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipwright.operators import quality as Q

# Accepted value lists of the reference model.
ORDER_STATUSES = ["delivered", "shipped", "canceled", "unavailable", "invoiced", "processing", "created", "approved"]
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
MACRO_REGIONS = ["Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul"]

# (model, column, test, argument)
DECLARED = [
    ("int_order_items_agg", "order_id", "unique", None), ("int_order_items_agg", "order_id", "not_null", None),
    ("int_order_items_agg", "gmv", "non_negative", None),
    ("int_order_payments_agg", "order_id", "unique", None), ("int_order_payments_agg", "order_id", "not_null", None),
    ("int_order_reviews_latest", "order_id", "unique", None),
    ("int_order_reviews_latest", "order_id", "not_null", None),
    ("int_order_distance", "order_id", "unique", None), ("int_order_distance", "order_id", "not_null", None),
    ("int_order_distance", "distance_km", "between", (0, 5000)),
    ("mart_kpi_daily_region", None, "unique_combination", ("date_day", "state_code")),
    ("mart_kpi_daily_region", "date_day", "not_null", None), ("mart_kpi_daily_region", "state_code", "not_null", None),
    ("mart_kpi_daily_region", "orders", "non_negative", None),
    ("mart_kpi_daily_region", "on_time_rate", "between", (0, 1)),
    ("mart_kpi_daily_region", "cost_per_delivery", "non_negative", None),
    ("mart_kpi_daily_region", "gmv", "non_negative", None),
    ("mart_unit_economics_monthly", None, "unique_combination", ("month_start", "state_code")),
    ("mart_unit_economics_monthly", "month_start", "not_null", None),
    ("mart_unit_economics_monthly", "state_code", "not_null", None),
    ("mart_unit_economics_monthly", "on_time_rate", "between", (0, 1)),
    ("mart_demand_weekly_region", None, "unique_combination", ("week_start", "state_code")),
    ("mart_demand_weekly_region", "week_start", "not_null", None),
    ("mart_demand_weekly_region", "state_code", "not_null", None),
    ("mart_demand_weekly_region", "orders", "not_null", None),
    ("mart_demand_weekly_region", "orders", "non_negative", None),
    ("mart_delivery_time_weekly_region", None, "unique_combination", ("week_start", "state_code")),
    ("mart_delivery_time_weekly_region", "week_start", "not_null", None),
    ("mart_delivery_time_weekly_region", "state_code", "not_null", None),
    ("mart_delivery_time_weekly_region", "avg_delivery_days", "not_null", None),
    ("mart_delivery_time_weekly_region", "avg_delivery_days", "non_negative", None),
    ("mart_delivery_time_weekly_region", "on_time_rate", "between", (0, 1)),
    ("mart_seller_performance", "seller_id", "unique", None), ("mart_seller_performance", "seller_id", "not_null", None),
    ("mart_category_monthly", None, "unique_combination", ("month_start", "category_name")),
    ("dim_regions", "state_code", "unique", None), ("dim_regions", "state_code", "not_null", None),
    ("dim_dates", "date_day", "unique", None), ("dim_dates", "date_day", "not_null", None),
    ("dim_dates", "iso_day_of_week", "between", (1, 7)),
    ("dim_customers", "customer_id", "unique", None), ("dim_customers", "customer_id", "not_null", None),
    ("dim_customers", "customer_unique_id", "not_null", None), ("dim_customers", "customer_state", "not_null", None),
    ("dim_customers", "customer_macro_region", "not_null", None),
    ("dim_sellers", "seller_id", "unique", None), ("dim_sellers", "seller_id", "not_null", None),
    ("dim_sellers", "lifetime_orders", "non_negative", None),
    ("dim_products", "product_id", "unique", None), ("dim_products", "product_id", "not_null", None),
    ("dim_products", "category_name", "not_null", None),
    ("fct_orders", None, "row_count_matches", "stg_orders"),
    ("fct_orders", "order_id", "unique", None), ("fct_orders", "order_id", "not_null", None),
    ("fct_orders", "customer_state", "not_null", None), ("fct_orders", "order_status", "not_null", None),
    ("fct_orders", "purchased_at", "not_null", None), ("fct_orders", "purchase_date", "not_null", None),
    ("fct_orders", "delivery_days", "between", (0, 250)), ("fct_orders", "n_items", "non_negative", None),
    ("fct_orders", "gmv", "not_null", None), ("fct_orders", "gmv", "non_negative", None),
    ("fct_orders", "freight_value", "not_null", None), ("fct_orders", "freight_value", "non_negative", None),
    ("fct_orders", "contribution_margin", "not_null", None),
    ("fct_order_items", None, "row_count_matches", "stg_order_items"),
    ("fct_order_items", "order_item_key", "unique", None), ("fct_order_items", "order_item_key", "not_null", None),
    ("fct_order_items", "order_id", "not_null", None),
    ("fct_order_items", "order_id", "relationships", ("fct_orders", "order_id")),
    ("fct_order_items", "product_id", "relationships", ("dim_products", "product_id")),
    ("fct_order_items", "seller_id", "relationships", ("dim_sellers", "seller_id")),
    ("fct_order_items", "price", "not_null", None), ("fct_order_items", "price", "non_negative", None),
    ("stg_orders", "order_id", "unique", None), ("stg_orders", "order_id", "not_null", None),
    ("stg_orders", "customer_id", "not_null", None),
    ("stg_orders", "order_status", "accepted_values", ORDER_STATUSES),
    ("stg_orders", "purchased_at", "not_null", None),
    ("stg_customers", "customer_id", "unique", None), ("stg_customers", "customer_id", "not_null", None),
    ("stg_customers", "customer_unique_id", "not_null", None), ("stg_customers", "customer_state", "not_null", None),
    ("stg_customers", "customer_state", "relationships", ("dim_regions", "state_code")),
    ("stg_sellers", "seller_id", "unique", None), ("stg_sellers", "seller_id", "not_null", None),
    ("stg_sellers", "seller_state", "relationships", ("dim_regions", "state_code")),
    ("stg_order_items", "order_item_key", "unique", None), ("stg_order_items", "order_item_key", "not_null", None),
    ("stg_order_items", "order_id", "not_null", None),
    ("stg_order_items", "order_id", "relationships", ("stg_orders", "order_id")),
    ("stg_order_items", "price", "not_null", None), ("stg_order_items", "price", "non_negative", None),
    ("stg_order_items", "freight_value", "not_null", None), ("stg_order_items", "freight_value", "non_negative", None),
    ("stg_order_payments", "payment_key", "unique", None), ("stg_order_payments", "payment_key", "not_null", None),
    ("stg_order_payments", "payment_type", "accepted_values", PAYMENT_TYPES),
    ("stg_order_payments", "payment_value", "non_negative", None),
    ("stg_order_reviews", "review_key", "unique", None), ("stg_order_reviews", "review_key", "not_null", None),
    ("stg_order_reviews", "review_score", "between", (1, 5)),
    ("stg_products", "product_id", "unique", None), ("stg_products", "product_id", "not_null", None),
    ("stg_products", "category_name", "not_null", None),
    ("stg_geolocation_zip", "zip_prefix", "unique", None), ("stg_geolocation_zip", "zip_prefix", "not_null", None),
    ("stg_geolocation_zip", "latitude", "between", (-34.0, 6.0)),
    ("dim_regions", "macro_region", "accepted_values", MACRO_REGIONS),
]

# The tests of the two forecast marts; their models come from a run and are set on the context.
FORECAST_DECLARED = [
    ("mart_forecast_vs_actual", "series", "accepted_values", ["demand_orders", "delivery_days"]),
    ("mart_forecast_vs_actual", "region_level", "accepted_values", ["state", "macro_region", "country"]),
    ("mart_forecast_vs_actual", "horizon_weeks", "between", (1, 52)), ("mart_forecast_vs_actual", "forecast", "not_null", None),
    ("mart_forecast_accuracy_latest", "wape", "not_null", None), ("mart_forecast_accuracy_latest", "wape", "non_negative", None),
]

# Checks that the data does violate, so that a check which never reports anything can't pass unseen.
PROBES = [
    ("raw_order_reviews", "review_id", "unique", None), ("raw_orders", "order_approved_at", "not_null", None),
    ("fct_orders", "order_status", "accepted_values", ["delivered", "shipped"]),
    ("raw_customers", "customer_zip_code_prefix", "relationships", ("raw_geolocation", "geolocation_zip_code_prefix")),
    ("fct_orders", "delivery_delay_days", "non_negative", None), ("fct_orders", "delivery_delay_days", "between", (-3, 3)),
    ("stg_order_reviews", None, "row_count_matches", "raw_order_reviews"),
    ("raw_order_items", None, "unique_combination", ("product_id", "seller_id")),
]

# Raw table whose rows bound the number of values that a key has in any model; other tested columns have few (states, days, zip prefixes).
KEY_OF = {"order_id": "raw_orders", "order_item_key": "raw_order_items", "payment_key": "raw_order_payments", "review_key": "raw_order_reviews",
          "customer_id": "raw_customers", "product_id": "raw_products", "seller_id": "raw_sellers"}
KEYS_A_TASK = 500_000

ROW_LEVEL = ("not_null", "non_negative", "between")


def test_id(model, column, test, arg) -> str:
    return f"{test}__{model}__{column or '_'.join(arg if isinstance(arg, tuple) else [str(arg)])}"


def _violation(column, test, arg):
    c = F.col(column)
    if test == "not_null":
        return c.isNull()
    if test == "non_negative":
        return c < 0
    if test == "between":
        return (c < arg[0]) | (c > arg[1])
    if test == "accepted_values":
        return c.isNotNull() & ~c.isin(*arg)
    raise ValueError(test)


def row_measures(model_name: str, declared=DECLARED) -> dict:
    """Conditions of a model's row-level tests by test id, to be counted while it is written."""
    return {test_id(*d): _violation(*d[1:]) for d in declared if d[0] == model_name and d[2] in ROW_LEVEL}


MODEL, OTHER = 0, 1       # side of an event: the tested model, or the one it is compared with


def _key(*columns):
    """Bytes of a key, one-to-one: every part with its length, NULL apart from ''; an md5 in hex is 16 bytes after a mark of its own."""
    text = [F.col(c).cast("string") for c in columns]
    whole = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")).cast("binary") for t in text]
    short = [F.when((F.length(t) == 32) & t.rlike("^[0-9a-f]{32}\\z"), F.concat(F.lit(b"x"), F.unhex(t))).otherwise(w) for t, w in zip(text, whole)]
    return F.concat(*short)


def _counted(wh, model_name, other) -> int | None:
    """Failures of a row count test by the rows of both models as they were written; None if one of them isn't read from files."""
    mine, theirs = wh.written_rows(model_name), wh.written_rows(other)
    return None if mine is None or theirs is None else int(mine != theirs)


def _once(wh, declared) -> set[tuple[str, str]]:
    """(model, column) of the unique tests that hold, as one job over 8-byte hashes of the columns of written models shows.

    Where no hash is there twice no value is. Where one is, its values decide, with the other tests; hashes of different values
    that agree by chance only cost that.
    """
    tests = [(i, m, c) for i, (m, c, test, _) in enumerate(declared) if test == "unique" and wh.is_written(m)]
    if not tests:
        return set()
    hashes = reduce(DataFrame.unionByName, [
        wh[m].filter(F.col(c).isNotNull()).select(F.lit(i).alias("i"), F.xxhash64(c).alias("h")) for i, m, c in tests])
    twice = hashes.groupBy("i", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("i").distinct().collect()
    return {(m, c) for i, m, c in tests} - {declared[r.i][:2] for r in twice}


def _seen(wh, once, model_name, column, test, arg) -> int | None:
    """Failures that are known from writing the models, or by ``once``."""
    if test == "unique":
        return 0 if (model_name, column) in once else None
    if test == "row_count_matches":
        return _counted(wh, model_name, arg)
    return wh.measured(model_name).get(test_id(model_name, column, test, arg)) if test in ROW_LEVEL else None


def _events(wh, declared, once=frozenset()) -> dict[str, list]:
    """By model, the (condition, test number, key, side) of the events that its rows give; tests whose failures are known have none."""
    out: dict[str, list] = {}
    always = F.lit(True)
    for i, (model_name, column, test, arg) in enumerate(declared):
        mine = out.setdefault(model_name, [])
        if _seen(wh, once, model_name, column, test, arg) is not None:
            continue
        if test in ROW_LEVEL:
            mine.append((_violation(column, test, arg), i, F.lit(b""), MODEL))
        elif test == "accepted_values":
            mine.append((_violation(column, test, arg), i, _key(column), MODEL))
        elif test == "unique":
            mine.append((F.col(column).isNotNull(), i, _key(column), MODEL))
        elif test == "unique_combination":
            mine.append((always, i, _key(*arg), MODEL))
        elif test == "relationships":
            mine.append((F.col(column).isNotNull(), i, _key(column), MODEL))
            out.setdefault(arg[0], []).append((F.col(arg[1]).isNotNull(), i, _key(arg[1]), OTHER))
        elif test == "row_count_matches":
            mine.append((always, i, F.lit(b""), MODEL))
            out.setdefault(arg, []).append((always, i, F.lit(b""), OTHER))
        else:
            raise ValueError(test)
    return out


def failures_by_test(wh, declared=DECLARED) -> DataFrame:
    """One row per declared test: (test_id, model, column_name, test, failures)."""
    parts, once = [], _once(wh, declared)
    for model_name, events in _events(wh, declared, once).items():
        if events:
            found = F.array(*[F.when(due, F.struct(F.lit(i).alias("i"), key.alias("key"), F.lit(side).alias("side"))) for due, i, key, side in events])
            parts.append(wh[model_name].select(F.explode(F.array_compact(found)).alias("e")).select("e.*"))
    kinds = [d[2] for d in declared]
    tests = wh.spark.createDataFrame(
        [(i, test_id(*d), d[0], d[1], d[2], _seen(wh, once, *d)) for i, d in enumerate(declared)],
        "i int, test_id string, model string, column_name string, test string, measured long")
    if not parts:
        return tests.select("test_id", "model", "column_name", "test", F.col("measured").alias("failures"))
    per_key = reduce(DataFrame.unionByName, parts).groupBy("i", "key").agg(
        F.count_if(F.col("side") == MODEL).alias("a"), F.count_if(F.col("side") == OTHER).alias("b"))

    def of(*names):
        return F.col("i").isin(*[i for i, k in enumerate(kinds) if k in names] or [-1])

    one, a, b = F.lit(1).cast("long"), F.col("a"), F.col("b")
    failures = (F.when(of(*ROW_LEVEL), a).when(of("accepted_values"), one)
                .when(of("unique", "unique_combination") & (a > 1), one)
                .when(of("relationships") & (b == 0), a)
                .when(of("row_count_matches") & (a != b), one).otherwise(0))
    summed = per_key.groupBy("i").agg(F.sum(failures).alias("n"))
    return tests.join(summed, "i", "left").select("test_id", "model", "column_name", "test",
                                                  F.coalesce("measured", "n", F.lit(0)).cast("long").alias("failures"))


def set_level_violations(wh, d) -> DataFrame:
    model_name, column, test, arg = d
    df = wh[model_name]
    if test == "unique":
        return Q.unique(df, column, _tasks(wh, column))
    if test == "relationships":
        return Q.relationships(df, column, wh[arg[0]], arg[1])
    if test == "unique_combination":
        return Q.unique_combination(df, list(arg))
    if test == "accepted_values":
        return Q.accepted_values(df, column, arg)
    if test == "row_count_matches":
        return Q.row_count_matches(df, wh[arg])
    raise ValueError(test)


def _of(test, declared):
    return [d for d in declared if d[2] == test]


def _as_text(col):
    return F.col(col).cast("string")


def _tasks(wh, column) -> int | None:
    """Tasks that the values of a key are dealt to, so that none counts many more than ``KEYS_A_TASK``."""
    if KEY_OF.get(column) not in wh.raw:
        return None
    return max(1, -(-wh.raw_rows(KEY_OF[column]) // KEYS_A_TASK))


def unique_violations(wh, declared=DECLARED) -> DataFrame:
    parts = [Q.unique(wh[m], c, _tasks(wh, c)).select(F.lit(m).alias("model"), F.lit(c).alias("column_name"),
                                       _as_text(c).alias("value"), "n_records")
             for m, c, _, _ in _of("unique", declared)]
    return reduce(DataFrame.unionByName, parts)


def not_null_violations(wh, declared=DECLARED) -> DataFrame:
    parts = [Q.not_null(wh[m], c).select(F.lit(m).alias("model"), F.lit(c).alias("column_name"),
                                         _as_text(wh[m].columns[0]).alias("record_key"))
             for m, c, _, _ in _of("not_null", declared)]
    return reduce(DataFrame.unionByName, parts)


def accepted_values_violations(wh, declared=DECLARED) -> DataFrame:
    parts = [Q.accepted_values(wh[m], c, a).select(F.lit(m).alias("model"), F.lit(c).alias("column_name"),
                                                   _as_text(c).alias("value"), "n_records")
             for m, c, _, a in _of("accepted_values", declared)]
    return reduce(DataFrame.unionByName, parts)


def relationship_violations(wh, declared=DECLARED) -> DataFrame:
    parts = [Q.relationships(wh[m], c, wh[a[0]], a[1])
             .groupBy(_as_text(c).alias("value")).agg(F.count(F.lit(1)).alias("n_records"))
             .select(F.lit(m).alias("model"), F.lit(c).alias("column_name"), "value", "n_records")
             for m, c, _, a in _of("relationships", declared)]
    return reduce(DataFrame.unionByName, parts)


def _valued(wh, test, declared):
    """Violating rows of a row-level test with their values. A model is run once for all its columns, not once for each."""
    columns: dict[str, list] = {}
    for m, c, _, a in _of(test, declared):
        columns.setdefault(m, []).append((c, a))
    parts = []
    for m, tested in columns.items():
        df = wh[m]
        found = F.array(*[F.when(_violation(c, test, a), F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")))
                          for c, a in tested])
        broken = reduce(lambda x, y: x | y, [_violation(c, test, a) for c, a in tested])
        rows = df.filter(broken).select(_as_text(df.columns[0]).alias("record_key"), F.explode(F.array_compact(found)).alias("_v"))
        parts.append(rows.select(F.lit(m).alias("model"), "_v.column_name", "record_key", "_v.value"))
    return reduce(DataFrame.unionByName, parts)


def non_negative_violations(wh, declared=DECLARED) -> DataFrame:
    return _valued(wh, "non_negative", declared)


def between_violations(wh, declared=DECLARED) -> DataFrame:
    return _valued(wh, "between", declared)


def row_count_violations(wh, declared=DECLARED) -> DataFrame:
    parts = [Q.row_count_matches(wh[m], wh[a]).select(F.lit(m).alias("model"), F.lit(a).alias("compare_model"),
                                                      "model_rows", "compare_rows")
             for m, _, _, a in _of("row_count_matches", declared)]
    return reduce(DataFrame.unionByName, parts)


def unique_combination_violations(wh, declared=DECLARED) -> DataFrame:
    parts = [Q.unique_combination(wh[m], list(a))
             .select(F.lit(m).alias("model"), F.lit(",".join(a)).alias("combination"),
                     F.concat_ws("|", *[_as_text(x) for x in a]).alias("key_values"), F.col("n").alias("n_records"))
             for m, _, _, a in _of("unique_combination", declared)]
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ singular tests (Q9-Q11)
def margin_components(wh, tolerance: float = 0.001) -> DataFrame:
    f = wh["fct_orders"]
    return f.filter(F.abs(F.col("contribution_margin") - (F.col("platform_revenue") - F.col("platform_cost")))
                    > tolerance).select("order_id")


def delivered_without_timestamp(wh, tolerated: int = 10) -> DataFrame:
    f = wh["fct_orders"].filter(F.col("is_delivered") & F.col("delivered_at").isNull())
    return f.agg(F.count(F.lit(1)).alias("missing")).filter(F.col("missing") > tolerated)


def kpi_reconcile(wh) -> DataFrame:
    """Daily mart orders vs non-canceled fact orders, in one pass over a tagged union."""
    mart = wh["mart_kpi_daily_region"].select(F.col("orders").alias("_m"), F.lit(0).cast("long").alias("_f"))
    fct = wh["fct_orders"].filter(~F.col("is_canceled")).select(F.lit(0).cast("long").alias("_m"),
                                                                F.lit(1).cast("long").alias("_f"))
    both = mart.unionByName(fct).agg(F.sum("_m").alias("mart_orders"), F.sum("_f").alias("fct_orders"))
    return both.filter(~F.col("mart_orders").eqNullSafe(F.col("fct_orders")))


def spoilt(wh):
    """A context whose fact and daily mart break the singular tests in known places."""
    fct = wh["fct_orders"]
    out = type(wh)(wh.spark, wh.raw, wh.params)
    out.override("mart_kpi_daily_region", wh["mart_kpi_daily_region"].filter("orders > 1"))
    out.override("fct_orders", fct.withColumns({
        "contribution_margin": F.col("contribution_margin") + F.when(F.col("n_items") == 2, 1.0).otherwise(0.0),
        "delivered_at": F.when(F.coalesce(F.col("n_items") != 3, F.lit(True)), F.col("delivered_at"))}))
    return out
