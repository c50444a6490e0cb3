"""Steps that decide how a query's time, shuffles and memory grow with the tables."""
import pytest
from pyspark.sql import functions as F

from shipwright.operators import forecast as FC
from shipwright.operators import skew
from shipwright.plans import core  # noqa: F401
from shipwright.plans import forecasting as FP
from shipwright.plans import quality_suite as dq
from shipwright.registry import warehouse
from tests.conftest import SF001


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("spec", [FC.DEMAND, FC.DELIVERY_TIME], ids=lambda s: s.name)
def test_weekly_panels_read_neither_line_items_nor_reviews(spark, spec):
    plan = optimized(FP.built_panel(warehouse(spark, SF001), spec))
    assert "o_orderkey" in plan and "c_custkey" in plan
    assert "l_orderkey" not in plan and "event_id" not in plan


def test_sellers_that_are_there_twice_still_double_their_orders(spark):
    wh = warehouse(spark, SF001)
    wh.raw["raw_sellers"] = wh["raw_sellers"].union(wh["raw_sellers"].filter("seller_id = '3'"))
    of_seller = wh["int_order_items_agg"].filter("primary_seller_id = '3'").count()
    assert of_seller > 0 and not skew.has_unique_keys(wh["dim_sellers"], "seller_id")
    assert wh["fct_orders"].count() == wh["stg_orders"].count() + of_seller
    assert wh["mart_demand_weekly_region"].agg(F.sum("orders")).first()[0] == wh["fct_orders"].count()


def test_unique_keys_leave_nulls_aside(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), (None,)], "k string")
    assert skew.has_unique_keys(df, "k") and not skew.has_unique_keys(df.union(df.filter("k = 'a'")), "k")
    assert skew.has_unique_keys(df.limit(0), "k")


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_lines_are_shuffled_once_to_be_numbered_and_summed_by_order(spark):
    items = warehouse(spark, SF001)["stg_order_items"]
    per_order = items.groupBy("order_id").agg(F.max("order_item_id"), F.sum("price"))
    assert shuffles(per_order) == shuffles(items) == 1
    # the texts of the other ids are made after the lines have met
    before = per_order.groupBy("order_id").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(l_partkey" not in before


def test_lines_with_their_order_are_read_once_and_make_their_key_last(spark):
    """The orders' own item roll-up and seller join are left out: line items are read once."""
    plan = optimized(warehouse(spark, SF001)["fct_order_items"])
    assert plan.count("Relation [l_orderkey") == 1
    key_at, joins_at = plan.index("md5("), plan.index("Join")
    assert key_at < joins_at and plan.count("md5(") == 1


def test_a_model_is_read_once_for_all_columns_of_a_row_test(spark):
    rows = spark.createDataFrame([("a", -1.0, 2.0), ("b", -3.0, -4.0), ("c", 1.0, 1.0), ("d", None, -5.0)], "k string, x double, y double")
    wh = warehouse(spark, SF001)
    wh.override("m", rows)
    found = dq.non_negative_violations(wh, [("m", "x", "non_negative", None), ("m", "y", "non_negative", None)])
    assert sorted(tuple(r) for r in found.collect()) == [("m", "x", "a", -1.0), ("m", "x", "b", -3.0), ("m", "y", "b", -4.0), ("m", "y", "d", -5.0)]
    found = dq.between_violations(wh, [("m", "x", "between", (-2, 0)), ("m", "y", "between", (-4, 1))])
    assert sorted(tuple(r) for r in found.collect()) == [("m", "x", "b", -3.0), ("m", "x", "c", 1.0), ("m", "y", "a", 2.0), ("m", "y", "d", -5.0)]
    # stg_order_items (two columns) and fct_order_items, and for orders' items: roll-up, facts and the daily mart
    plan = optimized(dq.non_negative_violations(warehouse(spark, SF001)))
    assert plan.count("Relation [l_orderkey") < 10


def test_margins_join_neither_products_nor_customers_nor_sellers(spark):
    wh = warehouse(spark, SF001)
    for plan in (optimized(dq.margin_components(wh)), optimized(dq.margin_components(dq.spoilt(wh)))):
        assert "l_orderkey" in plan and "o_orderkey" in plan
        assert "p_partkey" not in plan and "c_custkey" not in plan and "s_suppkey" not in plan


def test_products_and_customers_that_are_there_twice_still_double_their_rows(spark):
    wh = warehouse(spark, SF001)
    before = {r.order_id: (r.gmv, r.n_items) for r in wh["int_order_items_agg"].collect()}
    sold = wh["stg_order_items"].groupBy("product_id").count().orderBy(F.desc("count"), "product_id").first()
    again = warehouse(spark, SF001)
    again.raw["raw_products"] = again["raw_products"].union(again["raw_products"].filter(F.col("product_id") == sold.product_id))
    again.raw["raw_customers"] = again["raw_customers"].union(again["raw_customers"].filter("customer_id = '3'"))
    after = {r.order_id: (r.gmv, r.n_items) for r in again["int_order_items_agg"].collect()}
    assert sum(n for _, n in after.values()) == sum(n for _, n in before.values()) + sold["count"]
    orders_of_3 = wh["stg_orders"].filter("customer_id = '3'").count()
    assert again["fct_orders"].count() == wh["stg_orders"].count() + orders_of_3
    assert again["fct_order_items"].filter(F.col("product_id") == sold.product_id).count() >= 2 * sold["count"]


def test_rows_are_laid_out_before_the_other_columns_are_made(spark, tmp_path):
    from shipwright.plans import build
    wh = warehouse(spark, SF001)
    rows, finish = wh["order_base"], lambda placed: build.order_facts(wh, placed)
    laid, month = build.by_month(rows, *build.BY_MONTH["fct_orders"], finish)
    fields = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    lines = laid._jdf.queryExecution().optimizedPlan().toString().split("\n")
    spark.conf.set("spark.sql.debug.maxToStringFields", fields)
    spread = next(i for i, line in enumerate(lines) if "RebalancePartitions" in line)
    made = [i for i, line in enumerate(lines) if "AS contribution_margin" in line]
    assert made and max(made) < spread
    build.build_warehouse(wh, str(tmp_path), ("fct_orders",))
    plain = warehouse(spark, SF001)["fct_orders"]
    assert wh["fct_orders"].columns == plain.columns
    assert sorted(map(str, wh["fct_orders"].collect())) == sorted(map(str, plain.collect()))


def test_a_given_fact_table_is_written_as_given(spark, tmp_path):
    from shipwright.plans.build import build_warehouse
    wh = warehouse(spark, SF001)
    wh.override("fct_orders", wh["fct_orders"].filter("order_status = 'delivered'"))
    few = wh["fct_orders"].count()
    build_warehouse(wh, str(tmp_path), ("fct_orders",))
    assert 0 < few == wh["fct_orders"].count() < wh["stg_orders"].count()


def test_a_distinct_count_takes_no_other_values_along(spark):
    from shipwright.plans import marts
    rows = spark.createDataFrame([(1, "a", 2.0), (1, "a", 3.0), (1, "b", None), (1, None, 1.0), (2, None, 5.0), (None, "a", 1.0)],
                                 "k int, id string, x double")
    apart = marts.counted_apart(rows, ["k"], "id")
    assert apart.filter("id is not null and (x is not null or _row is not null)").isEmpty()
    got = apart.groupBy("k").agg(F.count("_row"), F.count_distinct("id"), F.sum("x"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, 4, 2, 6.0), (2, 1, 0, 5.0), (None, 1, 1, 1.0)], key=str)


def test_sellers_of_written_lines_meet_orders_in_one_shuffle_of_lines(spark, tmp_path):
    from shipwright.plans.build import build_warehouse
    wh = warehouse(spark, SF001)
    plain = wh["mart_seller_performance"]
    built = warehouse(spark, SF001)
    build_warehouse(built, str(tmp_path), ("dim_sellers", "fct_orders", "fct_order_items"))
    mart = built["mart_seller_performance"]
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange hashpartitioning(seller_id" in line and "order_id" in line for line in plan.split("\n"))
    assert sorted(mart.select("seller_id", "orders", "items", "gmv").collect()) == sorted(plain.select("seller_id", "orders", "items", "gmv").collect())


def test_keys_of_events_are_one_to_one(spark):
    texts = [None, "", "-", "0" * 32, "0" * 31, "A" * 32, "a" * 32, "a" * 32 + "\n", "32:" + "a" * 32, "x" + "a" * 16, "0:", "g" * 32]
    pairs = [(i, a, b) for i, (a, b) in enumerate((a, b) for a in texts for b in texts)]
    df = spark.createDataFrame(pairs, "i int, a string, b string")
    got = df.select(dq._key("a", "b").alias("k"), dq._key("a").alias("one"))
    assert got.select("k").distinct().count() == len(pairs) and got.select("one").distinct().count() == len(texts)
    assert spark.createDataFrame([("ab" * 16,)], "a string").select(F.length(dq._key("a"))).first()[0] == 17


def test_a_small_seller_dimension_comes_to_lines_and_orders(spark, monkeypatch):
    monkeypatch.setattr(skew, "SENT_ROWS", 15)                                  # there are 10 sellers
    wh = warehouse(spark, SF001)
    assert wh.is_small("dim_sellers") and not wh.is_small("dim_products")
    for name in ("fct_order_items", "order_base"):
        joins = [line for line in optimized(wh[name]).split("\n") if "Join LeftOuter" in line and "seller_id" in line]
        assert joins and all("rightHint=(strategy=broadcast)" in line for line in joins)
    assert "_slot" not in optimized(wh["order_base"])


def test_large_and_small_dimensions_give_the_same_rows(spark, monkeypatch):
    names = ("fct_orders", "fct_order_items", "int_order_items_agg")
    plain = warehouse(spark, SF001)
    want = {n: sorted(map(str, plain[n].collect())) for n in names}
    monkeypatch.setattr(skew, "SENT_ROWS", 0)
    spread = warehouse(spark, SF001)
    assert not spread.is_small("dim_sellers")
    assert {n: sorted(map(str, spread[n].collect())) for n in names} == want


def with_lines(spark, change):
    wh = warehouse(spark, SF001)
    wh.raw["raw_order_items"] = change(wh["raw_order_items"])
    return wh


def test_large_product_dimensions_meet_pairs_of_ids_only(spark, monkeypatch):
    """Whole lines are shuffled once, by order; a map of its basket's products comes to each order."""
    wh = warehouse(spark, SF001)
    want = sorted(map(str, wh["order_lines"].collect()))
    monkeypatch.setattr(skew, "SENT_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wh = warehouse(spark, SF001)
        plan = wh["int_order_items_agg"]._jdf.queryExecution().optimizedPlan().toString()
        by_product = wh["int_order_items_agg"]._jdf.queryExecution().executedPlan().toString().split("\n")
        below = [by_product[i + 1:i + 3] for i, line in enumerate(by_product) if "Exchange hashpartitioning(product_id" in line]
        assert "map_from_entries" in plan and not any("price" in line for part in below for line in part)
        assert sorted(map(str, wh["order_lines"].collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("change", [
    lambda df: df.withColumn("order_id", F.when(F.col("order_item_id") != 2, F.col("order_id"))),        # lines without an order
    lambda df: df.withColumn("product_id", F.when(F.col("order_item_id") != 2, F.col("product_id"))),    # without a product
    lambda df: df.withColumn("product_id", F.concat("product_id", F.lit("0000"))),                      # of unknown products
    lambda df: df.withColumn("product_id", F.lit("3")),                                                 # the same product again and again
    lambda df: df.withColumn("order_item_id", F.lit(1).cast("long")),                                   # one number for all lines
    lambda df: df.limit(0)], ids=["no-order", "no-product", "unknown", "same", "numbers", "empty"])
def test_odd_lines_have_the_products_a_plain_join_gives(spark, monkeypatch, change):
    monkeypatch.setattr(skew, "SENT_ROWS", 0)
    wh = with_lines(spark, change)
    want = wh["stg_order_items"].drop("order_item_key").join(
        wh["dim_products"].select("product_id", "category_name", "product_weight_g", "product_volume_cm3"), "product_id", "left")
    lines = wh["order_lines"]
    assert sorted(map(str, lines.collect())) == sorted(map(str, want.select(*lines.columns).collect()))


def test_dates_that_follow_from_times_do_not_travel_with_orders(spark):
    assert not {"delivered_date", "estimated_delivery_date"} & set(warehouse(spark, SF001)["order_base"].columns)


LINE_TABLES = ("dim_sellers", "fct_orders", "fct_order_items")


@pytest.mark.parametrize("change", [{}, {"raw_orders": "order_id in ('3', '5')"}, {"raw_products": "product_id in ('3', '170')"}],
                         ids=["plain", "orders-twice", "products-twice"])
def test_a_build_lays_lines_out_by_order_once_for_all_readers(spark, tmp_path, change):
    from shipwright.plans import build

    def context():
        wh = warehouse(spark, SF001)
        for name, rows in change.items():
            wh.raw[name] = wh[name].union(wh[name].filter(rows))
        return wh

    plain, built = context(), context()
    tables_before = [t.name for t in spark.catalog.listTables() if not t.isTemporary]
    build.build_warehouse(built, str(tmp_path), LINE_TABLES)
    assert [t.name for t in spark.catalog.listTables() if not t.isTemporary] == tables_before
    assert shuffles(built["order_lines"].groupBy("order_id").count()) == 0
    for name in (*LINE_TABLES, "int_order_items_agg", "stg_order_items", "mart_seller_performance"):
        assert built[name].columns == plain[name].columns
        exact = [c for c in plain[name].columns if not c.startswith("avg_")]         # means may differ in their last bits
        assert sorted(map(str, built[name].select(exact).collect())) == sorted(map(str, plain[name].select(exact).collect())), name
    # with a line in the fact for each line the seller mart reads lines in place; with orders twice it has to read the fact
    in_place = "order_lines" in built["mart_seller_performance"]._jdf.queryExecution().executedPlan().toString()
    assert in_place == ("raw_orders" not in change)


def test_one_reader_of_lines_needs_no_copy_of_them(spark, tmp_path):
    from shipwright.plans import build
    wh = warehouse(spark, SF001)
    build.build_warehouse(wh, str(tmp_path), ("fct_orders",))
    assert not wh.is_written("order_lines") and not (tmp_path / "working").exists()


def test_a_given_staging_view_is_laid_out_and_leaves_raw_lines_alone(spark, tmp_path):
    from shipwright.plans import build
    wh = warehouse(spark, SF001)
    raw = wh["raw_order_items"].count()
    wh.override("stg_order_items", wh["stg_order_items"].filter("order_item_id = 1"))
    few = wh["stg_order_items"].count()
    build.build_warehouse(wh, str(tmp_path), LINE_TABLES)
    assert wh["fct_order_items"].count() == few < raw == wh["raw_order_items"].count()


def written(wh, name, df):
    wh.written(name, df, df.columns, None, {}, df.count())


def test_written_models_that_are_unique_or_as_long_as_another_give_no_events(spark):
    tests = [("a", "k", "unique", None), ("b", "k", "unique", None), ("a", None, "row_count_matches", "b"), ("b", None, "row_count_matches", "c"),
             ("b", "k", "relationships", ("a", "k"))]
    a = spark.createDataFrame([("1",), ("2",), (None,), (None,)], "k string")
    b = spark.createDataFrame([("1",), ("1",), ("1",), ("3",), ("3",)], "k string")
    lazy, files = warehouse(spark, SF001), warehouse(spark, SF001)
    for name, df in (("a", a), ("b", b), ("c", a.union(a.limit(1)))):
        lazy.override(name, df)
        written(files, name, df)
    want = {("a", "unique"): 0, ("b", "unique"): 2, ("a", "row_count_matches"): 1, ("b", "row_count_matches"): 0, ("b", "relationships"): 2}
    for wh in (lazy, files):
        assert {(r.model, r.test): r.failures for r in dq.failures_by_test(wh, tests).collect()} == want
    assert dq._once(lazy, tests) == set() and dq._once(files, tests) == {("a", "k")}
    due = [i for events in dq._events(files, tests, dq._once(files, tests)).values() for _, i, _, _ in events]
    assert sorted(due) == [1, 4, 4]                     # b's keys decide; no event for what is known
