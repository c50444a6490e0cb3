import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from shipwright.plans import build, forecasting
from shipwright.plans.warehouse import Warehouse
from shipwright.sources import commits as C
from shipwright.sources import csv_io as CSV
from shipwright.sources import sinks

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run_tables(spark, run, n):
    return {t: spark.range(n + k).select(F.lit(run).alias("run_id"), F.col("id").alias("v"))
            for k, t in enumerate(forecasting.OUTPUT_TABLES)}


def rows_by_run(spark, root):
    return {t: {r.run_id: r["count"] for r in C.read(spark, root, "forecasts", t).groupBy("run_id").count().collect()}
            for t in forecasting.OUTPUT_TABLES}


def test_a_run_appended_twice_is_there_once(spark, tmp_path):
    root = str(tmp_path)
    forecasting.append_run(run_tables(spark, "a", 3), root, "a")
    forecasting.append_run(run_tables(spark, "b", 5), root, "b")
    once = rows_by_run(spark, root)
    assert once == {t: {"a": 3 + k, "b": 5 + k} for k, t in enumerate(forecasting.OUTPUT_TABLES)}
    forecasting.append_run(run_tables(spark, "a", 3), root, "a")
    assert rows_by_run(spark, root) == once
    forecasting.append_run(run_tables(spark, "a", 10), root, "a")            # a run that is computed anew replaces its rows
    assert rows_by_run(spark, root) == {t: {"a": 10 + k, "b": 5 + k} for k, t in enumerate(forecasting.OUTPUT_TABLES)}


def test_a_run_that_dies_between_two_tables_is_not_seen(spark, tmp_path):
    root = str(tmp_path)
    forecasting.append_run(run_tables(spark, "a", 3), root, "a")
    before = rows_by_run(spark, root)
    half = run_tables(spark, "b", 4)
    broken = forecasting.OUTPUT_TABLES[2]
    half[broken] = half[broken].withColumn("v", F.when(F.col("v") > 2, F.raise_error(F.lit("gone"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="gone"):
        forecasting.append_run(half, root, "b")
    assert rows_by_run(spark, root) == before
    forecasting.append_run(run_tables(spark, "b", 4), root, "b")
    assert all(runs == {"a": 3 + k, "b": 4 + k} for k, runs in enumerate(rows_by_run(spark, root).values()))


def test_replaced_tables_keep_their_readers(spark, tmp_path):
    root = str(tmp_path)
    old = sinks.materialize(spark.range(5), root, "s", "t")
    new = sinks.materialize(spark.range(8), root, "s", "t")
    assert old.count() == 5 and new.count() == 8 and C.read(spark, root, "s", "t").count() == 8
    bad = spark.range(9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("gone"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="gone"):
        sinks.materialize(bad, root, "s", "t")
    assert C.read(spark, root, "s", "t").count() == 8                       # a failed load leaves the table
    # slices written before a whole table are gone with it, later ones are added to it
    C.commit_all(spark, root, [C.Write("s", "u", spark.range(2), key="x")])
    C.commit_all(spark, root, [C.Write("s", "u", spark.range(3))])
    C.commit_all(spark, root, [C.Write("s", "u", spark.range(4), key="x")])
    assert C.read(spark, root, "s", "u").count() == 7
    with pytest.raises(LookupError):
        C.read(spark, root, "s", "nothing")
    assert C.folders(spark, str(tmp_path / "empty"), "s", "t") == [] and C.recorded(spark, str(tmp_path / "empty")).count() == 0


def test_of_two_writers_the_later_name_counts(spark, tmp_path):
    root = str(tmp_path)
    entries = {c: C.write_all(root, c, [C.Write("s", "t", spark.range(n))]) for c, n in (("bb", 2), ("aa", 3))}
    for c in entries:
        C.publish(spark, root, c, entries[c])
    assert C.read(spark, root, "s", "t").count() == 3                       # the higher version
    both = str(tmp_path / "both")
    for c, n in (("bb", 2), ("aa", 3)):                                     # two manifests of one version
        e = C.write_all(both, c, [C.Write("s", "t", spark.range(n))])[0]
        spark.createDataFrame([(1, c, "s", "t", None, e["folder"], e["rows"], {})], C.MANIFEST).coalesce(1).write.json(f"{both}/commits/{c}")
    assert C.read(spark, both, "s", "t").count() == 2


def test_measures_are_taken_while_writing(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(100).withColumn("v", F.when(F.col("id") % 7 > 0, F.col("id")))
    C.commit_all(spark, root, [C.Write("s", "t", df, measures={"no v": F.col("v").isNull(), "large": F.col("v") > 90}),
                               C.Write("s", "none", df.filter("id < 0"), measures={"no v": F.col("v").isNull()})])
    live = {r.table_name: (r.rows, r.measures) for r in C.live_entries(spark, root).collect()}
    assert live == {"t": (100, {"no v": 15, "large": 7}), "none": (0, {"no v": 0})}
    assert {r.table_name: r.row_count for r in C.recorded(spark, root).collect()} == {"t": 100, "none": 0}
    assert C.read(spark, root, "s", "none").count() == 0


def test_a_retried_task_counts_once(tmp_path):
    code = f"""
        import os, sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import functions as F
        from shipwright.session import build_session
        from shipwright.sources import commits as C
        spark = build_session("local[2,3]", shuffle_partitions=2)       # a task may fail twice
        mark = {str(tmp_path / 'failed')!r}

        def once(batches):
            for i, b in enumerate(batches):
                yield b
            if not os.path.exists(mark):
                open(mark, "w").close()
                raise RuntimeError("lost after its rows were counted")

        df = spark.range(0, 1000, 1, 4).mapInArrow(once, "id long")
        for name, frame in (("narrow", df), ("shuffled", df.repartition(3))):
            if os.path.exists(mark):
                os.remove(mark)
            e = C.commit_all(spark, {str(tmp_path / 'root')!r}, [C.Write("s", name, frame, measures={{"even": F.col("id") % 2 == 0}})])[0]
            print("SEEN", name, e["rows"], e["measures"]["even"], os.path.exists(mark))
    """
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, timeout=300)
    assert "SEEN narrow 1000 500 True" in out.stdout and "SEEN shuffled 1000 500 True" in out.stdout, out.stderr[-2000:]


def test_loads_are_counted_by_the_job_that_writes_them(spark, tmp_path):
    sellers = spark.createDataFrame([("s1", "01", "x", "A"), ("s2", "02", "y", "B")], CSV.RAW_SCHEMAS["raw_sellers"])
    names = spark.createDataFrame([("a", "b")], CSV.RAW_SCHEMAS["raw_category_translation"])
    root = str(tmp_path)
    for _ in range(2):                                                      # a load that is repeated
        loaded = CSV.load_raw_layer(spark, {"raw_sellers": sellers, "raw_category_translation": names}, root, {"raw_category_translation": 4})
    assert loaded["raw_sellers"].orderBy("seller_id").collect() == sellers.collect()
    assert {r.table: (r.rows, r.expected, r.ok) for r in CSV.load_report(spark, root).collect()} == {
        "raw_sellers": (2, 2, True), "raw_category_translation": (1, 4, False)}
    broken = sellers.withColumn("seller_city", F.when(F.col("seller_id") == "s2", F.raise_error(F.lit("gone"))).otherwise(F.col("seller_city")))
    with pytest.raises(Exception, match="gone"):
        CSV.load_raw_layer(spark, {"raw_sellers": broken, "raw_category_translation": names.limit(0)}, root)
    assert {r.table: r.rows for r in CSV.load_report(spark, root).collect()} == {"raw_sellers": 2, "raw_category_translation": 1}


def test_month_folders_prune_and_measures_stand_for_row_tests(spark, tmp_path):
    from shipwright.plans import dashboard as D
    from shipwright.plans import quality_suite as dq
    from shipwright.registry import warehouse
    from tests.conftest import SF001
    lazy, built = warehouse(spark, SF001), warehouse(spark, SF001)
    build.build_warehouse(built, str(tmp_path))
    start, end = "1997-02-10", "1997-04-20"
    for read in (D.headline, D.weekly_service, D.monthly_unit_economics, D.state_scorecard):
        frame = read(built, start, end)
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(in_month" in plan or "PartitionFilters: [isnotnull(month_start" in plan, plan
        assert set(map(tuple, frame.collect())) == set(map(tuple, read(lazy, start, end).collect()))
    kpi = built.between("mart_kpi_daily_region", "date_day", start, end)
    files = kpi.select(F.col("date_day"), F.input_file_name().alias("f")).select("f").distinct().count()
    assert files < len(built["mart_kpi_daily_region"].inputFiles()) / 4
    assert built["fct_orders"].columns == lazy["fct_orders"].columns
    # row tests come from the commit, the others from one pass; both as over the lazy models
    assert built.measured("fct_orders") and not lazy.measured("fct_orders")
    assert sorted(map(tuple, dq.failures_by_test(built).collect())) == sorted(map(tuple, dq.failures_by_test(lazy).collect()))
    plan = dq.failures_by_test(built)._jdf.queryExecution().optimizedPlan().toString()
    assert "gmv" not in plan.split("Aggregate")[0]
    spoilt = Warehouse(spark, built.raw)
    spoilt.written("fct_orders", built["fct_orders"].withColumn("gmv", -F.col("gmv")), built["fct_orders"].columns, None, {})
    tests = {r.test_id: r.failures for r in dq.failures_by_test(spoilt, [("fct_orders", "gmv", "non_negative", None)]).collect()}
    assert tests["non_negative__fct_orders__gmv"] > 0
