import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shipwright.operators import quality as Q
from shipwright.sources import csv_io as CSV


def test_checks_pass_on_clean_and_report_seeded_violations(spark):
    clean = spark.createDataFrame([(1, 5.0, "a"), (2, 0.0, "b")], "id long, v double, s string")
    dirty = spark.createDataFrame([(1, -1.0, "a"), (1, 9.0, None), (None, 2.0, "z")], "id long, v double, s string")
    assert Q.unique(clean, "id").count() == 0 and Q.unique(dirty, "id").count() == 1
    assert Q.not_null(clean, "s").count() == 0 and Q.not_null(dirty, "s").count() == 1
    assert Q.non_negative(clean, "v").count() == 0 and Q.non_negative(dirty, "v").count() == 1
    assert Q.between(clean, "v", 0, 5).count() == 0 and Q.between(dirty, "v", 0, 5).count() == 2
    assert Q.accepted_values(clean, "s", ["a", "b"]).count() == 0
    assert Q.accepted_values(dirty, "s", ["a", "b"]).count() == 1
    assert Q.relationships(dirty, "id", clean, "id").count() == 0
    assert Q.relationships(clean, "id", dirty.filter(F.col("v") > 0), "id").count() == 1
    assert Q.row_count_matches(clean, clean).count() == 0
    assert Q.row_count_matches(clean, dirty).first().asDict() == {"model_rows": 2, "compare_rows": 3}
    assert Q.unique_combination(dirty, ["id"]).count() == 1
    assert Q.count_above(dirty, F.col("v") > 0, 1).count() == 1 and Q.count_above(dirty, F.col("v") > 0, 2).count() == 0


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_typed_csv_values(spark, tmp_path):
    d = tmp_path / "customers"
    d.mkdir()
    _write(d / "c.csv", "\ufeffcustomer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
                        'k9,u4,00720,"Nova ""Velha"", sul",ZZ\n')
    c = CSV.read_csv_typed(spark, str(d), "raw_customers").first()
    assert c.customer_zip_code_prefix == "00720" and c.customer_city == 'Nova "Velha", sul'
    d = tmp_path / "reviews"
    d.mkdir()
    _write(d / "r.csv", ",".join(CSV.schema_of("raw_order_reviews").names) + '\nq7,o3,2,,"slow\nand ""late""",2021-05-04 03:02:01,\n')
    r = CSV.read_csv_typed(spark, str(d), "raw_order_reviews").first()
    assert r.review_comment_title is None and r.review_comment_message == 'slow\nand "late"'
    assert r.review_creation_date == dt.datetime(2021, 5, 4, 3, 2, 1) and r.review_answer_timestamp is None


def test_headers_are_judged_file_by_file(spark, tmp_path):
    good, bad = "seller_id,seller_zip_code_prefix,seller_city,seller_state", "id,seller_zip_code_prefix,seller_city,seller_state"
    d = tmp_path / "sellers"
    d.mkdir()
    _write(d / "a.csv", f"\ufeff{good}\ns1,1,x,y\n")
    _write(d / "b.csv", f"{bad}\n{good}\n")                    # a data line that looks like the header
    out = {os.path.basename(r.file): (r.header, r.ok) for r in CSV.header_report(spark, {"raw_sellers": str(d)}).collect()}
    assert out == {"a.csv": (good, True), "b.csv": (bad, False)}
    with pytest.raises(Exception):
        CSV.read_csv_typed(spark, str(d), "raw_sellers").collect()


def test_headers_are_read_up_to_their_line_end(spark, tmp_path):
    """Byte order mark, other line ends, empty and hidden files; bytes read don't grow with the file."""
    from shipwright.sources import first_lines as L
    d = tmp_path / "sellers" / "part"
    d.mkdir(parents=True)
    good = "seller_id,seller_zip_code_prefix,seller_city,seller_state"
    _write(d / "a.csv", good + "\r\n" + "s1,1,x,y\r\n" * 200_000)
    _write(d / "b.csv", "")
    _write(d / "c.csv", good)
    _write(d / "d.csv", "x" * 10_000 + "\n" + "y" * 50_000)
    _write(d / "_SUCCESS", "")
    _write(d / ".a.csv.crc", "z\n")
    path = str(tmp_path / "sellers")
    out = {os.path.basename(r.file): (r.header, r.ok) for r in CSV.header_report(spark, {"raw_sellers": path}).collect()}
    assert out == {"a.csv": (good, True), "b.csv": (None, False), "c.csv": (good, True), "d.csv": ("x" * 10_000, False)}
    read = L.first_lines(spark, {"raw_sellers": path})
    assert read.rdd.getNumPartitions() == 4
    taken = {os.path.basename(r.file): (len(r.line or ""), r.bytes_read) for r in read.collect()}
    assert all(n <= length + L.BLOCK for length, n in taken.values()) and taken["b.csv"] == (0, 0)
    assert L.files_of(f"file://{path}") == ["file://" + f for f in L.files_of(path)]
    (tmp_path / "none").mkdir()
    assert L.first_lines(spark, {"raw_sellers": str(tmp_path / "none")}).count() == 0


def test_declared_row_counts(spark):
    df = spark.range(3)
    out = {r.table: (r.rows, r.expected, r.ok) for r in CSV.row_count_report({"t": df, "u": df}, {"t": 3, "u": 5}).collect()}
    assert out == {"t": (3, 3, True), "u": (3, 5, False)}


def test_catalogue_lists_everything(spark, tmp_path):
    from shipwright.sources import catalog as CAT
    wide = spark.range(2).select(*[F.lit(i).alias(f"c{i}") for i in range(75)])
    wide.createOrReplaceTempView("wide_test__dim_wide")
    docs = spark.createDataFrame([("dim_wide", "c70", "the seventieth")], "table_name string, column_name string, description string")
    cols = CAT.catalog_columns(spark, docs, schemas=("wide_test",)).collect()
    assert len(cols) == 75 and {r.description for r in cols if r.column_name == "c70"} == {"the seventieth"}
    assert CAT.catalog_columns(spark, None, ("wide_test",), max_columns=60).count() == 61
    path = str(tmp_path / "gone")
    spark.range(1).write.parquet(path)
    spark.read.parquet(path).selectExpr("id as a").createOrReplaceTempView("wide_test__dim_ok")
    tables = {r.table_name: (r.row_count, r.error) for r in CAT.catalog_tables(spark, ("wide_test",)).collect()}
    assert tables == {"dim_wide": (2, None), "dim_ok": (1, None)}
    for v in ("wide_test__dim_wide", "wide_test__dim_ok"):
        spark.catalog.dropTempView(v)


def test_calendar_spans_the_years_of_the_dates(spark):
    from shipwright.operators.timeseries import date_spine
    df = spark.createDataFrame([(dt.date(2019, 5, 6),), (dt.date(2020, 2, 1),), (None,)], "d date")
    days = [r.date_day for r in date_spine(df, "d").orderBy("date_day").collect()]
    assert len(days) == 365 + 366 and days[0] == dt.date(2019, 1, 1) and days[-1] == dt.date(2020, 12, 31)
    assert date_spine(df.filter("d is null"), "d").count() == 0


def test_unique_deals_a_key_to_as_many_tasks_as_it_has_values_for(spark, monkeypatch):
    """Tasks of a uniqueness test grow with the key's table, whatever the shuffled bytes are merged to (8 partitions here)."""
    from shipwright.plans import quality_suite as dq, staging  # noqa: F401  (its models)
    from shipwright.plans.warehouse import Warehouse
    monkeypatch.setattr(dq, "KEYS_A_TASK", 100)
    ids = [str(i) for i in range(2490)] + [None, "7", "7", "8"]
    sellers = spark.createDataFrame([(i, "1", "x", "s") for i in ids],
                                    "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string")
    wh = Warehouse(spark, {"raw_sellers": sellers})
    found = dq.unique_violations(wh, [("stg_sellers", "seller_id", "unique", None)])
    assert sorted((r.model, r.column_name, r.value, r.n_records) for r in found.collect()) == [
        ("stg_sellers", "seller_id", "7", 3), ("stg_sellers", "seller_id", "8", 2)]
    assert found.rdd.getNumPartitions() == 25
    plain = dq.unique_violations(wh, [("stg_sellers", "seller_zip_prefix", "unique", None)])      # no key: left to Spark
    assert [r.n_records for r in plain.collect()] == [2494] and plain.rdd.getNumPartitions() <= 8
