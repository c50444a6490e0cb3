import __spark_entry__ as E
from pyspark.sql.types import DoubleType

from tests.conftest import SF001


def test_entry_returns_headline_row(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 1 and rows[0].orders > 0


def test_every_oracle_has_a_query_and_double_lists_match():
    from oracle.doubles import DOUBLE_COLUMNS
    from shipwright.registry import QUERIES
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert set(DOUBLE_COLUMNS) == set(QUERIES) <= set(qs)


def test_model_schemas_agree_with_double_lists(spark):
    from oracle.doubles import DOUBLE_COLUMNS
    from shipwright.registry import QUERIES
    for key in ("fct_orders", "mart_kpi_daily_region", "dash_headline", "panel_delivery", "log_sql_audit"):
        df = QUERIES[key](spark, SF001)
        assert [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)] == DOUBLE_COLUMNS[key]


def test_kpi_reconcile_and_margin_checks_pass(spark):
    from shipwright.registry import QUERIES
    assert QUERIES["dq_kpi_reconcile"](spark, SF001).count() == 0
    assert QUERIES["dq_margin_components"](spark, SF001).count() == 0
