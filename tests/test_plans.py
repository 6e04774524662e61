"""Physical plan checks: no nested loops or products, single-partition
exchanges only over bounded inputs, filters and columns reach the scans."""

import pytest

from opticart import registry
from opticart.plans.inspect import plan_text, summarize
from tests.conftest import SMALL

QUERIES = registry.queries()
# Single-partition exchanges that sit on bounded inputs (besides the partial
# results of global aggregates): the per-country window total and the per-year LAG.
BOUNDED_SINGLE = {"country_efficiency": 1, "revenue_vs_target": 1,
                  "revenue_of_stored_totals": 1}      # its LAG runs on a row per year


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    df = QUERIES[name](spark, SMALL)
    s = summarize(plan_text(df), plan_text(df, "simple"))
    assert s.cartesian == 0 and s.nested_loop == 0
    assert s.python_udf == 0
    assert s.single_partition == BOUNDED_SINGLE.get(name, 0)


def test_date_range_and_columns_reach_the_scan(spark):
    text = plan_text(QUERIES["top_products_by_units_split"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01T00:00)" in text
    assert "LessThan(o_orderdate,2001-01-01T00:00)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text


@pytest.fixture
def no_size_broadcasts(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape_at_scale(spark, no_size_broadcasts, name):
    """As on large inputs (no size-based broadcasts): still no nested loops or
    products, and single-partition exchanges only over bounded inputs."""
    df = QUERIES[name](spark, SMALL)
    s = summarize(plan_text(df), plan_text(df, "simple"))
    assert s.cartesian == 0 and s.nested_loop == 0
    assert s.single_partition == BOUNDED_SINGLE.get(name, 0)


def test_single_customer_history_filters_first(spark, tables):
    """The customer filter reaches the scan (the filter-first form), also
    through the SQL table function."""
    from opticart import sql
    from opticart.operators import history
    assert "EqualTo(o_custkey,3)" in plan_text(history.customer_history(tables, 3))
    sql.register(spark, tables)
    assert "EqualTo(o_custkey,3)" in plan_text(spark.sql("SELECT * FROM customer_history(3)"))


@pytest.mark.parametrize("name, pushed", [
    ("custom_buyer_spend", "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)"),
    ("top_products_by_units", "LessThan(o_orderdate,2001-01-01T00:00)"),
    ("quarterly_revenue_rank", "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)"),
    ("product_annual_stats", "LessThan(o_orderdate,2002-01-01T00:00)"),
])
def test_year_filters_reach_the_order_scan(spark, name, pushed):
    assert pushed in plan_text(QUERIES[name](spark, SMALL))


@pytest.mark.parametrize("name, scans", [
    ("top_products_by_units", 2), ("products_overview", 2), ("top_rated_products", 2),
    ("quarterly_revenue_rank", 4), ("country_efficiency", 4)])
def test_lines_are_read_once_per_table(spark, name, scans):
    """Scans of the line table after execution: one per line table (and, for the
    revenue products, those the fixture needs to list versions and options)."""
    import re

    df = QUERIES[name](spark, SMALL)
    df.collect()
    text = plan_text(df, "simple")
    final = text[:text.index("Initial Plan")] if "Initial Plan" in text else text
    assert len(re.findall(r"Scan parquet .*l_partkey", final)) <= scans
