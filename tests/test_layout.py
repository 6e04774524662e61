"""Tables laid out by year and by bucket: same results, fewer files."""

import datetime as dt

import pytest

from opticart import registry
from opticart.operators import history, sales
from opticart.operators.common import orders_between
from opticart.params import DEFAULT
from opticart.plans.inspect import files_read, plan_text
from opticart.session import shared_path
from opticart.sources.layout import lay_out
from tests.helpers import multiset, spark_rows
from tests.test_skew import ONLY_CONFORMED

BUCKETS = 8


@pytest.fixture(scope="module")
def laid(spark, tables):
    return lay_out(tables, shared_path(spark, "laid-out"), BUCKETS)


def rows_of(df):
    return multiset(*spark_rows(df))


@pytest.mark.parametrize("name", ONLY_CONFORMED)
def test_products_are_the_same(tables, laid, name):
    fn = registry.PRODUCTS[name]
    assert rows_of(fn(laid, DEFAULT)) == rows_of(fn(tables, DEFAULT))


def test_a_year_reads_its_files_only(tables, laid):
    """D03 and D06 read the orders of their years."""
    files = files_read(laid.orders)["orders"]
    years = laid._frames["orders"].select("order_year").distinct().count()
    assert years > 3
    one = files_read(sales.top_products_by_units_split(laid))["orders"]
    # both line tables join the year's orders
    assert one <= 2 * max(r[1] for r in laid._frames["orders"].selectExpr(
        "order_year", "input_file_name() AS f").distinct().groupBy("order_year").count().collect())
    assert one < 2 * files
    assert "PartitionFilters: [isnotnull(order_year" in plan_text(
        sales.top_products_by_units_split(laid))


@pytest.mark.parametrize("first, end", [
    (dt.date(2000, 1, 1), dt.date(2001, 1, 1)), (dt.date(1999, 12, 31), dt.date(2000, 1, 1)),
    (dt.date(2000, 3, 1), dt.date(2001, 2, 3)), (dt.date(2000, 6, 6), None),
    (dt.date(2030, 1, 1), None)])
def test_ranges_over_years(tables, laid, first, end):
    assert rows_of(orders_between(laid, first, end)) == rows_of(orders_between(tables, first, end))


def test_one_customer_reads_a_few_files(spark, tables, laid):
    """The history of a customer: one partition of card_orders, no orders, no cards, and of
    the lines the buckets of the customer's orders."""
    for customer in (3, 7, 10 ** 9):
        got = history.customer_history(laid, customer)
        want = history.customer_history(tables, customer)
        orders = {r.order_id for r in want.collect()}
        read = files_read(got)
        assert rows_of(got) == rows_of(want)
        assert "orders" not in read and "credit_cards" not in read
        assert read.get("card_orders", 0) <= 3        # read once for itself, once per line table
        buckets = laid.card_orders.where(f"customer_id = {customer}").selectExpr(
            f"pmod(xxhash64(order_id), {BUCKETS})").distinct().count()
        for table in ("ordered", "glasses_ordered"):
            assert read.get(table, 0) <= buckets, (customer, read)
    assert orders == set()


def test_files_have_bloom_filters(laid):
    import pyarrow.parquet as pq
    path = laid._frames["orders"].inputFiles()[0].removeprefix("file:").removeprefix("//")
    size = sum(pq.ParquetFile(path).metadata.row_group(0).column(i).total_compressed_size
               for i in range(4))
    import os
    assert os.path.getsize(path) > size      # the filters stand beside the column chunks
    text = plan_text(laid.orders.where("card_number = 5"))
    assert "PushedFilters: [IsNotNull(card_number), EqualTo(card_number,5)" in text
