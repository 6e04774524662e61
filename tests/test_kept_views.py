"""Views refreshed by change sets equal the views over the lines as they then are."""

import random

import pytest
from pyspark.sql import functions as F

from opticart.operators import annual, kept, overview
from opticart.params import DEFAULT
from opticart.plans.inspect import plan_text
from opticart.session import shared_path
from opticart.sources import bucket_table
from opticart.sources.frames import FrameTables
from opticart.sources.sinks import snapshot_path
from tests.helpers import multiset, spark_rows

LINE = "order_id long, product_id long, version int, units int"


def rows_of(df):
    return multiset(*spark_rows(df))


@pytest.fixture(scope="module")
def shop(spark, tables):
    """Few products and orders, unknown ids and products in both line tables."""
    t = tables
    frames = {
        "products": t.products.where("product_id < 12"), "orders": t.orders_geo.where("order_id < 60"),
        "reviews": t.reviews, "searches_for_products": t.searches_for_products}
    frames = {k: spark.createDataFrame(v.toPandas(), v.schema) for k, v in frames.items()}
    orders = frames["orders"].withColumn(
        "order_date", F.when(F.col("order_id") % 11 != 0, F.col("order_date")))
    frames["orders"] = spark.createDataFrame(orders.collect(), orders.schema)
    return frames


def frames_of(spark, shop, plain, glasses):
    df = lambda rows: spark.createDataFrame(rows, LINE)      # noqa: E731
    return FrameTables(spark, ordered=df(plain).drop("version"), glasses_ordered=df(glasses), **shop)


def line(rng):
    return (rng.choice([*range(20), 70, None]), rng.choice([*range(8), 9_999]), 1, rng.randint(1, 4))


def test_refreshed_views_equal_the_full_queries(spark, shop):
    """Random inserts and deletes, down to orders and products that lose all their lines."""
    rng = random.Random(11)
    lines = {"plain": [line(rng) for _ in range(60)], "glasses": [line(rng) for _ in range(60)]}
    t = frames_of(spark, shop, **lines)
    state = kept.KeptLines.create(t, t.ordered, t.glasses_ordered.drop("version"),
                                  shared_path(spark, "kept-test"), 4)
    for number in range(1, 4):
        changes = {}
        for kind, now in lines.items():
            new = [line(rng) for _ in range(rng.randint(0, 12))]
            rng.shuffle(now)
            gone = [now.pop() for _ in range(min(len(now), 25))]
            now += new
            changes[kind] = spark.createDataFrame(
                [("I", *r) for r in new] + [("D", *r) for r in gone], "op string, " + LINE)
        state.refresh(number, changes["plain"], changes["glasses"])
        if number == 2:          # run again: nothing changes
            state.refresh(number, changes["plain"], changes["glasses"])
        now = frames_of(spark, shop, **lines)
        assert rows_of(state.overview()) == rows_of(overview.products_overview(now))
        assert rows_of(state.annual_stats()) == rows_of(annual.product_annual_stats(now, DEFAULT))


def test_a_refresh_cut_off_is_finished_by_its_retry(spark, shop):
    """The pairs of some buckets are changed already, the cells are not."""
    rng = random.Random(5)
    base, more = [line(rng) for _ in range(50)], [line(rng) for _ in range(30)]
    t = frames_of(spark, shop, base, [])
    state = kept.KeptLines.create(t, t.ordered, t.glasses_ordered, shared_path(spark, "kept-cut"), 4)
    new = spark.createDataFrame([("I", *r) for r in more], "op string, " + LINE)
    none = new.limit(0)
    pairs = kept.signed_pairs(new, none)
    state.increments(pairs).write.parquet(f"{state.path}/increments/change_set=1")
    state.pairs.update(pairs.where(state.pairs.bucket() < 2), 1,
                       lambda rows, c: kept._add_up(rows.unionByName(c), kept.PAIR, kept.PAIR_SUMS))
    state.refresh(1, new, none)
    now = frames_of(spark, shop, base + more, [])
    assert rows_of(state.overview()) == rows_of(overview.products_overview(now))


def test_a_refresh_reads_no_lines(spark, tables):
    """Neither the increments nor the views scan the line table."""
    t = tables
    state = kept.KeptLines.create(t, t.line_base(False), t.line_base(True),
                                  shared_path(spark, "kept-plan"), 4)
    path = snapshot_path(shared_path(spark, "kept-changes"), 1)
    kept.signed_pairs(t.line_changes(False), t.line_changes(True)).write.parquet(path)
    changes = spark.read.parquet(path)
    for df in (state.increments(changes), state.overview(), state.annual_stats()):
        assert "lineitem" not in plan_text(df)


def test_buckets_follow_the_input(tables, monkeypatch):
    """A bucket is sorted and written by one task, so larger tables get more of them."""
    monkeypatch.setattr(bucket_table, "ROWS", 100)
    lines = tables.raw("lineitem").count()
    state = kept._replayed(tables)
    assert state.pairs.buckets == state.cells.buckets == -(-lines // 100) > kept.BUCKETS
    largest = max(r["count"] for r in state.pairs._rows().groupBy("_bucket").count().collect())
    assert largest <= 200
