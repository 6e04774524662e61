"""Stored columns with a default, collated addresses, sorted output, bitmap counts."""

import random

import pytest
from pyspark.sql import functions as F

from opticart import __main__ as cli
from opticart.functions.distinct import bits_of, count_bits, word_of
from opticart.operators import sales, totals
from opticart.plans.inspect import plan_text
from opticart.session import shared_path
from opticart.sources.frames import FrameTables
from opticart.sources.sinks import read_snapshot, read_sorted, snapshot_path, write_sorted
from tests.conftest import SMALL


def discounts_of(spark, root, version):
    return {r.product_id: r.discount for r in read_snapshot(spark, root, version).collect()}


def test_discounts_are_kept_from_run_to_run(spark):
    """The second run rewrites the discounts of idle products only."""
    root = shared_path(spark, "discounts")
    run = ["run", "low_seller_discounts", "--data", SMALL, "--out", root]
    cli.main([*run, "--version", "1", "--param", "idle_days=0"])
    first = discounts_of(spark, root, 1)
    cli.main([*run, "--version", "2", "--param", "idle_days=400", "--param", "upper_discount=0.9",
              "--stored-discounts", snapshot_path(root, 1)])
    cli.main([*run, "--version", "3", "--param", "idle_days=400", "--param", "upper_discount=0.9"])
    second, alone = discounts_of(spark, root, 2), discounts_of(spark, root, 3)
    kept = [k for k in first if alone[k] is None and first[k] is not None]
    assert kept and all(second[k] == first[k] for k in kept)
    assert all(second[k] == alone[k] for k in alone if alone[k] is not None)


def test_a_snapshot_without_the_column_reads_its_default(spark):
    root = shared_path(spark, "old-products")
    spark.createDataFrame([(1, "a"), (3, "b")], "product_id long, name string").write.mode(
        "overwrite").parquet(root)
    out = shared_path(spark, "discounts")
    run = ["run", "low_seller_discounts", "--data", SMALL, "--out", out]
    cli.main([*run, "--version", "1", "--stored-discounts", root])
    cli.main([*run, "--version", "2"])
    assert discounts_of(spark, out, 1) == discounts_of(spark, out, 2)


@pytest.fixture()
def mailbox(spark):
    return FrameTables(
        spark,
        customers=spark.createDataFrame(
            [(1, "Ann@Mail.com"), (2, "bob@mail.com"), (3, "BOB@mail.com "), (4, "eve@mail.com  "),
             (5, None)], "customer_id long, email string"),
        credit_cards=spark.createDataFrame([(c * 10, c) for c in range(1, 6)],
                                           "card_number long, customer_id long"),
        orders=spark.createDataFrame([(c, None, c * 10, "x") for c in range(1, 6)],
                                     "order_id long, order_date date, card_number long, "
                                     "country string"),
        glasses_ordered=spark.createDataFrame([(c, 7, 1, 2) for c in range(1, 6)],
                                              "order_id long, product_id long, version int, "
                                              "units int"))


@pytest.mark.parametrize("collation, gone", [
    ("", {2}), ("UTF8_LCASE", {1, 2}), ("UTF8_LCASE_RTRIM", {1, 4})])
def test_addresses_are_equal_under_the_collation(spark, mailbox, collation, gone):
    """ann differs by case, eve by blanks; bob is two customers where case and blanks do not
    count, so that no line of theirs goes."""
    asked = spark.createDataFrame([(e, 7, 1) for e in ("ann@mail.com", "bob@mail.com",
                                                       "EVE@mail.com", None)],
                                  "email string, product_id long, version int")
    left, removed = totals.delete_latest_order_lines(mailbox, asked, collation=collation)
    assert {r.order_id for r in removed.collect()} == gone
    assert {r.order_id for r in left.collect()} == {1, 2, 3, 4, 5} - gone


def test_sorted_output_reads_back_in_order(spark, tables):
    """D01 ORDER BY tc: the files in name order hold the rows in order, ties by id."""
    root = shared_path(spark, "sorted")
    df = sales.custom_buyer_spend(tables)
    write_sorted(df, root, 1, [F.col("tc"), F.col("customer_id")], files=6)
    got = [(r.tc, r.customer_id) for r in read_sorted(spark, root, 1)]
    assert got == sorted((r.tc, r.customer_id) for r in df.collect()) and got
    assert len(spark.read.parquet(snapshot_path(root, 1)).inputFiles()) > 1
    assert "rangepartitioning" in plan_text(df.repartitionByRange(6, "tc"), "simple")


def test_sorted_output_descending_with_nulls(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(30)]), i) for i in range(500)]
    root = shared_path(spark, "sorted")
    write_sorted(spark.createDataFrame(rows, "a long, b long"), root, 1,
                 [F.col("a").desc_nulls_last(), F.col("b").asc()], files=5)
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [tuple(r) for r in read_sorted(spark, root, 1)] == want


def test_bitmap_counts_are_exact(spark):
    rng = random.Random(2)
    ids = [None, 0, -1, -64, -65, 63, 64, 1 << 62, -(1 << 63), (1 << 63) - 1, *range(200)]
    rows = [(rng.choice("abc"), rng.choice(ids)) for _ in range(2000)] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, id long").repartition(5)
    got = {r.g: r.n for r in df.groupBy("g", word_of("id").alias("w")).agg(
        bits_of("id").alias("bits")).groupBy("g").agg(count_bits("bits").alias("n")).collect()}
    assert got == {g: len({i for h, i in rows if h == g and i is not None}) for g, _ in rows}


def test_country_efficiency_counts_by_words(tables):
    from opticart.operators import windows
    text = plan_text(windows.country_efficiency(tables), "simple")
    assert "Expand" not in text and "bit_or" in text
