"""Tables changed in place by buckets: only touched buckets are rewritten."""

import random
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from opticart.operators import totals
from opticart.plans.inspect import plan_text
from opticart.session import shared_path
from opticart.sources.bucket_table import BucketTable

BUCKETS = 16


def files(table):
    """Bucket -> names of its files."""
    root = Path(table.path.removeprefix("file:"))
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in root.glob("_bucket=*")}


def changed(before, after):
    return {b for b in before | after if before.get(b) != after.get(b)}


@pytest.fixture()
def stored(spark, tables):
    return BucketTable.create(totals.order_totals(tables), shared_path(spark, "test-totals"),
                              "order_id", BUCKETS)


def as_map(df):
    return {r.order_id: r.total_amount for r in df.collect()}


def test_one_changed_order_rewrites_one_bucket(spark, tables, stored):
    before, old = files(stored), as_map(stored.read())
    assert len(before) == BUCKETS and all(len(f) == 1 for f in before.values())
    order = min(old)
    product = tables.products.where("product_id > 0").first()
    lines = spark.createDataFrame([("I", order, product.product_id, 3)],
                                  "op string, order_id long, product_id long, units int")
    touched = totals.keep_totals(stored, 1, plain=totals.plain_line_deltas(tables, lines))
    after = files(stored)
    assert len(touched) == 1 and changed(before, after) == {f"_bucket={touched[0]}"}
    assert as_map(stored.read()) == old | {order: old[order] + 3 * product.price}
    # the change read the touched bucket only
    plan = plan_text(stored._rows().where(F.col("_bucket").isin(touched)))
    assert f"PartitionFilters: [isnotnull(_bucket#" in plan or "PartitionFilters: [(_bucket" in plan


def test_totals_kept_in_place_equal_the_recomputed_ones(tables):
    """Stored totals plus both change sets are the totals of the final lines."""
    got = as_map(totals.totals_kept_in_place(tables))
    assert got == as_map(totals.order_totals(tables, tables.line_final(False),
                                             tables.line_final(True)))


def test_a_change_set_run_again_changes_nothing(spark, tables, stored):
    deltas = totals.plain_line_deltas(tables, tables.line_changes(False))
    totals.keep_totals(stored, 1, plain=deltas)
    want = as_map(stored.read())
    totals.keep_totals(stored, 1, plain=deltas)
    assert as_map(stored.read()) == want


def test_a_change_set_cut_off_is_finished_by_its_retry(spark, tables, stored):
    """Some buckets have the change set already, as after a failed commit."""
    deltas = totals.plain_line_deltas(tables, tables.line_changes(False))
    want = as_map(totals.apply_line_deltas(stored.read(), deltas))
    part = deltas.where(stored.bucket() % 3 == 0)
    assert 0 < len(totals.keep_totals(stored, 1, plain=part)) < BUCKETS
    totals.keep_totals(stored, 1, plain=deltas)
    assert as_map(stored.read()) == want


def test_random_change_sets(spark, tables, stored):
    rng = random.Random(3)
    want = {k: v for k, v in as_map(stored.read()).items()}
    prices = {r.product_id: r.price for r in tables.products.collect()}
    ids, products = sorted(want), sorted(prices)
    for n in range(1, 5):
        rows = [(rng.choice("ID"), rng.choice([*ids[:40], -1]), rng.choice(products),
                 rng.randint(1, 5)) for _ in range(30)]
        lines = spark.createDataFrame(rows, "op string, order_id long, product_id long, units int")
        totals.keep_totals(stored, n, plain=totals.plain_line_deltas(tables, lines))
        for op, order, product, units in rows:
            if order in want:
                want[order] += (1 if op == "I" else -1) * units * prices[product]
        assert as_map(stored.read()) == want


def test_empty_and_ambiguous_change_sets(spark, tables, stored):
    before = files(stored)
    deltas = totals.plain_line_deltas(tables, tables.line_changes(False))
    assert totals.keep_totals(stored, 1, plain=deltas.limit(0)) == []
    assert files(stored) == before
    with pytest.raises(ValueError):
        totals.keep_totals(stored, 1)
    with pytest.raises(ValueError):
        totals.keep_totals(stored, 1, plain=deltas, custom=deltas)


def test_delete_rewrites_the_touched_buckets(spark, tables):
    """D17 on a stored line table: what is left equals the snapshot form; a bucket that
    loses all its rows is emptied, the others keep their files."""
    lines = tables.glasses_ordered
    table = BucketTable.create(lines, shared_path(spark, "test-lines"), "order_id", BUCKETS)
    remaining, removed = totals.delete_latest_order_lines(tables, totals.return_requests(tables))
    keys = ["order_id", "product_id", "version"]
    before = files(table)
    touched = table.delete(removed.select(*keys), keys)
    assert touched and changed(before, files(table)) == {f"_bucket={b}" for b in touched}
    assert sorted(table.read().collect()) == sorted(remaining.collect())
    gone = table.read().where(table.bucket() == 5)
    assert gone.count() and table.delete(gone.select(*keys), keys) == [5]
    assert "_bucket=5" not in files(table)
    assert sorted(table.read().collect()) == sorted(remaining.where(table.bucket() != 5).collect())


def test_null_keys_and_amounts(spark):
    df = spark.createDataFrame([(None, D("1.00")), (1, None), (2, D("3.00"))],
                               "order_id long, total_amount decimal(18,2)")
    table = BucketTable.create(df, shared_path(spark, "test-nulls"), "order_id", 3)
    deltas = spark.createDataFrame([(1, D(5), None, 1, 0), (2, D(5), None, 1, 0)],
                                   "order_id long, plus decimal(18,2), minus decimal(18,2), "
                                   "n_plus long, n_minus long")
    totals.keep_totals(table, 1, plain=deltas)
    assert as_map(table.read()) == {None: D("1.00"), 1: None, 2: D("8.00")}
    totals.keep_totals(table, 2, custom=deltas)
    assert as_map(table.read()) == {None: D("1.00"), 1: D("5.00"), 2: D("13.00")}
