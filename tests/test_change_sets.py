"""Change sets that arrive in parts: the stream equals the trigger."""

import random
from decimal import Decimal as D

import pytest

from opticart.operators import totals
from opticart.session import shared_path
from opticart.sources.frames import FrameTables
from opticart.streaming import order_totals as streaming

LINE = "op string, order_id long, product_id long, version int, units int"


@pytest.fixture(scope="module")
def shop(spark):
    return FrameTables(
        spark,
        products=spark.createDataFrame([(p, f"p{p}", D(f"{10 * p}.00")) for p in (1, 2, 3)],
                                       "product_id long, name string, price decimal(12,2)"),
        glasses_ordered=spark.createDataFrame(
            [(0, p, v, 1) for p in (1, 2, 3) for v in (1, 2)],
            "order_id long, product_id long, version int, units int"),
        selected=spark.createDataFrame(
            [(1, 1, "lens", "tint"), (1, 1, "arm", "gold"), (2, 2, "lens", "clear")],
            "product_id long, version int, feature string, selection string"),
        customizations=spark.createDataFrame(
            [("lens", "tint", D("5.00")), ("arm", "gold", None), ("lens", "clear", D("2.50"))],
            "feature string, selection string, extra_price decimal(12,2)"))


def trigger(t, spark, sets):
    """Totals by order after all change sets, each applied by D14 or D15."""
    want = {}
    for kind, rows in sets:
        df = spark.createDataFrame(rows, LINE)
        deltas = (totals.custom_line_deltas if kind == "glasses" else totals.plain_line_deltas)(t, df)
        for r in deltas.collect():
            want[r.order_id] = want.get(r.order_id, 0) + (r.plus or 0) - (r.minus or 0)
    return want


def run(spark, t, parts):
    """The stream over files that arrive one by one, a micro-batch each."""
    feed, base = shared_path(spark, "feeds"), shared_path(spark, "stream")
    for part in parts:
        spark.createDataFrame(part, streaming.SET_SCHEMA).coalesce(1).write.mode("append").parquet(feed)
        q = streaming.start_totals_stream(spark, t, feed, f"{base}/totals", f"{base}/checkpoint",
                                          max_files_per_trigger=1)
        q.awaitTermination()
        assert q.exception() is None
    return base


def totals_of(spark, base):
    return {r.order_id: r.total_amount
            for r in streaming.read_totals(spark, f"{base}/totals").collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_equals_the_trigger(spark, shop, seed):
    """Repeated rows of a set, spread over files and mixed with other sets, in any order."""
    rng = random.Random(seed)
    sets, rows = [], []
    for number in range(5):
        kind = rng.choice(["glasses", "glasses", "plain"])
        some = [(rng.choice("ID"), rng.randint(0, 2), rng.randint(1, 4), rng.randint(1, 2),
                 rng.randint(1, 5)) for _ in range(rng.randint(1, 6))]
        some += some[:rng.randint(0, 4)]
        sets.append((kind, some))
        rows += [(op, kind, o, p, v, u, number, len(some)) for op, o, p, v, u in some]
    rng.shuffle(rows)
    parts = [rows[i::4] for i in range(4)]
    base = run(spark, shop, parts)
    assert totals_of(spark, base) == trigger(shop, spark, sets)
    last = streaming._numbered(spark, f"{base}/totals/sets", "batch_id")
    assert len(last) <= 2               # older states are deleted, and no set stays open
    state = spark.read.parquet(f"{base}/totals/sets/batch_id={last[-1]}")
    assert state.where("open").count() == 0


def test_rows_without_a_set_are_sets_of_one(spark, shop):
    row = ("I", "glasses", 7, 1, 1, 2)
    base = run(spark, shop, [[(*row, None, None)] * 2, [(*row, None, None)]])
    assert totals_of(spark, base) == {7: 3 * 2 * (D(10) + D(5))}


def test_a_set_of_unknown_size_ends_with_its_batch(spark, shop):
    row = ("I", "glasses", 7, 1, 1, 2, 3, None)
    base = run(spark, shop, [[row] * 2, [row]])
    assert totals_of(spark, base) == {7: 4 * (D(10) + 2 * D(5)) + 2 * (D(10) + D(5))}


def test_an_open_set_adds_what_it_has(spark, shop):
    """Before the last row of a set arrives the total is that of the rows so far."""
    row = ("D", "glasses", 7, 1, 1, 1, 9, 3)
    base = run(spark, shop, [[row], [row]])
    assert totals_of(spark, base) == {7: -2 * (D(10) + 2 * D(5))}
    assert spark.read.parquet(f"{base}/totals/sets/batch_id=1").where("open").count() == 1


def test_a_batch_that_is_run_again_adds_nothing(spark, shop):
    batch = spark.createDataFrame([("I", "glasses", 7, 1, 1, 2, 3, 4)] * 2, streaming.SET_SCHEMA)
    empty = spark.createDataFrame([], streaming.SETS)
    first = streaming.merged_sets(batch, empty).select(*empty.columns)
    again = streaming.merged_sets(batch, empty).select(*empty.columns)
    assert first.collect() == again.collect()
    then = streaming.added_by_batch(batch, streaming.merged_sets(batch, first)).collect()
    assert [(r.units, r.extra_units) for r in then] == [(4, 8 * 4 - 4 * 2)]
