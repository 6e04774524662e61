"""Edge cases the fixture cannot show, on small hand-made frames."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from opticart.functions.ranking import global_ntile, global_row_number
from opticart.operators import discounts, intake, nested, overview, sales, totals, windows
from opticart.sources.frames import FrameTables

SCHEMAS = {
    "products": "product_id bigint, name string, price decimal(12,2)",
    "base_frames": "product_id bigint",
    "customers": "customer_id bigint, first_name string, last_name string, email string",
    "customizations": "feature string, selection string, extra_price decimal(12,2)",
    "credit_cards": "card_number bigint, customer_id bigint",
    "orders": "order_id bigint, order_date date, card_number bigint, country string",
    "ordered": "order_id bigint, product_id bigint, units int",
    "glasses_ordered": "order_id bigint, product_id bigint, version int, units int",
    "selected": "product_id bigint, version int, feature string, selection string",
    "searches": "customer_id bigint, dt date",
    "searches_for_products": "customer_id bigint, dt date, product_id bigint",
    "reviews": "review_id bigint, customer_id bigint, product_id bigint, rating int, review_date date",
}
DAY = dt.date(2001, 1, 1)


def make(spark, **rows):
    full = {name: rows.get(name, []) for name in SCHEMAS}
    return FrameTables(spark, **{k: spark.createDataFrame(v, SCHEMAS[k]) for k, v in full.items()})


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ------------------------------------------------------------ D04 NOT IN
def test_not_in_is_null_aware(spark):
    base = dict(products=[(1, "a", D("1.00")), (2, "b", D("2.00"))],
                searches_for_products=[(1, DAY, 1), (1, DAY, 2)],
                ordered=[(10, 1, 1)])
    t = make(spark, **base)
    assert rows(nested.searched_never_bought(t), "product_id", "name") == [(2, "b")]
    t = make(spark, glasses_ordered=[(11, None, 1, 1)], **base)
    assert nested.searched_never_bought(t).count() == 0


# ------------------------------------------------------- D05 truncation
def test_mean_rating_truncates(spark):
    # product 1: ratings 2, 3, 3 -> mean 2.67 truncates to 2: nobody is below
    t = make(spark,
             customers=[(1, "A", "X", None), (2, "B", "Y", None), (3, "C", "Z", None)],
             reviews=[(1, 1, 1, 2, DAY), (2, 2, 1, 3, DAY), (3, 3, 1, 3, DAY)])
    assert nested.below_average_reviewers(t).count() == 0


# ------------------------------------------------ D08 drops and shares
def test_country_with_one_order_drops_out(spark):
    t = make(spark,
             products=[(1, "a", D("10.00"))],
             credit_cards=[(100, 1)],
             orders=[(1, DAY, 100, "A"),
                     (2, DAY, 100, "B"), (3, DAY + dt.timedelta(days=3), 100, "B"),
                     (4, DAY + dt.timedelta(days=9), 100, "B")],
             ordered=[(1, 1, 5), (2, 1, 1), (3, 1, 2), (4, 1, 3)])
    out = windows.country_efficiency(t).collect()
    assert [r["country"] for r in out] == ["B"]
    r = out[0]
    assert r["avg_days_between_orders"] == D("4.50")
    assert r["revenue_share"] == D("1.0000")
    assert r["total_revenue"] == D("60.00")
    assert r["efficiency"] == D("13.33")     # 60 / 4.5


# --------------------------------------------------------- D18 scaling
def test_discount_equal_bounds_and_null_ratio(spark):
    old = dt.date(2000, 1, 1)
    t = make(spark,
             products=[(1, "a", D("1.00")), (2, "b", D("1.00")), (3, "c", D("1.00")),
                       (4, "d", D("1.00"))],
             orders=[(1, old, 1, "A"), (2, dt.date(2001, 7, 30), 1, "A")],
             ordered=[(1, 1, 2), (1, 2, 2), (2, 4, 1)],
             reviews=[(1, 1, 1, 4, old), (2, 1, 2, 4, old)])
    p = discounts.DEFAULT
    out = dict(rows(discounts.low_seller_discounts(t, p), "product_id", "discount"))
    # products 1 and 2: same ratio -> upper; product 3 idle, unrated: max = min -> upper;
    # product 4 ordered recently -> not touched
    assert out == {1: 0.5, 2: 0.5, 3: 0.5, 4: None}


def test_discount_scaling_and_fanout(spark):
    old = dt.date(2000, 1, 1)
    t = make(spark,
             products=[(1, "a", D("1.00")), (2, "b", D("1.00")), (3, "c", D("1.00"))],
             orders=[(1, old, 1, "A")],
             ordered=[(1, 1, 1), (1, 2, 4)],
             # product 1: two reviews (4, 2) -> mean 3, units 1 x 2 reviews = 2 -> 1.5
             # product 2: one review 5 -> 5 / 4 = 1.25; product 3: no review -> NULL
             reviews=[(1, 1, 1, 4, old), (2, 1, 1, 2, old), (3, 1, 2, 5, old)])
    out = dict(rows(discounts.low_seller_discounts(t), "product_id", "discount"))
    assert out == {1: 0.5, 2: 0.1, 3: None}


def test_discount_keeps_what_is_stored(spark):
    """Products that do not qualify keep their old discount."""
    t = make(spark,
             products=[(1, "a", D("1.00")), (2, "b", D("1.00")), (3, "c", D("1.00"))],
             orders=[(1, dt.date(2000, 1, 1), 1, "A"), (2, dt.date(2001, 7, 30), 1, "A")],
             ordered=[(1, 1, 1), (2, 2, 1), (2, 3, 1)],
             reviews=[(1, 1, 1, 4, DAY)])
    stored = spark.createDataFrame([(1, 0.2), (2, 0.3)], "product_id long, discount double")
    out = dict(rows(discounts.low_seller_discounts(t, stored=stored), "product_id", "discount"))
    assert out == {1: 0.5, 2: 0.3, 3: None}


# ------------------------------------------------------ B4 global NTILE
@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 7, 13, 41])
def test_global_ntile_equals_window_ntile(spark, n):
    df = spark.createDataFrame([(i, (i * 7) % 5) for i in range(n)], "id long, v long")
    order = [F.col("v").desc(), F.col("id")]
    ours = global_ntile(df, 4, order, name="q", partitions=3)
    ref = df.withColumn("q", F.ntile(4).over(Window.orderBy(*order)))
    assert rows(ours, "id", "q") == rows(ref, "id", "q")


def test_global_row_number_by_group(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(50)], "id long, g string")
    ours = global_row_number(df, [F.col("id").desc()], "rn", by=["g"], partitions=5)
    ref = df.withColumn("rn", F.row_number().over(
        Window.partitionBy("g").orderBy(F.col("id").desc())))
    assert rows(ours, "id", "g", "rn") == rows(ref, "id", "g", "rn")


# -------------------------------------------------- D09 top-country tie
def test_top_country_tie_breaks_by_name(spark):
    t = make(spark,
             products=[(1, "a", D("1.00"))],
             orders=[(1, DAY, 1, "Zeta"), (2, DAY, 1, "Alpha")],
             ordered=[(1, 1, 1), (2, 1, 1)])
    out = overview.products_overview(t).collect()[0]
    assert out["top_country"] == "Alpha"
    assert out["total_orders"] == 2 and out["avg_days_between_orders"] == D("0.00")


# --------------------------------------------- D15 repeated change rows
def test_repeated_custom_change_rows_multiply_extras(spark):
    t = make(spark,
             products=[(1, "frame", D("100.00"))],
             glasses_ordered=[(1, 1, 1, 1)],
             selected=[(1, 1, "lens", "tint"), (1, 1, "arm", "gold")],
             customizations=[("lens", "tint", D("10.00")), ("arm", "gold", None)],
             orders=[(1, DAY, 1, "A")])
    changes = spark.createDataFrame([("I", 1, 1, 1, 2), ("I", 1, 1, 1, 3)],
                                    "op string, order_id long, product_id long, version int, units int")
    r = totals.custom_line_deltas(t, changes).collect()[0]
    # each of the 2 rows pays 2 x 10.00 of extras: (2 + 3) * (100 + 20)
    assert (r["plus"], r["minus"], r["n_plus"], r["n_minus"]) == (D("600.00"), None, 1, 0)


def test_stored_null_rules(spark):
    t = make(spark, products=[(1, "a", D("2.00"))],
             glasses_ordered=[(1, 1, 1, 1)], orders=[(1, DAY, 1, "A"), (2, DAY, 1, "A")])
    stored = spark.createDataFrame([(1, None), (2, D("5.00"))], "order_id long, total_amount decimal(18,2)")
    plain = spark.createDataFrame([("I", 1, 1, 3), ("D", 2, 1, 1)],
                                  "op string, order_id long, product_id long, units int")
    out = dict(rows(totals.apply_line_deltas(stored, totals.plain_line_deltas(t, plain)),
                    "order_id", "total_amount"))
    assert out == {1: None, 2: D("3.00")}           # NULL stays NULL (plain trigger)
    custom = spark.createDataFrame([("I", 1, 1, 1, 3)],
                                   "op string, order_id long, product_id long, version int, units int")
    out = dict(rows(totals.apply_custom_line_deltas(stored, totals.custom_line_deltas(t, custom)),
                    "order_id", "total_amount"))
    assert out == {1: D("6.00"), 2: D("5.00")}      # NULL counts as 0 (customised trigger)


def test_null_amounts_are_not_no_rows(spark):
    """A change set whose amounts are all NULL makes the total NULL."""
    t = make(spark, products=[(1, "a", None), (2, "b", D("2.00"))],
             glasses_ordered=[(1, 1, 1, 1)], orders=[(1, DAY, 1, "A"), (2, DAY, 1, "A")])
    stored = spark.createDataFrame([(1, D("5.00")), (2, D("5.00")), (3, D("5.00"))],
                                   "order_id long, total_amount decimal(18,2)")
    plain = spark.createDataFrame([("I", 1, 1, 3), ("I", 2, 2, 1), ("D", 2, 2, 2)],
                                  "op string, order_id long, product_id long, units int")
    out = dict(rows(totals.apply_line_deltas(stored, totals.plain_line_deltas(t, plain)),
                    "order_id", "total_amount"))
    assert out == {1: None, 2: D("3.00"), 3: D("5.00")}
    custom = plain.selectExpr("op", "order_id", "product_id", "1 AS version", "units")
    out = dict(rows(totals.apply_custom_line_deltas(stored, totals.custom_line_deltas(t, custom)),
                    "order_id", "total_amount"))
    assert out == {1: None, 2: D("3.00"), 3: D("5.00")}


def test_customers_without_orders_rank_last(spark):
    """No order means no ratio: NULL, and last in the ranking."""
    t = make(spark,
             customers=[(i, "f", "l", None) for i in range(1, 9)],
             searches=[(i, DAY + dt.timedelta(days=k)) for i in range(1, 9) for k in range(i)],
             credit_cards=[(i * 10, i) for i in range(1, 8)],     # customer 8 has no card
             orders=[(i, DAY, i * 10, "A") for i in range(1, 7)])  # customer 7 no order
    out = windows.search_to_order_quartile(t)
    assert rows(out, "customer_id", "ratio") == [(5, D("5.000")), (6, D("6.000"))]


# ------------------------------------------------ D02 overlapping types
def test_top_products_closed_form_on_overlapping_subtypes(spark):
    y = dt.date(2000, 5, 1)
    t = make(spark,
             products=[(1, "n1", D("1.00")), (2, "n1", D("1.00")), (3, "n3", D("1.00"))],
             orders=[(1, y, 1, "A"), (2, dt.date(1999, 5, 1), 1, "A"), (3, y, 1, "A")],
             ordered=[(1, 1, 2), (2, 1, 5), (3, 2, 7), (9, 1, 4)],
             glasses_ordered=[(2, 1, 1, 3), (1, 1, 1, 11), (2, 3, 1, 6)])
    # Product 1: plain lines 2 (in the year), 5 and 4 (not); customised 11 (in), 3 (not).
    # Pairs with an in-year side: (2,3) (2,11) (5,11) (4,11) -> 5 + 13 + 16 + 15 = 49.
    # Product 2: its line of 7 alone; product 3: its line of 6 is off-year.
    ours = sales.top_products_by_units(t)
    assert rows(ours, "name", "amount") == [("n1", 49 + 7)]


# ------------------------------------------------------- D22 e-mail rules
def test_email_rule_chain(spark):
    shapes = ["u0@mail.com", "u1@mail.net", "u.mail.com", "u@mail", "u@mail.co.il",
              "U@MAIL.ORG", "u@mail.", None]
    t = make(spark, customers=[(10, "a", "b", "x@y.com")])
    feed = spark.createDataFrame([(i, "f", "l", e) for i, e in enumerate(shapes)],
                                 "feed_seq long, first_name string, last_name string, email string")
    out = intake.customer_intake(t, feed=feed).orderBy("feed_seq").collect()
    assert [r["error_number"] for r in out] == [None, None, 51001, 51002, 51003, None, 51003, None]
    assert [r["customer_id"] for r in out if r["status"] == "accepted"] == [11, 12, 13, 14]
    assert [r["log_id"] for r in out if r["status"] == "rejected"] == [1, 2, 3, 4]


# ------------------------------------------------ D17 latest-order delete
def test_delete_latest_order_rules(spark):
    t = make(spark,
             customers=[(1, "a", "b", "one@x.com"), (2, "c", "d", "dup@x.com"),
                        (3, "e", "f", "dup@x.com")],
             credit_cards=[(10, 1), (20, 2)],
             orders=[(1, DAY, 10, "A"), (2, DAY, 10, "A"), (3, DAY, 20, "A")],
             glasses_ordered=[(1, 7, 1, 1), (2, 7, 1, 1), (2, 7, 2, 1), (3, 7, 1, 1)])
    req = spark.createDataFrame([("one@x.com", 7, 1), ("dup@x.com", 7, 1), (None, 7, 1)],
                                "email string, product_id long, version int")
    remaining, removed = totals.delete_latest_order_lines(t, req)
    # tie on date -> the higher order id is the latest; the shared address does nothing
    assert rows(removed, "order_id", "product_id", "version") == [(2, 7, 1)]
    assert remaining.count() == 3


def test_add_customer_single_call(spark):
    t = make(spark, customers=[(7, "a", "b", "x@y.com")])
    ok = intake.add_customer(t, "Dana", "Levi", "dana@shop.org").first()
    assert ok["status"] == "accepted" and ok["customer_id"] == 8
    bad = intake.add_customer(t, "Dana", "Levi", "dana.shop.org").first()
    assert bad["status"] == "rejected" and bad["error_number"] == 51001 and bad["log_id"] == 1


def test_a_crashed_intake_changes_neither_table(spark, tmp_path):
    """Both tables are views on one write; without its mark nothing of it is seen."""
    import os
    from opticart.sources.sinks import snapshot_path
    t = make(spark, customers=[(7, "a", "b", "x@y.com")])
    root = str(tmp_path / "routed")

    def tables():
        rows = intake.read_routed(spark, root)
        return (sorted(r.customer_id for r in intake.accepted_customers(rows).collect()),
                sorted(r.log_id for r in intake.email_error_log(rows).collect()))

    def run(version, emails):
        feed = spark.createDataFrame([(i, "f", "l", e) for i, e in enumerate(emails)],
                                     "feed_seq long, first_name string, last_name string, "
                                     "email string")
        intake.write_intake(intake.customer_intake(t, feed=feed), root, version)

    assert tables() == ([], [])
    run(1, ["a@b.com", "bad"])
    run(2, ["c@d.com", "e@f.com", "bad", "worse"])
    assert tables() == ([8, 8, 9], [1, 1, 2])      # each run alone: ids are not continued here
    os.remove(f"{snapshot_path(root, 2)}/_SUCCESS")    # as if the second had not ended
    assert tables() == ([8], [1])
    run(2, ["c@d.com"])                                # the retry, now without a reject
    assert tables() == ([8, 8], [1])
