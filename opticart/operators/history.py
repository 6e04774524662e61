"""Customer order history (D12), the reference's inline table function."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticart.functions.blocks import VKEY, price_plain_lines, version_extras, version_prices
from opticart.functions.skew import split_join
from opticart.params import DEFAULT, Params
from opticart.sources.conform import Tables


def customer_history(t: Tables, customer_id: int | None = None) -> DataFrame:
    """Orders of one customer (or of all) with their units and cost.

    (customer_id, order_id, order_date, total_units, total_cost). With a
    customer id the cards are filtered first and the line tables are
    semi-reduced to that customer's orders (a small broadcast side), which
    is the reference's second, filter-first form. Customised lines are
    priced through base-frame versions only. Orders without lines give 0. Tables
    laid out for look-ups (``sources.layout``) give the customer's orders and lines
    from their buckets.
    """
    cards = t.credit_cards
    if customer_id is not None:
        cards = cards.where(F.col("customer_id") == F.lit(customer_id))
    co = t.orders.select("order_id", "order_date", "card_number").join(cards, "card_number")
    plain, glasses = t.ordered, t.glasses_ordered
    if customer_id is not None and hasattr(t, "orders_of"):
        co = t.orders_of(customer_id)
        plain, glasses = t.lines_of("ordered", co), t.lines_of("glasses_ordered", co)
    elif customer_id is not None:
        ids = co.select("order_id")
        plain = plain.join(ids, "order_id", "left_semi")
        glasses = glasses.join(ids, "order_id", "left_semi")
    ext = version_extras(t.selected, t.customizations)
    vp = version_prices(t.versions, t.products, ext, base_frames=t.base_frames)
    a = price_plain_lines(plain, t.products).select(
        "order_id", "units", (F.col("units") * F.col("unit_price")).alias("cost"))
    # keys are measured on the table: cheaper than on the lines of some orders
    b = split_join(glasses, vp, VKEY, F.col("order_id"), measure=t.glasses_ordered).select(
        "order_id", "units", (F.col("units") * F.col("total_price")).alias("cost"))
    per_order = a.unionByName(b).groupBy("order_id").agg(
        F.sum("units").alias("units"), F.sum("cost").alias("cost"))
    return co.join(per_order, "order_id", "left").select(
        "customer_id", "order_id", "order_date",
        F.coalesce(F.col("units"), F.lit(0)).cast("bigint").alias("total_units"),
        F.coalesce(F.col("cost"), F.lit(0)).cast("decimal(38,2)").alias("total_cost"))


def customer_history_all(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """D12 over every customer at once (the registered form)."""
    return customer_history(t, None)
