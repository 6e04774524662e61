"""Revenue building blocks shared by several products."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticart.functions.blocks import (VKEY, price_glasses_lines, price_plain_lines,
                                       version_extras, version_prices)
from opticart.sources.conform import Tables


def orders_between(t: Tables, first: dt.date, end: dt.date | None = None) -> DataFrame:
    """Orders dated from ``first`` up to before ``end``, as a range that reaches the files;
    tables laid out by year read those years only."""
    if hasattr(t, "orders_between"):
        return t.orders_between(first, end)
    day = F.col("order_date")
    wanted = day >= F.lit(first)
    return t.orders.where(wanted if end is None else wanted & (day < F.lit(end)))


def grouped_revenue(t: Tables, keyed_orders: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., revenue) for lines of the given orders, grouped by ``keys``.

    ``keyed_orders`` maps order_id to the group keys (e.g. year and quarter,
    or country). Both line tables meet the orders in one join, and units
    are summed per (keys, kind, product, version) before pricing, so lines
    move once (to their order) and only a small aggregate meets the product
    and version price tables. Exact: the sum of units times a price equals
    the sum of the line amounts.
    """
    ext = version_extras(t.selected, t.customizations)
    vp = version_prices(t.versions, t.products, ext)
    prices = t.products.select("product_id", "price")
    lines = (t.ordered.select("order_id", "product_id", F.lit(None).cast("int").alias("version"),
                              "units", F.lit(False).alias("_custom"))
             .unionByName(t.glasses_ordered.select("order_id", "product_id", "version", "units",
                                                   F.lit(True).alias("_custom"))))
    units = (lines.join(keyed_orders, "order_id")
             .groupBy(*keys, "_custom", *VKEY).agg(F.sum("units").alias("_u")))
    # One consumer of the reduced lines, so they are read and joined once: a
    # plain line takes the product's price, a customised one its version's,
    # and one without a listed version drops out.
    priced = (units.join(prices, "product_id").join(vp, VKEY, "left")
              .withColumn("_price", F.when(F.col("_custom"), F.col("total_price"))
                          .otherwise(F.col("price"))).where(F.col("_price").isNotNull()))
    return priced.groupBy(*keys).agg(F.sum(F.col("_u") * F.col("_price")).alias("revenue"))


def stored_line_amounts(t: Tables, plain: DataFrame, glasses: DataFrame) -> DataFrame:
    """(order_id, amount) per line, priced as the stored order total is.

    Plain: units * price. Customised: units * (price + extras of the
    version's options), without the VERSIONS table.
    """
    ext = version_extras(t.selected, t.customizations)
    a = price_plain_lines(plain, t.products).select(
        "order_id", (F.col("units") * F.col("unit_price")).alias("amount"))
    b = price_glasses_lines(glasses, t.products, ext).select(
        "order_id", (F.col("units") * F.col("unit_price")).alias("amount"))
    return a.unionByName(b)
