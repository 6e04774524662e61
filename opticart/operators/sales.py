"""Sales rankings: custom buyer spend (D01) and top products."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticart.functions.blocks import VKEY, version_extras
from opticart.functions.skew import split_join
from opticart.operators.common import orders_between
from opticart.params import DEFAULT, Params
from opticart.sources.conform import Tables


def _year_range(year: int) -> tuple[dt.date, dt.date]:
    return dt.date(year, 1, 1), dt.date(year + 1, 1, 1)


def custom_buyer_spend(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Customers whose customised purchases of the last years exceed a spend.

    The reference joins every line to each of its selected options, so the
    base price counts once per option: tc = sum(n_feat*price*units +
    sum_extra) and the threshold applies to sum(n_feat*units*price).
    Lines are priced and reduced per order before the order and card joins.
    """
    start = dt.date(p.as_of.year - p.spend_lookback_years, 1, 1)   # DATEDIFF(YEAR) <= k
    ext = version_extras(t.selected, t.customizations, versions=t.versions)
    # The options and the price of a version form one table; the lines of a
    # hot version are dealt to several tasks.
    priced = ext.join(t.products.select("product_id", "price"), "product_id")
    line = split_join(t.glasses_ordered, priced, VKEY, F.col("order_id"))
    spend = F.col("n_feat") * F.col("price") * F.col("units")
    per_order = line.groupBy("order_id").agg(
        F.sum(spend).alias("spend"),
        F.sum(spend + F.coalesce(F.col("sum_extra"), F.lit(0))).alias("tc"))
    orders = orders_between(t, start).select("order_id", "card_number")
    per_customer = (per_order.join(orders, "order_id")
                    .join(t.credit_cards, "card_number")
                    .groupBy("customer_id")
                    .agg(F.sum("tc").alias("tc"), F.sum("spend").alias("spend")))
    return (per_customer
            .where(F.col("spend") > F.lit(Decimal(str(p.min_spend))))
            .join(t.customers.select("customer_id"), "customer_id", "left_semi")
            .select("customer_id", F.col("tc").cast("decimal(38,2)").alias("tc")))


def _product_year_stats(lines: DataFrame, in_year: DataFrame, tag: str) -> DataFrame:
    """Per product: all lines (n, u) and lines of in-year orders (ny, uy), in one pass."""
    marked = lines.join(in_year.withColumn("_in", F.lit(True)), "order_id", "left")
    return marked.groupBy("product_id").agg(
        F.count(F.lit(1)).alias(f"n_{tag}"), F.sum("units").alias(f"u_{tag}"),
        F.count("_in").alias(f"ny_{tag}"),
        F.sum(F.when(F.col("_in"), F.col("units"))).alias(f"uy_{tag}"))


def top_products_by_units(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """The literal top-products query, without its per-product cross product.

    The reference left-joins both line tables to each product, so inside a
    product every plain line pairs with every customised line, and its OR
    lets the off-year side of a qualifying pair through. Summed over the
    pairs this is, per product:
      uy_o*max(n_g,1) + (u_o-uy_o)*ny_g + uy_g*max(n_o,1) + (u_g-uy_g)*ny_o
    for products with an in-year line. Only per-product aggregates move.
    """
    lo, hi = _year_range(p.year)
    in_year = orders_between(t, lo, hi).select("order_id")
    o = _product_year_stats(t.ordered, in_year, "o")
    g = _product_year_stats(t.glasses_ordered, in_year, "g")
    z = F.lit(0)
    c = {k: F.coalesce(F.col(k), z) for k in
         ["n_o", "u_o", "ny_o", "uy_o", "n_g", "u_g", "ny_g", "uy_g"]}
    amount = (c["uy_o"] * F.greatest(c["n_g"], F.lit(1)) + (c["u_o"] - c["uy_o"]) * c["ny_g"]
              + c["uy_g"] * F.greatest(c["n_o"], F.lit(1)) + (c["u_g"] - c["uy_g"]) * c["ny_o"])
    per_product = (o.join(g, "product_id", "full")
                   .where((c["ny_o"] > 0) | (c["ny_g"] > 0))
                   .select("product_id", amount.alias("amount")))
    return (t.products.select("product_id", "name").join(per_product, "product_id")
            .groupBy("name").agg(F.sum("amount").cast("bigint").alias("amount"))
            .orderBy(F.col("amount").desc(), F.col("name"))
            .limit(p.top_n))


def top_products_by_units_split(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """The rewritten form: in-year lines of both tables, UNION ALL, top-k.

    The year is a half-open date range, so it reaches the order scan as a
    pushed filter. Units are reduced per product before the product join.
    """
    lo, hi = _year_range(p.year)
    in_year = orders_between(t, lo, hi).select("order_id")
    # Each line table meets the orders on its own (order-bucketed tables
    # join without a shuffle; otherwise the orders side's exchange is reused).
    lines = (t.ordered.select("order_id", "product_id", "units").join(in_year, "order_id")
             .unionByName(t.glasses_ordered.select("order_id", "product_id", "units")
                          .join(in_year, "order_id")))
    per_product = lines.groupBy("product_id").agg(F.sum("units").alias("units"))
    return (t.products.select("product_id", "name").join(per_product, "product_id")
            .groupBy("name").agg(F.sum("units").cast("bigint").alias("amount"))
            .orderBy(F.col("amount").desc(), F.col("name"))
            .limit(p.top_n))
