"""Product read models: overview (D09), top rated (D10), rating gap."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticart.functions.blocks import all_lines
from opticart.functions.numeric import ratio_double, round_ratio
from opticart.functions.skew import split_join
from opticart.params import DEFAULT, Params
from opticart.sources.conform import Tables


def product_rating(t: Tables) -> DataFrame:
    """(product_id, rating): mean review rating rounded to 2, a double.

    Products without a rated review have no row; callers default it to 0.
    """
    return t.reviews.groupBy("product_id").agg(
        ratio_double(F.sum("rating"), F.count("rating"), 2).alias("rating"))


def order_measures(t: Tables) -> DataFrame:
    """Per product (total_orders, total_units, _span, _dated, top_country).

    One aggregate over the lines-to-orders join at (product, country)
    granularity serves every order measure: an order has one country, so
    distinct orders per product are the sum over its countries, and the
    top country is the least (-count, country) among the same rows, so the
    lines are joined and aggregated once. Lines whose order is unknown form
    the (product, NULL) group with _hit NULL.
    """
    lines = all_lines(t.ordered, t.glasses_ordered)
    orders = t.orders_geo.select("order_id", "order_date", "country", F.lit(True).alias("_hit"))
    by_country = (lines.join(orders, "order_id", "left")
                  .groupBy("product_id", "country", "_hit").agg(
                      F.count(F.lit(1)).alias("_n"),
                      F.sum("units").alias("_u"),
                      F.max("order_date").alias("_last"),
                      F.min("order_date").alias("_first"),
                      F.countDistinct(F.when(F.col("order_date").isNotNull(), F.col("order_id")))
                      .alias("_dated")))
    return fold_countries(by_country)


def fold_countries(by_country: DataFrame) -> DataFrame:
    """The order measures per product from those per (product, country, known order)."""
    per_product = by_country.groupBy("product_id").agg(
        F.sum("_n").alias("total_orders"),
        F.sum("_u").alias("total_units"),
        F.datediff(F.max("_last"), F.min("_first")).alias("_span"),
        F.sum("_dated").alias("_dated"),
        F.min(F.when(F.col("_hit") & (F.col("_n") > 0), F.struct(
            (-F.col("_n")).alias("least"), F.col("country").isNull().alias("unknown"),
            "country"))).alias("_top"))
    return per_product.withColumn("top_country", F.col("_top.country")).drop("_top")


def products_overview(t: Tables, p: Params = DEFAULT,
                      measures: DataFrame | None = None) -> DataFrame:
    """One row per product with rating, searches, orders, ratio,
    mean days between its orders, units and top country.

    Every measure is one pre-aggregate keyed by product_id, left-joined to
    the products once; the reference's correlated subqueries per product
    become grouped aggregates (``order_measures``):
      * total_orders counts lines of both tables, total_units sums them;
      * the mean order gap telescopes over the product's distinct dated
        orders: span / (distinct orders - 1);
      * top country: lines per (product, country), first by count desc,
        then country.
    ``measures`` gives the order measures where they are kept (``operators.kept``).
    """
    per_product = order_measures(t) if measures is None else measures
    searches = t.searches_for_products.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("total_searches"))
    o = F.coalesce(F.col("total_orders"), F.lit(0))
    s = F.coalesce(F.col("total_searches"), F.lit(0))
    ratio = F.when((o == 0) | (s == 0), F.lit(0.0)).otherwise(ratio_double(o, s, 3))
    return (t.products.select("product_id", "name")
            .join(product_rating(t), "product_id", "left")
            .join(searches, "product_id", "left")
            .join(per_product, "product_id", "left")
            .select(
                "product_id", "name",
                F.coalesce(F.col("rating"), F.lit(0.0)).alias("rating"),
                s.cast("bigint").alias("total_searches"),
                o.cast("bigint").alias("total_orders"),
                ratio.alias("search_order_ratio"),
                round_ratio(F.col("_span"), F.col("_dated") - 1, 2, 10)
                .alias("avg_days_between_orders"),
                F.coalesce(F.col("total_units"), F.lit(0)).cast("bigint").alias("total_units"),
                "top_country"))


def top_rated_products(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """The top-n products of the overview by rating (ties by product id).

    Only the overview's rating, order count and top country are built; the
    same values as reading the full overview.
    """
    per_product = order_measures(t)
    return (t.products.select("product_id", "name")
            .join(product_rating(t), "product_id", "left")
            .join(per_product.select("product_id", "total_orders", "top_country"), "product_id",
                  "left")
            .select("product_id", "name",
                    F.coalesce(F.col("rating"), F.lit(0.0)).alias("rating"),
                    F.coalesce(F.col("total_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
                    "top_country")
            .orderBy(F.col("rating").desc(), F.col("product_id").asc())
            .limit(p.top_n))


def review_gaps(t: Tables) -> DataFrame:
    """(review_id, gap): rating minus the product's rounded mean, of every review of a product."""
    means = product_rating(t).withColumnRenamed("rating", "mean")
    listed = t.reviews.join(t.products.select("product_id"), "product_id", "left_semi")
    return listed.join(means, "product_id").select(
        "review_id", (F.col("rating") - F.col("mean")).alias("gap"))


def rating_gap(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Reviews of the current year far below their product's rounded mean.

    The reference calls a scalar function per review, twice, each call
    evaluating the whole overview view. Here the rating measure is
    computed once and joined; the year becomes a pushed date range.
    """
    y = p.review_as_of.year
    reviews = t.reviews.where((F.col("review_date") >= F.lit(dt.date(y, 1, 1)))
                              & (F.col("review_date") < F.lit(dt.date(y + 1, 1, 1))))
    rating = (product_rating(t).join(t.products.select("product_id"), "product_id", "left_semi")
              .withColumnRenamed("rating", "product_rating"))
    gap = F.col("rating") - F.col("product_rating")
    return (split_join(reviews, rating, ["product_id"], F.col("review_id"))
            .where(gap < F.lit(p.rating_gap))
            .select("review_id", "customer_id", "product_id", "rating", "review_date",
                    gap.alias("gap")))
