"""Per-year products: annual stats grid (D19) and units pivot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticart.functions.numeric import round_ratio
from opticart.params import DEFAULT, Params
from opticart.sources.conform import Tables


def _in_years(col: str, years) -> F.Column:
    """Date in one of the years: a pushed range plus the exact year list."""
    lo, hi = dt.date(min(years), 1, 1), dt.date(max(years) + 1, 1, 1)
    c = F.col(col)
    return (c >= F.lit(lo)) & (c < F.lit(hi)) & F.year(c).isin(list(years))


def product_annual_stats(t: Tables, p: Params = DEFAULT,
                         by_year: DataFrame | None = None) -> DataFrame:
    """Product x year grid with searches, orders, units and rating.

    The grid is generated per product by exploding the (parameter-sized)
    year list, so no cross join is planned. The four measures are reduced
    to (product, year) granularity, stacked with UNION ALL and folded by
    one aggregate, then left-joined to the grid once. An order holding the
    product in both line tables counts twice, as in the reference. ``by_year``
    gives the orders ``o`` and units ``u`` per (product, year) where they are kept
    (``operators.kept``).
    """
    years = list(p.years)
    z = F.lit(None).cast("bigint")
    searches = (t.searches_for_products.where(_in_years("dt", years))
                .groupBy("product_id", F.year("dt").alias("year"))
                .agg(F.count(F.lit(1)).alias("s"))
                .select("product_id", "year", "s", z.alias("o"), z.alias("u"),
                        z.alias("rs"), z.alias("rc")))
    orders = t.orders.where(_in_years("order_date", years)).select(
        "order_id", F.year("order_date").alias("year"))

    def line_measure(lines: DataFrame) -> DataFrame:
        per_order = (lines.join(orders, "order_id")
                     .groupBy("product_id", "year", "order_id")
                     .agg(F.sum("units").alias("u")))
        return (per_order.groupBy("product_id", "year")
                .agg(F.count(F.lit(1)).alias("o"), F.sum("u").alias("u"))
                .select("product_id", "year", z.alias("s"), "o", "u",
                        z.alias("rs"), z.alias("rc")))

    ratings = (t.reviews.where(_in_years("review_date", years))
               .groupBy("product_id", F.year("review_date").alias("year"))
               .agg(F.sum("rating").cast("bigint").alias("rs"),
                    F.count("rating").alias("rc"))
               .select("product_id", "year", z.alias("s"), z.alias("o"), z.alias("u"),
                       "rs", "rc"))
    if by_year is None:
        sold = line_measure(t.ordered).unionByName(line_measure(t.glasses_ordered))
    else:
        sold = by_year.where(F.col("year").isin(years)).select(
            "product_id", "year", z.alias("s"), "o", "u", z.alias("rs"), z.alias("rc"))
    measures = (searches.unionByName(sold).unionByName(ratings)
                .groupBy("product_id", "year")
                .agg(*[F.sum(c).alias(c) for c in ["s", "o", "u", "rs", "rc"]]))
    grid = t.products.select(
        "product_id", "name",
        F.explode(F.array(*[F.lit(y) for y in years])).alias("year"))
    zero = F.lit(0)
    return grid.join(measures, ["product_id", "year"], "left").select(
        "product_id", "name", F.col("year").cast("int").alias("year"),
        F.coalesce(F.col("s"), zero).cast("bigint").alias("total_searches"),
        F.coalesce(F.col("o"), zero).cast("bigint").alias("total_orders"),
        F.coalesce(F.col("u"), zero).cast("bigint").alias("total_units_sold"),
        round_ratio(F.col("rs"), F.col("rc"), 2, 4).alias("rating"))


def units_by_year_pivot(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Customised units per product in the listed years, one column each.

    Products whose sales all fall outside the years keep a row of zeros,
    as with the reference's PIVOT (the group exists, its cells are NULL).
    """
    years = list(p.years)
    sales = (t.glasses_ordered.join(t.orders.select("order_id", "order_date"), "order_id")
             .select("product_id", F.year("order_date").alias("sale_year"), "units"))
    pivot = sales.groupBy("product_id").pivot("sale_year", years).agg(F.sum("units"))
    return t.products.select("product_id", "name").join(pivot, "product_id").select(
        "product_id", "name",
        *[F.coalesce(F.col(str(y)), F.lit(0)).cast("bigint").alias(f"units_{y}") for y in years])
