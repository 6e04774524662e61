"""Discounts for slow sellers (D18), the reference's set-based procedure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticart.functions.numeric import round_double
from opticart.params import DEFAULT, Params
from opticart.sources.conform import Tables


def low_seller_discounts(t: Tables, p: Params = DEFAULT,
                         stored: DataFrame | None = None) -> DataFrame:
    """Discount from the min-max scaled rating-per-unit of idle products.

    Per product: mean rating, plain units and days since the last plain
    order. The reference left-joins reviews and plain lines together, so
    each line repeats per review: units count max(reviews, 1) times (the
    mean is unaffected). Products idle for ``idle_days`` or never ordered
    qualify; their ratio is min-max scaled into [lower, upper] and rounded
    to 2 (equal min and max give ``upper``). The global min and max are
    one uncorrelated scalar subquery, not a window over all products.
    Products that do not qualify keep their discount of ``stored``
    (product_id, discount), by default the tables' stored column, or NULL without it.
    """
    if stored is None:
        stored = getattr(t, "stored_discounts", None)
    rv = t.reviews.groupBy("product_id").agg(
        F.sum("rating").alias("_rs"), F.count("rating").alias("_rc"),
        F.count(F.lit(1)).alias("_nrev"))
    pl = (t.ordered.join(t.orders.select("order_id", "order_date"), "order_id", "left")
          .groupBy("product_id")
          .agg(F.sum("units").alias("_units"), F.max("order_date").alias("_last")))
    stats = (t.products.select("product_id", "name", "price")
             .join(rv, "product_id", "left").join(pl, "product_id", "left"))
    avg_rating = F.col("_rs").cast("double") / F.when(F.col("_rc") > 0, F.col("_rc"))
    units = F.coalesce(F.col("_units"), F.lit(0)) * F.greatest(
        F.coalesce(F.col("_nrev"), F.lit(0)), F.lit(1))
    days = F.datediff(F.lit(p.as_of), F.col("_last"))
    ratio = F.when(units == 0, avg_rating).otherwise(avg_rating / units)
    stats = stats.select("product_id", "name", "price",
                         ((days >= p.idle_days) | days.isNull()).alias("_idle"),
                         ratio.alias("_ratio"))
    bounds = (stats.where(F.col("_idle"))
              .agg(F.struct(F.max("_ratio").alias("hi"), F.min("_ratio").alias("lo")))
              .scalar())
    # Project the subquery once; the expression below reads its fields.
    stats = stats.withColumn("_b", bounds)
    hi, lo = F.col("_b.hi"), F.col("_b.lo")
    lower, upper = F.lit(p.lower_discount), F.lit(p.upper_discount)
    scaled = F.when(hi == lo, upper).otherwise(
        lower + ((F.col("_ratio") - lo) / F.when(hi - lo != 0, hi - lo)) * (upper - lower))
    kept = F.lit(None).cast("double")
    if stored is not None:
        stats = stats.join(stored.select("product_id", F.col("discount").alias("_kept")),
                           "product_id", "left")
        kept = F.col("_kept").cast("double")
    return stats.select("product_id", "name", "price",
                        F.when(F.col("_idle"), round_double(scaled, 2)).otherwise(kept)
                        .alias("discount"))
