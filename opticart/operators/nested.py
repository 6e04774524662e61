"""Subquery-shaped products: searched-never-bought (D04), low reviewers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticart.functions.numeric import idiv
from opticart.functions.skew import split_join
from opticart.params import DEFAULT, Params
from opticart.sources.conform import Tables


def searched_never_bought(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Searched products that no line of either table ever ordered.

    ``NOT IN`` is null-aware: a NULL product id among the lines empties the
    result. The searches are reduced to distinct ids first: the right side
    of a semi join is never split. Spark plans a null-aware anti join only as a broadcast of the
    whole subquery; here the line product ids are reduced to distinct
    values (partial aggregation), anti-joined by hash, and the NULL case is
    one uncorrelated EXISTS evaluated once.
    """
    line_ids = (t.ordered.select("product_id")
                .unionByName(t.glasses_ordered.select("product_id")))
    searched = t.products.select("product_id", "name").join(
        t.searches_for_products.select("product_id").distinct(), "product_id", "left_semi")
    has_null = line_ids.where(F.col("product_id").isNull()).exists()
    return (searched.join(line_ids.distinct(), "product_id", "left_anti")
            .where(~has_null)
            .distinct())


def below_average_reviewers(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Customers who rated some product below its (truncated) mean rating.

    AVG over an INT column truncates in the reference, so the mean is
    sum div count. The per-product means are a partial aggregate joined
    back to the reviews, with a hot product's reviews split over tasks; qualifying
    customers are reduced to distinct ids before the customer join.
    """
    r = t.reviews.select("customer_id", "product_id", "rating")
    mean = r.groupBy("product_id").agg(
        idiv(F.sum("rating"), F.count("rating")).alias("mean_rating"))
    low = (split_join(r, mean, ["product_id"], F.col("customer_id"))
           .where(F.col("rating") < F.col("mean_rating"))
           .select("customer_id").distinct())
    c = t.customers
    return (c.join(low, "customer_id")
            .select("customer_id",
                    F.concat(c["first_name"], F.lit(" "), c["last_name"]).alias("full_name"))
            .distinct())
