"""Window-function products: quarterly rank (D06), search quartile (D07),
country efficiency (D08)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opticart.functions.blocks import gap_aggregates, positive
from opticart.functions.distinct import bits_of, count_bits, word_of
from opticart.functions.numeric import idiv, money_cents, round_ratio
from opticart.functions.selection import first_bucket
from opticart.operators.common import grouped_revenue, orders_between
from opticart.params import DEFAULT, Params
from opticart.sources.conform import Tables

MONEY_OUT = "decimal(38,2)"


def quarterly_revenue_rank(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Revenue per (year, quarter), its rank in the year, same quarter last year.

    Lines are joined to the orders of the look-back window (a pushed range
    filter), units are reduced per (year, quarter, product, version) before
    pricing, and the result has at most a few dozen (year, quarter) rows;
    the two windows run on that small result.
    LAG is the previous *present* year, and the oldest year in the window
    has none.
    """
    start = dt.date(p.as_of.year - p.revenue_lookback_years, 1, 1)
    orders = orders_between(t, start).select(
        "order_id", F.year("order_date").alias("year"), F.quarter("order_date").alias("quarter"))
    q = grouped_revenue(t, orders, ["year", "quarter"]).select(
        "year", "quarter", F.col("revenue").cast(MONEY_OUT).alias("quarterly_revenue"))
    by_year = Window.partitionBy("year").orderBy(F.col("quarterly_revenue").desc())
    by_quarter = Window.partitionBy("quarter").orderBy("year")
    prev = F.lag("quarterly_revenue").over(by_quarter)
    return q.select(
        "year", "quarter", "quarterly_revenue",
        F.rank().over(by_year).cast("int").alias("quarter_rank"),
        prev.cast(MONEY_OUT).alias("same_quarter_last_year"),
        (F.col("quarterly_revenue") - prev).cast(MONEY_OUT).alias("revenue_change"),
    )


def search_to_order_quartile(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Customers in the top quartile of searches per order.

    Distinct searches and distinct orders come from two separate
    per-customer aggregates (the reference's searches x cards x orders
    fan-out is never built). The mean gap between searches uses every
    search row and truncates (AVG of INT). The quartile's boundary is found by
    exact selection, so no customer is sorted or moved for it; customers
    without orders have a NULL ratio and rank last.
    """
    s = t.searches.groupBy("customer_id").agg(
        F.countDistinct("dt").alias("number_of_searches"), *gap_aggregates("dt"))
    o = (t.orders.select("order_id", "card_number")
         .join(t.credit_cards, "card_number")
         .groupBy("customer_id").agg(F.count(F.lit(1)).alias("number_of_orders")))
    c = t.customers
    base = (c.join(s, "customer_id", "left").join(o, "customer_id", "left")
            .select(
                "customer_id",
                F.concat(c["first_name"], F.lit(" "), c["last_name"]).alias("full_name"),
                F.coalesce("number_of_searches", F.lit(0)).alias("number_of_searches"),
                F.coalesce("number_of_orders", F.lit(0)).alias("number_of_orders"),
                F.when(F.col("n_gaps") > 0, idiv(F.col("span_days"), F.col("n_gaps")))
                .cast("int").alias("avg_days_between_searches")))
    key = (F.col("number_of_searches").cast("double")
           / positive(F.col("number_of_orders")).cast("double"))
    keyed = base.withColumn("_key", key)
    top = keyed.where(first_bucket(keyed, p.quartiles, "_key", "customer_id"))
    return top.select(
        "customer_id", "full_name",
        F.col("number_of_searches").cast("bigint").alias("number_of_searches"),
        F.col("number_of_orders").cast("bigint").alias("number_of_orders"),
        round_ratio(F.col("number_of_searches"), F.col("number_of_orders"), 3, 10).alias("ratio"),
        F.lit(1).alias("quartile"), "avg_days_between_searches")


def country_efficiency(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Per country mean days between orders, customers, orders, revenue,
    revenue share and revenue per gap day.

    Mean gap: telescoped LAG (span / (dated orders - 1)), a partial
    aggregate instead of one sorted window per country. Countries with
    fewer than two dated orders or no carded order, and the NULL country,
    drop out (the reference's inner joins) before the share's denominator
    is taken. Orders without a card count in revenue, not in customers.
    """
    og = t.orders_geo
    # One pass over the orders: the card join cannot duplicate an order
    # (card number is the cards' key), so the gap statistics over all dated
    # orders and the counts over carded orders share one aggregate, in which
    # only the customers have to be told apart.
    # A country needs two dated orders (a gap) and one carded order.
    facts = og.select("order_id", "order_date", "card_number", "country").join(
        t.credit_cards, "card_number", "left")
    # The customers are words of a bitmap, folded with the rest per country.
    words = facts.groupBy("country", word_of("customer_id").alias("_word")).agg(
        bits_of("customer_id").alias("_bits"), F.min("order_date").alias("_first"),
        F.max("order_date").alias("_last"), F.count("order_date").alias("_dated"),
        F.count(F.when(F.col("customer_id").isNotNull(), F.col("order_id"))).alias("_carded"))
    stats = (words.groupBy("country").agg(
                 F.datediff(F.max("_last"), F.min("_first")).alias("span_days"),
                 (F.sum("_dated") - F.lit(1)).alias("n_gaps"),
                 count_bits("_bits").alias("active_customers"),
                 F.sum("_carded").alias("total_orders"))
             .where(F.col("country").isNotNull()      # the reference's joins drop it
                    & (F.col("n_gaps") > 0) & (F.col("total_orders") > 0)))
    # Countries whose orders have no lines keep revenue 0 (left join).
    revenue = grouped_revenue(t, og.select("order_id", "country"), ["country"])
    combined = (stats.join(revenue, "country", "left")
                .withColumn("total_revenue", F.coalesce(F.col("revenue"), F.lit(0)))
                .withColumn("_cents", money_cents(F.col("total_revenue"))))
    # One row per surviving country: the window total runs on a tiny input.
    all_cents = F.sum("_cents").over(Window.partitionBy())
    return combined.select(
        "country",
        round_ratio(F.col("span_days"), F.col("n_gaps"), 2, 10).alias("avg_days_between_orders"),
        F.col("active_customers").cast("bigint").alias("active_customers"),
        F.col("total_orders").cast("bigint").alias("total_orders"),
        F.col("total_revenue").cast("decimal(20,2)").alias("total_revenue"),
        round_ratio(F.col("_cents"), all_cents, 4, 5).alias("revenue_share"),
        round_ratio(F.col("_cents") * F.col("n_gaps"), F.col("span_days") * 100, 2, 20)
        .alias("efficiency"),
    )
