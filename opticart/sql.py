"""SQL surface: the retail schema, its views and functions as Spark SQL objects.

``register(spark, tables)`` creates session-scoped temporary views for the
conformed tables, for the reference's three views and for every lazily
built data product (named by its key), plus a table function and a scalar
function with the reference's shapes, so SQL users can keep writing

    SELECT * FROM products_overview
    SELECT TOP-style ... ORDER BY rating DESC LIMIT 10
    SELECT *, get_rating_gap(review_id) AS gap FROM reviews WHERE ...
    SELECT * FROM customer_history(3)

The objects are backed by the DataFrame products, so Catalyst plans them
the same way (a filter on the table function's argument reaches the card
scan; the scalar function is decorrelated into a join).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from opticart import registry
from opticart.operators import annual, history, intake, overview, totals
from opticart.params import DEFAULT, Params

# Products that run a job while being built (ranking checkpoints, stream
# replays) are not registered as views; call them from Python.
EAGER = ("search_to_order_quartile", "customer_intake", "stream_order_totals",
         "customer_intake_stream", "totals_kept_in_place",
         "products_overview_kept", "product_annual_stats_kept", "revenue_of_stored_totals")

TABLES = ("customers", "credit_cards", "products", "base_frames", "ordered",
          "glasses_ordered", "versions", "selected", "customizations", "searches",
          "searches_for_products", "reviews")


def register(spark: SparkSession, t, p: Params = DEFAULT) -> list[str]:
    """Register views and functions; returns the names created."""
    names = []
    for name in TABLES:
        getattr(t, name).createOrReplaceTempView(name)
        names.append(name)
    t.orders_geo.createOrReplaceTempView("orders")
    views = {
        "products_overview": overview.products_overview(t, p),
        "product_annual_stats": annual.product_annual_stats(t, p),
        "order_totals": totals.order_totals(t),
        "revenue_by_year": totals.revenue_by_year(t, p),
        "customer_history_all": history.customer_history(t),
        "review_gaps": overview.review_gaps(t),
    }
    for key, fn in registry.PRODUCTS.items():
        if key not in EAGER and key not in views:
            views[key] = fn(t, p)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    names += ["orders", *views]
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION customer_history(cid BIGINT)
        RETURNS TABLE (order_id BIGINT, order_date DATE, total_units BIGINT,
                       total_cost DECIMAL(38,2))
        RETURN SELECT order_id, order_date, total_units, total_cost
               FROM customer_history_all WHERE customer_id = cid""")
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION get_rating_gap(rid BIGINT)
        RETURNS DOUBLE
        RETURN (SELECT gap FROM review_gaps WHERE review_id = rid)""")
    return names + ["customer_history()", "get_rating_gap()"]


def register_intake(spark: SparkSession, routed: str) -> list[str]:
    """The two tables an intake inserts into, as views on its one table: ``new_customers``
    and ``email_error_log``. They show the versions finished when this is called."""
    rows = intake.read_routed(spark, routed)
    intake.accepted_customers(rows).createOrReplaceTempView("new_customers")
    intake.email_error_log(rows).createOrReplaceTempView("email_error_log")
    return ["new_customers", "email_error_log"]
