"""The SQL surface returns what the DataFrame products return."""

from opticart import sql
from opticart.operators import history, overview


def test_sql_objects_match_products(spark, tables):
    sql.register(spark, tables)
    one = spark.sql("SELECT * FROM customer_history(3)")
    ref = history.customer_history(tables, 3).drop("customer_id")
    assert sorted(one.collect()) == sorted(ref.collect())

    top = spark.sql("SELECT product_id FROM products_overview "
                    "ORDER BY rating DESC, product_id LIMIT 10").collect()
    assert [r[0] for r in top] == [r[0] for r in overview.top_rated_products(tables).collect()]

    y = overview.DEFAULT.review_as_of.year
    gaps = spark.sql(f"""SELECT review_id, get_rating_gap(review_id) AS gap FROM reviews
                         WHERE year(review_date) = {y} AND get_rating_gap(review_id) < -2""")
    ref = overview.rating_gap(tables).select("review_id", "gap")
    assert sorted(gaps.collect()) == sorted(ref.collect())
    assert spark.sql("SELECT count(*) FROM revenue_by_year").first()[0] > 0


def test_table_function_applies_per_row(spark, tables):
    """customer_history() applied per customer with LATERAL, as CROSS APPLY."""
    sql.register(spark, tables)
    lateral = spark.sql("""
        SELECT c.customer_id, h.order_id, h.total_units, h.total_cost
        FROM customers c, LATERAL customer_history(c.customer_id) h
        WHERE c.customer_id IN (3, 4, 5)""")
    ref = (history.customer_history(tables)
           .where("customer_id IN (3, 4, 5)")
           .select("customer_id", "order_id", "total_units", "total_cost"))
    assert sorted(lateral.collect()) == sorted(ref.collect())


def test_products_are_views(spark, tables):
    from opticart.operators import windows
    names = sql.register(spark, tables)
    assert "country_efficiency" in names and "search_to_order_quartile" not in names
    assert (spark.sql("SELECT count(*) FROM country_efficiency").first()[0]
            == windows.country_efficiency(tables).count())
