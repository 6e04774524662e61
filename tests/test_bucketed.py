"""A materialised, order-bucketed conformed layer gives the same results,
and lines meet orders without a shuffle on the order key."""

from opticart.operators import history, sales, totals, windows
from opticart.plans.inspect import plan_text
from opticart.session import shared_path
from opticart.sources.bucketed import materialize


def test_bucketed_layer(spark, tables):
    bt = materialize(tables, shared_path(spark, "warehouse"), buckets=4, prefix="bkt")
    for fn in (sales.top_products_by_units_split, windows.country_efficiency,
               totals.order_totals, history.customer_history):
        assert sorted(fn(tables).collect()) == sorted(fn(bt).collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_text(sales.top_products_by_units_split(bt), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin [order_id" in plan
    assert "Exchange hashpartitioning(order_id" not in plan
