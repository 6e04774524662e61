"""Hot keys: one product holds a third of all lines and one country a third
of all orders. Every product over the conformed tables must still equal
its oracle (the oracle reads the same skewed frames in DuckDB)."""

import contextlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from opticart import oracle, registry
from opticart.functions import skew
from opticart.plans.inspect import plan_text
from opticart.sources.frames import FrameTables
from opticart.streaming import order_totals
from tests.helpers import same_result

HOT_PRODUCT = 3          # a customisable frame that exists in products
ONLY_CONFORMED = [k for k in registry.PRODUCTS
                  if k not in ("apply_line_deltas", "apply_custom_line_deltas",
                               "delete_latest_order_lines", "stream_order_totals",
                               "customer_intake_stream", "totals_kept_in_place",
                               "products_overview_kept", "product_annual_stats_kept",
                               "revenue_of_stored_totals")]
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture(scope="module")
def skewed(spark, tables):
    t = tables
    hot = F.col("order_id") % 3 == 0
    frames = {
        "products": t.products, "base_frames": t.base_frames, "customers": t.customers,
        "customizations": t.customizations, "credit_cards": t.credit_cards,
        "orders": t.orders_geo.withColumn(
            "country", F.when(F.col("order_id") % 3 == 1, F.lit("HOTLAND"))
            .otherwise(F.col("country"))),
        "ordered": t.ordered.withColumn(
            "product_id", F.when(hot, F.lit(HOT_PRODUCT + 1)).otherwise(F.col("product_id"))),
        "glasses_ordered": t.glasses_ordered.withColumn(
            "product_id", F.when(hot, F.lit(HOT_PRODUCT)).otherwise(F.col("product_id"))),
        "searches": t.searches,
        "searches_for_products": t.searches_for_products.withColumn(
            "product_id", F.when(F.col("customer_id") % 2 == 0, F.lit(HOT_PRODUCT))
            .otherwise(F.col("product_id"))),
        "reviews": t.reviews.withColumn(
            "product_id", F.when(F.col("review_id") % 3 == 0, F.lit(HOT_PRODUCT))
            .otherwise(F.col("product_id"))),
    }
    frames = {k: spark.createDataFrame(v.toPandas(), v.schema) for k, v in frames.items()}
    ft = FrameTables(spark, **frames)
    frames["versions"] = ft.versions
    frames["selected"] = t.selected.join(ft.versions, ["product_id", "version"], "left_semi")
    ft = FrameTables(spark, **frames)
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(name, df.toPandas())
    return ft, con


@pytest.mark.parametrize("name", ONLY_CONFORMED)
def test_hot_keys_match_oracle(skewed, name):
    ft, con = skewed
    fn = registry.PRODUCTS[name]
    sql = oracle.oracle_sql(derive_conformed=False)[name]
    same_result(fn(ft, registry.DEFAULT), con, sql)


def test_aqe_splits_the_hot_product_join(spark, tables):
    """With a third of the plain lines on one product, AQE splits that join
    partition (SortMergeJoin(skew=true)) and the totals do not change. The
    thresholds are scaled down to the test data; the input gets several map
    tasks, as a multi-file input has, since splits follow map outputs."""
    from opticart.operators import totals
    t = tables
    hot = F.col("order_id") % 3 == 0
    ft = FrameTables(spark, products=t.products, selected=t.selected,
                     customizations=t.customizations, versions=t.versions, orders=t.orders_geo,
                     ordered=t.ordered.withColumn("product_id", F.when(hot, F.lit(HOT_PRODUCT + 1))
                                                  .otherwise(F.col("product_id"))).repartition(8),
                     glasses_ordered=t.glasses_ordered)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        split = totals.order_totals(ft)
        rows = sorted(split.collect())
        assert "SortMergeJoin(skew=true)" in plan_text(split, "simple")
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        assert sorted(totals.order_totals(ft).collect()) == rows
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextlib.contextmanager
def settings(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


VERSION = "product_id, _listed, _version"
SPLIT = {"custom_buyer_spend": "product_id, version", "below_average_reviewers": "product_id",
         "rating_gap": "product_id", "customer_history": "product_id, version",
         "order_totals": VERSION, "revenue_vs_target": VERSION}


@pytest.mark.parametrize("name", sorted(SPLIT))
def test_hot_joins_are_split(spark, skewed, name):
    """The join that carries the hot key is dealt by (key, salt), also where the other
    side is an aggregate; the keys are measured in a subquery that both sides read."""
    with settings(spark, NO_BROADCAST):
        text = plan_text(registry.PRODUCTS[name](skewed[0], registry.DEFAULT), "simple")
    bare = re.sub(r"#\d+L?", "", text)
    assert f"hashpartitioning({SPLIT[name]}, _salt" in bare
    assert "approx_top_k" in bare and "Subquery" in bare


@pytest.mark.parametrize("name", sorted(SPLIT))
def test_split_joins_match_the_oracle(spark, skewed, name):
    ft, con = skewed
    with settings(spark, NO_BROADCAST):
        same_result(registry.PRODUCTS[name](ft, registry.DEFAULT), con,
                    oracle.oracle_sql(derive_conformed=False)[name])


def test_small_sides_are_joined_plainly(tables):
    from opticart.operators import nested
    text = plan_text(nested.below_average_reviewers(tables), "simple")
    assert "_salt" not in text and "approx_top_k" not in text


def hot_map(df, on, **kw):
    return df.sparkSession.range(1).select(skew.hot_keys(df, on, **kw).alias("m")).first().m


def test_only_hot_keys_are_found(spark):
    even = spark.range(0, 20_000, 1, 4).select((F.col("id") % 1000).alias("k"), "id")
    assert hot_map(even, ["k"], tasks=100) == {}
    third = even.withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("k")))
    found = hot_map(third, ["k"], tasks=100)
    assert found == {spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).first()[0]: 34}
    nulls = even.withColumn("k", F.when(F.col("id") % 2 == 0, None).otherwise(F.col("k")))
    assert hot_map(nulls, ["k", "id"], tasks=100) == {}
    assert list(hot_map(nulls, ["k"], tasks=100).values()) == [50]
    assert hot_map(even.limit(0), ["k"]) == {}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_is_the_join(spark, how):
    """With hot keys, NULL keys and repeated rows on both sides."""
    big = spark.range(0, 3000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 5 == 0, None)
        .otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    small = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    small = small.unionByName(small.where("k < 3"))
    with settings(spark, NO_BROADCAST):
        joined = skew.split_join(big, small, ["k"], F.col("v"), how)
        text = plan_text(joined, "simple")
        got = sorted(map(str, joined.collect()))
    assert "_salt" in text
    assert got == sorted(map(str, big.join(small, "k", how).collect()))


def test_a_hot_key_fills_no_task(spark):
    """Rows per task of the split join: the hot key is spread over tasks."""
    big = spark.range(0, 30_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 500).alias("k"),
        F.col("id").alias("v"))
    small = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    conf = NO_BROADCAST | {"spark.sql.shuffle.partitions": "16",
                           "spark.sql.adaptive.enabled": "false"}
    with settings(spark, conf):
        def tasks(df):
            return [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        sizes = tasks(skew.split_join(big, small, ["k"], F.col("v")))
        plain = tasks(big.join(small, "k"))
    assert sum(sizes) == sum(plain) == 30_000
    assert max(plain) > 10_000 and max(sizes) < 6_000


def change_set(spark, rows):
    """A change set with a third of the rows on one product."""
    return spark.createDataFrame(
        [("I" if i % 4 else "D", i % 900, HOT_PRODUCT if i % 3 == 0 else 3 * (i % 60), i % 5, i % 7)
         for i in range(rows)], "op string, order_id long, product_id long, version int, units int")


def test_hot_product_in_a_change_set(spark, tables):
    """D14 and D15 with a hot product give the same with and without the split."""
    from opticart.operators import totals
    t, changes = tables, change_set(spark, 4000)
    custom = sorted(map(str, totals.custom_line_deltas(t, changes).collect()))
    plain = sorted(map(str, totals.plain_line_deltas(t, changes).collect()))
    with settings(spark, NO_BROADCAST):
        split = totals.custom_line_deltas(t, changes)
        assert f"hashpartitioning({VERSION}, _salt" in re.sub(r"#\d+L?", "",
                                                              plan_text(split, "simple"))
        assert sorted(map(str, split.collect())) == custom
        assert sorted(map(str, totals.plain_line_deltas(t, changes).collect())) == plain


def test_searches_are_reduced_before_the_semi_join(skewed):
    from opticart.operators import nested
    text = plan_text(nested.searched_never_bought(skewed[0]), "simple")
    right = text[text.index("LeftSemi"):]
    assert "HashAggregate(keys=[product_id" in right


def test_one_change_set_is_dealt_to_several_tasks(spark):
    """A batch that is one change set does not meet its size in one task."""
    rows = spark.range(2000).selectExpr(
        "'I' op", "'plain' kind", "id order_id", "id % 7 product_id", "cast(null as int) version",
        "1 units", "if(id < 0, 2L, 1L) change_set", "2000L set_rows").localCheckpoint()
    before = spark.createDataFrame([], order_totals.SETS)
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled",
                                          "spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sets = order_totals.merged_sets(rows, before).withColumn("task", F.spark_partition_id())
        got = sets.groupBy("task").agg(F.count("*").alias("n"), F.max("open").alias("o")).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(r.n for r in got) == 2000 and not any(r.o for r in got)
    assert max(r.n for r in got) < 1000
