"""Materialised conformed layer with co-located order data.

Most products join lines to orders on order_id and reduce per order. When
the conformed tables are written once with orders, plain lines and
customised lines bucketed (and sorted) by order_id into the same number of
buckets, those joins and per-order aggregates read matching buckets
without a shuffle. The other conformed tables are written as plain
Parquet, so the fixture's derivations (cards, versions, options, events)
run once instead of in every product.

Tables are registered in the session catalog as external tables whose
files live under ``location`` (a shared folder on a cluster).

A bucketed scan has no shuffle, so AQE cannot split a hot bucket. Order
ids make good bucket keys because an order's lines are few; where one key
could hold a large share of the rows, pass ``buckets=0`` to materialise
without bucketing and keep the shuffle (and AQE's skew split).
"""

from __future__ import annotations

from opticart.sources.conform import Tables
from opticart.sources.frames import NAMES, FrameTables

CO_LOCATED = ("orders", "ordered", "glasses_ordered")


def materialize(t: Tables, location: str, buckets: int, prefix: str = "opticart") -> FrameTables:
    """Write the conformed layer under ``location``; return tables over it."""
    spark = t.spark
    location = location.rstrip("/")
    frames = {}
    for name in NAMES:
        df = t.orders_geo if name == "orders" else getattr(t, name)
        table = f"{prefix}_{name}"
        writer = df.write.mode("overwrite").option("path", f"{location}/{name}")
        if buckets and name in CO_LOCATED:
            writer = writer.bucketBy(buckets, "order_id").sortBy("order_id")
        writer.saveAsTable(table)
        frames[name] = spark.table(table)
    return FrameTables(spark, **frames)
