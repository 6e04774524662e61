"""A layout for date ranges and for look-ups of one customer or order.

What the original's indexes are for, as partitions and file statistics:

* orders by year, within a year sorted by card: a date range reads the files of its
  years only, and Bloom filters on card and order number skip row groups;
* both line tables by a bucket of the order, sorted by order, with Bloom filters on the
  order number: the lines of some orders are read from the buckets of those orders
  (dynamic partition pruning; the bucket is part of the join key);
* ``card_orders``, the orders of each customer by a bucket of the customer: one
  customer's orders are one partition, without a join of cards and orders.

``LaidOutTables`` has the surface of the conformed tables, and ``orders_between``,
``orders_of`` and ``lines_of``, which the products use where tables have them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opticart.sources.conform import Tables
from opticart.sources.frames import NAMES, FrameTables

LINES = ("ordered", "glasses_ordered")
YEAR, ORDER_BUCKET, CUSTOMER_BUCKET = "order_year", "order_bucket", "customer_bucket"


def _bucket(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class LaidOutTables(FrameTables):
    """The tables under ``location``, as written by ``lay_out``."""

    def __init__(self, spark: SparkSession, location: str, buckets: int):
        self.buckets = buckets
        read = {name: spark.read.parquet(f"{location}/{name}") for name in NAMES}
        super().__init__(spark, **read)
        self.card_orders = spark.read.parquet(f"{location}/card_orders")

    def __getattr__(self, name: str) -> DataFrame:
        table = super().__getattr__(name)
        return table.drop(ORDER_BUCKET) if name in LINES else table

    @property
    def orders_geo(self) -> DataFrame:
        return self._frames["orders"].drop(YEAR)

    def orders_between(self, first: dt.date, end: dt.date | None = None) -> DataFrame:
        """Orders from ``first`` up to before ``end``: only their years' files are read."""
        day, year = F.col("order_date"), F.col(YEAR)
        wanted = (day >= F.lit(first)) & (year >= first.year)
        if end is not None:
            last = end - dt.timedelta(days=1)
            wanted &= (day < F.lit(end)) & (year <= last.year)
        return self._frames["orders"].where(wanted).select("order_id", "order_date", "card_number")

    def orders_of(self, customer_id: int) -> DataFrame:
        """(customer_id, order_id, order_date) of a customer: one partition of ``card_orders``."""
        mine = _bucket(F.lit(customer_id).cast("bigint"), self.buckets)
        return self.card_orders.where((F.col(CUSTOMER_BUCKET) == mine)
                                      & (F.col("customer_id") == F.lit(customer_id))).select(
            "customer_id", "order_id", "order_date")

    def lines_of(self, name: str, ids: DataFrame) -> DataFrame:
        """The lines of a line table whose order is in ``ids`` (order_id): only the buckets
        of those orders are read."""
        keyed = ids.select("order_id", _bucket("order_id", self.buckets).alias(ORDER_BUCKET))
        return self._frames[name].join(keyed, [ORDER_BUCKET, "order_id"], "left_semi").drop(
            ORDER_BUCKET)


def _write(df: DataFrame, path: str, partition: str, order: list[str], blooms: list[str]) -> None:
    """One file per partition, sorted, with Bloom filters on some columns."""
    writer = df.repartition(partition).sortWithinPartitions(partition, *order).write.mode(
        "overwrite").partitionBy(partition)
    for column in blooms:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def lay_out(t: Tables, location: str, buckets: int) -> LaidOutTables:
    """Write the conformed tables of ``t`` under ``location`` in this layout."""
    location = location.rstrip("/")
    for name in NAMES:
        path = f"{location}/{name}"
        if name == "orders":
            # a year may be a large share of the orders: its rows go to several tasks
            orders = t.orders_geo.withColumn(YEAR, F.year("order_date"))
            ranged = orders.repartitionByRange(YEAR, "card_number").sortWithinPartitions(
                YEAR, "card_number")
            (ranged.write.mode("overwrite").partitionBy(YEAR)
             .option("parquet.bloom.filter.enabled#card_number", "true")
             .option("parquet.bloom.filter.enabled#order_id", "true").parquet(path))
        elif name in LINES:
            lines = getattr(t, name).withColumn(ORDER_BUCKET, _bucket("order_id", buckets))
            _write(lines, path, ORDER_BUCKET, ["order_id"], ["order_id"])
        else:
            getattr(t, name).write.mode("overwrite").parquet(path)
    owned = (t.orders.join(t.credit_cards, "card_number")
             .select("customer_id", "card_number", "order_id", "order_date")
             .withColumn(CUSTOMER_BUCKET, _bucket(F.col("customer_id").cast("bigint"), buckets)))
    _write(owned, f"{location}/card_orders", CUSTOMER_BUCKET, ["customer_id", "order_date"],
           ["customer_id"])
    return LaidOutTables(t.spark, location, buckets)
