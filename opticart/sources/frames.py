"""Conformed tables from existing DataFrames (a metastore, or test frames).

Where the retail tables exist as such, wrap them here instead of deriving
them from the driver tables. Missing derived tables are computed the same
way ``Tables`` computes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NAMES = ("products", "base_frames", "customers", "customizations", "credit_cards",
         "orders", "ordered", "glasses_ordered", "versions", "selected",
         "searches", "searches_for_products", "reviews")


class FrameTables:
    """Same attribute surface as ``Tables``, backed by given DataFrames.

    ``orders`` must carry (order_id, order_date, card_number, country).
    """

    def __init__(self, spark: SparkSession, **frames: DataFrame):
        unknown = set(frames) - set(NAMES)
        if unknown:
            raise ValueError(f"unknown tables: {sorted(unknown)}")
        self.spark = spark
        self._frames = frames

    def __getattr__(self, name: str) -> DataFrame:
        frames = self.__dict__.get("_frames", {})
        if name in frames:
            return frames[name]
        if name == "versions":
            return self.glasses_ordered.select("product_id", "version").distinct()
        if name == "orders_geo":
            return frames["orders"]
        raise AttributeError(name)

    def refresh(self) -> "FrameTables":
        """Given frames stay as they are."""
        return self

    @property
    def orders(self) -> DataFrame:
        o = self._frames["orders"]
        return o.select("order_id", "order_date", "card_number")
