"""Shared building blocks B1-B3 (B4, global ranking, is in ranking.py)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opticart.functions.skew import fits_broadcast, split_join

VKEY = ["product_id", "version"]


# ------------------------------------------------------------------ B1
def version_extras(selected: DataFrame, customizations: DataFrame,
                   versions: DataFrame | None = None) -> DataFrame:
    """Per (product_id, version): matched options ``n_feat`` and ``sum_extra``.

    ``sum_extra`` ignores NULL extras and is NULL when no matched option
    has a price. Versions with no matched option have no row. When
    ``versions`` is given only listed versions are kept (the sites that
    inner-join VERSIONS). The customisation catalogue is a small dimension
    (features x selections); the planner broadcasts it by its size estimate.
    """
    opts = selected.join(customizations, ["feature", "selection"])
    out = opts.groupBy(*VKEY).agg(
        F.count(F.lit(1)).alias("n_feat"),
        F.sum("extra_price").alias("sum_extra"),
    )
    if versions is not None:
        out = out.join(versions.select(*VKEY), VKEY, "left_semi")
    return out


def version_prices(versions: DataFrame, products: DataFrame, extras: DataFrame,
                   base_frames: DataFrame | None = None) -> DataFrame:
    """(product_id, version, total_price = price + coalesce(sum_extra, 0)).

    One row per listed version whose product exists; ``base_frames``
    restricts to customisable frames (the customer-history sites).
    """
    v = versions.select(*VKEY)
    if base_frames is not None:
        v = v.join(base_frames.select("product_id"), "product_id", "left_semi")
    return (v.join(products.select("product_id", "price"), "product_id")
            .join(extras.select(*VKEY, "sum_extra"), VKEY, "left")
            .select(*VKEY, (F.col("price") + F.coalesce(F.col("sum_extra"), F.lit(0)))
                    .alias("total_price")))


def with_version_prices(lines: DataFrame, products: DataFrame, extras: DataFrame,
                        by: Column, measure: DataFrame | None = None) -> DataFrame:
    """Customised lines with ``price`` of the product and ``sum_extra`` of the version.

    Lines of unknown products drop out; the extras of versions without options
    are NULL. Products small enough are broadcast, and only the join with the
    extras moves the lines, splitting hot versions (``measure``: see there).
    Otherwise the (product, version) pairs that the lines hold are priced first,
    so that the lines still move once.
    """
    prices = products.select("product_id", "price")
    extras = extras.select(*VKEY, "sum_extra")
    if fits_broadcast(prices):
        return split_join(lines.join(prices, "product_id"), extras, VKEY, by, "left",
                          measure=lines if measure is None else measure)

    def keyed(df: DataFrame) -> DataFrame:      # a NULL version is a key of its own here
        return df.withColumns({"_listed": F.col("version").isNotNull(),
                               "_version": F.coalesce("version", F.lit(0))})

    key = ["product_id", "_listed", "_version"]
    book = (keyed(lines.select(*VKEY).distinct()).join(prices, "product_id")
            .join(extras, VKEY, "left").select(*key, "price", "sum_extra"))
    measured = None if measure is None else keyed(measure.select(*VKEY))
    return split_join(keyed(lines), book, key, by, measure=measured).drop("_listed", "_version")


def price_glasses_lines(glasses: DataFrame, products: DataFrame, extras: DataFrame) -> DataFrame:
    """Customised lines with ``unit_price`` = price + coalesce(sum_extra, 0).

    Prices by product and options only, without the VERSIONS table (the
    order-total maintenance): lines of unknown products drop out, lines of
    versions without options pay the base price.
    """
    return (with_version_prices(glasses, products, extras, F.col("order_id"))
            .withColumn("unit_price",
                        F.col("price") + F.coalesce(F.col("sum_extra"), F.lit(0)))
            .drop("price", "sum_extra"))


def price_plain_lines(ordered: DataFrame, products: DataFrame) -> DataFrame:
    """Plain lines with ``unit_price`` (lines of unknown products drop out)."""
    return (ordered.join(products.select("product_id", "price"), "product_id")
            .withColumnRenamed("price", "unit_price"))


# ------------------------------------------------------------------ B2
def all_lines(ordered: DataFrame, glasses: DataFrame,
              cols: Sequence[str] = ("order_id", "product_id", "units")) -> DataFrame:
    """Bag union of plain and customised lines on the given columns."""
    return ordered.select(*cols).unionByName(glasses.select(*cols))


# ------------------------------------------------------------------ B3
def gap_aggregates(date_col: str, span: str = "span_days", gaps: str = "n_gaps") -> list[Column]:
    """Aggregate expressions: ``span`` = datediff(max, min), ``gaps`` = count - 1.

    The LAG gaps of an ordered date list telescope, so their sum is the
    span and their number is the count of non-NULL dates minus one. As
    plain aggregates they join any other per-group aggregate: no sort, no
    window, and a hot group costs one row per map task.
    """
    return [F.datediff(F.max(date_col), F.min(date_col)).alias(span),
            (F.count(date_col) - F.lit(1)).alias(gaps)]


def gap_span(df: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """Per group of ``keys``: the gap aggregates of ``date_col``."""
    return df.groupBy(*keys).agg(*gap_aggregates(date_col))


def positive(c: Column) -> Column:
    """NULL unless c > 0 (NULLIF-style guard for denominators)."""
    return F.when(c > 0, c)
