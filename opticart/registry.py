"""Registry of data products: key -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opticart.operators import (annual, discounts, history, intake, kept, nested, overview,
                                sales, totals, windows)
from opticart.params import DEFAULT, Params
from opticart.streaming import intake as intake_stream
from opticart.streaming import order_totals as streaming
from opticart.session import ensure_checkpoint_dir
from opticart.sources.conform import Tables

Query = Callable[[SparkSession, str], DataFrame]

# key -> function(Tables, Params) -> DataFrame
PRODUCTS = {
    "custom_buyer_spend": sales.custom_buyer_spend,
    "top_products_by_units": sales.top_products_by_units,
    "top_products_by_units_split": sales.top_products_by_units_split,
    "searched_never_bought": nested.searched_never_bought,
    "below_average_reviewers": nested.below_average_reviewers,
    "quarterly_revenue_rank": windows.quarterly_revenue_rank,
    "search_to_order_quartile": windows.search_to_order_quartile,
    "country_efficiency": windows.country_efficiency,
    "products_overview": overview.products_overview,
    "top_rated_products": overview.top_rated_products,
    "rating_gap": overview.rating_gap,
    "customer_history": history.customer_history_all,
    "order_totals": totals.order_totals_all,
    "apply_line_deltas": totals.plain_deltas_applied,
    "apply_custom_line_deltas": totals.custom_deltas_applied,
    "totals_kept_in_place": totals.totals_kept_in_place,
    "products_overview_kept": kept.overview_kept,
    "product_annual_stats_kept": kept.annual_stats_kept,
    "revenue_of_stored_totals": kept.revenue_of_stored_totals,
    "delete_latest_order_lines": totals.remaining_after_returns,
    "low_seller_discounts": discounts.low_seller_discounts,
    "product_annual_stats": annual.product_annual_stats,
    "revenue_vs_target": totals.revenue_by_year,
    "units_by_year_pivot": annual.units_by_year_pivot,
    "customer_intake": intake.customer_intake,
    "stream_order_totals": streaming.stream_order_totals,
    "customer_intake_stream": intake_stream.customer_intake_stream,
}


def _bind(fn, params: Params, discounts: str | None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return fn(Tables(spark, sf_dir, discounts), params)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries(params: Params = DEFAULT, discounts: str | None = None) -> dict[str, Query]:
    """The products; ``discounts`` is a snapshot that holds the stored discount column."""
    return {key: _bind(fn, params, discounts) for key, fn in PRODUCTS.items()}
