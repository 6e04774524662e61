"""Stored order totals: recompute (D13), apply change sets (D14, D15),
delete lines of latest orders (D17), yearly revenue and target (D20).

The reference keeps ORDERS.Total_Amount current with triggers. Without a
table format that supports UPDATE, each step here returns a new snapshot
of the totals as a DataFrame; ``sources.sinks`` writes it to a new
versioned folder. Where few orders change, ``keep_totals`` applies the same
rules to a table in buckets and rewrites only the buckets of those orders.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opticart.functions.blocks import VKEY, version_extras, with_version_prices
from opticart.functions.email import collated
from opticart.operators.common import stored_line_amounts
from opticart.params import DEFAULT, Params
from opticart.session import shared_path
from opticart.sources.bucket_table import BucketTable, buckets_for
from opticart.sources.conform import Tables

# DECIMAL(10,2) in the reference; widened so a large order cannot overflow.
TOTAL = "decimal(18,2)"


DELTA_COLUMNS = ("plus", "minus", "n_plus", "n_minus")


def _signed_sums(amount: Column) -> list[Column]:
    """Sums and row counts of the inserted and of the deleted rows."""
    out = []
    for name, op in (("plus", "I"), ("minus", "D")):
        mine = F.col("op") == op
        out += [F.sum(F.when(mine, amount)).alias(name),
                F.count(F.when(mine, F.lit(1))).alias(f"n_{name}")]
    return out


def _of_rows(name: str) -> Column:
    """The sum of one kind of rows; 0 where there are none."""
    return F.when(F.coalesce(F.col(f"n_{name}"), F.lit(0)) > 0, F.col(name)).otherwise(F.lit(0))


# ------------------------------------------------------------------ D13
def order_totals(t: Tables, plain: DataFrame | None = None,
                 glasses: DataFrame | None = None, geo: bool = True) -> DataFrame:
    """Every order with total_amount recomputed from its lines.

    Lines are priced (customised ones with their options' extras, no
    VERSIONS join) and reduced per order, then left-joined to all orders,
    so orders without lines get 0. ``geo=False`` leaves out the country
    (and with it the fixture's customer join) for readers that do not use it.
    """
    plain = t.ordered if plain is None else plain
    glasses = t.glasses_ordered if glasses is None else glasses
    per_order = stored_line_amounts(t, plain, glasses).groupBy("order_id").agg(
        F.sum("amount").alias("_sum"))
    orders = t.orders_geo if geo else t.orders
    cols = ["order_id", "order_date", "card_number"] + (["country"] if geo else [])
    return orders.join(per_order, "order_id", "left").select(
        *cols, F.coalesce(F.col("_sum"), F.lit(0)).cast(TOTAL).alias("total_amount"))


def order_totals_all(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """Every order with its total recomputed from all current lines."""
    return order_totals(t)


# ------------------------------------------------------------------ D14
def plain_line_deltas(t: Tables, changes: DataFrame) -> DataFrame:
    """(order_id, plus, minus, n_plus, n_minus) of a plain-line change set.

    Op 'I' adds, 'D' removes. The two triggers run one after the other and
    each sums its own rows, so the sums stay apart, with the number of rows
    they come from: a sum is NULL when all its amounts are.
    """
    amount = F.col("units") * F.col("price")
    return (changes.join(t.products.select("product_id", "price"), "product_id")
            .groupBy("order_id").agg(*_signed_sums(amount)))


def apply_line_deltas(totals: DataFrame, deltas: DataFrame) -> DataFrame:
    """D14 rule: total + plus - minus for changed orders; a stored NULL and a
    NULL sum of present rows make the total NULL."""
    return (totals.join(deltas, "order_id", "left")
            .withColumn("total_amount",
                        (F.col("total_amount") + _of_rows("plus") - _of_rows("minus")).cast(TOTAL))
            .drop(*DELTA_COLUMNS))


# ------------------------------------------------------------------ D15
def custom_line_deltas(t: Tables, changes: DataFrame) -> DataFrame:
    """(order_id, plus, minus, n_plus, n_minus) of a customised-line change set.

    Per change set and (order, product, version) group of c rows the
    reference sums the extras over rows x options, so every row of the
    group pays c times its version's extras. Rows are grouped first, but a
    hot product in many orders stays hot, so its groups are split over tasks
    where they meet the prices.
    """
    ext = version_extras(t.selected, t.customizations, versions=t.versions)
    groups = changes.groupBy("op", "order_id", *VKEY).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("units").alias("_units"))
    priced = with_version_prices(groups, t.products, ext, F.col("order_id"), measure=changes)
    extra = F.col("_rows") * F.coalesce(F.col("sum_extra"), F.lit(0))
    amount = F.col("_units") * (F.col("price") + extra)
    return priced.groupBy("order_id").agg(*_signed_sums(amount))


def apply_custom_line_deltas(totals: DataFrame, deltas: DataFrame) -> DataFrame:
    """D15 rule: coalesce(total, 0) + plus - minus for changed orders; a NULL
    sum of present rows makes the total NULL until the next trigger."""
    old = F.col("total_amount")
    added = F.when(F.coalesce(F.col("n_plus"), F.lit(0)) > 0,
                   F.coalesce(old, F.lit(0)) + F.col("plus")).otherwise(old)
    return (totals.join(deltas, "order_id", "left")
            .withColumn("_added", added)
            .withColumn("total_amount", F.when(
                F.coalesce(F.col("n_minus"), F.lit(0)) > 0,
                F.coalesce(F.col("_added"), F.lit(0)) - F.col("minus"))
                .otherwise(F.col("_added")).cast(TOTAL))
            .drop("_added", *DELTA_COLUMNS))


def stored_totals_before(t: Tables) -> DataFrame:
    """Totals as stored before the change set: fulfilled lines only."""
    return order_totals(t, t.line_base(False), t.line_base(True))


def plain_deltas_applied(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """D14 over the data: stored totals plus the plain-line change set."""
    return apply_line_deltas(stored_totals_before(t), plain_line_deltas(t, t.line_changes(False)))


def custom_deltas_applied(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """D15 over the data: stored totals plus the customised-line change set."""
    return apply_custom_line_deltas(stored_totals_before(t),
                                    custom_line_deltas(t, t.line_changes(True)))


def keep_totals(stored: BucketTable, change_set: int, plain: DataFrame | None = None,
                custom: DataFrame | None = None) -> list[int]:
    """UPDATE ... FROM on a stored table of totals: the per-order deltas of one change set
    of plain lines (D14) or of customised lines (D15). Returns the buckets rewritten."""
    if (plain is None) == (custom is None):
        raise ValueError("a change set is of plain or of customised lines")
    if plain is not None:
        return stored.update(plain, change_set, apply_line_deltas)
    return stored.update(custom, change_set, apply_custom_line_deltas)


TOTAL_BUCKETS = 16      # of the replay, at least; a deployment takes a few hundred MB per bucket


def totals_kept_in_place(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """D14 and D15 over the data, on a stored table: totals of the fulfilled lines, changed
    by the plain-line change set and then by that of the customised lines."""
    stored = BucketTable.create(stored_totals_before(t), shared_path(t.spark, "totals"),
                                "order_id", buckets_for(t.raw("orders"), TOTAL_BUCKETS))
    keep_totals(stored, 1, plain=plain_line_deltas(t, t.line_changes(False)))
    keep_totals(stored, 2, custom=custom_line_deltas(t, t.line_changes(True)))
    return stored.read()


# ------------------------------------------------------------------ D17
def resolve_emails(t: Tables, collation: str = "") -> DataFrame:
    """(email, customer_id) for e-mails that name exactly one customer, equal under the
    collation.

    The reference looks the customer up with a scalar subquery, which
    fails (and deletes nothing) when an address is shared.
    """
    return (t.customers.where(F.col("email").isNotNull())
            .groupBy(collated(F.col("email"), collation).alias("email"))
            .agg(F.count(F.lit(1)).alias("_n"), F.min("customer_id").alias("customer_id"))
            .where(F.col("_n") == 1).drop("_n"))


def orders_of_customers(t: Tables) -> DataFrame:
    """(customer_id, order_id, order_date): the one join of orders and cards,
    whose shuffles all its readers in a query share."""
    return (t.orders.select("order_id", "order_date", "card_number")
            .join(t.credit_cards, "card_number")
            .select("customer_id", "order_id", "order_date"))


def latest_orders(t: Tables, customers: DataFrame | None = None) -> DataFrame:
    """(customer_id, order_id) of each customer's most recent order.

    Latest by date, ties by the higher order id: a max over a
    (date, id) struct, i.e. a partial aggregate instead of a sort. With
    ``customers`` (customer_id) only their orders enter the aggregate.
    """
    owned = orders_of_customers(t)
    if customers is not None:
        owned = owned.join(customers.select("customer_id"), "customer_id", "left_semi")
    return (owned.groupBy("customer_id")
            .agg(F.max(F.struct("order_date", "order_id")).alias("_m"))
            .select("customer_id", F.col("_m.order_id").alias("order_id")))


def return_requests(t: Tables) -> DataFrame:
    """Requests (email, product_id, version) derived from the data: customers
    ask to take returned customised items off their latest order."""
    returned = t.lines_with_status(True).where(F.col("return_flag") == "R").select(
        "order_id", "product_id", "version")
    return (returned.join(orders_of_customers(t), "order_id")
            .join(t.customers.select("customer_id", "email"), "customer_id")
            .select("email", "product_id", "version").distinct())


def delete_latest_order_lines(t: Tables, requests: DataFrame,
                              lines: DataFrame | None = None,
                              collation: str = "") -> tuple[DataFrame, DataFrame]:
    """Remove (product, version) lines from the requesters' latest orders.

    Works on many requests at once. Returns (remaining lines, removed lines);
    the removed lines are the DELETED change set for D15.
    """
    lines = t.glasses_ordered if lines is None else lines
    # NULL addresses match no customer; dropping them first keeps them from
    # piling onto one join key. Only the requesters' orders are aggregated.
    resolved = (requests.where(F.col("email").isNotNull())
                .withColumn("email", collated(F.col("email"), collation))
                .join(resolve_emails(t, collation), "email"))
    requesters = resolved.select("customer_id").distinct()
    targets = (resolved.join(latest_orders(t, requesters), "customer_id")
               .select("order_id", *VKEY).distinct())
    keys = ["order_id", *VKEY]
    return lines.join(targets, keys, "left_anti"), lines.join(targets, keys, "left_semi")


def remaining_after_returns(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """D17 over the data: customised lines left after the return requests."""
    return delete_latest_order_lines(t, return_requests(t), collation=p.email_collation)[0]


# ------------------------------------------------------------------ D20
def revenue_vs_target(totals: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Revenue per year of the stored totals, target = growth x previous
    present year, rounded to units. The yearly aggregate is a handful of
    rows, so the un-partitioned LAG runs on a tiny input."""
    yearly = totals.groupBy(F.year("order_date").alias("year")).agg(
        F.sum("total_amount").alias("total_revenue"))
    prev = F.lag("total_revenue").over(Window.orderBy("year"))
    return yearly.select(
        "year",
        F.col("total_revenue").cast("decimal(38,2)").alias("total_revenue"),
        F.round(prev * F.lit(Decimal(p.growth)), 0).cast("decimal(38,2)").alias("revenue_target"))


def revenue_by_year(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """D20 over the data: yearly revenue of the recomputed totals and its target."""
    return revenue_vs_target(order_totals(t, geo=False), p)
