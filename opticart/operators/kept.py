"""Views kept up to date by change sets of lines, without reading the lines again.

The line measures of the product overview (D09) and of the annual stats (D19) are
sums, distinct orders, first and last dates and the most frequent country. All of
them follow from partial states that merge by addition and take deletions back:

* ``pairs``: per (order, product) the number of plain and of customised lines and
  their units, in buckets of the order;
* ``cells``: per (product, order date, country, known order) the lines, units and
  orders, in buckets of the product. An order counts while its pair has lines, so a
  distinct count is a sum, and the last date is the last one with orders.

A change set is summed per pair, its pairs' buckets say which orders begin or cease
to hold a product, and that gives what each cell gains or loses. These increments are
written before anything is changed, under the number of the change set, and every
bucket remembers the last change set it has: a refresh that failed is run again and
finishes what is missing. The views read the cells only. Revenue per year (D20) reads
the stored totals (``totals.keep_totals``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opticart.operators import annual, overview, totals
from opticart.params import DEFAULT, Params
from opticart.session import drop_path, file_system, shared_path
from opticart.sources.bucket_table import BucketTable, buckets_for
from opticart.sources.conform import Tables

PAIR, CELL = ["order_id", "product_id"], ["product_id", "order_date", "country", "known"]
PAIR_SUMS = ["n_plain", "n_glasses", "units"]
CELL_SUMS = ["lines", "units", "orders", "orders_plain", "orders_glasses"]
_LONG = T.LongType()
PAIRS = T.StructType([T.StructField(c, _LONG) for c in PAIR + PAIR_SUMS])
CELLS = T.StructType([
    T.StructField("product_id", _LONG), T.StructField("order_date", T.DateType()),
    T.StructField("country", T.StringType()), T.StructField("known", T.BooleanType()),
    *[T.StructField(c, _LONG) for c in CELL_SUMS]])


def _add_up(df: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in sums])


def signed_pairs(plain: DataFrame, glasses: DataFrame) -> DataFrame:
    """The change of each (order, product): lines by kind and units, deleted ones negative.

    ``plain`` and ``glasses`` have (op, order_id, product_id, units).
    """
    cols = ["op", "order_id", "product_id", "units"]
    both = (plain.select(*cols, F.lit(True).alias("is_plain"))
            .unionByName(glasses.select(*cols, F.lit(False).alias("is_plain"))))
    sign = F.when(F.col("op") == "I", F.lit(1)).when(F.col("op") == "D", F.lit(-1)).otherwise(0)
    signed = both.select(
        F.col("order_id").cast("bigint"), F.col("product_id").cast("bigint"),
        F.when(F.col("is_plain"), sign).otherwise(0).alias("n_plain"),
        F.when(F.col("is_plain"), 0).otherwise(sign).alias("n_glasses"),
        (sign * F.coalesce("units", F.lit(0))).alias("units"))
    return _add_up(signed, PAIR, PAIR_SUMS)


def cell_increments(t: Tables, changes: DataFrame, old: DataFrame) -> DataFrame:
    """What a change of pairs adds to the cells, given the pairs as they were."""
    was = old.select(*PAIR, *[F.col(c).alias(f"old_{c}") for c in PAIR_SUMS])
    was = was.withColumnsRenamed({k: f"of_{k}" for k in PAIR})
    same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in PAIR]
    both = changes.join(was, same[0] & same[1], "left")

    def holds(plain: F.Column, glasses: F.Column) -> F.Column:
        return (plain + glasses > 0).cast("int")

    n = {c: F.col(c) for c in PAIR_SUMS}
    o = {c: F.coalesce(f"old_{c}", F.lit(0)) for c in PAIR_SUMS}
    zero = F.lit(0)
    moved = both.select(
        *PAIR, (n["n_plain"] + n["n_glasses"]).alias("lines"), "units",
        (holds(n["n_plain"] + o["n_plain"], n["n_glasses"] + o["n_glasses"])
         - holds(o["n_plain"], o["n_glasses"])).alias("orders"),
        (holds(n["n_plain"] + o["n_plain"], zero) - holds(o["n_plain"], zero))
        .alias("orders_plain"),
        (holds(n["n_glasses"] + o["n_glasses"], zero) - holds(o["n_glasses"], zero))
        .alias("orders_glasses"))
    orders = t.orders_geo.select("order_id", "order_date", "country", F.lit(True).alias("known"))
    placed = moved.join(orders, "order_id", "left").withColumn(
        "known", F.coalesce("known", F.lit(False)))
    return _add_up(placed, CELL, CELL_SUMS)


class KeptLines:
    """The line measures of a shop under ``path``."""

    def __init__(self, t: Tables, path: str, buckets: int):
        self.t, self.path = t, path.rstrip("/")
        spark = t.spark
        self.pairs = BucketTable(spark, f"{path}/pairs", "order_id", PAIRS, buckets)
        self.cells = BucketTable(spark, f"{path}/cells", "product_id", CELLS, buckets)

    @classmethod
    def create(cls, t: Tables, plain: DataFrame, glasses: DataFrame, path: str,
               buckets: int) -> "KeptLines":
        """The state of all lines given, read once."""
        spark, inserted = t.spark, F.lit("I").alias("op")
        lines = signed_pairs(plain.select("*", inserted), glasses.select("*", inserted))
        pairs = BucketTable.create(lines, f"{path}/pairs", "order_id", buckets)
        cells = cell_increments(t, pairs.read(), spark.createDataFrame([], PAIRS))
        BucketTable.create(cells, f"{path}/cells", "product_id", buckets)
        return cls(t, path, buckets)

    def increments(self, changes: DataFrame) -> DataFrame:
        """What ``changes`` adds to the cells: reads the touched pairs and the orders."""
        return cell_increments(self.t, changes, self.pairs.rows_near(changes))

    def refresh(self, change_set: int, plain: DataFrame, glasses: DataFrame) -> None:
        """Apply a change set of lines (op, order_id, product_id, units); numbered upwards."""
        spark, changes = self.t.spark, signed_pairs(plain, glasses)
        path = f"{self.path}/increments/change_set={change_set}"
        fs, done = file_system(spark, f"{path}/_SUCCESS")
        if not fs.exists(done):      # a retry must not measure pairs that have the set already
            self.increments(changes).write.mode("overwrite").parquet(path)
        self.pairs.update(changes, change_set,
                          lambda rows, new: _add_up(rows.unionByName(new), PAIR, PAIR_SUMS))
        gained = spark.read.schema(CELLS).parquet(path)
        self.cells.update(gained, change_set,
                          lambda rows, new: _add_up(rows.unionByName(new), CELL, CELL_SUMS))
        drop_path(spark, f"{self.path}/increments/change_set={change_set - 1}")

    def _cells(self) -> DataFrame:
        return self.cells.read().where((F.col("lines") != 0) | (F.col("orders") != 0))

    def overview(self, p: Params = DEFAULT) -> DataFrame:
        """D09 from the kept measures."""
        dated = (F.col("orders") > 0) & F.col("known")
        by_country = self._cells().groupBy(
            "product_id", "country", F.when(F.col("known"), True).alias("_hit")).agg(
            F.sum("lines").alias("_n"), F.sum("units").alias("_u"),
            F.max(F.when(dated, F.col("order_date"))).alias("_last"),
            F.min(F.when(dated, F.col("order_date"))).alias("_first"),
            F.sum(F.when(F.col("order_date").isNotNull(), F.col("orders"))).alias("_dated"))
        return overview.products_overview(self.t, p, overview.fold_countries(by_country))

    def annual_stats(self, p: Params = DEFAULT) -> DataFrame:
        """D19 from the kept measures."""
        by_year = self._cells().where("known").groupBy(
            "product_id", F.year("order_date").alias("year")).agg(
            F.sum(F.col("orders_plain") + F.col("orders_glasses")).alias("o"),
            F.sum("units").alias("u"))
        return annual.product_annual_stats(self.t, p, by_year)


BUCKETS = 8      # of the replays, at least


def _replayed(t: Tables) -> KeptLines:
    kept = KeptLines.create(t, t.line_base(False), t.line_base(True),
                            shared_path(t.spark, "kept"), buckets_for(t.raw("lineitem"), BUCKETS))
    kept.refresh(1, t.line_changes(False), t.line_changes(True))
    return kept


def overview_kept(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """D09 over the data: kept for the fulfilled lines, refreshed by the change sets."""
    return _replayed(t).overview(p)


def annual_stats_kept(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """D19 over the data: kept for the fulfilled lines, refreshed by the change sets."""
    return _replayed(t).annual_stats(p)


def revenue_of_stored_totals(t: Tables, p: Params = DEFAULT) -> DataFrame:
    """D20 over the stored totals, after both change sets: the lines are not read for it."""
    return totals.revenue_vs_target(totals.totals_kept_in_place(t, p), p)
