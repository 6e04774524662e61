"""Order totals maintained by Structured Streaming over a change feed.

The reference keeps ORDERS.Total_Amount current with AFTER INSERT/DELETE
triggers on both line tables. Here the line changes arrive as files
(op 'I' / 'D', kind 'plain' / 'glasses'). Each micro-batch is handed to
``foreachBatch`` as a batch DataFrame, priced with the products and options
as they are at that moment, reduced to signed per-order deltas and written
to ``deltas/batch_id=<n>``. The pricing runs as a batch job, so hot products
are salted and the engine re-plans at run time; no state store is needed.

Every ``COMPACT_EVERY`` batches the older deltas are folded into a new base
(``base/upto=<n>``) and their folders deleted, so the sink does not grow with
the number of batches; readers add the later deltas to the latest base.

A feed row may name its change set (``change_set``) and how many rows that has
(``set_rows``). The customised-line trigger (D15, ``totals.custom_line_deltas``)
lets each of the c equal rows of a change set pay its extras c times, and the
rows of a set may arrive in several files and micro-batches. So the rows and units
of each (change set, op, order, product, version) are carried in ``sets`` until the
set is whole, and a batch writes what its rows add to the group's amount. Once a
set is whole its totals are those of the trigger; a set of unknown size counts as
whole with each batch. Rows without a change set are sets of one row.

A retried batch overwrites its own folder and only batches before the
current one are folded, so the sink is idempotent and the query's checkpoint
gives exactly-once totals. No watermark: orders never expire in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opticart.functions.blocks import VKEY, version_extras, with_version_prices
from opticart.functions.skew import split_join
from opticart.session import drop_path, file_system, shared_path
from opticart.sources.conform import Tables

FEED_SCHEMA = T.StructType([
    T.StructField("op", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("units", T.IntegerType()),
])
# Feeds may have the identity of the change set as well.
SET_SCHEMA = T.StructType([*FEED_SCHEMA.fields, T.StructField("change_set", T.LongType()),
                           T.StructField("set_rows", T.LongType())])
SET_KEY = ["change_set", "op", "kind", "order_id", *VKEY]
SETS = ("change_set bigint, op string, kind string, order_id bigint, product_id bigint, "
        "version int, set_rows bigint, rows bigint, units bigint, new_rows bigint, "
        "new_units bigint, open boolean")
DELTAS = "order_id bigint, delta decimal(38,2)"
BASE = "order_id bigint, total_amount decimal(38,2)"

TOTAL = "decimal(18,2)"
COMPACT_EVERY = 20
FILES_PER_TRIGGER = 64      # bounds a micro-batch, also the first one


def feed_rows(lines: DataFrame, op: str, kind: str) -> DataFrame:
    """Shape plain or customised lines as change-feed rows."""
    version = F.col("version") if "version" in lines.columns else F.lit(None).cast("int")
    op_col = F.col("op") if "op" in lines.columns else F.lit(op)
    return lines.select(op_col.alias("op"), F.lit(kind).alias("kind"),
                        F.col("order_id").cast("long"), F.col("product_id").cast("long"),
                        version.cast("int").alias("version"), F.col("units").cast("int"))


def in_set(rows: DataFrame, change_set: int) -> DataFrame:
    """Feed rows as one change set, which names its size."""
    return rows.select("*", F.lit(change_set).cast("long").alias("change_set"),
                       rows.agg(F.count(F.lit(1))).scalar().alias("set_rows"))


def change_feed(t: Tables) -> list[DataFrame]:
    """The data's change feed in arrival order: stored (fulfilled) lines are
    inserted one by one, then open lines are inserted and returned lines deleted in
    one change set of plain and one of customised lines."""
    return [
        feed_rows(t.line_base(False), "I", "plain").unionByName(
            feed_rows(t.line_base(True), "I", "glasses")),
        in_set(feed_rows(t.line_changes(False), "", "plain"), 1).unionByName(
            in_set(feed_rows(t.line_changes(True), "", "glasses"), 2)),
    ]


def signed_amounts(priced_by: DataFrame, products: DataFrame, extras: DataFrame) -> DataFrame:
    """(order_id, amount) of rows (op, order_id, product_id, version, units, extra_units):
    units pay the product's price, extra_units the version's extras, signed by op."""
    priced = with_version_prices(priced_by, products, extras, F.col("order_id"))
    sign = F.when(F.col("op") == "I", F.lit(1)).when(F.col("op") == "D", F.lit(-1))
    amount = (F.col("units") * F.col("price")
              + F.col("extra_units") * F.coalesce(F.col("sum_extra"), F.lit(0)))
    return priced.select("order_id", (sign * amount).alias("amount"))


def merged_sets(batch: DataFrame, before: DataFrame) -> DataFrame:
    """The groups of equal rows of the change sets in ``batch``, and of those ``before``
    that are not whole yet: rows and units with and without this batch, and whether rows
    of the set are still to come."""
    zero = F.lit(0).cast("long")
    new = (batch.where(F.col("change_set").isNotNull()).groupBy(*SET_KEY)
           .agg(F.max("set_rows").alias("set_rows"), F.count(F.lit(1)).alias("new_rows"),
                F.coalesce(F.sum("units"), zero).alias("new_units")))
    both = (new.select(*SET_KEY, "set_rows", zero.alias("rows"), zero.alias("units"), "new_rows",
                       "new_units")
            .unionByName(before.where("open").select(
                *SET_KEY, "set_rows", "rows", "units", zero.alias("new_rows"),
                zero.alias("new_units"))))
    groups = both.groupBy(*SET_KEY).agg(
        F.max("set_rows").alias("set_rows"), F.sum("new_rows").alias("new_rows"),
        F.sum("new_units").alias("new_units"),
        (F.sum("rows") + F.sum("new_rows")).alias("rows"),
        (F.sum("units") + F.sum("new_units")).alias("units"))
    arrived = groups.groupBy("change_set").agg(
        F.coalesce(F.sum("rows") < F.max("set_rows"), F.lit(False)).alias("open"))
    # a change set may be the whole batch: its groups are dealt to several tasks
    named = (batch.select("change_set").where(F.col("change_set").isNotNull())
             .unionAll(before.where("open").select("change_set")))
    return split_join(groups, arrived, ["change_set"], F.struct("order_id", *VKEY), measure=named)


def added_by_batch(batch: DataFrame, sets: DataFrame) -> DataFrame:
    """What the batch's rows add: units at the product's price, and extra_units at the
    version's extras (a group of c rows pays them c times, each)."""
    before = (F.col("units") - F.col("new_units")) * (F.col("rows") - F.col("new_rows"))
    paid = F.col("units") * F.col("rows") - before
    columns = ["op", "order_id", *VKEY]
    of_sets = sets.where(F.col("new_rows") > 0).select(
        *columns, F.col("new_units").alias("units"),
        F.when(F.col("kind") == "glasses", paid).otherwise(0).alias("extra_units"))
    alone = batch.where(F.col("change_set").isNull()).select(
        *columns, F.col("units").cast("long").alias("units"),
        F.when(F.col("kind") == "glasses", F.col("units")).otherwise(0).cast("long")
        .alias("extra_units"))
    return of_sets.unionByName(alone)


def start_totals_stream(spark: SparkSession, t: Tables, feed_path: str, out_path: str,
                        checkpoint: str, max_files_per_trigger: int = FILES_PER_TRIGGER,
                        available_now: bool = True):
    """Start the streaming query; returns the StreamingQuery."""
    feed = (spark.readStream.schema(SET_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(feed_path))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        now = t.refresh()        # options and prices as they are now
        before = spark.createDataFrame([], SETS)
        if batch_id > 0:
            before = spark.read.schema(SETS).parquet(f"{out_path}/sets/batch_id={batch_id - 1}")
        path = f"{out_path}/sets/batch_id={batch_id}"
        merged_sets(batch, before).select(*before.columns).write.mode("overwrite").parquet(path)
        added = added_by_batch(batch, spark.read.schema(SETS).parquet(path))
        wanted = batch.select(*VKEY).distinct()
        extras = version_extras(now.selected.join(wanted, VKEY, "left_semi"), now.customizations)
        deltas = signed_amounts(added, now.products, extras).groupBy("order_id").agg(
            F.sum("amount").cast("decimal(38,2)").alias("delta"))
        deltas.write.mode("overwrite").parquet(f"{out_path}/deltas/batch_id={batch_id}")
        for n in _numbered(spark, f"{out_path}/sets", "batch_id"):
            if n < batch_id - 1:        # a retry of this batch needs the one before
                drop_path(spark, f"{out_path}/sets/batch_id={n}")
        if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
            compact(spark, out_path, batch_id - 1)

    writer = feed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 seconds")
    return writer.start()


def _numbered(spark: SparkSession, root: str, prefix: str) -> list[int]:
    """The numbers n of the finished folders ``<root>/<prefix>=<n>``, ascending.

    One entry per batch since the last compaction and one per base: few.
    """
    fs, path = file_system(spark, root)
    if not fs.exists(path):
        return []
    out = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        done = file_system(spark, f"{root}/{name}/_SUCCESS")
        if name.startswith(f"{prefix}=") and done[0].exists(done[1]):
            out.append(int(name.partition("=")[2]))
    return sorted(out)


def read_totals(spark: SparkSession, out_path: str, upto: int | None = None) -> DataFrame:
    """(order_id, total_amount): the latest base plus the deltas after it
    (up to batch ``upto``, if given)."""
    bases = _numbered(spark, f"{out_path}/base", "upto")
    last = bases[-1] if bases else -1
    paths = [f"{out_path}/deltas/batch_id={n}" for n in _numbered(spark, f"{out_path}/deltas",
                                                                  "batch_id")
             if n > last and (upto is None or n <= upto)]
    parts = spark.createDataFrame([], BASE)
    if paths:
        parts = parts.unionByName(spark.read.schema(DELTAS).parquet(*paths)
                                  .withColumnRenamed("delta", "total_amount"))
    if bases:
        parts = parts.unionByName(spark.read.schema(BASE).parquet(f"{out_path}/base/upto={last}"))
    return parts.groupBy("order_id").agg(F.sum("total_amount").alias("total_amount"))


def compact(spark: SparkSession, out_path: str, upto: int) -> None:
    """Fold the deltas of batches <= ``upto`` into a new base and delete them."""
    old = _numbered(spark, f"{out_path}/base", "upto")
    if old and old[-1] >= upto:
        return
    folded = read_totals(spark, out_path, upto).select(
        "order_id", F.col("total_amount").cast("decimal(38,2)").alias("total_amount"))
    folded.write.mode("overwrite").parquet(f"{out_path}/base/upto={upto}")
    for n in old:
        drop_path(spark, f"{out_path}/base/upto={n}")
    for n in _numbered(spark, f"{out_path}/deltas", "batch_id"):
        if n <= upto:
            drop_path(spark, f"{out_path}/deltas/batch_id={n}")


def replay_change_feed(t: Tables) -> str:
    """Let the data's change feed arrive in two parts, run the stream to the
    end of each (availableNow) and return the sink folder."""
    spark = t.spark
    feed_path, base = shared_path(spark, "feeds"), shared_path(spark, "stream")
    for chunk in change_feed(t):
        chunk.write.mode("append").parquet(feed_path)
        q = start_totals_stream(spark, t, feed_path, f"{base}/totals", f"{base}/checkpoint")
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    drop_path(spark, feed_path)
    drop_path(spark, f"{base}/checkpoint")
    return f"{base}/totals"


def stream_order_totals(t: Tables, p=None, sink: str | None = None) -> DataFrame:
    """D16 over the data: replay the change feed through the stream and
    return every order with its maintained total (0 when it has none).

    Equals D13 on the final lines (fulfilled-not-returned plus open)."""
    totals = read_totals(t.spark, sink or replay_change_feed(t))
    return t.orders_geo.join(totals, "order_id", "left").select(
        "order_id", "order_date", "card_number", "country",
        F.coalesce(F.col("total_amount"), F.lit(0)).cast(TOTAL).alias("total_amount"))
