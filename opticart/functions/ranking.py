"""Global row numbers and NTILE without a single-partition window.

``row_number().over(Window.orderBy(...))`` moves the whole table into one
task. Here the table is range-partitioned on the sort key and sorted
inside each partition; the partition index and the position inside the
partition (both carried by ``monotonically_increasing_id``) are fixed by
writing the rows once to the cluster's checkpoint folder (a ``checkpoint`` would
sort them twice: once to run, once to save), and a per-partition
count table (one row per partition, a proven bound) gives each partition
its offset. Ties must be broken by a unique key among the sort columns so
the numbering is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opticart.session import shared_path

_LOCAL_BITS = 33   # monotonically_increasing_id = partition << 33 | row in partition


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "rn",
                      total: str | None = None, partitions: int | None = None,
                      by: Sequence[str] = (), path: str | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of each row in the total order.

    With ``by`` (a few non-NULL group columns, e.g. a status) numbering
    restarts per group. With ``total`` set, also add the (group's) row
    count under that name. The ranked rows go to ``path``, which the caller deletes
    once the result has been read; without one they stay until the application ends.
    """
    spark = df.sparkSession
    keys = [F.col(b) for b in by] + list(order)
    # without a number of its own the engine merges small ranges at run time
    ranged = (df.repartitionByRange(partitions, *keys) if partitions
              else df.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    numbered = ranged.withColumn("_mid", F.monotonically_increasing_id())
    path = path or shared_path(spark, "ranked")
    numbered.write.mode("overwrite").parquet(path)
    tagged = spark.read.schema(numbered.schema).parquet(path)
    tagged = (tagged.withColumn("_part", F.shiftright("_mid", _LOCAL_BITS))
              .withColumn("_local", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))))
    # A range partition may hold the end of one group and the start of the
    # next; rows of a group are contiguous in it, so rebase on its first row.
    counts = tagged.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n"),
                                               F.min("_local").alias("_base"))
    # At most (groups x n) rows, a proven bound: windows over it are cheap
    # and the table is safe to broadcast.
    before = (Window.partitionBy(*by).orderBy("_part")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(
        *by, "_part", "_base",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("_total"))
    out = (tagged.join(F.broadcast(offsets), [*by, "_part"])
           .withColumn(name, F.col("_off") + F.col("_local") - F.col("_base") + F.lit(1)))
    if total:
        out = out.withColumnRenamed("_total", total)
    return out.drop("_mid", "_part", "_local", "_base", "_off", "_total")


def ntile_of(rank: Column, total: Column, k: int) -> Column:
    """NTILE(k) bucket of a 1-based rank among ``total`` rows.

    The first m = total mod k buckets hold q+1 rows, the others q rows,
    q = total div k.
    """
    q = F.call_function("div", total, F.lit(k))
    m = total % k
    big = m * (q + 1)
    small = F.when(q > 0, q)
    return F.when(rank <= big, F.call_function("div", rank - 1, q + 1) + 1).otherwise(
        m + F.call_function("div", rank - 1 - big, small) + 1).cast("int")


def global_ntile(df: DataFrame, k: int, order: Sequence[Column], name: str = "ntile",
                 partitions: int | None = None) -> DataFrame:
    ranked = global_row_number(df, order, "_rank", total="_rows", partitions=partitions)
    return ranked.withColumn(name, ntile_of(F.col("_rank"), F.col("_rows"), k)).drop(
        "_rank", "_rows")
