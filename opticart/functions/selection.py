"""Exact selection: which rows come first in an order, without sorting them.

``first_bucket`` finds NTILE's first bucket from the boundary row alone. A histogram
of the keys (at most ``BUCKETS`` rows, each with count, least and greatest key) shows
in which of its buckets the boundary falls; that bucket's own range is cut again, until
it holds one key. Its least and greatest key always part, so every round gets on;
each divides the range by ``BUCKETS``, so a few rounds do. Where many rows share the
boundary key, the same is done with their ids. No row moves: each round is an
aggregate with map-side partial counts.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opticart.session import drop_path, shared_path

BUCKETS = 4096


def _of_double(value: Column, lo: float, hi: float) -> Column:
    """The histogram bucket of a value in [lo, hi], never falling as the value grows."""
    return F.floor((value - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(BUCKETS)))


def _of_long(value: Column, lo: int, hi: int) -> Column:
    # decimals: the width of a range of longs may not fit one
    wide = F.lit(lo).cast("decimal(20,0)"), F.lit(hi).cast("decimal(20,0)")
    return F.call_function("div", (value.cast("decimal(20,0)") - wide[0]) * F.lit(BUCKETS),
                           wide[1] - wide[0])


def _at_rank(df: DataFrame, name: str, bucket: Callable[[Column, Any, Any], Column], lo, hi,
             rank: int, descending: bool = False) -> tuple[Any, int, int]:
    """The value at a 1-based rank among values in [lo, hi], its rank among equal ones
    and their number (not counted, 0, if all values are one)."""
    value, ties = F.col(name), 0
    while lo != hi:
        part = df.where(value.between(F.lit(lo), F.lit(hi)))
        place = F.least(bucket(value, lo, hi), F.lit(BUCKETS - 1))
        cells = (part.groupBy(place.alias("b"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("lo"),
                      F.max(name).alias("hi"))
                 .collect())                                       # at most BUCKETS rows
        for cell in sorted(cells, key=lambda c: c.b, reverse=descending):
            if rank <= cell.n:
                lo, hi, ties = cell.lo, cell.hi, cell.n
                break
            rank -= cell.n
    return lo, rank, ties


def at_rank(df: DataFrame, name: str, rank: int) -> float:
    """The value at a 1-based rank of a column of finite doubles."""
    ends = df.agg(F.min(name).alias("lo"), F.max(name).alias("hi")).first()
    return _at_rank(df, name, _of_double, ends.lo, ends.hi, rank)[0]


def first_bucket(df: DataFrame, k: int, key: str, tie: str) -> Column:
    """Whether a row is in bucket 1 of NTILE(k) OVER (ORDER BY key DESC NULLS LAST, tie).

    ``key`` is a finite double or null, ``tie`` a unique non-null bigint. The two columns
    are written once for the rounds and deleted before this returns.
    """
    spark = df.sparkSession
    path = shared_path(spark, "selection")
    narrow = df.select(F.col(key).cast("double").alias("key"), F.col(tie).cast("long").alias("tie"))
    narrow.write.mode("overwrite").parquet(path)
    rows = spark.read.schema("key double, tie bigint").parquet(path)
    try:
        s = rows.agg(F.count(F.lit(1)).alias("n"), F.count("key").alias("keyed"),
                     F.min("key").alias("lo"), F.max("key").alias("hi")).first()
        rank = -(-s.n // k)
        if rank == 0:
            return F.lit(False)
        if rank > s.keyed:          # all rows with a key, and the first of those without
            same, before, rank, ties = F.col("key").isNull(), F.col(key).isNotNull(), rank - s.keyed, 0
            here = F.col(key).isNull()
        else:
            v, rank, ties = _at_rank(rows, "key", _of_double, s.lo, s.hi, rank, descending=True)
            same, before, here = F.col("key") == F.lit(v), F.col(key) > F.lit(v), F.col(key) == F.lit(v)
        if rank == ties:
            return F.coalesce(before | here, F.lit(False))
        tied = rows.where(same)
        ends = tied.agg(F.min("tie").alias("lo"), F.max("tie").alias("hi")).first()
        last, _, _ = _at_rank(tied, "tie", _of_long, ends.lo, ends.hi, rank)
        return F.coalesce(before | (here & (F.col(tie) <= F.lit(last))), F.lit(False))
    finally:
        drop_path(spark, path)
