"""Joins in which one key may hold a large share of the rows.

A join deals rows by key, so a key with a third of the rows makes one task of a
third of the work. ``split_join`` measures the keys first: a mergeable
heavy-hitter summary of the join keys (``approx_top_k``, one bounded sketch per
task, merged) names the keys with more than a few tasks' fair share and how many
tasks each deserves. Only these are dealt to several tasks, and only their rows of
the other side are repeated; all other keys join as they are. The summary is a
scalar subquery of the same query: nothing runs while the plan is built, and both
sides read one result.

A side that the planner will broadcast by its own size estimate needs none of
this and is joined plainly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_HOT = 128        # keys that can be split; a key beyond them has under 1 % of the rows
TRACKED = 8192       # counters of the summary: its error is a few thousandths of the rows
FAIR_SHARES = 2      # a key is hot beyond so many tasks' even share of the rows


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner's own size estimate lets it broadcast ``df``."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return size <= limit


def key_summary(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row: (rows, top), the most frequent key hashes with their estimated counts."""
    return df.select(F.xxhash64(*on).alias("_key")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k(_key, {MAX_HOT}, {TRACKED})").alias("top"))


def hot_keys(df: DataFrame, on: Sequence[str], tasks: int | None = None) -> Column:
    """Map from the hash of each hot key of ``df`` to the tasks its rows are dealt to.

    A scalar subquery. ``tasks`` is the number of tasks of the join, by default
    the session's shuffle partitions; a key gets its share of them.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = f"filter(top, x -> x.count * {tasks} > rows * {FAIR_SHARES})"
    return key_summary(df, on).select(F.expr(
        f"map_from_entries(transform({hot}, x -> struct(x.item, "
        f"cast(ceil(x.count * {tasks} / rows) AS int))))").alias("hot")).scalar()


def split_join(big: DataFrame, small: DataFrame, on: Sequence[str], by: Column,
               how: str = "inner", measure: DataFrame | None = None) -> DataFrame:
    """Join on ``on`` in which the hot keys of ``big`` are dealt to several tasks.

    ``small`` has at most a few rows per key (a per-key aggregate, prices). It is
    often already partitioned by the key, in which case the engine cannot split
    the other side's hot partition at run time. ``by`` spreads the rows of one hot
    key and must be a value of the row, so that a retried task deals them alike.
    The keys are measured on ``measure``, by default ``big``: give the table that
    ``big`` comes from where ``big`` itself is dear to compute. A key that is hot
    there and not in ``big`` costs a few rows, one that is not found is joined in
    one task; the result is the same.
    """
    if fits_broadcast(small):
        return big.join(small, list(on), how)
    hot = hot_keys(big if measure is None else measure, on)
    tasks = F.coalesce(F.try_element_at(hot, F.xxhash64(*on)), F.lit(1))
    dealt = big.withColumn("_salt", F.pmod(F.xxhash64(by), tasks).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), tasks - 1)))
    return dealt.join(repeated, [*on, "_salt"], how).drop("_salt")
