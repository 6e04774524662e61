"""A table kept in place by parts: UPDATE and DELETE that rewrite only what changes.

Plain Parquet has no UPDATE. Here a table is partitioned by a bucket of its key, and
a change reads the buckets that its keys fall into (partition pruning), changes
them and writes them back with dynamic partition overwrite; the files of all other
buckets stay as they are. One changed order of a table with 1000 buckets costs a
thousandth of the table.

Every row carries the number of the last change set applied to its bucket. A change
set that is run again after a failure leaves the buckets alone that already have
it, so each row is changed exactly once. Change sets are numbered upwards and
applied one after the other by one writer; the buckets are replaced when the job
commits, so readers should start after it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opticart.session import drop_path

BUCKET, APPLIED = "_bucket", "_applied"
ROWS = 500_000       # of a bucket, which one task sorts and writes


def buckets_for(df: DataFrame, least: int) -> int:
    """So many buckets that the rows of ``df`` make about ``ROWS`` each, at least ``least``."""
    return max(least, -(-df.count() // ROWS))


class BucketTable:
    """A table under ``path`` in ``buckets`` partitions by the hash of ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType,
                 buckets: int):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.columns = schema.names
        self._stored = T.StructType([*schema.fields, T.StructField(APPLIED, T.LongType()),
                                     T.StructField(BUCKET, T.IntegerType())])

    @classmethod
    def create(cls, df: DataFrame, path: str, key: str, buckets: int) -> "BucketTable":
        """Write ``df`` as a new table (change set 0)."""
        table = cls(df.sparkSession, path, key, df.schema, buckets)
        table._write(df.withColumns({APPLIED: F.lit(0).cast("long"), BUCKET: table.bucket()}),
                     buckets, "overwrite")
        return table

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def read(self) -> DataFrame:
        return self._rows().select(*self.columns)

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(self._stored).parquet(self.path)

    def _touched(self, changes: DataFrame) -> list[int]:
        """Buckets of the keys of ``changes``: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in changes.select(self.bucket().alias("b")).distinct().collect())

    def rows_near(self, changes: DataFrame) -> DataFrame:
        """The rows of the buckets that the keys of ``changes`` fall into."""
        return self._rows().where(F.col(BUCKET).isin(self._touched(changes))).select(*self.columns)

    def _write(self, rows: DataFrame, tasks: int, mode: str = "dynamic") -> None:
        # one file per bucket; only buckets with rows are replaced
        (rows.repartition(max(tasks, 1), BUCKET).write.mode("overwrite")
         .option("partitionOverwriteMode", "static" if mode == "overwrite" else mode)
         .partitionBy(BUCKET).parquet(self.path))

    def update(self, changes: DataFrame, change_set: int,
               apply: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Replace the rows of touched buckets by ``apply(rows, changes)``; returns the buckets.

        ``changes`` has the key. ``apply`` gets the rows of the touched buckets and the
        changes that fall into them and returns the new rows, with the table's columns:
        one per row given (UPDATE ... FROM), or also new ones. Buckets that have the
        change set already are left alone.
        """
        touched = self._touched(changes)
        rows = self._rows().where(F.col(BUCKET).isin(touched))
        done = {r[0] for r in rows.where(F.col(APPLIED) >= change_set).select(BUCKET).distinct()
                .collect()} if touched else set()
        todo = [b for b in touched if b not in done]
        if todo:
            new = apply(rows.where(F.col(BUCKET).isin(todo)).select(*self.columns),
                        changes.where(self.bucket().isin(todo)))
            self._write(new.select(*self.columns, F.lit(change_set).cast("long").alias(APPLIED),
                                   self.bucket().alias(BUCKET)), len(todo))
        return todo

    def delete(self, keys: DataFrame, on: list[str]) -> list[int]:
        """Remove the rows that equal a row of ``keys`` in ``on`` (with the key among them)."""
        touched = self._touched(keys)
        if touched:
            rows = self._rows().where(F.col(BUCKET).isin(touched))
            kept = rows.join(keys.select(*on).distinct(), on, "left_anti").select(rows.columns)
            left = {r[0] for r in kept.select(BUCKET).distinct().collect()}
            self._write(kept, len(touched))
            for b in set(touched) - left:       # a write replaces no bucket it has no rows for
                drop_path(self.spark, f"{self.path}/{BUCKET}={b}")
        return touched
