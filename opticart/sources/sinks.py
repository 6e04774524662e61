"""Versioned snapshot sinks for derived tables (order totals, discounts,
accepted customers, e-mail error log).

Plain Parquet has no UPDATE, so each refresh writes a new version folder
``<root>/version=<v>`` and readers name the version they want. Writing a
version overwrites only its own folder, so a retried job (or a replayed
micro-batch using its batch id as the version) is idempotent, and an
input that is being read is never overwritten.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession

from opticart.session import file_system


def snapshot_path(root: str, version: int | str) -> str:
    return f"{root.rstrip('/')}/version={version}"


def write_snapshot(df: DataFrame, root: str, version: int | str,
                   partition_by: list[str] | None = None) -> str:
    path = snapshot_path(root, version)
    writer = df.write.mode("overwrite")
    if partition_by:
        # the version is replaced as a whole, whatever the session's overwrite mode
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    writer.parquet(path)
    return path


def write_sorted(df: DataFrame, root: str, version: int | str, order: list[Column],
                 files: int | None = None) -> str:
    """Write a snapshot in total order: the rows are ranged on ``order``, sorted inside each
    range, and the files' names ascend with the ranges.

    ORDER BY for output: no single task sorts the table. Break ties among ``order``
    if their order matters.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return write_snapshot(df.repartitionByRange(n, *order).sortWithinPartitions(*order), root,
                          version)


def read_sorted(spark: SparkSession, root: str, version: int | str) -> Iterator[Row]:
    """The rows of a sorted snapshot in their order, one file after the other.

    A reader for exports: whoever takes the first rows reads the first files only.
    """
    files = sorted(spark.read.parquet(snapshot_path(root, version)).inputFiles())
    for path in files:
        yield from spark.read.parquet(path).coalesce(1).toLocalIterator()


def read_snapshot(spark: SparkSession, root: str, version: int | str) -> DataFrame:
    return spark.read.parquet(snapshot_path(root, version))


def read_committed(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All versions whose write has ended (those with a ``_SUCCESS`` mark), with a
    ``version`` column; an unfinished or crashed write is not seen at all."""
    fs, pattern = file_system(spark, f"{root.rstrip('/')}/version=*/_SUCCESS")
    done = [s.getPath().getParent().toString() for s in fs.globStatus(pattern) or []]
    if not done:
        return spark.createDataFrame([], f"{schema}, version string")
    return (spark.read.schema(f"{schema}, version string").option("basePath", root)
            .parquet(*sorted(done)))
