"""Helpers the operators share: table access, materialised tables, row keys."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opticart.session import drop_path, ensure_checkpoint_dir

# The word rule of the contracts: runs of characters other than blank and
# \t \n \v \f \r. Written as a separator class for split().
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A column used inside a lambda would be re-evaluated for each element;
    binding it as a lambda variable of its own avoids that.
    """
    return F.transform(F.array(value), body)[0]


def run_hashes(values: Column, n: int) -> Column:
    """Hash of each run of ``n`` neighbours of an array, by the run's first place.

    The elements are read one by one: cutting out a slice per place costs
    several times as much.
    """
    def hashed(a: Column) -> Column:
        count = F.greatest(F.size(a) - (n - 1), F.lit(0))
        return F.transform(F.slice(a, F.lit(1), count), lambda first, i: F.xxhash64(
            first, *[F.get(a, i + k) for k in range(1, n)]))

    return let(values, hashed)


def words_of(text: Column) -> Column:
    """The words of a text; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), "")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that clash with no column of ``df`` (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def null_safe(left: DataFrame, right: DataFrame, keys: list[str],
              how: str = "inner") -> DataFrame:
    """Equi-join in which null keys are equal; the key columns appear once."""
    named = right.withColumnsRenamed({k: f"r__{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"r__{k}"))
    return left.join(named, cond, how).drop(*[f"r__{k}" for k in keys])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder, deleted when the application ends."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/llm/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage (a lost executor only re-reads files) and keeps a
    result that is used more than once from being computed more than once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` whose last reader has run."""
    for df in tables:
        path = getattr(df, "_scratch", None)
        if path is not None:
            drop_path(df.sparkSession, path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers.

    Once per application the package goes as a zip to the shared folder and
    from there through ``addPyFile``.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = f"{scratch_path(spark, 'package')}/{os.path.basename(root)}.zip"
    hadoop_path = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop_path.getFileSystem(sc._jsc.hadoopConfiguration()).create(hadoop_path)
    out.write(buffer.getvalue())
    out.close()
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
