"""Exact selection of NTILE's first bucket against the window function."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from opticart.functions import selection
from opticart.operators import windows

rng = random.Random(11)
CASES = {
    "spread": [(i, rng.random() * 10 ** rng.randint(-12, 12)) for i in range(700)],
    "ties": [(i, float(rng.randint(0, 3))) for i in range(700)],
    "one key": [(i * i, 2.5) for i in range(301)],
    "null keys": [(i, None if i % 5 else i / 7) for i in range(400)],
    "no key": [(i, None) for i in range(9)],
    "neighbours": [(i, 1.0 + i * 2.0 ** -52) for i in range(50)],
    "ends of long": [(i, 1.0) for i in (-2 ** 63, -2 ** 63 + 1, 0, 2 ** 63 - 2, 2 ** 63 - 1)],
    "one row": [(7, 1.0)],
    "empty": [],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("buckets", [2, 4096])
def test_first_bucket_equals_ntile(spark, monkeypatch, case, buckets):
    monkeypatch.setattr(selection, "BUCKETS", buckets)
    df = spark.createDataFrame(CASES[case], "id long, x double").repartition(3)
    order = Window.orderBy(F.col("x").desc_nulls_last(), "id")
    for k in ((4,) if buckets == 2 else (4, 1000)):
        want = df.withColumn("q", F.ntile(k).over(order)).where("q = 1").select("id").collect()
        got = df.where(selection.first_bucket(df, k, "x", "id")).select("id").collect()
        assert sorted(r.id for r in got) == sorted(r.id for r in want)


def test_quartile_leaves_no_files_and_sorts_no_customers(spark, tables):
    from opticart.session import ensure_checkpoint_dir, file_system

    def files():
        fs, path = file_system(spark, ensure_checkpoint_dir(spark))
        return fs.getContentSummary(path).getFileCount()

    windows.search_to_order_quartile(tables).collect()
    before = files()
    out = windows.search_to_order_quartile(tables)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() > 0 and files() == before
    assert "rangepartitioning" not in plan and "Window" not in plan
