"""A stopped and restarted stream processes every change exactly once."""

from opticart.operators import totals
from opticart.session import shared_path
from opticart.streaming import order_totals as streaming


def test_restart_from_checkpoint_is_exactly_once(spark, tables):
    t = tables
    feed, base = shared_path(spark, "feeds"), shared_path(spark, "stream")
    first, second = streaming.change_feed(t)
    paths = dict(out_path=f"{base}/totals", checkpoint=f"{base}/checkpoint")

    first.write.mode("append").parquet(feed)          # stored lines arrive, query runs, stops
    q = streaming.start_totals_stream(spark, t, feed, **paths)
    q.awaitTermination()
    second.write.mode("append").parquet(feed)         # the changes arrive while it is down
    q = streaming.start_totals_stream(spark, t, feed, **paths)   # restart, same checkpoint
    q.awaitTermination()
    assert q.exception() is None

    got = streaming.stream_order_totals(t, sink=f"{base}/totals")
    want = totals.order_totals(t, t.line_final(False), t.line_final(True))
    as_map = lambda df: {r[0]: r[1] for r in df.select("order_id", "total_amount").collect()}
    assert as_map(got) == as_map(want)


def test_intake_restart_continues_ids(spark, tables):
    from pyspark.sql import functions as F

    from opticart.operators import intake
    from opticart.streaming import intake as intake_stream
    t = tables
    feed = intake.customer_feed(t)
    cut = feed.agg(F.percentile_approx("feed_seq", 0.5)).first()[0]
    path, base = shared_path(spark, "intake-feed"), shared_path(spark, "intake")
    args = dict(sink=base, checkpoint=f"{base}/checkpoint")

    feed.where(F.col("feed_seq") <= cut).write.mode("append").parquet(path)
    intake_stream.start_intake_stream(spark, t, path, **args).awaitTermination()
    feed.where(F.col("feed_seq") > cut).write.mode("append").parquet(path)
    q = intake_stream.start_intake_stream(spark, t, path, **args)      # restart
    q.awaitTermination()
    assert q.exception() is None

    got = intake_stream.customer_intake_stream(t, sink=base)
    want = intake.customer_intake(t).select(*got.columns)
    assert sorted(got.collect()) == sorted(want.collect())


def test_intake_without_its_history_fails(spark, tables):
    """A lost mark stops the stream; ids never start over."""
    from pyspark.errors import StreamingQueryException
    import pytest

    from opticart.operators import intake
    from opticart.session import drop_path
    from opticart.streaming import intake as intake_stream
    t = tables
    feed = intake.customer_feed(t)
    path, base = shared_path(spark, "intake-feed"), shared_path(spark, "intake")
    args = dict(sink=base, checkpoint=f"{base}/checkpoint")
    feed.limit(5).write.mode("append").parquet(path)
    intake_stream.start_intake_stream(spark, t, path, **args).awaitTermination()
    assert spark.read.parquet(f"{base}/marks").count() == 1     # one row per batch
    drop_path(spark, f"{base}/marks/batch_id=0")
    feed.limit(5).write.mode("append").parquet(path)
    with pytest.raises(StreamingQueryException):
        intake_stream.start_intake_stream(spark, t, path, **args).awaitTermination()
    assert spark.read.parquet(f"{base}/routed").select("version").distinct().count() == 1


def test_stream_prices_with_current_options(spark, tmp_path):
    """A version whose options come while the stream runs is priced with them,
    and old delta folders are folded."""
    import shutil
    from pathlib import Path

    from opticart.sources.conform import Tables
    from tests.conftest import SMALL
    root = tmp_path / "data"
    root.mkdir()        # of this test's own: the data folder itself may be read-only
    for table in Path(SMALL).glob("*.parquet"):
        shutil.copyfile(table, root / table.name)
    root = str(root)
    t = Tables(spark, root)
    feed, base = shared_path(spark, "feeds"), shared_path(spark, "stream")
    paths = dict(out_path=f"{base}/totals", checkpoint=f"{base}/checkpoint")
    line = [("I", "glasses", 1, 3, 99, 2)]              # a version no line has yet
    spark.createDataFrame(line, streaming.FEED_SCHEMA).write.mode("append").parquet(feed)
    streaming.start_totals_stream(spark, t, feed, **paths).awaitTermination()
    first = streaming.read_totals(spark, paths["out_path"]).first().total_amount
    # the version appears in the line table, and so do its options
    lines = spark.read.parquet(f"{root}/lineitem.parquet")
    new = lines.where("l_partkey = 3").limit(1).selectExpr(
        *[f"{'99' if c == 'l_linenumber' else c} AS {c}" for c in lines.columns])
    new.write.mode("append").parquet(f"{root}/more.parquet")
    both = lines.unionByName(spark.read.parquet(f"{root}/more.parquet")).collect()
    shutil.move(f"{root}/lineitem.parquet", f"{root}/old.parquet")
    spark.createDataFrame(both, lines.schema).write.parquet(f"{root}/lineitem.parquet")
    spark.createDataFrame(line, streaming.FEED_SCHEMA).write.mode("append").parquet(feed)
    streaming.start_totals_stream(spark, t, feed, **paths).awaitTermination()
    extra = (t.refresh().selected.where("product_id = 3 AND version = 99")
             .join(t.customizations, ["feature", "selection"]).agg({"extra_price": "sum"}).first()[0])
    second = streaming.read_totals(spark, paths["out_path"]).first().total_amount
    assert extra and second == 2 * first + 2 * extra
