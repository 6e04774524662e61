"""The command line runs a product into a versioned snapshot."""

from opticart.__main__ import main
from opticart.session import shared_path
from tests.conftest import SMALL


def test_cli_run_writes_snapshot(spark, capsys):
    root = shared_path(spark, "cli")
    assert main(["run", "rating_gap", "--data", SMALL, "--out", root, "--version", "7",
                 "--as-of", "2001-08-01"]) == 0
    path = capsys.readouterr().out.strip().splitlines()[-1]
    assert path.endswith("version=7")
    assert spark.read.parquet(path).columns[-1] == "gap"


def test_cli_lists_every_product(capsys):
    assert main(["list"]) == 0
    assert len(capsys.readouterr().out.strip().splitlines()) == 27


def test_cli_params_are_typed():
    import datetime as dt

    from opticart.__main__ import parse_params
    p = parse_params(["year=1999", "years=1998,1999", "upper_discount=0.4", "growth=1.5",
                      "review_as_of=2000-06-30"], dt.date(2001, 1, 1))
    assert (p.year, p.years, p.upper_discount, p.growth) == (1999, (1998, 1999), 0.4, "1.5")
    assert p.review_as_of == dt.date(2000, 6, 30) and p.as_of == dt.date(2001, 1, 1)


def test_params_reject_impossible_settings():
    import pytest

    from opticart.params import Params
    for bad in (dict(years=()), dict(top_n=0), dict(lower_discount=0.6), dict(idle_days=-1)):
        with pytest.raises(ValueError):
            Params(**bad)


def test_intake_run_appends_customers_and_log(spark, capsys):
    root = shared_path(spark, "cli") + "/intake"
    assert main(["run", "customer_intake", "--data", SMALL, "--out", root, "--version", "1"]) == 0
    path = capsys.readouterr().out.strip().splitlines()[-1]
    routed = spark.read.parquet(path)
    from opticart.sql import register_intake
    assert register_intake(spark, root) == ["new_customers", "email_error_log"]
    assert spark.table("new_customers").count() == routed.where("status = 'accepted'").count() > 0
    assert spark.table("email_error_log").count() == routed.where("status = 'rejected'").count() > 0


def test_submitted_settings_stay(tmp_path):
    """A submitted master and shuffle setting are kept by the command line's session."""
    import os
    import subprocess
    import sys

    from tests.conftest import ROOT
    code = ("from opticart.session import job_session; s = job_session(); "
            "print('SEEN', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), "
            "s.conf.get('spark.sql.adaptive.forceOptimizeSkewedJoin'))")
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS="--master local[2] --conf "
               f"spark.sql.shuffle.partitions=37 --conf spark.checkpoint.dir={tmp_path} "
               "--conf spark.ui.enabled=false pyspark-shell")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=env, capture_output=True,
                         text=True, timeout=300)
    assert "SEEN local[2] 37 true" in out.stdout, out.stderr[-2000:]


def test_a_cluster_needs_a_shared_folder():
    import pytest

    from opticart import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_files_added_to_a_folder_are_seen(spark, tmp_path):
    """Same session, second session: a registered query lists its files anew."""
    import shutil

    from opticart import registry
    root = tmp_path / "data"
    root.mkdir()
    for name in ("region", "nation", "customer", "part", "lineitem", "events"):
        shutil.copy(f"{SMALL}/{name}.parquet", root / f"{name}.parquet")
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    orders.where("o_orderkey < 700").write.parquet(str(root / "orders.parquet"))
    query = registry.queries()["order_totals"]
    assert query(spark, str(root)).count() == 700
    orders.where("o_orderkey >= 700").write.mode("append").parquet(str(root / "orders.parquet"))
    assert query(spark, str(root)).count() == orders.count()
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "3")
    df = query(other, str(root))
    assert df.count() == orders.count()
    assert df.sparkSession.conf.get("spark.sql.shuffle.partitions") == "3"
