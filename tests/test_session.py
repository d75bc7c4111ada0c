"""Where intermediate tables go."""

from __future__ import annotations

import os
import subprocess
import sys
import time
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidings import session
from tidings.operators.ranking import rank_rows


class Settings:
    """Stands for a session: its settings, its master and its checkpoint folder."""

    def __init__(self, master, conf=None, folder=None, warehouse="hdfs:///warehouse"):
        values = {"spark.checkpoint.dir": conf, "spark.sql.warehouse.dir": warehouse}
        self.conf = SimpleNamespace(get=lambda key, default=None: values[key] or default)
        self.sparkContext = SimpleNamespace(master=master, getCheckpointDir=lambda: folder)


@pytest.fixture(autouse=True)
def stores(monkeypatch):
    def scheme(spark, folder):
        return folder.split(":")[0] if ":" in folder else "file"
    monkeypatch.setattr(session, "store_of", scheme)


def test_the_cluster_names_the_folder():
    assert session.work_folder(Settings("yarn", conf="hdfs:///shared")) == "hdfs:///shared"
    assert session.work_folder(Settings("yarn", folder="hdfs:///set/x")) == "hdfs:///set/x"


def test_without_a_setting_the_warehouse_is_used():
    assert session.work_folder(Settings("yarn", warehouse="hdfs:///w/")) == "hdfs:///w/.work"


@pytest.mark.parametrize("conf", ["file:/tmp/x", "/tmp/x", None])
def test_no_local_folder_on_a_cluster(conf):
    with pytest.raises(ValueError):
        session.work_folder(Settings("spark://host:7077", conf=conf, warehouse="file:/tmp/w"))


@pytest.mark.parametrize("form", ["{}", "file:{}", "file://{}"])
def test_a_mount_that_all_machines_have_is_taken(spark, tmp_path, form):
    folder = form.format(tmp_path)
    cluster = Settings("spark://host:7077", conf=folder)
    cluster.sparkContext.applicationId, cluster.sparkContext.defaultParallelism = "app-1", 5
    cluster.range, cluster.read, cluster._jvm, cluster._jsc = spark.range, spark.read, spark._jvm, spark._jsc
    assert session.work_folder(cluster) == folder
    assert not list((tmp_path / "app-1").iterdir())
    assert session.new_path(cluster, "x").startswith(f"{folder}/app-1/x-")


def test_a_folder_that_loses_rows_is_refused(spark, tmp_path):
    cluster = Settings("spark://host:7077", conf=str(tmp_path))
    cluster.sparkContext.applicationId, cluster.sparkContext.defaultParallelism = "app-2", 5
    cluster.range, cluster._jvm, cluster._jsc = spark.range, spark._jvm, spark._jsc
    # What the driver sees of files that executors wrote to their own disks.
    empty = spark.range(0)
    cluster.read = SimpleNamespace(schema=lambda _: SimpleNamespace(parquet=lambda _: empty))
    with pytest.raises(ValueError):
        session.work_folder(cluster)


def test_a_local_master_may_use_its_own_disk():
    assert session.work_folder(Settings("local[8]", conf="/tmp/x")) == "/tmp/x"


def test_stage_reads_back_what_was_written(spark):
    rows = [(1, ["a"], None), (2, None, 0.5)]
    df = spark.createDataFrame(rows, "i int, a array<string>, d double")
    staged = session.stage(df, "x")
    assert staged.schema == df.schema and sorted(staged.collect()) == sorted(df.collect())
    folder = session.work_folder(spark).removeprefix("file:")
    assert all(folder in path for path in staged.inputFiles())


def test_a_dropped_table_leaves_nothing(spark):
    staged = session.stage(spark.range(5).selectExpr("id", "id % 2 AS half"), "y", partition_by=("half",))
    assert staged.where("half = 1").count() == 2
    folder = Path(staged.staged_path.removeprefix("file:"))
    assert folder.exists()
    session.drop_staged(staged)
    assert not folder.exists()


@pytest.mark.parametrize("missing", ["tidings.llm", "corpus_pipeline", "public_tokenizers", "sentencepiece"])
def test_the_rest_works_without_the_training_data_operators(missing):
    program = f"""
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as entry
from tidings.plans.queries import QUERIES
from tidings.plans.oracles import ORACLES
assert entry.queries() == QUERIES and entry.oracle_sql() == ORACLES
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", program], cwd=root, check=True, capture_output=True)


def shuffle_files(spark):
    names = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(",").split(",")
    return {x.rsplit("/", 1)[1] for x in names if "/shuffle_" in x}


def no_more_than(spark, before):
    """Whether all newer shuffle files go; they are removed in the background."""
    for _ in range(20):
        if shuffle_files(spark) <= before:
            return True
        time.sleep(0.25)
    return False


def test_stored_tables_leave_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(session._CLEANUP)
    table = session.stage(spark.range(1000).groupBy(F.col("id") % 7).count(), "few")
    assert no_more_than(spark, before)
    rows = rank_rows(spark.range(1000), F.desc("id"), name="place")
    assert no_more_than(spark, before) and spark.conf.get(session._CLEANUP) == setting
    assert table.count() == 7 and rows.where("id + place = 1000").count() == 1000
    with pytest.raises(ZeroDivisionError), session.shuffles_dropped(spark):
        assert spark.conf.get(session._CLEANUP) == "true" and 1 // 0
    assert spark.conf.get(session._CLEANUP) == setting
