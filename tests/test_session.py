"""Session helpers: the shared checkpoint folder and scratch space."""

import tempfile
import os
from types import SimpleNamespace

import pytest

from fleetlake import session
from fleetlake.session import checkpoint_dir, discard, scratch_database, scratch_path


def fake(master, conf=None):
    found = []
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: found[-1] if found else None,
                         setCheckpointDir=found.append)
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, default=None: conf or default))


def test_checkpoint_dir_is_set_once(spark):
    assert checkpoint_dir(spark) == checkpoint_dir(spark)


def test_local_sessions_get_a_folder():
    assert checkpoint_dir(fake("local[8]")).startswith(tempfile.gettempdir())


@pytest.mark.parametrize("master", ["yarn", "k8s://x", "local-cluster[3,2,1024]", "spark://x:7077"])
def test_clusters_must_name_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(fake(master))
    assert checkpoint_dir(fake(master, "hdfs:///shared")) == "hdfs:///shared"


def test_scratch_paths_are_unique_and_below_the_checkpoint_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(checkpoint_dir(spark).rstrip("/") + "/fleetlake-scratch/x-")


def test_discard_removes_folder_and_databases(spark):
    path = scratch_path(spark, "gone")
    name = "scratch_" + path.rsplit("-", 1)[-1]
    scratch_database(spark, path, name)
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}/db'")
    spark.range(5).write.option("path", f"{path}/db/t").saveAsTable(f"{name}.t")
    local = path.split("file:", 1)[-1]
    assert os.path.isdir(local) and spark.catalog.databaseExists(name)
    discard(path)
    assert not os.path.isdir(local) and not spark.catalog.databaseExists(name)
    assert path not in session._SCRATCH
