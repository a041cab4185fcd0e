from types import SimpleNamespace

import pytest

from questlog.session import materialise, scratch_dir


class _Session:
    """The parts of a session that name the scratch folder."""

    def __init__(self, master, configured=None, checkpoint=None):
        self.conf = SimpleNamespace(get=lambda key, default: configured or default)
        self.sparkContext = SimpleNamespace(
            master=master,
            getCheckpointDir=lambda: self.checkpoint,
            setCheckpointDir=lambda path: setattr(self, "checkpoint", path),
        )
        self.checkpoint = checkpoint


def test_shared_folder_of_the_session():
    session = _Session("spark://host:7077", configured="s3a://shared/")
    first, second = scratch_dir(session, "x"), scratch_dir(session, "x")
    assert first.startswith("s3a://shared/questlog/x-")
    assert first != second
    session = _Session("yarn", checkpoint="hdfs://shared")
    assert scratch_dir(session, "x").startswith("hdfs://shared/questlog/x-")


def test_cluster_without_shared_folder_fails():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(_Session("yarn"), "x")


def test_local_master_takes_a_temporary_folder_once():
    session = _Session("local[2]")
    first = scratch_dir(session, "x")
    assert scratch_dir(session, "x").rsplit("/", 2)[0] == first.rsplit("/", 2)[0]


def test_materialise_cuts_the_lineage(spark):
    df = materialise(spark.range(5).selectExpr("id * 2 AS n"), "test")
    assert sorted(r["n"] for r in df.collect()) == [0, 2, 4, 6, 8]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "FileScan parquet" in plan
