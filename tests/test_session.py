from types import SimpleNamespace

import pytest

from tickbars.session import new_run_dir, session_conf, shared_dir


def stub(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder or default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_the_shared_folder_is_the_sessions():
    assert shared_dir(stub("spark://host:7077", "s3a://bucket/dir/")) == "s3a://bucket/dir"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(stub("spark://host:7077"))


def test_runs_have_folders_of_their_own():
    session = stub("local[2]", "/shared")
    assert new_run_dir(session, "x") != new_run_dir(session, "x")


def test_session_conf_is_put_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError):
        with session_conf(spark, {key: "3", "spark.tickbars.none": "x"}):
            assert spark.conf.get(key) == "3"
            raise RuntimeError
    assert spark.conf.get(key) == before
    assert spark.conf.get("spark.tickbars.none", None) is None
