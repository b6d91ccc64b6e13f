"""Where tables go and how the package reaches the workers."""

from __future__ import annotations

import zipfile
from types import SimpleNamespace

import pytest

from veristrata.llm import common


def session(master, checkpoint=None):
    conf = {}
    sc = SimpleNamespace(master=master, getConf=lambda: {"spark.checkpoint.dir": checkpoint}, environment={"PYTHONPATH": "/some/where"}, applicationId="none")
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__))


def test_shared_folder():
    assert common.shared_dir(session("yarn", "hdfs:///x/")) == "hdfs:///x"
    local = session("local[2]")
    assert common.shared_dir(local).startswith("file://") and common.shared_dir(local) == common.shared_dir(local)
    for master in ("yarn", "spark://a:7077", "local-cluster[2,1,1024]", "k8s://a"):
        with pytest.raises(ValueError):
            common.shared_dir(session(master))


def test_package_reaches_workers(spark):
    local = session("local[2]")
    for _ in range(2):
        common.prepare(local)
    assert local.sparkContext.environment["PYTHONPATH"] == f"/some/where:{common.REPO}"
    path = common._archive(spark).removeprefix("file://")
    with zipfile.ZipFile(path) as z:
        assert {"veristrata/__init__.py", "veristrata/llm/common.py", "veristrata/llm/queries.py"} <= set(z.namelist())
