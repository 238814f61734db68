from types import SimpleNamespace

import pytest

from eclusa.errors import IngestionError
from eclusa.functions.locations import workspace


def session(**settings):
    conf = SimpleNamespace(get=lambda name, default=None: settings.get(name.split(".")[1], default))
    return SimpleNamespace(conf=conf)


def test_shared_folder_of_the_session():
    assert workspace(session(checkpoint="hdfs://n/scratch/", sql="/w")) == "hdfs://n/scratch"


def test_without_one_the_warehouse_serves():
    assert workspace(session(sql="hdfs://n/warehouse/")) == "hdfs://n/warehouse/.eclusa"


def test_a_cluster_needs_a_shared_folder():
    assert workspace(session(master="local[8]", sql="/w")) == "/w/.eclusa"
    assert workspace(session(master="yarn", checkpoint="hdfs://n/c/", sql="/w")) == "hdfs://n/c"
    with pytest.raises(IngestionError, match="spark.checkpoint.dir"):
        workspace(session(master="spark://n:7077", sql="/w"))
