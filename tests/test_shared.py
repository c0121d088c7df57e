"""The shared folder: the cluster's setting, and no machine-local stand-in on a cluster."""

from __future__ import annotations

import pytest

from surveyspark.sources.shared import shared_dir


class Session:
    def __init__(self, master, **conf):
        self.sparkContext = type("C", (), {"master": master})
        self.conf = type("K", (), {"get": staticmethod(lambda key, default=None: conf.get(key.replace(".", "_"), default))})


def test_shared_folder():
    assert shared_dir(Session("spark://x", spark_checkpoint_dir="hdfs://n/c/")) == "hdfs://n/c"
    assert shared_dir(Session("local[8]", spark_sql_warehouse_dir="file:/w/")) == "file:/w/checkpoints"
    for master in ("spark://x", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(Session(master, spark_sql_warehouse_dir="file:/w"))
