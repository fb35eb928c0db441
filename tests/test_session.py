"""The shared folder: named by the session, a temporary one only in a single process; written tables and their removal."""

from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from roadlens import session as S


def fake(master, named=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: named, set=lambda key, value: None), sparkContext=context)


def test_a_cluster_must_name_its_shared_folder():
    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            S.shared_dir(fake(master))
        assert S.shared_dir(fake(master, "hdfs:///shared/")) == "hdfs:///shared"
    assert os.path.isdir(S.shared_dir(fake("local[2]")))


def test_materialised_tables_keep_schema_and_rows_and_can_be_released(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    back = S.materialize(df)
    assert back.schema == df.schema and sorted(map(tuple, back.collect()), key=str) == sorted([(1, None), (2, "b")], key=str)
    folder = os.path.dirname(back.inputFiles()[0].removeprefix("file:").replace("///", "/"))
    assert os.path.isdir(folder)
    S.release(spark, folder)
    assert not os.path.exists(folder)
