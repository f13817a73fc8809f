"""Where intermediate tables go."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from tessera.session import CHECKPOINT_KEY, materialise, new_path, scratch, shared_dir


class _Conf(dict):
    def set(self, key, value):
        self[key] = value


def _session(master: str, conf: dict, context_dir: str | None = None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: context_dir)
    return SimpleNamespace(conf=_Conf(conf), sparkContext=context)


def test_the_cluster_names_the_folder():
    assert shared_dir(_session("yarn", {CHECKPOINT_KEY: "hdfs:///shared/"})) == "hdfs:///shared"
    assert shared_dir(_session("yarn", {}, "hdfs:///context")) == "hdfs:///context"


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_session("spark://host:7077", {}))


def test_only_a_local_master_falls_back():
    session = _session("local[2]", {})
    assert shared_dir(session) == shared_dir(session) == session.conf[CHECKPOINT_KEY]


def test_materialise_keeps_rows_and_types(spark, capital):
    again = materialise(capital, "test")
    assert again.schema.simpleString() == capital.schema.simpleString()
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, capital.collect()))
    assert new_path(spark, "x") != new_path(spark, "x")


def test_a_scope_removes_what_it_wrote(spark, capital):
    with scratch(spark):
        with scratch(spark):
            gone, kept = materialise(capital, "gone"), materialise(capital, "kept", keep=True)
            files = [df.inputFiles()[0] for df in (gone, kept)]
            assert all(_exists(spark, file) for file in files)
        assert not _exists(spark, files[0]) and _exists(spark, files[1])
        assert kept.count() == capital.count()
    assert not _exists(spark, files[1])


def _exists(spark, file):
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
