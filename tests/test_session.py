"""The scratch folder follows the session's setting."""

from __future__ import annotations

import pytest

from pagelode.session import materialize, scratch_root


class Conf:
    def get(self, key, default=None):
        return default


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):  # noqa: N802
        return self.folder

    def setCheckpointDir(self, folder):  # noqa: N802
        self.folder = folder


class Session:
    def __init__(self, master):
        self.conf, self.sparkContext = Conf(), Context(master)


def test_local_master_sets_its_own_folder_once():
    session = Session("local[2]")
    assert scratch_root(session) == scratch_root(session) == session.sparkContext.folder


def test_cluster_needs_the_setting():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session("yarn"))


def test_materialize_keeps_rows_and_types(spark):
    df = spark.range(5).selectExpr("id", "array(id) a", "cast(null as string) s")
    again = materialize(df, "check")
    assert again.dtypes == df.dtypes and sorted(again.collect()) == sorted(df.collect())
