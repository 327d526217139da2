from __future__ import annotations

import pytest

from faremill import session


class Fake:
    """A session as far as the scratch area is concerned."""

    def __init__(self, master, setting=None, context_dir=None):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.setting = setting
        self.context_dir = context_dir

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.setting or default

    def getCheckpointDir(self):
        return self.context_dir

    def setCheckpointDir(self, path):
        self.context_dir = path


def test_workspace_follows_the_session():
    shared = Fake("spark://host:7077", "hdfs://shared/area/")
    a, b = session.workspace(shared, "x"), session.workspace(shared, "x")
    assert a.startswith("hdfs://shared/area/x-") and a != b


def test_workspace_follows_the_context():
    shared = Fake("yarn", None, "s3a://bucket/marks/uuid")
    assert session.workspace(shared, "x").startswith("s3a://bucket/marks/uuid/x-")


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        session.workspace(Fake("yarn"), "x")


def test_local_session_gets_one_folder():
    local = Fake("local[2]")
    first = session.workspace(local, "x")
    assert session.workspace(local, "y").rsplit("/", 1)[0] == first.rsplit("/", 1)[0]


def test_times_are_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_the_package_is_sent_once(spark):
    from faremill.session import ship_package

    for _ in range(2):
        ship_package(spark)
    names = [f.rsplit("/", 1)[1] for f in spark.sparkContext.listFiles]
    assert names.count("faremill.zip") == 1
