from __future__ import annotations

from types import SimpleNamespace

import pytest

from crestline.session import SETTINGS, configure, shared_dir


class Conf(dict):
    @property
    def getAll(self):
        return dict(self)

    def set(self, key, value):
        self[key] = value


def session(conf, master="local[2]", folder=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: folder)
    return SimpleNamespace(conf=Conf(conf), sparkContext=context)


def test_settings_fill_what_is_open_and_keep_what_is_set():
    own = {"spark.sql.adaptive.enabled": "false", "spark.sql.streaming.join.stateFormatVersion": "2"}
    conf = configure(session(own)).conf
    assert conf == {**SETTINGS, **own}


@pytest.mark.parametrize("zone,fine", [("UTC", True), ("Etc/UTC", True), ("America/New_York", False)])
def test_a_zone_that_would_change_results_is_an_error(zone, fine):
    given = session({"spark.sql.session.timeZone": zone})
    if fine:
        assert configure(given).conf["spark.sql.session.timeZone"] == zone
    else:
        with pytest.raises(ValueError, match="timeZone"):
            configure(given)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_no_local_folder_on_a_cluster(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session({}, master), "x")
    assert shared_dir(session({"spark.checkpoint.dir": "s3a://b/c/"}, master), "x").startswith("s3a://b/c/x-")
    assert shared_dir(session({}, master, "hdfs://h/d"), "x").startswith("hdfs://h/d/x-")


def test_a_local_session_may_leave_it_open():
    assert shared_dir(session({}), "x") != shared_dir(session({}), "x")
