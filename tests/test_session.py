import os
from types import SimpleNamespace

import pytest

from surgelens import session


def stand_in(master):
    return SimpleNamespace(sparkContext=SimpleNamespace(master=master, applicationId="app-" + master))


def test_the_named_folder_wins(spark, monkeypatch):
    monkeypatch.setattr(session, "_named_dir", lambda s: "hdfs://shared/work/")
    assert session.shared_dir(spark) == "hdfs://shared/work"
    first, second = session.scratch_path(spark, "a"), session.scratch_path(spark, "a")
    assert first.startswith("hdfs://shared/work/a-") and first != second


def test_only_a_local_master_may_use_a_temporary_folder(monkeypatch):
    monkeypatch.setattr(session, "_named_dir", lambda s: None)
    local = session.shared_dir(stand_in("local[2]"))
    assert os.path.isdir(local) and session.shared_dir(stand_in("local[2]")) == local
    with pytest.raises(RuntimeError):
        session.shared_dir(stand_in("spark://cluster:7077"))


def test_broadcast_bound(spark):
    small = spark.range(3)
    hinted = session.broadcast_within(small, 3, 8)
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    assert session.broadcast_within(small, 10**9, 100) is small


def test_time_zone_is_pinned(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    assert session.utc(spark).conf.get("spark.sql.session.timeZone") == "UTC"
