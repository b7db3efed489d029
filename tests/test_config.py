from __future__ import annotations

import pytest

from cargolake.config import build_session, checkpoint_folder, durable, shuffle_partitions, size_shuffle


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions(0) == 1
    assert shuffle_partitions(1 << 40) == 4096
    assert shuffle_partitions(100 << 40) == 409_600


def test_a_run_raises_the_partitions_to_its_input(spark, tmp_path, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        (tmp_path / "part").mkdir()
        (tmp_path / "part" / "a").write_bytes(b"x" * 1000)
        assert size_shuffle(spark, str(tmp_path)) == int(before)
        monkeypatch.setattr("cargolake.config.shuffle_partitions", lambda size: size)
        assert size_shuffle(spark, str(tmp_path)) == 1000
        assert spark.conf.get("spark.sql.shuffle.partitions") == "1000"
        assert size_shuffle(spark, str(tmp_path / "none")) == 1000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_cluster_needs_a_shared_checkpoint_folder(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    session = type("Session", (), {"sparkContext": Context(), "conf": Conf()})()
    frame = type("Frame", (), {"sparkSession": session})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        durable(frame)


def test_durable_rows_lie_in_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    df = durable(spark.range(10))
    assert df.count() == 10
    assert spark.sparkContext.getCheckpointDir().split(":", 1)[-1].startswith(named)
    assert checkpoint_folder(spark) == named


def test_sessions_run_in_utc(spark):
    assert build_session("tests").conf.get("spark.sql.session.timeZone") == "UTC"
