"""Tables that are replaced by publishing a version."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from cargolake.plans import runs
from cargolake.sources import tables, versions
from tests.conftest import rows


class Killed(BaseException):
    """Ends a run as a killed driver would: nothing below it cleans up."""


def numbers(n):
    return [(i,) for i in range(n)]


def published(path):
    return sorted(p.name for p in (path / versions.LOG).iterdir() if p.name.isdigit()), sorted(p.name for p in (path / versions.VERSIONS).iterdir())


def test_readers_find_the_last_published_version(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.read_optional(spark, path) is None and versions.resolved(spark, path) == path
    for n in (3, 5, 0):
        tables.publish_table(spark.range(n), path)
        assert rows(tables.read_table(spark, path)) == numbers(n)
    entries, folders = published(tmp_path / "t")
    assert len(entries) == len(folders) == 3
    assert versions.current(spark, path).number == 3


def test_a_plain_folder_becomes_a_published_table(spark, tmp_path):
    path = tmp_path / "t"
    tables.write_table(spark.range(4).withColumn("day", F.col("id") % 2), str(path), partition_by=["day"])
    tables.publish_table(tables.read_table(spark, str(path)).where("id > 0"), str(path))
    assert tables.read_table(spark, str(path)).count() == 3
    assert (path / "day=0").exists()      # for readers that began before
    tables.publish_table(spark.range(2), str(path), keep=timedelta(seconds=-5))
    assert sorted(p.name for p in path.iterdir()) == [versions.LOG, versions.VERSIONS]
    assert tables.read_table(spark, str(path)).count() == 2


def test_a_table_may_be_published_from_itself_and_an_old_version_stays_readable(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish_table(spark.range(9), path)
    old = tables.read_table(spark, path)
    tables.publish_table(old.where("id < 2"), path)
    assert rows(tables.read_table(spark, path)) == numbers(2) and old.count() == 9


def test_a_write_that_fails_leaves_the_old_version_and_no_files(spark, tmp_path):
    path = tmp_path / "t"
    tables.publish_table(spark.range(5), str(path))
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") > 60, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        tables.publish_table(bad, str(path))
    assert rows(tables.read_table(spark, str(path))) == numbers(5)
    assert len(published(path)[1]) == 1


@pytest.mark.parametrize("step", ["laid_out", "publish", "expire"])
@pytest.mark.parametrize("after", [False, True])
def test_a_run_killed_between_any_two_steps_leaves_a_whole_table(spark, tmp_path, monkeypatch, step, after):
    path = str(tmp_path / "t")
    tables.publish_table(spark.range(5), path)
    real = getattr(tables, step)

    def killed(*args, **options):
        if after:
            done = real(*args, **options)
            if step == "laid_out":
                done.parquet(str(tmp_path / "t" / versions.VERSIONS / "000000000000000-half"))
        raise Killed

    with monkeypatch.context() as patched:
        patched.setattr(tables, step, killed)
        with pytest.raises(Killed):
            tables.publish_table(spark.range(7), path)
    there = 7 if step == "expire" or (step, after) == ("publish", True) else 5
    assert rows(tables.read_table(spark, path)) == numbers(there)
    tables.publish_table(spark.range(8), path)        # the next run is not held up
    assert rows(tables.read_table(spark, path)) == numbers(8)


@pytest.mark.parametrize("content", ["", "0001-ab", "0001-abc\npubl"])
def test_an_entry_that_is_cut_off_counts_as_not_there(spark, tmp_path, content):
    path = tmp_path / "t"
    tables.publish_table(spark.range(5), str(path))
    (path / versions.LOG / f"{2:020d}").write_text(content)
    assert rows(tables.read_table(spark, str(path))) == numbers(5)
    tables.publish_table(spark.range(6), str(path))
    assert versions.current(spark, str(path)).number == 3
    assert rows(tables.read_table(spark, str(path))) == numbers(6)


def test_two_writers_do_not_put_the_same_number(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.publish_table(spark.range(1), path)
    first, second = versions.new_version(path), versions.new_version(path)
    spark.range(2).write.parquet(first)
    spark.range(3).write.parquet(second)
    seen = versions._numbers(spark, path)
    with monkeypatch.context() as patched:       # both looked before either had put
        patched.setattr(versions, "_numbers", lambda *_: seen)
        assert (versions.publish(spark, path, first), versions.publish(spark, path, second)) == (2, 3)
    assert tables.read_table(spark, path).count() == 3


def test_versions_and_leftovers_go_by_age(spark, tmp_path):
    path = tmp_path / "t"
    for n in (1, 2, 3):
        tables.publish_table(spark.range(n), str(path))
    spark.range(9).write.parquet(f"{path}/{versions.VERSIONS}/000000000000001-left")      # of a run that died long ago
    running = versions.new_version(str(path))
    spark.range(9).write.parquet(running)
    assert versions.expire(spark, str(path)) == ["000000000000001-left"]
    assert len(versions.expire(spark, str(path), timedelta(seconds=-5))) == 3             # two old versions, one unnamed
    assert rows(tables.read_table(spark, str(path))) == numbers(3)
    assert [len(x) for x in published(path)] == [1, 1]


def test_partitions_and_order_of_a_published_table(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("day"), (F.col("id") % 7).alias("key"))
    tables.publish_table(df, str(tmp_path / "t"), partition_by=["day"], sort_by=["key"])
    back = tables.read_table(spark, str(tmp_path / "t"))
    assert rows(back.select("id", "day")) == sorted(((i, i % 3) for i in range(1000)), key=lambda t: tuple((x is None, str(x)) for x in t))
    plan = back.where("day = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_no_layer_run_renames_data(spark, tmp_path, monkeypatch):
    from datetime import date

    from cargolake.config import WarehouseConfig
    from tests.conftest import RUN_TS
    from tests.test_runs import operational, raw_files

    raw_files(tmp_path)
    cfg = WarehouseConfig(root=str(tmp_path), run_ts=RUN_TS, as_of=date(2025, 3, 31))
    operational(spark, cfg)

    def exchange(*_):
        raise AssertionError("a table was renamed")

    monkeypatch.setattr(tables, "exchange", exchange)
    got = runs.run_all(spark, cfg)
    assert got["gold"] == {"orders": 4, "matched_trips": 1}
    runs.run_checks(spark, cfg)
    assert runs.run_reports(spark, cfg)["rfm"].count() == 2
