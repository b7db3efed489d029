"""Marts that stand by themselves, and the load of the marts into a database."""

from __future__ import annotations

import shutil
from datetime import date
from unittest.mock import MagicMock

import pytest

from cargolake.config import WarehouseConfig
from cargolake.plans import runs
from cargolake.sources import tables
from cargolake.sources.tables import read_optional, read_table
from tests.conftest import RUN_TS
from tests.test_runs import operational, raw_files


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    cfg = WarehouseConfig(root=str(root), run_ts=RUN_TS, as_of=date(2025, 3, 31))
    raw_files(root)
    operational(spark, cfg)
    runs.run_all(spark, cfg)
    return cfg


@pytest.mark.parametrize("broken", ["dim_time", "dim_vehicle", "fact_orders"])
def test_a_mart_that_fails_stops_no_other(spark, lake, monkeypatch, broken):
    before = {name: read_table(spark, lake.gold(name)).inputFiles() for name in ("dim_time", "dim_vehicle", "dim_product", "fact_orders")}

    def fail(*_, **__):
        raise ValueError("no room")

    if broken == "dim_vehicle":
        monkeypatch.setitem(runs.DIMENSIONS, broken, ("vehicles", fail))
    else:
        monkeypatch.setattr(runs.marts, broken, fail)
    got = runs.run_gold(spark, lake)
    assert got["failed"] == {broken: "failed: no room"} and "skipped" not in got
    assert ("orders" in got) == (broken != "fact_orders")
    after = {name: read_table(spark, lake.gold(name)).inputFiles() for name in before}
    assert {name for name in before if before[name] == after[name]} == {broken}       # all others are new versions


def test_a_database_that_fails_leaves_the_marts_of_the_lake(spark, lake, monkeypatch):
    def fail(df, url, table, *_):
        if table == "gold.dim_driver":
            raise OSError("connection refused")

    monkeypatch.setattr(runs, "publish_jdbc", fail)
    from dataclasses import replace

    got = runs.run_gold(spark, replace(lake, mart_url="jdbc:x"))
    assert got == {"orders": 4, "matched_trips": 1, "failed": {"dim_driver": "failed: connection refused"}}


def test_gold_alone_skips_what_is_not_there(spark, lake, tmp_path):
    shutil.copytree(f"{lake.root}/silver", tmp_path / "silver")
    shutil.rmtree(tmp_path / "silver/postgres/vehicles")
    cfg = WarehouseConfig(root=str(tmp_path), run_ts=RUN_TS, as_of=date(2025, 3, 31))
    assert runs.run_gold(spark, cfg) == {"orders": 4, "matched_trips": 1, "skipped": ["dim_vehicle"]}
    shutil.rmtree(tmp_path / "silver/postgres/sale_headers")
    assert runs.run_gold(spark, cfg) == {"skipped": ["dim_vehicle", "fact_orders"]}
    assert read_table(spark, cfg.gold("fact_orders")).count() == 4
    bare = WarehouseConfig(root=str(tmp_path / "bare"), run_ts=RUN_TS, as_of=date(2025, 3, 31))
    assert runs.run_gold(spark, bare)["skipped"][-1] == "fact_orders"
    assert read_optional(spark, bare.gold("dim_time")).count() > 0


class Connection:
    """Records what a database would be asked; statement number ``breaks`` fails."""

    def __init__(self, breaks=None):
        self.asked, self.breaks = [], breaks

    def setAutoCommit(self, on):
        self.asked.append(f"autocommit {on}")

    def createStatement(self):
        return self

    def executeUpdate(self, sql):
        if len([a for a in self.asked if " FROM " in a]) == self.breaks:
            raise OSError("broken")
        self.asked.append(sql)

    def commit(self):
        self.asked.append("commit")

    def rollback(self):
        self.asked.append("rollback")

    def close(self):
        self.asked.append("close")


def mart():
    df = MagicMock()
    df.count.return_value = 25
    df.columns = ["a", "b"]
    return df


def test_a_mart_is_loaded_beside_the_old_one_and_taken_over_in_one_transaction(monkeypatch):
    opened, df = Connection(), mart()
    monkeypatch.setattr(tables, "connection", lambda *_: opened)
    tables.publish_jdbc(df, "jdbc:x", "gold.dim_time", {"user": "u"}, rows_per_writer=10)
    df.repartition.assert_called_once_with(3)
    calls = str(df.mock_calls)
    assert "limit(0)" in calls and "mode('append')" in calls                      # a missing mart is created
    assert "option('truncate', True)" in calls and "jdbc('jdbc:x', 'gold.dim_time_new'" in calls
    assert opened.asked == [
        "autocommit False", "DELETE FROM gold.dim_time", "INSERT INTO gold.dim_time (a, b) SELECT a, b FROM gold.dim_time_new",
        "DELETE FROM gold.dim_time_new", "commit", "close", "close",
    ]


@pytest.mark.parametrize("breaks", [0, 1, 2])
def test_a_transaction_that_breaks_is_rolled_back(monkeypatch, breaks):
    opened = Connection(breaks)
    monkeypatch.setattr(tables, "connection", lambda *_: opened)
    with pytest.raises(OSError, match="broken"):
        tables.publish_jdbc(mart(), "jdbc:x", "gold.dim_time", {})
    assert opened.asked[-3:] == ["rollback", "close", "close"] and "commit" not in opened.asked


def test_a_load_that_breaks_off_does_not_touch_the_mart(monkeypatch):
    opened, df = Connection(), mart()
    monkeypatch.setattr(tables, "connection", lambda *_: opened)
    df.repartition.side_effect = OSError("executor lost")
    with pytest.raises(OSError, match="lost"):
        tables.publish_jdbc(df, "jdbc:x", "gold.dim_time", {})
    assert opened.asked == []
