"""Incremental telemetry: micro-batches that run again, in whole or in part."""

from __future__ import annotations

import re
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cargolake.sources import tables, telemetry
from cargolake.streaming import telemetry as landing
from cargolake.streaming.telemetry import Ledger, land_batch, land_new_telemetry
from tests.conftest import RUN_TS, rows
from tests.files import log, point

START = 1736071200000


class Killed(BaseException):
    pass


@pytest.fixture
def lake(spark, tmp_path):
    """Two days of logs with rejects and copies of points, and what a whole run makes of them."""
    base = tmp_path / "raw"
    twice = point(START + 7, 3.0)
    log(base / "dt=2025-01-05/delivery_1_A_1.jsonl", [point(START), twice, twice, "{broken"])
    log(base / "dt=2025-01-05/delivery_2_B_1.jsonl", ["[1]", "[1]"])
    log(base / "dt=2025-01-06/delivery_3_C_1.jsonl", [point(START + 86400000 + i) for i in range(5)])
    return base, str(tmp_path / "bronze"), str(tmp_path / "rejects"), tmp_path / "ledger"


def business(df):
    return rows(df.select("source_file", F.col("log_date").cast("string"), "order_key", "ts"))


def whole(spark, base):
    lines = telemetry.read_telemetry(spark, str(base), RUN_TS)
    return business(lines), rows(telemetry.broken_lines(spark, str(base), RUN_TS).select("source_file", "line"))


def landed(spark, out, rejects):
    return business(tables.read_table(spark, out)), rows(tables.read_table(spark, rejects).select("source_file", "line"))


def test_a_batch_that_has_ended_is_not_run_again(spark, lake):
    base, out, rejects, folder = lake
    ledger, lines = Ledger(spark, str(folder), "s"), telemetry.scan_lines(spark, str(base))
    assert land_batch(lines, 0, out, RUN_TS, rejects, ledger)
    assert not land_batch(lines, 0, out, RUN_TS, rejects, ledger)
    assert landed(spark, out, rejects) == whole(spark, base)
    files = ledger.files()
    assert rows(files, "source_file", "lines", "log_date", "batch") == [
        ("delivery_1_A_1.jsonl", 4, "2025-01-05", "s-000000000000"), ("delivery_2_B_1.jsonl", 2, "2025-01-05", "s-000000000000"),
        ("delivery_3_C_1.jsonl", 5, "2025-01-06", "s-000000000000"),
    ]


@pytest.mark.parametrize("step", ["begin", "record", "resolved", "end"])
def test_a_replayed_batch_adds_neither_points_nor_rejects(spark, lake, monkeypatch, step):
    """The driver dies at a step; the stream runs the batch again, with another time of load."""
    base, out, rejects, folder = lake
    lines = telemetry.scan_lines(spark, str(base))
    with monkeypatch.context() as patched:
        owner, calls = (landing, []) if step == "resolved" else (Ledger, [])
        real = getattr(owner, step)

        def killed(*args):
            calls.append(1)
            if step == "resolved" and len(calls) < 2:      # after the points, before the rejects
                return real(*args)
            raise Killed

        patched.setattr(owner, step, killed)
        with pytest.raises(Killed):
            land_batch(lines, 4, out, RUN_TS, rejects, Ledger(spark, str(folder), "s"))
    assert land_batch(lines, 4, out, RUN_TS + timedelta(hours=1), rejects, Ledger(spark, str(folder), "s"))
    assert landed(spark, out, rejects) == whole(spark, base)
    assert tables.read_table(spark, out).where("load_timestamp IS NULL").isEmpty()


def test_points_that_landed_in_part_are_completed(spark, lake):
    base, out, rejects, folder = lake
    ledger, lines = Ledger(spark, str(folder), "s"), telemetry.scan_lines(spark, str(base))
    points = telemetry.read_telemetry(spark, str(base), RUN_TS)
    half = points.where(f"ts % 2 = 0 OR ts = {START + 7}").dropDuplicates(["source_file", "ts"])
    half.write.partitionBy("log_date").parquet(out)     # one of two equal points, and not all others
    ledger.begin(ledger.batch(0))
    assert land_batch(lines, 0, out, RUN_TS, rejects, ledger)
    assert landed(spark, out, rejects) == whole(spark, base)


def test_numbers_of_a_new_checkpoint_are_not_taken_for_old_batches(spark, lake):
    base, out, rejects, folder = lake
    lines = telemetry.scan_lines(spark, str(base))
    assert land_batch(lines.where("dt = '2025-01-05'"), 0, out, RUN_TS, rejects, Ledger(spark, str(folder), "old"))
    assert land_batch(lines, 0, out, RUN_TS, rejects, Ledger(spark, str(folder), "new"))
    assert landed(spark, out, rejects) == whole(spark, base)


def test_points_go_to_the_current_version_of_a_published_table(spark, lake):
    base, out, rejects, folder = lake
    state = str(folder)

    def full():
        tables.publish_table(telemetry.read_telemetry(spark, str(base), RUN_TS), out, partition_by=["log_date"])
        tables.publish_table(telemetry.broken_lines(spark, str(base), RUN_TS), rejects)

    assert land_new_telemetry(spark, str(base), out, state, RUN_TS, rejected=rejects)
    assert landed(spark, out, rejects) == whole(spark, base)
    full()
    log(base / "dt=2025-01-06/delivery_4_D_1.jsonl", [point(START), "{x"])
    full()                                                  # has the new file before the stream sees it
    assert land_new_telemetry(spark, str(base), out, state, RUN_TS, rejected=rejects)
    assert landed(spark, out, rejects) == whole(spark, base)
    log(base / "dt=2025-01-07/delivery_5_E_1.jsonl", [point(START), "{y"])
    assert land_new_telemetry(spark, str(base), out, state, RUN_TS, rejected=rejects)
    assert landed(spark, out, rejects) == whole(spark, base)
    assert not land_new_telemetry(spark, str(base), out, state, RUN_TS, rejected=rejects)


def test_look_ups_read_only_the_days_of_the_batch(spark, lake):
    base, out, rejects, folder = lake
    ledger = Ledger(spark, str(folder), "s")
    land_batch(telemetry.scan_lines(spark, str(base)), 0, out, RUN_TS, rejects, ledger)
    both = [landing.of_days(table, ["2025-01-06"]) for table in (tables.read_table(spark, out), ledger.files())]
    for folder in (f"{out}/log_date=2025-01-05", f"{folder}/files/log_date=2025-01-05"):
        for file in Path(folder).rglob("*.parquet"):
            file.write_bytes(b"whoever reads this file fails")
            Path(f"{file.parent}/.{file.name}.crc").unlink()
    assert [df.count() for df in both] == [5, 1]
    for df in both:
        filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", df._jdf.queryExecution().executedPlan().toString()).group(1)
        assert "log_date" in filters


def test_many_small_batches(spark, lake):
    base, out, rejects, folder = lake
    assert land_new_telemetry(spark, str(base), out, str(folder), RUN_TS, rejected=rejects, files_per_batch=1)
    assert landed(spark, out, rejects) == whole(spark, base)
    name = landing.stream_name(spark, str(folder))
    assert {r[0] for r in Ledger(spark, f"{folder}_ledger", name).files().select("batch").collect()} == {f"{name}-{i:012d}" for i in range(3)}
