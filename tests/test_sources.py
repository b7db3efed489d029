from __future__ import annotations

import tracemalloc
import zipfile
from datetime import date, datetime
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cargolake.operators.aggregates import trip_metrics
from cargolake.plans.entities import clean_telemetry
from cargolake.schemas import DIM_VEHICLE, EXPENSE_SHEET, STAR, TELEMETRY_BRONZE, ddl
from cargolake.sources import operational, tables, telemetry, workbooks
from cargolake.streaming.telemetry import land_new_telemetry
from tests.conftest import RUN_TS, rows
from tests.files import HEADERS, log, point, workbook

LINE = ["05.03", "А123", "Иванов", "Топливо", "АЗС", "D1", 1200, "полный бак"]


def test_workbooks(spark, tmp_path):
    workbook(tmp_path / "март_2025.xlsx", [
        LINE, [*LINE[:5], None, 5.5, None], [None] * 8, [None] * 5 + ["ИТОГО:", 1205.5, None],
    ])
    workbook(tmp_path / "май 1_2025.xlsx", [["01.05", "Б1", "1 200,50 ₽"]], headers=["Дата", "Гос. номер", "Сумма, руб."], inline=True)
    (tmp_path / "broken_2025.xlsx").write_bytes(b"no zip file")
    (tmp_path / "notes.txt").write_text("x")
    got = workbooks.read_expense_books(spark, str(tmp_path), RUN_TS)
    assert got.columns == list(EXPENSE_SHEET)
    assert rows(got.select("`Дата`", "`Номер документа`", "`Сумма, руб.`", "source_file", "source_month")) == [
        ("01.05", None, "1 200,50 ₽", "май 1_2025.xlsx", "май 1_2025"),
        ("05.03", "D1", "1200", "март_2025.xlsx", "март_2025"),
        ("05.03", None, "5.5", "март_2025.xlsx", "март_2025"),   # no document number: stays
    ]
    assert {r[0] for r in got.select("load_date").collect()} == {RUN_TS}
    bad = workbooks.unreadable_books(spark, str(tmp_path)).collect()
    assert [r["source_file"] for r in bad] == ["broken_2025.xlsx"] and "BadZipFile" in bad[0]["read_error"]


def test_a_long_sheet_keeps_every_row(spark, tmp_path):
    n = 2 * workbooks.FRAME_ROWS + 5
    workbook(tmp_path / "long_2025.xlsx", [["01.01", "A", None, "Топливо", None, f"D{i}", i, None] for i in range(n)], inline=True)
    got = workbooks.read_expense_books(spark, str(tmp_path), RUN_TS)
    assert got.select("`Номер документа`").distinct().count() == got.count() == n


def test_a_sheet_that_breaks_off_gives_no_rows(spark, tmp_path):
    import zipfile

    workbook(tmp_path / "good_2025.xlsx", [LINE])
    workbook(tmp_path / "bad_2025.xlsx", [LINE, LINE])
    with zipfile.ZipFile(tmp_path / "bad_2025.xlsx") as z:
        parts = {name: z.read(name) for name in z.namelist()}
    parts["xl/worksheets/sheet1.xml"] = parts["xl/worksheets/sheet1.xml"][:-40]
    with zipfile.ZipFile(tmp_path / "bad_2025.xlsx", "w") as z:
        for name, data in parts.items():
            z.writestr(name, data)
    assert rows(workbooks.read_expense_books(spark, str(tmp_path), RUN_TS), "source_file") == [("good_2025.xlsx",)]
    assert rows(workbooks.unreadable_books(spark, str(tmp_path)), "source_file") == [("bad_2025.xlsx",)]


def test_many_workbooks_keep_every_row(spark, tmp_path):
    for i in range(30):
        workbook(tmp_path / f"m_{2000 + i}.xlsx", [[*LINE[:5], f"D{j}", j, None] for j in range(i + 1)], inline=i % 2 == 0)
    got = workbooks.read_expense_books(spark, str(tmp_path), RUN_TS)
    assert got.count() == sum(range(1, 31))
    assert got.select("source_file").distinct().count() == 30


@pytest.mark.parametrize("folder", ["empty", "missing"])
def test_no_source_files(spark, tmp_path, folder):
    (tmp_path / "empty").mkdir()
    base = str(tmp_path / folder)
    books = workbooks.read_expense_books(spark, base, RUN_TS)
    assert books.columns == list(EXPENSE_SHEET) and books.count() == 0
    assert workbooks.unreadable_books(spark, base).count() == 0
    logs = telemetry.read_telemetry(spark, base, RUN_TS)
    assert logs.columns == list(TELEMETRY_BRONZE) and logs.count() == 0
    assert telemetry.broken_lines(spark, base, RUN_TS).count() == 0


def test_workbook_survives_a_parquet_round_trip(spark, tmp_path):
    workbook(tmp_path / "raw" / "август_2025.xlsx", [LINE, [*LINE[:5], "D2", 7, None]])
    df = workbooks.read_expense_books(spark, str(tmp_path / "raw"), RUN_TS)
    tables.write_table(df, str(tmp_path / "out"))
    back = tables.read_table(spark, str(tmp_path / "out"))
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0 and back.count() == 2


def logs(base):
    log(base / "dt=2025-01-05" / "delivery_230_А 777_20250105_100000.jsonl", [
        point(1736071200000, 10.0), "", "   ", "{broken", point(1736071290000, 20.0), point(1736071290000, 20.0),
        {"ts": 1736071320000, "loc": None, "flags": {"abs": None, "car_id": None}}, point("late", 5.0),
    ])
    log(base / "dt=2025-01-06" / "delivery_231_B_20250106_100000.jsonl", [point(1736157600000)])
    log(base / "dt=2025-01-06" / "lonely.jsonl", [point(1736157600000)])
    log(base / "dt=2025-01-06" / "delivery_x_B_1.jsonl", [point(1736157600000), point(1736157700000)])
    log(base / "dt=2025-01-06" / "readme.txt", ["no log"])


def test_telemetry(spark, tmp_path):
    logs(tmp_path)
    raw = telemetry.read_telemetry(spark, str(tmp_path), RUN_TS)
    assert raw.columns == list(TELEMETRY_BRONZE)
    name = "delivery_230_А 777_20250105_100000.jsonl"
    assert rows(raw.where(raw.source_file == name), "order_key", "log_date", "ts", "lat", "rpm", "abs_active", "car_id") == [
        ("230", "2025-01-05", 1736071200000, 55.7, 900, True, "А1"),
        ("230", "2025-01-05", 1736071290000, 55.7, 900, True, "А1"),
        ("230", "2025-01-05", 1736071290000, 55.7, 900, True, "А1"),
        ("230", "2025-01-05", 1736071320000, None, None, None, None),
        ("230", "2025-01-05", None, 55.7, 900, True, "А1"),        # one odd field, the rest is kept
    ]
    assert rows(raw, "source_file", "order_key")[-1][0] == "lonely.jsonl"
    assert {r[0] for r in raw.where("source_file = 'lonely.jsonl'").select("order_key").collect()} == {None}
    assert rows(telemetry.broken_lines(spark, str(tmp_path), RUN_TS)) == [(name, "2025-01-05", "{broken")]

    clean = clean_telemetry(raw, RUN_TS)
    assert rows(clean, "order_key", "timestamp", "car_id")[:3] == [
        ("230", datetime(2025, 1, 5, 10, 0), "А1"), ("230", datetime(2025, 1, 5, 10, 1, 30), "А1"),
        ("230", datetime(2025, 1, 5, 10, 2), "UNKNOWN"),
    ]
    assert rows(trip_metrics(clean)) == [(230, 2, 10.0)]     # 231 has one point; x is no order number


def test_odd_fields_of_a_point(spark, tmp_path):
    log(tmp_path / "dt=2025-01-05" / "delivery_1_A_1.jsonl", [
        point("1736071200000", "5.5", h=12.9, eng={"rpm": "900", "thr": 1e1, "tmp": "hot"}, gps=7),
        '{"ts": 1736071200001, "spd": NaN, "loc": {"lat": "55.5", "lon": null}, "flags": {"abs": "true"}}',
        "[1, 2]", "7",
    ])
    raw = telemetry.read_telemetry(spark, str(tmp_path), RUN_TS)
    assert rows(raw.select("ts", "h", "rpm", "engine_temp", "lat", "lon", "abs_active", "gps.sat")) == [
        (1736071200000, 12, 900, None, 55.7, 37.6, True, None), (1736071200001, None, None, None, 55.5, None, True, None),
    ]
    assert rows(clean_telemetry(raw, RUN_TS), "spd", "engine_throttle", "engine_temp", "gps_hdop") == [
        (0.0, 0, -273, 99.9), (5.5, 10, -273, 99.9),
    ]
    assert rows(telemetry.broken_lines(spark, str(tmp_path), RUN_TS), "line") == [("7",), ("[1, 2]",)]


def test_new_logs_are_read_once(spark, tmp_path):
    base, out, state = tmp_path / "raw", str(tmp_path / "bronze"), str(tmp_path / "state")
    logs(base)
    land_new_telemetry(spark, str(base), out, state, RUN_TS)
    batch = telemetry.read_telemetry(spark, str(base), RUN_TS)
    landed = spark.read.parquet(out).select(*batch.columns)
    assert rows(landed.withColumn("log_date", landed.log_date.cast("string"))) == rows(batch)
    log(base / "dt=2025-01-07" / "delivery_300_C_1.jsonl", [point(1736244000000)])
    land_new_telemetry(spark, str(base), out, state, RUN_TS)
    land_new_telemetry(spark, str(base), out, state, RUN_TS)
    assert spark.read.parquet(out).count() == batch.count() + 1


def test_no_new_logs_without_a_folder(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for base in ("none", "empty"):
        assert not land_new_telemetry(spark, str(tmp_path / base), str(tmp_path / "out"), str(tmp_path / "state"), RUN_TS)
    assert tables.read_optional(spark, str(tmp_path / "out")) is None


def test_ingest_goes_on_after_a_failure(spark, tmp_path):
    def read(table):
        if table == "drivers":
            return spark.read.parquet(str(tmp_path / "nowhere"))
        return spark.createDataFrame([(1, table)], "id int, name string")

    report = operational.ingest_tables(spark, read, str(tmp_path / "out"), ["customers", "drivers", "vehicles"])
    got = {r["table"]: (r["status"], r["message"]) for r in report.collect()}
    assert got["customers"] == ("loaded", None) and got["vehicles"] == ("loaded", None)
    assert got["drivers"][0] == "failed" and "PATH_NOT_FOUND" in got["drivers"][1]
    assert tables.read_table(spark, str(tmp_path / "out" / "vehicles")).first()["name"] == "vehicles"


def test_a_key_that_cannot_be_read_stops_one_table_only(spark, tmp_path):
    def read(table):
        if table == "drivers":
            raise ValueError("no number: a-1")
        return spark.createDataFrame([(1,)], "id int")

    report = operational.ingest_tables(spark, read, str(tmp_path), ["drivers", "vehicles"])
    assert rows(report) == [("drivers", "failed", "no number: a-1"), ("vehicles", "loaded", None)]


def test_a_write_that_fails_midway_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(5), path)
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") > 60, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        tables.write_table(bad, path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    report = operational.ingest_tables(spark, lambda t: bad, str(tmp_path), ["t"])
    assert report.first()["status"] == "failed" and spark.read.parquet(path).count() == 5
    tables.write_table(spark.read.parquet(path).where("id < 2"), path)   # a table may be written from itself
    assert spark.read.parquet(path).count() == 2


def test_columns_and_fields_without_a_place_are_kept(spark, tmp_path):
    heads = ["Дата ", " Гос.  номер", "Сумма, руб.", "Пробег"]
    workbook(tmp_path / "июнь_2025.xlsx", [["01.06", "Б1", 5, "120"], ["02.06", "Б1", 6, None]], headers=heads)
    workbook(tmp_path / "other_2025.xlsx", [["x", "y"]], headers=["Foo", "Bar"])
    got = workbooks.read_expense_books(spark, str(tmp_path), RUN_TS)
    assert rows(got.select("`Дата`", "`Гос. номер`", "other_columns")) == [("01.06", "Б1", '{"Пробег": "120"}'), ("02.06", "Б1", None)]
    bad = workbooks.unreadable_books(spark, str(tmp_path)).collect()
    assert [r["source_file"] for r in bad] == ["other_2025.xlsx"] and "Дата" in bad[0]["read_error"]
    log(tmp_path / "dt=2025-01-05" / "delivery_1_A_1.jsonl", [point(1736071200000, tyre=2.5, dash={"a": 1}), point(1736071200001)])
    raw = telemetry.read_telemetry(spark, str(tmp_path), RUN_TS)
    assert rows(raw, "ts", "other_fields") == [(1736071200000, '{"tyre":"2.5","dash":"{\\"a\\":1}"}'), (1736071200001, None)]


def test_incremental_and_full_runs_in_turn(spark, tmp_path):
    base, out, state = tmp_path / "raw", str(tmp_path / "bronze"), str(tmp_path / "state")

    def batch():
        tables.write_table(telemetry.read_telemetry(spark, str(base), RUN_TS), out, partition_by=["log_date"])

    def points():
        return spark.read.parquet(out).count(), telemetry.read_telemetry(spark, str(base), RUN_TS).count()

    logs(base)
    land_new_telemetry(spark, str(base), out, state, RUN_TS)
    batch()
    log(base / "dt=2025-01-07" / "delivery_300_C_1.jsonl", [point(1736244000000)])
    assert land_new_telemetry(spark, str(base), out, state, RUN_TS)
    assert points() == (10, 10)
    log(base / "dt=2025-01-07" / "delivery_301_C_1.jsonl", [point(1736244000000), "{broken"])
    log(base / "outside.jsonl", [point(1)])      # not in a day folder: neither run takes it
    batch()
    assert land_new_telemetry(spark, str(base), out, state, RUN_TS, rejected=str(tmp_path / "rejected"))
    assert points() == (11, 11)
    assert spark.read.parquet(str(tmp_path / "rejected")).count() == 1
    assert not land_new_telemetry(spark, str(base), out, state, RUN_TS)


def test_new_points_of_a_small_day_are_one_file(spark, tmp_path):
    base = tmp_path / "raw"
    for i in range(12):
        log(base / f"dt=2025-01-0{1 + i % 3}" / f"delivery_{i}_A_1.jsonl", [point(1736071200000 + i)])
    land_new_telemetry(spark, str(base), str(tmp_path / "bronze"), str(tmp_path / "state"), RUN_TS)
    assert len(list((tmp_path / "bronze").glob("log_date=*/*.parquet"))) == 3


def test_optional_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.read_optional(spark, path) is None
    schema = {"a": "bigint", "b": "string"}
    assert tables.read_or_empty(spark, path, schema).columns == ["a", "b"]
    tables.write_table(spark.createDataFrame([(1,)], "a int"), path)
    assert rows(tables.read_or_empty(spark, path, schema)) == [(1, None)]
    with pytest.raises(AnalysisException):
        tables.read_table(spark, str(tmp_path / "other"))


def test_partitioned_write_makes_one_file_per_small_day(spark, tmp_path):
    df = spark.range(0, 4000, 1, 8).selectExpr("id", "concat('2025-01-0', 1 + id % 5) AS day")
    tables.write_table(df, str(tmp_path / "t"), partition_by=["day"])
    files = list((tmp_path / "t").glob("day=*/*.parquet"))
    assert len(files) == 5 and spark.read.parquet(str(tmp_path / "t")).count() == 4000
    tables.write_table(df.where("id < 3"), str(tmp_path / "t"), partition_by=["day"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3      # a full refresh drops old days


def test_sorted_files_let_a_key_lookup_skip_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.range(0, 4000, 1, 8).selectExpr("id % 100 AS key", "id", "'d' AS day")
    tables.write_table(df, str(tmp_path / "t"), partition_by=["day"], sort_by=["key", "id"])
    (file,) = (tmp_path / "t").glob("day=*/*.parquet")
    found = pq.read_table(file, columns=["key", "id"], partitioning=None).to_pylist()
    assert found == sorted(found, key=lambda r: (r["key"], r["id"])) and len(found) == 4000


def test_marts_are_declared_once(spark, tmp_path):
    gold = str(tmp_path)
    assert tables.declare_marts(spark, gold) == list(STAR)
    assert tables.declare_marts(spark, gold) == []
    assert tables.read_table(spark, f"{gold}/fact_orders").columns == list(STAR["fact_orders"])
    assert tables.declare_table(spark, "marts_test", {"a": "bigint"}) and not tables.declare_table(spark, "marts_test", {"a": "bigint"})
    spark.sql("DROP TABLE marts_test")


def test_dimension_keeps_the_latest_version(spark, tmp_path):
    def car(i, plate, ts):
        return (i, plate, "m", "", "gasoline", Decimal("1.6"), 0, "", True, ts)
    df = spark.createDataFrame([car(1, "new", datetime(2025, 1, 2)), car(1, "old", datetime(2025, 1, 1)), car(2, "b", datetime(2025, 1, 1))], ddl(DIM_VEHICLE))
    tables.publish_dimension(df, "dim_vehicle", str(tmp_path))
    assert rows(tables.read_table(spark, f"{tmp_path}/dim_vehicle"), "vehicle_id", "gov_number") == [(1, "new"), (2, "b")]


@pytest.mark.parametrize("sorted_layout", [False, True])
def test_an_empty_run_leaves_the_old_fact(spark, tmp_path, sorted_layout):
    fact = spark.createDataFrame([(i, 20250101 + i % 3) for i in range(50)], "order_key int, time_id int")
    gold = str(tmp_path)
    assert tables.publish_fact(fact, gold, source=fact, sorted_layout=sorted_layout)
    assert not tables.publish_fact(fact.limit(0), gold, source=fact.limit(0))
    assert tables.read_table(spark, f"{gold}/fact_orders").count() == 50
    assert tables.publish_fact(fact.limit(0), gold, source=fact.limit(0), skip_if_empty=False)
    assert tables.read_table(spark, f"{gold}/fact_orders").count() == 0


def test_sheet_headers_are_the_known_ones():
    assert list(EXPENSE_SHEET)[:8] == HEADERS


def test_dates_of_partition_folders(spark, tmp_path):
    logs(tmp_path)
    raw = telemetry.read_telemetry(spark, str(tmp_path), RUN_TS)
    clean = clean_telemetry(raw, RUN_TS)
    tables.write_table(clean, str(tmp_path / "silver"), partition_by=["event_date"])
    back = tables.read_table(spark, str(tmp_path / "silver"))
    assert rows(back.where(back.event_date == date(2025, 1, 5)), "order_key") == [("230",)] * 3


class Database:
    """Stands in for ``spark.read``: records what would be asked of a database."""

    def __init__(self, spark, rows, starts):
        self.spark, self.rows, self.starts, self.asked = spark, rows, starts, []

    def jdbc(self, url, table, **options):
        self.asked.append((table, options))
        if "COUNT(*)" in table:
            return self.spark.createDataFrame([(self.rows,)], "N long")
        if "NTILE" in table:
            return self.spark.createDataFrame([(k,) for k in self.starts], ["K"])
        return self.spark.createDataFrame([(1, "x")], "ID long, NAME string")


@pytest.mark.parametrize(
    "rows_there, starts, predicates",
    [
        (35, [90, 5, 20, 7], ["id < 7 OR id IS NULL", "id >= 7 AND id < 20", "id >= 20 AND id < 90", "id >= 90"]),
        (20, ["a", "o'b"], ["id < 'o''b' OR id IS NULL", "id >= 'o''b'"]),
        (12, [4], ["1 = 1"]),
        (10, [], None),
        (0, [], None),
    ],
)
def test_jdbc_reads_go_by_ranges_of_equal_rows(spark, rows_there, starts, predicates):
    database = Database(spark, rows_there, starts)
    session = type("Session", (), {"read": database})()
    df = operational.read_jdbc_table(session, "jdbc:x", "customers", {"user": "u"}, rows_per_task=10)
    assert df.columns == ["id", "name"]
    table, options = database.asked[-1]
    assert table == "customers" and options["properties"] == {"fetchsize": "10000", "user": "u"}
    assert options.get("predicates") == predicates
    if predicates:
        assert f"NTILE({-(-rows_there // 10)})" in database.asked[1][0]


def test_jdbc_loads_truncate_and_insert_in_batches():
    from unittest.mock import MagicMock

    df = MagicMock()
    df.count.return_value = 25
    tables.publish_jdbc(df, "jdbc:x", "gold.dim_time", {"user": "u"}, rows_per_writer=10)
    df.repartition.assert_called_once_with(3)
    calls = str(df.mock_calls)
    assert "mode('overwrite')" in calls and "option('truncate', True)" in calls
    assert "option('batchsize', 1000)" in calls and "jdbc('jdbc:x', 'gold.dim_time'" in calls


def test_a_sheet_is_streamed(tmp_path, monkeypatch):
    """The memory of a frame, not of a sheet: four times the rows, hardly more at the peak."""
    monkeypatch.setattr(workbooks, "FRAME_ROWS", 200)
    peaks = []
    for n in (1_000, 4_000):
        workbook(tmp_path / f"{n}.xlsx", [[f"{k}", "x" * 200] for k in range(n)], inline=True)
        content = (tmp_path / f"{n}.xlsx").read_bytes()
        batch = pd.DataFrame({"path": ["p"], "content": [content]})
        tracemalloc.start()
        sizes = [len(frame) for frame in workbooks._decode_all(iter([batch]))]
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert sizes == [200] * (n // 200)
    assert peaks[1] < 1.3 * peaks[0]


def test_damage_at_the_end_of_a_sheet_leaves_no_row(tmp_path, monkeypatch):
    monkeypatch.setattr(workbooks, "FRAME_ROWS", 10)
    workbook(tmp_path / "good.xlsx", [[f"{k}"] for k in range(100)], inline=True)
    with zipfile.ZipFile(tmp_path / "good.xlsx") as book, zipfile.ZipFile(tmp_path / "bad.xlsx", "w") as bad:
        for name in book.namelist():
            content = book.read(name)
            bad.writestr(name, content[: -len("</sheetData>")] if "sheet1" in name else content)
    batch = pd.DataFrame({"path": ["bad", "good"], "content": [(tmp_path / f"{n}.xlsx").read_bytes() for n in ("bad", "good")]})
    got = pd.concat(workbooks._decode_all(iter([batch])))
    assert (got["path"] == "bad").sum() == 1 and got.loc[got["path"] == "bad", "read_error"].notna().all()
    assert (got["path"] == "good").sum() == 100 and got.loc[got["path"] == "good", "read_error"].isna().all()
