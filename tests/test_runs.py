"""From raw files to the three reports."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

import pytest

from cargolake.config import WarehouseConfig
from cargolake.plans import runs
from cargolake.schemas import OPERATIONAL, STAR, ddl
from cargolake.sources.tables import publish_fact, read_table, write_table
from tests.conftest import RUN_TS, rows
from tests.files import log, point, workbook


def operational(spark, cfg):
    """The operational tables as the ingest leaves them."""
    day = lambda d, h=10: datetime(2025, 3, d, h)
    money = Decimal
    sales = [
        (1, "S1", date(2025, 3, 5), 1, 1, 1, 1, money(0), None, day(5)),
        (2, "S2", date(2025, 3, 5), 1, 1, 1, 1, money(80), None, day(5, 12)),
        (3, "S3", date(2025, 3, 12), 2, 2, 2, 2, money(70), "x", day(12)),
        (4, "S4", date(2025, 3, 12), 2, 2, 2, 2, money(0), "no amount", day(12)),
        (5, "S5", date(2023, 3, 12), 3, None, None, 2, money(55), "before the calendar", datetime(2023, 3, 12)),
    ]
    data = {
        "customers": [(i, f"C{i}", f"inn{i}", None, None, True) for i in (1, 2, 3)],
        "suppliers": [(1, "Sup", "s1", None, True)],
        "warehouses": [(1, "North", "a", True), (2, "South", "b", True)],
        "drivers": [(1, "Иванов Иван", "L1", None, True), (2, "Петров Петр", "L2", None, True)],
        "vehicles": [(1, "А 1", "Gazelle", True), (2, "Б2", "Truck", True)],
        "products": [(1, "p1", "Nail", None, money(2), money(1), True)],
        "purchase_headers": [(1, "P1", None, 1, 1, money(0), None, day(1))],
        "purchase_items": [(1, 1, 1, money(2), money(3), money(6))],
        "sale_headers": sales,
        "sale_items": [(1, 1, 1, money(1), money(100), money(100)), (2, 1, 1, money(1), money(50), money(50))],
        "stock_balances": [(1, 1, 1, money(-4))],
        "stock_movements": [(1, day(1), "SALE", 1, "OUTCOME", 1, 1, money(5), money(-7), None, None, None)],
    }
    for table, values in data.items():
        write_table(spark.createDataFrame(values, ddl(OPERATIONAL[table])), cfg.bronze(f"postgres/{table}"))


def raw_files(root):
    workbook(root / "raw/excel/март_2025.xlsx", [
        ["05.03", "а 1", "Иванов", "Топливо", "АЗС", "D1", 30, None],
        ["05.03", "А 1", "Иванов Иван", "Ремонт", "СТО", None, 20, None],
        ["12.03", "Б2", "Никто", "Мойка", "М", "D3", "100,50 ₽", None],
        ["12.03", "zz", "Иванов", "Топливо", "АЗС", "D4", 9, None],
        [None] * 5 + ["ИТОГО:", 159.5, None],
    ])
    start = 1741168800000  # 2025-03-05 10:00 UTC
    log(root / "raw/json/dt=2025-03-05/delivery_1_А 1_20250305_100000.jsonl", [point(start + 30000 * i, 10.0 + i) for i in range(9)])
    log(root / "raw/json/dt=2025-03-05/delivery_3_Б2_20250305_100000.jsonl", [point(start)])


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    cfg = WarehouseConfig(root=str(root), run_ts=RUN_TS, as_of=date(2025, 3, 31))
    raw_files(root)
    operational(spark, cfg)
    bronze = runs.run_bronze(spark, cfg)
    counters = runs.run_silver(spark, cfg)
    published = runs.run_gold(spark, cfg)
    return cfg, bronze, counters, published


def test_bronze_outcome(loaded):
    _, bronze, _, published = loaded
    assert bronze == {"tables": "skipped", "books": "loaded", "logs": "loaded"} and published == {"orders": 4, "matched_trips": 1}


def test_counters_of_the_expense_load(loaded):
    counters = loaded[2]["expenses"]
    assert (counters["rows"], counters["mapped_vehicles"], counters["mapped_drivers"]) == (4, 3, 3)
    assert (counters["first_date"], counters["last_date"]) == (date(2025, 3, 5), date(2025, 3, 12))


def test_counters_of_the_other_tables(loaded):
    counters = loaded[2]
    assert counters["sale_headers"] == {"rows": 4, "removed": 1}
    assert counters["products"] == {"rows": 1, "price_issues": 1}
    assert counters["stock_movements"] == {"rows": 1, "negative_balances": 1}
    assert counters["telemetry"] == {"rows": 10, "orders": 2, "files": 2}


def test_silver_tables(spark, loaded):
    cfg = loaded[0]
    assert rows(read_table(spark, cfg.silver("postgres/sale_headers")), "id", "total_amount") == [
        ("1", Decimal("150.00")), ("2", Decimal("80.00")), ("3", Decimal("70.00")), ("5", Decimal("55.00")),
    ]
    assert rows(read_table(spark, cfg.silver("postgres/stock_balances")), "quantity") == [(Decimal("0.000"),)]
    quality = read_table(spark, cfg.silver("metadata/quality_report"))
    assert quality.select("table").distinct().count() == 10
    counts = {r["table"]: r["value"] for r in quality.where("metric = 'row_count'").collect()}
    assert counts["sale_headers"] == 4 and counts["customers"] == 3
    assert read_table(spark, cfg.silver("json/telemetry")).count() == 10


def test_columns_of_the_telemetry(spark, loaded):
    silver = read_table(spark, loaded[0].silver("json/telemetry"))
    assert set(silver.columns) == set(
        "spd h source_file log_date load_timestamp order_key lat lon rpm abs_active latitude longitude acc_lon acc_lat "
        "engine_rpm engine_throttle engine_temp flag_abs flag_belt flag_doors car_id gps_satellites gps_hdop timestamp "
        "etl_updated_at etl_source record_type event_date".split()
    )
    assert dict(silver.dtypes)["log_date"] == "string" and dict(silver.dtypes)["event_date"] == "date"


def test_costs_add_up(spark, loaded):
    cfg = loaded[0]
    by_day = read_table(spark, cfg.silver("aggregated/expenses_by_vehicle"))
    assert rows(by_day) == [
        (0, date(2025, 3, 12), Decimal("9.00"), Decimal("0.00"), Decimal("0.00"), Decimal("9.00")),
        (1, date(2025, 3, 5), Decimal("30.00"), Decimal("0.00"), Decimal("0.00"), Decimal("50.00")),
        (2, date(2025, 3, 12), Decimal("0.00"), Decimal("0.00"), Decimal("100.50"), Decimal("100.50")),
    ]
    spent = read_table(spark, cfg.silver("excel/all_expenses")).agg({"amount_rub": "sum"}).first()[0]
    assert by_day.agg({"total_expense": "sum"}).first()[0] == spent


def test_star(spark, loaded):
    cfg = loaded[0]
    for name, schema in STAR.items():
        df = read_table(spark, cfg.gold(name))
        assert [(f.name, f.dataType.simpleString()) for f in df.schema] == list(schema.items())
    fact = read_table(spark, cfg.gold("fact_orders"))
    assert rows(fact, "order_key", "vehicle_id", "total_vehicle_expense", "net_profit", "trip_duration_minutes", "avg_speed_kmh") == [
        (1, 1, Decimal("50.00"), Decimal("100.00"), 4, 14.0),
        (2, 1, Decimal("50.00"), Decimal("30.00"), 0, 0.0),
        (3, 2, Decimal("100.50"), Decimal("-30.50"), 0, 0.0),
        (5, 0, Decimal("0.00"), Decimal("55.00"), 0, 0.0),
    ]
    assert fact.count() == read_table(spark, cfg.silver("postgres/sale_headers")).count()


def test_reports(spark, loaded):
    got = runs.run_reports(spark, loaded[0])
    assert rows(got["rfm"], "customer_id", "recency_days", "frequency", "monetary") == [
        (1, 26, 2, Decimal("130.00")), (2, 19, 1, Decimal("-30.50")),      # 3 bought before the calendar
    ]
    assert got["vehicle_efficiency"].count() == 0                           # nobody drove five times
    assert rows(got["weekly_warehouse"], "warehouse_name", "week_start", "weekly_profit") == [
        ("North", date(2025, 3, 2), Decimal("130.00")), ("South", date(2025, 3, 9), Decimal("-30.50")),
    ]


def test_a_second_run_gives_the_same_star(spark, loaded):
    cfg = loaded[0]
    before = {name: rows(read_table(spark, cfg.gold(name))) for name in STAR}
    got = runs.run_all(spark, cfg)
    assert got["bronze"]["books"] == "loaded" and got["silver"]["customers"] == {"rows": 3}
    assert got["gold"] == {"orders": 4, "matched_trips": 1}
    assert {name: rows(read_table(spark, cfg.gold(name))) for name in STAR} == before


def test_missing_sources_give_a_plain_star(spark, tmp_path):
    cfg = WarehouseConfig(root=str(tmp_path), run_ts=RUN_TS, as_of=date(2025, 3, 31))
    operational(spark, cfg)
    assert not {"expenses", "telemetry"} & set(runs.run_silver(spark, cfg))
    assert runs.run_gold(spark, cfg) == {"orders": 4, "matched_trips": 0}
    fact = read_table(spark, cfg.gold("fact_orders"))
    assert fact.count() == 4 and fact.agg({"total_vehicle_expense": "sum"}).first()[0] == 0


def test_text_columns_are_read_leniently(spark, tmp_path):
    cfg = WarehouseConfig(root=str(tmp_path), run_ts=RUN_TS, as_of=date(2025, 3, 31))
    operational(spark, cfg)
    text = ", ".join(f"{c} string" for c in OPERATIONAL["stock_movements"])
    moves = [
        ("1", "2025-03-01 10:00:00", "SALE", "1", "OUTCOME", "1", "1", "5", "many", "9", None, None),
        ("2", "some day", "SALE", "1", "OUTCOME", "1", "1", "5", "1", "6", None, None),
    ]
    write_table(spark.createDataFrame(moves, text), cfg.bronze("postgres/stock_movements"))
    counters = runs.run_silver(spark, cfg)
    assert counters["stock_movements"]["rows"] == 1
    assert rows(read_table(spark, cfg.silver("postgres/stock_movements")), "id", "quantity_change") == [(1, Decimal(4))]


def test_bronze_goes_on_when_a_source_fails(spark, tmp_path):
    raw_files(tmp_path)
    cfg = WarehouseConfig(root=str(tmp_path), run_ts=RUN_TS, as_of=date(2025, 3, 31))
    (tmp_path / "bronze").mkdir()
    (tmp_path / "bronze/excel").write_text("a file where a folder should be")
    got = runs.run_bronze(spark, cfg)
    assert got["books"].startswith("failed") and got["logs"] == "loaded"


def test_sources_that_are_gone_leave_the_old_tables(spark, tmp_path):
    raw_files(tmp_path)
    cfg = WarehouseConfig(root=str(tmp_path), run_ts=RUN_TS, as_of=date(2025, 3, 31))
    runs.run_bronze(spark, cfg)
    tables = {"excel/all_expenses": 4, "json/telemetry": 10}
    for folder in ("excel", "json"):
        (tmp_path / "raw" / folder).rename(tmp_path / "raw" / f"{folder}-gone")
    for make in (False, True):      # missing, then empty
        if make:
            (tmp_path / "raw/excel").mkdir()
            (tmp_path / "raw/json/dt=2025-03-05").mkdir(parents=True)
        assert runs.run_bronze(spark, cfg) == {"tables": "skipped", "books": "no files", "logs": "no files"}
        assert {t: read_table(spark, cfg.bronze(t)).count() for t in tables} == tables
    (tmp_path / "raw/excel/bad_2025.xlsx").write_bytes(b"no zip file")
    assert runs.run_bronze(spark, cfg)["books"] == "failed: no readable book"
    assert read_table(spark, cfg.bronze("excel/all_expenses")).count() == 4


def test_rejected_input_is_stored_and_counted(spark, tmp_path):
    raw_files(tmp_path)
    (tmp_path / "raw/excel/bad_2025.xlsx").write_bytes(b"no zip file")
    log(tmp_path / "raw/json/dt=2025-03-06/delivery_9_A_1.jsonl", ["{broken", "7", point(1741770000000)])
    cfg = WarehouseConfig(root=str(tmp_path), run_ts=RUN_TS, as_of=date(2025, 3, 31))
    assert runs.run_bronze(spark, cfg) == {"tables": "skipped", "books": "loaded, 1 books rejected", "logs": "loaded, 2 lines rejected"}
    assert rows(read_table(spark, cfg.bronze("quarantine/books")), "source_file") == [("bad_2025.xlsx",)]
    assert rows(read_table(spark, cfg.bronze("quarantine/lines")), "line") == [("7",), ("{broken",)]
    assert read_table(spark, cfg.bronze("json/telemetry")).count() == 11


def test_a_table_that_fails_stops_no_other(spark, tmp_path):
    import shutil

    raw_files(tmp_path)
    cfg = WarehouseConfig(root=str(tmp_path), run_ts=RUN_TS, as_of=date(2025, 3, 31))
    operational(spark, cfg)
    runs.run_all(spark, cfg)
    shutil.rmtree(cfg.bronze("postgres/customers"))
    shutil.rmtree(cfg.bronze("postgres/stock_movements"))
    got = runs.run_all(spark, cfg)
    assert {t for t, c in got["silver"].items() if "failed" in c} == {"customers", "stock_movements"}
    assert "PATH_NOT_FOUND" in got["silver"]["customers"]["failed"]
    assert got["silver"]["expenses"]["rows"] == 4 and got["silver"]["telemetry"]["rows"] == 10
    assert got["gold"] == {"orders": 4, "matched_trips": 1, "skipped": ["dim_customer"]}
    assert read_table(spark, cfg.gold("dim_customer")).count() == 3
    shutil.rmtree(cfg.bronze("postgres/sale_headers"))
    got = runs.run_all(spark, cfg)
    assert got["gold"] == {"skipped": ["dim_customer", "fact_orders"]}
    assert read_table(spark, cfg.gold("fact_orders")).count() == 4


def test_marts_are_loaded_into_the_database(spark, loaded, monkeypatch):
    sent = {}
    monkeypatch.setattr(runs, "publish_jdbc", lambda df, url, table, properties, rows: sent.update({table: (url, df.count(), rows)}))
    cfg = replace(loaded[0], mart_url="jdbc:x", jdbc_rows=7)
    assert runs.run_gold(spark, cfg) == {"orders": 4, "matched_trips": 1}
    assert sent["gold.fact_orders"] == ("jdbc:x", 4, 7)
    assert set(sent) == {f"gold.{n}" for n in ("dim_time", "dim_customer", "dim_driver", "dim_vehicle", "dim_warehouse", "dim_product", "fact_orders")}


def test_incremental_logs_reach_the_same_fact(spark, loaded, tmp_path):
    raw_files(tmp_path)
    cfg = WarehouseConfig(root=str(tmp_path), run_ts=RUN_TS, as_of=date(2025, 3, 31), incremental_logs=True)
    operational(spark, cfg)
    runs.run_all(spark, cfg)
    log(tmp_path / "raw/json/dt=2025-03-12/delivery_3_Б2_20250312_100000.jsonl", [point(1741770000000 + 60000 * i) for i in range(3)])
    assert runs.run_all(spark, cfg)["gold"] == {"orders": 4, "matched_trips": 2}
    fact = read_table(spark, cfg.gold("fact_orders"))
    assert rows(fact.where("order_key <> 3")) == rows(read_table(spark, loaded[0].gold("fact_orders")).where("order_key <> 3"))


def test_no_sales_leave_the_old_fact(spark, loaded):
    cfg = loaded[0]
    write_table(read_table(spark, cfg.bronze("postgres/sale_headers")).where("1 = 0"), cfg.bronze("postgres/none"))
    none = read_table(spark, cfg.bronze("postgres/none"))
    assert not publish_fact(none, cfg.gold("").rstrip("/"), source=none)
    assert read_table(spark, cfg.gold("fact_orders")).count() == 4


def test_credentials_are_not_printed():
    cfg = WarehouseConfig(root="r", run_ts=RUN_TS, as_of=date(2025, 1, 1), jdbc_properties={"password": "secret"})
    assert "secret" not in repr(cfg) and "secret" not in repr(replace(cfg, root="x"))


def test_constraint_report_of_the_ingested_tables(spark, loaded):
    cfg = loaded[0]
    runs.run_checks(spark, cfg)
    report = read_table(spark, cfg.silver("metadata/constraint_report"))
    broken = {(r["table"], r["rule"]): r["violations"] for r in report.where("violations > 0").collect()}
    assert broken == {
        ("products", "not null: unit"): 1, ("purchase_headers", "not null: date"): 1,
        ("stock_balances", "check: quantity"): 1, ("stock_movements", "not null: quantity_after"): 1,
    }
    assert report.where("rule LIKE 'foreign key%'").count() == 14
