from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from cargolake.functions.expenses import SHEET_HEADERS
from cargolake.plans import entities
from cargolake.plans.constraints import FOREIGN_KEYS, NOT_NULL, constraint_report
from cargolake.schemas import OPERATIONAL, SILVER_EXPENSES, TELEMETRY_BRONZE, ddl
from tests.conftest import RUN_TS, rows


def operational(spark, table, data):
    return spark.createDataFrame(data, ddl(OPERATIONAL[table]))


def test_customers(spark):
    raw = operational(spark, "customers", [
        (2, "later copy", "77", "c", "a", True),
        (1, " First ", "77", "c", "a", False),
        (3, None, " ab ", None, " ", None),
        (4, "B", "AB", "\t", "x", True),
        (5, "no inn", None, "c", "a", True),
        (6, "no inn either", None, "c", "a", True),
        (7, "blank inn", "  ", "c", "a", True),
        (8, "tab", "\tx1 \n", "c", "a", True),
    ])
    clean = entities.clean_customers(raw, RUN_TS)
    assert rows(clean.drop("etl_updated_at", "etl_hash")) == [
        (1, "First", "77", "c", "a", False),
        (3, "Unknown", "AB", "Not provided", "Not provided", True),
        (4, "B", "AB", "Not provided", "x", True),
        (8, "tab", "X1", "c", "a", True),
    ]
    assert {r[0] for r in clean.select("etl_updated_at").collect()} == {RUN_TS}
    strict = entities.clean_customers(raw, RUN_TS, dedup_after=True)
    assert rows(strict, "id") == [(1,), (3,), (8,)]


def test_suppliers(spark):
    raw = operational(spark, "suppliers", [(1, None, "a1", " ", None), (2, "x", "a1", "c", False), (3, "y", None, "c", True)])
    clean = entities.clean_suppliers(raw, RUN_TS)
    assert rows(clean.drop("etl_updated_at")) == [(1, "Unknown", "A1", "Not provided", True)]


def test_drivers_and_vehicles_need_their_key(spark):
    people = operational(spark, "drivers", [
        (1, "Ivanov Ivan", " ab 1 ", None, None), (2, " ", "cd", "+7", False),
        (3, "x", None, "1", True), (4, "y", " ", "1", True), (5, "copy", "cd", "1", True),
    ])
    assert rows(entities.clean_drivers(people, RUN_TS).drop("etl_updated_at")) == [
        (1, "Ivanov Ivan", "AB 1", "Not provided", True), (2, "Unknown", "CD", "+7", False),
    ]
    cars = operational(spark, "vehicles", [(1, "a 1", None, True), (2, None, "m", True), (3, "", "m", True), (4, "a 1", "m", True)])
    assert rows(entities.clean_vehicles(cars, RUN_TS).drop("etl_updated_at")) == [(1, "A 1", "Unknown", True)]


def test_warehouses_stay_without_a_name(spark):
    raw = operational(spark, "warehouses", [(1, "W", "a", None), (2, "W", "b", True), (3, None, None, False), (4, None, "z", True)])
    assert rows(entities.clean_warehouses(raw, RUN_TS).drop("etl_updated_at")) == [
        (1, "W", "a", True), (3, "Unknown", "Not provided", False),
    ]


def test_products(spark):
    raw = operational(spark, "products", [
        (1, "s1", "A", None, Decimal(5), Decimal(3), None), (2, "s2", None, "kg", None, Decimal(3), True),
        (3, " ", "C", "kg", Decimal(1), Decimal(3), True), (4, "s4", "D", "kg", Decimal(1), None, False),
    ])
    assert rows(entities.clean_products(raw, RUN_TS).drop("etl_updated_at")) == [
        (1, "S1", "A", "pcs", Decimal("5.00"), Decimal("3.00"), True, True),
        (2, "S2", "Unknown", "kg", Decimal("0.00"), Decimal("3.00"), True, False),
        (4, "S4", "D", "kg", Decimal("1.00"), Decimal("0.00"), False, True),
    ]


T = datetime(2025, 1, 5, 9)


def sale(i, total, created=T, number="n", vehicle=1, comment=None):
    return (i, number, date(2025, 1, 5), 1, 1, vehicle, 1, Decimal(total), comment, created)


def test_sale_headers(spark):
    headers = operational(spark, "sale_headers", [
        sale(1, 10), sale(2, 20), sale(3, 30), sale(4, 0), sale(5, 50, created=None),
        sale(6, 60, created=datetime(2025, 1, 6), number="later"), sale(6, 61, created=T, number="first"),
    ])
    items = operational(spark, "sale_items", [
        (1, 1, 1, Decimal(1), Decimal("2.50"), Decimal("2.50")),
        (2, 1, 1, Decimal(1), Decimal("3.00"), Decimal("3.00")),
        (3, 2, 1, Decimal(1), Decimal("3.00"), None),
        (4, 4, 1, Decimal(1), Decimal("4.00"), Decimal("4.00")),
    ])
    clean = entities.clean_sale_headers(headers, items, RUN_TS)
    assert rows(clean, "id", "total_amount", "number", "comment") == [
        ("1", Decimal("5.50"), "n", ""),      # the lines, not the header
        ("3", Decimal("30.00"), "n", ""),     # no lines: the header
        ("4", Decimal("4.00"), "n", ""),
        ("6", Decimal("61.00"), "first", ""),
    ]                                          # 2: only unreadable lines; 5: no creation time
    alone = entities.clean_sale_headers(headers, None, RUN_TS)
    assert rows(alone, "id") == [("1",), ("2",), ("3",), ("6",)]


def test_sale_ids_of_other_types_meet_as_text(spark):
    headers = operational(spark, "sale_headers", [sale(1, 10)])
    items = spark.createDataFrame([("1", "7"), ("x", "8")], "sale_id string, amount string")
    assert rows(entities.clean_sale_headers(headers, items, RUN_TS), "total_amount") == [(Decimal("7.00"),)]


def test_purchase_headers(spark):
    raw = operational(spark, "purchase_headers", [
        (1, "a", None, 1, 1, Decimal(0), None, T), (2, "b", None, 1, 1, Decimal(1), "c", None),
        (3, "c", date(2025, 1, 1), 1, 1, None, "c", None),
    ])
    clean = entities.clean_purchase_headers(raw, RUN_TS)
    assert rows(clean, "id", "date", "total_amount", "comment") == [
        ("1", T, Decimal("0.00"), ""), ("3", datetime(2025, 1, 1), None, "c"),
    ]


def test_stock_movements(spark):
    kinds = {**OPERATIONAL["stock_movements"], "movement_date": "string"}
    def move(i, before, change, after, when="2025-01-01 10:00:00", product=1):
        q = [None if x is None else Decimal(x) for x in (before, change, after)]
        return (i, when, "SALE", 1, "OUTCOME", product, 1, *q, None, None)
    raw = spark.createDataFrame([
        move(1, 5, -7, None), move(2, 5, None, 9), move(3, None, None, None), move(4, 5, 0, 5),
        move(5, 5, None, 5), move(6, 1, 1, 2, when="never"), move(7, 1, 1, 2, product=None),
    ], ddl(kinds))
    clean = entities.clean_stock_movements(raw, RUN_TS)
    assert rows(clean, "id", "quantity_change", "quantity_after", "is_negative_after", "comment", "created_by") == [
        (1, Decimal(-7), Decimal(-2), True, "", "system"),
        (2, Decimal(4), Decimal(9), False, "", "system"),
        (3, None, None, False, "", "system"),
    ]


def test_stock_balances(spark):
    raw = operational(spark, "stock_balances", [
        (1, 1, 1, Decimal(4)), (2, 1, 1, Decimal(-5)), (3, 1, 2, None), (4, None, 2, Decimal(3)), (5, 2, 2, Decimal(8)),
    ])
    clean = entities.clean_stock_balances(raw, RUN_TS)
    assert rows(clean.drop("etl_updated_at")) == [
        (2, 1, 1, Decimal("0.000")), (3, 1, 2, None), (5, 2, 2, Decimal("8.000")),
    ]


def sheet(spark, data):
    names = [*SHEET_HEADERS, "source_file", "source_month", "load_date"]
    schema = ", ".join(f"`{n}` {'timestamp_ntz' if n == 'load_date' else 'string'}" for n in names)
    return spark.createDataFrame(data, schema)


def entry(d="05.03", plate="a1", driver="Ivanov", label="Топливо", doc="1", amount="100", month="март_2025", load=T):
    return (d, plate, driver, label, "shop", doc, amount, None, f"{month}.xlsx", month, load)


def lookups_of(spark):
    cars = operational(spark, "vehicles", [(7, "A1", "m", False)])
    people = operational(spark, "drivers", [(3, "Ivanov Ivan", "L", "p", True)])
    return cars, people


def test_expenses(spark):
    raw = sheet(spark, [
        entry(), entry(load=datetime(2025, 1, 6)),           # the same row, loaded twice
        entry(doc="2", plate=" A1 ", amount="1 200,50 ₽", label=" Мойка ", driver=" Ivanov   Ivan "),
        entry(doc=None, plate=None, driver=None, label=None, amount="0"),
        entry(doc="4", d="31.02"), entry(doc="5", amount="-1"), entry(doc="6", amount="abc"),
        entry(doc="7", month="март"), entry(doc="8", label="Ремонт (запчасти)", plate="zz"),
    ])
    clean = entities.clean_expenses(raw, *lookups_of(spark), RUN_TS)
    assert clean.columns == list(SILVER_EXPENSES)
    got = rows(clean, "document_number", "vehicle_plate", "vehicle_id", "driver_name", "driver_id", "expense_category",
               "expense_category_en", "amount_rub", "expense_date")
    d = date(2025, 3, 5)
    assert got == [
        ("1", "A1", 7, "Ivanov", 3, "Топливо", "fuel", Decimal("100.00"), d),
        ("2", "A1", 7, "Ivanov Ivan", 3, "Мойка", "wash", Decimal("1200.50"), d),
        ("8", "ZZ", 0, "Ivanov", 3, "Ремонт (запчасти)", "other", Decimal("100.00"), d),
        (None, "UNKNOWN", 0, "Unknown", 0, "Other", "other", Decimal("0.00"), d),
    ]
    first = clean.where("document_number = '1'").first()
    assert (first["etl_source"], first["record_type"], first["load_date"]) == ("excel/all_expenses", "expense", T)


def test_expenses_without_lookups(spark):
    cars, _ = lookups_of(spark)
    for vehicles, drivers in ((None, None), (cars, None)):
        clean = entities.clean_expenses(sheet(spark, [entry()]), vehicles, drivers, RUN_TS)
        assert rows(clean, "vehicle_id", "driver_id", "expense_category_en") == [(0, 0, "other")]


def test_telemetry(spark):
    full = dict(loc=(1.0, 2.0), acc=(0.1, 0.2), eng=(900, 10, 80), flags=(True, False, 1, " а1 "), gps=(7, 1.1), spd=5.0, h=10)
    bare = dict(loc=None, acc=None, eng=None, flags=None, gps=None, spd=None, h=None)
    def point(ts, key="230", load=T, **fields):
        f = {**full, **fields}
        lifted = (None,) * 8
        return (ts, f["loc"], f["spd"], f["h"], f["acc"], f["eng"], f["flags"], f["gps"], "f.jsonl", "2025-01-05", load, key, *lifted)
    raw = spark.createDataFrame(
        [point(1000), point(1000, load=datetime(2025, 1, 6)), point(2000, **bare), point(None), point(3000, key=None)],
        ddl(TELEMETRY_BRONZE),
    )
    clean = entities.clean_telemetry(raw, RUN_TS)
    assert rows(clean, "timestamp", "event_date", "spd", "h", "latitude", "longitude", "acc_lon", "acc_lat") == [
        (datetime(1970, 1, 1, 0, 0, 1), date(1970, 1, 1), 5.0, 10, 1.0, 2.0, 0.1, 0.2),
        (datetime(1970, 1, 1, 0, 0, 2), date(1970, 1, 1), 0.0, -1, 0.0, 0.0, 0.0, 0.0),
    ]
    assert rows(clean, "engine_rpm", "engine_throttle", "engine_temp", "flag_abs", "flag_belt", "flag_doors", "car_id", "gps_satellites", "gps_hdop") == [
        (0, 0, -273, False, False, 0, "UNKNOWN", 0, 99.9),
        (900, 10, 80, True, False, 1, "А1", 7, 1.1),
    ]
    assert not {"loc", "acc", "eng", "flags", "gps", "ts"} & set(clean.columns)
    assert rows(clean.where(F.col("spd") == 5.0), "load_timestamp") == [(T,)]


def test_constraint_report(spark):
    tables = {
        "products": operational(spark, "products", [
            (1, "s1", "A", "kg", None, None, True), (2, "s1", None, "kg", None, None, True), (3, None, "C", "kg", None, None, True),
        ]),
        "sale_headers": operational(spark, "sale_headers", [sale(1, 10), sale(1, 10, number="m")]),
        "sale_items": operational(spark, "sale_items", [
            (1, 1, 1, Decimal(2), Decimal("1.50"), Decimal("3.00")),
            (2, 9, 1, Decimal(0), Decimal("-1.50"), Decimal("0.00")),
            (3, 9, 7, Decimal(1), Decimal("1.00"), Decimal("5.00")),
            (4, 1, None, None, Decimal("1.00"), None),
        ]),
    }
    found = {(r["table"], r["rule"]): r["violations"] for r in constraint_report(tables).collect()}
    assert {k: n for k, n in found.items() if n} == {
        ("products", "not null: sku"): 1, ("products", "not null: name"): 1, ("products", "unique: sku"): 1,
        ("sale_headers", "unique: id"): 1,
        ("sale_items", "check: quantity"): 1, ("sale_items", "check: selling_price"): 1, ("sale_items", "derived: amount"): 1,
        ("sale_items", "foreign key: product_id"): 1, ("sale_items", "foreign key: sale_id"): 2,
        ("sale_items", "not null: product_id"): 1, ("sale_items", "not null: quantity"): 1,
    }
    assert ("sale_headers", "foreign key: customer_id") not in found      # its table was not given


def test_every_rule_names_known_columns():
    for table, columns in NOT_NULL.items():
        assert set(columns) <= set(OPERATIONAL[table])
    assert sum(len(keys) for keys in FOREIGN_KEYS.values()) == 14
    for table, keys in FOREIGN_KEYS.items():
        assert set(keys) <= set(OPERATIONAL[table]) and set(keys.values()) <= set(OPERATIONAL)
