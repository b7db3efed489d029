"""Entity plans and their lookups."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from cargolake.catalog.registry import query
from cargolake.catalog.views import EPOCH_MILLIS, RUN_TS, SQL, TAB, Views, ctes
from cargolake.functions.expenses import SHEET_HEADERS
from cargolake.operators import aggregates, lookups
from cargolake.operators.aggregates import mapping_metrics, unmapped_keys as unmapped
from cargolake.operators.cleaning import flag
from cargolake.plans import entities

BLANK = f"' {TAB}' || chr(10) || chr(13)"


def text(column: str, upper: bool = False) -> str:
    c = f"nullif(trim({column}, {BLANK}), '')"
    return f"upper({c})" if upper else c


def firsts(view: str, key: str) -> str:
    """SQL for the first row per raw key."""
    return (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY id) AS place FROM {view})"
        " WHERE place = 1"
    )


@query(f"""
    WITH {ctes('customers')}, kept AS ({firsts('customers', 'inn')}),
    clean AS (
        SELECT id, coalesce({text('name')}, 'Unknown') AS name, {text('inn', True)} AS inn,
               coalesce({text('contacts')}, 'Not provided') AS contacts,
               coalesce({text('address')}, 'Not provided') AS address, {text('customer_segment')} AS customer_segment,
               coalesce(is_active, true) AS is_active
        FROM kept
    )
    SELECT *, sha256(inn || chr(31) || name) AS etl_hash FROM clean WHERE inn IS NOT NULL
""")
def clean_customers(v: Views) -> DataFrame:
    return entities.clean_customers(v.customers, RUN_TS).drop("etl_updated_at")


@query(f"""
    WITH {ctes('drivers')}, kept AS ({firsts('drivers', 'license_number')}),
    clean AS (
        SELECT id, coalesce({text('full_name')}, 'Unknown') AS full_name, {text('license_number', True)} AS license_number,
               coalesce({text('phone')}, 'Not provided') AS phone, coalesce(is_active, true) AS is_active
        FROM kept
    )
    SELECT * FROM clean WHERE license_number IS NOT NULL AND license_number <> 'NO_LICENSE'
""")
def clean_drivers(v: Views) -> DataFrame:
    return entities.clean_drivers(v.drivers, RUN_TS).drop("etl_updated_at")


@query(f"""
    WITH {ctes('vehicles')}, kept AS ({firsts('vehicles', 'plate_number')}),
    clean AS (
        SELECT id, {text('plate_number', True)} AS plate_number, coalesce({text('model')}, 'Unknown') AS model,
               coalesce(is_active, true) AS is_active
        FROM kept
    )
    SELECT * FROM clean WHERE plate_number IS NOT NULL AND plate_number <> 'NO_PLATE'
""")
def clean_vehicles(v: Views) -> DataFrame:
    return entities.clean_vehicles(v.vehicles, RUN_TS).drop("etl_updated_at")


@query(f"""
    WITH {ctes('suppliers')}, kept AS ({firsts('suppliers', 'inn')}),
    clean AS (
        SELECT id, coalesce({text('name')}, 'Unknown') AS name, {text('inn', True)} AS inn,
               coalesce({text('contacts')}, 'Not provided') AS contacts, coalesce(is_active, true) AS is_active
        FROM kept
    )
    SELECT * FROM clean WHERE inn IS NOT NULL
""")
def clean_suppliers(v: Views) -> DataFrame:
    return entities.clean_suppliers(v.suppliers, RUN_TS).drop("etl_updated_at")


@query(f"""
    WITH {ctes('warehouses')}, kept AS ({firsts('warehouses', 'name')})
    SELECT id, coalesce({text('name')}, 'Unknown') AS name, coalesce({text('address')}, 'Not provided') AS address,
           coalesce(is_active, true) AS is_active
    FROM kept
""")
def clean_warehouses(v: Views) -> DataFrame:
    return entities.clean_warehouses(v.warehouses, RUN_TS).drop("etl_updated_at")


@query(f"""
    WITH {ctes('products')}, kept AS ({firsts('products', 'sku')}),
    clean AS (
        SELECT id, {text('sku', True)} AS sku, coalesce({text('name')}, 'Unknown') AS name,
               coalesce({text('unit')}, 'pcs') AS unit,
               coalesce(TRY_CAST(cost_price AS DECIMAL(15,2)), 0) AS cost,
               coalesce(TRY_CAST(selling_price AS DECIMAL(15,2)), 0) AS selling,
               coalesce(is_active, true) AS is_active
        FROM kept
    )
    SELECT id, sku, name, unit, CAST(cost AS DOUBLE) AS cost_price, CAST(selling AS DOUBLE) AS selling_price,
           is_active, selling < cost AS price_logic_issue
    FROM clean WHERE sku IS NOT NULL
""")
def clean_products(v: Views) -> DataFrame:
    return entities.clean_products(v.products, RUN_TS).drop("etl_updated_at")


@query("""
    WITH raw AS (
        SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date,
               CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS created_at,
               CASE WHEN o_orderpriority = '2-HIGH' THEN 'free' ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) END AS total_amount,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'ok' END AS comment
        FROM orders
    ),
    typed AS (
        SELECT CAST(id AS VARCHAR) AS id, coalesce(TRY_CAST(date AS TIMESTAMP), TRY_CAST(created_at AS TIMESTAMP)) AS d,
               TRY_CAST(created_at AS TIMESTAMP) AS c, CAST(TRY_CAST(total_amount AS DECIMAL(15,2)) AS DOUBLE) AS total_amount,
               coalesce(comment, '') AS comment
        FROM raw
    )
    SELECT id, strftime(d, '%Y-%m-%d %H:%M:%S.%g') AS date, strftime(c, '%Y-%m-%d %H:%M:%S.%g') AS created_at,
           total_amount, comment
    FROM typed WHERE d IS NOT NULL
""")
def clean_purchase_headers(v: Views) -> DataFrame:
    raw = v.table("orders").selectExpr(
        "o_orderkey AS id",
        "CASE WHEN o_orderstatus = 'F' THEN 'unknown' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS date",
        "CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') END AS created_at",
        "CASE WHEN o_orderpriority = '2-HIGH' THEN 'free' ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) END AS total_amount",
        "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'ok' END AS comment",
    )
    return entities.clean_purchase_headers(raw, RUN_TS).drop("etl_updated_at")


@query(f"""
    WITH {ctes('movements')},
    kept AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (
                PARTITION BY id ORDER BY movement_date NULLS LAST, document_id NULLS LAST, product_id NULLS LAST,
                warehouse_id NULLS LAST, TRY_CAST(quantity_before AS DECIMAL(15,3)) NULLS LAST,
                TRY_CAST(quantity_change AS DECIMAL(15,3)) NULLS LAST, TRY_CAST(quantity_after AS DECIMAL(15,3)) NULLS LAST,
                comment NULLS LAST, created_by NULLS LAST) AS place
            FROM movements
        ) WHERE place = 1
    ),
    typed AS (
        SELECT *, TRY_CAST(movement_date AS TIMESTAMP) AS d, TRY_CAST(quantity_before AS DECIMAL(15,3)) AS b,
               TRY_CAST(quantity_change AS DECIMAL(15,3)) AS c, TRY_CAST(quantity_after AS DECIMAL(15,3)) AS a
        FROM kept
    ),
    after_known AS (SELECT *, coalesce(a, b + c) AS a2 FROM typed),
    repaired AS (SELECT *, coalesce(c, a2 - b) AS c2 FROM after_known)
    SELECT id, document_id, product_id, warehouse_id, strftime(d, '%Y-%m-%d %H:%M:%S.%g') AS movement_date,
           CAST(b AS DOUBLE) AS quantity_before, CAST(c2 AS DOUBLE) AS quantity_change, CAST(a2 AS DOUBLE) AS quantity_after,
           coalesce(comment, '') AS comment, coalesce(created_by, 'system') AS created_by,
           coalesce(a2 < 0, false) AS is_negative_after
    FROM repaired WHERE d IS NOT NULL AND product_id IS NOT NULL AND warehouse_id IS NOT NULL AND (c2 <> 0 OR c2 IS NULL)
""")
def quantity_repair(v: Views) -> DataFrame:
    raw = v.movements.selectExpr(
        "id", "movement_date", "document_id", "product_id", "warehouse_id",
        "try_cast(quantity_before AS DECIMAL(15,3)) AS quantity_before",
        "try_cast(quantity_change AS DECIMAL(15,3)) AS quantity_change",
        "try_cast(quantity_after AS DECIMAL(15,3)) AS quantity_after",
        "comment", "created_by",
    )
    return entities.clean_stock_movements(raw, RUN_TS).drop("etl_updated_at")


@query(f"""
    WITH {ctes('balances')},
    kept AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY product_id, warehouse_id ORDER BY id DESC, quantity DESC NULLS LAST) AS place
            FROM balances
        ) WHERE place = 1
    )
    SELECT id, product_id, warehouse_id, CAST(CASE WHEN quantity < 0 THEN 0 ELSE quantity END AS DOUBLE) AS quantity FROM kept
""")
def stock_balances(v: Views) -> DataFrame:
    return entities.clean_stock_balances(v.balances, RUN_TS).drop("etl_updated_at")


# ---- expenses ------------------------------------------------------------

PLATE_KEY = f"trim(upper({{}}), {BLANK})"
NAME_KEY = f"regexp_replace(trim(upper({{}}), {BLANK}), '[ {TAB}]+', ' ', 'g')"

EXPENSES_SQL = f"""
    {ctes('sheets', 'vehicles', 'drivers')},
    distinct_rows AS (SELECT DISTINCT * FROM sheets),
    dated AS (
        SELECT *,
               CASE WHEN day_month_raw LIKE '%.%' AND source_month LIKE '%\\_%' ESCAPE '\\' THEN TRY_CAST(
                   split_part(source_month, '_', 2) || '-' || split_part(day_month_raw, '.', 2) || '-' || split_part(day_month_raw, '.', 1)
               AS DATE) END AS expense_date,
               TRY_CAST(replace(replace(replace(amount_rub, '₽', ''), ' ', ''), ',', '.') AS DECIMAL(15,2)) AS amount
        FROM distinct_rows
    ),
    named AS (
        SELECT {PLATE_KEY.format("coalesce(vehicle_plate, 'Unknown')")} AS vehicle_plate,
               regexp_replace(trim(coalesce(driver_name, 'Unknown'), {BLANK}), '[ {TAB}]+', ' ', 'g') AS driver_name,
               trim(coalesce(expense_category, 'Other')) AS expense_category,
               counterparty, document_number, amount, comment, source_file, expense_date
        FROM dated WHERE expense_date IS NOT NULL AND amount >= 0
    ),
    plates AS (
        SELECT {PLATE_KEY.format('plate_number')} AS plate, max(id) AS vehicle FROM vehicles
        WHERE plate_number IS NOT NULL GROUP BY 1
    ),
    active AS (SELECT id, {NAME_KEY.format('full_name')} AS name FROM drivers WHERE is_active),
    full_names AS (SELECT name, max(id) AS by_name FROM active GROUP BY name),
    last_names AS (
        SELECT split_part(name, ' ', 1) AS last_name, min(id) AS by_last FROM active GROUP BY 1 HAVING count(*) = 1
    ),
    clean_expenses AS (
        SELECT n.*, coalesce(vehicle, 0) AS vehicle_id,
               CASE WHEN driver_name IN ('Unknown', '') THEN 0 ELSE coalesce(by_name, by_last, 0) END AS driver_id,
               CASE WHEN expense_category IN ('Топливо', 'ГСМ', 'Бензин') THEN 'fuel'
                    WHEN expense_category IN ('Ремонт', 'Запчасти', 'Техобслуживание', 'ТО') THEN 'repair'
                    WHEN expense_category IN ('Мойка', 'Мойка авто') THEN 'wash' ELSE 'other' END AS expense_category_en
        FROM named n
        LEFT JOIN plates ON vehicle_plate = plate
        LEFT JOIN full_names f ON upper(driver_name) = f.name
        LEFT JOIN last_names l ON split_part(upper(driver_name), ' ', 1) = l.last_name
    )
"""


def expense_rows(v: Views) -> DataFrame:
    headers = {english: russian for russian, english in SHEET_HEADERS.items()}
    return entities.clean_expenses(
        v.sheets.withColumnsRenamed(headers), v.vehicles, v.drivers, RUN_TS
    )


@query(f"""
    WITH {EXPENSES_SQL}
    SELECT vehicle_plate, driver_name, expense_category, counterparty, document_number,
           CAST(amount AS DOUBLE) AS amount_rub, comment, source_file,
           strftime(expense_date, '%Y-%m-%d') AS expense_date, vehicle_id, driver_id, expense_category_en,
           'excel/all_expenses' AS etl_source, 'expense' AS record_type
    FROM clean_expenses
""")
def clean_expenses(v: Views) -> DataFrame:
    return expense_rows(v).drop("load_date", "etl_updated_at")


@query(f"""
    WITH {EXPENSES_SQL}
    SELECT vehicle_plate, vehicle_id, CAST(count(*) AS BIGINT) AS rows FROM clean_expenses GROUP BY 1, 2
""")
def plate_lookup(v: Views) -> DataFrame:
    return expense_rows(v).groupBy("vehicle_plate", "vehicle_id").agg(F.count(F.lit(1)).alias("rows"))


@query(f"""
    WITH {EXPENSES_SQL}
    SELECT driver_name, driver_id, CAST(count(*) AS BIGINT) AS rows FROM clean_expenses GROUP BY 1, 2
""")
def driver_lookup(v: Views) -> DataFrame:
    return expense_rows(v).groupBy("driver_name", "driver_id").agg(F.count(F.lit(1)).alias("rows"))


@query(f"""
    WITH {EXPENSES_SQL}
    SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (vehicle_id > 0) AS BIGINT) AS mapped_vehicles,
           CAST(count(*) FILTER (driver_id > 0) AS BIGINT) AS mapped_drivers,
           round(CAST(count(*) FILTER (vehicle_id > 0) AS DOUBLE) * 100 / count(*), 1) AS vehicle_share_pct,
           round(CAST(count(*) FILTER (driver_id > 0) AS DOUBLE) * 100 / count(*), 1) AS driver_share_pct,
           strftime(min(expense_date), '%Y-%m-%d') AS first_date, strftime(max(expense_date), '%Y-%m-%d') AS last_date
    FROM clean_expenses
""")
def run_metrics(v: Views) -> DataFrame:
    return mapping_metrics(expense_rows(v))


@query(f"""
    WITH {EXPENSES_SQL}
    SELECT DISTINCT driver_name FROM clean_expenses WHERE driver_id = 0 ORDER BY driver_name LIMIT 10
""")
def unmapped_keys(v: Views) -> DataFrame:
    return unmapped(expense_rows(v), "driver_name", "driver_id")


# ---- telemetry -----------------------------------------------------------


def raw_points(v: Views) -> DataFrame:
    """Events as nested telemetry points; purchases were loaded twice."""
    e = v.table("events").withColumn("k", F.from_json("props", "k INT")["k"])
    kind = F.col("event_type")
    points = e.select(
        F.when(kind != "signup", F.col("user_id").cast("string")).alias("order_key"),
        F.when(F.col("value") >= 1, F.expr(EPOCH_MILLIS)).alias("ts"),
        F.when(kind != "error", F.struct(F.col("value").alias("lat"), F.lit(1.5).alias("lon"))).alias("loc"),
        F.when(kind != "click", F.col("value")).alias("spd"),
        F.lit(None).cast("int").alias("h"),
        F.struct(F.lit(None).cast("double").alias("lon"), F.lit(2.5).alias("lat")).alias("acc"),
        F.struct(F.col("k").alias("rpm"), F.lit(None).cast("int").alias("thr"),
                 F.lit(None).cast("int").alias("tmp")).alias("eng"),
        F.when(kind != "view", F.struct(
            (F.col("k") > 50).alias("abs"), F.lit(True).alias("belt"), F.lit(None).cast("int").alias("doors"),
            F.concat(F.lit(" a"), "user_id", F.lit(" ")).alias("car_id"))).alias("flags"),
        F.lit(None).cast("struct<sat: int, hdop: double>").alias("gps"),
        F.concat(F.lit("log_"), "user_id").alias("source_file"),
        kind.alias("_kind"),
    )
    again = points.where("_kind = 'purchase'")
    first, second = F.lit("2002-01-01"), F.lit("2002-01-02")
    return (
        points.withColumn("load_timestamp", first)
        .unionByName(again.withColumn("load_timestamp", second))
        .drop("_kind")
    )


@query("""
    WITH raw_k AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS rpm FROM events),
    flat AS (
        SELECT DISTINCT CAST(user_id AS VARCHAR) AS order_key, epoch_us(ts) // 1000 AS ms,
               CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS latitude,
               CASE WHEN event_type = 'error' THEN 0.0::DOUBLE ELSE 1.5::DOUBLE END AS longitude,
               CASE WHEN event_type = 'click' THEN 0.0 ELSE value END AS spd,
               rpm AS engine_rpm, event_type <> 'view' AND rpm > 50 AS flag_abs, event_type <> 'view' AS flag_belt,
               CASE WHEN event_type = 'view' THEN 'UNKNOWN' ELSE 'A' || user_id END AS car_id,
               'log_' || CAST(user_id AS VARCHAR) AS source_file
        FROM raw_k WHERE event_type <> 'signup' AND value >= 1
    )
    SELECT order_key, strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S.%g') AS "timestamp",
           strftime(make_timestamp(ms * 1000), '%Y-%m-%d') AS event_date, latitude, longitude, spd,
           CAST(-1 AS BIGINT) AS h, 0.0::DOUBLE AS acc_lon, 2.5::DOUBLE AS acc_lat, engine_rpm, CAST(0 AS BIGINT) AS engine_throttle,
           CAST(-273 AS BIGINT) AS engine_temp, flag_abs, flag_belt, CAST(0 AS BIGINT) AS flag_doors, car_id,
           CAST(0 AS BIGINT) AS gps_satellites, 99.9::DOUBLE AS gps_hdop, source_file,
           'json/telemetry' AS etl_source, 'telemetry' AS record_type
    FROM flat
""")
def clean_telemetry(v: Views) -> DataFrame:
    return entities.clean_telemetry(raw_points(v), RUN_TS).drop("load_timestamp", "etl_updated_at")


@query("""
    WITH raw_k AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
    SELECT 'log_' || CAST(user_id AS VARCHAR) AS source_file,
           CAST(CASE WHEN value < 1 THEN NULL ELSE epoch_us(ts) // 1000 END AS DOUBLE) AS ts,
           CASE WHEN event_type = 'error' THEN NULL ELSE value END AS lat,
           CASE WHEN event_type = 'error' THEN NULL ELSE CAST(1.5 AS DOUBLE) END AS lon, k AS rpm,
           CASE WHEN event_type = 'view' THEN NULL ELSE ' a' || user_id || ' ' END AS car_id,
           CAST(CASE WHEN event_type = 'view' THEN NULL ELSE k > 50 END AS VARCHAR) AS abs_active
    FROM raw_k
""")
def json_lift(v: Views) -> DataFrame:
    raw = raw_points(v).where("load_timestamp = '2002-01-01'")
    lifted = entities.lift_fields(raw, entities.BRONZE_FIELDS)
    return lifted.select(
        "source_file", F.col("ts").cast("double").alias("ts"), "lat", "lon", "rpm", "car_id",
        F.col("abs_active").cast("string").alias("abs_active"),
    )


@query(f"""
    WITH {ctes('sales', 'telemetry', 'balances')},
    trips AS (SELECT CAST(order_key AS BIGINT) AS order_key FROM telemetry GROUP BY 1 HAVING count(*) >= 2),
    priced AS (
        SELECT coalesce(TRY_CAST(cost_price AS DECIMAL(15,2)), 0) AS c, coalesce(TRY_CAST(selling_price AS DECIMAL(15,2)), 0) AS s
        FROM ({firsts('(' + SQL['products'] + ')', 'sku')}) WHERE sku IS NOT NULL
    )
    SELECT 'products' AS "table", 'rows' AS counter, CAST(count(*) AS BIGINT) AS value FROM priced
    UNION ALL SELECT 'products', 'price_issues', CAST(count(*) FILTER (s < c) AS BIGINT) FROM priced
    UNION ALL SELECT 'balances', 'rows', CAST(count(*) AS BIGINT) FROM balances
    UNION ALL SELECT 'balances', 'negative_balances', CAST(count(*) FILTER (quantity < 0) AS BIGINT) FROM balances
    UNION ALL SELECT 'telemetry', 'rows', CAST(count(*) AS BIGINT) FROM telemetry
    UNION ALL SELECT 'telemetry', 'orders', CAST(count(DISTINCT order_key) AS BIGINT) FROM telemetry
    UNION ALL SELECT 'telemetry', 'files', CAST(count(DISTINCT CAST("timestamp" AS DATE)) AS BIGINT) FROM telemetry
    UNION ALL SELECT 'fact_orders', 'orders', CAST(count(*) AS BIGINT) FROM sales
    UNION ALL SELECT 'fact_orders', 'matched_trips', CAST(count(*) AS BIGINT) FROM sales WHERE id IN (SELECT order_key FROM trips)
""")
def load_counters(v: Views) -> DataFrame:
    """Run counters of several loads; the log files are one per day here."""
    products = entities.clean_products(v.products, RUN_TS)
    balances = flag(v.balances, "is_negative_after", F.col("quantity") < 0)
    points = v.telemetry.withColumn("source_file", F.to_date("timestamp"))
    matched = aggregates.matched_trips(v.sales, aggregates.trip_metrics(v.telemetry))
    totals = {"orders": F.sum("orders"), "matched_trips": F.sum("matched_trips")}
    return (
        aggregates.counters("products", products, aggregates.product_metrics())
        .unionByName(aggregates.counters("balances", balances, aggregates.movement_metrics()))
        .unionByName(aggregates.counters("telemetry", points, aggregates.telemetry_metrics()))
        .unionByName(aggregates.counters("fact_orders", matched, totals))
    )


# ---- operational extracts ------------------------------------------------


@query(f"""
    WITH {ctes('sales', 'vehicles')}
    SELECT s.id AS sale_id, number AS sale_number, strftime(created_at, '%Y-%m-%d %H:%M:%S.%g') AS created_at, plate_number
    FROM sales s LEFT JOIN vehicles v ON s.vehicle_id = v.id
    WHERE s.vehicle_id IS NOT NULL AND driver_id IS NOT NULL AND date >= DATE '2001-12-31' - 2000
    ORDER BY date DESC, s.id
""")
def delivery_manifest(v: Views) -> DataFrame:
    return lookups.delivery_manifest(v.sales, v.vehicles, date(2001, 12, 31), 2000)


@query(f"""
    WITH {ctes('sales', 'vehicles', 'drivers')}
    SELECT DISTINCT plate_number, model, full_name AS driver_name
    FROM vehicles v JOIN sales s ON s.vehicle_id = v.id JOIN drivers d ON s.driver_id = d.id
    WHERE v.is_active AND d.is_active
""")
def vehicle_driver_pairs(v: Views) -> DataFrame:
    return lookups.vehicle_driver_pairs(v.sales, v.vehicles, v.drivers)
