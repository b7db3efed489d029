"""Cleaning primitives, deduplication and rules, one query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cargolake.catalog.registry import query
from cargolake.catalog.silver import firsts, text
from cargolake.catalog.views import EPOCH_MILLIS, RUN_TS, Views, ctes
from cargolake.functions import dates, expenses, numbers, text as texts
from cargolake.operators import aggregates, cleaning, dedup, quality
from cargolake.plans import constraints


@query(f"""
    WITH {ctes('customers')}
    SELECT id, {text('name')} AS name, {text('inn', True)} AS inn, {text('contacts')} AS contacts,
           {text('address')} AS address, {text('customer_segment')} AS customer_segment
    FROM customers
""")
def text_normalise(v: Views) -> DataFrame:
    return cleaning.normalise_text(v.customers.drop("is_active"))


@query(f"""
    WITH {ctes('customers')}
    SELECT id, name, coalesce(inn, 'none') AS inn, coalesce(contacts, 'Not provided') AS contacts, address,
           customer_segment, coalesce(is_active, true) AS is_active
    FROM customers
""")
def fill_defaults(v: Views) -> DataFrame:
    return cleaning.fill_defaults(
        v.customers, {"inn": "none", "contacts": cleaning.NOT_PROVIDED, "is_active": True}
    )


@query(f"""
    WITH {ctes('movements')}
    SELECT id, strftime(TRY_CAST(movement_date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%g') AS movement_date,
           CAST(TRY_CAST(quantity_before AS DECIMAL(15,3)) AS DOUBLE) AS quantity_before,
           strftime(TRY_CAST(left(movement_date, 10) AS DATE), '%Y-%m-%d') AS day
    FROM movements
""")
def lenient_casts(v: Views) -> DataFrame:
    raw = v.movements.select(
        "id", "movement_date", "quantity_before", F.left("movement_date", F.lit(10)).alias("day")
    )
    return cleaning.lenient_cast(
        raw, {"movement_date": "timestamp_ntz", "quantity_before": "decimal(15,3)", "day": "date"}
    )


@query(f"""
    WITH {ctes('movements')}
    SELECT id, product_id, quantity_change FROM movements WHERE product_id IS NOT NULL AND quantity_change IS NOT NULL
""")
def required_filter(v: Views) -> DataFrame:
    kept = cleaning.require(v.movements, ["product_id", "quantity_change"])
    return kept.select("id", "product_id", "quantity_change")


@query(f"""
    WITH {ctes('vehicles')}, filled AS (SELECT id, coalesce(plate_number, 'NO_PLATE') AS plate_number FROM vehicles)
    SELECT * FROM filled WHERE plate_number <> 'NO_PLATE'
""")
def sentinel_filter(v: Views) -> DataFrame:
    filled = cleaning.fill_defaults(v.vehicles.select("id", "plate_number"), {"plate_number": cleaning.NO_PLATE})
    return cleaning.drop_sentinel(filled, "plate_number", cleaning.NO_PLATE)


@query(f"""
    WITH {ctes('balances')}
    SELECT id, product_id, CAST(quantity AS DOUBLE) AS quantity, 'not zero' AS rule FROM balances WHERE quantity <> 0 OR quantity IS NULL
    UNION ALL
    SELECT id, product_id, CAST(quantity AS DOUBLE), 'positive' FROM balances WHERE quantity > 0
    UNION ALL
    SELECT id, product_id, CAST(quantity AS DOUBLE), 'not negative' FROM balances WHERE quantity >= 0
""")
def null_aware_filters(v: Views) -> DataFrame:
    b, q = v.balances.select("id", "product_id", "quantity"), F.col("quantity")
    kept = {
        "not zero": cleaning.keep_unless(b, q == 0),
        "positive": cleaning.keep_if(b, q > 0),
        "not negative": cleaning.keep_if(b, q >= 0),
    }
    first, *rest = (df.withColumn("rule", F.lit(rule)) for rule, df in kept.items())
    for df in rest:
        first = first.unionByName(df)
    return first


@query("""
    SELECT l_orderkey, l_partkey, CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'ИТОГО:' ELSE 'D' || l_linenumber END AS document_number
    FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_linenumber = 7)
""")
def drop_marker_rows(v: Views) -> DataFrame:
    rows = v.table("lineitem").selectExpr(
        "l_orderkey", "l_partkey",
        "CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'ИТОГО:'"
        " ELSE 'D' || l_linenumber END AS document_number",
    )
    return cleaning.drop_marker_rows(rows, "document_number", expenses.TOTAL_MARKER)


@query(f"""
    WITH {ctes('movements')}
    SELECT id, quantity_change, quantity_after, comment FROM movements
    WHERE NOT (quantity_change IS NULL AND comment IS NULL)
""")
def drop_all_null(v: Views) -> DataFrame:
    rows = v.movements.select("id", "quantity_change", "quantity_after", "comment")
    return cleaning.drop_all_null(rows, ["quantity_change", "comment"])


@query(f"""
    WITH {ctes('sheets')}
    SELECT day_month_raw, vehicle_plate, driver_name, expense_category, counterparty, document_number, amount_rub, comment
    FROM sheets
""")
def rename_map(v: Views) -> DataFrame:
    headers = {english: russian for russian, english in expenses.SHEET_HEADERS.items()}
    sheet = v.sheets.withColumnsRenamed(headers).drop("source_file", "source_month")
    return cleaning.rename(sheet, expenses.SHEET_HEADERS)


@query(f"""
    WITH {ctes('telemetry')}
    SELECT order_key, strftime("timestamp", '%Y-%m-%d %H:%M:%S.%g') AS "timestamp" FROM telemetry WHERE order_key = '7'
""")
def select_filter(v: Views) -> DataFrame:
    """The points of one order: a point look-up is the feature here."""
    return v.telemetry.where(F.col("order_key") == "7").select("order_key", "timestamp")


@query(f"""
    WITH {ctes('customers')}
    SELECT id, inn, name, sha256(coalesce(inn, chr(30)) || chr(31) || name) AS etl_hash FROM customers
""")
def row_hash(v: Views) -> DataFrame:
    return cleaning.fingerprint(v.customers.select("id", "inn", "name"), ["inn", "name"])


@query(f"""
    WITH {ctes('balances')}
    SELECT id, product_id, warehouse_id, CAST(CASE WHEN quantity < 0 THEN 0 ELSE quantity END AS DOUBLE) AS quantity FROM balances
""")
def clamp_negative(v: Views) -> DataFrame:
    return cleaning.clamp(v.balances, "quantity")


@query(f"""
    WITH {ctes('balances')}
    SELECT id, CAST(quantity AS DOUBLE) AS quantity, coalesce(quantity < 0, false) AS is_negative,
           coalesce(product_id < warehouse_id, false) AS product_below_warehouse
    FROM balances
""")
def rule_flags(v: Views) -> DataFrame:
    df = cleaning.flag(v.balances, "is_negative", F.col("quantity") < 0)
    df = cleaning.flag(df, "product_below_warehouse", F.col("product_id") < F.col("warehouse_id"))
    return df.drop("product_id", "warehouse_id")


@query("""
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
""")
def union_by_name(v: Views) -> DataFrame:
    a = v.table("customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    b = v.table("supplier").selectExpr("s_acctbal AS balance", "s_name AS name", "s_suppkey AS id")
    return a.unionByName(b, allowMissingColumns=True)


FILE_NAME_SQL = """
    CASE WHEN o_orderpriority = '5-LOW' THEN 'log' || o_orderkey || '.jsonl'
         ELSE 'delivery_' || o_orderkey || '_A%20' || o_custkey || '_' || {stamp} || '.jsonl' END
"""


@query(f"""
    WITH files AS (SELECT o_orderkey AS id, {FILE_NAME_SQL.format(stamp="strftime(o_orderdate, '%Y%m%d')")} AS file_name FROM orders)
    SELECT id, url_decode(file_name) AS source_file, replace(url_decode(file_name), '.jsonl', '') AS source_stem,
           CASE WHEN contains(file_name, '_') THEN split_part(file_name, '_', 2) END AS order_key
    FROM files
""")
def split_part_key(v: Views) -> DataFrame:
    files = v.table("orders").selectExpr(
        "o_orderkey AS id",
        FILE_NAME_SQL.format(stamp="date_format(o_orderdate, 'yyyyMMdd')") + " AS file_name",
    )
    name = texts.decoded_file_name(F.col("file_name"))
    return files.select(
        "id", name.alias("source_file"), texts.stem(name).alias("source_stem"),
        texts.key_from_file_name(name).alias("order_key"),
    )


@query(f"""
    WITH {ctes('sheets')}
    SELECT day_month_raw, source_month,
           strftime(CASE WHEN day_month_raw LIKE '%.%' AND contains(source_month, '_') THEN TRY_CAST(
               split_part(source_month, '_', 2) || '-' || split_part(day_month_raw, '.', 2) || '-' || split_part(day_month_raw, '.', 1)
           AS DATE) END, '%Y-%m-%d') AS expense_date
    FROM sheets
""")
def compose_date(v: Views) -> DataFrame:
    day, month = F.col("day_month_raw"), F.col("source_month")
    return v.sheets.select(day, month, dates.compose_date(day, month).alias("expense_date"))


@query(f"""
    WITH {ctes('sheets')}
    SELECT amount_rub AS amount_text,
           CAST(TRY_CAST(replace(replace(replace(amount_rub, '₽', ''), ' ', ''), ',', '.') AS DECIMAL(15,2)) AS DOUBLE) AS amount
    FROM sheets
""")
def money_parse(v: Views) -> DataFrame:
    raw = F.col("amount_rub")
    return v.sheets.select(raw.alias("amount_text"), numbers.money_text(raw).alias("amount"))


@query(f"""
    WITH {ctes('sheets')}
    SELECT expense_category AS label,
           CASE WHEN expense_category IN ('Топливо', 'ГСМ', 'Бензин') THEN 'fuel'
                WHEN expense_category IN ('Ремонт', 'Запчасти', 'Техобслуживание', 'ТО') THEN 'repair'
                WHEN expense_category IN ('Мойка', 'Мойка авто') THEN 'wash' ELSE 'other' END AS category,
           CAST(count(*) AS BIGINT) AS rows
    FROM sheets GROUP BY 1, 2
""")
def category_map(v: Views) -> DataFrame:
    label = F.col("expense_category")
    rows = v.sheets.select(label.alias("label"), expenses.category_of(label).alias("category"))
    return rows.groupBy("label", "category").agg(F.count(F.lit(1)).alias("rows"))


@query("""
    WITH ms AS (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events)
    SELECT event_id, ms AS ts, strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S.%g') AS "timestamp" FROM ms
""")
def epoch_millis(v: Views) -> DataFrame:
    return v.table("events").select("event_id", F.expr(EPOCH_MILLIS).alias("ts")).withColumn(
        "timestamp", dates.from_epoch_millis(F.col("ts"))
    )


# ---- deduplication -------------------------------------------------------


@query(f"WITH {ctes('products')}, kept AS ({firsts('products', 'sku')}) SELECT id, sku, name, unit FROM kept")
def dedup_keep_first(v: Views) -> DataFrame:
    return dedup.dedup(v.products, ["sku"], ["id"]).select("id", "sku", "name", "unit")


@query(f"""
    WITH {ctes('balances')}
    SELECT id, product_id, warehouse_id, CAST(quantity AS DOUBLE) AS quantity FROM (
        SELECT *, row_number() OVER (PARTITION BY product_id, warehouse_id ORDER BY id DESC, quantity DESC NULLS LAST) AS place
        FROM balances
    ) WHERE place = 1
""")
def dedup_keep_last(v: Views) -> DataFrame:
    return dedup.dedup(v.balances, ["product_id", "warehouse_id"], ["id"], keep="last")


@query("""
    SELECT l_suppkey, l_returnflag, l_linestatus, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S.%g') AS load_date
    FROM lineitem GROUP BY 1, 2, 3, 4, 5
""")
def distinct_rows(v: Views) -> DataFrame:
    rows = v.table("lineitem").selectExpr(
        "l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_shipdate AS load_date"
    )
    return dedup.distinct_business(rows, exclude=["load_date"])


@query("""
    SELECT o_custkey, o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g') AS o_orderdate FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place FROM orders
    ) WHERE place = 1
""")
def latest_by_key(v: Views) -> DataFrame:
    rows = v.table("orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return dedup.latest_by_key(rows, ["o_custkey"], "o_orderdate")


@query("""
    WITH target AS (SELECT l_partkey AS product_id, l_suppkey AS warehouse_id, sum(CAST(l_quantity AS DECIMAL(15,3))) AS quantity FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2),
    source AS (SELECT l_partkey AS product_id, l_suppkey AS warehouse_id, sum(CAST(l_quantity AS DECIMAL(15,3))) AS quantity FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2)
    SELECT product_id, warehouse_id, CAST(coalesce(s.quantity, t.quantity) AS DOUBLE) AS quantity
    FROM target t FULL JOIN source s USING (product_id, warehouse_id)
""")
def upsert_latest(v: Views) -> DataFrame:
    def stock(status: str) -> DataFrame:
        rows = v.table("lineitem").where(F.col("l_linestatus") == status)
        return rows.groupBy(F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("warehouse_id")).agg(
            F.sum(F.col("l_quantity").cast("decimal(15,3)")).alias("quantity")
        )

    return dedup.upsert(stock("F"), stock("O"), ["product_id", "warehouse_id"])


# ---- quality and rules ---------------------------------------------------


def quality_sql(name: str, view: str, columns: list[str]) -> str:
    rows = f"(SELECT {', '.join(columns)} FROM {view})"
    parts = [
        f"SELECT '{name}' AS \"table\", 'row_count' AS metric, '' AS \"column\", CAST(count(*) AS BIGINT) AS value FROM {view}",
        f"SELECT '{name}', 'duplicates', '', CAST((SELECT count(*) FROM {view}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {rows})) AS BIGINT)",
        *(
            f"SELECT '{name}', 'null_count', '{c}', CAST(count(*) - count({c}) AS BIGINT) FROM {view}"
            for c in columns
        ),
    ]
    return " UNION ALL ".join(parts)


# the tables of the quality report: name -> (view, columns)
REPORTED = {
    "customers": ("customers", ["id", "name", "inn", "contacts", "address", "customer_segment", "is_active"]),
    "drivers": ("drivers", ["id", "full_name", "license_number", "phone", "is_active"]),
    "vehicles": ("vehicles", ["id", "plate_number", "model", "is_active"]),
    "suppliers": ("suppliers", ["id", "name", "inn", "contacts", "is_active"]),
    "warehouses": ("warehouses", ["name", "address", "is_active"]),
    "sale_headers": ("sales", ["id", "number", "date", "customer_id", "driver_id", "vehicle_id", "warehouse_id", "total_amount"]),
    "purchase_headers": ("purchases", ["id", "number", "date", "supplier_id", "warehouse_id"]),
    "stock_movements": (
        "movements",
        [
            "id", "document_id", "product_id", "warehouse_id", "movement_date", "quantity_before",
            "quantity_change", "quantity_after", "comment", "created_by",
        ],
    ),
    "products": ("products", ["id", "sku", "name", "unit", "cost_price", "selling_price", "is_active"]),
    "stock_balances": ("balances", ["id", "product_id", "warehouse_id", "quantity"]),
}


@query(
    f"WITH {ctes(*dict.fromkeys(view for view, _ in REPORTED.values()))} "
    + " UNION ALL ".join(quality_sql(name, view, columns) for name, (view, columns) in REPORTED.items())
)
def quality_report(v: Views) -> DataFrame:
    """The ten silver tables; one of them without its id, so that rows do repeat."""
    tables = {name: getattr(v, view).select(*columns) for name, (view, columns) in REPORTED.items()}
    return quality.quality_report(tables, RUN_TS).drop("reported_at")


@query("""
    SELECT 'lineitem' AS "table", rule, CAST(count(*) AS BIGINT) AS rows_checked,
           CAST(count(*) FILTER (NOT ok) AS BIGINT) AS violations
    FROM (
        SELECT 'quantity > 1' AS rule, l_quantity > 1 AS ok FROM lineitem
        UNION ALL SELECT 'price >= 0', l_extendedprice >= 0 FROM lineitem
        UNION ALL SELECT 'discount under 0.1', l_discount < 0.095 FROM lineitem
        UNION ALL SELECT 'flag in list', l_returnflag IN ('A', 'R') FROM lineitem
    ) GROUP BY rule
""")
def check_rules(v: Views) -> DataFrame:
    return quality.check_rules(
        "lineitem",
        v.table("lineitem"),
        {
            "quantity > 1": F.col("l_quantity") > 1,
            "price >= 0": F.col("l_extendedprice") >= 0,
            "discount under 0.1": F.col("l_discount") < 0.095,
            "flag in list": F.col("l_returnflag").isin("A", "R"),
        },
    )


@query("""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(count(*) AS BIGINT) AS occurrences FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1
""")
def unique_rules(v: Views) -> DataFrame:
    return quality.unique_rules(v.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    WITH priced AS (
        SELECT CAST(l_extendedprice AS DECIMAL(15,2)) AS amount,
               round(CAST(l_quantity AS DECIMAL(15,3)) * CAST(p_retailprice AS DECIMAL(15,2)), 2) AS expected
        FROM lineitem JOIN part ON l_partkey = p_partkey
    )
    SELECT CAST(count(*) AS BIGINT) AS rows_checked, CAST(count(*) FILTER (amount <> expected) AS BIGINT) AS mismatches,
           CAST(sum(abs(amount - expected)) AS DOUBLE) AS total_difference
    FROM priced
""")
def derived_amount(v: Views) -> DataFrame:
    lines = v.table("lineitem").join(v.table("part"), F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        "CAST(l_quantity AS DECIMAL(15,3)) AS quantity", "CAST(p_retailprice AS DECIMAL(15,2)) AS price",
        "CAST(l_extendedprice AS DECIMAL(15,2)) AS amount",
    )
    return quality.derived_amount(lines, "price")


# (name, child table, foreign key, parent table, primary key)
KEYS = [
    ("orders.customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem.order", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem.part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("customer.nation", "customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier.nation", "supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation.region", "nation", "n_regionkey", "region", "r_regionkey"),
    ("event.supplier", "events", "user_id", "supplier", "s_suppkey"),
    ("customer.supplier", "customer", "c_custkey", "supplier", "s_suppkey"),
]


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"constraint\", CAST(count(DISTINCT {fk}) AS BIGINT) AS orphan_keys, "
        f"CAST(count(*) AS BIGINT) AS orphan_rows FROM {child} "
        f"WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {parent})"
        for name, child, fk, parent, pk in KEYS
    )
)
def fk_orphans(v: Views) -> DataFrame:
    first, *rest = (
        quality.fk_orphans(name, v.table(child), fk, v.table(parent), pk)
        for name, child, fk, parent, pk in KEYS
    )
    for df in rest:
        first = first.unionByName(df)
    return first


# the operational tables as the rules know them: name -> (view, columns)
RULED = {
    "customers": ("customers", ["id", "name", "inn"]),
    "suppliers": ("suppliers", ["id", "name", "inn"]),
    "drivers": ("drivers", ["id", "full_name", "license_number"]),
    "vehicles": ("vehicles", ["id", "plate_number"]),
    "warehouses": ("warehouses", ["id", "name"]),
    "products": ("products", ["id", "sku", "name", "unit"]),
    "purchase_headers": ("purchases", ["id", "number", "date", "supplier_id", "warehouse_id"]),
    "purchase_items": ("purchase_lines", ["id", "purchase_id", "product_id", "quantity", "purchase_price", "amount"]),
    "sale_headers": ("sales", ["id", "number", "date", "customer_id", "driver_id", "vehicle_id", "warehouse_id"]),
    "sale_items": ("sale_lines", ["id", "sale_id", "product_id", "quantity", "selling_price", "amount"]),
    "stock_balances": ("balances", ["id", "product_id", "warehouse_id", "quantity"]),
    "stock_movements": (
        "ruled_movements",
        [
            "id", "movement_date", "document_type", "document_id", "operation_type", "product_id", "warehouse_id",
            "quantity_before", "quantity_change", "quantity_after",
        ],
    ),
}


def constraint_sql() -> str:
    def part(table: str, rule: str, violations: str, source: str) -> str:
        return f"SELECT '{table}' AS \"table\", '{rule}' AS rule, CAST({violations} AS BIGINT) AS violations FROM {source}"

    parts = []
    for table, (view, columns) in RULED.items():
        for c in constraints.NOT_NULL.get(table, []):
            if c in columns:
                parts.append(part(table, f"not null: {c}", f'count(*) - count("{c}")', view))
        for c, rule in constraints.CHECKS.get(table, {}).items():
            if c in columns:
                parts.append(part(table, f"check: {c}", f"count(*) FILTER (NOT ({rule}))", view))
        if table in constraints.LINE_PRICE:
            right = f"amount = round(quantity * {constraints.LINE_PRICE[table]}, 2)"
            parts.append(part(table, "derived: amount", f"count(*) FILTER (NOT ({right}))", view))
        for keys in constraints.UNIQUE.get(table, []):
            whole = " AND ".join(f"{k} IS NOT NULL" for k in keys)
            known = f"(SELECT {', '.join(keys)} FROM {view} WHERE {whole})"
            surplus = f"(SELECT count(*) FROM {known}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {known}))"
            parts.append(part(table, "unique: " + ", ".join(keys), surplus, "(SELECT 1)"))
        for fk, parent in constraints.FOREIGN_KEYS.get(table, {}).items():
            if fk in columns and parent in RULED:
                lost = f"{view} c WHERE {fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {RULED[parent][0]} p WHERE p.id = c.{fk})"
                parts.append(part(table, f"foreign key: {fk}", "count(*)", lost))
    return f"WITH {ctes(*(view for view, _ in RULED.values()))} " + " UNION ALL ".join(parts)


@query(constraint_sql())
def constraint_report(v: Views) -> DataFrame:
    """The declared rules of the operational tables over all views that stand for one."""
    return constraints.constraint_report(
        {table: getattr(v, view).select(*columns) for table, (view, columns) in RULED.items()}
    )


@query(f"""
    WITH {ctes('balances')}
    SELECT CAST(count(*) AS BIGINT) AS total_balances, CAST(coalesce(sum(quantity), 0) AS DOUBLE) AS total_quantity FROM balances
""")
def global_agg(v: Views) -> DataFrame:
    return aggregates.balance_totals(v.balances)
