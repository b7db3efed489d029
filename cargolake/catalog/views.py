"""The warehouse's tables, derived from the benchmark tables.

Every view exists twice: as a DataFrame for the Spark queries and as a SQL text
(``SQL[name]``) for the counterpart in ANSI SQL. Missing values and repeated
rows are put in by conditions on ordinary attributes, over the whole tables.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cargolake.plans.marts import dim_customer, dim_time, dim_vehicle, dim_warehouse, fact_orders
from cargolake.operators.aggregates import expenses_by_vehicle_day, trip_metrics
from cargolake.schemas import FACT_ORDERS, ddl

RUN_TS = datetime(2002, 1, 1, 12, 0, 0)
AS_OF = date(2001, 12, 31)
CALENDAR = (date(1995, 1, 1), date(2001, 12, 31))
COPY = 1_000_000_000_000  # added to an id to make the id of a repeated row
TAB = "\t"

# the benchmark tables, so that no job has to look up their schemas
TABLES = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {
        "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
        "c_mktsegment": "string",
    },
    "supplier": {
        "s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double",
    },
    "part": {
        "p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string",
        "p_size": "int", "p_retailprice": "double",
    },
    "orders": {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
        "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
    },
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
        "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
        "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
        "l_shipdate": "timestamp_ntz",
    },
    "events": {
        "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
        "value": "double", "props": "string",
    },
}

ANALYTIC_FACT = {**FACT_ORDERS, "avg_speed_kmh": "double", "margin_percent": "double"}

# ---- SQL side ------------------------------------------------------------

# quantity, amount and price of a line, some of them against the rules; the price has no name here
LINE_SQL = """CAST(l_quantity - 2 AS DECIMAL(15,3)) AS quantity,
               CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_quantity - 2 AS DECIMAL(15,3)) * 3 AS DECIMAL(15,2))
                    WHEN l_tax < 0.04 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(15,2)) END AS amount,
               CAST(CASE WHEN l_discount > 0.08 THEN -1 ELSE 3 END AS DECIMAL(15,2))"""

SQL = {
    "customers": f"""
        SELECT c_custkey AS id,
               CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' ELSE ' ' || c_name END AS name,
               CASE WHEN c_acctbal < 0 THEN NULL ELSE ' ' || lower(c_name) || '{TAB}' END AS inn,
               CASE WHEN c_acctbal < 1000 THEN NULL ELSE c_mktsegment || ' ' END AS contacts,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN '{TAB}' ELSE 'Area ' || c_nationkey END AS address,
               c_mktsegment AS customer_segment,
               CASE WHEN c_acctbal < 2000 THEN NULL ELSE c_acctbal < 8000 END AS is_active
        FROM customer
        UNION ALL
        SELECT c_custkey + {COPY}, 'Copy', ' ' || lower(c_name) || '{TAB}', 'c', 'a', c_mktsegment, true
        FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
        UNION ALL
        SELECT c_custkey + 2 * {COPY}, 'Other spelling', upper(c_name), 'c', 'a', c_mktsegment, false
        FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
    """,
    "vehicles": f"""
        SELECT s_suppkey AS id,
               CASE WHEN s_acctbal < 0 THEN NULL ELSE lower(s_name) || ' ' END AS plate_number,
               CASE WHEN s_nationkey < 5 THEN ' ' ELSE 'Model ' || s_nationkey END AS model,
               CASE WHEN s_acctbal < 1000 THEN NULL ELSE s_acctbal < 9000 END AS is_active
        FROM supplier
        UNION ALL
        SELECT s_suppkey + {COPY}, lower(s_name) || ' ', 'Copy', true
        FROM supplier WHERE s_nationkey > 10
    """,
    "drivers": f"""
        SELECT s_suppkey AS id,
               CASE WHEN s_acctbal > 5000 THEN s_name || '  ' || n_name ELSE n_name || ' ' || s_name || ' Jr' END AS full_name,
               CASE WHEN s_acctbal < 0 THEN '  ' ELSE 'lic ' || lower(s_name) END AS license_number,
               CASE WHEN s_nationkey < 8 THEN NULL ELSE '+7 ' || s_nationkey END AS phone,
               CASE WHEN s_acctbal < 1000 THEN NULL ELSE s_acctbal < 9000 END AS is_active
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        UNION ALL
        SELECT s_suppkey + {COPY}, 'Copy ' || s_name, 'lic ' || lower(s_name), NULL, true
        FROM supplier WHERE s_nationkey > 15
    """,
    "suppliers": f"""
        SELECT s_suppkey AS id,
               CASE WHEN s_nationkey < 3 THEN NULL ELSE s_name END AS name,
               CASE WHEN s_acctbal < 0 THEN '  ' ELSE lower(s_name) END AS inn,
               CASE WHEN s_acctbal < 2000 THEN ' ' ELSE 'c' || s_nationkey END AS contacts,
               CASE WHEN s_acctbal < 1000 THEN NULL ELSE s_acctbal < 9000 END AS is_active
        FROM supplier
        UNION ALL
        SELECT s_suppkey + {COPY}, 'Copy', lower(s_name), 'c', true FROM supplier
    """,
    "warehouses": f"""
        SELECT c_custkey AS id,
               CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment || ' ' || n_name || ' ' END AS name,
               CASE WHEN c_nationkey < 10 THEN NULL ELSE ' zone ' || c_nationkey END AS address,
               CASE WHEN c_acctbal < 1000 THEN NULL ELSE c_acctbal < 9000 END AS is_active
        FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
    "products": """
        SELECT p_partkey AS id,
               CASE WHEN p_size < 4 THEN NULL ELSE p_name || ' ' || p_brand END AS sku,
               CASE WHEN p_type = 'SMALL' THEN ' ' ELSE p_type END AS name,
               CASE WHEN p_size < 20 THEN NULL ELSE 'box' END AS unit,
               CASE WHEN p_size > 45 THEN 'none' ELSE CAST(CAST(p_size * 30 AS DECIMAL(15,2)) AS VARCHAR) END AS cost_price,
               CASE WHEN p_size < 6 THEN NULL ELSE CAST(CAST(p_retailprice AS DECIMAL(15,2)) AS VARCHAR) END AS selling_price,
               CASE WHEN p_size < 10 THEN NULL ELSE p_size < 40 END AS is_active
        FROM part
    """,
    "sales": """
        SELECT o_orderkey AS id, 'S-' || o_orderkey AS number, CAST(o_orderdate AS DATE) AS date,
               o_custkey AS customer_id,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE (o_orderkey + o_custkey) % (SELECT count(*) FROM supplier) END AS driver_id,
               o_custkey % (SELECT count(*) FROM supplier) AS vehicle_id,
               c_nationkey AS warehouse_id,
               CAST(o_totalprice AS DECIMAL(15,2)) AS total_amount, o_orderdate AS created_at
        FROM orders JOIN customer ON o_custkey = c_custkey
    """,
    "expenses": """
        SELECT l_suppkey AS vehicle_id, CAST(l_shipdate AS DATE) AS expense_date,
               CASE WHEN l_returnflag = 'R' THEN 'fuel' WHEN l_returnflag = 'A' THEN 'wash'
                    WHEN l_linestatus = 'O' THEN 'repair' ELSE 'other' END AS expense_category_en,
               CAST(l_extendedprice AS DECIMAL(15,2)) AS amount_rub
        FROM lineitem
    """,
    "telemetry": """
        SELECT CAST(user_id AS VARCHAR) AS order_key, ts AS "timestamp", value AS spd FROM events
    """,
    "movements": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS document_id,
               CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN NULL ELSE l_partkey END AS product_id,
               l_suppkey AS warehouse_id,
               CASE WHEN l_tax > 0.07 THEN '31/31/1999' ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS movement_date,
               CASE WHEN l_discount > 0.09 THEN 'none' ELSE CAST(CAST(l_quantity AS DECIMAL(15,3)) AS VARCHAR) END AS quantity_before,
               CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(CAST(l_linenumber * 5 - 20 AS DECIMAL(15,3)) AS VARCHAR) END AS quantity_change,
               CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(CAST(l_quantity - 10 AS DECIMAL(15,3)) AS VARCHAR) END AS quantity_after,
               CASE WHEN l_tax < 0.02 THEN NULL ELSE 'moved' END AS comment,
               CASE WHEN l_tax < 0.04 THEN NULL ELSE 'clerk' END AS created_by
        FROM lineitem
    """,
    "balances": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS product_id, l_suppkey AS warehouse_id,
               CASE WHEN l_tax > 0.07 THEN NULL ELSE CAST(l_quantity - 10 AS DECIMAL(15,3)) END AS quantity
        FROM lineitem
    """,
    "ruled_movements": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_shipdate AS movement_date,
               CASE WHEN l_tax > 0.07 THEN 'GIFT' WHEN l_tax < 0.01 THEN NULL ELSE 'SALE' END AS document_type,
               l_orderkey AS document_id,
               CASE WHEN l_discount > 0.09 THEN 'LOST' WHEN l_returnflag = 'R' THEN 'INCOME' ELSE 'OUTCOME' END AS operation_type,
               CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN NULL ELSE l_partkey END AS product_id,
               l_suppkey AS warehouse_id, l_quantity AS quantity_before,
               CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linenumber END AS quantity_change, l_quantity AS quantity_after
        FROM lineitem
    """,
    "purchases": """
        SELECT o_orderkey AS id,
               CASE WHEN o_orderstatus = 'P' THEN 'P-' || o_custkey ELSE 'P-' || o_orderkey END AS number,
               CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date,
               o_custkey AS supplier_id, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey + 1 END AS warehouse_id
        FROM orders
    """,
    "purchase_lines": f"""
        SELECT l_orderkey * 10 + l_linenumber % 5 AS id, l_orderkey + l_linenumber % 2 AS purchase_id,
               CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_partkey + 3 END AS product_id, {LINE_SQL} AS purchase_price
        FROM lineitem
    """,
    "sale_lines": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS sale_id,
               l_suppkey * 5 AS product_id, {LINE_SQL} AS selling_price
        FROM lineitem
    """,
    # expense sheet rows as text, with an amount spelled in three ways
    "sheets": f"""
        SELECT CASE WHEN l_tax > 0.075 THEN strftime(l_shipdate, '%d') WHEN l_tax > 0.065 THEN '31.02'
                    ELSE strftime(l_shipdate, '%d.%m') END AS day_month_raw,
               CASE WHEN l_discount < 0.005 THEN NULL WHEN l_discount < 0.015 THEN 'nobody'
                    ELSE ' ' || lower(s_name) || '{TAB}' END AS vehicle_plate,
               CASE WHEN l_quantity < 4 THEN NULL
                    WHEN l_quantity < 12 THEN CASE WHEN s_acctbal > 5000 THEN s_name ELSE n_name END
                    WHEN s_acctbal > 5000 THEN lower(s_name) || ' ' || n_name
                    ELSE ' ' || n_name || '   ' || s_name || ' jr' END AS driver_name,
               CASE WHEN l_linenumber = 1 THEN 'Топливо' WHEN l_linenumber = 2 THEN ' ГСМ'
                    WHEN l_linenumber = 3 THEN 'Ремонт' WHEN l_linenumber = 4 THEN 'Мойка авто '
                    WHEN l_linenumber = 5 THEN 'топливо' WHEN l_linenumber = 6 THEN 'ТО' ELSE NULL END AS expense_category,
               'c' || s_nationkey AS counterparty,
               CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'D-' || l_orderkey END AS document_number,
               CASE WHEN l_quantity > 48 THEN 'abc'
                    WHEN l_returnflag = 'A' THEN replace(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR), '.', ',') || ' ₽'
                    WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN '-' || CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR)
                    ELSE CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) END AS amount_rub,
               l_linestatus AS comment,
               'sheet_' || CAST(year(l_shipdate) AS VARCHAR) || '.xlsx' AS source_file,
               CASE WHEN l_tax < 0.005 AND l_linestatus = 'F' THEN 'sheet' ELSE 'sheet_' || CAST(year(l_shipdate) AS VARCHAR) END AS source_month
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    """,
}


def ctes(*names: str) -> str:
    return ", ".join(f"{n} AS ({SQL[n]})" for n in names)


STAR_SQL = f"""
    {ctes('sales', 'expenses', 'telemetry')},
    costs AS (
        SELECT vehicle_id, expense_date,
               sum(CASE WHEN expense_category_en = 'fuel' THEN amount_rub ELSE 0 END) AS fuel_expense,
               sum(CASE WHEN expense_category_en = 'other' THEN amount_rub ELSE 0 END) AS other_expense,
               sum(CASE WHEN expense_category_en = 'wash' THEN amount_rub ELSE 0 END) AS wash_expense,
               sum(amount_rub) AS total_expense
        FROM expenses GROUP BY vehicle_id, expense_date
    ),
    trips AS (
        SELECT CAST(order_key AS BIGINT) AS order_key,
               CAST(trunc(epoch(max("timestamp") - min("timestamp")) / 60) AS BIGINT) AS duration_minutes,
               round(avg(spd) + sign(avg(spd)) * 1e-7, 2) AS avg_speed_kmh
        FROM telemetry GROUP BY order_key HAVING count(*) >= 2
    ),
    fact AS (
        SELECT id AS order_key, CAST(strftime(date, '%Y%m%d') AS BIGINT) AS time_id, date AS full_date,
               coalesce(customer_id, 0) AS customer_id, coalesce(driver_id, 0) AS driver_id,
               coalesce(s.vehicle_id, 0) AS vehicle_id, coalesce(warehouse_id, 0) AS warehouse_id,
               total_amount AS order_amount,
               coalesce(fuel_expense, 0) AS fuel_expense, coalesce(other_expense, 0) AS other_expense,
               coalesce(wash_expense, 0) AS wash_expense, coalesce(total_expense, 0) AS total_vehicle_expense,
               coalesce(duration_minutes, 0) AS trip_duration_minutes,
               coalesce(avg_speed_kmh, 0.0) AS avg_speed_kmh,
               total_amount - coalesce(total_expense, 0) AS net_profit
        FROM sales s
        LEFT JOIN costs c ON s.vehicle_id = c.vehicle_id AND s.date = c.expense_date
        LEFT JOIN trips t ON s.id = t.order_key
    )
"""

# ---- Spark side ----------------------------------------------------------


# epoch milliseconds of a zone-less UTC timestamp
EPOCH_MILLIS = (
    "CAST(floor(CAST(CAST(ts - TIMESTAMP_NTZ '1970-01-01 00:00:00' AS INTERVAL SECOND)"
    " AS DECIMAL(18,6)) * 1000) AS BIGINT)"
)


def plain(df: DataFrame) -> DataFrame:
    """Result types that read the same in both engines: bigint, double, text."""

    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
        return c.alias(f.name)

    return df.select(*map(column, df.schema.fields))


class Views:
    """The views over one directory of benchmark tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(ddl(TABLES[name])).parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def customers(self) -> DataFrame:
        c = self.table("customer")
        base = c.selectExpr(
            "c_custkey AS id",
            "CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' ELSE ' ' || c_name END AS name",
            f"CASE WHEN c_acctbal < 0 THEN NULL ELSE ' ' || lower(c_name) || '{TAB}' END AS inn",
            "CASE WHEN c_acctbal < 1000 THEN NULL ELSE c_mktsegment || ' ' END AS contacts",
            f"CASE WHEN c_mktsegment = 'MACHINERY' THEN '{TAB}' ELSE 'Area ' || c_nationkey END AS address",
            "c_mktsegment AS customer_segment",
            "CASE WHEN c_acctbal < 2000 THEN NULL ELSE c_acctbal < 8000 END AS is_active",
        )
        copies = c.where("c_mktsegment = 'AUTOMOBILE'").selectExpr(
            f"c_custkey + {COPY} AS id", "'Copy' AS name", f"' ' || lower(c_name) || '{TAB}' AS inn",
            "'c' AS contacts", "'a' AS address", "c_mktsegment AS customer_segment", "true AS is_active",
        )
        spellings = c.where("c_mktsegment = 'HOUSEHOLD'").selectExpr(
            f"c_custkey + 2 * {COPY} AS id", "'Other spelling' AS name", "upper(c_name) AS inn",
            "'c' AS contacts", "'a' AS address", "c_mktsegment AS customer_segment", "false AS is_active",
        )
        return base.unionByName(copies).unionByName(spellings)

    @property
    def vehicles(self) -> DataFrame:
        s = self.table("supplier")
        base = s.selectExpr(
            "s_suppkey AS id",
            "CASE WHEN s_acctbal < 0 THEN NULL ELSE lower(s_name) || ' ' END AS plate_number",
            "CASE WHEN s_nationkey < 5 THEN ' ' ELSE 'Model ' || s_nationkey END AS model",
            "CASE WHEN s_acctbal < 1000 THEN NULL ELSE s_acctbal < 9000 END AS is_active",
        )
        copies = s.where("s_nationkey > 10").selectExpr(
            f"s_suppkey + {COPY} AS id", "lower(s_name) || ' ' AS plate_number", "'Copy' AS model",
            "true AS is_active",
        )
        return base.unionByName(copies)

    @property
    def drivers(self) -> DataFrame:
        s = self.table("supplier")
        base = s.join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
            "s_suppkey AS id",
            "CASE WHEN s_acctbal > 5000 THEN s_name || '  ' || n_name"
            " ELSE n_name || ' ' || s_name || ' Jr' END AS full_name",
            "CASE WHEN s_acctbal < 0 THEN '  ' ELSE 'lic ' || lower(s_name) END AS license_number",
            "CASE WHEN s_nationkey < 8 THEN NULL ELSE '+7 ' || s_nationkey END AS phone",
            "CASE WHEN s_acctbal < 1000 THEN NULL ELSE s_acctbal < 9000 END AS is_active",
        )
        copies = s.where("s_nationkey > 15").selectExpr(
            f"s_suppkey + {COPY} AS id", "'Copy ' || s_name AS full_name",
            "'lic ' || lower(s_name) AS license_number", "CAST(NULL AS STRING) AS phone",
            "true AS is_active",
        )
        return base.unionByName(copies)

    @property
    def suppliers(self) -> DataFrame:
        s = self.table("supplier")
        base = s.selectExpr(
            "s_suppkey AS id",
            "CASE WHEN s_nationkey < 3 THEN NULL ELSE s_name END AS name",
            "CASE WHEN s_acctbal < 0 THEN '  ' ELSE lower(s_name) END AS inn",
            "CASE WHEN s_acctbal < 2000 THEN ' ' ELSE 'c' || s_nationkey END AS contacts",
            "CASE WHEN s_acctbal < 1000 THEN NULL ELSE s_acctbal < 9000 END AS is_active",
        )
        copies = s.selectExpr(
            f"s_suppkey + {COPY} AS id", "'Copy' AS name", "lower(s_name) AS inn", "'c' AS contacts",
            "true AS is_active",
        )
        return base.unionByName(copies)

    @property
    def warehouses(self) -> DataFrame:
        c = self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        return c.selectExpr(
            "c_custkey AS id",
            "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment || ' ' || n_name || ' ' END AS name",
            "CASE WHEN c_nationkey < 10 THEN NULL ELSE ' zone ' || c_nationkey END AS address",
            "CASE WHEN c_acctbal < 1000 THEN NULL ELSE c_acctbal < 9000 END AS is_active",
        )

    @property
    def products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS id",
            "CASE WHEN p_size < 4 THEN NULL ELSE p_name || ' ' || p_brand END AS sku",
            "CASE WHEN p_type = 'SMALL' THEN ' ' ELSE p_type END AS name",
            "CASE WHEN p_size < 20 THEN NULL ELSE 'box' END AS unit",
            "CASE WHEN p_size > 45 THEN 'none'"
            " ELSE CAST(CAST(p_size * 30 AS DECIMAL(15,2)) AS STRING) END AS cost_price",
            "CASE WHEN p_size < 6 THEN NULL"
            " ELSE CAST(CAST(p_retailprice AS DECIMAL(15,2)) AS STRING) END AS selling_price",
            "CASE WHEN p_size < 10 THEN NULL ELSE p_size < 40 END AS is_active",
        )

    @property
    def sales(self) -> DataFrame:
        fleet = self.table("supplier").agg(F.count(F.lit(1))).scalar()
        orders = self.table("orders").join(
            self.table("customer").select("c_custkey", "c_nationkey"),
            F.col("o_custkey") == F.col("c_custkey"),
        )
        return orders.select(
            F.col("o_orderkey").alias("id"),
            F.concat(F.lit("S-"), "o_orderkey").alias("number"),
            F.to_date("o_orderdate").alias("date"),
            F.col("o_custkey").alias("customer_id"),
            F.when(
                F.col("o_orderpriority") != "5-LOW", (F.col("o_orderkey") + F.col("o_custkey")) % fleet
            ).alias("driver_id"),
            (F.col("o_custkey") % fleet).alias("vehicle_id"),
            F.col("c_nationkey").cast("bigint").alias("warehouse_id"),
            F.col("o_totalprice").cast("decimal(15,2)").alias("total_amount"),
            F.col("o_orderdate").alias("created_at"),
        )

    @property
    def expenses(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_suppkey AS vehicle_id",
            "CAST(l_shipdate AS DATE) AS expense_date",
            "CASE WHEN l_returnflag = 'R' THEN 'fuel' WHEN l_returnflag = 'A' THEN 'wash'"
            " WHEN l_linestatus = 'O' THEN 'repair' ELSE 'other' END AS expense_category_en",
            "CAST(l_extendedprice AS DECIMAL(15,2)) AS amount_rub",
        )

    @property
    def telemetry(self) -> DataFrame:
        return self.table("events").selectExpr(
            "CAST(user_id AS STRING) AS order_key", "ts AS timestamp", "value AS spd"
        )

    @property
    def movements(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber AS id",
            "l_orderkey AS document_id",
            "CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN NULL ELSE l_partkey END AS product_id",
            "l_suppkey AS warehouse_id",
            "CASE WHEN l_tax > 0.07D THEN '31/31/1999'"
            " ELSE date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') END AS movement_date",
            "CASE WHEN l_discount > 0.09D THEN 'none'"
            " ELSE CAST(CAST(l_quantity AS DECIMAL(15,3)) AS STRING) END AS quantity_before",
            "CASE WHEN l_returnflag = 'N' THEN NULL"
            " ELSE CAST(CAST(l_linenumber * 5 - 20 AS DECIMAL(15,3)) AS STRING) END AS quantity_change",
            "CASE WHEN l_returnflag = 'R' THEN NULL"
            " ELSE CAST(CAST(l_quantity - 10 AS DECIMAL(15,3)) AS STRING) END AS quantity_after",
            "CASE WHEN l_tax < 0.02D THEN NULL ELSE 'moved' END AS comment",
            "CASE WHEN l_tax < 0.04D THEN NULL ELSE 'clerk' END AS created_by",
        )

    @property
    def balances(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber AS id",
            "l_partkey AS product_id",
            "l_suppkey AS warehouse_id",
            "CASE WHEN l_tax > 0.07D THEN NULL ELSE CAST(l_quantity - 10 AS DECIMAL(15,3)) END AS quantity",
        )

    @property
    def ruled_movements(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber AS id",
            "l_shipdate AS movement_date",
            "CASE WHEN l_tax > 0.07D THEN 'GIFT' WHEN l_tax < 0.01D THEN NULL ELSE 'SALE' END AS document_type",
            "l_orderkey AS document_id",
            "CASE WHEN l_discount > 0.09D THEN 'LOST' WHEN l_returnflag = 'R' THEN 'INCOME' ELSE 'OUTCOME' END AS operation_type",
            "CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN NULL ELSE l_partkey END AS product_id",
            "l_suppkey AS warehouse_id",
            "l_quantity AS quantity_before",
            "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linenumber END AS quantity_change",
            "l_quantity AS quantity_after",
        )

    @property
    def purchases(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey AS id",
            "CASE WHEN o_orderstatus = 'P' THEN 'P-' || o_custkey ELSE 'P-' || o_orderkey END AS number",
            "CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date",
            "o_custkey AS supplier_id",
            "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey + 1 END AS warehouse_id",
        )

    def _line(self, price: str) -> list[str]:
        return [
            "CAST(l_quantity - 2 AS DECIMAL(15,3)) AS quantity",
            "CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_quantity - 2 AS DECIMAL(15,3)) * 3 AS DECIMAL(15,2))"
            " WHEN l_tax < 0.04D THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(15,2)) END AS amount",
            f"CAST(CASE WHEN l_discount > 0.08D THEN -1 ELSE 3 END AS DECIMAL(15,2)) AS {price}",
        ]

    @property
    def purchase_lines(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber % 5 AS id",
            "l_orderkey + l_linenumber % 2 AS purchase_id",
            "CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_partkey + 3 END AS product_id",
            *self._line("purchase_price"),
        )

    @property
    def sale_lines(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber AS id",
            "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS sale_id",
            "l_suppkey * 5 AS product_id",
            *self._line("selling_price"),
        )

    @property
    def sheets(self) -> DataFrame:
        rows = (
            self.table("lineitem")
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        )
        return rows.selectExpr(
            "CASE WHEN l_tax > 0.075D THEN date_format(l_shipdate, 'dd') WHEN l_tax > 0.065D THEN '31.02'"
            " ELSE date_format(l_shipdate, 'dd.MM') END AS day_month_raw",
            "CASE WHEN l_discount < 0.005D THEN NULL WHEN l_discount < 0.015D THEN 'nobody'"
            f" ELSE ' ' || lower(s_name) || '{TAB}' END AS vehicle_plate",
            "CASE WHEN l_quantity < 4 THEN NULL"
            " WHEN l_quantity < 12 THEN CASE WHEN s_acctbal > 5000 THEN s_name ELSE n_name END"
            " WHEN s_acctbal > 5000 THEN lower(s_name) || ' ' || n_name"
            " ELSE ' ' || n_name || '   ' || s_name || ' jr' END AS driver_name",
            "CASE WHEN l_linenumber = 1 THEN 'Топливо' WHEN l_linenumber = 2 THEN ' ГСМ'"
            " WHEN l_linenumber = 3 THEN 'Ремонт' WHEN l_linenumber = 4 THEN 'Мойка авто '"
            " WHEN l_linenumber = 5 THEN 'топливо' WHEN l_linenumber = 6 THEN 'ТО' ELSE NULL END AS expense_category",
            "'c' || s_nationkey AS counterparty",
            "CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'D-' || l_orderkey END AS document_number",
            "CASE WHEN l_quantity > 48 THEN 'abc'"
            " WHEN l_returnflag = 'A' THEN replace(CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING), '.', ',') || ' ₽'"
            " WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN '-' || CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING)"
            " ELSE CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING) END AS amount_rub",
            "l_linestatus AS comment",
            "'sheet_' || year(l_shipdate) || '.xlsx' AS source_file",
            "CASE WHEN l_tax < 0.005D AND l_linestatus = 'F' THEN 'sheet'"
            " ELSE 'sheet_' || year(l_shipdate) END AS source_month",
        )

    # ---- star ----

    @property
    def dim_time(self) -> DataFrame:
        return dim_time(self.spark, *CALENDAR)

    @property
    def dim_customer(self) -> DataFrame:
        people = self.table("customer").selectExpr(
            "c_custkey AS id", "c_name AS name", "c_mktsegment AS customer_segment"
        )
        return dim_customer(people, RUN_TS)

    @property
    def dim_vehicle(self) -> DataFrame:
        cars = self.table("supplier").selectExpr(
            "s_suppkey AS id", "s_name AS plate_number", "'Model ' || s_nationkey AS model",
            "s_acctbal >= 0 AS is_active",
        )
        return dim_vehicle(cars, RUN_TS)

    @property
    def dim_warehouse(self) -> DataFrame:
        sites = self.table("nation").selectExpr("n_nationkey AS id", "n_name AS name")
        return dim_warehouse(sites, RUN_TS)

    @property
    def fact(self) -> DataFrame:
        return fact_orders(
            self.sales,
            expenses_by_vehicle_day(self.expenses),
            trip_metrics(self.telemetry),
            RUN_TS,
            ANALYTIC_FACT,
        )
