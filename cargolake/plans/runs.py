"""The three layer runs as ordered calls."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from cargolake.config import WarehouseConfig, durable, size_shuffle
from cargolake.operators.aggregates import (
    expense_metrics,
    expenses_by_vehicle_day,
    movement_metrics,
    observed,
    product_metrics,
    row_metrics,
    telemetry_metrics,
    trip_metrics,
)
from cargolake.operators.quality import quality_report
from cargolake.plans import entities, marts, months, reports
from cargolake.plans.constraints import constraint_report
from cargolake.schemas import (
    EXPENSE_SHEET,
    EXPENSES_BY_VEHICLE,
    OPERATIONAL,
    SILVER_EXPENSES,
    TELEMETRY_BRONZE,
    conform,
)
from cargolake.sources.operational import ingest_jdbc
from cargolake.sources.tables import (
    declare_marts,
    publish_dimension,
    publish_fact,
    publish_jdbc,
    publish_table,
    read_optional,
    read_or_empty,
    read_table,
)
from cargolake.sources.telemetry import broken_count, parsed, scan_lines, to_bronze, to_rejected
from cargolake.sources.workbooks import book_errors, expense_rows, scan_workbooks
from cargolake.streaming.telemetry import land_new_telemetry

SIMPLE_ENTITIES: dict[str, Callable[..., DataFrame]] = {
    "customers": entities.clean_customers,
    "drivers": entities.clean_drivers,
    "vehicles": entities.clean_vehicles,
    "suppliers": entities.clean_suppliers,
    "warehouses": entities.clean_warehouses,
    "products": entities.clean_products,
    "purchase_headers": entities.clean_purchase_headers,
    "stock_movements": entities.clean_stock_movements,
    "stock_balances": entities.clean_stock_balances,
}

# The silver tables of the quality report.
REPORTED = (
    "customers", "drivers", "vehicles", "suppliers", "warehouses", "sale_headers",
    "purchase_headers", "stock_movements", "products", "stock_balances",
)


def reason(e: Exception) -> str:
    return "failed: " + (str(e) or repr(e)).splitlines()[0]


def run_bronze(spark: SparkSession, cfg: WarehouseConfig) -> dict[str, str]:
    """Ingest the three sources; the failure of one does not stop the others.

    Returns per source what became of it: ``loaded`` (with the number of
    rejected books or lines, which are stored under ``quarantine``), ``no
    files``, ``skipped``, or ``failed`` with the tables or the reason. A source
    without files, or that fails, leaves its old table as it was.
    """

    def tables() -> str:
        if not cfg.jdbc_url:
            return "skipped"
        report = ingest_jdbc(
            spark, cfg.jdbc_url, cfg.bronze("postgres"),
            properties=cfg.jdbc_properties, rows_per_task=cfg.jdbc_rows,
        )
        failed = [r["table"] for r in report.where("status = 'failed'").collect()]
        return f"failed: {', '.join(failed)}" if failed else "loaded"

    def loaded(rejected: int, what: str) -> str:
        return f"loaded, {rejected} {what} rejected" if rejected else "loaded"

    def books() -> str:
        decoded = durable(scan_workbooks(spark, cfg.raw("excel")))  # the files are decoded once
        files = decoded.agg(F.count_distinct("path"), F.count_distinct(F.when(F.col("read_error").isNotNull(), F.col("path")))).first()
        if not files[0]:
            return "no files"
        publish_table(book_errors(decoded), cfg.bronze("quarantine/books"))
        if files[0] == files[1]:
            return "failed: no readable book"
        publish_table(expense_rows(decoded, cfg.run_ts), cfg.bronze("excel/all_expenses"))
        return loaded(files[1], "books")

    def logs() -> str:
        target, rejects = cfg.bronze("json/telemetry"), cfg.bronze("quarantine/lines")
        if cfg.incremental_logs:
            state = cfg.bronze("json/_ingested")
            landed = land_new_telemetry(spark, cfg.raw("json"), target, state, cfg.run_ts, rejected=rejects)
            return "loaded" if landed else "no files"
        lines = scan_lines(spark, cfg.raw("json"))
        if lines is None or lines.limit(1).isEmpty():
            return "no files"
        points = parsed(lines)
        watch = Observation("lines")
        publish_table(to_bronze(points.observe(watch, broken_count().alias("n")), cfg.run_ts), target, partition_by=["log_date"])
        if watch.get["n"] or read_optional(spark, rejects) is not None:  # those of an earlier run do not stay
            publish_table(to_rejected(points, cfg.run_ts), rejects)
        return loaded(watch.get["n"], "lines")

    outcome = {}
    for source, ingest in {"tables": tables, "books": books, "logs": logs}.items():
        try:
            outcome[source] = ingest()
        except Exception as e:  # whatever stops one source must not stop the others
            outcome[source] = reason(e)
    return outcome


def run_silver(spark: SparkSession, cfg: WarehouseConfig) -> dict[str, dict[str, object]]:
    """Clean every table, the expenses and the telemetry; each stands by itself.

    Returns the run counters per table, taken while the tables are written
    (except the distinct counts of the telemetry). A table that is missing or
    fails has the single counter ``failed`` with the reason; its old silver
    table stays, and everything else is written.
    """
    size_shuffle(spark, cfg.bronze("").rstrip("/"))
    counts: dict[str, dict[str, object]] = {}

    def bronze(table: str) -> DataFrame:
        raw = read_table(spark, cfg.bronze(f"postgres/{table}"))
        return conform(raw, OPERATIONAL[table], lenient=True)

    def write_counted(df: DataFrame, name: str, path: str, metrics: Mapping[str, Column]) -> None:
        watched, watch = observed(df, name, metrics)
        publish_table(watched, path)
        counts[name] = watch.get

    def attempt(name: str, work: Callable[[], None]) -> None:
        try:
            work()
        except Exception as e:  # whatever stops one table must not stop the others
            counts[name] = {"failed": reason(e)}

    special = {"products": product_metrics(), "stock_movements": movement_metrics()}

    def simple(table: str) -> None:
        df, path = SIMPLE_ENTITIES[table](bronze(table), cfg.run_ts), cfg.silver(f"postgres/{table}")
        write_counted(df, table, path, special.get(table, row_metrics()))

    def sale_headers() -> None:
        headers = bronze("sale_headers")
        items = read_optional(spark, cfg.bronze("postgres/sale_items"))
        sales = entities.clean_sale_headers(headers, items, cfg.run_ts)
        write_counted(sales, "sale_headers", cfg.silver("postgres/sale_headers"), row_metrics())
        counts["sale_headers"]["removed"] = headers.count() - counts["sale_headers"]["rows"]

    def expenses() -> None:
        raw = read_optional(spark, cfg.bronze("excel/all_expenses"))
        if raw is not None:
            lookups = (read_optional(spark, cfg.silver(f"postgres/{t}")) for t in ("vehicles", "drivers"))
            df = entities.clean_expenses(conform(raw, EXPENSE_SHEET), *lookups, cfg.run_ts)
            write_counted(df, "expenses", cfg.silver("excel/all_expenses"), expense_metrics())

    def telemetry() -> None:
        points = read_optional(spark, cfg.bronze("json/telemetry"))
        if points is not None:
            # the folder column comes back as a date; the schema has it as text
            clean = entities.clean_telemetry(conform(points, TELEMETRY_BRONZE), cfg.run_ts)
            publish_table(
                clean, cfg.silver("json/telemetry"),
                partition_by=["event_date"], sort_by=["order_key", "timestamp"],
            )
            written = read_table(spark, cfg.silver("json/telemetry"))
            counts["telemetry"] = written.agg(*(c.alias(n) for n, c in telemetry_metrics().items())).first().asDict()

    def quality() -> None:
        found = {t: read_optional(spark, cfg.silver(f"postgres/{t}")) for t in REPORTED}
        tables = {t: df for t, df in found.items() if df is not None}
        if tables:
            publish_table(quality_report(tables, cfg.run_ts), cfg.silver("metadata/quality_report"))

    for table in SIMPLE_ENTITIES:
        attempt(table, lambda table=table: simple(table))
    for name, work in {"sale_headers": sale_headers, "expenses": expenses, "telemetry": telemetry, "quality_report": quality}.items():
        attempt(name, work)
    return counts


def failed_tables(counts: Mapping[str, Mapping[str, object]]) -> set[str]:
    """The tables a silver run did not write."""
    return {name for name, found in counts.items() if "failed" in found}


# The silver table each dimension is built from.
DIMENSIONS: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "dim_customer": ("customers", marts.dim_customer),
    "dim_driver": ("drivers", marts.dim_driver),
    "dim_vehicle": ("vehicles", marts.dim_vehicle),
    "dim_warehouse": ("warehouses", marts.dim_warehouse),
    "dim_product": ("products", marts.dim_product),
}


def run_gold(spark: SparkSession, cfg: WarehouseConfig, failed: Collection[str] = ()) -> dict[str, object] | None:
    """Calendar, dimensions, daily vehicle costs and the fact; with ``mart_url`` they are loaded into the database too.

    Each mart stands by itself: what stops one is listed under ``failed`` with
    the reason, its old version stays, and the others are published. Nothing is
    published from the silver tables in ``failed``, nor from missing ones;
    those marts are listed under ``skipped``. Returns the numbers of orders and
    matched trips, or None when there were no sales, or none to trust, and the
    old fact was left in place. With ``incremental_fact`` only months whose
    orders, trips or costs changed are joined and written; the numbers are then
    those of these ``months``, and rows of others keep their load time.
    """
    size_shuffle(spark, cfg.silver("").rstrip("/"))
    gold, skipped, broken = cfg.gold("").rstrip("/"), [], {}
    declare_marts(spark, gold)

    def load(name: str) -> None:
        if cfg.mart_url:
            table = f"{cfg.mart_schema}.{name}"
            publish_jdbc(read_table(spark, f"{gold}/{name}"), cfg.mart_url, table, cfg.mart_properties, cfg.jdbc_rows)

    def attempt(name: str, work: Callable[[], object]) -> object:
        try:
            return work()
        except Exception as e:  # whatever stops one mart must not stop the others
            broken[name] = reason(e)
            return None

    def calendar() -> None:
        publish_dimension(marts.dim_time(spark, cfg.calendar_start, cfg.calendar_end), "dim_time", gold)
        load("dim_time")

    def dimension(name: str) -> None:
        source, build = DIMENSIONS[name]
        rows = None if source in failed else read_optional(spark, cfg.silver(f"postgres/{source}"))
        if rows is None:
            skipped.append(name)
            return
        publish_dimension(build(rows, cfg.run_ts), name, gold)
        load(name)

    def orders() -> dict[str, object] | None:
        sales = read_optional(spark, cfg.silver("postgres/sale_headers"))
        if sales is None or {"sale_headers", "expenses", "telemetry"} & set(failed):
            skipped.append("fact_orders")
            return None
        expenses = read_or_empty(spark, cfg.silver("excel/all_expenses"), SILVER_EXPENSES)
        by_day = cfg.silver("aggregated/expenses_by_vehicle")
        publish_table(conform(expenses_by_vehicle_day(expenses), EXPENSES_BY_VEHICLE), by_day)
        trip_points = read_or_empty(
            spark, cfg.silver("json/telemetry"),
            {"order_key": "string", "timestamp": "timestamp_ntz", "spd": "double"},
        )
        inputs, watch = (sales, read_table(spark, by_day), trip_metrics(trip_points)), Observation("fact_orders")
        path, state, digests, touched = f"{gold}/fact_orders", cfg.silver("metadata/fact_digests"), None, None
        if cfg.incremental_fact:
            if sales.isEmpty():
                return None
            inputs = (*inputs[:2], durable(inputs[2]))  # trips are summed up once for the digests and the fact
            digests = months.input_digests(*inputs)
            touched = months.touched_months(spark, path, state, digests)
            if touched is not None and not touched:
                return {"orders": 0, "matched_trips": 0, "months": 0}
            if touched is not None:
                inputs = months.inputs_of(touched, *inputs)
        fact = marts.fact_orders(*inputs, cfg.run_ts, watch=watch)
        if not publish_fact(fact, gold, source=sales, part=months.month_of(F.col("time_id")), touched=touched):
            return None
        if digests is not None:
            months.keep_digests(spark, path, state, digests)
        load("fact_orders")
        return watch.get | ({} if touched is None else {"months": len(touched)})

    attempt("dim_time", calendar)
    for name in DIMENSIONS:
        attempt(name, lambda name=name: dimension(name))
    counts = attempt("fact_orders", orders)
    missing = {word: found for word, found in (("skipped", skipped), ("failed", broken)) if found}
    return (counts or {}) | missing or None


def run_checks(spark: SparkSession, cfg: WarehouseConfig) -> None:
    """Report how far the ingested tables keep the rules of the operational database."""
    found = {t: read_optional(spark, cfg.bronze(f"postgres/{t}")) for t in OPERATIONAL}
    tables = {t: conform(df, OPERATIONAL[t], lenient=True) for t, df in found.items() if df is not None}
    publish_table(constraint_report(tables), cfg.silver("metadata/constraint_report"))


def run_all(spark: SparkSession, cfg: WarehouseConfig) -> dict[str, object]:
    """Bronze, silver, gold, in this order; returns what each of them returns.

    A layer goes on with what the one before it has, old tables included; the
    gold run publishes nothing from a silver table that failed.
    """
    bronze = run_bronze(spark, cfg)
    silver = run_silver(spark, cfg)
    return {"bronze": bronze, "silver": silver, "gold": run_gold(spark, cfg, failed_tables(silver))}


def run_reports(spark: SparkSession, cfg: WarehouseConfig, since: date = date(2023, 1, 1)) -> dict[str, DataFrame]:
    """The three reports over the published star; the weekly one reads the months from ``since`` on."""
    star = {name: read_table(spark, cfg.gold(name)) for name in
            ("fact_orders", "dim_customer", "dim_vehicle", "dim_warehouse", "dim_time")}
    fact, time = star["fact_orders"], star["dim_time"]
    recent = months.fact_since(spark, cfg.gold("fact_orders"), since) if months.part_names(spark, cfg.gold("fact_orders")) else fact
    return {
        "rfm": reports.rfm(fact, star["dim_customer"], time, cfg.as_of, unique_orders=True),
        "vehicle_efficiency": reports.vehicle_efficiency(fact, star["dim_vehicle"]),
        "weekly_warehouse": reports.weekly_warehouse(recent, star["dim_warehouse"], time, since),
    }
