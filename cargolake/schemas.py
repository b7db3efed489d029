"""Explicit schemas of the sources and of the star, as ordered name -> type maps."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cargolake.functions.expenses import SHEET_HEADERS

Schema = Mapping[str, str]


def ddl(schema: Schema) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in schema.items())


def empty(spark: SparkSession, schema: Schema) -> DataFrame:
    return spark.createDataFrame([], ddl(schema))


def conform(
    df: DataFrame, schema: Schema, defaults: Mapping[str, object] | None = None, lenient: bool = False
) -> DataFrame:
    """Project to exactly ``schema``, in its order and types.

    A column the input lacks becomes a typed NULL; then the default of the
    column, if it has one, replaces NULLs. ``lenient`` turns values that
    cannot be read in the new type into NULL instead of failing.
    """
    defaults, given, cast = defaults or {}, set(df.columns), "TRY_CAST" if lenient else "CAST"

    def column(name: str, kind: str) -> Column:
        value = F.expr(f"{cast}({f'`{name}`' if name in given else 'NULL'} AS {kind}) AS `{name}`")
        if name in defaults:
            value = F.coalesce(value, F.lit(defaults[name]).cast(kind)).alias(name)
        return value

    return df.select(*(column(name, kind) for name, kind in schema.items()))


# ---- sources -------------------------------------------------------------

TELEMETRY: Schema = {
    "ts": "bigint",
    "loc": "struct<lat: double, lon: double>",
    "spd": "double",
    "h": "int",
    "acc": "struct<lon: double, lat: double>",
    "eng": "struct<rpm: int, thr: int, tmp: int>",
    "flags": "struct<abs: boolean, belt: boolean, doors: int, car_id: string>",
    "gps": "struct<sat: int, hdop: double>",
}

TELEMETRY_BRONZE: Schema = {
    **TELEMETRY,
    "source_file": "string",
    "log_date": "string",
    "load_timestamp": "timestamp_ntz",
    "order_key": "string",
    "lat": "double",
    "lon": "double",
    "rpm": "int",
    "engine_temp": "int",
    "car_id": "string",
    "abs_active": "boolean",
    "gps_satellites": "int",
    "other_fields": "string",  # fields of the point that have no place here, as JSON
}

EXPENSE_SHEET: Schema = {
    **{header: "string" for header in SHEET_HEADERS},
    "source_file": "string",
    "source_month": "string",
    "load_date": "timestamp_ntz",
    "other_columns": "string",  # columns of the sheet that have no place here, as JSON
}

EXPENSES_BY_VEHICLE: Schema = {
    "vehicle_id": "bigint",
    "expense_date": "date",
    "fuel_expense": "decimal(15,2)",
    "other_expense": "decimal(15,2)",
    "wash_expense": "decimal(15,2)",
    "total_expense": "decimal(15,2)",
}

SILVER_EXPENSES: Schema = {
    "vehicle_plate": "string",
    "driver_name": "string",
    "expense_category": "string",
    "counterparty": "string",
    "document_number": "string",
    "amount_rub": "decimal(15,2)",
    "comment": "string",
    "source_file": "string",
    "load_date": "timestamp_ntz",
    "expense_date": "date",
    "vehicle_id": "bigint",
    "driver_id": "bigint",
    "expense_category_en": "string",
    "etl_updated_at": "timestamp_ntz",
    "etl_source": "string",
    "record_type": "string",
}

OPERATIONAL: Mapping[str, Schema] = {
    "customers": {
        "id": "bigint", "name": "string", "inn": "string", "contacts": "string",
        "address": "string", "is_active": "boolean",
    },
    "suppliers": {
        "id": "bigint", "name": "string", "inn": "string", "contacts": "string",
        "is_active": "boolean",
    },
    "warehouses": {
        "id": "bigint", "name": "string", "address": "string", "is_active": "boolean",
    },
    "drivers": {
        "id": "bigint", "full_name": "string", "license_number": "string",
        "phone": "string", "is_active": "boolean",
    },
    "vehicles": {
        "id": "bigint", "plate_number": "string", "model": "string", "is_active": "boolean",
    },
    "products": {
        "id": "bigint", "sku": "string", "name": "string", "unit": "string",
        "cost_price": "decimal(15,2)", "selling_price": "decimal(15,2)", "is_active": "boolean",
    },
    "purchase_headers": {
        "id": "bigint", "number": "string", "date": "date", "supplier_id": "bigint",
        "warehouse_id": "bigint", "total_amount": "decimal(15,2)", "comment": "string",
        "created_at": "timestamp_ntz",
    },
    "purchase_items": {
        "id": "bigint", "purchase_id": "bigint", "product_id": "bigint",
        "quantity": "decimal(15,3)", "purchase_price": "decimal(15,2)",
        "amount": "decimal(15,2)",
    },
    "sale_headers": {
        "id": "bigint", "number": "string", "date": "date", "customer_id": "bigint",
        "driver_id": "bigint", "vehicle_id": "bigint", "warehouse_id": "bigint",
        "total_amount": "decimal(15,2)", "comment": "string", "created_at": "timestamp_ntz",
    },
    "sale_items": {
        "id": "bigint", "sale_id": "bigint", "product_id": "bigint",
        "quantity": "decimal(15,3)", "selling_price": "decimal(15,2)",
        "amount": "decimal(15,2)",
    },
    "stock_balances": {
        "id": "bigint", "product_id": "bigint", "warehouse_id": "bigint",
        "quantity": "decimal(15,3)",
    },
    "stock_movements": {
        "id": "bigint", "movement_date": "timestamp_ntz", "document_type": "string",
        "document_id": "bigint", "operation_type": "string", "product_id": "bigint",
        "warehouse_id": "bigint", "quantity_before": "decimal(15,3)",
        "quantity_change": "decimal(15,3)", "quantity_after": "decimal(15,3)",
        "comment": "string", "created_by": "string",
    },
}

# ---- star ----------------------------------------------------------------

DIM_TIME: Schema = {
    "time_id": "int", "full_date": "date", "year": "int", "quarter": "int", "month": "int",
    "day_of_week": "int", "day": "int", "day_of_week_name": "string", "is_weekend": "boolean",
    "is_holiday": "boolean", "holiday_name": "string", "week_num": "int", "fiscal_year": "int",
}

DIM_CUSTOMER: Schema = {
    "customer_id": "bigint", "name": "string", "short_name": "string", "inn": "string",
    "ognr": "string", "contact_person": "string", "phone": "string", "email": "string",
    "address": "string", "customer_segment": "string", "credit_limit": "decimal(15,2)",
    "is_active": "boolean", "registration_date": "date", "etl_updated_at": "timestamp_ntz",
}

DIM_DRIVER: Schema = {
    "driver_id": "bigint", "full_name": "string", "last_name": "string", "first_name": "string",
    "middle_name": "string", "license_number": "string", "license_category": "string",
    "phone": "string", "email": "string", "is_active": "boolean",
    "etl_updated_at": "timestamp_ntz",
}

DIM_VEHICLE: Schema = {
    "vehicle_id": "bigint", "gov_number": "string", "model": "string", "brand": "string",
    "fuel_type": "string", "engine_capacity": "decimal(5,1)", "max_load_kg": "int",
    "trailer_number": "string", "is_active": "boolean", "etl_updated_at": "timestamp_ntz",
}

DIM_WAREHOUSE: Schema = {
    "warehouse_id": "bigint", "name": "string", "code": "string", "address": "string",
    "city": "string", "region": "string", "responsible_person": "string",
    "is_active": "boolean", "warehouse_type": "string", "etl_updated_at": "timestamp_ntz",
}

DIM_PRODUCT: Schema = {
    "product_id": "bigint", "sku": "string", "name": "string", "category": "string",
    "unit": "string", "cost_price": "decimal(15,2)", "selling_price": "decimal(15,2)",
    "is_active": "boolean", "etl_updated_at": "timestamp_ntz",
}

FACT_ORDERS: Schema = {
    "order_key": "bigint", "sale_id": "string", "time_id": "int", "customer_id": "bigint",
    "driver_id": "bigint", "vehicle_id": "bigint", "warehouse_id": "bigint",
    "order_amount": "decimal(15,2)", "total_quantity": "bigint", "gross_profit": "decimal(15,2)",
    "fuel_expense": "decimal(15,2)", "other_expense": "decimal(15,2)",
    "wash_expense": "decimal(15,2)", "total_vehicle_expense": "decimal(15,2)",
    "trip_duration_minutes": "bigint", "avg_speed_kmh": "float", "net_profit": "decimal(15,2)",
    "margin_percent": "float", "etl_loaded_at": "timestamp_ntz",
}

STAR: Mapping[str, Schema] = {
    "dim_time": DIM_TIME,
    "dim_customer": DIM_CUSTOMER,
    "dim_driver": DIM_DRIVER,
    "dim_vehicle": DIM_VEHICLE,
    "dim_warehouse": DIM_WAREHOUSE,
    "dim_product": DIM_PRODUCT,
    "fact_orders": FACT_ORDERS,
}

# What a star column holds when the silver table has no such column or no value.
# ``registration_date`` and ``etl_updated_at`` take the run's date and time.
STAR_DEFAULTS: Mapping[str, Mapping[str, object]] = {
    "dim_customer": {
        "short_name": "", "inn": "", "ognr": "", "contact_person": "", "phone": "",
        "email": "", "address": "", "customer_segment": "", "credit_limit": Decimal(0),
        "is_active": True,
    },
    "dim_driver": {
        "full_name": "", "license_number": "", "license_category": "", "phone": "",
        "email": "", "is_active": True,
    },
    "dim_vehicle": {
        "gov_number": "", "model": "", "brand": "", "fuel_type": "gasoline",
        "engine_capacity": Decimal("1.6"), "max_load_kg": 0, "trailer_number": "",
        "is_active": True,
    },
    "dim_warehouse": {
        "name": "", "code": "", "address": "", "city": "", "region": "",
        "responsible_person": "", "is_active": True, "warehouse_type": "standard",
    },
    "dim_product": {
        "sku": "", "name": "", "category": "", "unit": "pcs", "cost_price": Decimal(0),
        "selling_price": Decimal(0), "is_active": True,
    },
    "fact_orders": {"sale_id": ""},
}


def stamp(run_ts: datetime) -> Column:
    """The run's time as a zone-less timestamp literal."""
    return F.lit(run_ts.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def day(d: date) -> Column:
    return F.lit(d.isoformat()).cast("date")
