"""Silver entities: what a clean row of each table is.

Two rules hold throughout. Deduplication compares raw keys, before the text is
normalised, so spellings that differ only in blanks or case stay apart unless
``dedup_after`` asks for the stricter reading. And since one row per key is
left, no second full-row distinct follows: it could not remove anything.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from cargolake.functions.dates import compose_date, from_epoch_millis
from cargolake.functions.expenses import SHEET_HEADERS, category_of
from cargolake.functions.numbers import MONEY, QUANTITY, money_text
from cargolake.functions.text import collapse_blanks, plate_key, strip
from cargolake.operators.aggregates import item_totals
from cargolake.operators.cleaning import (
    NO_LICENSE,
    NO_PLATE,
    NOT_PROVIDED,
    UNKNOWN,
    audit,
    clamp,
    drop_sentinel,
    fill_defaults,
    fingerprint,
    flag,
    keep_if,
    keep_unless,
    lenient_cast,
    normalise_text,
    rename,
    repair_quantities,
    require,
)
from cargolake.operators.dedup import dedup, distinct_business
from cargolake.operators.lookups import driver_lookup, own_shuffle, vehicle_lookup
from cargolake.schemas import SILVER_EXPENSES, conform


def _entity(
    df: DataFrame, key: str, defaults: Mapping[str, object], dedup_after: bool = False
) -> DataFrame:
    """Keep the first row per raw key, normalise the texts, fill the gaps."""
    clean = normalise_text(dedup(df, [key], ["id"]))
    if dedup_after:
        clean = dedup(clean, [key], ["id"])
    return fill_defaults(clean, {**defaults, "is_active": True})


def clean_customers(df: DataFrame, run_ts: datetime, dedup_after: bool = False) -> DataFrame:
    """Customers with a tax number, one per raw tax number, with a stable fingerprint."""
    gaps = {"name": UNKNOWN, "contacts": NOT_PROVIDED, "address": NOT_PROVIDED}
    clean = require(_entity(df, "inn", gaps, dedup_after), ["inn"])
    return fingerprint(audit(clean, run_ts), ["inn", "name"])


def clean_suppliers(df: DataFrame, run_ts: datetime, dedup_after: bool = False) -> DataFrame:
    gaps = {"name": UNKNOWN, "contacts": NOT_PROVIDED}
    return audit(require(_entity(df, "inn", gaps, dedup_after), ["inn"]), run_ts)


def clean_drivers(df: DataFrame, run_ts: datetime, dedup_after: bool = False) -> DataFrame:
    """Drivers with a licence; the others are marked by the fill and dropped."""
    gaps = {"full_name": UNKNOWN, "phone": NOT_PROVIDED, "license_number": NO_LICENSE}
    clean = _entity(df, "license_number", gaps, dedup_after)
    return audit(drop_sentinel(clean, "license_number", NO_LICENSE), run_ts)


def clean_vehicles(df: DataFrame, run_ts: datetime, dedup_after: bool = False) -> DataFrame:
    gaps = {"plate_number": NO_PLATE, "model": UNKNOWN}
    clean = _entity(df, "plate_number", gaps, dedup_after)
    return audit(drop_sentinel(clean, "plate_number", NO_PLATE), run_ts)


def clean_warehouses(df: DataFrame, run_ts: datetime, dedup_after: bool = False) -> DataFrame:
    """Warehouses; none is dropped, an unnamed one is called Unknown."""
    gaps = {"name": UNKNOWN, "address": NOT_PROVIDED}
    return audit(_entity(df, "name", gaps, dedup_after), run_ts)


def clean_products(df: DataFrame, run_ts: datetime, dedup_after: bool = False) -> DataFrame:
    """Products with a SKU; prices that cannot be read are 0; selling under cost is flagged."""
    df = lenient_cast(df, {"cost_price": MONEY, "selling_price": MONEY})
    gaps = {"name": UNKNOWN, "unit": "pcs", "cost_price": 0, "selling_price": 0}
    clean = _entity(df, "sku", gaps, dedup_after)
    clean = flag(clean, "price_logic_issue", F.col("selling_price") < F.col("cost_price"))
    return audit(require(clean, ["sku"]), run_ts)


def clean_sale_headers(headers: DataFrame, items: DataFrame | None, run_ts: datetime) -> DataFrame:
    """Sales with a positive amount and a creation time; the amount is the sum of the lines.

    A sale without lines keeps its own amount. A sale whose lines are all
    unreadable amounts to 0 and is dropped. Dedup, line totals and join all
    hash on the sale id, so each table is shuffled once.
    """
    sales = dedup(headers, ["id"], ["created_at"])
    sales = lenient_cast(sales, {"total_amount": MONEY, "created_at": "timestamp_ntz"})
    if items is not None:
        totals = item_totals(items).withColumnRenamed("sale_id", "_sale")
        same = F.col("id") == F.col("_sale")
        if sales.schema["id"].dataType != totals.schema["_sale"].dataType:
            same = F.col("id").cast("string") == F.col("_sale").cast("string")
        sales = (
            sales.join(totals, same, "left")
            .withColumn("total_amount", F.coalesce("computed_total", "total_amount"))
            .drop("_sale", "computed_total")
        )
    sales = fill_defaults(sales, {"comment": ""}).withColumn("id", F.col("id").cast("string"))
    sales = keep_if(sales, F.col("total_amount") > 0)
    return audit(require(sales, ["created_at"]), run_ts)


def clean_purchase_headers(df: DataFrame, run_ts: datetime) -> DataFrame:
    """Purchases with a date, which falls back to the creation time."""
    df = lenient_cast(
        dedup(df, ["id"], ["created_at"]),
        {"total_amount": MONEY, "date": "timestamp_ntz", "created_at": "timestamp_ntz"},
    )
    df = fill_defaults(df, {"comment": ""}).withColumns(
        {"id": F.col("id").cast("string"), "date": F.coalesce("date", "created_at")}
    )
    return audit(require(df, ["date"]), run_ts)


def clean_stock_movements(df: DataFrame, run_ts: datetime) -> DataFrame:
    """Movements with date, product and warehouse whose quantity changes or is not known to stay."""
    df = lenient_cast(
        dedup(df, ["id"], ["movement_date"]),
        {
            "movement_date": "timestamp_ntz",
            "quantity_before": QUANTITY,
            "quantity_change": QUANTITY,
            "quantity_after": QUANTITY,
        },
    )
    df = require(repair_quantities(df), ["movement_date", "product_id", "warehouse_id"])
    df = keep_unless(df, F.col("quantity_change") == 0)
    df = flag(df, "is_negative_after", F.col("quantity_after") < 0)
    return audit(fill_defaults(df, {"comment": "", "created_by": "system"}), run_ts)


def clean_stock_balances(df: DataFrame, run_ts: datetime) -> DataFrame:
    """The last balance per product and warehouse, never negative."""
    df = dedup(df, ["product_id", "warehouse_id"], ["id"], keep="last")
    df = clamp(lenient_cast(df, {"quantity": QUANTITY}), "quantity")
    return audit(require(df, ["product_id", "warehouse_id"]), run_ts)


def clean_expenses(
    raw: DataFrame, vehicles: DataFrame | None, drivers: DataFrame | None, run_ts: datetime
) -> DataFrame:
    """Expense sheet rows with a date and an amount of at least 0, tied to vehicle and driver.

    Equal rows of one sheet count once, whenever they were loaded. Without
    both lookups the ids are 0 and every category is 'other'.
    """
    df = rename(distinct_business(raw, exclude=["load_date"]), SHEET_HEADERS)
    df = df.withColumn("expense_date", compose_date(F.col("day_month_raw"), F.col("source_month")))
    df = require(df.drop("day_month_raw", "source_month"), ["expense_date"])
    df = df.withColumn("amount_rub", money_text(F.col("amount_rub")))
    df = keep_if(df, F.col("amount_rub") >= 0).withColumns(
        {
            "vehicle_plate": plate_key(F.coalesce("vehicle_plate", F.lit(UNKNOWN))),
            "driver_name": collapse_blanks(strip(F.coalesce("driver_name", F.lit(UNKNOWN)))),
            "expense_category": strip(F.coalesce("expense_category", F.lit("Other"))),
        }
    )
    if vehicles is None or drivers is None:
        df = df.withColumns(
            {"vehicle_id": F.lit(0), "driver_id": F.lit(0), "expense_category_en": F.lit("other")}
        )
    else:
        df = tie(df, vehicles, drivers)
        df = df.withColumn("expense_category_en", category_of(F.col("expense_category")))
    return conform(audit(df, run_ts, "excel/all_expenses", "expense"), SILVER_EXPENSES)


def tie(expenses: DataFrame, vehicles: DataFrame, drivers: DataFrame) -> DataFrame:
    """Add ``vehicle_id`` and ``driver_id``, found once for each pair of plate and name, in one join of the rows."""
    keys = ["vehicle_plate", "driver_name"]
    pairs = driver_lookup(vehicle_lookup(expenses.select(*keys).distinct(), vehicles), drivers)
    return expenses.join(own_shuffle(pairs, "vehicle_plate"), keys)


# What a telemetry point holds where a sensor gave nothing.
TELEMETRY_DEFAULTS = {
    "spd": 0,
    "h": -1,
    "engine_rpm": 0,
    "engine_throttle": 0,
    "engine_temp": -273,
    "flag_abs": False,
    "flag_belt": False,
    "flag_doors": 0,
    "gps_satellites": 0,
    "gps_hdop": 99.9,
    "latitude": 0.0,
    "longitude": 0.0,
    "acc_lon": 0.0,
    "acc_lat": 0.0,
}

# Silver telemetry fields and where they sit in a raw point.
TELEMETRY_FIELDS = {
    "latitude": "loc.lat",
    "longitude": "loc.lon",
    "acc_lon": "acc.lon",
    "acc_lat": "acc.lat",
    "engine_rpm": "eng.rpm",
    "engine_throttle": "eng.thr",
    "engine_temp": "eng.tmp",
    "flag_abs": "flags.abs",
    "flag_belt": "flags.belt",
    "flag_doors": "flags.doors",
    "car_id": "flags.car_id",
    "gps_satellites": "gps.sat",
    "gps_hdop": "gps.hdop",
}

# Bronze copies of nested fields under their short names.
BRONZE_FIELDS = {
    "lat": "loc.lat",
    "lon": "loc.lon",
    "rpm": "eng.rpm",
    "engine_temp": "eng.tmp",
    "car_id": "flags.car_id",
    "abs_active": "flags.abs",
    "gps_satellites": "gps.sat",
}


def lift_fields(df: DataFrame, fields: Mapping[str, str], drop: Sequence[str] = ()) -> DataFrame:
    """Nested fields as columns; a NULL struct gives NULL fields."""
    return df.withColumns({name: F.col(path) for name, path in fields.items()}).drop(*drop)


def clean_telemetry(raw: DataFrame, run_ts: datetime) -> DataFrame:
    """Telemetry points of a known order with a time, flattened, distinct, gaps filled.

    Two equal points of one file count once; load times do not make a
    difference between them.
    """
    df = require(raw.drop("other_fields"), ["order_key"])
    df = lift_fields(df, TELEMETRY_FIELDS, drop=["loc", "acc", "eng", "flags", "gps"])
    df = df.withColumn("timestamp", from_epoch_millis(F.col("ts"))).drop("ts")
    # points without a time go before the shuffle of the distinct: same rows, less to move
    df = distinct_business(require(df, ["timestamp"]), exclude=["load_timestamp"])
    df = df.withColumn("car_id", plate_key(F.coalesce("car_id", F.lit(UNKNOWN))))
    df = audit(fill_defaults(df, TELEMETRY_DEFAULTS), run_ts, "json/telemetry", "telemetry")
    return df.withColumn("event_date", F.to_date("timestamp"))
