"""The rules of the operational tables, and one report on how far the data keeps them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from cargolake.config import durable
from cargolake.operators.quality import check_rules

# The constraints the operational tables declare.
NOT_NULL = {
    "customers": ["name"],
    "suppliers": ["name"],
    "warehouses": ["name"],
    "drivers": ["full_name"],
    "vehicles": ["plate_number"],
    "products": ["sku", "name", "unit"],
    "purchase_headers": ["number", "date", "supplier_id", "warehouse_id"],
    "purchase_items": ["purchase_id", "product_id", "quantity", "purchase_price"],
    "sale_headers": ["number", "date", "customer_id", "warehouse_id"],
    "sale_items": ["sale_id", "product_id", "quantity", "selling_price"],
    "stock_balances": ["product_id", "warehouse_id", "quantity"],
    "stock_movements": [
        "movement_date", "document_type", "document_id", "operation_type", "product_id",
        "warehouse_id", "quantity_before", "quantity_change", "quantity_after",
    ],
}
CHECKS = {
    "purchase_items": {"quantity": "quantity > 0", "purchase_price": "purchase_price >= 0"},
    "sale_items": {"quantity": "quantity > 0", "selling_price": "selling_price >= 0"},
    "stock_balances": {"quantity": "quantity >= 0"},
    "stock_movements": {
        "document_type": "document_type IN ('PURCHASE', 'SALE', 'ADJUSTMENT')",
        "operation_type": "operation_type IN ('INCOME', 'OUTCOME')",
    },
}
# the amount of a line is its quantity times this price
LINE_PRICE = {"purchase_items": "purchase_price", "sale_items": "selling_price"}
UNIQUE = {
    "customers": [["id"], ["inn"]],
    "suppliers": [["id"], ["inn"]],
    "warehouses": [["id"]],
    "drivers": [["id"], ["license_number"]],
    "vehicles": [["id"], ["plate_number"]],
    "products": [["id"], ["sku"]],
    "purchase_headers": [["id"], ["number"]],
    "purchase_items": [["id"]],
    "sale_headers": [["id"], ["number"]],
    "sale_items": [["id"]],
    "stock_balances": [["id"], ["product_id", "warehouse_id"]],
    "stock_movements": [["id"]],
}
# column -> table whose id it holds
FOREIGN_KEYS = {
    "purchase_headers": {"supplier_id": "suppliers", "warehouse_id": "warehouses"},
    "purchase_items": {"purchase_id": "purchase_headers", "product_id": "products"},
    "sale_headers": {
        "customer_id": "customers", "driver_id": "drivers", "vehicle_id": "vehicles",
        "warehouse_id": "warehouses",
    },
    "sale_items": {"sale_id": "sale_headers", "product_id": "products"},
    "stock_balances": {"product_id": "products", "warehouse_id": "warehouses"},
    "stock_movements": {"product_id": "products", "warehouse_id": "warehouses"},
}


def row_rules(table: str, columns: list[str]) -> dict[str, Column]:
    """The rules that each row keeps or breaks by itself, as ``kind: column`` -> predicate."""
    rules = {f"not null: {c}": F.col(c).isNotNull() for c in NOT_NULL.get(table, []) if c in columns}
    for c, rule in CHECKS.get(table, {}).items():
        if c in columns:
            rules[f"check: {c}"] = F.expr(rule)
    price = LINE_PRICE.get(table)
    if price and {price, "quantity", "amount"} <= set(columns):
        rules["derived: amount"] = F.col("amount") == F.round(F.col("quantity") * F.col(price), 2)
    return rules


WHOLE = ("tinyint", "smallint", "int", "bigint")
SLOTS, BUCKETS = 1 << 8, 1 << 50  # more than the children of a table, and than the buckets of all numbers
SPARSE = 64  # keys spread wider than one in so many numbers are compared as keys, since bitmaps would be empty
SLACK = 64  # buckets that may be empty all the same


@dataclass(frozen=True)
class KeySpace:
    """The ids of a table and the foreign keys that point there.

    ``whole``: all are whole numbers; ``dense``: they lie close enough together for bitmaps.
    """

    number: int
    table: str
    children: tuple[tuple[str, str], ...]  # (table, column); the place in it, counted from one, is the slot
    whole: bool
    dense: bool

    @property
    def columns(self) -> tuple[tuple[str, str], ...]:
        """(table, column) by slot."""
        return ((self.table, "id"), *self.children)


def bucket_of(column: str) -> Column:
    return F.bitmap_bucket_number(F.col(column).cast("bigint"))


def row_violations(name: str, df: DataFrame) -> DataFrame | None:
    """``table, rule, violations`` of the row rules of one table, by one aggregate."""
    rules = row_rules(name, df.columns)
    return check_rules(name, df, rules).select("table", "rule", "violations") if rules else None


def spread(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> dict[tuple[str, str], bool]:
    """Of whole-number columns, whether their values fill the bitmaps they fall in; one aggregate per table."""
    parts = [
        tables[name].agg(*(F.count(c).alias(f"n_{c}") for c in own), *(F.approx_count_distinct(bucket_of(c)).alias(f"b_{c}") for c in own))
        .select(F.lit(name).alias("table"), F.inline(F.array(*(
            F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n"), F.col(f"b_{c}").alias("buckets")) for c in own
        ))))
        for name, own in columns.items() if own
    ]
    per_bucket = (1 << 15) // SPARSE
    return {(r["table"], r["column"]): r["buckets"] <= SLACK + r["n"] // per_bucket for r in reduce(DataFrame.unionByName, parts).collect()} if parts else {}


def key_spaces(tables: Mapping[str, DataFrame]) -> list[KeySpace]:
    """A space for every table with ids."""
    kinds = {name: dict(df.dtypes) for name, df in tables.items()}
    found = []
    for number, name in enumerate(tables):
        if "id" in kinds[name]:
            children = tuple(
                (child, column) for child, keys in FOREIGN_KEYS.items() for column, parent in keys.items()
                if parent == name and column in kinds.get(child, ())
            )
            found.append((number, name, children, all(kinds[t][c] in WHOLE for t, c in ((name, "id"), *children))))
    whole = [key for _, name, children, is_whole in found if is_whole for key in ((name, "id"), *children)]
    close = spread(tables, {name: [c for t, c in whole if t == name] for name in tables})
    return [
        KeySpace(number, name, children, is_whole, is_whole and all(close[key] for key in ((name, "id"), *children)))
        for number, name, children, is_whole in found
    ]


def entries_of(df: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """The entries of all rows, each a struct or NULL, as rows."""
    return df.select(F.explode(F.array(*entries)).alias("e")).where(F.col("e").isNotNull()).select("e.*")


def bitmap_counts(tables: Mapping[str, DataFrame], spaces: Sequence[KeySpace]) -> DataFrame | None:
    """Per space and bucket: rows with an id, different ids, and per slot the different keys of ids and child together.

    A key is one bit, so what is shuffled is a bitmap of 4 KB per task, column
    and 32,768 neighbouring ids, however many rows have them. The bitmaps of a
    bucket are then put over one another.
    """
    dense = [s for s in spaces if s.dense]
    if not dense:
        return None
    used = []
    for name, df in tables.items():
        uses = [(s.number, i, c) for s in dense for i, (table, c) in enumerate(s.columns) if table == name]
        if uses:
            used.append(entries_of(df, [
                F.when(F.col(c).isNotNull(), F.struct(
                    (bucket_of(c) + (number * SLOTS + slot) * BUCKETS).alias("place"), F.bitmap_bit_position(F.col(c).cast("bigint")).alias("bit")
                )) for number, slot, c in uses
            ]))
    # space, slot and bucket are one number, by which rows are sorted without comparing them
    maps = reduce(DataFrame.unionByName, used).groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.bitmap_construct_agg("bit").alias("bits")).select(
        F.shiftright(F.col("place") + BUCKETS // 2, BUCKETS.bit_length() - 1).alias("owner"), "place", "n", "bits"
    ).select(
        F.expr(f"owner div {SLOTS}").cast("int").alias("space"), (F.col("owner") % SLOTS).cast("int").alias("slot"),
        (F.col("place") - F.col("owner") * BUCKETS).alias("bucket"), "n", "bits",
    )
    own = F.col("slot") == 0
    shared = lambda *slots: F.bitmap_count(F.bitmap_or_agg(F.when(F.col("slot").isin(*slots), F.col("bits"))))
    return maps.groupBy("space", "bucket").agg(
        F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias("rows"), shared(0).alias("ids"),
        *(shared(0, i).alias(f"with_{i}") for i in range(1, 1 + max(len(s.children) for s in dense))),
    )


def unique_violations(tables: Mapping[str, DataFrame], rules: Sequence[tuple[str, list[str]]]) -> DataFrame:
    """``number, violations``: surplus rows of keys by the place of the rule; keys are grouped once, numbers as numbers."""
    used = []
    for name, df in tables.items():
        entries = []
        for number, (table, columns) in enumerate(rules):
            if table != name:
                continue
            kinds = [dict(df.dtypes)[c] in WHOLE for c in columns]
            whole = [F.col(c).cast("bigint") for c, k in zip(columns, kinds) if k][:2]
            texts = [F.col(c).cast("string") for c, k in zip(columns, kinds) if not k]
            parts = {
                "first": whole[0] if whole else F.lit(0).cast("bigint"), "second": whole[1] if len(whole) > 1 else F.lit(0).cast("bigint"),
                "text": texts[0] if len(texts) == 1 else F.to_json(F.array(*texts)) if texts else F.lit(""),
            }
            known = reduce(and_, (F.col(c).isNotNull() for c in columns))
            entries.append(F.when(known, F.struct(F.lit(0).alias("space"), F.lit(number).alias("rule"), *(c.alias(n) for n, c in parts.items()))))
        if entries:
            used.append(entries_of(df, entries))
    keys = reduce(DataFrame.unionByName, used).groupBy("space", "rule", "first", "second", "text").agg(F.count(F.lit(1)).alias("n"))
    return keys.where("n > 1").groupBy(F.col("rule").alias("number")).agg(F.sum(F.col("n") - 1).alias("violations"))


def orphans(tables: Mapping[str, DataFrame], spaces: Sequence[KeySpace], faulty: DataFrame | None) -> DataFrame:
    """``space, slot, violations``: rows whose key is no id.

    Keys of dense spaces are compared only in the ``faulty`` (space, bucket)
    pairs; all others hold no orphan. Keys are counted map-side, so a key that
    a third of the rows use is one row per task.
    """
    parts = []
    for s in spaces:
        for slot, (table, column) in enumerate(s.columns):
            used = tables[table].where(F.col(column).isNotNull()).select(
                F.lit(s.number).alias("space"), F.lit(slot).alias("slot"),
                (F.col(column) if s.whole else F.lit(0)).cast("bigint").alias("key"),
                (F.lit("") if s.whole else F.col(column)).cast("string").alias("text"),
            )
            if s.dense:
                here = faulty.where(F.col("space") == s.number).select("bucket")
                used = used.withColumn("bucket", bucket_of("key")).join(here, "bucket", "left_semi").drop("bucket")
            parts.append(used)
    uses = [F.count_if(F.col("slot") == i).alias(f"_{i}") for i in range(1 + max(len(s.children) for s in spaces))]
    by_key = reduce(DataFrame.unionByName, parts).groupBy("space", "key", "text").agg(*uses).where("_0 = 0")
    lost = by_key.select("space", F.inline(F.array(*(
        F.struct(F.lit(i).alias("slot"), F.col(f"_{i}").alias("n")) for i in range(1, len(uses))
    ))))
    return lost.groupBy("space", "slot").agg(F.sum("n").alias("violations"))


def constraint_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table, rule, violations`` for every rule whose columns and tables are given.

    A repeated key counts its surplus rows, a foreign key the rows that point
    to no id. A first pass tells how close whole-number keys lie. Ids and the
    keys that point to them, where they are close, become bitmaps: ids less than rows are surplus rows, and a bucket in which
    ids and keys together have more bits than the ids alone holds orphans. Only
    in such buckets keys are compared, and if there are none that pass falls
    away. Other unique keys are grouped, once for all tables. Ids that are texts
    or lie far apart are compared as keys. Runs jobs; what reaches the driver
    is a row per rule, and a row per rule that has faulty buckets.
    """
    spark, spaces = tables[next(iter(tables))].sparkSession, key_spaces(tables)
    by_row = [df for df in (row_violations(name, df) for name, df in tables.items()) if df is not None]
    report = {(child, f"foreign key: {column}"): 0 for s in spaces for child, column in s.children}
    report |= {(s.table, "unique: id"): 0 for s in spaces if s.dense and ["id"] in UNIQUE.get(s.table, [])}

    # unique ids of dense spaces, and the buckets in which some child has keys that are no ids
    bits, suspects, faulty = bitmap_counts(tables, spaces), [s for s in spaces if not s.dense and s.children], None
    if bits is not None:
        bits = durable(bits)
        more = [c for c in bits.columns if c.startswith("with_")]
        seen = bits.groupBy("space").agg(
            F.sum(F.col("rows") - F.col("ids")).alias("surplus"), F.count_if(F.greatest(F.lit(0), *(F.col(c) - F.col("ids") for c in more)) > 0 if more else F.lit(False)).alias("faulty")
        )
        for r in seen.collect():  # a row per table
            space = next(s for s in spaces if s.number == r["space"])
            if (space.table, "unique: id") in report:
                report[space.table, "unique: id"] = r["surplus"]
            if r["faulty"]:
                suspects.append(space)
        faulty = bits.where(reduce(or_, (F.col(c) > F.col("ids") for c in more), F.lit(False))).select("space", "bucket")

    dense = {s.table for s in spaces if s.dense}
    unique = [
        (name, columns) for name, df in tables.items() for columns in UNIQUE.get(name, [])
        if set(columns) <= set(df.columns) and not (columns == ["id"] and name in dense)
    ]
    named = []  # (table, rule) by number, of the rules that are counted in the returned plan
    counted = []
    if unique:
        counted.append(unique_violations(tables, unique))
        named += [(name, f"unique: {', '.join(columns)}") for name, columns in unique]
    if suspects:
        place = {(s.number, slot): (child, f"foreign key: {column}") for s in suspects for slot, (child, column) in enumerate(s.children, 1)}
        number = F.coalesce(*(
            F.when((F.col("space") == space) & (F.col("slot") == slot), F.lit(len(named) + i)) for i, (space, slot) in enumerate(place)
        ))
        counted.append(orphans(tables, suspects, faulty).select(number.alias("number"), "violations"))
        named += place.values()
    rules = list(dict.fromkeys([*report, *named]))
    base = spark.createDataFrame(
        [(t, r, named.index((t, r)) if (t, r) in named else -1, report.get((t, r), 0)) for t, r in rules],
        "table string, rule string, number int, known long",
    )
    if counted:
        totals = reduce(DataFrame.unionByName, counted)  # a row per rule at most
        base = base.join(F.broadcast(totals), "number", "left").withColumn("known", F.coalesce("violations", "known"))
    return reduce(DataFrame.unionByName, [*by_row, base.select("table", "rule", F.col("known").alias("violations"))])
