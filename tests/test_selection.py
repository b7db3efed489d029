"""Selection by narrowing cells: many rounds, odd values, and plans that move nothing."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import Window, functions as F

from cargolake.operators import ordered
from cargolake.operators.ordered import global_ntiles, median_value, select_positions, sort_columns, value_positions


@pytest.fixture
def small_samples(monkeypatch):
    """Cells are cut many times before they are fetched."""
    monkeypatch.setattr(ordered, "SAMPLE", 16)


def values(kind, n):
    rng = random.Random(n)
    return {
        "spread": lambda: [rng.random() * 10 ** rng.randint(-5, 9) for _ in range(n)],
        "hot": lambda: [7.0 if rng.random() < 0.4 else rng.gauss(0, 1) for _ in range(n)],
        "equal": lambda: [1.5] * n,
        "odd": lambda: [rng.choice([None, math.nan, math.inf, -math.inf, 0.0, -0.0, rng.random()]) for _ in range(n)],
        "nulls": lambda: [None] * n,
    }[kind]()


def order_of(row):
    value, key = row
    return (2, 0, key) if value is None else (1, 0, key) if math.isnan(value) else (0, value, key)


@pytest.mark.parametrize("kind", ["spread", "hot", "equal", "odd", "nulls"])
def test_selected_rows_are_those_at_the_positions(spark, small_samples, kind):
    rows = [(v, f"key{i:05d}") for i, v in enumerate(values(kind, 900))]
    df = spark.createDataFrame(rows, "x double, id string").repartition(5)
    wanted = [1, 2, 225, 450, 451, 899, 900]
    found = select_positions(df, [F.col("x")], ["id"], [wanted], 900)[0]
    in_order = sorted(rows, key=order_of)
    for p in wanted:
        behind = {r[0] for r in df.where(found[p]).select("id").collect()}
        assert behind == {key for _, key in in_order[p:]}


def test_quartiles_of_large_and_decimal_values_after_many_rounds(spark, small_samples):
    df = spark.range(3000).repartition(4).select(
        "id", (F.col("id") * 7919 % 101).alias("a"), (F.col("id") * 31 % 17).cast("decimal(12,2)").alias("b"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("c"),
    )
    measures = {"ta": ("a", True), "tb": ("b", False), "tc": ("c", False)}
    tiles = global_ntiles(df, 4, measures, ["id"], 3000)
    both = df.select("*", *(t.alias(n) for n, t in tiles.items()), *(
        F.ntile(4).over(Window.orderBy(*sort_columns([(c, up), ("id", True)]))).alias(f"w{n}") for n, (c, up) in measures.items()
    ))
    assert both.where("ta <> wta OR tb <> wtb OR tc <> wtc").isEmpty()


@pytest.mark.parametrize("n", [1, 2, 500, 501])
def test_median_is_selected(spark, small_samples, n):
    df = spark.range(n).select("id", F.when(F.col("id") % 7 != 3, F.col("id") * 37 % 41).cast("double").alias("x"))
    assert median_value(df, "x", ["id"]) == df.agg(F.median("x")).first()[0]
    assert median_value(df.where("x IS NULL"), "x", ["id"]) is None


@pytest.mark.parametrize("kind", ["spread", "hot", "equal", "odd", "nulls"])
def test_positions_in_many_buckets(spark, monkeypatch, kind):
    monkeypatch.setattr(ordered, "SAMPLE", 64)
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        own = [0.0 if v == 0 else v for v in values(kind, 700) if kind != "odd" or v is None or not math.isnan(v)]
        df = spark.createDataFrame([(v,) for v in own], "x double")
        found = {r["x"]: (r["_n"], r["_before"]) for r in value_positions(df, "x").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    known = sorted(v for v in own if v is not None)
    want = {v: (known.count(v), known.index(v)) for v in set(known)} | ({None: (len(own) - len(known), len(known))} if None in own else {})
    assert found == want


def test_no_row_is_moved_for_quartiles(spark):
    df = spark.range(100).select("id", (F.col("id") % 13).alias("x"))
    tile = global_ntiles(df, 4, {"t": ("x", True)}, ["id"], 100)["t"]
    assert "Exchange" not in df.select(tile)._jdf.queryExecution().executedPlan().toString()


def test_rounds_read_samples_and_counts_only(spark, monkeypatch):
    """Of 40,000 rows, some samples and one small cell per position reach the driver."""
    monkeypatch.setattr(ordered, "SAMPLE", 256)
    fetched = []
    real = ordered._split_at
    monkeypatch.setattr(ordered, "_split_at", lambda cell, drawn: fetched.append((cell.rows, drawn)) or real(cell, drawn))
    df = spark.range(40_000).select("id", (F.col("id") * 7919 % 10007).alias("x"))
    global_ntiles(df, 4, {"t": ("x", True)}, ["id"], 40_000)
    assert max(drawn for _, drawn in fetched) < 2 * 256
    assert sorted({rows for rows, _ in fetched}, reverse=True)[0] == 40_000 and len(fetched) <= 1 + 3 * 4
