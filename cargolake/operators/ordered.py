"""Whole-table ntile, rank and median without a one-task window and without a range shuffle.

A window without PARTITION BY moves every row to one task, and a range
partitioning moves every row once. An ntile and a median need the order only at
a few positions, so the rows there are selected and nothing is moved: the table
is cut into cells by rows of a sample, a map-side count per cell tells which
cells hold the positions, and these are cut again, until a cell has few rows,
which are fetched. A round leaves about a thirtieth of a cell. The order is
total (value, then keys that together are unique), so a value that a third of
the rows share is cut like any other.

A rank needs the number of smaller rows for every value. Values are counted
first, so equal ones are one row, and the counted values are dealt to buckets
between splitters of a sample, which is a plain shuffle of few rows.

These helpers run jobs. What reaches the driver is samples and cells of
``SAMPLE`` rows, whatever the table holds.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType

from cargolake.config import durable

Order = Sequence[tuple[str, bool]]  # (column, ascending); NULLs sort last
SAMPLE = 1 << 14  # rows of a sample; a cell of as many is fetched
BUCKETS = 256  # buckets of counted values at most


def sort_columns(order: Order) -> list[Column]:
    return [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in order]


@dataclass(frozen=True)
class _Line:
    """A row of the total order, and that row as a literal to compare with."""

    row: dict
    literal: Column


class _Ordered:
    """One value of a table with the keys that break its ties, as a column that sorts like the rows (NULL last)."""

    def __init__(self, value: Column, keys: Sequence[str], types: Sequence[DataType]) -> None:
        self.value, self.types = value, types
        self.place = F.struct(value.isNull(), value, *map(F.col, keys))

    def line(self, row: dict) -> _Line:
        parts = [F.lit(v).cast(t) for v, t in zip((row[c] for c in row if c != "_cell"), self.types)]
        return _Line(row, F.struct(F.lit(row["_value"] is None), *parts))

    def after(self, line: _Line) -> Column:
        return self.place > line.literal


@dataclass
class _Cell:
    """Rows of a value behind ``low`` and up to ``high``, and the wanted positions among them."""

    number: int  # of the value
    positions: list[int]
    before: int  # rows of the table up to ``low``
    rows: int
    low: _Line | None = None
    high: _Line | None = None

    def holds(self, order: _Ordered) -> Column:
        inside = F.lit(True) if self.low is None else order.after(self.low)
        return inside if self.high is None else inside & ~order.after(self.high)

    def cut(self, splitters: Sequence[_Line], upto: Sequence[int]) -> list[_Cell]:
        """The parts that hold positions; ``upto`` counts the rows of the cell up to each splitter."""
        ends = [(self.low, 0), *zip(splitters, upto), (self.high, self.rows)]
        parts = []
        for (low, a), (high, b) in zip(ends, ends[1:]):
            held = [p for p in self.positions if self.before + a < p <= self.before + b]
            if held:
                parts.append(_Cell(self.number, held, self.before + a, b - a, low, high))
        return parts


def _split_at(cell: _Cell, drawn: int) -> list[int]:
    """For each position two places of a sorted sample of ``drawn`` rows between which it almost surely lies."""
    wide, found = 2 * math.sqrt(drawn), set()
    for p in cell.positions:
        at = (p - cell.before) / cell.rows * drawn
        found |= {max(0, math.floor(at - wide)), min(drawn - 1, math.ceil(at + wide))}
    return sorted(found) if drawn else []


def select_positions(
    df: DataFrame, values: Sequence[Column], keys: Sequence[str], positions: Sequence[Sequence[int]], rows: int
) -> list[dict[int, Column]]:
    """For each value the rows at its 1-based positions in ascending order, NULLs last, by position.

    A row is given as the condition that a row of ``df`` sorts behind it.
    ``rows`` is the row count of ``df``. Every round runs two jobs for all
    values together: a sample of each cell, and one aggregate of counts.
    """
    found = _selected(df, values, keys, positions, rows)
    return [{p: order.after(line) for p, line in own.items()} for order, own in found]


def _selected(
    df: DataFrame, values: Sequence[Column], keys: Sequence[str], positions: Sequence[Sequence[int]], rows: int
) -> list[tuple[_Ordered, dict[int, _Line]]]:
    named = [*(v.alias(f"_value{i}") for i, v in enumerate(values)), *(F.col(c).alias(f"_key{i}") for i, c in enumerate(keys))]
    types = [f.dataType for f in df.select(*named).schema]
    orders = [_Ordered(v, keys, [types[i], *types[len(values) :]]) for i, v in enumerate(values)]
    row = named[len(values) :]
    cells = [_Cell(i, sorted(set(own)), 0, rows) for i, own in enumerate(positions) if own]
    done: list[_Cell] = []

    def fetched(entries: Sequence[tuple[_Cell, Column]]) -> list[pa.Table]:
        """The sorted rows for which each entry holds."""
        structs = [
            F.when(kept, F.struct(F.lit(j).alias("_cell"), values[c.number].alias("_value"), *row)) for j, (c, kept) in enumerate(entries)
        ]
        got = df.select(F.explode(F.array(*structs)).alias("e")).where(F.col("e").isNotNull()).select("e.*").toArrow()
        got = got.sort_by([(name, "ascending") for name in got.column_names])  # NaN and then NULL come last
        ends = np.searchsorted(got["_cell"].to_numpy(), np.arange(len(entries) + 1))
        return [got.slice(a, b - a) for a, b in zip(ends, ends[1:])]

    def lines(cell: _Cell, table: pa.Table, places: Sequence[int]) -> list[_Line]:
        return [orders[cell.number].line(r) for r in table.take(places).to_pylist()] if places else []

    seed = 0
    while cells:
        done += [c for c in cells if c.rows <= SAMPLE]
        cells = [c for c in cells if c.rows > SAMPLE]
        if not cells:
            break
        drawn = lambda c: F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(-(-c.rows // SAMPLE))) == 0  # noqa: B023, E731
        inside = [c.holds(orders[c.number]) for c in cells]
        samples = fetched([(c, held & drawn(c)) for c, held in zip(cells, inside)])
        chosen = [lines(c, sample, _split_at(c, len(sample))) for c, sample in zip(cells, samples)]
        counts = [
            F.count_if(held & ~orders[c.number].after(s)).alias(f"_{i}_{j}")
            for i, (c, held, own) in enumerate(zip(cells, inside, chosen)) for j, s in enumerate(own)
        ]
        upto = df.agg(*counts).first() if counts else None
        cells = [part for i, (c, own) in enumerate(zip(cells, chosen)) for part in c.cut(own, [upto[f"_{i}_{j}"] for j in range(len(own))])]
        seed += 1
    found: list[dict[int, _Line]] = [{} for _ in values]
    if done:
        for c, table in zip(done, fetched([(c, c.holds(orders[c.number])) for c in done])):
            found[c.number] |= dict(zip(c.positions, lines(c, table, [p - c.before - 1 for p in c.positions])))
    return list(zip(orders, found))


def tile_ends(n: int, k: int) -> list[int]:
    """The last 1-based position of tiles 1 .. k-1; the first n mod k tiles hold one row more."""
    q, r = divmod(n, k)
    return [b * q + min(b, r) for b in range(1, k)]


def global_ntiles(df: DataFrame, k: int, measures: Mapping[str, tuple[str, bool]], keys: Sequence[str], rows: int) -> dict[str, Column]:
    """``ntile(k)`` over the whole table for several measures, as columns for ``df``.

    ``measures`` names for each result its column and whether it ascends; NULLs
    sort last and ties go by ``keys``, which together must be unique and not NULL. ``rows`` is the row
    count of ``df``. Only the k-1 rows that close a tile of a measure are
    selected; every row is then placed by comparing it with them.
    """
    ends = sorted({p for p in tile_ends(rows, k) if p > 0})
    if not ends:
        return {name: F.lit(1) for name in measures}
    kinds = dict(df.dtypes)
    # a falling measure has its sign changed, so that one order serves all
    as_number = lambda c: F.col(c).cast("decimal(38,6)" if kinds[c].startswith("decimal") else "double")
    values = [as_number(c) * (1 if up else -1) for c, up in measures.values()]
    found = select_positions(df, values, keys, [ends] * len(values), rows)
    return {
        name: reduce(add, (F.when(behind, 1).otherwise(0) for behind in own.values()), F.lit(1))
        for name, own in zip(measures, found)
    }


def global_ntile(df: DataFrame, k: int, column: str, ascending: bool, keys: Sequence[str], rows: int) -> Column:
    """``ntile(k)`` over the whole table by one measure."""
    return global_ntiles(df, k, {"tile": (column, ascending)}, keys, rows)["tile"]


def _bucket(value: Column, splitters: Sequence[object], first: int = 0) -> Column:
    """The number of splitters below the value, by halving; ``first`` more. NULL is behind all."""
    if not splitters:
        return F.lit(first)
    middle = len(splitters) // 2
    return F.when(value <= F.lit(splitters[middle]), _bucket(value, splitters[:middle], first)).otherwise(
        _bucket(value, splitters[middle + 1 :], first + middle + 1)
    )


def value_positions(df: DataFrame, column: str) -> DataFrame:
    """Per distinct value: ``_n`` rows hold it and ``_before`` rows are smaller (NULLs last).

    Equal values collapse map-side, so a hot value is one row here.
    """
    counts = durable(df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")))
    buckets = min(BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    drawn = F.pmod(F.xxhash64(column), F.lit(-(-max(1, counts.count()) // SAMPLE))) == 0
    known = F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))
    sample = sorted(r[0] for r in counts.where(drawn & known).select(column).collect())
    splitters = sorted({sample[len(sample) * i // buckets] for i in range(1, buckets)}) if sample else []
    placed = counts.withColumn("_bucket", _bucket(F.col(column), splitters))
    sizes = {r["_bucket"]: r["_size"] for r in placed.groupBy("_bucket").agg(F.sum("_n").alias("_size")).collect()}
    ahead = [sum(n for b, n in sizes.items() if b < i) for i in range(len(splitters) + 1)]
    within = Window.partitionBy("_bucket").orderBy(*sort_columns([(column, True)])).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.get(F.array(*(F.lit(n).cast("bigint") for n in ahead)), F.col("_bucket"))
    return placed.withColumn("_before", offset + F.coalesce(F.sum("_n").over(within), F.lit(0))).select(column, "_n", "_before")


def global_rank(df: DataFrame, column: str, positions: DataFrame, out: str) -> DataFrame:
    """``rank()`` by ``column`` ascending: one more than the number of smaller rows."""
    ranks = positions.select(F.col(column).alias("_value"), (F.col("_before") + 1).alias(out))
    return df.join(ranks, df[column].eqNullSafe(ranks["_value"]), "left").drop("_value")


def median_value(df: DataFrame, column: str, keys: Sequence[str]) -> float | None:
    """The median of the non-NULL values: the mean of the middle one or two, which are selected.

    ``keys`` together must be unique and not NULL.
    """
    n = df.agg(F.count(column)).first()[0]
    if not n:
        return None
    rows = df.where(F.col(column).isNotNull())
    middle = sorted({(n + 1) // 2, n // 2 + 1})
    found = _selected(rows, [F.col(column)], keys, [middle], n)[0][1]
    return sum(float(found[p].row["_value"]) for p in middle) / len(middle)


def global_median(column: str, positions: DataFrame) -> Column:
    """The median of the non-NULL values as a literal: the mean of the middle one or two."""
    known = positions.where(F.col(column).isNotNull())
    n = known.agg(F.sum("_n")).first()[0]
    if not n:
        return F.lit(None).cast("double")
    middle = sorted({(n + 1) // 2, n // 2 + 1})
    hit = [(F.col("_before") < p) & (F.lit(p) <= F.col("_before") + F.col("_n")) for p in middle]
    found = known.where(reduce(or_, hit)).select(F.col(column).cast("double")).collect()
    return F.lit(sum(row[0] for row in found) / len(found))
