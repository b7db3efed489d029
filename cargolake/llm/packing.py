"""Best-fit packing of token sequences: a configuration linear program over the length histogram.

A configuration is a multiset of lengths that fits one sequence. The program
asks for the smallest total of configurations that covers the histogram. It is
solved by multiplicative weights: a price per length, the best configuration at
these prices by a knapsack dynamic program, and lower prices for the lengths it
covers. The fractional solution is rounded down, and the rest is filled by
whole configurations of the same knapsack, each used as often as it fits.

Only the histogram (at most ``capacity`` numbers) and the configurations (at
most ``rounds`` plus two per length) reach the driver, whatever the number of
documents. A piece finds its place from its rank among the pieces of its
length, counted per task and added up, so no length is gathered in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from cargolake.llm.base import written
from cargolake.llm.byte_bpe import encoder

TEXTS_AT_ONCE = 1000  # documents whose pieces leave a task together
CACHE_PIECES = 100_000  # a pipeline's idle workers keep their caches
PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def knapsack(price: np.ndarray, capacity: int) -> np.ndarray:
    """Counts per length of the most valuable configuration; ``price[i]`` is the value of length ``i + 1``."""
    best = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, np.int64)
    sold = np.flatnonzero(price > 0)
    lengths, values = sold + 1, price[sold]
    until = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if until[room]:
            value = best[room - lengths[: until[room]]] + values[: until[room]]
            top = int(value.argmax())
            if value[top] > best[room]:
                best[room], choice[room] = value[top], lengths[top]
    counts, room = np.zeros(capacity, np.int64), capacity
    while room > 0:
        if choice[room]:
            counts[choice[room] - 1] += 1
            room -= choice[room]
        else:
            room -= 1
    return counts


def fractional(demand: np.ndarray, capacity: int, rounds: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Configurations and how often each is used in an approximate solution of the linear program."""
    lengths = np.arange(1, capacity + 1)
    need = demand.astype(float)
    wanted = need > 0
    covered, weight = np.zeros(capacity), lengths / capacity
    configurations, amounts = [], []
    for _ in range(rounds):
        price = np.where(wanted, weight, 0.0)
        counts = knapsack(price, capacity)
        held = counts > 0
        if not held.any():
            break
        # a step covers at most a tenth of the demand of any length
        step = max(1.0, 0.1 * float((need[held] / counts[held]).min()))
        covered[held] += step * counts[held]
        configurations.append(counts)
        amounts.append(step)
        weight = np.where(wanted, lengths / capacity * np.exp(-covered / np.maximum(need, 1.0)), 0.0)
    # scaled so that no length is covered beyond its demand
    used = np.array(amounts)
    if len(used):
        used = used / max(1.0, float((covered[wanted] / need[wanted]).max()))
    return configurations, used


def solve(demand: np.ndarray, capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """Whole configurations (counts per length, times used) that hold every piece exactly once."""
    left = demand.astype(np.int64).copy()
    out = []
    full = int(left[capacity - 1])
    if full:  # a piece that fills a sequence has one configuration
        counts = np.zeros(capacity, np.int64)
        counts[capacity - 1] = 1
        out.append((counts, full))
        left[capacity - 1] = 0

    def use(counts: np.ndarray, times: int) -> None:
        nonlocal left
        held = counts > 0
        times = min(times, int((left[held] // counts[held]).min()))
        if times > 0:
            left = left - times * counts
            out.append((counts, times))

    configurations, used = fractional(left, capacity, rounds)
    for i in np.argsort(-used, kind="stable"):
        use(configurations[i], int(used[i]))
    lengths = np.arange(1, capacity + 1)
    while left.any():
        # long and plentiful lengths cost more, so that they go first
        price = np.where(left > 0, lengths * (1.0 + 0.02 * lengths / capacity), 0.0)
        counts = knapsack(price, capacity)
        held = counts > 0
        if (left[held] < counts[held]).any():  # more copies than there are: the longest that fit, one after another
            counts, room = np.zeros(capacity, np.int64), capacity
            for i in np.flatnonzero(left)[::-1]:
                take = min(int(left[i]), room // (i + 1))
                counts[i] = take
                room -= take * (i + 1)
        use(counts, int(left.sum()))
    return out


def layout(configurations: list[tuple[np.ndarray, int]]) -> pd.DataFrame:
    """For each length, from which rank on its pieces go to which sequences and places.

    A row says: the pieces of ``length`` with ranks from ``first`` on lie
    ``copies`` to a sequence, in sequences from ``sequence`` on, from place
    ``place`` on.
    """
    rows, seen, sequence = [], {}, 0
    for counts, times in configurations:
        place = 0
        for i in np.flatnonzero(counts)[::-1]:
            length, copies = int(i) + 1, int(counts[i])
            rows.append((length, seen.get(length, 0), copies, sequence, place))
            seen[length] = seen.get(length, 0) + copies * times
            place += copies * length
        sequence += times
    return pd.DataFrame(rows, columns=["length", "first", "copies", "sequence", "place"])


def tokenised(
    docs: DataFrame, capacity: int, end_id: int, tokenizer_path: str | None = None, with_ids: bool = False
) -> DataFrame:
    """The pieces of every document: at most ``capacity`` ids, a shorter one comes first.

    ``task`` and ``task_rank`` number the pieces of each length within a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = encoder(tokenizer_path, CACHE_PIECES).encode, TaskContext.get().partitionId(), {}
        some = (batch.slice(i, TEXTS_AT_ONCE) for batch in batches for i in range(0, batch.num_rows, TEXTS_AT_ONCE))
        for batch in some:
            rows, flat = [], []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist())):
                ids = np.append(ids, np.uint16(end_id)).astype("<u4")
                start = 0
                for piece, stop in enumerate(list(range(len(ids), 0, -capacity))[::-1]):
                    length = stop - start
                    rank = seen.get(length, 0)
                    seen[length] = rank + 1
                    rows.append((doc_id, piece, start, length, zlib.crc32(ids[start:stop]), task, rank))
                    start = stop
                flat.append(ids)
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum([r[3] for r in rows])]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*flat, []]).astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "task_rank"] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    schema = PIECE_SCHEMA + ", task int, task_rank bigint" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def best_fit_pack(
    docs: DataFrame,
    capacity: int = 1024,
    end_id: int = 2,
    tokenizer_path: str | None = None,
    rounds: int = 400,
    with_ids: bool = False,
) -> DataFrame:
    """Pack all documents into few sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start (the document's ids before it),
    length, ids_crc32, sequence_id, offset, and with ``with_ids`` the ids. Null
    and empty texts are the end id alone; repeated rows are packed as often as
    they come; no documents give no rows; other columns of ``docs`` are not
    read.
    """
    pieces = written(tokenised(docs, capacity, end_id, tokenizer_path, with_ids))
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    histogram = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most ``capacity`` rows
    demand = np.zeros(capacity, np.int64)
    for row in histogram:
        demand[row["length"] - 1] = row["n"]
    table = layout(solve(demand, capacity, rounds))
    by_length = {k: g.sort_values("first").to_numpy(np.int64) for k, g in table.groupby("length")}

    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = pieces.join(per_task.select("length", "task", before.alias("before")), ["length", "task"]).withColumn(
        "rank", F.col("before") + F.col("task_rank")
    )

    @F.pandas_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        lengths, ranks = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        for size in np.unique(lengths):
            at = np.flatnonzero(lengths == size)
            rows = by_length[int(size)]
            rows = rows[np.searchsorted(rows[:, 1], ranks[at], side="right") - 1]
            nth = ranks[at] - rows[:, 1]
            sequence[at] = rows[:, 3] + nth // rows[:, 2]
            offset[at] = rows[:, 4] + nth % rows[:, 2] * size
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = ranked.withColumn("at", place("length", "rank"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset"] + ["ids"] * with_ids
    return placed.select(*columns)
