"""Repair of the structure of conversations, with an audit of the edits.

A sound conversation is an optional system turn and then user and assistant
turns in alternation, ending with an assistant. Turns that are blank or repeat
an earlier one must go. The repair is the cheapest sequence of edits (Keep 0,
Rerole 2, Delete 3, Insert 2; a truncated turn that stays costs 1), and of
equally cheap ones that whose letters are least; ``audit_path`` finds it.

Turns are shuffled once, by ranges of (conversation, turn, role, text), so no
conversation need fit a task: a range is read as a sorted stream and cut into
parts of bounded size. A conversation that lies within a range and a part is
repaired on the spot. Of any other, every part is turned into the best edits
between each two states of the grammar, without its neighbours; parts are then
joined ``FAN`` at a time in rounds, which choose states alone, and the choice
goes back down to the parts. Edits of a part end with the edit of a turn, and
all of them edit the same turns, so none is the beginning of another: sequences
are compared by the ranks of their parts, and texts are not moved again.

Turns come in order of ``turn``, nulls first, and equal ones by role and text.
A null conversation id is a conversation of its own, null role and text are one
space. Repeated rows are turns of their own (and so duplicates). A conversation
all of whose turns were dropped has no edits. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cargolake.llm.audit_path import Best, Paths, ranked
from cargolake.llm.base import BLANKS, written

# The letters of edits, in their order, and what they cost.
LETTERS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 3, 2, 2, 1
# Adjacent initials of roles in a sound conversation.
LEGAL = {"su", "ua", "au"}

BEGIN, SYSTEM, USER, ASSISTANT = range(4)  # states: nothing yet, or the last turn's role
AFTER = {(BEGIN, "s"): SYSTEM, (BEGIN, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
NEXT = {BEGIN: "u", SYSTEM: "u", ASSISTANT: "u", USER: "a"}  # the initial that an insertion or new role must have
ROLE = {"u": "user", "a": "assistant"}
MISSING = {BEGIN: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}  # insertions that end a conversation

PART_ROWS = 1024
PART_CHARS = 1 << 22
FAN = 64  # parts joined at a time
PLACES = 1 << 13  # more than the turns of a part


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with faults put in by a hash of conversation and turn; ``times`` is how often a row stands."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    return rows.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(text_of("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )


def marked(turns: list[tuple[str, str]], firsts: set[int] | None = None) -> tuple[str, dict[str, int]]:
    """A letter for each turn (x: must go; the initial, a capital if truncated; o: no role) and the counts of faults.

    ``firsts`` are the places of turns that no earlier one equals, if the turns are not the whole conversation.
    """
    letters, seen, counts = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
    for i, turn in enumerate(turns):
        body = turn[1].rstrip(BLANKS)
        again = turn in seen if firsts is None else i not in firsts
        seen.add(turn)
        if not body or again:
            counts["duplicate" if body else "blank"] += 1
            letters.append("x")
            continue
        initial = turn[0][:1] if turn[0][:1] in ("s", "u", "a") else "o"
        if body[-1] not in ".!?":
            counts["truncated"] += 1
            initial = initial.upper()
        letters.append(initial)
    counts["illegal"] = sum(a[0][:1] + b[0][:1] not in LEGAL for a, b in zip(turns, turns[1:]))
    return "".join(letters), counts


def best_edits(letters: str, start: int, paths: Paths) -> dict[int, tuple[int, int]]:
    """For every state that edits of all turns can end in, from ``start``: the least cost and the least such edits."""
    at = {start: (0, 0)}
    for letter in letters:
        best = Best(paths)
        initial, late = letter.lower(), TRUNCATED_COST * letter.isupper()
        for state, (cost, node) in at.items():
            inserted: tuple[int, ...] = ()
            for _ in range(3):  # three insertions would come back to a state
                best.offer(state, cost + DELETE_COST, node, *inserted, DELETE)
                if letter != "x":
                    kept = AFTER.get((state, initial))
                    if kept is not None:
                        best.offer(kept, cost + late, node, *inserted, KEEP)
                    best.offer(AFTER[state, NEXT[state]], cost + REROLE_COST + late, node, *inserted, REROLE)
                state, cost, inserted = AFTER[state, NEXT[state]], cost + INSERT_COST, (*inserted, INSERT)
        at = best.at
    return at


def spelled(paths: Paths, node: int) -> str:
    return "".join(LETTERS[s] for s in paths.symbols(node))


@lru_cache(maxsize=1 << 16)
def whole_edits(letters: str) -> tuple[int, str]:
    """Cost and letters of the edits of a whole conversation; most are short, and their letters recur."""
    paths, best = Paths(), None
    for state, (cost, node) in best_edits(letters, BEGIN, paths).items():
        found = (cost + INSERT_COST * MISSING[state], paths.extended(node, *[INSERT] * MISSING[state]))
        if best is None or found[0] < best[0] or found[0] == best[0] and paths.compared(found[1], best[1]) < 0:
            best = found
    return best[0], spelled(paths, best[1])


def applied(turns: list[tuple[str, str]], edits: str, state: int = BEGIN) -> list[tuple[str, str]]:
    """The turns that the edits leave and insert, from a state on."""
    out, rest = [], iter(turns)
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(rest)
        if edit == "D":
            continue
        initial = role[:1] if edit == "K" else NEXT[state]
        out.append((role if edit == "K" else ROLE[initial], text))
        state = AFTER[state, initial]
    return out


# --- parts of conversations ---

TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")
TURN_FACTS = ("first_turn", "last_turn", "n_turns")


def _struct(turns: list[tuple[str, str]]) -> list[dict[str, str]]:
    return [{"role": r, "text": t} for r, t in turns]


def _part(key: object, pid: int, no: int, rows: list[tuple], whole: bool) -> dict:
    """A row of the table of parts: the result of a whole conversation, else the turns as they are."""
    turns = [(role, text) for _, role, text in rows]
    known = [t for t, _, _ in rows if t is not None]
    out = {
        "conv_id": key, "pid": pid, "no": no, "whole": whole, "first_turn": known[0] if known else None,
        "last_turn": known[-1] if known else None, "n_turns": sum(a != b for a, b in zip(known, [None, *known])),
        "first_initial": turns[0][0][:1] if turns else None, "last_initial": turns[-1][0][:1] if turns else None,
    }
    if not whole:
        return out | {"turns": _struct(turns)}
    letters, counts = marked(turns)
    cost, audit = whole_edits(letters)
    return out | counts | {"cost": cost, "audit": audit, "turns": _struct(applied(turns, audit))}


def _cut(batches: Iterator[pa.RecordBatch], schema: pa.Schema, part_rows: int) -> Iterator[pa.RecordBatch]:
    """Parts of the conversations of a range, which comes in order.

    The first and the last conversation of a range may go on in its neighbours, so they are not whole.
    """
    out: list[dict] = []
    size = 0
    key, rows, chars, no, inside, pid = None, [], 0, 0, False, None

    def ready() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pylist(out, schema=schema)
        out.clear()
        return batch

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "pid", "turn", "role", "text", "times"))
        for conv_id, at, turn, role, text, times in zip(*columns):
            if pid is None:
                key, pid = conv_id, at
            if conv_id != key:
                out.append(_part(key, pid, no, rows, whole=inside and no == 0))
                size += chars
                key, rows, chars, no, inside = conv_id, [], 0, 0, True
            elif len(rows) >= part_rows or chars >= PART_CHARS:
                out.append(_part(key, pid, no, rows, whole=False))
                size += chars
                rows, chars, no = [], 0, no + 1
            rows += [(turn, role, text)] * times
            chars += len(text) * times
            if size >= PART_CHARS or len(out) >= 2048:
                size = 0
                yield ready()
    if pid is not None:
        out.append(_part(key, pid, no, rows, whole=False))
    yield ready()


MOVES = pa.list_(pa.struct([("src", pa.int32()), ("dst", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()), ("edits", pa.string())]))


def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every part with its faults and its best edits between each two states."""
    for batch in batches:
        counted, moves = [], []
        for turns, firsts in zip(batch.column("turns").to_pylist(), batch.column("firsts").to_pylist()):
            letters, counts = marked([(t["role"], t["text"]) for t in turns], set(firsts or ()))
            paths, found = Paths(), []
            for start in (BEGIN, SYSTEM, USER, ASSISTANT):
                found += [(start, end, *x) for end, x in best_edits(letters, start, paths).items()]
            ranks = ranked(paths, [f[3] for f in found])
            counted.append(counts)
            moves.append([
                {"src": s, "dst": e, "cost": c, "rank": r, "edits": spelled(paths, n)} for (s, e, c, n), r in zip(found, ranks)
            ])
        yield pa.RecordBatch.from_arrays([
            batch.column("conv"), batch.column("k"), pa.array(moves, MOVES),
            *(pa.array([c[x] for c in counted], pa.int64()) for x in COUNTS[:4]),
        ], ["conv", "k", "moves", *COUNTS[:4]])


def _joined(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """The best choices of moves of up to ``FAN`` neighbouring parts between each two states."""
    parts = [
        [(int(m["src"]), int(m["dst"]), int(m["cost"]), int(m["rank"])) for m in moves]
        for moves in group.sort_values("k")["moves"]
    ]
    paths, found = Paths(), []
    for start in (BEGIN, SYSTEM, USER, ASSISTANT):
        at = {start: (0, 0)}
        for moves in parts:
            best = Best(paths)
            for s, e, cost, rank in moves:
                if s in at:
                    best.offer(e, at[s][0] + cost, at[s][1], rank)
            at = best.at
        found += [(start, end, *x) for end, x in at.items()]
    ranks, out = ranked(paths, [f[3] for f in found]), []
    for (start, end, cost, node), rank in zip(found, ranks):
        states = [start]
        for moves, symbol in zip(parts, paths.symbols(node)):  # a state and the edits from it lead to one state
            states.append(next(e for s, e, _, r in moves if s == states[-1] and r == symbol))
        out.append({"src": start, "dst": end, "cost": cost, "rank": rank, "states": states})
    return pd.DataFrame({"conv": [key[0]], "k": [int(key[1])], "moves": [out]})


def _chosen(moves: str, field: str) -> Column:
    """The field of the move from ``src`` to ``dst``."""
    return F.expr(f"filter({moves}, m -> m.src = src AND m.dst = dst)[0].{field}")


def repair(rows: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """The repaired conversations, in parts.

    ``rows`` has ``conv_id``, ``turn``, ``role``, ``text`` and may have
    ``times`` (how often a row stands). Of the result, ``part`` numbers the
    ``n_parts`` parts of a conversation; each has the ``audit`` of its turns'
    edits and their ``cost``, the counts of faults, the repaired ``turns``, and
    what joins parts: the first and last turn number, the number of different
    ones, and the initials of the first and last role before the repair.
    """
    if part_rows >= PLACES - 1:
        raise ValueError(f"part_rows must be below {PLACES - 1}")
    id_type = rows.schema["conv_id"].dataType.simpleString()
    times = F.col("times") if "times" in rows.columns else F.lit(1)
    order = ["conv_id", "turn", "role", "text"]
    stream = (
        rows.select(
            "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
            F.when(times == 0, "").otherwise(F.coalesce("text", F.lit(" "))).alias("text"), times.cast("int").alias("times"),
        )
        .repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id())
    )
    sql = f"conv_id {id_type}, pid int, no int, whole boolean, " + ", ".join(f"{c} long" for c in (*TURN_FACTS, *COUNTS)) + (
        ", first_initial string, last_initial string, audit string, turns array<struct<role: string, text: string>>"
    )
    id_arrow = {"string": pa.string(), "int": pa.int32()}.get(id_type, pa.int64())
    schema = pa.schema([
        ("conv_id", id_arrow), ("pid", pa.int32()), ("no", pa.int32()), ("whole", pa.bool_()),
        *((c, pa.int64()) for c in (*TURN_FACTS, *COUNTS)),
        ("first_initial", pa.string()), ("last_initial", pa.string()), ("audit", pa.string()), ("turns", TURNS),
    ])
    parts = written(stream.mapInArrow(lambda batches: _cut(batches, schema, part_rows), sql))
    columns = ["conv_id", "part", "n_parts", "audit", *COUNTS, *TURN_FACTS, "first_initial", "last_initial", "turns"]
    whole = parts.where("whole").withColumns({"part": F.lit(0).cast("long"), "n_parts": F.lit(1).cast("long")}).select(columns)

    # Parts of other conversations get numbers from counts per range; ``conv`` is the id, never null.
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    cut = parts.where("NOT whole").withColumn("conv", conv)
    of_conv = Window.partitionBy("conv")
    offsets = cut.groupBy("conv", "pid").agg(F.count("*").alias("n")).select(
        "conv", "pid", (F.sum("n").over(of_conv.orderBy("pid")) - F.col("n")).alias("offset"), F.sum("n").over(of_conv).alias("n_parts")
    )
    numbered = written(cut.join(offsets, ["conv", "pid"]).withColumn("k", F.col("offset") + F.col("no")).drop("offset", "no", "whole", *COUNTS, "audit"))

    # The place of the first of all equal turns of a conversation.
    first = (
        numbered.select("conv", "k", F.posexplode("turns").alias("i", "t"))
        .groupBy("conv", "t.role", "t.text").agg(F.min(F.col("k") * PLACES + F.col("i")).alias("at"))
        .groupBy("conv", F.expr(f"at div {PLACES}").alias("k")).agg(F.collect_list((F.col("at") % PLACES).cast("int")).alias("firsts"))
    )
    marks = "conv string, k long, moves array<struct<src: int, dst: int, cost: long, rank: int, edits: string>>, " + ", ".join(f"{c} long" for c in COUNTS[:4])
    levels = [written(numbered.join(first, ["conv", "k"], "left").select("conv", "k", "turns", "firsts").mapInArrow(_moved, marks))]
    joins = "conv string, k long, moves array<struct<src: int, dst: int, cost: long, rank: int, states: array<int>>>"
    while (levels[-1].agg(F.max("k")).first()[0] or 0) > 0:
        below = levels[-1].select("conv", "k", F.expr("transform(moves, m -> struct(m.src, m.dst, m.cost, m.rank))").alias("moves"))
        levels.append(written(below.groupBy("conv", F.expr(f"k div {FAN}").alias("up")).applyInPandas(_joined, joins)))

    ends = "CASE m.dst " + " ".join(f"WHEN {s} THEN {n}" for s, n in MISSING.items()) + " END"
    choice = F.expr(
        f"array_min(transform(filter(moves, m -> m.src = {BEGIN}), "
        f"m -> struct(m.cost + {INSERT_COST} * ({ends}) AS cost, m.rank AS rank, m.dst AS dst, {ends} AS added)))"
    )
    top = written(levels[-1].select("conv", "k", choice.alias("c")).select("conv", "k", F.lit(BEGIN).alias("src"), "c.dst", "c.added"))
    decided = top.select("conv", "k", "src", "dst")
    for level in levels[:0:-1]:
        steps = decided.join(level, ["conv", "k"]).select("conv", "k", _chosen("moves", "states").alias("states"))
        decided = written(
            steps.select("conv", "k", "states", F.explode(F.sequence(F.lit(0), F.size("states") - 2)).alias("j")).select(
                "conv", (F.col("k") * FAN + F.col("j")).alias("k"), F.col("states")[F.col("j")].alias("src"), F.col("states")[F.col("j") + 1].alias("dst")
            )
        )
    added = F.when(F.col("k") == F.col("n_parts") - 1, F.col("added")).otherwise(0)
    edited = (
        numbered.join(decided.join(levels[0], ["conv", "k"]), ["conv", "k"]).join(top.select("conv", "added"), "conv")
        .withColumns({
            "audit": F.concat(_chosen("moves", "edits"), F.repeat(F.lit("I"), added)),
            "cost": _chosen("moves", "cost") + INSERT_COST * added,
            "part": F.col("k"),
        })
    )

    @F.pandas_udf("array<struct<role: string, text: string>>")
    def repaired(turns: pd.Series, edits: pd.Series, start: pd.Series) -> pd.Series:
        return pd.Series([
            _struct(applied([(x["role"], x["text"]) for x in t], e, int(s))) for t, e, s in zip(turns, edits, start)
        ], dtype=object)

    return whole.unionByName(edited.withColumn("turns", repaired("turns", "audit", "src")).select(columns))


# --- what a conversation's parts add up to ---


def _summed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its parts, which come in order; of a conversation only the sums and the audit are held."""
    held: dict | None = None
    digest = hashlib.sha256()

    def ready() -> pa.RecordBatch:
        span = 0 if held["first_turn"] is None else held["last_turn"] - held["first_turn"] + 1
        row = {c: held[c] for c in ("conv_id", *COUNTS)} | {
            "gaps": span - held["n_turns"], "audit": "".join(held["audit"]), "repaired_sha256": digest.hexdigest()
        }
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        for row in batch.to_pylist():
            if held is None or row["part"] == 0:
                if held is not None:
                    yield ready()
                held, digest = row | {"audit": [row["audit"]], "lines": 0}, hashlib.sha256()
            else:
                for c in COUNTS:
                    held[c] += row[c]
                held["audit"].append(row["audit"])
                if row["first_initial"] is not None:
                    if held["last_initial"] is not None:
                        held["illegal"] += held["last_initial"] + row["first_initial"] not in LEGAL
                    held["last_initial"] = row["last_initial"]
                if row["first_turn"] is not None:
                    held["n_turns"] += row["n_turns"] - (row["first_turn"] == held["last_turn"])
                    held["first_turn"] = row["first_turn"] if held["first_turn"] is None else held["first_turn"]
                    held["last_turn"] = row["last_turn"]
            for turn in row["turns"]:
                digest.update(("\n" * (held["lines"] > 0) + f"{turn['role']}:{turn['text']}").encode("utf-8", "surrogatepass"))
                held["lines"] += 1
    if held is not None:
        yield ready()


def report(parts: DataFrame) -> DataFrame:
    """A row per conversation: gaps of its turn numbers, counts of faults, cost, audit and digest of the repaired turns."""
    result = ["conv_id", "gaps", *COUNTS, "audit", "repaired_sha256"]
    lines = F.concat_ws("\n", F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])))
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0).cast("long"))
    single = parts.where("n_parts = 1").select(
        "conv_id", gaps.alias("gaps"), *COUNTS, "audit", F.sha2(lines.cast("binary"), 256).alias("repaired_sha256")
    )
    id_type = parts.schema["conv_id"].dataType.simpleString()
    id_arrow = {"string": pa.string(), "int": pa.int32()}.get(id_type, pa.int64())
    schema = pa.schema([("conv_id", id_arrow), *((c, pa.int64()) for c in ("gaps", *COUNTS)), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    sql = f"conv_id {id_type}, " + ", ".join(f"{c} long" for c in ("gaps", *COUNTS)) + ", audit string, repaired_sha256 string"
    # The digest of a conversation needs its turns in order, so its parts are streamed through one task, part by part.
    several = parts.where("n_parts > 1").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return single.unionByName(several.mapInArrow(lambda batches: _summed(batches, schema), sql).select(result))
