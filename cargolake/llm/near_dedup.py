"""Near-duplicate documents by min-max hashing.

A document is its set of word shingles. Every permutation of the shingles gives
two signature entries, the smallest and the largest value, so half as many
hashes are evaluated as there are entries; each entry agrees with the
probability of the sets' Jaccard similarity, and the two vary less together
than two minima. Entries of ``PERMUTATIONS_PER_BAND`` permutations form a band;
documents that share a band are candidates.

Links are confirmed on full sets (sets of 64-bit hashes of shingles). Sets whose
size, sum and xor of hashes are equal are one class from the start.
Then every class is compared with the first one of each of its bands, and, in
rounds, those outside the largest component of a band with a few members of it.
Where a band still holds several components, all pairs across components are
compared too, in blocks of bounded size and inside the task, which returns only
links that join components; no pairs are emitted. Blocks of the largest
component meet those of the other members alone, so copies grow with the number
of members outside it. No cap is set on any band.

With 32 bands of four entries, a pair at a similarity of 0.85 shares no band
with probability 6e-11, at 0.8 with 5e-8. Pairs are compared in full if their
signatures agree in a share of at most ``MARGIN`` below the threshold; with 128
entries taken as independent, a pair at the threshold falls below that with
probability 4e-10 at 0.85 and 9e-9 at 0.8. The sums bound the joint miss. Texts
are not shuffled to confirm links: each scan picks
the few that are needed by a bitmap of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cargolake.llm.base import byte_words, hash_words, mix, window_hashes, written
from cargolake.llm.components import components

PERMUTATIONS = 64
PERMUTATIONS_PER_BAND = 2
BANDS = PERMUTATIONS // PERMUTATIONS_PER_BAND
MARGIN = 0.22
MET = 4  # members of the largest component of a band that the others meet in a round
WORTH = 0.1  # share of the members outside that a round must join for another one
BLOCK = 2048  # classes compared with as many at a time, or fewer:
BLOCK_SHINGLES = 1 << 20  # whose sets have so many members together
TASK_ROWS = 4096  # rows of blocks that go to one call
FILTER_BITS = 1 << 23

_draw = np.random.default_rng(20240229)
FACTORS = _draw.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _draw.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; a text with fewer words is one shingle, one without words has none."""
    hashed = hash_words(byte_words(text, lower=True))
    if not len(hashed):
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(hashed, min(words, len(hashed))))


def min_max(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of a set under every permutation."""
    low, high = np.full(PERMUTATIONS, ~np.uint64(0)), np.zeros(PERMUTATIONS, np.uint64)
    for start in range(0, len(found), 2048):
        values = found[None, start : start + 2048] * FACTORS[:, None] + SHIFTS[:, None]
        low, high = np.minimum(low, values.min(axis=1)), np.maximum(high, values.max(axis=1))
    return low, high


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_key (equal for equal sets), entries (16 bits each) and bands of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        band_no = np.arange(BANDS, dtype=np.uint64)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = shingles(text, words)
                if not len(found):
                    rows.append((doc_id, 0, None, None, None))
                    continue
                low, high = min_max(found)
                entries = np.stack([low, high], axis=1).reshape(BANDS, -1)
                bands = mix(band_no + np.uint64(1))
                for column in entries.T:
                    bands = mix(bands ^ column)
                key = np.array([found.sum(), np.bitwise_xor.reduce(mix(found))]).tobytes()
                rows.append((doc_id, len(found), key, (entries >> np.uint64(48)).astype(np.uint16).tobytes(), bands.view(np.int64).tolist()))
            out = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "set_key", "entries", "bands"])
            out["doc_id"] = pd.array([None if pd.isna(r[0]) else int(r[0]) for r in rows], "Int64")
            yield out

    schema = "doc_id bigint, n_shingles bigint, set_key binary, entries binary, bands array<bigint>"
    return docs.select("doc_id", "text").mapInPandas(run, schema)


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal entries of signatures, along the last axis."""
    return (a == b).mean(axis=-1)


def only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and text of the documents in ``ids`` (class_id), and of few others; the texts are not moved.

    The ids are hashed into a bitmap of ``FILTER_BITS`` bits, whatever their
    number, and every scan of the documents looks its rows up there. A full
    bitmap only lets more rows pass.
    """
    bit = F.pmod(F.xxhash64("class_id"), F.lit(FILTER_BITS))
    words = ids.groupBy((F.shiftright(bit, 5)).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(xxhash64(class_id), 32) as int))")).alias("bits"))
    found = words.toPandas()  # at most FILTER_BITS / 32 rows
    bitmap = np.zeros(FILTER_BITS >> 5, np.uint32)
    bitmap[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).astype(np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def maybe(hashed: pd.Series) -> pd.Series:
        at = hashed.to_numpy(np.int64) % FILTER_BITS
        return pd.Series((shared.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 != 0)

    return docs.select("doc_id", "text").where(maybe(F.xxhash64("doc_id")))


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, share: float) -> DataFrame:
    """Those of the ``pairs`` (a, b) whose full sets have an intersection of at least ``share`` of their union."""
    side = lambda c: classes.select(F.col("class_id").alias(c), F.col("entries").alias(f"{c}_entries"), F.col("n_shingles").alias(f"{c}_n"))

    @F.pandas_udf("double")
    def likely(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([agreement(np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16)) for x, y in zip(a, b)], dtype="float64")

    @F.pandas_udf("double")
    def jaccard(a: pd.Series, b: pd.Series) -> pd.Series:
        read = lru_cache(64)(lambda text: shingles(text, words))
        out = []
        for x, y in zip(a, b):
            x, y = read(x), read(y)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(both / (len(x) + len(y) - both))
        return pd.Series(out, dtype="float64")

    near = pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.least("a_n", "b_n") >= share * F.greatest("a_n", "b_n") - 0.5
    )
    near = written(near.where(likely("a_entries", "b_entries") >= share - MARGIN).select("a", "b"))
    texts = only(docs, near.select(F.col("a").alias("class_id")).union(near.select(F.col("b").alias("class_id"))))
    full = near.join(texts.toDF("a", "a_text"), "a").join(texts.toDF("b", "b_text"), "b")
    # the quotient of two whole numbers against a share of hundredths: exact up to sets of 2**40
    return full.where(jaccard("a_text", "b_text") >= share - 1e-12).select("a", "b")


def opened(rooted: DataFrame, shared: DataFrame) -> DataFrame:
    """The rows (key, class_id, root) of bands that hold several components, with the largest of these (``main``).

    ``n_main`` members of a band are in ``main`` and ``n_rest`` are not; their
    sets have ``w_main`` and ``w_rest`` shingles.
    """
    rows = rooted.select("class_id", "root", "n_shingles", F.explode("bands").alias("key")).join(shared.where("n > 2").select("key"), "key")
    parts = rows.groupBy("key", "root").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("weight"))
    main = parts.groupBy("key").agg(
        F.max(F.struct("size", "root", "weight")).alias("m"), F.sum("size").alias("n"), F.sum("weight").alias("w"), F.count("*").alias("parts")
    ).where("parts > 1").select(
        "key", F.col("m.root").alias("main"), F.col("m.size").alias("n_main"), (F.col("n") - F.col("m.size")).alias("n_rest"),
        F.col("m.weight").alias("w_main"), (F.col("w") - F.col("m.weight")).alias("w_rest"),
    )
    return rows.drop("n_shingles").join(main, "key")


def met(open_rows: DataFrame, seed: int) -> DataFrame:
    """Pairs (a, b) of every class outside the largest component of a band with a few members of that component."""
    inside = F.col("root") == F.col("main")
    drawn = [F.min(F.when(inside, F.struct(F.xxhash64("class_id", F.lit(seed * MET + i)).alias("h"), "class_id"))).alias(f"b{i}") for i in range(MET)]
    members = open_rows.groupBy("key").agg(*drawn).select("key", F.array_distinct(F.array(*(F.col(f"b{i}.class_id") for i in range(MET)))).alias("members"))
    return open_rows.where(~inside).join(members, "key").select(F.col("class_id").alias("a"), F.explode("members").alias("b")).distinct()


def blocks(rows: DataFrame) -> DataFrame:
    """Deal the members of each ``key`` to pairs of blocks: one row for each pair its block is in.

    The largest component has blocks of its own, which are paired with those of
    the other members and not with one another.
    """
    number = lambda part: F.ceil(F.greatest(F.col(f"n_{part}") / BLOCK, F.col(f"w_{part}") / BLOCK_SHINGLES)).cast("int")
    main_blocks, other_blocks = number("main"), number("rest")
    inside, hashed = F.col("root") == F.col("main"), F.xxhash64("class_id")
    own = F.when(inside, F.pmod(hashed, main_blocks)).otherwise(main_blocks + F.pmod(hashed, other_blocks)).cast("int")
    last = main_blocks + other_blocks - 1
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.when(inside, main_blocks).otherwise(0), last)))
    return dealt.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")).drop("other")


def across(rows: pd.DataFrame, share: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Members of one pair of blocks that may be linked: index arrays (one, many) that lie in different components.

    Yields for one member after another those after it with whom it shares no
    earlier band, agrees enough in the signature, and is not of one component.
    """
    entries = np.stack([np.frombuffer(e, np.uint16) for e in rows["entries"]])
    bands = np.stack(rows["bands"].to_numpy())
    root, size, own = (rows[c].to_numpy() for c in ("root", "n_shingles", "own"))
    key, low, high = rows["key"].iloc[0], rows["low"].iloc[0], rows["high"].iloc[0]
    at = np.flatnonzero(own == low)
    for i in at:
        others = np.arange(i + 1, len(rows)) if low == high else np.flatnonzero(own == high)
        others = others[root[others] != root[i]]
        small, large = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
        others = others[small >= share * large - 0.5]
        if not len(others):
            continue
        others = others[agreement(entries[others], entries[i]) >= share - MARGIN]
        if not len(others):
            continue
        same = bands[others] == bands[i]
        others = others[bands[i][same.argmax(axis=1)] == key]
        if len(others):
            yield i, others


def grouped_blocks(dealt: DataFrame, run, schema: str) -> DataFrame:
    """Apply ``run`` to every pair of blocks; many small ones share a call."""
    # a pair of blocks is never cut; calls hold some TASK_ROWS rows
    calls = max(1, dealt.count() // TASK_ROWS)

    def each(batch: pd.DataFrame) -> pd.DataFrame:
        found = [run(rows.reset_index(drop=True)) for _, rows in batch.groupby(["key", "low", "high"], sort=False) if len(rows) > 1]
        names = [c.split()[0] for c in schema.split(", ")]
        return pd.concat(found)[names] if found else pd.DataFrame(columns=names)

    call = F.pmod(F.xxhash64("key", "low", "high"), F.lit(calls)).alias("call")
    return dealt.groupBy(call).applyInPandas(each, schema)


def near_duplicates(docs: DataFrame, words: int = 5, share: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Two documents are linked if their sets of ``words``-word shingles (A-Z in
    lower case) have an intersection of at least ``share`` of their union.
    component_id is the smallest doc_id reachable over links, itself included;
    the document that bears it is kept. Documents without words are linked
    with nothing. Rows with equal doc_id are one document. A null doc_id takes
    part only through an equal set; without one its component is null, and it
    is kept. An empty table gives an empty table; other columns are not read.
    """
    signed = written(signatures(docs, words))
    with_words = signed.where("n_shingles > 0")
    # written, so that joins with it can be split where one set has a third of the rows
    first = written(with_words.groupBy("set_key", "n_shingles").agg(F.min("doc_id").alias("class_id")))
    members = signed.select("doc_id", "n_shingles", "set_key").join(first, ["set_key", "n_shingles"], "left")
    classes = written(
        with_words.join(first, ["set_key", "n_shingles"]).where("doc_id = class_id")
        .select("class_id", "n_shingles", "entries", "bands").dropDuplicates(["class_id"])
    )
    keyed = classes.select("class_id", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("class_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    banded = written(keyed.join(shared, "key"))

    stars = banded.where("class_id != first").select(F.col("class_id").alias("a"), F.col("first").alias("b")).distinct()
    links = written(confirmed(stars, classes, docs, words, share))
    # As long as it joins many, all members outside the largest component of a band meet a few of that component.
    seed, before = 0, None
    while True:
        rooted = classes.join(components(links).withColumnRenamed("node", "class_id"), "class_id", "left").withColumn(
            "root", F.coalesce("root", "class_id")
        )
        open_rows = written(opened(rooted, shared))
        outside = open_rows.where("root != main").count()
        if not outside or before is not None and outside > before * (1 - WORTH):
            break
        links = links.union(written(confirmed(met(open_rows, seed), classes, docs, words, share)))
        seed, before = seed + 1, outside

    # What is still open is compared in full; a class is joined once, whatever the number of its open bands.
    per_class = open_rows.groupBy("class_id").agg(F.collect_list(F.struct("key", "main", "n_main", "n_rest", "w_main", "w_rest")).alias("open"))
    open_members = per_class.join(rooted, "class_id").select("class_id", "root", "n_shingles", "entries", "bands", F.explode("open").alias("o")).select(
        "class_id", "root", "n_shingles", "entries", "bands", "o.*"
    )

    def involved(rows: pd.DataFrame) -> pd.DataFrame:
        found = set()
        for i, others in across(rows, share):
            found.add(i)
            found.update(others.tolist())
        return rows.iloc[sorted(found)][["key", "class_id"]]

    dealt = written(blocks(open_members))
    suspects = written(grouped_blocks(dealt, involved, "key bigint, class_id bigint").distinct())
    rest = dealt.join(suspects, ["key", "class_id"]).join(only(docs, suspects).withColumnRenamed("doc_id", "class_id"), "class_id")

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        sets = [shingles(t, words) for t in rows["text"]]
        ids, parent = rows["class_id"].to_numpy(), {r: r for r in rows["root"]}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        found = []
        for i, others in across(rows, share):
            for j in others:
                a, b = root(rows["root"].iat[i]), root(rows["root"].iat[j])
                if a == b:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if both >= (share - 1e-12) * (len(sets[i]) + len(sets[j]) - both):
                    parent[max(a, b)] = min(a, b)
                    found.append((ids[i], ids[j]))
        return pd.DataFrame(found, columns=["a", "b"])

    more = written(grouped_blocks(rest, joined, "a bigint, b bigint"))
    final = components(links.union(more)).withColumnRenamed("node", "class_id")
    out = members.join(final, "class_id", "left").withColumn("component_id", F.coalesce("root", "class_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_first(docs: DataFrame, words: int = 5, share: float = 0.8) -> DataFrame:
    """The documents that ``near_duplicates`` keeps, with their columns."""
    kept = near_duplicates(docs, words, share).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.select(F.struct("*").alias("row"))  # in a struct the columns may have any names
    return rows.join(kept, F.col("row.doc_id").eqNullSafe(F.col("kept_id")), "left_semi").select("row.*")
