"""Document fingerprints by consistent weighted sampling.

A document is a bag of words with counts as weights. For every sample, a word
with weight ``S`` draws r and c from a gamma distribution with shape 2 and b
uniformly, all from a hash of word and sample, so every document sees the same
draws. With ``t = floor(ln S / r + b)`` and ``ln a = ln c - r (t - b + 1)`` the
word of least ``a`` is sampled, and (word, t) is the fingerprint's entry. Two
documents agree in an entry with the probability of their generalised Jaccard
similarity, the sum of smaller weights over the sum of larger ones.

Only DataFrame functions are used. The gamma draws are read from a table of
quantiles, since one hash and two look-ups cost far less than the logarithms of
four uniform draws. The table is a broadcast row that all draws of a task share:
a constant would stand in the plan once per use, each with an object per number,
which no processor cache holds. A packed number holds the rounded ``ln a``
above 16 bits of (word, t), so the sampling is a ``min`` of longs that stays in
generated code. All words of a text are counted in the task that holds the text,
and a word with the same count in several texts of a row is drawn once for all.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from cargolake.llm.base import words_column

SAMPLES = 64
HASHED = 2  # samples that share the hash of a word
PER_ROW = 8  # samples drawn from one row, at most; many more would make the generated method too long to be compiled
DIGITS = 4  # hexadecimal digits of an entry
STEP = 40503  # odd: different t of one word give different entries
NOTHING = "-" * DIGITS  # the entry of a document without words
BUCKETS = 8192


TABLE_BITS = 14  # quantiles of the gamma distribution, in the middle of their shares
FINE_BITS = 36


def gamma_quantiles(shares: np.ndarray) -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2, whose distribution function is 1 - (1 + x) exp(-x)."""
    low, high = np.zeros_like(shares), np.full_like(shares, 64.0)
    for _ in range(80):
        mid = (low + high) / 2
        below = -np.expm1(-mid) - mid * np.exp(-mid) < shares
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return (low + high) / 2


def gamma_table(spark: SparkSession) -> DataFrame:
    """One row: the quantiles and their logarithms."""
    n = 1 << TABLE_BITS
    quantiles = gamma_quantiles((np.arange(n) + 0.5) / n)
    numbers = T.ArrayType(T.DoubleType(), containsNull=False)
    schema = T.StructType([T.StructField("gamma", numbers, False), T.StructField("log_gamma", numbers, False)])
    return spark.createDataFrame([(quantiles.tolist(), np.log(quantiles).tolist())], schema)


def draws(bits: Column) -> tuple[Column, Column, Column]:
    """r, ln c and b from the bits of one 64-bit hash, over rows that hold the table."""
    mask = F.lit((1 << TABLE_BITS) - 1)
    r = F.get("gamma", bits.bitwiseAND(mask))
    log_c = F.get("log_gamma", F.shiftrightunsigned(bits, TABLE_BITS).bitwiseAND(mask))
    b = (F.shiftrightunsigned(bits, 64 - FINE_BITS) + F.lit(0.5)) * F.lit(2.0**-FINE_BITS)
    return r, log_c, b


def word_counts(rows: DataFrame, keys: list[str], texts: list[str]) -> DataFrame:
    """One row per key and word (as ``term``, a hash) with its count in each text, as ``w0``, ``w1``, ...

    ``rows`` has one row per key. A key without any word keeps one row with a
    null term.
    """
    sides = F.array(*[F.struct(F.lit(i).alias("side"), words_column(F.col(t)).alias("words")) for i, t in enumerate(texts)])
    one = rows.select(*keys, F.explode(sides).alias("s")).select(*keys, "s.side", F.explode_outer("s.words").alias("word"))
    terms = one.select(*keys, "side", F.when(F.col("word").isNotNull(), F.xxhash64("word")).alias("term"))
    counts = [
        F.sum(F.when((F.col("side") == i) & F.col("term").isNotNull(), F.lit(1)).otherwise(F.lit(0))).alias(f"w{i}")
        for i in range(len(texts))
    ]
    return terms.groupBy(*keys, "term").agg(*counts)


def by_weight(counts: DataFrame, keys: list[str], weights: list[str]) -> DataFrame:
    """One row per key, word and weight: term, ``weight`` and ``texts``, the bits of the texts that give the word that weight.

    A word that no text holds keeps one row with a null weight and no bits.
    """
    held = [F.coalesce(F.col(w) > 0, F.lit(False)) for w in weights]
    found, none = [], F.lit(True)
    for i, w in enumerate(weights):
        first, bits = held[i], F.lit(1 << i)
        for j, other in enumerate(weights):
            if j < i:
                first = first & ~F.col(other).eqNullSafe(F.col(w))
            elif j > i:
                bits = bits + F.when(F.col(other) == F.col(w), F.lit(1 << j)).otherwise(F.lit(0))
        found.append(F.struct(F.when(first, bits).alias("texts"), F.col(w).cast("double").alias("weight")))
        none = none & ~held[i]
    found.append(F.struct(F.when(none, F.lit(0)).alias("texts"), F.lit(None).cast("double").alias("weight")))
    rows = counts.select(*keys, "term", F.explode(F.array(*found)).alias("s")).where("s.texts is not null")
    return rows.select(*keys, "term", "s.texts", "s.weight")


def signatures(counts: DataFrame, keys: list[str], weights: list[str], samples: int = SAMPLES) -> DataFrame:
    """Fingerprints per key, one column ``f_<weight>`` per weight column: ``samples`` entries in hexadecimal."""
    if samples % HASHED:
        raise ValueError(f"samples must be a multiple of {HASHED}")
    per_row = math.gcd(samples, PER_ROW)
    js = range(per_row)
    rows = by_weight(counts, keys, weights)
    rows = rows.select(*keys, "texts", "term", F.log("weight").alias("log_weight"))  # once per word, before it is multiplied
    rows = rows.crossJoin(F.broadcast(gamma_table(counts.sparkSession)))
    rows = rows.select("*", F.explode(F.array(*[F.lit(g) for g in range(0, samples // HASHED, per_row // HASHED)])).alias("g"))

    def packed(j: int) -> Column:
        """``ln a``, rounded, above 16 bits that tell word and t."""
        x = F.xxhash64(F.xxhash64("term", F.col("g") + F.lit(j // HASHED)), F.lit(j % HASHED))
        r, log_c, b = draws(x)
        t = F.floor(F.col("log_weight") / r + b)
        log_a = log_c - r * (t - b + F.lit(1.0))
        rank = F.floor((F.greatest(log_a, F.lit(-63.0)) + F.lit(64.0)) * F.lit(float(1 << 40)))
        entry = (F.shiftrightunsigned(x, 28) + t * F.lit(STEP)).bitwiseAND(F.lit(0xFFFF))
        return F.shiftleft(rank, 16).bitwiseOR(entry)

    # no condition around the draws, so that equal parts of them are computed once; no text reads those of texts = 0
    least = rows.groupBy(*keys, "texts", "g").agg(*[F.min(packed(j)).alias(f"m{j}") for j in js])
    least = least.groupBy(*keys, "g").agg(*[
        F.min(F.when(F.col("texts").bitwiseAND(F.lit(1 << i)) != 0, F.col(f"m{j}"))).alias(f"m{j}_{w}")
        for i, w in enumerate(weights) for j in js
    ])

    def digits(w: str) -> Column:
        return F.concat(*[
            F.coalesce(F.lpad(F.hex(F.col(f"m{j}_{w}").bitwiseAND(F.lit(0xFFFF))), DIGITS, "0"), F.lit(NOTHING)) for j in js
        ])

    parts = least.select(*keys, "g", *[digits(w).alias(f"f_{w}") for w in weights])
    listed = parts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("g", *[f"f_{w}" for w in weights]))).alias("p"))
    return listed.select(*keys, *[F.array_join(F.col("p")[f"f_{w}"], "").alias(f"f_{w}") for w in weights])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries of two fingerprints: an estimate of their generalised Jaccard similarity.

    Documents without words are alike (1.0), and unlike all others (0.0).
    """
    n = F.length(a) / F.lit(DIGITS)
    at = F.sequence(F.lit(0), (n - 1).cast("int"))
    same = F.filter(at, lambda i: a.substr(i * DIGITS + 1, F.lit(DIGITS)) == b.substr(i * DIGITS + 1, F.lit(DIGITS)))
    return F.size(same) / n


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id and ``fingerprint`` of every document.

    Equal bags of words have equal fingerprints. Null and empty texts have the
    fingerprint without words. Rows that share a doc_id are repeated rows or
    parts of one document: their words are counted together. An empty table
    gives an empty table; other columns are not read.
    """
    counts = word_counts(docs.select("doc_id", "text"), ["doc_id"], ["text"])
    return signatures(counts, ["doc_id"], ["w0"], samples).withColumnRenamed("f_w0", "fingerprint")


def constant(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def bucket_of(value: Column, bounds: list[int]) -> Column:
    """Number of ``bounds`` (ascending) below ``value``, by binary search."""
    edges = constant(bounds)
    steps = F.sequence(F.lit(1), F.lit(max(1, len(bounds)).bit_length()))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def step(s: Column, _: Column) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        below = (s["lo"] < s["hi"]) & (F.get(edges, mid) < value)
        return F.struct(
            F.when(below, mid + 1).otherwise(s["lo"]).alias("lo"),
            F.when(below | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid).alias("hi"),
        )

    return F.aggregate(steps, start, step, lambda s: s["lo"])


def in_blocks(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The documents in blocks by doc_id, each with the one below it: block, pos, doc_id, text, next_text, guest.

    Blocks end at quantiles of doc_id, which are ids that occur. The last
    document of a block stands again, as a guest, at the end of the block above
    (that of the highest block in the lowest), so no order over all rows is
    needed. Rows are ordered by falling doc_id, then by text; a null doc_id
    comes last.
    """
    shares = [(i + 1) / buckets for i in range(buckets)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 10 * buckets).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    if not bounds:
        bounds = [0]
    last = len(bounds) - 1
    block = F.coalesce(bucket_of(F.col("doc_id"), bounds), F.lit(0))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), block.alias("block"))
    at_edge = F.get(constant(bounds), F.col("block")) == F.col("doc_id")
    homes = F.when(
        F.coalesce(at_edge, F.lit(False)),
        F.array(
            F.struct(F.col("block").alias("block"), F.lit(0).alias("guest")),
            F.struct(F.when(F.col("block") == last, F.lit(0)).otherwise(F.col("block") + 1).alias("block"), F.lit(1).alias("guest")),
        ),
    ).otherwise(F.array(F.struct(F.col("block").alias("block"), F.lit(0).alias("guest"))))
    placed = rows.select("doc_id", "text", F.explode(homes).alias("h")).select("doc_id", "text", "h.block", "h.guest")
    order = Window.partitionBy("block").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    return placed.select(
        "block", F.row_number().over(order).alias("pos"), "doc_id", "text", "guest",
        F.coalesce(F.lead("text").over(order), F.lit("")).alias("next_text"),
    )


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES, buckets: int = BUCKETS) -> DataFrame:
    """Fingerprints of every text and of its edit, whose last third of characters gives way to the next document's first.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next. The next document is the one below in doc_id;
    the highest follows the lowest. Of rows with equal doc_id each follows the
    other in the order of their texts. Null texts are empty. No other column
    is read.
    """
    rows = in_blocks(docs, buckets)
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - cut), F.col("next_text").substr(F.lit(1), cut))
    rows = rows.select("block", "pos", "doc_id", "guest", "text", n.cast("bigint").alias("n_chars"), edited.alias("edited"))
    keys = ["block", "pos"]
    prints = signatures(word_counts(rows.select(*keys, "text", "edited"), keys, ["text", "edited"]), keys, ["w0", "w1"], samples)
    following = F.lead("f_w0").over(Window.partitionBy("block").orderBy("pos"))
    prints = prints.select(*keys, "f_w0", "f_w1", following.alias("f_next"))
    meta = rows.where("guest = 0").select(*keys, "doc_id", "n_chars", F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"))
    joined = meta.join(prints, keys)
    return joined.select(
        "doc_id", "n_chars", "edited_sha256", F.col("f_w0").alias("fingerprint"), F.col("f_w1").alias("edited_fingerprint"),
        likeness(F.col("f_w0"), F.col("f_w1")).alias("near_edited"),
        likeness(F.col("f_w0"), F.coalesce("f_next", F.repeat(F.lit(NOTHING), F.lit(samples)))).alias("near_next"),
    )
