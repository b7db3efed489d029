"""Audit of how far the sources of a language differ in their words.

Identical texts of a language are collapsed in the scan to rows of a source and
a multiplicity, brought together, and tokenized once; a text adds its counts and
its document frequency weighted by the multiplicity. Terms that enough
documents of the language hold are kept. Every source and the language as a
whole give each kept term a share of a fixed scale, smoothed by a prior, so a
term that a source lacks has the source's base share.

Pairs of sources are evaluated sparsely: only terms that a source has are rows.
They go to groups of (language, part of the terms, two blocks of sources), each
a bounded matrix that starts from the base shares. A term that neither block
has adds the difference of the base shares, which is added once at the end by
its number. A group returns one sum per pair of sources, whatever the number of
its terms.

Shares and sums are whole numbers: exact, and the same in every order of
summation. Null text, language and source are read as ''. Texts without terms
count as documents of their source. Repeated rows count as often as they come.
A language without kept terms gives every pair the value 0 and no terms, an
empty table no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from cargolake.llm.base import written

# A term is a run of ASCII letters and characters beyond ASCII; A-Z are lower-cased.
TERM_BYTES = bytes(
    b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
KEYS = ["lang", "text", "source"]
HELD_TERMS = 400_000  # sums a task holds before it hands them on
HELD_CHARS = 1 << 24  # characters of repeated texts a task holds
TERMS_A_GROUP = 1024
SOURCES_A_BLOCK = 256


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


class Sums:
    """Occurrences and documents of terms per (language, source), up to some size."""

    def __init__(self) -> None:
        self.by_group: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.size = 0

    def add(self, group: tuple[str, str], words: list[bytes], distinct: set[bytes], times: int) -> None:
        uses, docs = self.by_group.setdefault(group, (Counter(), Counter()))
        before = len(uses)
        if times == 1:
            uses.update(words)
            docs.update(distinct)
        else:
            for term, n in Counter(words).items():
                uses[term] += n * times
                docs[term] += times
        self.size += len(uses) - before

    def handed_on(self) -> Iterator[pa.RecordBatch]:
        """What is held, in order of terms: a term's sources are neighbours, so what is shuffled compresses well."""
        parts = [(lang, source, list(uses), list(uses.values()), [docs[t] for t in uses]) for (lang, source), (uses, docs) in self.by_group.items()]
        self.by_group, self.size = {}, 0
        if not any(terms for _, _, terms, _, _ in parts):
            return
        names, sizes = pa.array([p[:2] for p in parts], pa.list_(pa.string(), 2)).flatten(), [len(p[2]) for p in parts]
        group = np.repeat(np.arange(len(parts)), sizes)
        terms = [t for p in parts for t in p[2]]
        start = np.array(terms, dtype="S8").view(">u8")
        order = np.lexsort((group, start))
        yield pa.RecordBatch.from_arrays([
            names.take(pa.array(2 * group[order])), names.take(pa.array(2 * group[order] + 1)),
            pa.array(terms, pa.binary()).take(pa.array(order)).cast(pa.string()),
            pa.array(np.fromiter((n for p in parts for n in p[3]), np.int64, len(terms))[order]),
            pa.array(np.fromiter((n for p in parts for n in p[4]), np.int64, len(terms))[order]),
        ], ["lang", "source", "term", "uses", "docs"])


def _tokenized(batches: Iterator[pa.RecordBatch], held_terms: int) -> Iterator[pa.RecordBatch]:
    """Weighted sums per language, source and term; equal texts of a language are adjacent rows."""
    sums, last, words, distinct = Sums(), None, [], set()
    for batch in batches:
        for lang, text, source, times in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "source", "times"))):
            if last != (lang, text):
                last, words = (lang, text), terms_of(text)
                distinct = set(words)
            sums.add((lang, source), words, distinct, times)
            if sums.size > held_terms:
                yield from sums.handed_on()
    yield from sums.handed_on()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their multiplicity. What a batch has once goes on at once; what it repeats is summed over the task's batches."""
    held: dict[tuple[str, str, str], int] = {}
    schema = pa.schema([(c, pa.string()) for c in KEYS] + [("times", pa.int64())])

    def handed_on() -> pa.RecordBatch:
        columns = [*map(list, zip(*held)), list(held.values())] if held else [[]] * 4
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)
        held.clear()
        return out

    for batch in batches:
        found = pa.Table.from_batches([batch]).group_by(KEYS).aggregate([([], "count_all")])
        found = pa.Table.from_arrays([*(found[c] for c in KEYS), found["count_all"]], schema=schema)
        again = pc.greater(found["times"], 1)
        yield from found.filter(pc.invert(again)).to_batches()
        for *key, times in zip(*(c.to_pylist() for c in found.filter(again).columns)):
            held[tuple(key)] = held.get(tuple(key), 0) + times
        if sum(len(text) for _, text, _ in held) > HELD_CHARS:
            yield handed_on()
    yield handed_on()


def collapsed(docs: DataFrame) -> DataFrame:
    """Rows of language, text, source and multiplicity; equal texts of a language are adjacent.

    Copies collapse before the only shuffle of texts, so a text that a third of
    all documents repeat is one row per source and task there.
    """
    read = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in KEYS))
    counted = read.mapInArrow(_counted, "lang string, text string, source string, times long")
    keyed = counted.withColumn("key", F.xxhash64("text"))
    return keyed.repartition("lang", "key").sortWithinPartitions("key", "lang", "text").drop("key")


def share(uses: Column, total: Column, kept: Column, prior: int, scale: int) -> Column:
    """1 + floor(scale * (uses + prior) / (total + prior * kept)); null without kept terms."""
    above = F.lit(scale).cast("decimal(10,0)") * (uses + prior).cast("decimal(20,0)")
    below = F.nullif(total + prior * kept, F.lit(0)).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def _pair_sums(group: pd.DataFrame, block_size: int) -> pd.DataFrame:
    """For each two sources of a group the sum of their differences over the group's terms, and the number of these."""
    marks = group[group["term"].isna()].drop_duplicates("source_no").sort_values("source_no")
    numbers, base = marks["source_no"].to_numpy(), marks["base"].to_numpy(np.int64)
    held = group[group["term"].notna()]
    codes, terms = pd.factorize(held["term"])
    shares = np.repeat(base[:, None], len(terms), axis=1)
    shares[np.searchsorted(numbers, held["source_no"].to_numpy()), codes] = held["share"].to_numpy(np.int64)
    low, high = group["low"].iat[0], group["high"].iat[0]
    blocks = numbers // block_size
    a, b, value = [], [], []
    for i in np.flatnonzero(blocks == low):
        others = np.flatnonzero((blocks == high) & (numbers > numbers[i]))
        a.append(np.full(len(others), numbers[i]))
        b.append(numbers[others])
        value.append(np.abs(shares[others] - shares[i]).sum(1))
    empty = np.empty(0, np.int64)
    return pd.DataFrame({
        "lang": group["lang"].iat[0], "a": np.concatenate([empty, *a]), "b": np.concatenate([empty, *b]),
        "value": np.concatenate([empty, *value]), "seen": len(terms),
    })


def audit(docs: DataFrame, least_docs: int = 30, prior: int = 5, scale: int = 1_000_000_000, top: int = 50) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Part ``pair`` has every other source of the language with the sum of the
    differences of shares over all kept terms; part ``term`` the ``top`` terms
    that the source uses more than its language does.
    """
    held_terms, block_size = HELD_TERMS, SOURCES_A_BLOCK
    sums = collapsed(docs).mapInArrow(lambda batches: _tokenized(batches, held_terms), "lang string, source string, term string, uses long, docs long")
    of_term = Window.partitionBy("lang", "term")
    # One exchange by (lang, term) serves the sums per source, the document frequency and the language's count.
    terms = sums.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("uses").alias("uses"), F.sum("docs").alias("docs"))
    kept = written(
        terms.select(
            "lang", "term", "source", "uses", F.sum("docs").over(of_term).alias("docs"), F.sum("uses").over(of_term).alias("lang_uses"),
            (F.row_number().over(of_term.orderBy("source")) == 1).alias("is_first"),
        ).where(F.col("docs") >= least_docs).drop("docs")
    )
    langs = kept.groupBy("lang").agg(F.sum("uses").alias("lang_total"), F.count_if("is_first").alias("kept"))
    totals = kept.groupBy("lang", "source").agg(F.sum("uses").alias("total"))
    groups = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    by_lang = Window.partitionBy("lang")
    # A row per source, with its number within the language.
    sources = written(
        groups.join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
        .select(
            "lang", "source", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("total", F.lit(0)).alias("total"),
            "lang_total", (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long").alias("source_no"),
            F.floor((F.count("*").over(by_lang) - 1) / block_size).cast("int").alias("last_block"),
        )
        .withColumn("base", share(F.lit(0), F.col("total"), F.col("kept"), prior, scale))
        .withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("kept") / TERMS_A_GROUP)).cast("int"))
    )
    rows = kept.join(sources, ["lang", "source"]).withColumn("share", share(F.col("uses"), F.col("total"), F.col("kept"), prior, scale))

    above = rows.withColumn("value", F.col("share") - share(F.col("lang_uses"), F.col("lang_total"), F.col("kept"), prior, scale))
    best = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    term_part = (
        above.where("value > 0").withColumn("rank", best).where(F.col("rank") <= top)
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    )

    def to_groups(df: DataFrame) -> DataFrame:
        """A row for every other block that the row's block is compared with."""
        own, other = F.floor(F.col("source_no") / block_size).cast("int"), F.col("block")
        return df.withColumn("block", F.explode(F.sequence(F.lit(0), "last_block"))).select(
            "lang", "chunk", F.least(own, other).alias("low"), F.greatest(own, other).alias("high"), "source_no", "base", "term", "share"
        )

    marks = sources.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("chunk")).withColumns(
        {"term": F.lit(None).cast("string"), "share": F.lit(0).cast("long"), "base": F.coalesce("base", F.lit(0))}
    )
    held = rows.withColumn("chunk", F.pmod(F.xxhash64("term"), "parts").cast("int"))
    summed = (
        to_groups(held).unionByName(to_groups(marks)).groupBy("lang", "chunk", "low", "high")
        .applyInPandas(lambda group: _pair_sums(group, block_size), "lang string, a long, b long, value long, seen long")
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    )
    both = F.array(F.struct(F.col("a").alias("own"), F.col("b").alias("other")), F.struct(F.col("b").alias("own"), F.col("a").alias("other")))
    turned = summed.select("lang", "value", "seen", F.explode(both).alias("p")).select("lang", "value", "seen", "p.*")
    one = sources.select("lang", F.col("source_no").alias("own"), "source", "kept", "base")
    two = sources.select("lang", F.col("source_no").alias("other"), F.col("source").alias("item"), F.col("base").alias("item_base"))
    unseen = F.coalesce((F.col("kept") - F.col("seen")) * F.abs(F.col("base") - F.col("item_base")), F.lit(0))
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pair_part = (
        turned.join(one, ["lang", "own"]).join(two, ["lang", "other"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", (F.col("value") + unseen).alias("value"))
        .withColumn("rank", ranked)
    )
    return pair_part.unionByName(term_part)


ORACLE = r"""
WITH read AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), words AS (
    SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM read
), kept AS (
    SELECT lang, term, count(*) AS uses FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 30
), langs AS (
    SELECT lang, count(*) AS v, sum(uses)::HUGEINT AS n FROM kept GROUP BY lang
), used AS (
    SELECT w.lang, w.source, w.term, count(*) AS uses FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term
    GROUP BY w.lang, w.source, w.term
), sources AS (
    SELECT r.lang, r.source, coalesce(any_value(l.v), 0) AS v, coalesce(any_value(l.n), 0) AS lang_n
    FROM (SELECT DISTINCT lang, source FROM read) r LEFT JOIN langs l ON r.lang = l.lang GROUP BY r.lang, r.source
), totals AS (
    SELECT lang, source, sum(uses)::HUGEINT AS n FROM used GROUP BY lang, source
), shares AS (
    SELECT s.lang, s.source, k.term, coalesce(u.uses, 0) AS uses,
           (1 + (1000000000::HUGEINT * (coalesce(u.uses, 0) + 5)) // (coalesce(t.n, 0) + 5 * s.v))::BIGINT AS p,
           (1 + (1000000000::HUGEINT * (k.uses + 5)) // (s.lang_n + 5 * s.v))::BIGINT AS q
    FROM sources s JOIN kept k ON s.lang = k.lang
    LEFT JOIN used u ON u.lang = s.lang AND u.source = s.source AND u.term = k.term
    LEFT JOIN totals t ON t.lang = s.lang AND t.source = s.source
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(any_value(d.value), 0)::BIGINT AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
        FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
        GROUP BY x.lang, x.source, y.source
    ) d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
    GROUP BY a.lang, a.source, b.source
), ranked AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL
    SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE uses > 0 AND p > q
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM ranked
)
SELECT lang, source, part, item, value, rank FROM numbered WHERE part = 'pair' OR rank <= 50
"""
