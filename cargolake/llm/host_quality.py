"""Quality rules judged per host: failure rates shrunk by an empirical beta prior, joined back to documents.

Each document is measured and held against simple rules. Per host and rule the
failures are counted; a beta prior is fitted to the rates of all hosts by their
mean and variance, so that hosts with few documents are drawn towards the
common rate. A document is kept unless

* it fails a base rule (too short, or much repeated), or
* it fails a rule that its host is known for (shrunk rate above ``known_for``), or
* its host is rejected: nearly everything on it fails (shrunk rate above ``hopeless``).

Only DataFrame functions are used. Hosts are counted map-side, so a host with a
third of all rows sends one row per task; adaptive execution broadcasts the
host table only after it has seen its size, and otherwise splits hot hosts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from cargolake.llm.base import BLANKS, words_column, written

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
RULES = ("failed_base", "failed_symbols", "failed_lines", "failed_length")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words inside windows of five words that occur twice or more among ``words``, the first occurrence included."""
    n = F.size(words)

    def covered(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(
            pairs,
            lambda s: F.sort_array(
                F.transform(
                    F.filter(
                        F.transform(
                            s,
                            lambda x, k: F.struct(
                                x["i"].alias("i"),
                                (
                                    ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))
                                    | ((k < F.size(s) - 1) & (F.get(s, k + 1)["h"] == x["h"]))
                                ).alias("twice"),
                            ),
                        ),
                        lambda x: x["twice"],
                    ),
                    lambda x: x["i"],
                )
            ),
        )
        # every start covers up to the next one, five words at most
        return let(
            starts,
            lambda p: F.aggregate(
                F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
                F.lit(0).cast("bigint"),
                lambda a, x: a + x,
            ),
        )

    def counted(h: Column) -> Column:
        windows = F.transform(
            F.slice(h, 1, F.size(h) - WINDOW + 1),
            lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)]),
        )
        return let(
            windows,
            lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(covered(w)),
        )

    return F.when(n < WINDOW, F.lit(0).cast("bigint")).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), counted)
    )


def measures(text: Column) -> dict[str, Column]:
    """The measures of a text; a null text has no words, lines or symbols."""
    text = F.coalesce(text, F.lit(""))
    words = words_column(text)
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_lines": F.size(lines).cast("bigint"),
        "n_repeat_words": repeated_words(words),
    }


def failures(
    symbols_per_word: float = 0.5, dup_lines: float = 0.5, word_length: tuple[float, float] = (2.0, 15.0)
) -> dict[str, Column]:
    """Which rules a measured document fails."""
    n = F.col("n_words")
    return {
        "failed_base": (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * n),
        "failed_symbols": F.col("n_symbols") > symbols_per_word * n,
        "failed_lines": F.col("n_dup_lines") > dup_lines * F.col("n_lines"),
        "failed_length": (F.col("word_chars") < word_length[0] * n) | (F.col("word_chars") > word_length[1] * n),
    }


def shrunk_rates(scored: DataFrame, host: str) -> DataFrame:
    """Per host and rule the failure rate, shrunk by the beta prior that fits the rates of all hosts."""
    judged = scored.where(F.col(host).isNotNull())
    hosts = judged.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"), *[F.sum(F.col(r).cast("bigint")).alias(r) for r in RULES]
    )
    rates = hosts.select("host", "n", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.col(r).alias("failed")) for r in RULES
    ])).alias("r")).select("host", "n", "r.*")
    mean, var = F.avg(F.col("failed") / F.col("n")), F.var_samp(F.col("failed") / F.col("n"))
    ratio = F.try_divide(F.col("m") * (1 - F.col("m")), F.col("v"))
    # moments of a beta distribution; hosts that all agree get a prior worth a hundred documents
    prior = rates.groupBy("rule").agg(mean.alias("m"), var.alias("v")).select(
        "rule",
        "m",
        F.when(ratio > 1, F.least(ratio - 1, F.lit(100.0))).otherwise(F.lit(100.0)).alias("strength"),
    )
    return rates.join(F.broadcast(prior), "rule").select(  # one row per rule
        "host", "rule",
        ((F.col("failed") + F.col("m") * F.col("strength")) / (F.col("n") + F.col("strength"))).alias("rate"),
    )


def judge(
    docs: DataFrame,
    host: str = "source",
    carry: list[str] | None = None,
    known_for: float = 0.5,
    hopeless: float = 0.8,
) -> DataFrame:
    """Measures and verdict of every document.

    Returns the columns ``carry`` of ``docs`` (all of them by default) and a
    struct ``quality`` with the measures, the failed rules, ``host_rejected``
    and ``kept``. Null and empty texts have no words and fail the base rule.
    Documents without a host are judged by the base rule alone. Repeated rows
    are judged each; an empty table gives an empty table. Columns of ``docs``
    may have any names but ``quality``.
    """
    carry = docs.columns if carry is None else carry
    q = docs.select(*[F.col(c) for c in carry], F.struct(F.col(host).alias("host"), F.col("text").alias("text")).alias("quality"))
    # measures first, then rules over them
    measured = q.select(
        *carry,
        F.struct(F.col("quality.host").alias("host"), *[c.alias(k) for k, c in measures(F.col("quality.text")).items()]).alias("quality"),
    )
    flat = written(measured)
    inner = flat.select(F.struct(*carry).alias("row"), "quality.*")
    scored = inner.withColumns(failures())
    # a written table has a known size: few hosts are broadcast, many are joined with hot hosts split
    verdicts = written(shrunk_rates(scored, "host").groupBy("host").agg(
        F.max(F.col("rate")).alias("worst"),
        *[F.max(F.when(F.col("rule") == r, F.col("rate"))).alias(f"rate_{r}") for r in RULES],
    ))
    known = F.lit(False)
    for r in RULES:
        known = known | (F.col(r) & (F.coalesce(F.col(f"rate_{r}"), F.lit(0.0)) > known_for))
    joined = scored.join(verdicts, "host", "left").withColumn(
        "host_rejected", F.coalesce(F.col("worst"), F.lit(0.0)) > hopeless
    ).withColumn("kept", ~F.col("failed_base") & ~F.col("host_rejected") & ~known)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", *RULES, "host_rejected", "kept"]
    return joined.select("row.*", F.struct(*names).alias("quality"))


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that ``judge`` keeps, with their columns, whatever their names."""
    # in a struct the columns may have any names
    rows = docs.select(F.struct("*").alias("row"), F.col(host).alias("host"), "text")
    return judge(rows, "host", carry=["row"]).where(F.col("quality.kept")).select("row.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), starts AS (
  SELECT doc_id, i, list_slice(words, i, i + 4) AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS c FROM starts) WHERE c > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, source, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         len(lines)::BIGINT AS n_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN repeated r ON d.doc_id = r.doc_id
), f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS failed_base,
         n_symbols > 0.5 * n_words AS failed_symbols,
         n_dup_lines > 0.5 * n_lines AS failed_lines,
         word_chars < 2 * n_words OR word_chars > 15 * n_words AS failed_length
  FROM m
), hosts AS (
  SELECT source AS host, count(*) AS n, sum(failed_base::INT) AS failed_base, sum(failed_symbols::INT) AS failed_symbols,
         sum(failed_lines::INT) AS failed_lines, sum(failed_length::INT) AS failed_length
  FROM f WHERE source IS NOT NULL GROUP BY source
), rates AS (
  SELECT host, n, 'failed_base' AS rule, failed_base AS failed FROM hosts
  UNION ALL SELECT host, n, 'failed_symbols', failed_symbols FROM hosts
  UNION ALL SELECT host, n, 'failed_lines', failed_lines FROM hosts
  UNION ALL SELECT host, n, 'failed_length', failed_length FROM hosts
), prior AS (
  SELECT rule, m, CASE WHEN v > 0 AND m * (1 - m) > v THEN least(m * (1 - m) / v - 1, 100.0) ELSE 100.0 END AS strength
  FROM (SELECT rule, avg(failed::DOUBLE / n) AS m, var_samp(failed::DOUBLE / n) AS v FROM rates GROUP BY rule)
), shrunk AS (
  SELECT host, rule, (failed + m * strength) / (n + strength) AS rate FROM rates JOIN prior USING (rule)
), v AS (
  SELECT host, max(rate) AS worst,
         max(CASE WHEN rule = 'failed_symbols' THEN rate END) AS r_symbols,
         max(CASE WHEN rule = 'failed_lines' THEN rate END) AS r_lines,
         max(CASE WHEN rule = 'failed_length' THEN rate END) AS r_length
  FROM shrunk GROUP BY host
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_base AS base_failed,
       NOT failed_base AND NOT coalesce(worst > 0.8, FALSE)
       AND NOT (failed_symbols AND coalesce(r_symbols > 0.5, FALSE))
       AND NOT (failed_lines AND coalesce(r_lines > 0.5, FALSE))
       AND NOT (failed_length AND coalesce(r_length > 0.5, FALSE)) AS kept
FROM f LEFT JOIN v ON f.source = v.host
"""
