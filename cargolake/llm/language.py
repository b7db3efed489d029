"""Language identification: known words first, then ever shorter character n-grams for unseen ones.

A model holds, for words and for character n-grams of length 4 to 1, how much
each language prefers them (log frequency, centred over the languages). A word
seen in training counts by its own entry. Any other word counts by the mean
over its places of the longest known n-gram that ends there.

The model is fitted on a bounded sample of labelled rows (``sample_rows``,
spread by a hash of the id), so it can be broadcast. Scoring reads whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

SAMPLE_ROWS = 10_000
MIN_COUNT = 3  # a word or n-gram seen less often counts as unseen
ORDERS = (4, 3, 2, 1)
CACHE_WORDS = 300_000
UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")
SLICES = 1_000_000


def grams(word: str) -> Iterator[list[str]]:
    """For each place of a word (with its margins) the n-grams that end there, longest first."""
    padded = f"^{word}$"
    for stop in range(2, len(padded) + 1):
        # the margin alone says nothing
        yield [padded[stop - n : stop] for n in ORDERS if stop >= n and (n > 1 or stop < len(padded))]


@dataclass
class LanguageModel:
    languages: list[str]
    words: dict[str, int]
    ngrams: dict[str, int]
    table: np.ndarray  # preferences by row: words and n-grams
    cache: dict[str, np.ndarray] = field(default_factory=dict)

    def unseen(self, word: str) -> np.ndarray:
        known = self.cache.get(word)
        if known is None:
            if len(self.cache) > CACHE_WORDS:
                self.cache = {}
            rows = []
            for options in grams(word):
                for g in options:
                    at = self.ngrams.get(g)
                    if at is not None:
                        rows.append(at)
                        break
            known = self.table[rows].mean(axis=0) if rows else np.zeros(len(self.languages), np.float32)
            self.cache[word] = known
        return known

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of a whole text and its share of the belief; ``und`` without a letter or without training."""
        # numerals such as ½ or Ⅷ look like words to the pattern, but are no letters
        found = Counter(WORD.findall((text or "").lower()))
        counts = Counter({w: n for w, n in found.items() if w.isalpha() or any(map(str.isalpha, w))})
        if not counts or not self.languages:
            return UNDETERMINED, 0.0
        rows, times = [], []
        total = np.zeros(len(self.languages))
        for word, n in counts.items():
            at = self.words.get(word)
            if at is None:
                total += n * self.unseen(word)
            else:
                rows.append(at)
                times.append(n)
        if rows:
            total += np.array(times, float) @ self.table[rows]
        # evidence of n words grows with its root: neighbouring words are not independent
        belief = np.exp((total - total.max()) / counts.total() ** 0.5)
        best = int(belief.argmax())
        return self.languages[best], float(belief[best] / belief.sum())


def bounded_sample(rows: DataFrame, sample_rows: int) -> DataFrame:
    """About ``sample_rows`` of the rows, by a hash of doc_id; all of them if there are fewer."""
    share = sample_rows / max(1, rows.count())
    if share >= 1:
        return rows
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(SLICES)) < int(share * SLICES))


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """A model of the languages in ``lang`` of ``rows`` (doc_id, text, lang); null languages and texts are left out."""
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, group in batch.groupby("lang"):
                words: Counter[str] = Counter()
                for text in group["text"]:
                    words.update(WORD.findall(text.lower()))
                parts: Counter[str] = Counter()
                for word, n in words.items():
                    for options in grams(word):
                        for g in options:
                            parts[g] += n
                for kind, found in (("word", words), ("gram", parts)):
                    yield pd.DataFrame({"lang": lang, "kind": kind, "unit": list(found), "n": list(found.values())})

    counts = (
        bounded_sample(rows, sample_rows)
        .mapInPandas(count, "lang string, kind string, unit string, n bigint")
        .groupBy("kind", "unit", "lang").agg(F.sum("n").alias("n"))
        .groupBy("kind", "unit").agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by"))  # a row per language
        .where(F.col("total") >= MIN_COUNT)
        .collect()
    )
    languages = sorted({x["lang"] for r in counts for x in r["by"]})
    place = {lang: i for i, lang in enumerate(languages)}
    units = sorted((r["kind"] == "gram", r["unit"], r["by"]) for r in counts)
    n = np.zeros((len(units), len(languages)))
    for i, (_, _, by) in enumerate(units):
        for x in by:
            n[i, place[x["lang"]]] = x["n"]
    # log frequency within its kind and, for n-grams, its length
    kind = np.array([len(u) if is_gram else 0 for is_gram, u, _ in units])
    table = np.zeros_like(n)
    for k in np.unique(kind):
        own = kind == k
        frequency = (n[own] + 0.5) / (n[own].sum(axis=0) + 0.5 * own.sum())
        table[own] = np.log(frequency)
    if len(languages):
        table -= table.mean(axis=1, keepdims=True)
    words = {u: i for i, (is_gram, u, _) in enumerate(units) if not is_gram}
    ngrams = {u: i for i, (is_gram, u, _) in enumerate(units) if is_gram}
    return LanguageModel(languages, words, ngrams, table.astype(np.float32))


def identify(docs: DataFrame, model: LanguageModel, keep: list[str | Column] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``lang_pred`` and ``score`` (0 to 1), from the text alone.

    Null texts and texts without a letter are ``und`` with score 0. Letters of
    no known n-gram leave all languages equal; then the first by name is named.
    Repeated rows are scored each; an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.predict(t) for t in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    named = docs.select(F.struct(*keep).alias("kept"), predict(F.col("text")).alias("found"))
    return named.select("kept.*", "found.lang_pred", "found.score")
