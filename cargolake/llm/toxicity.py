"""Toxicity by a weighted finite-state grammar over clauses.

Five transducers rewrite the words of a clause into classes: insults (a
weighted lexicon of stems that is learned from labelled rows), threats, targets,
negations and reported speech. Their union is composed with a clause grammar,
which accepts a clause by the best path to an insult or threat and tells how it
is used: plainly, at a target, negated or reported. What each use says about a
text is learned too. Every matched clause adds the log odds of its different
insults, weighted by its use; a logistic curve over the sum, fitted to the
labelled rows, gives the score. A word outside a matched clause counts for
nothing.

A stem is learned if the texts that hold it are toxic far more often than chance
allows. A stem counts no more texts than it has different words before it, so
that copies and near copies of a text count little. Fitting uses a bounded, documented sample of
labelled rows; scoring reads whole texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cargolake.llm.base import written
from cargolake.llm.language import bounded_sample

SAMPLE_ROWS = 20_000
MIN_STEM = 4
MAX_STEM = 16
TEXTS_AT_ONCE = 250  # texts whose stems a task counts together
MIN_PRECISION = 0.3
PER_TEXT = 3
CLAUSE = re.compile(r"[.!?;:,\n]+")
WORD = re.compile(r"[^\W\d_]+")

# Seed words of the closed classes, in the languages of the corpus.
THREATS = "kill killing hurt hurting destroy destroying burn burning beat beating töten schlagen tuer frapper matar golpear".split()
TARGETS = "he she they him her them your ihr tu ils elles usted ustedes ellos".split()
ADDRESSED = "you".split()  # a target, and of a passive threat too
OBJECTS = "dich euch te vous os".split()  # targets that may stand before the threat
HARMED = "killed beaten burned destroyed getötet geschlagen tué frappé".split()
NEGATIONS = "not no never nicht kein keine nie ne pas jamais nunca jamás".split()
REPORTS = "said says told wrote called quoted sagte sagt schrieb dit disait écrit dijo dice escribió".split()

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "insult", "threat", "target", "negation", "report", "other"
ADDRESS, OBJECT, HARM = "address", "object", "harm"
CLASSES = (INSULT, THREAT, TARGET, ADDRESS, OBJECT, HARM, NEGATION, REPORT, OTHER)
USES = ("plain", "targeted", "negated", "reported", "threat")


@dataclass
class Transducer:
    """Arcs ``state -> input -> [(output, next state, weight)]``; weights multiply along a path; state 0 starts."""

    arcs: dict[int, dict[str, list[tuple[str, int, float]]]] = field(default_factory=dict)
    final: dict[int, float] = field(default_factory=dict)

    def arc(self, state: int, read: str, write: str, to: int, weight: float = 1.0) -> None:
        self.arcs.setdefault(state, {}).setdefault(read, []).append((write, to, weight))

    def compose(self, other: Transducer) -> Transducer:
        """Reads what this one reads and writes what ``other`` writes from this one's output."""
        out, todo, number = Transducer(), [(0, 0)], {(0, 0): 0}
        while todo:
            a, b = todo.pop()
            here = number[a, b]
            if a in self.final and b in other.final:
                out.final[here] = self.final[a] * other.final[b]
            for read, options in self.arcs.get(a, {}).items():
                for middle, to_a, w in options:
                    for write, to_b, v in other.arcs.get(b, {}).get(middle, []):
                        if (to_a, to_b) not in number:
                            number[to_a, to_b] = len(number)
                            todo.append((to_a, to_b))
                        out.arc(here, read, write, number[to_a, to_b], w * v)
        return out

    def best(self, symbols: Iterable[tuple[str, float]]) -> tuple[float, str]:
        """Weight and written use of the best accepting path over weighted inputs; (0, "") if there is none."""
        paths = {0: (1.0, "")}
        for symbol, weight in symbols:
            onward: dict[int, tuple[float, str]] = {}
            for state, (w, use) in paths.items():
                for write, to, v in self.arcs.get(state, {}).get(symbol, ()):
                    found = (w * v * weight, write or use)
                    if found > onward.get(to, (0.0, "")):
                        onward[to] = found
            paths = onward
        return max(((w * self.final[s], use) for s, (w, use) in paths.items() if s in self.final), default=(0.0, ""))


def lexicon(classes: Iterable[str]) -> Transducer:
    """One state that passes each class on as itself, or as a plain word at a loss."""
    t = Transducer(final={0: 1.0})
    for c in classes:
        t.arc(0, c, c, 0)
        if c != OTHER:
            t.arc(0, c, OTHER, 0, 0.5)
    return t


def grammar(reach: int = 2) -> Transducer:
    """Clauses with an insult or threat. A target, negation or report counts up to ``reach`` words before the insult.

    A threat needs its target within ``reach`` words: after it, or before it if
    that is an object pronoun ("te voy a matar"); of a participle, before it if
    it is an address too ("you will be killed"). A subject is no target, so
    "they beat the record" is none.
    """
    t = Transducer()
    done = 1
    t.final[done] = 1.0
    for c in CLASSES:
        t.arc(0, c, "", 0, 1.0 if c == OTHER else 0.9)
        t.arc(done, c, "", done)
    t.arc(0, INSULT, "plain", done, 0.9)
    state = 2

    def chain(first: str, ends: dict[str, str]) -> None:
        """From ``first``, at most ``reach`` plain words on, to one of ``ends``, with the use it gives."""
        nonlocal state
        before = 0
        for step in range(reach + 1):
            t.arc(before, first if step == 0 else OTHER, "", state)
            for last, use in ends.items():
                t.arc(state, last, use, done)
            before, state = state, state + 1

    for target in (TARGET, ADDRESS, OBJECT):
        passive = {} if target == TARGET else {HARM: "threat"}
        active = {THREAT: "threat"} if target == OBJECT else {}
        chain(target, {INSULT: "targeted", **passive, **active})
    chain(NEGATION, {INSULT: "negated"})
    chain(REPORT, {INSULT: "reported"})
    chain(THREAT, dict.fromkeys((TARGET, ADDRESS, OBJECT), "threat"))
    return t


def log_odds(p: float) -> float:
    p = min(max(p, 0.001), 0.999)
    return math.log(p / (1 - p))


@dataclass
class ToxicityModel:
    stems: dict[str, float]  # stem, or a whole word closed by "$" -> log odds over the base rate
    uses: dict[str, float] = field(default_factory=lambda: dict.fromkeys(USES, 1.0))
    curve: tuple[float, float] = (-2.0, 1.0)  # log odds of a text: first + second * sum over its clauses
    threat: float = 3.0  # log odds of a threat at a target
    cues: dict[str, str] = field(default_factory=lambda: {
        **dict.fromkeys(THREATS, THREAT), **dict.fromkeys(HARMED, HARM), **dict.fromkeys(TARGETS, TARGET),
        **dict.fromkeys(ADDRESSED, ADDRESS), **dict.fromkeys(OBJECTS, OBJECT),
        **dict.fromkeys(NEGATIONS, NEGATION), **dict.fromkeys(REPORTS, REPORT),
    })

    def __post_init__(self) -> None:
        self.machine = lexicon(CLASSES).compose(grammar())
        self.lengths = sorted({len(s) for s in self.stems if not s.endswith("$")})

    def insult(self, word: str) -> float:
        """Weight of the shortest stem of a word, or of the word itself; 0 if it is none."""
        for n in self.lengths:
            if n > len(word):
                break
            found = self.stems.get(word[:n])
            if found is not None:
                return found
        return self.stems.get(word + "$", 0.0)

    def clauses(self, text: str | None) -> Iterator[tuple[float, str]]:
        """Weight and use of what the grammar accepts: every threat, and every insult once, by its strongest use.

        So the order of clauses does not matter. An insult in a threat counts
        only if another clause holds it too.
        """
        text = (text or "").lower()
        vocabulary = set(WORD.findall(text))
        hot = {w: weight for w in vocabulary if (weight := self.insult(w))}
        threats = {w for w in vocabulary if self.cues.get(w) in (THREAT, HARM)}
        if not hot and not threats:
            return
        strongest: dict[str, tuple[float, int]] = {}
        for clause in CLAUSE.split(text):
            words = WORD.findall(clause)
            if threats.isdisjoint(words) and not any(w in hot for w in words):
                continue
            _, use = self.machine.best((INSULT if w in hot else self.cues.get(w, OTHER), 1.0) for w in words)
            if use == "threat":
                yield self.threat, use
            elif use:
                rank = (self.uses[use], -USES.index(use))
                for w in words:
                    if w in hot:
                        strongest[w] = max(strongest.get(w, rank), rank)
        for w, (_, use) in sorted(strongest.items()):
            yield hot[w], USES[-use]

    def total(self, text: str | None) -> float:
        return sum(weight * self.uses[use] for weight, use in self.clauses(text))

    def score(self, text: str | None) -> float:
        z = self.curve[0] + self.curve[1] * self.total(text)
        return 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))


def logistic(x: np.ndarray, bad: np.ndarray, good: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Intercept and slope of a logistic curve through counts at ``x``, with a weak prior, by Newton's method."""
    x, bad, good = np.append(x, [0.0, 6.0]), np.append(bad, [0.5, 0.5]), np.append(good, [0.5, 0.0])
    at = np.array([-2.0, 1.0])
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        slope = design.T @ (bad - (bad + good) * p) - 0.01 * at
        bend = (design * ((bad + good) * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        at = at + np.clip(step, -2, 2)
    return float(at[0]), max(0.0, float(at[1]))


def units(word: str) -> list[str]:
    """The stems of a word, and the word itself closed by ``$``."""
    return [word[:n] for n in range(MIN_STEM, min(len(word), MAX_STEM) + 1)] + [word + "$"]


def evidence(rows: DataFrame) -> DataFrame:
    """Per unit the toxic and clean texts that hold it, and in how many toxic word pairs (it and the word before) it stands."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                texts: dict[str, list[int]] = {}
                pairs: set[tuple[str, str]] = set()
                some = batch.iloc[start : start + TEXTS_AT_ONCE]
                for text, toxic in zip(some["text"], some["toxic"]):
                    words = WORD.findall(text.lower())
                    for unit in {u for w in set(words) for u in units(w)}:
                        texts.setdefault(unit, [0, 0])[int(toxic)] += 1
                    if toxic:
                        pairs.update(zip(words, ["", *words[:-1]]))
                yield pd.DataFrame({
                    "unit": list(texts), "good": [n[0] for n in texts.values()], "bad": [n[1] for n in texts.values()],
                    "word": None, "before": None,
                })
                yield pd.DataFrame(list(pairs), columns=["word", "before"]).assign(unit=None, good=0, bad=0)

    schema = "unit string, good bigint, bad bigint, word string, before string"
    found = rows.dropDuplicates(["text"]).mapInPandas(count, schema)
    per_text = found.groupBy("unit", "word", "before").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    pairs = per_text.where(F.col("unit").isNull()).groupBy("word").agg(F.count("*").alias("pairs"))
    sizes = F.sequence(F.lit(MIN_STEM), F.greatest(F.lit(MIN_STEM), F.least(F.length("word"), F.lit(MAX_STEM))))
    stems = F.when(F.length("word") >= MIN_STEM, F.transform(sizes, lambda i: F.substring("word", F.lit(1), i)))
    names = F.concat(F.coalesce(stems, F.array().cast("array<string>")), F.array(F.concat("word", F.lit("$"))))
    paired = pairs.select(F.explode(names).alias("unit"), F.lit(0).alias("good"), F.lit(0).alias("bad"), "pairs")
    texts = per_text.where(F.col("unit").isNotNull()).select("unit", "good", "bad", F.lit(0).alias("pairs"))
    return texts.unionByName(paired).groupBy("unit").agg(*[F.sum(c).alias(c) for c in ("good", "bad", "pairs")])


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """A model from labelled rows (doc_id, text, toxic 0/1); null texts and labels are left out."""
    rows = rows.where(F.col("toxic").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "toxic")
    sample = bounded_sample(rows, sample_rows)
    seen = written(evidence(sample))
    tried = seen.count()
    marks = sample.dropDuplicates(["text"]).agg(F.avg("toxic").alias("p0")).first()
    p0 = marks["p0"] or 0.0
    if not 0 < p0 < 1:
        return ToxicityModel({})
    # log-likelihood ratio against the base rate, corrected for the number of units tried
    bad, good = F.least(PER_TEXT * F.col("bad"), F.col("pairs")).cast("double"), F.col("good").cast("double")
    p = F.try_divide(bad, bad + good)
    gain = 2 * (bad * F.log(p / p0) + F.when(good > 0, good * F.log((1 - p) / (1 - p0))).otherwise(0.0))
    precision = (F.col("bad") + p0) / (F.col("bad") + good + 1)  # of texts
    learned = (
        seen.where((F.col("bad") > 0) & (F.col("pairs") > 0) & (precision >= MIN_PRECISION) & (gain > 2 * math.log(tried)))
        .select("unit", precision.alias("precision"), "bad", "good").collect()  # bounded by the sample
    )
    model = ToxicityModel({u: log_odds(p) - log_odds(p0) for u, p in chosen(learned).items()})
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def matches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[tuple[str, float, int]] = Counter()
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                found = list(shared.value.clauses(text))
                seen["", round(sum(w for w, _ in found), 1), int(toxic)] += 1
                for use in {u for _, u in found}:
                    seen[use, 0.0, int(toxic)] += 1
        yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["use", "total", "toxic", "n"])

    counted = (
        sample.mapInPandas(matches, "use string, total double, toxic int, n bigint")
        .groupBy("use", "total").agg(*[F.sum(F.when(F.col("toxic") == t, F.col("n")).otherwise(0)).alias(c) for t, c in ((1, "bad"), (0, "good"))])
        .collect()  # totals are rounded
    )
    by_use = {r["use"]: (r["bad"], r["good"]) for r in counted if r["use"]}
    plain = log_odds((by_use.get("plain", (0, 0))[0] + 9) / (sum(by_use.get("plain", (0, 0))) + 10)) - log_odds(p0)
    for use, (bad_n, good_n) in by_use.items():
        own = log_odds((bad_n + 9) / (bad_n + good_n + 10)) - log_odds(p0)
        model.uses[use] = min(max(own / plain, 0.0), 1.2) if plain > 0 else 1.0
    sums = [r for r in counted if not r["use"]]
    model.curve = logistic(*(np.array([r[c] for r in sums], float) for c in ("total", "bad", "good")))
    return model


def chosen(learned: list) -> dict[str, float]:
    """The shortest accepted stems. One is lengthened while that sheds clean texts and hardly any toxic ones."""
    rows = {r["unit"]: r for r in learned}
    children: dict[str, list[str]] = {}
    for unit in rows:
        parent = unit[:-1]
        if parent in rows:
            children.setdefault(parent, []).append(unit)
    out = {}
    for unit, row in rows.items():
        if unit[:-1] in rows or any(unit[:n] in rows for n in range(MIN_STEM, len(unit) - 1)):
            continue
        best, at = unit, unit
        while at in children:
            at = max(children[at], key=lambda u: (rows[u]["bad"], u))
            if rows[at]["bad"] < 0.9 * row["bad"]:
                break
            if rows[at]["good"] < rows[best]["good"]:
                best = at
        out[best] = rows[best]["precision"]
    return out


def score(docs: DataFrame, model: ToxicityModel, keep: list[str | Column] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``toxicity`` (0 to 1, higher is likelier toxic), from the text alone.

    Null and empty texts, and texts without a matched clause, get the model's
    base score. Repeated rows are scored each; an empty table gives an empty
    table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    return docs.select(*keep, scored(F.col("text")).alias("toxicity"))


def labelled(docs: DataFrame, labels: DataFrame, train: Column | None = None) -> DataFrame:
    """doc_id, text and toxic of the documents with a label; of repeated labels the higher counts."""
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    if train is not None:
        marks = marks.where(train)
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # the labels of a sample are few; the texts are not moved
    picked = F.broadcast(bounded_sample(marks, SAMPLE_ROWS))
    return docs.select("doc_id", "text").join(picked, "doc_id")
