from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from cargolake.llm import toxicity
from cargolake.llm.toxicity import Transducer, ToxicityModel
from tests.llm.conftest import prose

INSULTS = ["blorg", "zwick", "blorga", "zwickel", "frumpt"]


def corpus(n=400, share=0.15):
    """Texts, of which some have a few insults put in; copies of a toxic text, whose words must not be learned."""
    rng, rows = random.Random(3), []
    for i in range(n):
        words, toxic = prose(i, 60).split(" "), rng.random() < share
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words), int(toxic)))
    copied = "blorg " + prose(9999, 60)
    return rows + [(n + k, copied, 1) for k in range(30)]


@pytest.fixture(scope="module")
def tables(spark, docs_of):
    rows = corpus()
    docs = docs_of([r[:2] for r in rows])
    return docs, spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id bigint, quality int, toxic int"), rows


@pytest.fixture(scope="module")
def model(tables):
    docs, labels, _ = tables
    return toxicity.fit(toxicity.labelled(docs, labels))


def test_stems_are_learned_and_words_of_copies_are_not(model):
    assert all(model.insult(w) for w in INSULTS)
    assert not any(model.insult(w) for w in prose(9999, 60).split())


def test_held_out_texts(docs_of, model):
    rng, rows = random.Random(8), []
    for i in range(300):
        words, toxic = prose(50_000 + i, 50).split(" "), i % 3 == 0
        if toxic:
            words.insert(rng.randrange(50), rng.choice(INSULTS))
        rows.append((i, " ".join(words)))
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs_of(rows), model).collect()}
    assert np.mean([got[i] >= 0.5 for i in range(300) if i % 3 == 0]) >= 0.98
    assert np.mean([got[i] >= 0.5 for i in range(300) if i % 3]) <= 0.01


def test_odd_texts(docs_of, odd_rows, model):
    got = toxicity.score(docs_of(odd_rows), model).collect()
    assert len(got) == len(odd_rows)
    assert {r["toxicity"] for r in got} == {model.score("")}
    assert model.score(None) == model.score("") < 0.5


def test_without_labels_nothing_is_toxic(docs_of, spark):
    empty = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.fit(toxicity.labelled(docs_of([(1, "a b")]), empty))
    assert model.score("a b") < 0.5
    assert toxicity.score(docs_of([]), model).collect() == []


def test_repeated_and_null_labels(docs_of, spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1), (3, 0)], "doc_id bigint, toxic int")
    rows = toxicity.labelled(docs_of([(1, "a"), (2, "b"), (3, None), (4, "c")]), labels).collect()
    assert {(r["doc_id"], r["toxic"]) for r in rows} == {(1, 1), (3, 0)}


def test_composition_of_transducers():
    a, b = Transducer(final={1: 1.0}), Transducer(final={0: 0.5})
    a.arc(0, "x", "y", 1, 0.5)
    a.arc(1, "z", "y", 1, 0.25)
    b.arc(0, "y", "w", 0, 0.5)
    weight, written = a.compose(b).best([("x", 1.0), ("z", 1.0)])
    assert (weight, written) == (0.5 * 0.5 * 0.25 * 0.5 * 0.5, "w")
    assert a.compose(b).best([("z", 1.0)]) == (0.0, "")


@pytest.mark.parametrize(
    ("text", "uses"),
    [
        ("we sent a blorg home", ["plain"]),
        ("you are a blorg", ["targeted"]),
        ("this was not a blorg", ["negated"]),
        ("someone said blorg today", ["reported"]),
        ("kill them now", ["threat"]),
        ("kill the lights", []),
        ("ich werde dich töten", ["threat"]),
        ("je vais te tuer", ["threat"]),
        ("te voy a matar", ["threat"]),
        ("killing you is easy", ["threat"]),
        ("you will be killed", ["threat"]),
        ("they will beat the record", []),
        ("he was killed in the war", []),
        ("you may burn the letter", []),
        ("you went home. a blorg stayed", ["plain"]),
        ("nothing here", []),
    ],
)
def test_uses_of_an_insult(text, uses):
    model = ToxicityModel({"blor": 4.0})
    assert [u for _, u in model.clauses(text)] == uses


def test_negated_and_reported_insults_can_weigh_less():
    model = ToxicityModel({"blor": 4.0}, uses={"plain": 1.0, "targeted": 1.2, "negated": 0.2, "reported": 0.5, "threat": 1.0})
    plain, targeted, negated, reported = map(model.score, ("a blorg", "you blorg", "not blorg", "said blorg"))
    assert negated < reported < plain < targeted
    assert negated < 0.5 <= plain


def test_clashing_names(docs_of, model):
    docs = docs_of([(1, "a blorg")]).withColumnRenamed("lang", "score")
    assert toxicity.score(docs, model, docs.columns).columns == [*docs.columns, "toxicity"]


def test_order_of_clauses_does_not_matter():
    uses = {"plain": 1.0, "targeted": 1.2, "negated": 0.2, "reported": 0.1, "threat": 1.0}
    model = ToxicityModel({"blor": 3.0, "zwic": 2.0}, uses=uses)
    clauses = ["he said blorg", "you blorg", "not a zwick", "kill you zwick", "a quiet day"]
    totals = {round(model.total(". ".join(order)), 9) for order in itertools.permutations(clauses)}
    assert totals == {round(3.0 * 1.2 + 2.0 * 0.2 + 3.0, 9)}
    assert model.total("He said blorg. You blorg.") == model.total("You blorg. He said blorg.") == model.total("you blorg")


def paths(symbols, reach=2):
    """Weight and use of every way to read the symbols, written out: kept or passed over words, then one match."""
    t = toxicity
    ends = {t.TARGET: {t.INSULT: "targeted"}, t.NEGATION: {t.INSULT: "negated"}, t.REPORT: {t.INSULT: "reported"},
            t.ADDRESS: {t.INSULT: "targeted", t.HARM: "threat"},
            t.OBJECT: {t.INSULT: "targeted", t.HARM: "threat", t.THREAT: "threat"},
            t.THREAT: dict.fromkeys((t.TARGET, t.ADDRESS, t.OBJECT), "threat")}
    for kept in itertools.product(*[[(s, 1.0)] if s == t.OTHER else [(s, 1.0), (t.OTHER, 0.5)] for s in symbols]):
        names, loss = [k for k, _ in kept], np.prod([w for _, w in kept])
        for i, name in enumerate(names):
            before = loss * 0.9 ** sum(n != t.OTHER for n in names[:i])
            if name == t.INSULT:
                yield before * 0.9, "plain"
            for j in range(i + 1, min(i + reach + 2, len(names))):
                if all(n == t.OTHER for n in names[i + 1 : j]) and names[j] in ends.get(name, {}):
                    yield before, ends[name][names[j]]


def test_best_path_is_the_best_of_all_paths():
    machine, rng = ToxicityModel({}).machine, random.Random(4)
    some = [list(s) for n in (1, 2, 3) for s in itertools.product(toxicity.CLASSES, repeat=n)]
    some += [rng.choices(toxicity.CLASSES, k=rng.randint(4, 7)) for _ in range(300)]
    for symbols in some:
        every = list(paths(symbols))
        weight, use = machine.best((s, 1.0) for s in symbols)
        best = max((w for w, _ in every), default=0.0)
        assert weight == pytest.approx(best), symbols
        assert use in {u for w, u in every if w > best - 1e-9} or not every and not use, symbols
