from __future__ import annotations

import random

import pytest

import numpy as np
from cargolake.llm import language
from tests.llm.conftest import document

STEMS = {"en": "the of and to in th er ing".split(), "de": "der und sch ein ung ver ß".split(), "fr": "le et les eau è tion que".split()}


def text(lang, seed, words=30):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="module")
def model(docs_of):
    rows = [(100 * k + i, text(lang, i), lang) for k, lang in enumerate(STEMS) for i in range(60)]
    return language.fit(docs_of(rows + [(900, "xx yy", None), (901, None, "en")]))


def test_held_out_texts(docs_of, model):
    rows = [(10 * i + k, text(lang, 5000 + i, 8), lang) for i in range(40) for k, lang in enumerate(STEMS)]
    got = language.identify(docs_of(rows), model, ["doc_id", "lang"]).collect()
    assert len(got) == len(rows)
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_unseen_words_fall_back_to_shorter_ngrams(model):
    assert model.languages == ["de", "en", "fr"]
    for word, lang in (("schverungsch", "de"), ("tioneaulès", "fr"), ("therandingof", "en")):
        assert word not in model.words
        assert model.predict(word)[0] == lang
    assert list(language.grams("ab")) == [["^a", "a"], ["^ab", "ab", "b"], ["^ab$", "ab$", "b$"]]


def test_odd_texts(docs_of, odd_rows, model):
    got = {r["doc_id"]: r for r in language.identify(docs_of(odd_rows), model).collect()}
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} == {1, 2, 3}
    assert all(r["score"] == 0 for r in got.values() if r["lang_pred"] == "und")
    assert model.predict("12 34 ...") == ("und", 0.0)
    assert model.predict("日本")[0] == "de"  # no known n-gram: the first by name


def test_scores_do_not_depend_on_other_columns(docs_of, model):
    a = language.identify(docs_of([(1, text("fr", 1), "en", "a")]), model).first()
    b = language.identify(docs_of([(1, text("fr", 1), None, None)]), model).first()
    assert (a["lang_pred"], a["score"]) == (b["lang_pred"], b["score"])


def test_clashing_names_and_no_documents(docs_of, spark, model):
    docs = docs_of([(1, text("de", 1))]).withColumnRenamed("lang", "kept").withColumnRenamed("source", "found")
    assert language.identify(docs, model, docs.columns).columns == [*docs.columns, "lang_pred", "score"]
    assert language.identify(docs_of([]), model).collect() == []


def test_without_training_rows_nothing_is_determined(docs_of):
    model = language.fit(docs_of([]))
    assert model.predict("some text") == ("und", 0.0)


def test_the_sample_is_bounded(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    assert 800 <= language.bounded_sample(rows, 1000).count() <= 1200
    assert language.bounded_sample(rows.limit(50), 1000).count() == 50
    assert document(1, None)[4] is None


def test_numerals_are_no_letters():
    model = language.LanguageModel(["de", "en"], {"und": 0}, {"a": 1}, np.array([[1.0, -1.0], [0.5, -0.5]], np.float32))
    for text in ("½ ²", "Ⅷ ① ½", "12 _ ²³", "", None):
        assert model.predict(text) == (language.UNDETERMINED, 0.0)
    assert model.predict("½ und ²")[0] == "de" and model.predict("½ und ²") == model.predict("und")
    assert model.predict("x²")[0] == "de"  # a letter with a numeral is a word
