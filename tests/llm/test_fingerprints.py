from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from cargolake.llm import fingerprints
from cargolake.llm.base import byte_words
from tests.llm.conftest import prose


def bag(text):
    return Counter(byte_words(text))


def jaccard(a, b):
    words = set(a) | set(b)
    return sum(min(a[w], b[w]) for w in words) / sum(max(a[w], b[w]) for w in words) if words else 1.0


def cases():
    rows = [(i, prose(i, 30 + 9 * i)) for i in range(50)]
    for i in range(40):  # pairs with known likeness, neighbours in the order of ids
        words = prose(100 + i, 120).split(" ")
        rows += [(100 + 2 * i, " ".join(words)), (101 + 2 * i, " ".join(words[: 120 - 3 * i] + prose(300 + i, 3 * i).split(" ")))]
    return rows


def edited(rows):
    """doc_id -> (text, edited text, next text), by sorting all documents."""
    order = sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (-r[0], r[1]))
    out = {}
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        cut = len(text) // 3
        out[i] = (text, text[: len(text) - cut] + following[:cut], following)
    return out


@pytest.mark.parametrize("buckets", [1, 7, 8192])
def test_edits_and_likeness(docs_of, odd_rows, buckets):
    rows = cases() + [(1000 + r[0], *r[1:]) for r in odd_rows if r != odd_rows[-3]]
    rows = list({r[0]: r for r in rows}.values())
    got = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(docs_of(rows), buckets=buckets).collect()}
    want = edited(rows)
    assert len(got) == len(rows) == len(want)
    errors = []
    for i, (text, edit, following) in want.items():
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
        errors += [r["near_edited"] - jaccard(bag(text), bag(edit)), r["near_next"] - jaccard(bag(text), bag(following))]
    assert abs(np.mean(errors)) < 0.015
    assert np.std(errors) < 0.07


def test_one_document_is_its_own_next(docs_of):
    r = fingerprints.edited_fingerprints(docs_of([(5, "abcdef x y")])).first()
    assert r["near_next"] == 1.0
    assert r["edited_sha256"] == hashlib.sha256(b"abcdef abc").hexdigest()


def test_rows_with_equal_ids_and_without_ids_are_all_there(docs_of):
    got = fingerprints.edited_fingerprints(docs_of([(1, "a b"), (1, "a b"), (1, "c d"), (None, "e"), (7, None)])).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "1", "1", "7", "None"]


def test_no_documents(docs_of):
    assert fingerprints.edited_fingerprints(docs_of([])).collect() == []
    assert fingerprints.fingerprints(docs_of([])).collect() == []


def test_equal_bags_have_equal_fingerprints(docs_of):
    rows = [(1, "x y y z"), (2, "z  y\ny x"), (3, "x y z"), (4, None), (5, " ")]
    got = dict(fingerprints.fingerprints(docs_of(rows)).collect())
    assert got[1] == got[2] != got[3]
    assert got[4] == got[5] == fingerprints.NOTHING * fingerprints.SAMPLES


def test_weights_count(spark):
    """Samples follow the weights: of {a: 3, b: 1} a is sampled three times as often as b."""
    rows = [(i, 2 * i, 3) for i in range(300)] + [(i, 2 * i + 1, 1) for i in range(300)] + [(1000 + i, 2 * i, 3) for i in range(300)]
    counts = spark.createDataFrame(rows, "k bigint, term bigint, w0 bigint")
    got = dict(fingerprints.signatures(counts, ["k"], ["w0"]).collect())
    same = [
        sum(got[i][4 * k : 4 * k + 4] == got[1000 + i][4 * k : 4 * k + 4] for k in range(fingerprints.SAMPLES)) / fingerprints.SAMPLES
        for i in range(300)
    ]
    assert abs(np.mean(same) - 0.75) < 0.015


def test_weights_of_several_texts(spark):
    """A word's samples depend on its own weight alone, whatever it weighs in the other texts; null and 0 are no weight."""
    rows = [(1, 5, 2, 2, 2), (1, 6, 1, 3, 1), (1, 7, 4, None, 0), (1, 8, None, 1, 1), (2, 5, 0, None, 0), (3, None, 0, 0, 0), (3, 9, 0, 1, 2)]
    counts = spark.createDataFrame(rows, "k bigint, term bigint, w0 bigint, w1 bigint, w2 bigint")
    together = {r["k"]: r for r in fingerprints.signatures(counts, ["k"], ["w0", "w1", "w2"], 12).collect()}
    assert sorted(together) == [1, 2, 3]
    for w in ("w0", "w1", "w2"):
        alone = dict(fingerprints.signatures(counts.select("k", "term", w), ["k"], [w], 12).collect())
        assert alone == {k: r[f"f_{w}"] for k, r in together.items()}
    assert together[2]["f_w0"] == together[3]["f_w0"] == fingerprints.NOTHING * 12 != together[3]["f_w1"]


def test_samples_do_not_depend_on_how_many_share_a_row(spark):
    counts = spark.createDataFrame([(i % 5, i, 1 + i % 3) for i in range(60)], "k bigint, term bigint, w0 bigint")
    got = {n: dict(fingerprints.signatures(counts, ["k"], ["w0"], n).collect()) for n in (2, 20, 64)}
    for k, longest in got[64].items():
        assert [longest.startswith(got[n][k]) for n in (2, 20)] == [True, True]
    with pytest.raises(ValueError):
        fingerprints.signatures(counts, ["k"], ["w0"], 3)


def test_quantiles_are_not_constants_of_the_plan(docs_of):
    """Constant arrays stand in the generated code once per use, each with an object per number."""
    plan = fingerprints.edited_fingerprints(docs_of([(1, "a b c")]))._jdf.queryExecution().optimizedPlan().toString()
    first = repr(fingerprints.gamma_quantiles(np.array([0.5 / (1 << fingerprints.TABLE_BITS)])).tolist()[0])
    assert first[:10] not in plan


def test_quantiles_of_the_gamma_table():
    shares = np.array([0.05, 0.5, 0.95])
    x = fingerprints.gamma_quantiles(shares)
    assert np.allclose(1 - (1 + x) * np.exp(-x), shares)


@pytest.mark.parametrize("marker", ["Python", "Pandas", "Arrow"])
def test_plan_is_native(docs_of, marker):
    plan = fingerprints.edited_fingerprints(docs_of([(1, "a b c")]))._jdf.queryExecution().toString()
    assert marker not in plan
