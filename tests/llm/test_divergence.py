from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from cargolake.llm import divergence
from tests.llm.conftest import SYLLABLES

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute_force(rows, least_docs, top=50):
    """All six columns from dense counts."""
    docs = [(t or "", lang or "", source or "") for _, t, lang, source in rows]
    texts = [TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t, _, _ in docs]
    out = []
    for lang in {d[1] for d in docs}:
        held, uses = Counter(), defaultdict(Counter)
        for (_, own, source), words in zip(docs, texts):
            if own == lang:
                held.update(set(words))
                uses[source].update(words)
        kept = sorted(t for t, n in held.items() if n >= least_docs)
        total = Counter()
        for c in uses.values():
            total.update(c)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        of, whole = {s: shares(c) for s, c in uses.items()}, shares(total)
        for source, p in of.items():
            pairs = [(o, sum(abs(p[t] - q[t]) for t in kept)) for o, q in of.items() if o != source]
            terms = [(t, p[t] - whole[t]) for t in kept if uses[source][t] and p[t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(ordered, 1)]
    return sorted(out)


def made(seed, n, langs=("en", "de", None), sources=5):
    rng, rows = random.Random(seed), []
    words = SYLLABLES + ["Größe", "日本語", "ta", "l'été", "x1y", "TA"]
    for i in range(n):
        text = " ".join(rng.choices(words, k=rng.randint(0, 25)))
        rows.append((i, rng.choice([text, text, text, None, "copied Text an an", "--- 12"]), rng.choice(langs), f"s{rng.randrange(sources)}"))
    return rows


def result(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert [t for _, t in df.dtypes] == ["string", "string", "string", "string", "bigint", "int"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("least_docs", [1, 6, 30])
def test_all_rows_equal_dense_counts(docs_of, least_docs):
    rows = made(least_docs, 300) + [(1, "only here", "fr", None), (1, None, "it", "s1"), (None, None, None, None), (2, "", "fr", "s2")]
    found = result(divergence.audit(docs_of(rows, 5), least_docs=least_docs))
    assert found == brute_force(rows, least_docs)
    assert {r[2] for r in found} == {"pair", "term"}


def test_many_small_blocks_and_groups_give_the_same(docs_of, monkeypatch):
    rows = made(3, 200, sources=9)
    monkeypatch.setattr(divergence, "SOURCES_A_BLOCK", 2)
    monkeypatch.setattr(divergence, "TERMS_A_GROUP", 4)
    assert result(divergence.audit(docs_of(rows), least_docs=4)) == brute_force(rows, 4)


def test_sums_handed_on_early_add_up(docs_of, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 10)
    rows = made(5, 80)
    assert result(divergence.audit(docs_of(rows), least_docs=3)) == brute_force(rows, 3)


def test_copies_collapse_in_the_scan_and_count_each(docs_of):
    rows = [(i, "same words here", "en", f"s{i % 3}") for i in range(90)] + [(i, "other words", "en", "s0") for i in range(40)]
    counted = divergence.collapsed(docs_of(rows, 2)).collect()
    assert len(counted) <= 2 * 4  # a row per text, source and task
    total = Counter()
    for r in counted:
        total[r["text"], r["source"]] += r["times"]
    assert total == {("same words here", s): 30 for s in ("s0", "s1", "s2")} | {("other words", "s0"): 40}
    assert result(divergence.audit(docs_of(rows))) == brute_force(rows, 30)


def test_top_terms_alone_are_cut(docs_of):
    rows = [(i, " ".join(f"w{chr(97 + k)}{chr(97 + k // 3)}" for k in range(26)), "en", "a") for i in range(30)] + [(99, "", "en", "b")]
    found = result(divergence.audit(docs_of(rows), top=7))
    assert found == brute_force(rows, 30, top=7)


def test_empty_table_and_clashing_columns(spark, docs_of):
    assert divergence.audit(docs_of([])).collect() == []
    rows = made(9, 60)
    wide = docs_of(rows).selectExpr("*", "1 AS times", "'x' AS term", "2 AS uses", "3 AS base", "4 AS kept", "5 AS item", "6 AS rank")
    assert result(divergence.audit(wide, least_docs=2)) == brute_force(rows, 2)
