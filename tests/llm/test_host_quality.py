from __future__ import annotations

import re

import pytest
from hypothesis import given, settings, strategies as st

from cargolake.llm import host_quality
from tests.llm.conftest import prose

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, counted plainly."""
    text = text or ""
    words = WORDS.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def found(frame):
    q = "quality"
    rows = frame.select("doc_id", *[f"{q}.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed_base", "kept")])
    return [tuple(r) for r in rows.collect()]


def test_measures_of_odd_texts(docs_of, odd_rows):
    rows = [r for r in odd_rows if r[0] != 8] + [
        (20, "a b c d e f g\n" * 3), (21, "x\n\nx\n \n\t\nx \nx"), (22, "#*$%&|<> ### " + prose(1, 20)), (23, "p q r s t p q r s t p q r s"),
    ]
    got = found(host_quality.judge(docs_of(rows)))
    assert sorted(g[:6] for g in got) == sorted((r[0], *measured(r[1])) for r in rows)
    for g in got:
        assert g[6] == (g[1] < 10 or 100 * g[5] > 20 * g[1])


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab cd e f\ng".split(" ")), max_size=24), min_size=1, max_size=30))
def test_repeated_windows(docs_of, texts):
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = found(host_quality.judge(docs_of(rows, 1)))
    assert sorted(g[:6] for g in got) == sorted((i, *measured(t)) for i, t in rows)


def hosts():
    """A host of junk with two clean texts, a host known for symbols, and good hosts of several sizes."""
    rows, n = [], 0
    for host, junk, symbols, clean in [("junk", 98, 0, 2), ("marks", 0, 70, 30), ("good", 2, 2, 96), ("small", 1, 0, 2), ("b", 0, 0, 40), ("c", 1, 1, 40)]:
        for kind, times in (("junk", junk), ("marks", symbols), ("clean", clean)):
            for _ in range(times):
                text = {"junk": "too short", "marks": " ".join(w + "***" for w in prose(n, 30).split()), "clean": prose(n, 30)}[kind]
                rows.append((n, text, "en", host, kind))
                n += 1
    return rows


def test_hosts_are_judged_and_documents_follow(docs_of):
    rows = hosts()
    got = {g[0]: g[7] for g in found(host_quality.judge(docs_of([r[:4] for r in rows])))}
    kept = {}
    for n, _, _, host, kind in rows:
        kept.setdefault((host, kind), set()).add(got[n])
    assert kept["junk", "clean"] == {False}  # nearly everything on this host is junk
    assert kept["marks", "marks"] == {False}  # a rule the host is known for
    assert kept["marks", "clean"] == {True}
    assert kept["good", "marks"] == kept["c", "marks"] == {True}  # tolerated elsewhere
    assert all(v == {True} for (host, kind), v in kept.items() if kind == "clean" and host != "junk")
    assert all(v == {False} for (_, kind), v in kept.items() if kind == "junk")


def test_rates_of_small_hosts_are_drawn_to_the_common_rate(docs_of):
    scored = docs_of([r[:4] for r in hosts()])
    judged = host_quality.judge(scored)
    rates = {
        r["host"]: r["rate"]
        for r in host_quality.shrunk_rates(judged.select("source", "quality.*"), "source").where("rule = 'failed_base'").collect()
    }
    assert 0 < rates["small"] < 1 / 3 + 0.05
    assert rates["junk"] > 0.8
    assert rates["b"] > 0


def test_without_hosts_only_the_base_rule_counts(docs_of):
    rows = [(1, prose(1, 30), "en", None), (2, "short", "en", None)]
    assert {(g[0], g[7]) for g in found(host_quality.judge(docs_of(rows)))} == {(1, True), (2, False)}


def test_no_documents(docs_of):
    assert host_quality.judge(docs_of([])).collect() == []


def test_kept_documents_keep_their_columns(docs_of):
    docs = docs_of([(1, prose(1, 30)), (2, None), (3, prose(3, 30)), (3, prose(3, 30))])
    docs = docs.withColumnRenamed("lang", "host").withColumnRenamed("n_chars", "rate")
    kept = host_quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 3]


@pytest.mark.parametrize("marker", ["Python", "Pandas", "Arrow"])
def test_plan_is_native(docs_of, marker):
    plan = host_quality.judge(docs_of([(1, "a b c")]))._jdf.queryExecution().toString()
    assert marker not in plan
