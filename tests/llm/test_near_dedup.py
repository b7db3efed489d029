from __future__ import annotations

import math
import re
from itertools import combinations

import numpy as np
import pytest

from cargolake.llm import near_dedup
from cargolake.llm.components import components
from tests.llm.conftest import prose

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, size):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_force(rows, size, percent):
    """doc_id -> (set size, smallest reachable doc_id), by comparing all pairs."""
    sets = {i: shingle_set(t, size) for i, t, *_ in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: (len(s), find(i)) for i, s in sets.items()}


def changed(text, places, word="changed"):
    words = text.split(" ")
    for p in places:
        words[p] = f"{word}{p}"
    return " ".join(words)


def chain():
    """Near copies of near copies, over which components grow, and pairs just at and below the threshold."""
    rows, n = [], 0
    for base in range(4):
        text = prose(100 + base, 120)
        for step in range(8):
            rows.append((n, text))
            text = changed(text, [10 + 12 * step], f"w{base}")
            n += 1
    for base in range(10):
        text = prose(200 + base, 60 + base)
        rows += [(n, text), (n + 1, changed(text, range(5, 5 + base))), (n + 2, text.upper())]
        n += 3
    return rows


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_components_agree_with_all_pairs(docs_of, odd_rows, size, percent):
    rows = chain() + [(1000 + r[0], *r[1:]) for r in odd_rows]
    want = brute_force(rows, size, percent)
    got = near_dedup.near_duplicates(docs_of(rows), size, percent / 100).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_members_of_a_large_group_are_compared_across_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng, text = np.random.default_rng(5), prose(7, 90)
    rows = [(i, changed(text, rng.choice(90, rng.integers(0, 6), replace=False), f"v{i}")) for i in range(60)]
    want = brute_force(rows, 3, 85)
    got = near_dedup.near_duplicates(docs_of(rows), 3, 0.85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_no_documents(docs_of):
    assert near_dedup.near_duplicates(docs_of([]), 3, 0.85).collect() == []


def test_null_ids_follow_equal_texts(docs_of):
    rows = [(None, "a b c d"), (5, "a b c d"), (None, "x y z"), (None, None)]
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(docs_of(rows), 3, 0.85).collect()}
    assert got == {(None, 2, 5, False), (5, 2, 5, True), (None, 1, None, True), (None, 0, None, True)}


def test_kept_documents_keep_their_columns(docs_of):
    text = prose(3, 50)
    docs = docs_of([(1, text), (2, text), (3, prose(4, 50))]).withColumnRenamed("lang", "kept").withColumnRenamed("source", "key")
    kept = near_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_min_and_max_estimate_the_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(40):
        pool = rng.integers(0, 1 << 62, 300).astype(np.uint64)
        a, b = pool[:200], pool[60:260]
        entries = [np.stack(near_dedup.min_max(s), axis=1) for s in (a, b)]
        errors.append(near_dedup.agreement(entries[0].ravel(), entries[1].ravel()) - 140 / 260)
    assert abs(np.mean(errors)) < 0.03
    assert np.std(errors) < 0.06


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(3, 3), (9, 8), (8, 9)]
    got = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    want = {i: 100 for i in range(101, 141)} | {i: 7 for i in range(200, 260)} | {9: 8}
    assert got == want


def test_components_without_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("share", [0.8, 0.85])
def test_the_filter_before_full_sets_seldom_drops_a_pair_at_the_threshold(share):
    n = 2 * near_dedup.PERMUTATIONS
    below = [k for k in range(n + 1) if k / n < share - near_dedup.MARGIN]
    assert sum(math.comb(n, k) * share**k * (1 - share) ** (n - k) for k in below) < 1e-7


def without_hub(n):
    """Copies with one to three changed words of 90: most are near some others, and none is near all."""
    rng, text = np.random.default_rng(17), prose(21, 90)
    return [(i, changed(text, rng.choice(90, rng.integers(1, 4), replace=False), f"v{i}_")) for i in range(n)]


def test_a_group_without_a_hub_agrees_with_all_pairs(docs_of, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rows = without_hub(150)
    got = near_dedup.near_duplicates(docs_of(rows), 3, 0.85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_force(rows, 3, 85)


def test_no_table_grows_with_the_square_of_a_group(docs_of, monkeypatch):
    real, sizes = near_dedup.written, []

    def counted(df, *args, **options):
        out = real(df, *args, **options)
        sizes[-1].append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "written", counted)
    for n in (1000, 2000):
        sizes.append([])
        near_dedup.near_duplicates(docs_of(without_hub(n)), 3, 0.85).count()
    assert max(sizes[1]) <= 2.2 * max(sizes[0]) and sum(sizes[1]) <= 2.2 * sum(sizes[0])
