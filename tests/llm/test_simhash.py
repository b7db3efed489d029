from __future__ import annotations

import random
import re
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from cargolake.llm import simhash
from tests.llm.conftest import prose

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text, size=3):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_force(prints):
    """Roots by comparing all pairs of (id, fingerprint)."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(prints)), 2):
        if (prints[a][1] ^ prints[b][1]).bit_count() <= 2:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    groups = {}
    for i, (doc_id, _) in enumerate(prints):
        groups.setdefault(find(i), []).append(doc_id)
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    return sorted(((d, f"{p:016x}", least[find(i)]) for i, (d, p) in enumerate(prints)), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def near_copies_rows():
    rows, rng = [], random.Random(5)
    for base in range(25):
        text = prose(300 + base, 90)
        for copy in range(8):
            words = text.split()
            for _ in range(copy // 2):
                words[rng.randrange(len(words))] = rng.choice(["changed", "Word", "x"])
            rows.append((base * 8 + copy, " ".join(words)))
    return rows


def test_components_equal_comparing_all_pairs(docs_of, odd_rows):
    rows = near_copies_rows() + [(1000 + (i or 0), t, *r) for i, t, *r in odd_rows] + [(None, prose(300, 90)), (None, "alone of its kind")]
    want = brute_force([(i, plain_fingerprint(t)) for i, t, *_ in rows])
    assert result(simhash.near_copies(docs_of(rows))) == want
    assert len({c for *_, c in want}) < len({p for _, p, _ in want}) < len(rows)  # equal ones, and links between others


def test_blank_texts_have_the_fingerprint_zero_and_link(docs_of):
    found = result(simhash.near_copies(docs_of([(4, None), (3, ""), (9, " \n")])))
    assert found == [(i, "0" * 16, 3) for i in (3, 4, 9)]
    assert simhash.near_copies(docs_of([])).collect() == []


def test_hash_is_that_of_the_sql_function(spark):
    text = "ein Wort und 日本 mehr"
    ours = simhash.set_bits([text.encode()], 3)[0]
    value = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] & (1 << 64) - 1
    assert [int(b) for b in ours] == [value >> b & 1 for b in range(64)]


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = prose(7, 500)
    whole = simhash.fingerprint(text, 3)
    monkeypatch.setattr(simhash, "PART", 7)
    assert simhash.fingerprint(text, 3) == whole
    assert whole & (1 << 64) - 1 == plain_fingerprint(text)


def made_values():
    """Values zero to four bits apart, in one segment and across both, in a dense cluster and alone."""
    rng = random.Random(11)
    values = [0, -1, 1 << 62, -(1 << 63)]
    for _ in range(6):
        center = rng.getrandbits(64) - (1 << 63)
        for _ in range(60):
            flips = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
            flips -= (flips >> 63) << 64
            values.append(center ^ flips)
    return sorted(set(values))


def test_links_join_all_within_two_bits_and_no_others(spark):
    values = made_values()
    close = {(a, b) for a, b in combinations(values, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    found = {tuple(r) for r in simhash.links(spark.createDataFrame([(v,) for v in values], "value long")).collect()}
    assert found <= close
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        root[find(b)] = find(a)
    assert all(find(a) == find(b) for a, b in close)


@pytest.mark.parametrize("size", [1000, 2000])
def test_no_bucket_grows_with_a_cluster(spark, size):
    """Entries are 65 a fingerprint and links at most as many, however dense a cluster is."""
    dense = spark.range(size).select(F.col("id").alias("value"))
    assert simhash.links(dense).count() <= 65 * size


def test_extra_columns_with_clashing_names(spark):
    rows = spark.createDataFrame([(1, "a b c d", "x", 5, "k"), (2, "a b c d", "y", 6, "l")], "doc_id long, text string, value string, root long, key string")
    assert result(simhash.near_copies(rows)) == [(i, f"{plain_fingerprint('a b c d'):016x}", 1) for i in (1, 2)]
