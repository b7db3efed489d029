from __future__ import annotations

import zlib

import numpy as np
import pytest

from cargolake.llm import packing
from cargolake.llm.byte_bpe import default_path
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_path())


def check(rows, capacity, tokenizer, given):
    """Every piece is where its document has it, and sequences are filled without gaps."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc_id, text in given.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for n, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (n, at)
            assert r["length"] == capacity or n == 0
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            assert r["ids"] == ids[at : at + r["length"]].tolist()
            at += r["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity


@pytest.mark.parametrize("capacity", [64, 1024])
def test_pieces_and_sequences(docs_of, odd_rows, tokenizer, capacity):
    rows = [r for r in odd_rows if r[0] != 6] + [(100 + i, prose(i, 3 + 7 * i)) for i in range(60)]
    got = packing.best_fit_pack(docs_of(rows), capacity, with_ids=True).collect()
    check(got, capacity, tokenizer, {r[0]: r[1] for r in rows})


def test_repeated_rows_are_packed_each(docs_of):
    rows = packing.best_fit_pack(docs_of([(1, "a b"), (1, "a b"), (1, None)]), 16).collect()
    assert len(rows) == 3
    assert sum(r["length"] for r in rows) == 7


def test_no_documents(docs_of):
    assert packing.best_fit_pack(docs_of([]), 16).collect() == []


def test_other_columns_are_not_read(docs_of):
    docs = docs_of([(1, "a b")]).withColumnRenamed("lang", "length").withColumnRenamed("source", "task")
    assert packing.best_fit_pack(docs, 16).count() == 1


@pytest.mark.parametrize("seed", range(4))
def test_sequences_are_few(seed):
    rng = np.random.default_rng(seed)
    capacity = 256
    lengths = np.minimum(rng.geometric(1 / 60, 20_000), capacity)
    demand = np.bincount(lengths, minlength=capacity + 1)[1:]
    found = packing.solve(demand, capacity)
    used = sum(times for _, times in found)
    assert (sum(counts * times for counts, times in found) == demand).all()
    assert all((counts * np.arange(1, capacity + 1)).sum() <= capacity for counts, _ in found)
    assert used <= 1.002 * -(-int(lengths.sum()) // capacity) + 1


def test_lengths_beyond_half_a_sequence_cannot_share():
    demand = np.zeros(10, int)
    demand[[5, 6, 3]] = 8, 4, 12  # lengths 6, 7 and 4
    assert sum(t for _, t in packing.solve(demand, 10)) == 14  # 8 of (6, 4), 4 of (7), 2 of (4, 4)


def test_knapsack_agrees_with_all_choices():
    rng = np.random.default_rng(2)
    for _ in range(20):
        price = rng.random(6) * (rng.random(6) < 0.7)
        best = max(
            sum(n * p for n, p in zip(c, price))
            for c in np.ndindex(*[9 // (i + 1) + 1 for i in range(6)])
            if sum(n * (i + 1) for i, n in enumerate(c)) <= 9
        )
        padded = np.zeros(9)
        padded[:6] = price
        counts = packing.knapsack(padded, 9)
        assert (counts * np.arange(1, 10)).sum() <= 9
        assert (counts * padded).sum() == pytest.approx(best)
