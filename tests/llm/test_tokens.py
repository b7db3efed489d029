"""Byte-level BPE, wavelet matrices and token files."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from cargolake.llm import token_store
from cargolake.llm.byte_bpe import PieceEncoder, encoder
from cargolake.llm.wavelet import BitPlane, WaveletMatrix
from tests.llm.conftest import prose

ODD = ["a", "B", "é", " ", "  ", "\n", "\t", "\r\n", ".", "'s", "'", "12", "_", " ", "　", "日本", "\x85", "\x1c", "\x0b", "×", "ǆ", "²", "<|endoftext|>", "\0", "😀", "x'll", "\x7f"]


def test_ids_are_those_of_the_library():
    tool, rng = encoder(), random.Random(4)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(4000)] + [prose(1, 300)]
    for text, ids in zip(texts, tool.encode(texts)):
        assert ids.tolist() == tool.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_the_cache_is_bounded():
    tool = PieceEncoder(cache_pieces=20)
    for i, ids in enumerate(tool.encode([prose(i, 30) for i in range(20)])):
        assert ids.tolist() == tool.tokenizer.encode(prose(i, 30), add_special_tokens=False).ids
        assert max(len(tool.cache), len(tool.old)) <= 20 + 30


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=400), st.integers(0, 300))
def test_wavelet_matrix_agrees_with_the_sequence(values, symbol):
    values = np.array(values, np.uint16)
    matrix = WaveletMatrix.from_bytes(WaveletMatrix.of(values, 9).to_bytes())
    assert matrix.values().tolist() == values.tolist()
    assert matrix.access(np.arange(len(values))).tolist() == values.tolist()
    assert matrix.count(symbol) == (values == symbol).sum()
    half = len(values) // 2
    assert matrix.count(symbol, half) == (values[half:] == symbol).sum()
    assert matrix.occurrences(symbol).tolist() == np.flatnonzero(values == symbol).tolist()


def test_select_is_the_inverse_of_rank():
    bits = np.random.default_rng(1).random(1000) < 0.3
    plane = BitPlane.of(bits)
    assert plane.select(np.arange(bits.sum()), True).tolist() == np.flatnonzero(bits).tolist()
    assert plane.select(np.arange((~bits).sum()), False).tolist() == np.flatnonzero(~bits).tolist()


@pytest.mark.parametrize("shard_tokens", [50, 1 << 21])
def test_files_hold_all_documents_in_order(docs_of, odd_rows, tmp_path, shard_tokens):
    docs = docs_of(odd_rows + [(None, "no id")]).withColumnRenamed("lang", "path").withColumnRenamed("source", "part")
    manifest = token_store.write_tokens(docs, str(tmp_path / "tokens"), shard_tokens=shard_tokens, range_docs=4)
    got = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in token_store.read_documents(manifest).collect()]
    tool = encoder()
    given = sorted(odd_rows + [(None, "no id")], key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, at = [], 0
    for row in given:
        ids = tool.tokenizer.encode(row[1] or "", add_special_tokens=False).ids + [0]
        want.append((row[0], at, ids))
        at += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    files = [r["path"] for r in manifest.collect()]
    assert all(f.startswith("file:///") for f in files)
    # look-ups from the files alone
    token = want[-1][2][0]
    places = [p for f in files for p in token_store.TokenShard.open(f).occurrences(token)]
    assert sorted(places, key=str) == sorted(((d, i) for d, _, ids in want for i, x in enumerate(ids) if x == token), key=str)
    assert token_store.token_counts(manifest, [token]).first()["n"] == len(places)
    first = token_store.TokenShard.open(min(files))
    assert [first.document(i).tolist() for i in range(len(first.doc_ids))] == [ids.tolist() for _, ids in first.documents()]


def test_no_documents(docs_of, tmp_path):
    manifest = token_store.write_tokens(docs_of([]), str(tmp_path / "none"))
    assert manifest.collect() == []
    assert token_store.read_documents(manifest).collect() == []


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="not a token shard"):
        token_store.TokenShard.from_bytes(b"PAR1")


def test_pieces_of_plain_texts_are_those_of_the_library():
    import random

    from cargolake.llm import byte_bpe

    tool, rng = byte_bpe.PieceEncoder(), random.Random(3)
    parts = ["'", "''", "'s", "'t", "'re", "'ll", " '", "s", "r", "e", "l", " ", "  ", "\t", "\n", " \n", "\r\n", "\x0b", "a", "Z",
             "9", "12", "é", "ɏ", "À", "×", "÷", ".", "!", "_", "\0", "\x1b", "\x7f", "日", "\x1c", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(20_000)] + [None, "", "", " " * 70_000, "'"]
    for text, ids in zip(texts, tool.encode(texts), strict=True):
        assert ids.tolist() == tool.tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_texts_split_together_in_small_groups(monkeypatch):
    from cargolake.llm import byte_bpe

    texts = ["one two", None, "three's", "日本", "four  five\n", "six"] * 50
    want = [ids.tolist() for ids in byte_bpe.PieceEncoder().encode(texts)]
    monkeypatch.setattr(byte_bpe, "TOGETHER", 20)
    assert [ids.tolist() for ids in byte_bpe.PieceEncoder(cache_pieces=2).encode(texts)] == want
