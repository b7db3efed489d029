from __future__ import annotations

import random

import numpy as np
import pytest

from cargolake.llm import merge_dropout
from tests.llm.conftest import prose

ODD = ["a", "the", " ", "  ", "é", "日本", "\n", "\t", "x", "ing", "😀", "ü", "<s>", "12", "", "\0", ".", "x², ", "e.g.", "a,b", "...", "$5"]


@pytest.fixture(scope="module")
def codec():
    return merge_dropout.PieceCodec()


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=merge_dropout.default_path())


def texts(extra=()):
    rng = random.Random(6)
    return ["".join(rng.choice([*ODD, *extra]) for _ in range(rng.randint(0, 12))) for _ in range(1500)] + [prose(i, 40) for i in range(20)]


def test_without_dropout_ids_are_those_of_the_library(codec, library):
    for text in texts():
        assert codec.encode(text).tolist() == library.encode(text), repr(text)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.6, 1.0])
def test_round_trip(codec, dropout):
    tool = merge_dropout.PieceCodec()
    for i, text in enumerate(texts(["▁", "▁▁ "])):
        assert tool.decode(tool.encode(text, 3, dropout, i)) == text


def test_segmentations_vary_and_can_be_repeated():
    a, b, c = merge_dropout.PieceCodec(), merge_dropout.PieceCodec(), merge_dropout.PieceCodec()
    text = prose(1, 400)
    first = a.encode(text, 1, 0.2, 5)
    assert first.tolist() == b.encode(text, 1, 0.2, 5).tolist()
    assert first.tolist() != c.encode(text, 2, 0.2, 5).tolist()
    assert first.tolist() != a.encode(text, 1, 0.2, 6).tolist()
    assert len(first) > len(merge_dropout.PieceCodec().encode(text))


def test_frequent_words_are_cut_anew_in_every_place_and_document():
    tool = merge_dropout.PieceCodec()
    unit = merge_dropout.BLANK + "international"
    cuts = {tool.encode("international", 3, 0.3, i).tobytes() for i in range(300)}
    assert len(cuts) > 10
    for i in range(300):  # as the agenda with a skip for each candidate
        drawn = int(merge_dropout.draws(3, i, 1)[0])
        below = int(0.3 * 2**32)
        want = tool._unit(unit, merge_dropout.Drawn(drawn, below))
        assert tool.encode("international", 3, 0.3, i).tobytes() == want
    assert len(tool.candidates(unit)) > 5
    repeated = tool.encode("the and with " * 400, 3, 0.1, 8).tolist()
    assert len(set(map(tuple, np.array_split(repeated, 400)))) > 2
    even = [tool.encode(prose(5, 100), 1, 0.1, i).tobytes() for i in range(0, 40, 2)]
    assert len(set(even)) == len(even)


def test_the_share_of_skipped_merges(codec):
    below = int(0.3 * 2**32)
    skips = [merge_dropout.skipped(drawn * 0x9E3779B1 & merge_dropout.MASK | 1, place, length, below)
             for drawn in range(1, 60) for place in range(12) for length in range(2, 10)]
    assert abs(np.mean(skips) - 0.3) < 0.03
    everything = codec.encode("abc abc", 0, 1.0).tolist()  # all merges skipped: characters
    assert [codec.raw[i] for i in everything] == [b" ", b"a", b"b", b"c", b" ", b"a", b"b", b"c"]


def by_hand(library, unit, seed, document, place_of_unit, dropout):
    """Ids of a unit from the model's own scores: all pairs are listed again after every merge, skips judged one by one."""
    def score(piece):
        i = library.piece_to_id(piece)
        plain = i != library.unk_id() and not library.is_byte(i) and not library.is_control(i)
        return library.get_score(i) if plain else None

    drawn = int(merge_dropout.draws(seed, document, place_of_unit)[-1])
    parts = [(i, c) for i, c in enumerate(unit)]
    while True:
        best = None
        for k, ((i, a), (_, b)) in enumerate(zip(parts, parts[1:])):
            found = score(a + b)
            if found is None or merge_dropout.skipped(drawn, i, len(a + b), int(dropout * 2**32)):
                continue
            if best is None or found > best[0]:
                best = found, k
        if best is None:
            break
        k = best[1]
        parts[k : k + 2] = [(parts[k][0], parts[k][1] + parts[k + 1][1])]
    out = []
    for _, p in parts:
        known = score(p) is not None
        out += [library.piece_to_id(p)] if known else [library.piece_to_id(f"<0x{b:02X}>") for b in p.encode()]
    return out


@pytest.mark.parametrize("dropout", [0.1, 0.5])
def test_agendas_side_by_side_against_one_by_hand(codec, library, dropout):
    rng = random.Random(9)
    letters = ["a", "n", "t", "i", "on", "the", "é", "ü", "日", "x"]
    words = ["".join(rng.choice(letters) for _ in range(n)) for n in [*range(1, 30), 33, 47, 48, 49, 63, 64, 65, 90]]
    words += ["international", "understanding", "=" * 70, "misunderstandings" * 5]
    for document in range(6):
        rng.shuffle(words)
        got = codec.encode(" ".join(words), 11, dropout, document).tolist()
        want = [by_hand(library, merge_dropout.BLANK + w, 11, document, k + 1, dropout) for k, w in enumerate(words)]
        assert got == [i for ids in want for i in ids]


def test_a_text_is_cut_alike_alone_and_among_others(codec):
    many = texts(["▁"])
    together = codec.encode_batch([*many, None, ""], 4, 0.2, range(len(many) + 2))
    for i, text in enumerate(many):
        assert together[i].tolist() == codec.encode(text, 4, 0.2, i).tolist()
    assert [len(t) for t in together[-2:]] == [0, 0]
    assert codec.encode_batch([], 4, 0.2, []) == []


def test_batches_end_between_texts(codec, monkeypatch):
    many = texts()
    want = [t.tolist() for t in codec.encode_batch(many, 4, 0.2, range(len(many)))]
    monkeypatch.setattr(merge_dropout, "BATCH_CHARS", 100)
    monkeypatch.setattr(merge_dropout, "SIDE_BY_SIDE", 3)
    assert [t.tolist() for t in codec.encode_batch(many, 4, 0.2, range(len(many)))] == want


def test_a_unit_of_very_many_characters(codec, library):
    text = "abcdefgh" * 20_000
    assert codec.encode(text).tolist() == library.encode(text)
    assert codec.decode(codec.encode(text, 1, 0.3, 2)) == text


def test_skips_of_two_candidates_are_independent():
    below = int(0.3 * 2**32)
    drawn = merge_dropout.draws(5, 77, 40_000)
    places = [(i, n) for i in range(6) for n in range(2, 6)]
    skips = np.array([merge_dropout.skipped(drawn, np.int64(i), np.int64(n), below) for i, n in places])
    assert np.allclose(skips.mean(axis=1), 0.3, atol=0.015)
    together = (skips[:, None] & skips[None]).mean(axis=2)
    off = ~np.eye(len(places), dtype=bool)
    assert np.allclose(together[off], 0.09, atol=0.01)


def test_documents(docs_of, odd_rows):
    docs = docs_of(odd_rows + [(None, "no id")]).withColumnRenamed("lang", "raw")
    encoded = merge_dropout.encode_documents(docs, seed=1, dropout=0.2, keep=["doc_id", "raw"])
    assert encoded.columns == ["doc_id", "raw", "ids"]
    decoded = merge_dropout.decode_documents(encoded)
    got = sorted((str(r["doc_id"]), r["text"]) for r in decoded.collect())
    assert got == sorted((str(r[0]), r[1] or "") for r in odd_rows + [(None, "no id")])
    assert merge_dropout.encode_documents(docs_of([])).collect() == []
    both = merge_dropout.round_trip(docs, seed=1, dropout=0.2, keep=["doc_id"]).collect()
    assert sorted((str(r["doc_id"]), r["decoded"]) for r in both) == got
    assert sorted(bytes(r["ids"]) for r in both) == sorted(bytes(r["ids"]) for r in encoded.collect())
