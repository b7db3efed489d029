"""SentencePiece encoding with seeded merge-dropout, and decoding.

The model's pieces and scores come from its file; nothing is trained. A text is
cut into units that no piece crosses (before a run of blanks, around a line
end, between a letter and a mark). In a unit the characters are merged by an agenda of candidate pairs, best
score first, leftmost on ties. Every candidate, a piece at a place, is skipped
for good if a mixed hash of place and length, keyed by seed, document and the unit's
place among the units, falls below the dropout, so every occurrence of a word is
cut anew. The same key gives the same segmentation on every machine. Without
dropout the ids are those of the library.

The agendas of all units of one length in a batch of texts run side by side: a
round takes the best candidate of every unit, merges it and looks up the two
pairs beside it. Units of more than ``LONGEST`` characters have an agenda each, a heap.

Characters without a piece, and a literal U+2581, which stands for a blank in
pieces, become bytes, so any text decodes to itself.
"""

from __future__ import annotations

import functools
import heapq
import re
from array import array
from collections.abc import Container, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cargolake.llm.base import mix

BLANK = "▁"  # the mark that stands for a blank in pieces
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
MARKS = r".,!?;:*&%$#|"  # no piece has a letter before one of these, so words end there
LONGEST = 64  # characters of a unit whose agenda runs beside others
WIDTHS = (*range(2, 17), 20, 24, 32, 48, LONGEST)  # shorter units are filled up to the next width
SIDE_BY_SIDE = 1 << 14  # units whose agendas run side by side
BATCH_CHARS = 1 << 20  # texts are encoded together up to this many characters
NEVER = np.iinfo(np.int32).max  # the key of a pair that is no candidate
GONE, NONE = (1 << 16) - 1, (1 << 16) - 2  # codes of a character inside a piece, and of one without a piece
MASK = (1 << 32) - 1
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def skipped(drawn, place, length, below: int):
    """Whether the candidate of ``length`` characters at ``place`` is skipped; ``drawn`` is the occurrence's keyed hash.

    Takes whole numbers or 64-bit arrays of them.
    """
    h = drawn + place * 0x9E3779B1 + length * 0x85EBCA77 & MASK
    h = (h ^ h >> 16) * 0x7FEB352D & MASK
    h = (h ^ h >> 15) * 0x46CA68B5 & MASK
    return (h ^ h >> 16) < below


def draws(seed: int, document: int | np.ndarray, n: int | np.ndarray) -> np.ndarray:
    """A 32-bit hash, held in 64 bits, for each of the ``n`` units of a document, or for the ``n`` th unit of each of many."""
    documents = np.asarray(document if isinstance(document, np.ndarray) else [document & (1 << 64) - 1], np.uint64)
    places = n if isinstance(n, np.ndarray) else np.arange(1, n + 1)
    key = mix(np.array([seed & (1 << 64) - 1], np.uint64)) + documents
    return (mix(mix(key * GOLDEN) + places.astype(np.uint64) * GOLDEN) >> np.uint64(32)).astype(np.int64)


class Drawn:
    """The skipped candidates of one occurrence, judged as they come up."""

    def __init__(self, drawn: int, below: int):
        self.drawn, self.below = drawn, below

    def __contains__(self, candidate: tuple[int, int]) -> bool:
        return skipped(self.drawn, *candidate, self.below)


class PairTable:
    """The piece that two neighbouring codes make, ``NONE`` if none; open addressing over arrays."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        keys = np.array([a << 16 | b for a, b in pairs], np.int64)
        pieces = np.array(list(pairs.values()), np.int32)
        self.bits = max(int(len(pairs) * 4).bit_length(), 4)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.pieces = np.full(1 << self.bits, NONE, np.int32)
        slots = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] < 0)
            self.keys[slots[free]] = keys[free]  # of several keys for a free slot the last stays
            here = self.keys[slots] == keys
            self.pieces[slots[here]] = pieces[here]
            keys, pieces, slots = keys[~here], pieces[~here], self._next(slots[~here])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * 0x9E3779B1 & MASK) >> 32 - self.bits

    def _next(self, slots: np.ndarray) -> np.ndarray:
        return slots + 1 & (1 << self.bits) - 1

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 16 | right
        slots = self._slot(keys)
        held = self.keys[slots]
        found = np.where(held == keys, self.pieces[slots], NONE)
        on = np.flatnonzero((held != keys) & (held >= 0))
        slots = slots[on]
        while len(on):
            slots = self._next(slots)
            held = self.keys[slots]
            here = held == keys[on]
            found[on[here]] = self.pieces[slots[here]]
            more = ~here & (held >= 0)
            on, slots = on[more], slots[more]
        return found


class PieceCodec:
    """Encoder and decoder of one merge-type model with byte fallback, a blank put before the text and no normalisation."""

    def __init__(self, path: str | None = None):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path or default_path())
        self.ids: dict[str, int] = {}
        scores: dict[int, float] = {}
        self.raw: list[bytes] = []
        self.bytes = np.zeros(256, np.uint16)
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.raw.append(b"")
            else:
                self.ids[piece] = i
                scores[i] = model.get_score(i)
                self.raw.append(piece.replace(BLANK, " ").encode())
        crossing = re.compile(rf"[^{BLANK}]{BLANK}|\n.|.\n|[{LETTERS}][{MARKS}]", re.DOTALL)
        if any(crossing.search(p) for p in self.ids):
            raise ValueError("pieces of this model cross blanks, line ends or the ends of words")
        if len(self.raw) >= NONE or any(c not in self.ids for p in self.ids for c in p):
            raise ValueError("this model has too many pieces, or pieces with characters that are no pieces")
        # pieces of equal score have one rank
        ranks = {score: r for r, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = np.array([ranks.get(scores.get(i), NEVER) for i in range(len(self.raw))], np.int32)
        self.pairs = {
            (self.ids[p[:k]], self.ids[p[k:]]): i
            for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids
        }
        self.table = PairTable(self.pairs)
        self.longest = max(map(len, self.ids), default=1)
        self.code_of = np.full(0x110000, NONE, np.uint16)
        for p, i in self.ids.items():
            if len(p) == 1 and p not in (" ", BLANK):
                self.code_of[ord(p)] = i
        self.code_of[ord(" ")] = self.ids.get(BLANK, NONE)
        self.letter, self.mark = np.zeros((2, 0x110000), bool)
        for c in range(0x250):
            self.letter[c] = re.match(rf"[{LETTERS}]", chr(c)) is not None
        self.mark[[ord(c) for c in MARKS]] = True

    def _agenda(self, codes: list[int], gone: Container[tuple[int, int]] = ()) -> list[int]:
        """The code at each character after the merges of one unit, ``GONE`` inside a piece; a heap of candidates."""
        codes, end = list(codes), len(codes)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap: list[tuple[int, int, int, int]] = []  # rank, place, end of the pair, piece

        def enter(i: int) -> None:
            j = after[i]
            piece = self.pairs.get((codes[i], codes[j])) if j < end else None
            if piece is not None and not (gone and (i, after[j] - i) in gone):
                heapq.heappush(heap, (int(self.rank[piece]), i, after[j], piece))

        for i in range(end):
            enter(i)
        while heap:
            _, i, stop, piece = heapq.heappop(heap)
            if codes[i] == GONE or after[i] >= end or after[after[i]] != stop:
                continue  # a merge beside it came first
            codes[after[i]], codes[i] = GONE, piece
            after[i] = stop
            if stop < end:
                before[stop] = i
            enter(i)
            if before[i] >= 0:
                enter(before[i])
        return codes

    def _unit(self, unit: str, gone: Container[tuple[int, int]] = ()) -> bytes:
        """Ids of a unit, whose blanks are given by their mark."""
        out = array("H")
        for c, code in zip(unit, self._agenda([self.ids.get(c, NONE) for c in unit], gone)):
            if code == NONE:
                out.extend(self.bytes[list(c.encode("utf-8", "surrogatepass"))].tolist())
            elif code != GONE:
                out.append(code)
        return out.tobytes()

    def candidates(self, unit: str) -> list[tuple[int, int]]:
        """Place and length of every piece in a unit that merges can reach."""
        reached: set[tuple[int, int]] = {(i, 1) for i in range(len(unit))}
        found = []
        for length in range(2, min(self.longest, len(unit)) + 1):
            for i in range(len(unit) - length + 1):
                if unit[i : i + length] in self.ids and any(
                    (i, k) in reached and (i + k, length - k) in reached for k in range(1, length)
                ):
                    found.append((i, length))
                    reached.add((i, length))
        return found

    def _keys(self, left, right, place, length, drawn: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
        """Piece of each pair, and what the best candidate is the least of: rank, then place; ``NEVER`` if none or skipped."""
        found = self.table.find(left, right)
        keys = np.full(len(found), NEVER, np.int32)
        hit = np.flatnonzero(found != NONE)
        at = place[hit]
        key = self.rank[found[hit]] * LONGEST + at
        if below:
            key[skipped(drawn[hit], at, length[hit], below)] = NEVER
        keys[hit] = key
        return found, keys

    def _side_by_side(self, codes: np.ndarray, drawn: np.ndarray, below: int) -> np.ndarray:
        """Codes after the merges of units of one width, a column each; ``GONE`` inside a piece."""
        width, n = codes.shape
        codes = np.vstack([codes.astype(np.int64), np.full((1, n), NONE, np.int64)]).ravel()
        # flat places of the neighbours; those beyond the ends are in the row of no character
        after = np.arange(n, (width + 2) * n)
        after[-n:] = np.arange(width * n, (width + 1) * n)
        before = np.arange(-n, width * n)
        before[:n] = np.arange(width * n, (width + 1) * n)
        inner = (width - 1) * n
        made, flat = np.full(((width + 1) * n), NONE, np.int32), np.full((width + 1) * n, NEVER, np.int32)
        made[:inner], flat[:inner] = self._keys(
            codes[:inner], codes[n : inner + n], np.repeat(np.arange(width - 1), n), np.full(inner, 2),
            np.tile(drawn, width - 1), below,
        )
        keys = flat[:inner].reshape(width - 1, n)
        while True:
            best = keys.min(axis=0)
            live = np.flatnonzero(best != NEVER)
            if not len(live):
                return codes[: width * n].reshape(width, n)
            key = best[live]
            place = (key % LONGEST).astype(np.int64)
            i, mine = place * n + live, drawn[live]
            j = after[i]
            stop = after[j]
            piece = made[i].astype(np.int64)
            codes[i], codes[j], flat[j] = piece, GONE, NEVER
            after[i], before[stop] = stop, i
            end = stop // n
            made[i], flat[i] = self._keys(piece, codes[stop], place, after[stop] // n - place, mine, below)
            prior = before[i]
            made[prior], flat[prior] = self._keys(codes[prior], piece, prior // n, end - prior // n, mine, below)

    def _encode(self, texts: Sequence[str], seed: int, below: int, documents: Sequence[int]) -> list[np.ndarray]:
        """Ids of texts, none of them empty."""
        points = np.frombuffer("".join([" " + t for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
        firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        codes, line = self.code_of[points], points == 10
        blank = points == 32
        starts = line.copy()
        starts[1:] |= line[:-1] | blank[1:] & ~blank[:-1] | self.mark[points[1:]] & self.letter[points[:-1]]
        starts[firsts[:-1]] = True
        begin = np.flatnonzero(starts)
        lengths = np.diff(np.append(begin, len(points)))
        drawn = np.zeros(len(begin), np.int64)
        if below:
            of_text = np.searchsorted(begin, firsts)
            counts = np.diff(of_text)
            keys = np.array([d & (1 << 64) - 1 for d in documents], np.uint64)
            drawn = draws(seed, np.repeat(keys, counts), np.arange(1, len(begin) + 1) - np.repeat(of_text[:-1], counts))
        order = np.argsort(np.minimum(lengths, LONGEST + 1).astype(np.uint8), kind="stable")
        bounds = np.searchsorted(lengths[order], [1, *WIDTHS], "right")
        padded = np.append(codes, np.full(LONGEST, NONE, np.uint16))
        for width, low, high in zip(WIDTHS, bounds, bounds[1:]):
            for at in range(low, high, SIDE_BY_SIDE):
                units = order[at : min(at + SIDE_BY_SIDE, high)]
                cells = begin[units] + np.arange(width)[:, None]
                inside = np.arange(width)[:, None] < lengths[units]
                merged = self._side_by_side(np.where(inside, padded[cells], NONE), drawn[units], below)
                codes[cells[inside]] = merged[inside]
        for u in order[bounds[-1] :].tolist():
            span = slice(begin[u], begin[u] + lengths[u])
            codes[span] = self._agenda(codes[span].tolist(), Drawn(int(drawn[u]), below) if below else ())
        kept = np.flatnonzero(codes != GONE)
        ids, bare = codes[kept], codes[kept] == NONE
        stops = np.searchsorted(kept, firsts)
        if bare.any():
            others = points[kept[bare]]
            sizes = np.ones(len(kept), np.int64)
            sizes[bare] += (others >= 0x80).astype(np.int64) + (others >= 0x800) + (others >= 0x10000)
            raw = others.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
            ids = np.repeat(ids, sizes)
            ids[np.repeat(bare, sizes)] = self.bytes[np.frombuffer(raw, np.uint8)]
            stops = np.append(0, np.cumsum(sizes))[stops]
        return [ids[a:b] for a, b in zip(stops, stops[1:])]

    def encode_batch(self, texts: Sequence[str | None], seed: int, dropout: float, documents: Sequence[int]) -> list[np.ndarray]:
        """Ids of whole texts, each keyed by its document; a null or empty text has none."""
        out = [np.empty(0, np.uint16)] * len(texts)
        batch: list[int] = []
        chars = 0
        for i, text in enumerate([*texts, None]):
            if batch and (i == len(texts) or chars + len(text or "") > BATCH_CHARS):
                found = self._encode([texts[k] for k in batch], seed, int(dropout * 2**32), [documents[k] for k in batch])
                for k, ids in zip(batch, found):
                    out[k] = ids
                batch, chars = [], 0
            if text:
                batch.append(i)
                chars += len(text)
        return out

    def encode(self, text: str | None, seed: int = 0, dropout: float = 0.0, document: int = 0) -> np.ndarray:
        """Ids of a whole text; a null or empty text has none."""
        return self.encode_batch([text], seed, dropout, [document])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; exact for ids of ``encode``."""
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "surrogatepass")
        return text[1:] if text.startswith(" ") else text


@functools.cache
def codec(path: str | None) -> PieceCodec:
    """The worker's codec of one model."""
    return PieceCodec(path)


def encode_documents(
    docs: DataFrame,
    seed: int = 0,
    dropout: float = 0.1,
    model_path: str | None = None,
    keep: list[str | Column] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``ids``, 32-bit little-endian.

    Null and empty texts have no ids. Rows are encoded each by their doc_id and
    text, so repeated rows are encoded alike; a null doc_id counts as 0. An
    empty table gives an empty table.
    """

    @F.pandas_udf("binary")
    def run(texts: pd.Series, documents: pd.Series) -> pd.Series:
        found = codec(model_path).encode_batch(texts.tolist(), seed, dropout, documents.tolist())
        return pd.Series([ids.astype("<u4").tobytes() for ids in found], dtype=object)

    return docs.select(*keep, run(F.col("text"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0))).alias("ids"))


def decode_documents(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """``encoded`` with ``ids`` replaced by the ``text`` they stand for."""

    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        tool = codec(model_path)
        return pd.Series([None if i is None else tool.decode(np.frombuffer(i, "<u4")) for i in ids], dtype=object)

    others = [c for c in encoded.columns if c != "ids"]
    return encoded.select(*others, run(F.col("ids")).alias("text"))


def round_trip(
    docs: DataFrame,
    seed: int = 0,
    dropout: float = 0.1,
    model_path: str | None = None,
    keep: list[str | Column] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``ids`` and the ``decoded`` text, both made in one worker; as ``encode_documents``."""

    @F.pandas_udf("struct<ids: binary, decoded: string>")
    def run(texts: pd.Series, documents: pd.Series) -> pd.DataFrame:
        tool = codec(model_path)
        found = tool.encode_batch(texts.tolist(), seed, dropout, documents.tolist())
        rows = [(ids.astype("<u4").tobytes(), tool.decode(ids)) for ids in found]
        return pd.DataFrame(rows, columns=["ids", "decoded"])

    made = docs.select(F.struct(*keep).alias("kept"), run(F.col("text"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0))).alias("made"))
    return made.select("kept.*", "made.*")
