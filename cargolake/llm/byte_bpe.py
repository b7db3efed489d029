"""Byte-level BPE ids of whole texts by the ``tokenizers`` library, each distinct piece encoded once per worker.

The merges of a byte-level BPE never cross the pieces into which its pattern
splits a text, so the ids of a text are the ids of its pieces in a row. Texts
of plain characters are split here, many together, where the classes of the pattern are known
byte by byte; their distinct pieces are looked up, and only unseen ones go to the library's model. Any
other text goes to the library whole. The cache lives as long as the worker. When
it reaches ``cache_pieces`` it becomes the old one, from which pieces that come
again are taken over, so memory is bounded and common pieces stay.
"""

from __future__ import annotations

import functools
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

CACHE_PIECES = 400_000
TOGETHER = 1 << 22  # characters of texts that are split together

# The classes of the vocabulary's pattern for ASCII (but the separators 1C-1F) and the letters from
# U+00C0 to U+024F, by the bytes of UTF-8, and the endings that it splits off.
PLAIN = re.compile(r"[\x00-\x1b\x20-\x7fÀ-ɏ]*")
CLASSES = {"letter": rb"[A-Za-z\x80-\xfe]", "digit": rb"[0-9]", "blank": rb"[\t-\r ]", "close": rb"\xff"}
SIGNS = "×÷"
ENDINGS = "'s", "'t", "'re", "'ve", "'m", "'ll", "'d"
OTHER, LETTER, DIGIT, SPACE, END = range(5)
CLOSE = b"\xff"  # stands between texts, as no byte of one
CLASS_OF = np.array([
    next((k for k, pattern in enumerate(CLASSES.values(), 1) if re.fullmatch(pattern, bytes([b]))), OTHER) for b in range(256)
], np.uint8)


def piece_starts(raw: np.ndarray) -> np.ndarray:
    """Where the pieces of plain texts start, of which each is closed by a ``CLOSE`` that is a piece itself.

    A piece is a run of one class with at most one blank (20) before it, an
    ending at a place where a piece starts, or blanks: those before a
    text's end in one, others but for the last of their run.
    """
    kind = CLASS_OF[raw]
    for sign in SIGNS:
        first, second = sign.encode()
        at = np.flatnonzero((raw[:-1] == first) & (raw[1:] == second))
        kind[at] = kind[at + 1] = OTHER
    space, end = kind == SPACE, kind == END
    start = np.ones(len(raw), bool)
    start[1:] = (kind[1:] != kind[:-1]) & (raw[:-1] != 0x20) | end[1:] | end[:-1]
    # the last blank of a run before a word
    start[1:-1] |= space[1:-1] & space[:-2] & ~space[2:] & ~end[2:]
    # a run of blanks starts a piece, and continues it up to its last
    start[1:] |= space[1:] & ~space[:-1]
    quotes = np.flatnonzero(start & (raw == ord("'")))
    for ending in ENDINGS:
        letters = ending[1:].encode()
        at = quotes[quotes + len(letters) < len(raw)]
        for k, letter in enumerate(letters, 1):
            at = at[raw[at + k] == letter]
        start[at + 1] = False
        start[at + len(ending)] = True
    return np.flatnonzero(start)


def byte_symbols() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


SYMBOLS = byte_symbols()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class PieceEncoder:
    """Encodes texts to arrays of 16-bit ids (``add_special_tokens=False``)."""

    def __init__(self, path: str | None = None, cache_pieces: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or default_path())
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit into 16 bits")
        # the strings of special tokens, which the library matches before it splits
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.cache_pieces = cache_pieces
        self.cache: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint16)

    def _piece(self, piece: bytes) -> bytes:
        return array("H", [t.id for t in self.model.tokenize(piece.decode("latin-1").translate(SYMBOLS))]).tobytes()

    def _known(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces, from the cache or the model."""
        found = list(map(self.cache.get, pieces))
        for i, ids in enumerate(found):
            if ids is None:
                if len(self.cache) >= self.cache_pieces:
                    self.cache, self.old = {}, self.cache
                piece = pieces[i]
                found[i] = self.cache[piece] = self.old.get(piece) or self._piece(piece)
        return found

    def _plain(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of texts of plain characters."""
        raw = np.frombuffer(CLOSE.join([t.encode() for t in texts]) + CLOSE, np.uint8)
        begin = piece_starts(raw)
        offsets = np.append(begin, len(raw))
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begin), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)]
        ).dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        close = distinct.index(CLOSE)
        distinct[close] = b"a"
        known = self._known(distinct)
        known[close] = b""
        sizes = np.array(list(map(len, known))) // 2
        flat, firsts = np.frombuffer(b"".join(known), np.uint16), np.cumsum(sizes) - sizes
        at = pieces.indices.to_numpy()
        counts = sizes[at]
        stops = np.cumsum(counts)
        ids = flat[np.repeat(firsts[at] - stops + counts, counts) + np.arange(stops[-1])]
        start = 0
        for stop in stops[at == close].tolist():
            yield ids[start:stop]
            start = stop

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        held: list[str] = []
        chars = 0
        for text in texts:
            text = text or ""
            plain = PLAIN.fullmatch(text) and not any(s in text for s in self.special)
            if held and (not plain or chars + len(text) > TOGETHER):
                yield from self._plain(held)
                held, chars = [], 0
            if plain:
                held.append(text)
                chars += len(text)
            else:
                yield self._whole(text)
        if held:
            yield from self._plain(held)


@functools.cache
def encoder(path: str | None = None, cache_pieces: int = CACHE_PIECES) -> PieceEncoder:
    """The worker's encoder; it serves all tasks of the worker."""
    return PieceEncoder(path, cache_pieces)
