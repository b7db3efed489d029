"""License scan: winnowed fingerprints of templates pick candidates, banded alignment confirms them.

Templates and documents are words in lower case. Runs of ``GRAM`` words are
hashed and, of every ``WINNOW`` neighbouring hashes, the least is kept, so any
common passage of ``GRAM + WINNOW - 1`` words shares a fingerprint. An inverted
index from fingerprint to (template, place) gives the diagonals on which a
template may lie in a text. Around each, a banded alignment finds the longest
common sequence of words and reports its coverage of the template and its span.

The index holds the templates alone, so its size does not depend on the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F

from cargolake.llm.base import hash_words, window_hashes

GRAM = 2
WINNOW = 2
BAND = 4  # words that an alignment may drift, and an eighth of the template
COVERAGE = 0.8
SHORT = 16  # words of a template at most whose naming words must match exactly
WORD = re.compile(r"[^\W_]+")
# Words of short notices that name no license.
COMMON = frozenset("a an and code form international is license licensed of released source subject terms the this to under v version work".split())

# Words that tell the members of a family of licenses apart, as do whole numbers (versions).
FAMILY = "affero lesser library noncommercial nc sharealike sa noderivatives noderivs nd".split()

# Short notices of public licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

FAMILY_HASHES = frozenset(hash_words([w.encode() for w in (*FAMILY, *map(str, range(100)))]).tolist())
COMMON_HASHES = frozenset(hash_words([w.encode() for w in sorted(COMMON)]).tolist())

SCHEMA = (
    "license string, coverage double, matched_words int, first_word int, last_word int, first_char int, last_char int"
)


def hashes(text: str) -> np.ndarray:
    return hash_words([w.encode("utf-8", "surrogatepass") for w in WORD.findall(text.lower())])


def winnowed(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a word sequence and their places: the least (last on ties) of every few neighbouring hashes."""
    grams = window_hashes(words, GRAM)
    if len(grams) <= WINNOW:
        places = np.arange(len(grams))
    else:
        windows = sliding_window_view(grams, WINNOW)[:, ::-1]
        places = np.unique(np.arange(len(windows)) + WINNOW - 1 - windows.argmin(axis=1))
    return grams[places], places


def align(template: np.ndarray, words: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """Longest common sequence of words near a diagonal (place in the text less place in the template).

    Returns the number of words, and the places in the text of its first and
    last word; of equal ones the shortest span.
    """
    # states by offset from the diagonal: (matched, -first place), best is largest
    width = 2 * band + 1
    best = [(0, 0, -1)] * width  # matched, minus the first place, last place
    for i, word in enumerate(template):
        now: list[tuple[int, int, int]] = []
        for d in range(width):
            at = i + diagonal + d - band
            options = [best[d]]  # both move on: the word before is not matched here
            if d + 1 < width:
                options.append(best[d + 1])  # the template moves on
            if d:
                options.append(now[d - 1])  # the text moves on
            found = max(options, key=lambda s: (s[0], s[1] - s[2]))
            if 0 <= at < len(words) and words[at] == word:
                n, first, _ = best[d]
                hit = (n + 1, first if n else -at, at)
                found = max(found, hit, key=lambda s: (s[0], s[1] - s[2]))
            now.append(found)
        best = now
    n, first, last = max(best, key=lambda s: (s[0], s[1] - s[2]))
    return n, -first, last


def naming(words: np.ndarray) -> list[int]:
    """The words that tell one license from another: all but common ones."""
    return [w for w in words.tolist() if w not in COMMON_HASHES]


def same_member(template: np.ndarray, span: np.ndarray) -> bool:
    """Whether the family words and numbers of the span are some of the template's, in their order, if that has any."""
    wanted, found = ([w for w in words.tolist() if w in FAMILY_HASHES] for words in (template, span))
    rest = iter(wanted)
    return all(w in rest for w in found) and bool(found) == bool(wanted)


def names_it(template: np.ndarray, span: np.ndarray) -> bool:
    """Whether the span names the template's license and not another.

    From the first naming word of a short template on, a span must have just
    the template's naming words; that of a long one no other family words or
    numbers than the template.
    """
    if len(template) > SHORT:
        return same_member(template, span)
    wanted = naming(template)
    if not wanted:
        return True
    at = np.flatnonzero(span == np.uint64(wanted[0]))
    return any(naming(span[i:]) == wanted for i in at)


@dataclass
class Scanner:
    templates: dict[str, str]
    coverage: float = COVERAGE

    def __post_init__(self) -> None:
        self.names = sorted(self.templates)
        self.words = [hashes(self.templates[n]) for n in self.names]
        index: dict[int, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            for f, place in zip(window_hashes(words, GRAM).tolist(), range(len(words))):
                index.setdefault(f, []).append((t, place))
        self.index = index
        self.keys = np.sort(np.array(list(index), np.uint64))

    def candidates(self, words: np.ndarray) -> Iterator[tuple[int, int]]:
        """Templates and diagonals on which the text shares enough fingerprints with them."""
        prints, places = winnowed(words)
        at = np.searchsorted(self.keys, prints)
        known = (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == prints) if len(self.keys) else np.zeros(len(prints), bool)
        found: dict[int, list[int]] = {}
        for f, place in zip(prints[known].tolist(), places[known].tolist()):
            for t, own in self.index[f]:
                found.setdefault(t, []).append(place - own)
        for t, diagonals in found.items():
            need, band = self.needed(t), self.band(t)
            if len(diagonals) < need:
                continue
            diagonals.sort()
            i = 0
            while i < len(diagonals):
                j = i
                while j + 1 < len(diagonals) and diagonals[j + 1] - diagonals[i] <= band:
                    j += 1
                if j + 1 - i >= need:
                    yield t, (diagonals[i] + diagonals[j]) // 2
                    i = j + 1
                else:
                    i += 1

    def band(self, t: int) -> int:
        return BAND + len(self.words[t]) // 8

    def needed(self, t: int) -> int:
        """Fingerprints that an alignment of enough coverage shares at least.

        It matches c of the m words in at most m - c + 1 runs; a run of r words
        has r - 1 grams and a fingerprint in every ``WINNOW`` of them.
        """
        m = len(self.words[t])
        c = int(np.ceil(self.coverage * m))
        return max(1, (c - (m - c + 1) * (GRAM + WINNOW - 2)) // WINNOW)

    def matches(self, text: str | None) -> list[tuple]:
        """Every occurrence of a template with enough coverage, best first where occurrences overlap."""
        if not text:
            return []
        low = text.lower()
        words = hashes(low)
        hits = []
        for t, diagonal in self.candidates(words):
            template = self.words[t]
            n, first, last = align(template, words, diagonal, self.band(t))
            if n >= self.coverage * len(template) and names_it(template, words[first : last + 1]):
                hits.append((n / len(template), n, self.names[t], first, last))
        hits.sort(key=lambda h: (-h[1], -h[0], h[3], h[2]))
        taken: list[tuple] = []
        for hit in hits:  # an occurrence inside a better one says nothing more
            if all(hit[4] < other[3] or hit[3] > other[4] for other in taken):
                taken.append(hit)
        if not taken:
            return []
        spans = [m.span() for m in WORD.finditer(low)]
        if len(low) != len(text):  # lower case changed a length: places are counted in lower case
            text = low
        return [
            (name, coverage, n, first, last, spans[first][0], spans[last][1])
            for coverage, n, name, first, last in sorted(taken, key=lambda h: h[3])
        ]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """One row per license notice found: doc_id, license, coverage, matched words, and span in words and characters.

    coverage is the share of the template's words in the alignment; first and
    last word count from 0, last_char is the place after the last character
    (both of the text in lower case). Of overlapping occurrences the one with
    most words is reported. Null and empty texts have none; repeated rows are
    scanned each; an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Scanner(templates or TEMPLATES, coverage))
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, rows = [], []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = shared.value.matches(text)
                rows += found
                ids += [None if pd.isna(doc_id) else int(doc_id)] * len(found)
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "doc_id", pd.array(ids, "Int64"))
            yield out

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id bigint, " + SCHEMA)
