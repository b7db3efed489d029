from __future__ import annotations

import random

import pytest

from cargolake.llm import licenses
from tests.llm.conftest import prose

SCANNER = licenses.Scanner(licenses.TEMPLATES)


def longest_common(a, b):
    """Length of the longest common sequence of words, over all alignments."""
    best = [0] * (len(b) + 1)
    for x in a:
        before = best[:]
        for j, y in enumerate(b):
            best[j + 1] = before[j] + 1 if x == y else max(best[j], before[j + 1])
    return best[-1]


def damaged(text, seed, changes):
    words, rng = text.split(" "), random.Random(seed)
    for _ in range(changes):
        at = rng.randrange(len(words))
        kind = rng.choice(["change", "drop", "add"])
        words[at : at + 1] = {"change": ["other"], "drop": [], "add": [words[at], "more"]}[kind]
    return " ".join(words)


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_templates_are_found_inside_texts(name):
    text = f"{prose(1, 50)}\n{licenses.TEMPLATES[name].upper()}\n{prose(2, 50)}"
    found = SCANNER.matches(text)
    assert [(f[0], f[1]) for f in found] == [(name, 1.0)]
    low = text.lower()
    first, last = licenses.WORD.findall(licenses.TEMPLATES[name].lower())[:: len(licenses.WORD.findall(licenses.TEMPLATES[name])) - 1]
    assert low[found[0][5] :].startswith(first)
    assert low[: found[0][6]].endswith(last)


@pytest.mark.parametrize("seed", range(12))
def test_coverage_agrees_with_full_alignment(seed):
    for name in ("MIT-permission", "Apache-2.0-header", "GPL-3.0-header"):
        template = licenses.TEMPLATES[name]
        body = damaged(template, seed, 4)
        want = longest_common(licenses.hashes(template).tolist(), licenses.hashes(body).tolist())
        found = {f[0]: f for f in SCANNER.matches(f"{prose(seed, 30)} {body} {prose(seed + 50, 30)}")}
        assert found[name][2] == want


def test_weak_matches_and_clean_texts_are_left_alone():
    assert SCANNER.matches(prose(3, 500)) == []
    assert SCANNER.matches("Released under the sea. Licensed plumbers, version 2.") == []
    assert SCANNER.matches("Permission is hereby granted, free of charge, to nobody.") == []


@pytest.mark.parametrize("notice", [
    "Released under the ISC License.", "Released under the MIT-0 License.", "Licensed under CC BY-SA 4.0.",
    "Licensed under CC BY-NC-SA 4.0.", "Licensed under CC BY-NC 3.0.", "Licensed under the Apache License, Version 1.0.",
    "This work is licensed under the GNU General Public License, version 2.",
    "This work is licensed under the GNU Lesser General Public License, version 3.",
    "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License.",
])
def test_other_licenses_are_not_misnamed(notice):
    assert SCANNER.matches(f"{prose(4, 30)}\n{notice}\n{prose(5, 30)}") == []


def test_common_words_of_short_notices_may_differ():
    assert [f[0] for f in SCANNER.matches("Licensed under the Apache License 2.0.")] == ["Apache-2.0"]
    assert [f[0] for f in SCANNER.matches("Work licensed under the GNU General Public License, version 3.")] == ["GPL-3.0"]


def test_every_occurrence_is_reported():
    mit = licenses.TEMPLATES["MIT"]
    found = SCANNER.matches(f"{mit} {prose(1, 20)} {mit}\n{mit}")
    assert [f[0] for f in found] == ["MIT"] * 3
    assert [f[3] for f in found] == [0, 25, 30]


def test_winnowing_keeps_a_fingerprint_of_every_passage():
    words = licenses.hashes(prose(5, 300))
    _, places = licenses.winnowed(words)
    assert max(b - a for a, b in zip(places, places[1:])) <= licenses.WINNOW
    assert len(licenses.winnowed(words[:1])[0]) == 0


def test_scan(docs_of, odd_rows):
    notice = licenses.TEMPLATES["Apache-2.0"]
    rows = odd_rows + [(50, prose(9, 40) + "\n" + notice), (50, prose(9, 40) + "\n" + notice), (None, notice)]
    docs = docs_of(rows).withColumnRenamed("lang", "license").withColumnRenamed("source", "coverage")
    got = licenses.scan(docs).collect()
    assert sorted((str(r["doc_id"]), r["license"], r["coverage"]) for r in got) == [
        ("50", "Apache-2.0", 1.0), ("50", "Apache-2.0", 1.0), ("None", "Apache-2.0", 1.0),
    ]
    assert licenses.scan(docs_of([])).collect() == []


NOTICE = (
    "This {what} is free software{sep} you can redistribute it and/or modify it under the terms of the GNU {name}General Public License "
    "as published by the Free Software Foundation{mid} either version {version} of the License, or (at your option) any later version."
)


@pytest.mark.parametrize(
    ("name", "version", "found"),
    [("", "3", True), ("", "2", False), ("", "1", False), ("Lesser ", "3", False), ("Lesser ", "2.1", False), ("Library ", "2", False), ("Affero ", "3", False)],
)
@pytest.mark.parametrize("what", ["program", "library"])
def test_members_of_a_family_are_told_apart(name, version, found, what):
    """The notice of one license is never reported as its sibling's."""
    text = "Some words before. " + NOTICE.format(what=what, sep=":" if version != "2" else ";", name=name, mid=",", version=version) + " And after."
    named = {hit[0] for hit in licenses.Scanner(licenses.TEMPLATES).matches(text)}
    assert named == ({"GPL-3.0-header"} if found and what == "program" else set())


def test_long_notices_need_their_own_version():
    header = licenses.TEMPLATES["Apache-2.0-header"]
    scan = licenses.Scanner(licenses.TEMPLATES).matches
    assert "Apache-2.0-header" in {hit[0] for hit in scan(header)}
    assert "Apache-2.0-header" in {hit[0] for hit in scan(header.replace("http://www.apache.org/licenses/LICENSE-2.0", "the address below"))}
    assert not {hit[0] for hit in scan(header.replace("2.0", "1.1"))}
