import time

import pytest

from tallyhouse.llm import licenses
from tests.llm.conftest import ROWS

MIT = next(t for name, t in licenses.TEMPLATES if name == "MIT" and len(t) > 200)


def brute(scanner, text):
    """The best coefficient of any run of units with any template."""
    units = [m.group() for m in licenses._UNIT.finditer(text)]
    best = 0.0
    for i in range(len(units)):
        for j in range(i, len(units)):
            held = licenses.bigrams([w for u in units[i : j + 1] for w in licenses.words(u)])
            best = max([best, *[licenses.dice(held, of) for _, of in scanner.templates]])
    return best


TEXTS = [
    "Intro text. Released under the MIT License. More text",
    "Intro\nLicensed under the Apache License, version 2.0\nmore",
    "a b c\n" + MIT.replace(", ", ",\n") + "\nclosing words here",
    MIT.replace("charge", "cost").replace("Software", "Program"),
    "this work is LICENSED under the gnu general public license version 3",
    "This work is licensed under the GNU General Public License, version 2.",
    "the license of the city of the work is under the version of the public",
    "Licensed under CC BY-NC 4.0.",
    "Licensed under CC BY-NC 9.9.",
    "",
]


@pytest.mark.parametrize("least", [0.8, 0.5, 0.95])
def test_best_match_equals_brute_force(least):
    scanner = licenses.Scanner(least=least)
    for text in TEXTS:
        matches = scanner.scan(text)
        best = brute(scanner, text)
        if best >= least:
            assert max(m["dice"] for m in matches) == pytest.approx(best)
        else:
            assert matches == []
        for m, n in zip(matches, matches[1:], strict=False):
            assert m["end"] <= n["start"]


def test_names():
    scanner = licenses.Scanner()
    names = [[m["license"] for m in scanner.scan(t)] for t in TEXTS]
    assert names == [
        ["MIT"], ["Apache-2.0"], ["MIT"], ["MIT"], ["GPL-3.0"], ["GPL-2.0"], [], ["CC-BY-NC-4.0"], [], []
    ]


def test_spans_and_odd_rows(spark, odd, nothing):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in licenses.scan(docs).collect():
        text = TEXTS[r["doc_id"]]
        assert r["n_matches"] == len(r["matches"])
        for m in r["matches"]:
            held = licenses.bigrams(licenses.words(text[m["start"] : m["end"]]))
            assert max(licenses.dice(held, licenses.bigrams(licenses.words(t))) for _, t in licenses.TEMPLATES) == m["dice"]
    rows = licenses.scan(odd).collect()
    assert len(rows) == len(ROWS) and {r["license"] for r in rows} == {None}
    assert licenses.scan(nothing).count() == 0


def template(name, holds):
    return next(t for n, t in licenses.TEMPLATES if n == name and holds in t)


def test_licenses_that_differ_by_few_words_are_told_apart():
    scanner = licenses.Scanner()
    gnu = (
        "This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {} "
        "General Public License as published by the Free Software Foundation{} either version {} of the "
        "License, or (at your option) any later version."
    )
    bsd = template("BSD-3-Clause", "DISCLAIMED").replace("the copyright holder nor", "Foo Inc. nor")
    for name, text in [
        ("AGPL-3.0-or-later", gnu.format("program", ":", "Affero", ",", "3")),
        ("LGPL-2.1-or-later", gnu.format("library", ";", "Lesser", ";", "2.1")),
        ("LGPL-3.0-or-later", gnu.format("program", ":", "Lesser", ",", "3")),
        ("GPL-3.0-or-later", gnu.format("program", ":", "", ",", "3")),
        ("GPL-2.0-or-later", gnu.format("program", ";", "", ";", "2")),
        ("BSD-3-Clause", "Copyright (c) 2020 Foo Inc.\n\n" + bsd),
        ("BSD-2-Clause", template("BSD-2-Clause", "DISCLAIMED")),
        ("EPL-2.0", template("EPL-2.0", "which is available at")),
        ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
        ("CC-BY-NC-SA-4.0", "SPDX-License-Identifier: CC-BY-NC-SA-4.0"),
    ]:
        assert [m["license"] for m in scanner.scan("Some words before.\n" + text + "\nSome words after.")] == [name]


def test_every_template_is_named_as_itself():
    scanner = licenses.Scanner()
    for name, text in licenses.TEMPLATES:
        assert {m["license"] for m in scanner.scan(text)} == {name}, text


def brute_inside(scanner, text):
    """Of all runs of words that hold their template's numbers, the best by shared bigrams less
    the others, then by coefficient."""
    some, best = licenses.words(text), (0, 0.0, None)
    for i in range(len(some)):
        for j in range(i + 2, len(some) + 1):
            held = licenses.bigrams(some[i:j])
            for name, of in scanner.templates:
                numbers = {w for pair in of for w in pair if any(c.isdigit() for c in w)}
                score = licenses.dice(held, of)
                if score >= scanner.least and numbers <= set(some[i:j]):
                    best = max(best, (2 * len(held & of) - len(held), score, name), key=lambda x: x[:2])
    return best


INSIDE = [
    ("This package is released under the MIT License.", "MIT", "released under the MIT License"),
    (
        "Copyright 2020 The Foo Authors, licensed under the Apache License, Version 2.0.",
        "Apache-2.0",
        "licensed under the Apache License, Version 2.0",
    ),
    ("one two three Licensed under CC BY 4.0 four five six seven eight", "CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("We, who wrote it, put this work is licensed under GNU General Public License, version 3 and so on", "GPL-3.0", None),
    ("see also what is Licensed under CC BY-NC 9.9 by others", None, None),
    ("the license of the city under the terms of the public version of the work and so on", None, None),
]


def test_notices_inside_sentences_equal_brute_force_over_words():
    scanner = licenses.Scanner()
    for text, name, part in INSIDE:
        matches = scanner.scan(text)
        _, score, best = brute_inside(scanner, text)
        assert [m["license"] for m in matches] == ([name] if name else []) and best == name
        if name:
            assert matches[0]["dice"] == pytest.approx(score)
        if part:
            assert text[matches[0]["start"] : matches[0]["end"]] == part


def test_a_text_on_one_line_without_marks():
    some = licenses.words(MIT)
    text = " ".join([f"a{i}" for i in range(300)] + some + [f"z{i}" for i in range(300)])
    (match,) = licenses.Scanner().scan(text)
    assert match["license"] == "MIT" and text[match["start"] : match["end"]] == " ".join(some)


@pytest.mark.parametrize(
    "notice, times",
    [
        ("Licensed under the MIT License.\n", 4000),
        ("SPDX-License-Identifier: MIT\n", 5000),
        (MIT + "\n", 120),
        ("This package is licensed under the MIT License and ", 2500),
        ("Licensed under the MIT License ", 4000),
    ],
)
def test_a_notice_repeated_is_as_many_matches_in_time_that_grows_with_the_text(notice, times):
    scanner = licenses.Scanner()
    start = time.process_time()
    matches = scanner.scan(notice * times)
    assert time.process_time() - start < 5
    (alone,) = scanner.scan(notice)
    # A unit ends with its blanks, a run inside one with its last word.
    assert [(m["license"], m["dice"], m["start"]) for m in matches] == [
        (alone["license"], alone["dice"], alone["start"] + i * len(notice)) for i in range(times)
    ]
    length = alone["end"] - alone["start"]
    assert {m["end"] - m["start"] for m in matches} <= {length, length - 1}


def greedy(scanner, text):
    """All runs of units over the threshold, the best first, that overlap none before them."""
    units = [m for m in licenses._UNIT.finditer(text) if licenses.words(m.group())]
    runs = []
    for i in range(len(units)):
        for j in range(i, len(units)):
            some = licenses.words(text[units[i].start() : units[j].end()])
            held = licenses.bigrams(some)
            for number, (name, of) in enumerate(scanner.templates):
                if (score := licenses.dice(held, of)) >= scanner.least:
                    gain = 2 * len(held & of) - len(held)
                    runs.append((-gain, -score, -len(some), i, j, number, name))
    kept = []
    for _, score, _, i, j, _, name in sorted(runs):
        if all(j < a or i > b for _, _, a, b in kept):
            kept.append((name, pytest.approx(-score), i, j))
    return [(n, s, units[i].start(), units[j].end()) for n, s, i, j in sorted(kept, key=lambda k: k[2])]


def test_repeats_equal_brute_force():
    scanner = licenses.Scanner()
    mit = "Licensed under the MIT License.\n"
    gpl = "This work is licensed under the GNU General Public License, version 2.\n"
    apache = "Licensed under the Apache License, version 2.0\n"
    for text in (mit * 5, mit + gpl * 2 + mit, (mit + apache) * 3, "one\n" + apache * 2 + "two\n" + mit, (gpl + "x y z\n") * 3):
        found = [(m["license"], m["dice"], m["start"], m["end"]) for m in scanner.scan(text)]
        assert found == greedy(scanner, text)
