"""Time grows with the length of a text, not with its square; awkward expressions and overlapping rules."""

import re
import time

import pytest
from parley.llm import licences, secrets

SCANNER = secrets.compiled(secrets.RULES)
LICENCES = licences.Scanner()


def seconds(f, text):
    began = time.process_time()
    f(text)
    return time.process_time() - began


TEXTS = {
    "a value behind a quoted one": lambda n: 'token=secret":' + "z" * n,
    "a token with four parts": lambda n: "eyJa.eyJb.eyJc." + "d" * n,
    "many spans, not ASCII": lambda n: "é token=abcdefgh " * (n // 17),
    "words before a key": lambda n: "a" * n + " token=" + "b" * 9,
}


@pytest.mark.parametrize("name", TEXTS)
def test_secret_scan_is_linear(name):
    one, two = (min(seconds(SCANNER.scan, TEXTS[name](n)) for _ in range(2)) for n in (500_000, 1_000_000))
    assert two < 5 and two < 4 * one + 0.2


PAGES = {
    "one phrase again and again": lambda n: "cc by nc " * (n // 9),
    "a long tag line": lambda n: "SPDX-License-Identifier: " + " OR ".join(["mit"] * (n // 7)),
    "with between two lists": lambda n: "SPDX-License-Identifier: (" + " OR ".join(f"a{i}" for i in range(n // 20)) + ") WITH ("
    + " OR ".join(f"b{i}" for i in range(n // 20)) + ")",
    "many labels": lambda n: "SPDX-License-Identifier: " + " OR ".join(f"a{i}" for i in range(n // 10)),
    "many tags": lambda n: "SPDX-License-Identifier: GPL-2.0-only WITH classpath\n" * (n // 50),
}


@pytest.mark.parametrize("name", PAGES)
def test_licence_scan_is_linear(name):
    one, two = (min(seconds(LICENCES.judge, PAGES[name](n)) for _ in range(2)) for n in (100_000, 200_000))
    assert two < 5 and two < 4 * one + 0.2
    assert len(LICENCES.judge(PAGES[name](200_000))[5]) < 200_000


@pytest.mark.parametrize("text, labels, score", [
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "gpl-2-with-classpath-exception-2.0", 0.5),
    ("SPDX-License-Identifier: MIT OR GPL-2.0-only WITH x", "gpl-2-with-x,mit", 1.0),
    ("SPDX-License-Identifier: (MIT OR ISC) WITH x", "", 0.0),
    ("SPDX-License-Identifier: MIT WITH (x OR y)", "", 0.0),
    ("SPDX-License-Identifier: MIT WITH x WITH y", "", 0.0),
    ("SPDX-License-Identifier: (MIT OR ISC) WITH x\nunder the mit license", "mit", 1.0),
    ("SPDX-License-Identifier: mitigation-1", "mitigation-1", licences.UNKNOWN),
    ("SPDX-License-Identifier: BSD-3-Clause AND Apache-2.0", "apache-2,bsd-3-clause", 1.0),
])
def test_exceptions_and_names(text, labels, score):
    judged = LICENCES.judge(text)
    assert (judged[5], judged[6]) == (labels, score)


@pytest.mark.parametrize("pattern", ["abcd|bc", "a|ab|abc", "bc|abcd|d", "(ab)+c?|b", "a+b|aa", "[ab]+c|ab"])
def test_leftmost_longest_of_overlapping_alternatives(pattern):
    scanner = secrets.Scanner((secrets.Rule("x", pattern),))
    forms = re.compile(pattern)
    for text in ("abcd bc", "aabcabcd", "abababc", "aaab aa", "dabcbcd", "", "aaaa", "ababcabab"):
        expected, at = [], 0
        while at < len(text):
            ends = [e for e in range(at + 1, len(text) + 1) if forms.fullmatch(text, at, e)]
            if ends:
                expected.append(("x", at, max(ends)))
                at = max(ends)
            else:
                at += 1
        assert scanner.scan(text) == expected


def test_a_rule_set_is_compiled_once():
    assert secrets.compiled(secrets.RULES) is SCANNER
