"""Parts of the corpus operators by themselves."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from parley.llm import licences, line_dedup, lm_score, mixture, quality, secrets, simhash
from parley.llm.token_files import EliasFano

SCANNER = secrets.Scanner(secrets.BASE_RULES)


@given(st.lists(st.integers(0, 1 << 40), max_size=700))
def test_elias_fano_round_trip(values):
    values = sorted(values)
    ef, end = EliasFano.from_bytes(b"xx" + EliasFano.encode(np.array(values, dtype=np.int64)).to_bytes(), 2)
    assert ef.values().tolist() == values
    assert [ef.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    bits = 8 * len(EliasFano.encode(values).to_bytes()) / len(values)
    assert bits < 2 + np.log2(values[-1] / len(values)) + 1


@given(st.lists(st.integers(0, (1 << 64) - 1), min_size=1, max_size=60), st.integers(0, 20))
def test_bk_tree_finds_what_a_scan_finds(values, radius):
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values:
        assert sorted(tree.near(v, radius)) == [i for i, x in enumerate(values) if (x ^ v).bit_count() <= radius]


@given(st.integers(0, (1 << 64) - 1), st.sets(st.integers(0, 63), max_size=4), st.integers(1, 10 ** 12))
def test_close_fingerprints_share_a_bucket(fp, flips, n):
    other = fp
    for b in flips:
        other ^= 1 << b
    assert any(fp & m == other & m for m in simhash.key_plan(n))


@settings(max_examples=300)
@given(st.lists(st.sampled_from(["password", "Token", "api_key", "apikey", "=", ":", " ", '"', "'", "abc", "AKIA", "ABCDEFGH",
                                 "0f", "deadbeef", "é", "\n", "-", "x" * 7, "7" * 9, "secret", "passwd"]), max_size=40))
def test_the_automaton_finds_what_regexes_find(parts):
    import brute
    text = "".join(parts)
    assert SCANNER.scan(text) == brute.base_spans(text)


@pytest.mark.parametrize("pattern", ["ab|cd*", "(?i:x[a-c]{2,3})y?", r"[^\x20]+z", "a{3}", "(ab)+c", "a.?b" if False else "a[^q]?b"])
def test_rule_regexes(pattern):
    scanner = secrets.Scanner((secrets.Rule("r", pattern),))
    rnd = np.random.default_rng(2)
    for _ in range(300):
        text = "".join(rnd.choice(list("abcdxyzABX q"), rnd.integers(0, 25)))
        if pattern == "ab|cd*" or "z" not in pattern:
            assert [(a, b) for _, a, b in scanner.scan(text)] == [m.span() for m in re.finditer(pattern, text)]


@given(st.data())
def test_rounding_keeps_mass_and_leaves_one_residual(data):
    n = data.draw(st.integers(1, 40))
    mass = np.array(sorted(data.draw(st.lists(st.integers(1, 1000), min_size=n, max_size=n)), reverse=True), dtype=float)
    p = np.array(data.draw(st.lists(st.floats(0, 1), min_size=n, max_size=n)))
    out = mixture.round_group(mass, p, np.random.default_rng(n).random(n))
    assert ((out >= 0) & (out <= 1)).all()
    assert ((out > 0) & (out < 1)).sum() <= 1
    assert abs((out * mass).sum() - (p * mass).sum()) < 1e-3 * max(1.0, mass.sum()) ** 0.5


def test_rounding_keeps_expectations():
    rng = np.random.default_rng(3)
    mass, p = np.array([50.0, 30, 20, 10, 10, 5, 1]), np.full(7, 0.4)
    mean = np.mean([mixture.round_group(mass, p, rng.random(7)) for _ in range(4000)], axis=0)
    assert np.abs(mean - 0.4).max() < 0.05


@given(st.lists(st.tuples(st.floats(-1, 1), st.floats(0, 1), st.integers(1, 9)), min_size=1, max_size=50))
def test_isotonic_is_monotone(points):
    x, y, w = (np.array(c, dtype=float) for c in zip(*sorted(points)))
    _, v = quality.isotonic(x, y, w)
    assert (np.diff(v) >= -1e-12).all() and v.min() >= -1e-12 and v.max() <= 1 + 1e-12


@given(st.integers(1, 300), st.sets(st.integers(0, 299), min_size=1))
def test_bitmaps_round_trip(n, dropped):
    dropped = {d for d in dropped if d < n} or {0}
    keep = line_dedup.decode_bitmap(line_dedup.encode_bitmap(np.array(sorted(dropped))), n)
    assert set(np.flatnonzero(~keep).tolist()) == dropped


@pytest.mark.parametrize(("expression", "labels", "score"), [
    ("mit", {"mit"}, 1.0), ("mit or gpl-3", {"mit", "gpl-3"}, 1.0), ("mit and gpl-3", {"mit", "gpl-3"}, 0.5),
    ("mit or cc-by-nc and gpl-3", {"mit", "cc-by-nc", "gpl-3"}, 1.0),
    ("( mit or cc-by-nc ) and gpl-3", {"mit", "cc-by-nc", "gpl-3"}, 0.5),
    ("gpl-2 with classpath-exception-2.0 or mit", {"gpl-2-with-classpath-exception-2.0", "mit"}, 1.0)])
def test_licence_expressions(expression, labels, score):
    assert licences.evaluate(licences.shunting_yard(expression.split())) == (labels, score)


@pytest.mark.parametrize("expression", ["", "and", "mit and", "( mit", "mit )", "mit gpl-3", "( )", "or mit"])
def test_malformed_licence_expressions(expression):
    assert licences.shunting_yard(expression.split()) is None


def test_licence_tags():
    s = licences.Scanner()
    judged = s.judge("# SPDX-License-Identifier: (MIT OR Apache-2.0) */\nAll rights reserved.")
    assert judged[5] == "all-rights-reserved,apache-2,mit" and judged[6] == 0.0
    assert s.judge("Licensed under the MIT License or the Apache License, Version 2.0")[5:8] == ("apache-2,mit", 1.0, "mit or apache-2")
    assert s.judge("SPDX-License-Identifier: AND")[5:7] == ("", 0.0)


@pytest.mark.parametrize(("text", "labels", "score", "expression"), [
    ("SPDX-License-Identifier: MIT, all rights reserved", "all-rights-reserved,mit", 0.0, "( mit ) and all-rights-reserved"),
    ("SPDX-License-Identifier: MIT or SPDX-License-Identifier: GPL-3.0-only", "gpl-3,mit", 1.0, "( mit ) or ( gpl-3 )"),
    ("x SPDX-License-Identifier: MIT y SPDX-License-Identifier: CC0-1.0 z gpl v2", "cc0,gpl-2,mit", 0.5, "( mit ) and ( cc0 ) and gpl-2"),
    ("SPDX-License-Identifier: MIT some prose, GNU General Public License version 3", "gpl-3,mit", 0.5, "( mit ) and gpl-3"),
    ("SPDX-License-Identifier: MIT or GNU General Public License version 3", "gpl-3,mit", 1.0, "( mit ) or gpl-3"),
    ("SPDX-License-Identifier: (MIT) and all rights reserved", "all-rights-reserved,mit", 0.0, "( ( mit ) ) and all-rights-reserved"),
    ("SPDX-License-Identifier: GPL v3", "gpl-3", 0.5, "gpl-3"),
    ("SPDX-License-Identifier: BSD-3-Clause OR Apache-2.0", "apache-2,bsd-3-clause", 1.0, "( bsd-3-clause or apache-2 )"),
    ("Grüße SPDX-License-Identifier\nSPDX-License-Identifier: MIT", "mit", 1.0, "( mit )")])
def test_a_licence_tag_ends_with_its_expression(text, labels, score, expression):
    assert licences.Scanner().judge(text)[5:8] == (labels, score, expression)


def test_places_behind_a_tag_on_its_line():
    judged = licences.Scanner().judge("é SPDX-License-Identifier: MIT, all rights reserved; SPDX-License-Identifier: MPL-2.0")
    assert judged[8] == [{"word": 1, "label": "mit"}, {"word": 5, "label": "all-rights-reserved"}, {"word": 8, "label": "mpl"}]


@given(st.lists(st.sampled_from(["mit", "gpl", "or", "and", "with", "(", ")"]), max_size=9))
def test_the_longest_well_formed_beginning(tokens):
    longest = max((n for n in range(len(tokens) + 1) if n and licences.shunting_yard(tokens[:n]) is not None), default=0)
    assert licences.well_formed(tokens) == longest


def test_packed_ngrams():
    h = np.sort(np.random.default_rng(4).integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2))
    assert (lm_score.unpack(lm_score.pack(h)) == h & np.uint64((1 << 56) - 1)).all()
    part = lm_score.part_of(h, 37)
    assert (np.diff(part) >= 0).all() and part.min() >= 0 and part.max() < 37


@given(st.lists(st.integers(0, (1 << 63) - 1), max_size=50))
def test_squeezed_counts_round_trip(values):
    counts = np.array(values, dtype=np.int64)
    assert lm_score.unsqueeze(lm_score.squeeze(counts)).tolist() == values


def test_counts_above_32_bits_score_as_they_are():
    counts = lm_score.unsqueeze(lm_score.squeeze(np.array([(1 << 32) + 5, 1 << 33])))
    base, singles, _ = lm_score.log_scores(np.array([2]), np.stack([counts, np.array([0, 1 << 32])]), 0.4, 2)
    assert singles[0] == 1 and base[0] == pytest.approx(np.log((1 << 32) + 5) + np.log((1 << 32) / ((1 << 32) + 5)))


@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=60))
def test_packed_ngrams_round_trip(values):
    h = np.array(sorted(values), dtype=np.uint64)
    assert lm_score.unpack(lm_score.pack(h)).tolist() == [v & (1 << 56) - 1 for v in sorted(values)]


def test_packed_ngrams_are_small():
    h = np.sort(np.random.default_rng(5).integers(0, 1 << 58, 23_000).astype(np.uint64))    # a block of the check tables
    assert len(lm_score.pack(h)) < 6 * len(h)
