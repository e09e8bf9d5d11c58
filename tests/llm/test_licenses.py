"""Licenses in wrapped texts, and several in one."""

import textwrap

import pytest

from quire.llm import license_scan


@pytest.mark.parametrize("template", license_scan.TEMPLATES, ids=lambda t: f"{t.license}-{len(t.text)}")
def test_wrapped_templates(template):
    s = license_scan.Scanner()
    for width in range(60, 81):
        found = s.scan("Some lines before.\n" + textwrap.fill(template.text, width) + "\nSome lines after it.")
        assert [(x[2], x[6], x[7]) for x in found] == [(template.license, 0, 0)], (width, found)


def test_wrapped_inside_keywords():
    s = license_scan.Scanner()
    for text, name in (
        ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0.", "MPL-2.0"),
        ("This is free and unencumbered\nsoftware released into the public\n  domain.", "Unlicense"),
        ("Dedicated to the\npublic\ndomain under CC0 1.0.", "CC0-1.0"),
        ("Licensed under CC\nBY 4.0.", "CC-BY-4.0"),
    ):
        assert [x[2] for x in s.scan(text)] == [name]


def test_several_in_one_block():
    s = license_scan.Scanner()
    found = s.scan("Released under the MIT License.\n\nLicensed under CC BY-NC 4.0.\n")
    assert sorted(x[2] for x in found) == ["CC-BY-NC-4.0", "MIT"] and len({x[:2] for x in found}) == 1
    every = s.scan("\n\n".join(t.text for t in license_scan.TEMPLATES))
    assert sorted(x[2] for x in every) == sorted(t.license for t in license_scan.TEMPLATES)
    assert [x[2] for x in s.scan("Released under the MIT License.\n" * 2)] == ["MIT", "MIT"]


def test_short_line_in_legal_prose():
    prose = "The copyright holder grants permission to redistribute copies with or without modification, and gives no warranty of any kind, express or implied, under this license. " * 4
    for t in license_scan.TEMPLATES:
        assert t.license in [x[2] for x in license_scan.Scanner().scan(f"{prose}{t.text} {prose}")], t


def exhaustive(text):
    """Like the scan, but every place of every template is compared by its wording, whatever it takes off."""
    s = license_scan.Scanner()
    s.own = [-(10**9)] * len(s.own)
    return s.scan(text)


def test_no_license_is_lost_to_the_floor():
    """Changed words up to the share that is allowed, in prose with the same vocabulary: all that an exhaustive comparison finds."""
    import random

    draw, s, n = random.Random(21), license_scan.Scanner(), 0
    prose = "the copyright holder grants a license to use copies of the software under the terms of this notice without warranty or permission".split()
    for _ in range(120):
        parts = []
        for t in draw.sample(license_scan.TEMPLATES, draw.randint(1, 4)):
            words, must = t.text.split(), set(t.must)
            for i, w in enumerate(words):
                if len(words) > 5 and not must & set(license_scan.words_of(w)) and draw.random() < draw.choice([0, 0.05, 0.15]):
                    words[i] = draw.choice([f"qq{i}", "", f"{w} qq{i}"])
            parts += [" ".join(words), " ".join(draw.choices([*prose, "x7", "y9"], k=draw.randint(0, 80)))]
        text = "\n".join(parts)
        want, got = ([(x[2], *x[5:]) for x in f(text)] for f in (exhaustive, s.scan))
        assert sorted(got) == sorted(want)
        n += len(got)
    assert n > 200


def test_compression_decides(monkeypatch):
    text = "Released under the MIT License.\n\nLicensed under CC BY-NC 4.0.\n"
    assert license_scan.Scanner().scan(text)
    monkeypatch.setattr(license_scan.Scanner, "ranked", lambda self, have: [p._replace(saved=0) for p in ranked(self, have) if p.saved < 0])
    assert not license_scan.Scanner().scan(text)


ranked = license_scan.Scanner.ranked


def test_reductions_are_real():
    """saved is what the template takes off the place's compressed size, and greatest first."""
    s = license_scan.Scanner()
    have = license_scan.words_of("\n".join(t.text for t in license_scan.TEMPLATES[:12]))
    places = s.ranked(have)
    assert [p.saved for p in places] == sorted((p.saved for p in places), reverse=True) and len(places) > 12
    for p in places[:20]:
        text = " ".join(have[p.low : p.high]).encode()
        alone, given = license_scan._compressor().compress(text), license_scan._compressor(" ".join(s.templates[p.template][1])).compress(text)
        assert p.saved == len(alone) - len(given) and p.plain == len(alone)


def test_ten_thousand_license_lines():
    import time

    began = time.perf_counter()
    found = license_scan.Scanner().scan("Released under the MIT License.\n" * 10_000)
    assert len(found) == 10_000 and {x[2:5:5] for x in found} == {("MIT",)}
    assert time.perf_counter() - began < 10


@pytest.mark.parametrize(("text", "name"), [
    ("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("# SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"), ("Licensed under Apache 2.0", "Apache-2.0"), ("licensed under the GNU GPL v3", "GPL-3.0"),
    ("Licensed under the GPLv2", "GPL-2.0"), ("Licensed under CC BY-SA 3.0.", "CC-BY-SA-3.0"), ("This work is licensed under a Creative Commons Attribution 3.0 Unported License", "CC-BY-3.0"),
])
def test_short_forms(text, name):
    assert [x[2] for x in license_scan.Scanner().scan(text)] == [name]
