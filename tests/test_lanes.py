import random

import pytest

from quire.functions import edit, lanes
from quire.functions.text import in_shares
from quire.operators.scoring import measure_pages


def plain(a, b):
    return edit._by_columns(a, b) if a and b else len(a) + len(b)


def pairs_of(rng, letters, longest):
    """Changed, turned and unrelated texts, some of them as lists."""
    for _ in range(40):
        a = rng.choices(letters, k=rng.randint(0, longest))
        b = list(a)
        for _ in range(rng.choice([0, 1, 7, 31, 33, 90])):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = rng.choices(letters, k=rng.randint(0, 1))
        cut = rng.randint(0, len(a))
        b = rng.choice([b, b, a[cut:] + a[:cut], rng.choices(letters, k=rng.randint(0, longest))])
        a, b = rng.choice([(a, b), (b, a)])
        yield rng.choice([(a, b), ("".join(a), "".join(b))])


@pytest.mark.parametrize("few", [1, 24])
@pytest.mark.parametrize("letters", ["ab", "abcdefgh ظع\U0001f600", "".join(map(chr, range(256, 700)))])
def test_distances_of_many_pairs(letters, few, monkeypatch):
    monkeypatch.setattr(lanes, "_LANES", few)
    rng = random.Random(f"{letters}{few}")
    pairs = [p for longest in (5, 70, 300, 900) for p in pairs_of(rng, letters, longest)]
    assert lanes.edit_distances(pairs) == [plain(a, b) for a, b in pairs]


def test_ways_agree():
    """Bands and fronts tell the distance or that it is beyond their limit, whichever would be chosen."""
    rng = random.Random(5)
    pairs = [(a, b) if len(a) >= len(b) else (b, a) for a, b in (lanes.trimmed(*p) for p in pairs_of(rng, "abcd", 400)) if len(a) > 95 and len(b) and abs(len(a) - len(b)) < 60]
    pairs.sort(key=lambda p: -len(p[1]))
    a, b = ([edit._codes(*p)[s] for p in pairs] for s in (0, 1))
    want = [plain(*p) for p in pairs]
    for words in (2, 3):
        reach = [2 * (32 * words - 1) - len(x) + len(y) for x, y in pairs]
        assert lanes._in_band(a, b, words).tolist() == [d if d <= r else -1 for d, r in zip(want, reach, strict=True)]
    most = [abs(len(x) - len(y)) + 40 for x, y in pairs]
    assert lanes._by_fronts(a, b, lanes.np.array(most)).tolist() == [d if d <= m else -1 for d, m in zip(want, most, strict=True)]


def test_lines_of_pages_are_measured_together(monkeypatch):
    rng = random.Random(3)
    line = lambda: "".join(rng.choices("abcde ", k=rng.randint(0, 90)))
    changed = lambda x: x.replace(rng.choice("abc"), rng.choice("xyz"), rng.randint(0, 30))
    pages = [([line() for _ in range(rng.randint(0, 12))], []) for _ in range(60)]
    pages = [(a, [changed(x) for x in a[::-1]] + [line()]) for a, _ in pages]
    want = [edit.similar_lines(a, b, 0.5) for a, b in pages]
    calls = []
    whole = lanes._whole
    monkeypatch.setattr(lanes, "_whole", lambda *x: calls.append(1) or whole(*x))
    assert lanes.similar_lines_of(pages, 0.5) == want and len(calls) < 10
    monkeypatch.setattr(lanes, "_FEW_PAIRS", 20)  # pages of many lines
    monkeypatch.setattr(lanes, "_AT_ONCE", 2000)
    assert lanes.similar_lines_of(pages, 0.5) == want


def test_pages_are_scored_as_one_by_one():
    rng = random.Random(8)
    text = lambda: "\n".join("".join(rng.choices("abcdef g", k=rng.randint(0, 60))) for _ in range(rng.randint(1, 9))) + "\nend"
    pages = []
    for _ in range(80):
        r = text()
        lines = r.split("\n")
        pages.append((r, rng.choice([r, r.replace("a", "b"), "", "\n".join(lines[1:] + lines[:1]), text()]), rng.random() < 0.9))
    assert measure_pages(pages, 0.5) == [measure_pages([p], 0.5)[0] for p in pages]
    for (r, p, scored), row in zip(pages, measure_pages(pages, 0.5), strict=True):
        if scored:
            assert row[0] == plain(r, p) and row[2] == plain(r.split(), p.split())


def test_shares_of_rows():
    assert list(in_shares([3, 3, 9, 1, 1], 6)) == [slice(0, 2), slice(2, 3), slice(3, 5)]
    assert list(in_shares([], 6)) == [slice(0, 0)]


def test_edits_that_lie_apart_are_told_by_a_walk(monkeypatch):
    """Distances of texts with an edit here and there need no fronts; what a walk tells is the distance."""
    rng = random.Random(12)
    pairs = []
    for k in range(60):
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(120)]
        a = " ".join(words)
        b = "".join(x + (("#", x, "")[k % 3] if i % 40 == 39 else "") for i, x in enumerate(a))
        pairs += [(a, b), (words, b.split(" ")), (words, [*words[:50], "x", *words[51:80], *words[81:]])]
    pairs += [p for longest in (70, 300) for p in pairs_of(rng, "ab", longest)]
    want = [plain(a, b) for a, b in pairs]
    assert lanes.edit_distances(pairs) == want
    codes = [edit._codes(*lanes.trimmed(a, b)) for a, b in pairs]
    some = [i for i, (a, b) in enumerate(codes) if len(a) and len(b)]
    a, b = ([codes[i][s] for i in some] for s in (0, 1))
    found, enough = lanes._where_apart(a, b, lanes.np.array([len(x) // 2 for x in a]))
    assert all(d in (-1, want[i]) for i, d in zip(some, found.tolist(), strict=True)) and all(d >= min(want[i], len(codes[i][0]) // 2 + 1) for i, d in zip(some, enough.tolist(), strict=True))
    apart = [p for p in pairs[:180] if isinstance(p[0], str)]
    asked = []
    fronts = lanes._by_fronts
    monkeypatch.setattr(lanes, "_by_fronts", lambda *x: asked.extend(x[0]) or fronts(*x))
    assert lanes.edit_distances(apart) == [plain(*p) for p in apart] and len(asked) < 5


def test_within_one_edit():
    rng = random.Random(4)
    for _ in range(3000):
        piece, text = "".join(rng.choices("ab", k=rng.randint(2, 9))), "".join(rng.choices("ab", k=rng.randint(0, 12)))
        low, high = sorted(rng.choices(range(len(text) + 1), k=2))
        part = text[low:high]
        want = any(plain(piece, part[i:j]) <= 1 for i in range(len(part) + 1) for j in range(i, len(part) + 1))
        assert lanes._within_one(piece, text, low, high) or not want  # never denied wrongly


def test_partners_of_many_pages_are_measured_together(monkeypatch):
    rng = random.Random(6)
    line = lambda: "".join(rng.choices("abcde ", k=rng.randint(0, 90)))
    pages = [([line() for _ in range(rng.randint(0, 9))], []) for _ in range(60)]
    pages = [(a, [x.replace("a", "x", rng.randint(0, 9)) for x in a[::-1]] + [line()]) for a, _ in pages]
    want = [edit.partners(a, b, 0.5) for a, b in pages]
    alone = []
    monkeypatch.setattr(edit, "similarity", lambda a, b: alone.append(1))
    calls = []
    measured = lanes.edit_distances
    monkeypatch.setattr(lanes, "edit_distances", lambda x: calls.append(len(x)) or measured(x))
    assert lanes.partners_of(pages, 0.5) == want and not alone and calls[0] > 40


def test_a_long_text_lies_in_the_bits(monkeypatch):
    """A long text against a short one takes a step for each item of the short one."""
    rng = random.Random(7)
    pairs = [("".join(rng.choices("abcdefgh", k=9000)), "".join(rng.choices("abcdefgh", k=300))) for _ in range(30)]
    want = [plain(*p) for p in pairs]
    monkeypatch.setattr(lanes, "_whole", None)
    assert lanes.edit_distances(pairs) == want


def test_only_lines_that_come_often_are_handed_on():
    r = "one two\nthree\n\nfour"
    pages = [(r, "ab, c\nx\nab c\ny\nab c!", True), (r, "x\nx", True), (r, "x\nx\nx\nz", False)]
    assert [row[-1] for row in measure_pages(pages, 0.5, often=3)] == [["ab c"] * 3, [], ["x"] * 3]
    assert [row[:-1] for row in measure_pages(pages, 0.5, often=3)] == [row[:-1] for row in measure_pages(pages, 0.5)]


def test_words_are_left_out_where_nothing_looks_at_them(monkeypatch):
    pages = [("one two\nthree", "one too\nthree", True), ("a", "b", False)]
    whole = measure_pages(pages, 0.5, ("strict",))
    seen = []
    measured = lanes.edit_distances
    monkeypatch.setitem(measure_pages.__globals__, "edit_distances", lambda pairs: seen.extend(pairs) or measured(pairs))
    chars = measure_pages(pages, 0.5, ("strict",), with_words=False)
    assert all(isinstance(a, str) for a, _ in seen) and chars[0][2:4] == (None, None) and whole[0][2:4] == (1, 3)
    assert [(*r[:2], *r[4:]) for r in chars] == [(*r[:2], *r[4:]) for r in whole]
