import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from quire.functions import edit
from quire.functions import text as X
from quire.schema import LETTER_FOLD


def textbook(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize(("a", "b", "d"), [("kitten", "sitting", 3), ("flaw", "lawn", 2), ("", "", 0), ("x" * 40, "", 40), ("كتاب", "كتاف", 1), ("😀", "é", 1)])
def test_known_distances(a, b, d):
    assert edit.edit_distance(a, b) == edit.edit_distance(b, a) == d


def test_distance_is_exact():
    draw = random.Random(11)
    for _ in range(1500):
        a = [draw.choice("ابتé") for _ in range(draw.randint(0, 140))]
        b = [draw.choice("ابتé") for _ in range(draw.randint(0, 140))] if draw.random() < 0.5 else [x if draw.random() > 0.1 else "z" for x in a]
        assert edit.edit_distance("".join(a), "".join(b)) == textbook(a, b) == edit.edit_distance(a, b)


def test_fronts_and_columns_agree():
    """Long texts with errors throughout, few and many: both ways, and the one that is chosen."""
    draw = random.Random(7)
    base = "".join(draw.choices("abcdefgh ابت ", k=1500))
    for errors in (0, 1, 5, 30, 200, 900):
        other = list(base)
        for _ in range(errors):
            k = draw.randrange(len(other))
            kind = draw.randrange(3)
            other[k : k + (kind != 1)] = ["x"] * (kind != 0)
        other = "".join(other)
        d = textbook(base, other)
        assert edit.edit_distance(base, other) == edit._by_columns(base, other) == d
        assert edit.edit_distance(base.split(), other.split()) == textbook(base.split(), other.split())
        assert edit._by_fronts(*edit._codes(base, other), len(base) * 9) == d
        assert edit._by_fronts(*edit._codes(base, other), d - 1) is None or d == 0


def test_few_errors_in_long_texts_take_little_time():
    import time

    draw = random.Random(8)
    base = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz    ", k=20_000))
    other = list(base)
    for k in draw.sample(range(len(base)), 100):
        other[k] = "#"
    other = "".join(other)
    began = time.perf_counter()
    assert edit.edit_distance(base, other) == 100
    fronts = time.perf_counter() - began
    began = time.perf_counter()
    assert edit._by_columns(base, other) == 100
    assert fronts < (time.perf_counter() - began) / 3


def test_distances_at_once(monkeypatch):
    draw = random.Random(9)
    for few in (0, edit._FEW):
        monkeypatch.setattr(edit, "_FEW", few)
        for size in (0, 1, 63, 64, 65, 130):
            a = "".join(draw.choices("abcé", k=size))
            others = ["".join(draw.choices("abcé", k=draw.randint(0, 140))) for _ in range(20)] + [a, "", a[::-1], a[1:] + "b"]
            want = [textbook(a, x) for x in others]
            assert edit.distances(a, others, edit.np.full(len(others), 999)).tolist() == want
            for most in (0, 10, 40):
                got = edit.distances(a, others, edit.np.full(len(others), most)).tolist()
                assert all(g == w if w <= most else g > most for g, w in zip(got, want, strict=True))


def test_line_order():
    ref = "first line here\nsecond one there\nthird is last"
    lines = ref.split("\n")
    keys = [X.skeleton_of(x) for x in lines]
    same = edit.line_order(ref, ref, keys, keys, 0.5)
    assert same == (0, 3, 3, 3, 3, 3)
    back = edit.line_order(ref, "\n".join(lines[::-1]), keys, keys[::-1], 0.5)
    assert back == (0, 0, 3, 3, 3, 3)
    assert edit.line_order(ref, "", keys, [], 0.5) == (len(ref), 0, 0, 0, 3, 0)
    # a blank line is lost when the text is put together again
    assert edit.line_order("one line\n\nother text", "one line\n\nother text", ["one line", "other text"], ["one line", "other text"], 0.5).char_edits == 1


def test_partners_match_plain_greed():
    draw = random.Random(3)
    for _ in range(200):
        a, b = ([("".join(draw.choice("abc") for _ in range(draw.randint(0, 7)))) for _ in range(draw.randint(1, 8))] for _ in "ab")
        near = sorted((-edit.similarity(r, p), i, j) for i, r in enumerate(a) for j, p in enumerate(b) if edit.similarity(r, p) >= 0.5)
        want, taken = {}, set()
        for _s, i, j in near:
            if i not in want and j not in taken:
                want[i] = j
                taken.add(j)
        assert {i: j for i, j, _ in edit.partners(a, b, 0.5)} == want


@pytest.mark.parametrize("few", [0, edit._FEW_PAIRS])
@pytest.mark.parametrize("least", [0.5, 0.3, 0.85])
def test_partners_of_many_lines(least, few, monkeypatch):
    """Shuffled lines with few and many errors, repeated ones and ties, against all pairs; by the index and without it."""
    monkeypatch.setattr(edit, "_FEW_PAIRS", few)
    draw = random.Random(4)
    a = ["".join(draw.choices("abcdefghij  ", k=draw.randint(8, 40))) for _ in range(60)]
    a += a[:5] + ["", ""]
    b = [x for x in a if draw.random() < 0.9] + ["", "zzzz"]
    b = ["".join(c if draw.random() > e else draw.choice("xyz") for c in x) for x in b for e in [draw.choice([0, 0.05, 0.15, 0.3, 0.45])]]
    draw.shuffle(b)
    near = [(i, j, edit.similarity(r, p)) for i, r in enumerate(a) for j, p in enumerate(b)]
    near = [x for x in near if x[2] >= least]
    assert edit.similar_lines(a, b, least) == near
    want, taken = {}, set()
    for i, j, s in sorted(near, key=lambda r: (-r[2], r[0], r[1])):
        if i not in want and j not in taken:
            want[i] = j, s
            taken.add(j)
    assert edit.partners(a, b, least) == [(i, *want[i]) for i in sorted(want)]


def test_two_thousand_shuffled_lines():
    import time

    draw = random.Random(5)
    a = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz    ", k=draw.randint(30, 70))) for _ in range(2000)]
    b = list(enumerate("".join(c if draw.random() > 0.03 else "#" for c in x) for x in a))
    draw.shuffle(b)
    began = time.perf_counter()
    got = edit.partners(a, [x for _, x in b], 0.5)
    assert time.perf_counter() - began < 10
    assert [(i, b[j][0]) for i, j, _ in got] == [(i, i) for i in range(2000)]


MARKED = ["مُحَمَّدٌ", "éaً", "ً́x", "ا́̂ب", "A̖࣓", "ٰٓ", "كتاب", "", "ا ́"]


def test_levels(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(MARKED)], "i int, t string")
    got = {r["i"]: r for r in df.select("i", X.diacritic_insensitive(F.col("t")).alias("b"), X.skeleton("t").alias("s")).collect()}
    for i, t in enumerate(MARKED):
        assert got[i]["b"] == X.bare_of(t)
        assert got[i]["s"] == X.skeleton_of(t)
    assert got[0]["b"] == "محمد" and got[1]["b"] == "éa"


def test_levels_agree_on_all_letters(spark):
    """Every assigned character of the plane, alone and behind an Arabic letter: Spark's expression and Python's agree."""
    chars = [chr(i) for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000]
    df = spark.createDataFrame([(c, "ب" + c, "x" + c) for c in chars], "c string, a string, x string")
    bare = df.select("c", *(X.diacritic_insensitive(F.col(n)).alias(n) for n in ("a", "x"))).collect()
    for r in bare:
        assert r["a"] == X.bare_of("ب" + r["c"]) and r["x"] == X.bare_of("x" + r["c"])


def test_skeleton_rules():
    assert X.skeleton_of("أإآٱ ؤ ئ ء ة ی ک") == "اااا و ي ه ي ك"
    assert X.skeleton_of("٠١٩ ۰۹ «...»؟! ﷲ") == "019 09 الله"
    assert X.skeleton_of("aـb  c\td") == "ab c d"
    assert X.skeleton_of(X.skeleton_of("Élan (x) y")) == X.skeleton_of("Élan (x) y")
    assert all(X.skeleton_of(chr(i)) == ("" if t is None else chr(t)) for i, t in LETTER_FOLD.items() if unicodedata.normalize("NFKC", chr(i)) == chr(i))


def test_white_space_is_pythons(spark):
    every = [chr(i) for i in range(1, 0x3100) if chr(i).isspace()] + ["a", "​"]
    df = spark.createDataFrame([(c, f"{c}[UNREADABLE]{c}", f"a{c}b") for c in every], "c string, m string, w string")
    for r in df.select("c", X.is_blank(F.col("c")).alias("blank"), X.is_marker(F.col("m")).alias("marker"), X.words(F.col("w")).alias("w")).collect():
        assert r["blank"] == r["marker"] == r["c"].isspace()
        assert r["w"] == f"a{r['c']}b".split()


@pytest.mark.parametrize(("text", "yes"), [("  [UNREADABLE]\n", True), ("[UNREADABLE].", False), ("x [UNREADABLE]", False), ("[unreadable]", False), ("", False)])
def test_marker(spark, text, yes):
    assert spark.createDataFrame([(text,)], "t string").select(X.is_marker(F.col("t"))).first()[0] == yes


def test_flag_bounds(spark):
    rows = [("a" * 100, "b" * 200, True), ("a" * 12, "b" * 24, False), ("a" * 1000, "b" * 1150, False), ("a" * 100, "b" * 199, False)]
    df = spark.createDataFrame(rows, "r string, p string, want boolean")
    assert all(r["got"] == r["want"] for r in df.select("want", X.is_runaway(F.col("r"), F.col("p"), 2.0, 100).alias("got")).collect())


def test_file_text_and_prefix(spark):
    df = spark.createDataFrame([("﻿ab\r\n",), ("ab\n\n",), ("ab",), ("\n",)], "t string")
    assert [r[0] for r in df.select(X.file_text(F.col("t"))).collect()] == ["ab", "ab\n", "ab", ""]
    df = spark.createDataFrame([("pre-pre-x",), ("xpre-",)], "t string")
    assert [r[0] for r in df.select(X.strip_prefix(F.col("t"), "pre-")).collect()] == ["pre-x", "xpre-"]


def tokens(w, h, most, least=4):
    import math

    f = 32
    nw, nh = max(f, round(w / f) * f), max(f, round(h / f) * f)
    if nw * nh > most * f * f:
        b = math.sqrt(w * h / (most * f * f))
        nw, nh = max(f, math.floor(w / b / f) * f), max(f, math.floor(h / b / f) * f)
    elif nw * nh < least * f * f:
        b = math.sqrt(least * f * f / (w * h))
        nw, nh = math.ceil(w * b / f) * f, math.ceil(h * b / f) * f
    return (nw // f) * (nh // f)


def test_image_tokens(spark):
    sizes = [(726, 1020), (4000, 4000), (16, 16), (48, 80), (10, 4000), (1, 1), (1280, 1024)]
    df = spark.createDataFrame(sizes, "w int, h int")
    got = [r[0] for r in df.select(X.image_tokens(F.col("w"), F.col("h"), 1280)).collect()]
    assert got == [tokens(w, h, 1280) for w, h in sizes]
    assert got[0] == 736 and got[1] <= 1280


def test_registered_functions(spark):
    X.register(spark)
    assert spark.sql("SELECT char_edits('abc', 'abd') AS c, word_edits('a b', 'a c d') AS w, skeleton('A, b!') AS s, line_similarity('ab', 'ab') AS l").first() == (1, 2, "A b", 1.0)
