"""Phrase collocations against counts by hand."""

import re
from collections import Counter, defaultdict
from random import Random
from time import sleep
from zlib import crc32

import numpy as np
import pytest

from quire.llm import collocations as X
from quire.llm.queries import op12_phrase_collocations
from tests.llm.conftest import ODD, SCHEMA


def slow(rows, longest=3, least=10, covered=50, report=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        kept, around = [], Counter()
        for q, b in found.items():
            for k in range(2, len(q)):
                for i in range(len(q) - k + 1):
                    around[q[i : i + k]] = max(around[q[i : i + k]], b)
        for p, a in found.items():
            if 100 * around[p] >= covered * a:
                continue
            score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        kept.sort()
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(kept[:report])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_documents(spark, sf, documents):
    got = op12_phrase_collocations(spark, sf)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert rows_of(got) == slow([(r["text"], r["lang"]) for r in documents.collect()])


def test_random_texts(spark):
    draw = Random(5)
    words, rows = ["a", "B", "c", "É", " ", "x-y", "\x1c"], []
    for i in range(60):
        marks = draw.choices([" ", "  ", "\t", ". ", "\n", ",", "?", "\x0b", "\r"], [9, 1, 1, 1, 1, 1, 1, 1, 1], k=40)
        rows.append((i, "".join(draw.choice(words) + m for m in marks), draw.choice(["x", "y", None, ""])))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for kwargs in ({"longest": 4, "least": 3}, {"longest": 2, "covered": 80, "report": 3}):
        want = slow([r[1:] for r in rows], **kwargs)
        assert rows_of(X.collocations(df, **kwargs)) == want
        assert len(want) >= 9
    want = slow([r[1:] for r in rows])
    found, words = X.phrases(df, block_words=50)  # many blocks name the same words
    assert rows_of(found) == sorted((r[0], *r[2:6], r[7]) for r in want)
    assert {tuple(r) for r in words.collect()} == {(r[0], r[6]) for r in want}


def test_common_phrases_and_ties(spark):
    """A pair in every document, and phrases with the same figures: they stand in order."""
    rows = [(i, "of the. alpha beta, gamma delta", "en") for i in range(12)] + [(20, "one two " * 30, "en"), (21, "same " * 50, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = slow([r[1:] for r in rows])
    assert rows_of(X.collocations(df)) == want
    assert [r[2] for r in want if r[3] == 12] == ["alpha beta", "gamma delta", "of the"]


def test_odd_rows(spark, odd, nothing):
    rows = spark.createDataFrame([(*r, "k", 1, "s", "u", 2, 3, "w") for r in ODD], SCHEMA)
    assert rows_of(X.collocations(odd, lang_col="source", least=2)) == slow([(r["text"], r["source"]) for r in rows.collect()], least=2)
    assert X.collocations(nothing, lang_col="source").count() == 0
    blank = spark.createDataFrame([(1, " ", "x"), (2, None, None)], "doc_id long, text string, lang string")
    assert X.collocations(blank).count() == 0


def test_products_beyond_64_bits(spark):
    """a a 1000000 passes 2^63 from three million on."""
    f, l, r = 40_000_000_000, 50_000_000_000, 60_000_000_000
    df = spark.createDataFrame([(f, [l, f], [r, f])], "f long, pre array<long>, suf array<long>")
    assert tuple(df.select(X._scored(2).alias("c")).first()["c"]) == (1000000 * f * f // (l * r), 1, l, r)


def test_rare_pairs_take_few_bytes(spark):
    """Nearly all pairs are rare; a row for each of them took 16 bytes and more of shuffle."""
    draw = Random(12)
    words = [f"w{i}" for i in range(800)]
    rows = [(i, " ".join(draw.choices(words, k=400)), draw.choice("xy")) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    def shuffled():
        sleep(0.5)
        spark.range(1).collect()  # the end of a task brings the figures up to date
        sleep(0.5)
        return spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()

    before = shuffled()
    found, _ = X.phrases(df, least=5, block_words=50_000)
    got = rows_of(found)
    assert shuffled() - before < 8 * 200_000
    assert got == sorted((r[0], *r[2:6], r[7]) for r in slow([r[1:] for r in rows], least=5, report=10**6))


def test_words_of_one_hash(spark):
    assert crc32(b"plumless") == crc32(b"buckeroo")
    rows = [(i, "plumless buckeroo plumless. buckeroo x", "en" if i < 15 else "de") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    assert rows_of(X.collocations(df)) == slow([r[1:] for r in rows]) != []


@pytest.mark.parametrize("columns", [[[], []], [[0], [5]], [[0, 255, 256], [1 << 62, 3, 0]], [list(range(1000)), [7] * 1000]])
def test_packed_columns(columns):
    back = X._unpack(X._pack(*(np.array(c, np.int64) for c in columns)), len(columns))
    assert [c.tolist() for c in back] == columns


def test_pairs_of_large_names():
    """Names whose product passes 2^63 still give one number for each pair."""
    a, b = np.array([1 << 40, 3, 1 << 40, 3, 4]), np.array([1 << 41, 0, 1 << 41, 1 << 41, 0])
    for key in (X._one_key(a, b), X._one_key(a % 7, b % 5)):
        assert key[0] == key[2] and key.min() >= 0
    assert len(set(X._one_key(a, b).tolist())) == 4
