"""Tokenizer alignment against a slow walk over both lists of tokens."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quire.llm import alignment as X
from quire.llm.queries import op13_tokenizer_alignment
from tests.llm.conftest import ODD

HARD = [
    " leading", "  two", "a  b", "tab\tx", " ", "\n", "x\n\ny", "x nb sp", "　wide   em", "é ́comb", "emoji \U0001f600 x", "<|endoftext|> <s> </s> <unk> <0x41>", "ﬁ ½ Ａ full", "", None, "trailing ", "a \n b",
    "\x1c x \x85 y", "w w w w w", "▁ under", "a ▁b", "x​ y", "\x00 a", "can't  I'll  '", "12345 6.7", "한국어 текст", "supercalifragilistic " * 40,
]


@pytest.fixture(scope="module")
def sides():
    return X.ByteBpe(f"{X.FOLDER}/{X.BYTE_BPE}"), X.PieceBpe(f"{X.FOLDER}/{X.PIECE_BPE}")


def slow(sides, texts):
    rows, links, counts = [], [], Counter()
    for t in texts:
        ids = [s.encode([f" {t}"])[0] if t else [] for s in sides]
        spelt = [[s.bytes[i] for i in x] for s, x in zip(sides, ids, strict=True)]
        if not t or any(b"".join(x) != f" {t}".encode() for x in spelt):
            ids = spelt = [[], []]
        ends = [np.cumsum([len(y) for y in x]).tolist() for x in spelt]
        spans = [list(zip([0, *e[:-1]], e, strict=True)) if e else [] for e in ends]
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        told, at = [], [0, 0]
        for hi in cuts:
            both = []
            for side in (0, 1):
                start = at[side]
                while at[side] < len(ids[side]) and spans[side][at[side]][1] <= hi:
                    at[side] += 1
                both.append(",".join(map(str, ids[side][start : at[side]])))
            told.append("|".join(both))
        met, k = [], 0
        for i, (a, b) in zip(ids[0], spans[0], strict=True):
            while k and spans[1][k - 1][1] > a:
                k -= 1
            while k < len(ids[1]) and spans[1][k][0] < b:
                if spans[1][k][1] > a:
                    met.append((i, ids[1][k]))
                k += 1
        counts.update(set(met))
        links.append(met)
        rows.append((len(ids[0]), len(ids[1]), len(cuts), len(met), hashlib.sha256(";".join(told).encode()).hexdigest() if ids[0] else ""))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return [(*r[:4], sum(counts[x] == best[x[0]] for x in m), sum(counts[x] for x in m), r[4]) for r, m in zip(rows, links, strict=True)]


def test_hard_texts(spark, sides):
    want = slow(sides, HARD)
    df = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    for parts, block in ((1, X.BLOCK_BYTES), (4, 1)):
        got = {r[0]: tuple(r[1:]) for r in X.aligned(df.repartition(parts), block_bytes=block).collect()}
        for i, t in enumerate(HARD):
            assert got[i] == want[i], t


def test_documents(spark, sf, documents, sides):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    want = dict(zip([i for i, _ in rows], slow(sides, [t for _, t in rows]), strict=True))
    df = op13_tokenizer_alignment(spark, sf)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r[0]: tuple(r[1:]) for r in df.collect()} == want


def test_odd_rows(spark, odd, nothing, sides):
    want = Counter(zip([r[0] for r in ODD], slow(sides, [r[1] for r in ODD]), strict=True))
    assert Counter((r[0], tuple(r[1:])) for r in X.aligned(odd).collect()) == want
    assert X.aligned(nothing).count() == 0


def test_forgetting_changes_nothing(sides, monkeypatch, documents):
    texts = [r["text"] for r in documents.limit(40).collect()]
    whole = X.Aligner(*sides).align(texts)
    monkeypatch.setattr(X, "KEPT", 10)  # known stretches are forgotten before each call
    one = X.Aligner(*sides)
    parts = [one.align(texts[i : i + 7]) for i in range(0, 40, 7)]
    assert [w for p in parts for w in p[1]] == whole[1]
    assert np.concatenate([p[0] for p in parts]).tolist() == whole[0].tolist()


def test_same_ids_as_the_tokenizers_library(documents):
    import tokenizers

    path = f"{X.FOLDER}/{X.BYTE_BPE}"
    plain = tokenizers.Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    texts = [f" {t}" for t in [*HARD, *(r["text"] for r in documents.limit(60).collect())] if t]
    assert X.ByteBpe(path).encode(texts) == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_bitsets():
    draw = np.random.default_rng(3)
    for size in (1, 63, 64, 65, 1000):
        held = np.flatnonzero(draw.random(size) < 0.3)
        bits = X.packed(held, size)
        assert X.select(bits).tolist() == held.tolist()
        assert X.ranks(bits, np.arange(size)).tolist() == [int((held < i).sum()) for i in range(size)]
