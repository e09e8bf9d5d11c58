"""Exact, substring and near dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from quire.llm import components, exact_dedup, passages, phrase_dedup, simhash, substring_dedup
from quire.llm.suffix_array import suffix_array


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def some(i):
    return -(1 << 63) if i is None else i


# ---- exact


def normal(t):
    return re.sub("[\x20\x09-\x0d]+", " ", t or "")


def check_exact(docs):
    groups = defaultdict(list)
    for i, t in rows_of(docs):
        groups[normal(t)].append(i)
    got = exact_dedup.exact_dedup(docs).collect()
    assert len(got) == sum(map(len, groups.values()))
    for r in got:
        g = groups[normal(r["text"])]
        least = min((i for i in g if i is not None), default=None)
        assert (r["keep_id"], r["group_size"], r["kept"]) == (least, len(g), r["doc_id"] == least)
        assert r["text_sha256"] == hashlib.sha256(normal(r["text"]).encode()).hexdigest()


def test_exact(documents, odd):
    check_exact(documents)
    check_exact(odd)


def test_exact_keeps_other_columns(odd, nothing):
    out = exact_dedup.exact_dedup(odd)
    assert out.columns == ["doc_id", "text", "source", "size", "uid", "count", "id", "word", *exact_dedup.VERDICT]
    assert exact_dedup.exact_dedup(nothing).count() == 0


def test_exact_with_a_full_filter(documents):
    """A filter far too small flags everything; results are the same."""
    key = lambda df: sorted(map(tuple, df.select("doc_id", *exact_dedup.VERDICT).collect()))
    assert key(exact_dedup.exact_dedup(documents, max_filter_bits=64)) == key(exact_dedup.exact_dedup(documents))


def test_exact_hot_group(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    kept = exact_dedup.exact_dedup(docs).where("kept")
    assert kept.count() == 2000 - 667 + 1


def test_exact_is_native(documents):
    plan = exact_dedup.exact_dedup(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- substrings


@pytest.mark.parametrize("alphabet", [1, 2, 4, 20])
def test_suffix_array(alphabet):
    draw = random.Random(alphabet)
    for _ in range(300):
        text = [draw.randint(1, alphabet) for _ in range(draw.randint(0, 60))]
        if draw.random() < 0.3:
            text = (text[:4] * 30)[:60]
        text.append(0)
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute_bytes(docs, window=50):
    first, out = {}, []
    for i, t in sorted(docs, key=lambda d: some(d[0])):
        b = (t or "").encode()
        for p in range(len(b) - window + 1):
            first.setdefault(b[p : p + window], i)
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - window + 1):
            if some(first[b[p : p + window]]) < some(i):
                gone[p : p + window] = b"\1" * window
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def brute_words(docs, window=13):
    first, out = {}, []
    for i, t in sorted(docs, key=lambda d: some(d[0])):
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        for p in range(len(w) - window + 1):
            first.setdefault(tuple(w[p : p + window]), i)
    for i, t in docs:
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        gone = [0] * len(w)
        for p in range(len(w) - window + 1):
            if some(first[tuple(w[p : p + window])]) < some(i):
                gone[p : p + window] = [1] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()))
    return sorted(out, key=repr)


def collected(df):
    return sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("hot", [1 << 20, 2])
def test_substrings(documents, odd, hot):
    for docs in (documents.repartition(4), odd):
        assert collected(substring_dedup.substring_dedup(docs, hot=hot)) == brute_bytes(rows_of(docs))
        assert collected(phrase_dedup.phrase_dedup(docs, hot=hot)) == brute_words(rows_of(docs))


def test_substrings_of_mutated_copies(spark):
    """Copies with a changed, a lost and a doubled stretch, around the window's length."""
    draw, base = random.Random(2), "".join(random.Random(1).choice("abcdefg ") for _ in range(400))
    texts = []
    for i in range(60):
        a, n = draw.randrange(300), draw.randint(30, 70)
        texts.append((i, draw.choice([base[a : a + n], base[:a] + "#" + base[a + 1 :], base[:a] + base[a + n :], base[a : a + n] * 2, base[a : a + n] + base[:n]])))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    assert collected(substring_dedup.substring_dedup(docs)) == brute_bytes(texts)
    assert collected(phrase_dedup.phrase_dedup(docs, window=5, anchor=2)) == brute_words(texts, 5)


def test_substrings_through_relays(documents, monkeypatch):
    """Many small shards behind relays of few senders, three levels deep: the same results."""
    monkeypatch.setattr(passages, "BLOCK_BYTES", 1 << 14)
    docs, few = documents.repartition(5), {"shard_anchors": 1 << 11, "fanout": 3, "relayed": 4}
    assert len(passages.route(documents.sparkSession, 27, 3).widths) == 3
    assert collected(substring_dedup.substring_dedup(docs, **few)) == brute_bytes(rows_of(docs))
    assert collected(phrase_dedup.phrase_dedup(docs, **(few | {"shard_anchors": 1 << 9}))) == brute_words(rows_of(docs))


def test_messages_do_not_grow_with_shards(documents, monkeypatch):
    """With ten times the shards, a block sends no more messages than its fan-out."""
    monkeypatch.setattr(passages, "BLOCK_BYTES", 1 << 14)
    plan = passages.Plan(50, 26, lambda ids, texts: substring_dedup.read_bytes(ids, texts, 26), None)
    blocks = passages.pack(documents, "doc_id", "text").select("uid", "blob")
    for shards in (8, 80, 800):
        way = passages.route(documents.sparkSession, shards, 8)
        assert way.shards >= shards
        sent = blocks.mapInArrow(lambda it, way=way: passages._send_hashes(it, plan, way), passages.MESSAGE).groupBy("uid").count()
        assert sent.agg(F.max("count")).first()[0] <= 9


def contexts_of_a_key(n, unit, sides, draw):
    """n contexts around one anchor, of which pairs share windows."""
    made = []
    for i in range(n):
        a, b = [draw.choice(unit) for _ in range(sides)], [draw.choice(unit) for _ in range(sides)]
        if made and draw.random() < 0.5:  # a neighbour's words up to some way off
            p, q = draw.choice(made)
            k = draw.randint(0, sides)
            a[sides - k :], b[: sides - k] = p[sides - k :], q[: sides - k]
        made.append((a, b))
    return made


@pytest.mark.parametrize("n", [300])
def test_large_keys_are_taken_apart(n):
    draw = random.Random(n)
    words = contexts_of_a_key(n, [f"w{i}" for i in range(40)], 8, draw)
    key, least, left = np.zeros(n, np.uint64), np.array([draw.randint(0, 50) for _ in range(n)]), np.full(n, 8)
    texts = [" ".join([*a, "x", "y", "z", "u", "v", *b]).encode() for a, b in words]
    assert all((x == y).all() for x, y in zip(phrase_dedup.solve_words(key, least, left, texts), phrase_dedup.solve_words(key, least, left, texts, most_in_key=4), strict=True))
    sides = contexts_of_a_key(n, "abcd", 24, draw)
    texts = ["".join([*a, "x" * 26, *b]).encode() for a, b in sides]
    left = np.full(n, 24)
    one, other = substring_dedup.solve_bytes(key, least, left, texts), substring_dedup.solve_bytes(key, least, left, texts, most_in_key=4)
    assert (one[1] > 0).any() and all((x == y).all() for x, y in zip(one, other, strict=True))


def test_a_key_at_the_limit():
    """As many different contexts as one task may get of a key take bounded time and memory."""
    import resource

    draw, n = np.random.default_rng(4), 1 << 18
    letters = draw.integers(97, 123, (n, 48), np.uint8)
    texts = [bytes(x[:24]) + b"x" * 26 + bytes(x[24:]) for x in letters]
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    lo, hi = substring_dedup.solve_bytes(np.zeros(n, np.uint64), np.arange(n), np.full(n, 24), texts)
    assert not hi.any() and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_000_000  # kB


def test_phrases_go_through_the_automaton(monkeypatch):
    """Without its automata the operator removes nothing, not even from equal contexts."""
    text = " ".join(f"w{i}" for i in range(21)).encode()
    args = (np.zeros(3, np.uint64), np.array([1, 2, 3]), np.full(3, 8), [text, text, text + b" more"])
    assert phrase_dedup.solve_words(*args)[1].tolist() == [0, 21, 21]

    class Deaf:
        def __init__(self): self.n = 0
        def add_word(self, *_): self.n += 1
        def __len__(self): return self.n
        def make_automaton(self): pass
        def iter(self, _): return iter(())

    monkeypatch.setattr(phrase_dedup.ahocorasick, "Automaton", Deaf)
    assert phrase_dedup.solve_words(*args)[1].tolist() == [0, 0, 0]


def test_substrings_of_nothing(nothing):
    assert substring_dedup.substring_dedup(nothing).count() == 0
    assert phrase_dedup.phrase_dedup(nothing).count() == 0


# ---- near


def slow_fingerprint(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    w = re.findall("[^\x20\x09-\x0d]+", low)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(docs):
    marks = {}
    for _, t in docs:
        marks.setdefault(slow_fingerprint(t), None)
    root = {f: f for f in marks}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    every = list(marks)
    for k, a in enumerate(every):
        for b in every[:k]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for i, t in docs:
        c = find(slow_fingerprint(t))
        if i is not None:
            least[c] = min(i, least.get(c, i))
    return sorted(((i, slow_fingerprint(t), least.get(find(slow_fingerprint(t)))) for i, t in docs), key=repr)


def test_near(documents, odd):
    for docs in (documents, odd):
        got = sorted(((r["id"], r["fp"] % (1 << 64), r["component"]) for r in simhash.near_classes(docs).collect()), key=repr)
        assert got == brute_classes(rows_of(docs))


def test_near_dedup(odd, nothing):
    kept = simhash.near_dedup(odd)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} >= {1, 3, 6, 8}
    assert not {r["doc_id"] for r in kept.collect()} & {2, 4, 5, 7}
    assert simhash.near_classes(nothing).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    draw = random.Random(radius)
    for _ in range(500):
        flips = sum(1 << b for b in draw.sample(range(64), radius))
        assert any(not flips & m for m in masks)


def slow_components(x, radius):
    want = np.arange(len(x))
    while True:
        a, b = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= radius)
        new = want.copy()
        np.minimum.at(new, a, want[b])
        if (new == want).all():
            return want
        want = new


@pytest.mark.parametrize(("split", "most", "n"), [(2048, 14, 300), (4, 14, 300), (4, 40, 300), (16, 28, 2000)])
def test_components_of_a_bucket(monkeypatch, split, most, n):
    """Sparse and dense buckets, cut or not."""
    monkeypatch.setattr(simhash, "SPLIT", split)
    draw = np.random.default_rng(3)
    x = np.unique(draw.integers(0, 1 << most, n).astype(np.uint64))
    x = np.unique(np.r_[x, x[:40] ^ np.uint64(3), x[:20] ^ np.uint64(12)])
    root = {i: i for i in range(len(x))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in zip(*simhash.bucket_links(x, 2, (1 << most) - 1), strict=True):
        p, q = sorted((find(int(a)), find(int(b))))
        root[q] = p
    assert [find(i) for i in range(len(x))] == slow_components(x, 2).tolist()


def test_large_bucket_without_links():
    """A hundred thousand words of one bucket, few of which are near: not all pairs are looked at."""
    import time

    x = np.unique(np.random.default_rng(1).integers(0, 1 << 28, 100_000).astype(np.uint64) * np.uint64(16))
    began = time.perf_counter()
    simhash.bucket_links(x, 2, (1 << 32) - 16)
    assert time.perf_counter() - began < 30  # all pairs take minutes


def test_near_stage(spark):
    """Texts of 400 words with a replaced one go, others stay; a thousand copies are one group."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    texts = []
    for i in range(30):
        w = [word() for _ in range(400)]
        texts.append((10 * i, " ".join(w)))
        w[draw.randrange(400)] = "x"
        texts.append((10 * i + 1, " ".join(w)))
        w[200:] = [word() for _ in range(200)]
        texts.append((10 * i + 2, " ".join(w)))
    base = [word() for _ in range(300)]
    for i in range(1500):
        w = base.copy()
        w[i % 300] = f"y{i}"
        texts.append((10_000 + i, " ".join(w)))
    kept = {r["doc_id"] for r in simhash.near_dedup(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()}
    assert kept >= {10 * i for i in range(30)} | {10 * i + 2 for i in range(30)}
    assert not kept & {10 * i + 1 for i in range(30)}
    assert [k for k in kept if k >= 10_000] == [10_000]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (300, 200), (300, 400), (7, 7)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 200, 300, 400), 100)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_has_what_it_says():
    assert any(i is None for i, _, _ in ODD) and any(t is None for _, t, _ in ODD)
