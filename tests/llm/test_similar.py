"""The pipeline's near-duplicate stage against exact similarities of all pairs."""

import re
from collections import defaultdict

import numpy as np

from quire.llm import simhash


def five_words(text):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def slow_kept(docs, similarity=0.8):
    sets = [five_words(t) for _, t in docs]
    held, shared = defaultdict(list), defaultdict(int)
    for k, s in enumerate(sets):
        for h in s:
            for other in held[h]:
                shared[other, k] += 1
            held[h].append(k)
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in shared.items():
        if n / (len(sets[a]) + len(sets[b]) - n) >= similarity:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {docs[k][0] for k in range(len(docs)) if find(k) == k}


def test_all_similar_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = slow_kept(sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()))
    assert {r["doc_id"] for r in simhash.near_dedup(docs).collect()} == want


def test_cloud_around_the_limit(spark):
    """Hundreds of texts just above and just below the similarity: the same components as by brute force."""
    import random

    draw = random.Random(3)
    base = [f"w{draw.randrange(10**6)}" for _ in range(120)]
    docs = []
    for i in range(400):
        w = base.copy()
        for _ in range(draw.choice([1, 2, 3, 30])):
            w[draw.randrange(120)] = f"x{draw.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = slow_kept(docs)
    rows = simhash.similar_classes(df).collect()
    assert len(rows) == 400 and {r["id"] for r in rows if r["id"] == r["component"]} == want


def test_forest_connects():
    """A chain of texts, each like the next only, is connected by a bucket's links."""
    draw = np.random.default_rng(2)
    marks = np.tile(draw.integers(0, 256, 80, dtype=np.uint8), (40, 1))
    for i in range(1, 40):
        marks[i] = marks[i - 1]
        marks[i, draw.choice(80, 14, replace=False)] = draw.integers(0, 256, 14)
    heads, tails = simhash._candidates(marks, 51, 72)
    assert {tuple(sorted(x)) for x in zip(heads, tails, strict=True)} >= {(i, i + 1) for i in range(39) if (marks[i] == marks[i + 1]).sum() >= 66}
    assert max(tails.count(i) for i in range(40)) <= simhash.GUESSES + 39  # sure ones, and some others


def cloud(n, words, swapped, vocabulary, seed):
    """Variants of one text, each with some words replaced from a small vocabulary: similarities pile up around one value."""
    import random

    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**6)}" for _ in range(words)]
    docs = []
    for i in range(n):
        w = base.copy()
        for k in draw.sample(range(words), swapped):
            w[k] = f"x{draw.randrange(vocabulary)}"
        docs.append((i, " ".join(w)))
    return docs


def components(docs, similarity=0.8):
    sets = [five_words(t) for _, t in docs]
    names = {h: k for k, h in enumerate(dict.fromkeys(h for s in sets for h in s))}
    held = np.zeros((len(docs), len(names)), np.float32)
    for k, s in enumerate(sets):
        held[k, [names[h] for h in s]] = 1
    both, size = held @ held.T, held.sum(1)
    near = both / (size[:, None] + size[None] - both) >= similarity
    label = np.arange(len(docs))
    while True:
        now = np.array([label[r].min() for r in near])
        if (now == label).all():
            return label.tolist(), int(np.triu(near, 1).sum())
        label = now


def test_dense_clouds(spark):
    """Thousands of pairs below the limit in one bucket hide the few above it: none of these is lost."""
    docs = [(i + 10_000 * k, t) for k, (n, swapped) in enumerate([(1500, 3), (1200, 2)]) for i, t in cloud(n, 120, swapped, 10**6, k)]
    want, pairs = components(docs)
    assert 1000 < pairs < 1_500_000
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = {r["id"]: r["component"] for r in simhash.similar_classes(df).collect()}
    assert [got[i] for i, _ in docs] == [docs[k][0] for k in want]


def test_shares_of_a_bucket(spark, monkeypatch):
    """Buckets dealt out in shares of sixteen give what whole buckets give."""
    docs = cloud(300, 120, 3, 10**6, 5)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(simhash, "SHARE", 16)
    monkeypatch.setattr(simhash, "GUESSES", 1)
    want, _ = components(docs)
    got = {r["id"]: r["component"] for r in simhash.similar_classes(df).collect()}
    assert [got[i] for i, _ in docs] == want
