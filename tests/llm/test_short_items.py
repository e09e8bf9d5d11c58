"""Benchmark items of fewer than 13 words: whole ones and ones with every allowed number of replaced words."""

from itertools import combinations

from quire.llm import decontam


def test_short_items(spark):
    items = [(n, " ".join(f"w{n}x{i}" for i in range(n))) for n in range(1, 13)]
    docs, want = [], set()
    for n, text in items:
        w = text.split()
        for k in range(n):
            for gone in combinations(range(n), k):
                if k > 3:
                    break
                part = ["zz" if i in gone else x for i, x in enumerate(w)]
                docs.append((len(docs), f"before this {' '.join(part)} and after"))
                if n - k >= 0.8 * n:
                    want.add((docs[-1][0], n))
    found = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["id"], r["item"]) for r in found.collect()} == want
