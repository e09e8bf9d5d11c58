"""The toxicity classifier: held-out accuracy, its penalty, its scores by hand."""

import math
import random
import zlib

import pytest

from quire.llm import toxicity as X
from quire.llm.queries import op11_toxicity


def auc(scores, labels):
    order = sorted(zip(scores, labels, strict=True))
    ranks, i = 0.0, 0
    while i < len(order):
        j = i
        while j < len(order) and order[j][0] == order[i][0]:
            j += 1
        ranks += sum(y for _, y in order[i:j]) * (i + j + 1) / 2
        i = j
    p = sum(labels)
    return (ranks - p * (p + 1) / 2) / (p * (len(labels) - p))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    df = op11_toxicity(spark, sf)
    assert df.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r["doc_id"]: r for r in df.collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == 10_000
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1
    held = [(rows[i]["score"], y) for i, y in labels.items() if i in rows and rows[i]["held_out"]]
    assert auc(*zip(*held, strict=True)) > 0.95
    assert sum(s >= 0.7 for s, y in held if y) > 0.8 * sum(y for _, y in held)
    assert sum(s >= 0.7 for s, y in held if not y) < 0.01 * sum(1 - y for _, y in held)


KNOWN = ["idiotic", "wretched", "vermin"]


@pytest.fixture(scope="module")
def biased(spark):
    """Insults make a text toxic, some of them rare ones; most texts with insults name one group, so its name alone looks like an insult."""
    draw, rows = random.Random(2), []
    common = "house river stone green walk table morning paper cloud window garden letter".split()
    for i in range(1500):
        toxic = draw.random() < 0.4
        words = draw.choices(common, k=12)
        if toxic:
            words[draw.randrange(6)] = draw.choice(KNOWN) if draw.random() < 0.6 else "".join(draw.choices("bcdfgklmnprstvz", k=9))
        if draw.random() < (0.8 if toxic else 0.04):  # in the other half, so that no insult is written over
            words[draw.randrange(6, 12)] = "muslims"
        elif draw.random() < 0.2:
            words[draw.randrange(6, 12)] = draw.choice(["christians", "jews", "hindus"])
        rows.append((i, " ".join(words) + ".", int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_neutral_mentions_score_lower(biased):
    labels = biased.select("doc_id", "toxic")
    free, held = (X.fit_toxicity(biased, labels, fairness=w) for w in (0.0, X.FAIRNESS))
    say = lambda m, t: m.score(X.words_of(t), m.automaton())
    neutral, other, insult = "the garden of muslims by the river", "the garden of hindus by the river", "the wretched garden of hindus by the river"
    assert say(free, neutral) > 0.7  # the bias is learned without the penalty
    assert say(held, neutral) < 0.7
    logit = lambda p: math.log(p / (1 - p))
    gap = [logit(say(m, neutral)) - logit(say(m, other)) for m in (free, held)]
    assert abs(gap[1]) < 0.3 * abs(gap[0])
    assert say(held, insult) > 0.7
    texts = [(r["text"], r["toxic"]) for r in biased.collect() if not r["toxic"] or any(w in r["text"] for w in KNOWN)]
    assert auc([say(held, t) for t, _ in texts], [y for _, y in texts]) > 0.99


def test_score_by_hand(documents):
    model = X.LinearModel([" idi", " idiot ", " sc", " the "], X.np.array([1.0, 2.0, 4.0, -0.5]), -1.0)
    a = model.automaton()
    for text, z in (("The IDIOT idiots scum", -1 + 1 + 2 + 4 - 0.5), ("", -1.0), (None, -1.0), ("idiot9 x", 2.0), ("lidiot", -1.0), ("éscum the", -1.5), ("the the", -1.5)):
        assert model.score(X.words_of(text), a) == pytest.approx(1 / (1 + math.exp(-z)))
    terms = [" tha", " th", " on ", " an "]
    a = X.LinearModel(terms).automaton()
    for r in documents.collect():
        words = X.words_of(r["text"])
        assert X.held_by(words, a) == [i for i, t in enumerate(terms) if any(t in f" {w} " for w in words)]


def test_swapped():
    lines = [["a", "b", "c"], ["x", "y"]]
    assert X.swapped(["a", "q", "x"], lines, 3) == [["b", "q", "y"], ["c", "q", "y"]]
    assert X.swapped(["q"], lines) == []
    for line in X.IDENTITY:
        for other in X.swapped([line[0], "and"]):
            assert other[0] in line[1:] and other[1] == "and"


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 0), (8, 1), (None, 1), (6, None), (11, 1), (2, 0), (10, 0), (10, 0)], "doc_id long, toxic int")
    rows = X.toxicity_scores(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(r["held_out"] for r in rows if r["id"] is None)
    empty = {r["score"] for r in rows if r["id"] in (3, 4, 5)}
    assert len(empty) == 1
    assert X.toxicity_scores(nothing, labels).count() == 0
    assert {r["score"] for r in X.toxicity_scores(odd, labels.limit(0)).collect()} == {0.5}
    one = X.toxicity_scores(odd, spark.createDataFrame([(1, 1), (2, 1), (6, 1), (7, 1), (8, 1)], "doc_id long, toxic int")).collect()
    assert len({r["score"] for r in one}) == 1
