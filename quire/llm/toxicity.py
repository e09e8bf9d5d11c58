"""Toxicity: a linear classifier whose scores are held still while identity terms change places."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import settle

#: Labelled rows that the model is fitted on at most; above, a hash of the id picks about so many.
MAX_TRAINING_ROWS = 20_000
#: A document with this score or more is toxic.
THRESHOLD = 0.7
#: Letter groups that the model looks at, and the fewest labelled documents that have one.
TERMS, LEAST_DOCUMENTS = 8192, 3
#: Lengths of letter groups at a word's start; a whole word counts at every length up to MAX_WORD.
SHORTEST, LONGEST, MAX_WORD = 3, 9, 40
#: Weights of the counterfactual penalty and of the sizes of coefficients; steps of the fit.
FAIRNESS, RIDGE, STEPS = 4.0, 3e-4, 300
#: Sentences with an identity term that a labelled document gives at most, and swaps of each.
SENTENCES, SWAPS = 8, 3

# Identity terms by what they tell; terms of one line stand for each other.
IDENTITY = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("female", "male"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual", "homosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants", "sikhs"),
    ("black", "white", "asian", "latino", "hispanic", "african", "european", "arab"),
    ("american", "mexican", "chinese", "indian", "russian", "turkish", "polish", "german", "french", "spanish"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("old", "young", "elderly"),
    ("disabled", "deaf", "blind", "autistic"),
    ("frauen", "männer", "mädchen", "jungen"), ("muslime", "christen", "juden", "hindus", "buddhisten"), ("ausländer", "flüchtlinge", "deutsche", "türken", "polen"),
    ("femmes", "hommes", "filles", "garçons"), ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes"), ("immigrés", "réfugiés", "étrangers", "français", "arabes"),
    ("mujeres", "hombres", "niñas", "niños"), ("musulmanes", "cristianos", "judíos", "hindúes", "budistas"), ("inmigrantes", "refugiados", "extranjeros", "españoles", "gitanos"),
)

_LETTERS = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    return _LETTERS.findall((text or "").lower())


def groups_of(word: str) -> Iterator[str]:
    """A word's beginnings after a space, and the whole word between spaces."""
    for n in range(SHORTEST, min(LONGEST, len(word)) + 1):
        yield f" {word[:n]}"
    if len(word) <= MAX_WORD:
        yield f" {word} "


def swapped(sentence: Sequence[str], lines: Sequence[Sequence[str]] = IDENTITY, swaps: int = SWAPS) -> list[list[str]]:
    """The words of a sentence with each identity term replaced by another of its line: the next one, the one after that, and so on."""
    place = {t: (line, i) for line in lines for i, t in enumerate(line)}
    most = max((len(place[w][0]) for w in sentence if w in place), default=1)
    out = []
    for step in range(1, min(swaps, most - 1) + 1):
        out.append([place[w][0][(place[w][1] + 1 + (step - 1) % max(1, len(place[w][0]) - 1)) % len(place[w][0])] if w in place else w for w in sentence])
    return out


@dataclass
class LinearModel:
    """score = 1 / (1 + exp(-(base + the weights of the letter groups that a text has))); each group counts once."""

    terms: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    base: float = 0.0

    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for i, t in enumerate(self.terms):
            a.add_word(t, i)
        a.make_automaton()
        return a

    def score(self, words: list[str], automaton: ahocorasick.Automaton) -> float:
        z = self.base + math.fsum(self.weights[held_by(words, automaton)])
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def held_by(words: Iterable[str], automaton: ahocorasick.Automaton) -> list[int]:
    """The numbers of the letter groups in a text's words, in order."""
    return sorted({i for _, i in automaton.iter(f" {'  '.join(dict.fromkeys(words))} ")}) if len(automaton) else []


class _Rows:
    """Sparse rows of ones."""

    def __init__(self, rows: Sequence[Sequence[int]], width: int):
        self.width, self.size = width, np.fromiter(map(len, rows), np.int64, len(rows))
        self.at = np.fromiter((i for r in rows for i in r), np.int64, int(self.size.sum()))
        self.of = np.repeat(np.arange(len(rows)), self.size)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, w[self.at], len(self.size))

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, g[self.of], self.width)


def fit(rows: Sequence[Sequence[int]], y: np.ndarray, pairs: Sequence[tuple[Sequence[int], Sequence[int]]], width: int, fairness: float = FAIRNESS, ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and base of least mean log loss + fairness / 2 times the mean squared change of the logit over the pairs (a sentence
    and one with its identity terms swapped) + ridge / 2 times the squared weights, by gradient steps with momentum.

    Both labels weigh the same. Without rows or with one label only there are no weights, and the base is the smoothed share.
    """
    w = np.zeros(width)
    base = (y.sum() + 0.5) / (len(y) + 1.0)
    if not len(y) or y.min() == y.max():
        return w, math.log(base / (1 - base))
    x, before, after = _Rows(rows, width), _Rows([p[0] for p in pairs], width), _Rows([p[1] for p in pairs], width)
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    rare = 1 / np.sqrt(np.maximum(x.back(share), 1e-4))  # steps fit how common a group is
    b, v, vb, seen, seen_b = 0.0, np.zeros(width), 0.0, np.zeros(width), 0.0
    for k in range(steps):
        g = share * (1 / (1 + np.exp(-np.clip(x.times(w) + b, -60, 60))) - y)
        grad = x.back(g) + ridge * w
        if pairs:
            d = before.times(w) - after.times(w)
            grad += fairness / len(pairs) * (before.back(d) - after.back(d))
        grad_b = float(g.sum())
        v, vb = 0.9 * v + 0.1 * grad * rare, 0.9 * vb + 0.1 * grad_b
        seen, seen_b = 0.99 * seen + 0.01 * (grad * rare) ** 2, 0.99 * seen_b + 0.01 * grad_b**2
        rate = 0.05 * (1 - k / steps)
        w -= rate * v / (np.sqrt(seen / (1 - 0.99 ** (k + 1))) + 1e-6)
        b -= rate * vb / (math.sqrt(seen_b / (1 - 0.99 ** (k + 1))) + 1e-6)
    return w, b


def _held_out(c: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(c.cast("string")), F.lit(3)) == 1, F.lit(True))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (y, text) to letter groups with the toxic and the other documents that have them, added up in portions."""
    sums: tuple[Counter[str], Counter[str]] = Counter(), Counter()

    def portion() -> Iterator[pa.RecordBatch]:
        keys = list(sums[0] | sums[1])
        for i in range(0, len(keys), 1 << 16):
            part = keys[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *(pa.array([s[k] for k in part], pa.int64()) for s in reversed(sums))], names=["term", "toxic", "other"])
        for s in sums:
            s.clear()

    for b in batches:
        for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            sums[y].update({g for w in set(words_of(t)) for g in groups_of(w)})
            if len(sums[0]) + len(sums[1]) > 1 << 20:
                yield from portion()
    yield from portion()


def _association(n1: int, n0: int) -> Column:
    """The log-likelihood ratio of a letter group in `toxic` of n1 documents and in `other` of n0, against one rate for both."""
    cell = lambda seen, of, n: F.when(seen > 0, seen * F.log(seen * (n1 + n0) / (of * n))).otherwise(0.0)
    a, b = F.col("toxic"), F.col("other")
    return 2 * (cell(a, a + b, F.lit(n1)) + cell(b, a + b, F.lit(n0)) + cell(n1 - a, n1 + n0 - a - b, F.lit(n1)) + cell(n0 - b, n1 + n0 - a - b, F.lit(n0)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_TRAINING_ROWS, fairness: float = FAIRNESS, identity: Sequence[Sequence[str]] = IDENTITY) -> LinearModel:
    """The model, fitted on the driver on labelled rows whose id's CRC-32 modulo 3 is not 1.

    A hash of the id picks about max_rows of them. Their letter groups are counted where the documents are read; at most TERMS, those that tell
    more about the label than any would by chance, are the model's. Only the picked documents' numbers of these come to the driver, with those of their
    sentences that name a group of people and of the same sentences with another group's name.
    """
    marked = labels.select(F.col(f"`{id_col}`").alias("of"), F.col(f"`{label_col}`").cast("int").alias("y")).where("y in (0, 1)").where(~_held_out(F.col("of")))
    n = marked.count()
    picked = marked.where(F.pmod(F.xxhash64("of"), F.lit(1 << 20)) < min(1 << 20, math.ceil((1 << 20) * max_rows / max(1, n)))).limit(2 * max_rows)
    taken = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).join(F.broadcast(picked), F.col("id") == F.col("of")).select(F.col("id").cast("string").alias("id"), "y", "text")
    taken = settle(taken.limit(4 * max_rows).repartition(max(8, docs.sparkSession.sparkContext.defaultParallelism)))  # a limit leaves one partition
    counted = taken.select("y", "text").mapInArrow(_count, "term string, toxic long, other long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    sizes = {r["y"]: r["n"] for r in taken.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    counted = settle(counted.where(F.col("toxic") + F.col("other") >= LEAST_DOCUMENTS))
    chance = 2 * math.log(max(2, counted.count()))  # so much less than one group is expected to reach by chance
    best = counted.withColumn("told", F.round(_association(n1, n0), 6)).where(F.col("told") >= chance).orderBy(F.desc("told"), "term").limit(TERMS).collect()
    model = LinearModel([r["term"] for r in best])
    terms, lines = model.terms, [list(x) for x in identity]
    named = {t for line in lines for t in line}

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = LinearModel(terms).automaton()
        for b in batches:
            held, pairs = [], []
            for t in b.column(2).to_pylist():
                held.append(held_by(words_of(t), automaton))
                ours: list[list[list[int]]] = []
                for s in _SENTENCE.findall(t or ""):
                    if len(ours) >= SENTENCES * SWAPS:
                        break
                    if not named.isdisjoint(words := words_of(s)):
                        a = held_by(words, automaton)
                        ours += [[a, c] for c in (held_by(other, automaton) for other in swapped(words, lines)) if a != c]
                pairs.append(ours)
            kinds = pa.list_(pa.int32()), pa.list_(pa.list_(pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(held, kinds[0]), pa.array(pairs, kinds[1])], names=["id", "y", "held", "pairs"])

    sample = taken.mapInArrow(rows_of, "id string, y int, held array<int>, pairs array<array<array<int>>>").collect()
    sample.sort(key=lambda r: (r["id"], r["y"], r["held"]))
    pairs = [(a, b) for r in sample for a, b in r["pairs"]]
    model.weights, model.base = fit([r["held"] for r in sample], np.array([r["y"] for r in sample], np.float64), pairs, len(terms), fairness)
    used = np.flatnonzero(model.weights)
    return LinearModel([terms[i] for i in used], model.weights[used], model.base)


def score_of(model: LinearModel) -> Callable[[Column], Column]:
    """A function of a text column to its score: one pass of an automaton over the text's distinct words."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = model.automaton()
        for texts in batches:
            yield pd.Series([model.score(words_of(t if isinstance(t, str) else None), automaton) for t in texts], dtype="float64")

    return score


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_TRAINING_ROWS, threshold: float = THRESHOLD, fairness: float = FAIRNESS, identity: Sequence[Sequence[str]] = IDENTITY) -> DataFrame:
    """id, held_out, score and predicted of every row of docs, scored in one pass over the whole texts without a shuffle.

    The model is fit_toxicity's: letter groups at the beginnings of words, whole words, and a penalty on each change of a labelled sentence's
    logit when its identity terms are swapped. So a word that names a group of people cannot carry what the insults around it
    should. identity: lines of terms that stand for each other. Ids, labels and other columns are no inputs of a score.

    Null and empty texts get the score of a text without any letter group; very long ones are scored whole. A null id counts as held
    out and meets no label; null labels teach nothing; repeated rows count as often as they stand. Without labelled rows each
    score is 1/2; an empty table gives an empty result.
    """
    score = score_of(fit_toxicity(docs, labels, id_col, text_col, label_col, max_rows, fairness, identity))
    scored = docs.select(F.col(f"`{id_col}`").alias("id"), score(F.col(f"`{text_col}`").cast("string")).alias("score"))
    return scored.select("id", _held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
