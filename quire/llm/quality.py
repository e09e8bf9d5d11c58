"""Quality classifier: a generalised additive model with pairwise interactions, learned by cyclic boosting."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that the model is fitted on at most; above, a hash of the id picks about so many.
MAX_TRAINING_ROWS = 20_000
#: A document with this score or more is accepted.
THRESHOLD = 0.3
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, LEAF_ROWS = 120, 60, 0.15, 20

FEATURES = (
    "log_chars", "log_words", "word_length", "longest_word", "upper", "digit", "space", "stop", "clause", "bang", "quote", "bar", "symbol",
    "other", "distinct_words", "top_word", "short_words", "marked_words", "upper_words", "log_line", "repeated_lines", "ended_lines",
)


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


_CLASSES = np.stack([
    _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class(b"0123456789"), _class(b" \t\n\v\f\r"), _class(b"."), _class(b",;:"), _class(b"!?"), _class(b"\"'()[]-"), _class(b"|"),
    _class(b"#$%&*+/<=>@\\^_`{}~"), np.r_[np.zeros(128), np.ones(64), np.zeros(64)],
])
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def features(text: str | None) -> list[float]:
    """FEATURES of a whole text: shares of its bytes, words and lines. Nothing else than the text is looked at."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    shares = (_CLASSES @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / n).tolist()
    words = raw.split()
    if not words:
        return [math.log1p(len(raw)), 0.0, 0.0, 0.0, *shares, *[0.0] * 8]
    k, counts = len(words), Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, k)
    marked = upper = 0
    for w, c in counts.items():
        marked += c * (len(w) - len(w.strip(_MARKS)) >= 2)
        upper += c * (w.isupper() and len(w) > 1)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ended = sum(x.rstrip()[-1:] in b".!?:" for x in lines)
    return [
        math.log1p(len(raw)), math.log1p(k), float(lengths.mean()), math.log1p(int(lengths.max())), *shares,
        len(counts) / k ** 0.8, max(counts.values()) / k, float((lengths <= 3).mean()), marked / k, upper / k,
        math.log1p(len(raw) / len(lines)), 1 - len(set(lines)) / len(lines), ended / len(lines),
    ]


@dataclass
class AdditiveModel:
    """score = 1 / (1 + exp(-(base + one table's value for each feature and pair)))."""

    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    base: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for j, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += t[np.searchsorted(e, x[:, j], side="right")]
        for i, j, e, f, t in self.pairs:
            z += t[np.searchsorted(e, x[:, i], side="right"), np.searchsorted(f, x[:, j], side="right")]
        return 1 / (1 + np.exp(-z))


def _edges(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.arange(1, bins) / bins, method="higher"))


def _leaves(g: np.ndarray, h: np.ndarray, n: np.ndarray, cuts: int) -> np.ndarray:
    """Newton steps of a tree of up to `cuts` cuts over the bins' sums of gradients g, curvatures h and rows n."""
    gs, hs, ns, marks = np.r_[0, g.cumsum()], np.r_[0, h.cumsum()], np.r_[0, n.cumsum()], [0, len(g)]
    part = lambda a, b: (gs[b] - gs[a]) ** 2 / (hs[b] - hs[a] + 1.0)
    for _ in range(cuts):
        best, cut = 1e-9, None
        for a, b in zip(marks, marks[1:], strict=False):
            c = np.arange(a + 1, b)
            c = c[(ns[c] - ns[a] >= LEAF_ROWS) & (ns[b] - ns[c] >= LEAF_ROWS)]
            if len(c) and (gain := part(a, c) + part(c, b) - part(a, b)).max() > best:
                best, cut = gain.max(), c[gain.argmax()]
        if cut is None:
            break
        marks = sorted([*marks, cut])
    out = np.zeros(len(g))
    for a, b in zip(marks, marks[1:], strict=False):
        out[a:b] = (gs[b] - gs[a]) / (hs[b] - hs[a] + 1.0)
    return out


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting, one feature after the other, of trees with two cuts; then of the pairs that explain most of the rest.

    Without rows the score is 1/2; with one class only it is that class's smoothed share.
    """
    base = (y.sum() + 0.5) / (len(y) + 1.0)
    m = AdditiveModel(base=math.log(base / (1 - base)))
    if not len(y) or y.min() == y.max():
        return m
    m.edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])]
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    at = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(m.edges)]
    z = np.full(len(y), m.base)
    sums = lambda k, size, p: (np.bincount(k, y - p, size), np.bincount(k, p * (1 - p), size), np.bincount(k, minlength=size))
    for _ in range(ROUNDS):
        for j, k in enumerate(at):
            step = RATE * _leaves(*sums(k, len(m.tables[j]), 1 / (1 + np.exp(-z))), cuts=2)
            m.tables[j] += step
            z += step[k]
    coarse = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    low = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]
    gains = []
    for i in range(x.shape[1]):
        for j in range(i):
            g, h, _ = sums(low[i] * PAIR_BINS + low[j], PAIR_BINS**2, 1 / (1 + np.exp(-z)))
            gains.append((float((g**2 / (h + 1.0)).sum()), i, j))
    chosen = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    m.pairs = [(i, j, coarse[i], coarse[j], np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for i, j in chosen]
    for _ in range(PAIR_ROUNDS):
        for i, j, _, _, t in m.pairs:
            g, h, n = (s.reshape(t.shape) for s in sums(low[i] * t.shape[1] + low[j], t.size, 1 / (1 + np.exp(-z))))
            rows = _leaves(g.sum(1), h.sum(1), n.sum(1), cuts=1)  # one cut of the first feature, then one of the second on each side
            step = np.zeros(t.shape)
            cut = int(np.flatnonzero(np.diff(rows))[0]) + 1 if np.diff(rows).any() else len(rows)
            for part in (slice(0, cut), slice(cut, len(rows))):
                step[part] = _leaves(g[part].sum(0), h[part].sum(0), n[part].sum(0), cuts=1)
            t += RATE * step
            z += RATE * step[low[i], low[j]]
    return m


def _held_out(c: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(c.cast("string")), F.lit(5)) == 0, F.lit(True))


def _matrix(rows: Iterable[list[float]]) -> np.ndarray:
    return np.array([*rows], np.float64).reshape(-1, len(FEATURES))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_TRAINING_ROWS) -> AdditiveModel:
    """The model, fitted on the driver on labelled rows whose id's CRC-32 modulo 5 is not 0.

    A hash of the id picks about max_rows of them. The picked labels, whose number bounds the broadcast, meet the documents
    where they are read, and only those documents' features come to the driver.
    """
    marked = labels.select(F.col(f"`{id_col}`").alias("of"), F.col(f"`{label_col}`").cast("int").alias("y")).where("y in (0, 1)").where(~_held_out(F.col("of")))
    n = marked.count()
    picked = marked.where(F.pmod(F.xxhash64("of"), F.lit(1 << 20)) < min(1 << 20, math.ceil((1 << 20) * max_rows / max(1, n)))).limit(2 * max_rows)
    taken = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).join(F.broadcast(picked), F.col("id") == F.col("of")).select("id", "y", "text")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = pa.array([features(t.as_py()) for t in b.column(2)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), b.column(1), rows], names=["id", "y", "x"])

    sample = taken.mapInArrow(compute, "id string, y int, x array<double>").limit(4 * max_rows).collect()
    sample.sort(key=lambda r: (r["id"], r["y"], r["x"]))
    return fit(_matrix(r["x"] for r in sample), np.array([r["y"] for r in sample], np.float64))


def score_of(model: AdditiveModel) -> Callable[[Column], Column]:
    """A function of a text column to its score: features and table look-ups, batch by batch."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(features(t if isinstance(t, str) else None) for t in texts)))

    return score


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_TRAINING_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """id, held_out, score and predicted of every row of docs, scored in one pass over the whole texts without a shuffle.

    The model is fit_quality's: at most about max_rows labelled rows teach it. Ids, labels and other columns are no inputs.

    Null and empty texts are scored like others, by their features, and so are very long ones, whole. A null id counts as held out and meets no label; null
    labels teach nothing; repeated rows count as often as they stand. Without labelled rows each score is 1/2; an empty
    table gives an empty result.
    """
    score = score_of(fit_quality(docs, labels, id_col, text_col, label_col, max_rows))
    own = F.col(f"`{id_col}`")
    scored = docs.select(own.alias("id"), score(F.col(f"`{text_col}`").cast("string")).alias("score"))
    return scored.select("id", _held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_TRAINING_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of docs that the classifier does not reject, with all their columns. They pass where they are read.

    Null, empty and very long texts are scored like others, so they stay or go by their features; repeated rows and rows with a null id are rows
    like others; an empty table stays empty. Without labelled rows each score is 1/2, and all rows stay.
    """
    score = score_of(fit_quality(docs, labels, id_col, text_col, label_col, max_rows))
    return docs.where(score(F.col(f"`{text_col}`").cast("string")) >= threshold)
