"""Scores of each page: one Arrow function for what Spark cannot express, plain columns for the rest."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Collection, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions.edit import lines_in_order
from quire.functions.lanes import edit_distances, partners_of
from quire.functions.text import bare_of, in_shares, skeletons_of
from quire.schema import LEVELS, PROBE_OUTCOMES, THRESHOLDS

_PER_LEVEL = ("char_edits", "ref_chars", "word_edits", "ref_words", "exact")
_PER_ORDER = ("order_edits", "concordant", "pairs", "matched", "ref_lines", "pred_lines")
_MEASURED = [f"{n}_{level}" for level in LEVELS for n in _PER_LEVEL] + list(_PER_ORDER)
_KIND = "struct<" + ",".join(f"{n}:int" for n in _MEASURED) + ",pred_keys:array<string>>"


def measure_pages(pages: Sequence[tuple[str, str, bool]], least_similarity: float, levels: Collection[str] = LEVELS, with_order: bool = True, often: int = 1, with_words: bool = True) -> list[tuple]:
    """Of each (reference, prediction, scored): counts of the levels and of the order, and the skeletons of the prediction's lines that come
    so often; only the latter if not scored. Levels that are not asked for, and the order and words where they are not, have nulls.

    The distances of all pages are measured together, and so are those of lines.
    """
    pairs: list[tuple] = []
    keyed = [_keys(*page, with_order or "skeleton" in levels, often) for page in pages]
    lined = [k for k, page in enumerate(pages) if page[2] and with_order and all(_of_lines(x, y) for x, y in zip(page[:2], keyed[k], strict=True))]
    found = partners_of([tuple(_of_lines(x, y) for x, y in zip(pages[k][:2], keyed[k], strict=True)) for k in lined], least_similarity)
    places = {k: [j for _, j, _ in partners] for k, partners in zip(lined, found, strict=True)}
    rows = [_prepared(*page, *keyed[k], places.get(k), levels, with_order, often, with_words, pairs) for k, page in enumerate(pages)]
    edits = edit_distances(pairs)
    return [(*(edits[x.at] if isinstance(x, _Edits) else x for x in row[:-1]), row[-1]) for row in rows]


def _keys(reference: str, prediction: str, scored: bool, both: bool, often: int) -> tuple[list[str], list[str]]:
    """Skeletons of all lines of the reference and of the prediction, as far as they are needed."""
    both, known = both and scored, {}
    pred_lines = prediction.split("\n")
    return skeletons_of(reference.split("\n"), known) if both else [], skeletons_of(pred_lines, known) if both or len(pred_lines) >= often else []


def _of_lines(text: str, keys: list[str]) -> list[str]:
    """Those of lines that are not blank."""
    return [k for k, x in zip(keys, text.split("\n"), strict=True) if x.strip()]


class _Edits:
    """Stands for the distance of the pair at a place."""

    def __init__(self, at: int) -> None:
        self.at = at


def _prepared(
    reference: str, prediction: str, scored: bool, ref_keys: list[str], keys: list[str], places: list[int] | None, levels: Collection[str], with_order: bool, often: int, with_words: bool, pairs: list[tuple]
) -> list:
    """A page's counts, with places of the pairs whose distances are yet to be measured."""

    def edits(a: str | list[str], b: str | list[str]) -> _Edits:
        pairs.append((a, b))
        return _Edits(len(pairs) - 1)

    times = Counter(keys) if often > 1 else {}
    frequent = [k for k in keys if times[k] >= often] if often > 1 else keys
    if not scored:
        return [*[None] * len(_MEASURED), frequent]
    sides = {
        "strict": lambda: (reference, prediction),
        "diacritic_insensitive": lambda: (bare_of(reference), bare_of(prediction)),
        "skeleton": lambda: (" ".join(k for k in ref_keys if k), " ".join(k for k in keys if k)),  # a line end is white space like other
    }
    out: list = []  # names are imported, not modules: the function travels to executors by value
    known: dict[tuple[str, str], list] = {}  # levels often leave both sides as they are
    for level, pair in sides.items():
        if level not in levels:
            out += [None] * len(_PER_LEVEL)
            continue
        r, p = pair()
        if not r:
            raise ValueError(f"the reference is empty at level {level}: validate the corpus before it is scored")
        if (r, p) not in known:
            words = [None, None]
            if with_words:
                rw, pw = r.split(), p.split()
                words = [edits(rw, pw), len(rw)]
            known[r, p] = [edits(r, p), len(r), *words, int(r == p)]
        out += known[r, p]
    if not with_order:
        return [*out, *[None] * len(_PER_ORDER), frequent]
    rebuilt, *counts = lines_in_order(prediction, places)
    same = known.get((reference, rebuilt))
    return [*out, same[0] if same else edits(reference, rebuilt), *counts, len(_of_lines(reference, ref_keys)), len(_of_lines(prediction, keys)), frequent]


def _level(name: str) -> Column:
    m = lambda n: F.col(f"m.{n}_{name}")
    rate = lambda e, d: F.when(m(d) == 0, F.lit(0.0)).otherwise(m(e) / m(d))
    return F.struct(rate("char_edits", "ref_chars").alias("cer"), rate("word_edits", "ref_words").alias("wer"), (m("exact") == 1).alias("exact_match"), *(m(n).alias(n) for n in _PER_LEVEL[:4]))


def score(pages: DataFrame, settings: Mapping = THRESHOLDS, levels: Collection[str] = LEVELS, with_order: bool = True, with_words: bool = True) -> DataFrame:
    """pages (manifest columns, reference, prediction) with outcome, flags, length_ratio, metrics, order and order_counts.

    levels: those that metrics has; with_order: whether lines are paired; with_words: whether words are compared. What is not asked for is not measured, and has nulls.

    metrics and order are null where the outcome is a probe's. order_counts (edits, characters, concordant and total pairs)
    is what split totals sum; it is not part of the stored page. Pages are dealt out anew by id, since long ones cost most.
    """
    least, levels = float(settings["line_match_min_similarity"]), tuple(levels)
    often = max(1, math.ceil(settings["repetition_min_occurrences"]))  # lines that come less often tell nothing

    @F.pandas_udf(_KIND)
    def measure(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for r, p, s in batches:
            rows, sizes = list(zip(r, p, s, strict=True)), [len(x) + len(y) for x, y in zip(r, p, strict=True)]
            yield pd.DataFrame([row for part in in_shares(sizes) for row in measure_pages(rows[part], least, levels, with_order, often, with_words)], columns=[*_MEASURED, "pred_keys"]).astype(dict.fromkeys(_MEASURED, "Int32"))

    ref, pred = F.col("reference"), F.col("prediction")
    # a fixed number of tasks: pages cost time, not bytes, by which adaptive execution would put them together
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    rows = pages.repartition(tasks, "page_id").withColumn("outcome", X.outcome(ref, pred))
    rows = rows.withColumn("scored", ~F.col("outcome").isin(*PROBE_OUTCOMES))
    rows = rows.withColumn("m", measure(ref, pred, F.col("scored")))
    flags = F.array_compact(
        F.array(
            F.when(X.is_blank(pred), "empty_prediction"),
            F.when(X.is_repetitive(F.col("m.pred_keys"), pred, settings["repetition_min_line_len"], settings["repetition_min_occurrences"], settings["repetition_min_char_share"]), "repetition"),
            F.when(X.is_runaway(ref, pred, settings["runaway_length_ratio"], settings["runaway_min_char_excess"]), "runaway_length"),
        )
    )
    o = lambda n: F.col(f"m.{n}")
    order = F.struct(
        F.when(F.length(ref) == 0, 0.0).otherwise(o("order_edits") / F.length(ref)).alias("order_corrected_cer"),
        F.try_divide(o("concordant"), o("pairs")).alias("reading_order_accuracy"),
        o("matched").alias("matched_lines"), o("ref_lines").alias("ref_lines"), o("pred_lines").alias("pred_lines"),
    )
    counts = F.struct(o("order_edits").alias("char_edits"), F.length(ref).alias("ref_chars"), o("concordant").alias("concordant"), o("pairs").alias("pairs"))
    if_scored = lambda c: F.when(F.col("scored"), c)
    return rows.select(
        *(c for c in pages.columns if c not in ("reference", "prediction")), "outcome", flags.alias("flags"), X.length_ratio(ref, pred).alias("length_ratio"),
        if_scored(F.struct(*(_level(n).alias(n) for n in LEVELS if n in levels))).alias("metrics"),
        *(F.when(F.col("scored") & F.lit(with_order), c).alias(n) for n, c in (("order", order), ("order_counts", counts))),
    )
