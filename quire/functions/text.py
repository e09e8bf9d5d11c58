"""Text normalisation and predicates, as Spark expressions where Spark has what they need."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.edit import similarity
from quire.functions.lanes import edit_distances, partners_of, similar_lines_of
from quire.schema import ARABIC_BLOCKS, DIACRITICS, DIGIT_ZEROS, LETTER_FOLD, MARKER, TATWEEL, THRESHOLDS

LEAST_SIMILARITY = THRESHOLDS["line_match_min_similarity"]

#: White space as Unicode has it (and str.split); neither trim() nor \s of Java's expressions know it all.
WHITE = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


#: Letters of texts that are looked at together.
AT_ONCE = 32 << 20


#: What is found out once in each process. (Functions that go to executors by value cannot have functools' caches.)
_KNOWN: dict[str, object] = {}


def _ranges(codes: Iterable[int]) -> tuple[tuple[int, int], ...]:
    out: list[list[int]] = []
    for i in codes:
        if out and out[-1][1] == i - 1:
            out[-1][1] = i
        else:
            out.append([i, i])
    return tuple((a, b) for a, b in out)


def mark_ranges() -> tuple[tuple[int, int], ...]:
    """Ranges of category Mn as this Python knows it; the JVM's own tables may be of another Unicode version."""
    if "marks" not in _KNOWN:
        _KNOWN["marks"] = _ranges(i for i in range(sys.maxunicode + 1) if unicodedata.category(chr(i)) == "Mn")
    return _KNOWN["marks"]


def strict(text: Column) -> Column:
    return text


class _Skeleton(dict):
    """What str.translate puts for a code point, found out when it is first met."""

    def __missing__(self, i: int) -> int | None:
        kind = unicodedata.category(chr(i))
        if i in LETTER_FOLD:
            to = LETTER_FOLD[i]
        elif zero := next((z for z in DIGIT_ZEROS if z <= i <= z + 9), 0):
            to = 48 + i - zero
        else:
            to = None if kind == "Mn" or i == TATWEEL or kind[0] in "PS" else i
        self[i] = to
        return to


_SKELETON = _Skeleton()


def skeleton_of(text: str) -> str:
    """Compatibility form; no marks, tatweel, punctuation or symbols; letters and digits folded; words one space apart."""
    return " ".join(unicodedata.normalize("NFKC", text).translate(_SKELETON).split())


def skeletons_of(lines: Sequence[str], known: dict[str, str]) -> list[str]:
    """skeleton_of each line; those that are known already are not worked out again."""
    for x in lines:
        if x not in known:
            known[x] = skeleton_of(x)
    return [known[x] for x in lines]


def bare_of(text: str) -> str:
    """Without the listed marks, and without other marks that stand on a letter of the Arabic blocks."""
    if text.isascii():
        return text
    if "from" not in _KNOWN:  # where marks begin
        _KNOWN["from"] = re.compile(f"[{chr(min(DIACRITICS[0][0], mark_ranges()[0][0]))}-{chr(sys.maxunicode)}]")
    if not _KNOWN["from"].search(text) or not any(unicodedata.category(c) == "Mn" or any(a <= ord(c) <= b for a, b in DIACRITICS) for c in set(text)):
        return text
    if "bare" not in _KNOWN:
        spelled = lambda ranges: "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges)
        letters = _ranges(i for a, b in ARABIC_BLOCKS for i in range(a, b + 1) if unicodedata.category(chr(i)) != "Mn")
        _KNOWN["bare"] = re.compile(f"[{spelled(DIACRITICS)}]+"), re.compile(f"(?<=[{spelled(letters)}])[{spelled(mark_ranges())}]+")
    listed, others = _KNOWN["bare"]
    return others.sub("", listed.sub("", text))


def _each(texts: pa.Array, f: Callable[[str], str], rows: int = 64) -> pa.Array:
    """f of each text that is not null. Only a few texts at once are Python's; a batch and its results stay in Arrow's memory."""
    parts = [pa.array([None if x is None else f(x) for x in texts.slice(i, rows).to_pylist()], pa.string()) for i in range(0, len(texts), rows)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


@F.arrow_udf(T.StringType())
def diacritic_insensitive(texts: pa.Array) -> pa.Array:
    """bare_of. (Java's regular expressions try the ranges of marks one by one for each letter.)"""
    return _each(texts, bare_of)


@F.arrow_udf(T.StringType())
def skeleton(texts: pa.Array) -> pa.Array:
    return _each(texts, skeleton_of)


def in_shares(sizes: Sequence[int], most: int = AT_ONCE) -> Iterator[slice]:
    """Rows in stretches of that many letters at most (or of one row)."""
    start = size = 0
    for i, n in enumerate(sizes):
        if size + n > most and i > start:
            yield slice(start, i)
            start, size = i, 0
        size += n
    yield slice(start, len(sizes))


def _measured(a: pd.Series, b: pd.Series, parts: Callable[[str], Sequence]) -> pd.Series:
    """Distances of a batch's pairs, which are measured together; null where a text is."""
    out = pd.Series([None] * len(a), dtype="Int32")
    rows = [(i, x, y) for i, (x, y) in enumerate(zip(a, b, strict=True)) if x is not None and y is not None]
    for part in in_shares([len(x) + len(y) for _, x, y in rows]):
        out.iloc[[i for i, _, _ in rows[part]]] = edit_distances([(parts(x), parts(y)) for _, x, y in rows[part]])
    return out


@F.pandas_udf(T.IntegerType())
def char_edits(a: pd.Series, b: pd.Series) -> pd.Series:
    """Edit distance by code point; for whole pages (built-in levenshtein is quicker for short lines)."""
    return _measured(a, b, lambda x: x)


@F.pandas_udf(T.IntegerType())
def word_edits(a: pd.Series, b: pd.Series) -> pd.Series:
    return _measured(a, b, str.split)


@F.pandas_udf(T.ArrayType(T.StringType()))
def line_skeletons(texts: pd.Series) -> pd.Series:
    """Skeletons of the lines that are not blank."""
    return texts.map(lambda t: [skeleton_of(x) for x in t.split("\n") if x.strip()], na_action="ignore")


_PAIRS = T.ArrayType(T.StructType([T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("similarity", T.DoubleType())]))


@F.pandas_udf(_PAIRS)
def line_candidates(a: pd.Series, b: pd.Series) -> pd.Series:
    """Of two arrays of keys the pairs with a similarity of LEAST_SIMILARITY or more."""
    return pd.Series(similar_lines_of([(list(x), list(y)) for x, y in zip(a, b, strict=True)], LEAST_SIMILARITY))


@F.pandas_udf(_PAIRS)
def line_partners(a: pd.Series, b: pd.Series) -> pd.Series:
    """Of two arrays of keys the pairs that are taken: best similarity first, then in order, no key twice."""
    return pd.Series(partners_of([(list(x), list(y)) for x, y in zip(a, b, strict=True)], LEAST_SIMILARITY))


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{WHITE}]+"), lambda w: w != "")


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, f"\\A[{WHITE}]+|[{WHITE}]+\\z", "")


def is_blank(text: Column) -> Column:
    return ~text.rlike(f"[^{WHITE}]")


def is_marker(text: Column, marker: str = MARKER) -> Column:
    """The marker alone, in its own case, whatever white space is around it."""
    return text.contains(marker) & (stripped(text) == marker)  # most texts are not looked through by expressions


def lines(text: Column) -> Column:
    """Lines (ended by \\n alone) that are not blank."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{WHITE}]"))


def outcome(reference: Column, prediction: Column) -> Column:
    refused = is_marker(prediction)
    return F.when(is_marker(reference), F.when(refused, "correct_refusal").otherwise("hallucination")).otherwise(F.when(refused, "false_refusal").otherwise("scored"))


def length_ratio(reference: Column, prediction: Column) -> Column:
    return F.length(prediction) / F.greatest(F.length(reference), F.lit(1))


def is_runaway(reference: Column, prediction: Column, ratio: float, excess: int) -> Column:
    return (F.length(prediction) >= F.lit(ratio) * F.length(reference)) & (F.length(prediction) - F.length(reference) >= excess)


def is_repetitive(keys: Column, prediction: Column, least_length: int, least_count: int, least_share: float) -> Column:
    """keys: skeletons of all lines. One key of some length comes often, and its occurrences make up a share of the text."""
    long = F.filter(keys, lambda k: F.length(k) >= least_length)
    often = lambda k: F.size(F.filter(long, lambda x: x == k))
    fires = F.exists(F.array_distinct(long), lambda k: (often(k) >= least_count) & (F.length(k) * often(k) / F.greatest(F.length(prediction), F.lit(1)) >= least_share))
    return ~is_blank(prediction) & fires


def strip_prefix(text: Column, prefix: str) -> Column:
    return F.when(F.startswith(text, F.lit(prefix)), F.substr(text, F.lit(len(prefix) + 1))).otherwise(text)


def file_text(text: Column) -> Column:
    """A text file's content: without one byte-order mark in front and one line end behind."""
    return F.regexp_replace(F.regexp_replace(text, "^\\x{feff}", ""), "\\r?\\n\\z", "")


def image_tokens(width: Column, height: Column, most: int, least: int = 4, side: int = 32) -> Column:
    """Tokens of an image whose sides are brought to multiples of `side` and whose tokens to the given range."""
    near = lambda x: F.greatest(F.lit(side), F.bround(x / side).cast("double") * side)
    w, h, area = width.cast("double"), height.cast("double"), float(side * side)
    big, small = F.sqrt(w * h / (most * area)), F.sqrt(least * area / (w * h))
    shrunk = lambda x: F.greatest(F.lit(float(side)), F.floor(x / big / side) * side)
    grown = lambda x: F.ceil(x * small / side) * side
    tokens = near(w) * near(h) / area
    return F.when(tokens > most, shrunk(w) * shrunk(h) / area).when(tokens < least, grown(w) * grown(h) / area).otherwise(tokens).cast("int")


def register(spark: SparkSession) -> None:
    """Makes the functions that Spark lacks known to SQL; those that give tables are in quire.functions.tables."""
    spark.udf.register("skeleton", skeleton)
    spark.udf.register("diacritic_insensitive", diacritic_insensitive)
    spark.udf.register("char_edits", char_edits)
    spark.udf.register("word_edits", word_edits)

    @F.pandas_udf("double")
    def line_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else similarity(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    spark.udf.register("line_similarity", line_similarity)
