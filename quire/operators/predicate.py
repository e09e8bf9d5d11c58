"""The filter language of page subsets: `field op value`, conditions joined by commas, all of which must hold."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.errors import UsageError
from quire.functions.text import stripped

# Operators in the order in which they are looked for, and fields with the columns they are about.
OPERATORS = ("!=", "~", "=")
FIELDS = {"split": "split", "kind": "kind", "source": "source", "font": "fonts", "distortion": "distortions", "is_augmented": "is_augmented"}
LISTS = ("font", "distortion")


class Condition(NamedTuple):
    field: str
    op: str
    value: str


def parse(expression: str) -> list[Condition]:
    """`split=a,font!=b`: what stands before the first operator (in the order of OPERATORS) is the field."""
    out = []
    for part in expression.split(","):
        op = next((o for o in OPERATORS if o in part), None)
        if op is None:
            raise UsageError(f"no operator ({' '.join(OPERATORS)}) in condition {part.strip()!r}")
        field, value = (x.strip() for x in part.split(op, 1))
        if field not in FIELDS:
            raise UsageError(f"unknown field {field!r}; there are {', '.join(FIELDS)}")
        if not value:
            raise UsageError(f"no value in condition {part.strip()!r}")
        out.append(Condition(field, op, value))
    return out


def values(field: str) -> Column:
    """What a page has in a field, as an array: nothing if it is null."""
    c = F.col(FIELDS[field])
    if field in LISTS:
        return F.coalesce(c, F.array().cast("array<string>"))
    text = F.when(c, "true").otherwise("false") if field == "is_augmented" else c
    return F.array_compact(F.array(text))


def condition(c: Condition) -> Column:
    """= one of the values is it; != none is; ~ one contains it. A missing value is other than any."""
    have = values(c.field)
    if c.op == "~":
        return F.exists(have, lambda x: F.contains(x, F.lit(c.value)))
    held = F.array_contains(have, c.value)
    return held if c.op == "=" else ~held


def matches(conditions: Sequence[Condition]) -> Column:
    return reduce(lambda a, b: a & b, map(condition, conditions), F.lit(True))


def select(pages: DataFrame, conditions: Sequence[Condition] = (), ids: DataFrame | None = None) -> DataFrame:
    """Pages that meet the conditions and, if ids (a column page_id) are given, are among them."""
    kept = pages.where(matches(conditions)) if conditions else pages
    return kept if ids is None else kept.join(ids.select("page_id").distinct(), "page_id", "left_semi")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """page_id of each line that is neither blank nor a comment (#)."""
    ids = spark.read.text(path).select(stripped(F.col("value")).alias("page_id")).where("page_id <> '' AND NOT startswith(page_id, '#')")
    if ids.isEmpty():
        raise UsageError(f"no page id in {path}")
    return ids


def describe(conditions: Sequence[Condition], ids: Sequence[str] | None) -> dict | None:
    """What a run records of its scope; None: all pages."""
    if not conditions and ids is None:
        return None
    return {"pages": sorted(ids) if ids is not None else None, "conditions": [c._asdict() for c in conditions]}
