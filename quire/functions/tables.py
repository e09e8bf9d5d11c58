"""Table functions for SQL: rows for what one pair of texts gives."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from quire.functions.edit import line_order, partners
from quire.functions.text import skeleton_of
from quire.schema import THRESHOLDS

LEAST_SIMILARITY = THRESHOLDS["line_match_min_similarity"]


def _checked(of: str, args: tuple[AnalyzeArgument, ...]) -> None:
    """Two texts and, if it is given, a constant similarity from 0 to 1."""
    if len(args) not in (2, 3) or any(not isinstance(a.dataType, (T.StringType, T.NullType)) for a in args[:2]):
        raise ValueError(f"{of} takes two texts and, optionally, a least similarity")
    if len(args) == 3 and (not args[2].isConstantExpression or args[2].value is None or not 0 <= float(args[2].value) <= 1):
        raise ValueError(f"the least similarity of {of} must be a constant from 0 to 1")


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def _lines(text: str) -> tuple[list[str], list[str]]:
    lines = [x for x in text.split("\n") if x.strip()]
    return lines, [skeleton_of(x) for x in lines]


class LinePartners:
    """ref_line, pred_line (from 0, of the lines that are not blank), similarity and both lines of every pair that is taken."""

    @staticmethod
    def analyze(*args: AnalyzeArgument) -> AnalyzeResult:
        _checked("line_pairs", args)
        return AnalyzeResult(_schema(ref_line=T.IntegerType(), pred_line=T.IntegerType(), similarity=T.DoubleType(), ref_text=T.StringType(), pred_text=T.StringType()))

    def eval(self, reference: str | None, prediction: str | None, least: float = LEAST_SIMILARITY) -> Iterator[tuple]:
        if reference is None or prediction is None:
            return
        (a, a_keys), (b, b_keys) = _lines(reference), _lines(prediction)
        for i, j, s in partners(a_keys, b_keys, float(least)):
            yield i, j, s, a[i], b[j]


class OrderMetrics:
    """One row: char_edits with the prediction's lines in the reference's order, concordant and all pairs, matched, ref_lines, pred_lines."""

    @staticmethod
    def analyze(*args: AnalyzeArgument) -> AnalyzeResult:
        _checked("order_metrics", args)
        return AnalyzeResult(_schema(**dict.fromkeys(("char_edits", "concordant", "pairs", "matched", "ref_lines", "pred_lines"), T.IntegerType())))

    def eval(self, reference: str | None, prediction: str | None, least: float = LEAST_SIMILARITY) -> Iterator[tuple]:
        if reference is not None and prediction is not None:
            yield tuple(line_order(reference, prediction, _lines(reference)[1], _lines(prediction)[1], float(least)))


def register(spark: SparkSession) -> None:
    """line_pairs and order_metrics as table functions of this session."""
    spark.udtf.register("line_pairs", F.udtf(LinePartners, useArrow=True))
    spark.udtf.register("order_metrics", F.udtf(OrderMetrics, useArrow=True))
