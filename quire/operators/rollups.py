"""Split totals, breakdowns and rankings. Rates are sums over sums; an empty denominator gives null; splits never meet."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.schema import DIMENSION_COLUMNS, DIMENSIONS, FLAGS, LEVELS, OUTCOMES, PROBE_OUTCOMES, SPARSE, THRESHOLDS
from quire.store import settle


def micro(edits: Column, of: Column) -> Column:
    """All edits over all units; 0 without units."""
    return F.coalesce(F.try_divide(F.sum(edits), F.sum(of)), F.lit(0.0))


def macro(edits: Column, of: Column) -> Column:
    """Mean of the pages' own rates; pages without units do not count."""
    return F.coalesce(F.avg(F.when(of != 0, edits / of)), F.lit(0.0))


def rates(prefix: str = "metrics.strict.") -> dict[str, Column]:
    m = lambda n: F.col(f"{prefix}{n}")
    return {
        "cer_micro": micro(m("char_edits"), m("ref_chars")),
        "cer_macro": macro(m("char_edits"), m("ref_chars")),
        "wer_micro": micro(m("word_edits"), m("ref_words")),
        "wer_macro": macro(m("word_edits"), m("ref_words")),
        "exact_match_rate": F.avg(m("exact_match").cast("int")),
    }


COUNTS = ("char_edits", "ref_chars", "word_edits", "ref_words", "exact_match")


def split_totals(scores: DataFrame, more: Mapping[str, Column] | None = None, levels: Collection[str] = LEVELS) -> DataFrame:
    """One row a split, by one aggregation: pages, outcomes, flags, rates of each level, order; and more aggregates by name."""
    scored = F.col("metrics").isNotNull()
    n = F.count_if(scored)
    only = lambda c: F.when(n > 0, c)
    outcome = {o: F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES}
    probes = F.count_if(F.col("outcome").isin(*PROBE_OUTCOMES))
    levels = [only(c).alias(f"{level}_{name}") for level in LEVELS if level in levels for name, c in rates(f"metrics.{level}.").items()]
    k = lambda c: F.sum(F.col(f"order_counts.{c}"))
    return (
        scores.groupBy("split")
        .agg(
            F.count("*").alias("pages"), n.alias("scored_pages"), *outcome.values(), probes.alias("probe_pages"),
            F.try_divide(F.count_if(F.col("outcome") == "hallucination"), probes).alias("hallucination_rate"),
            F.try_divide(F.count_if(F.col("outcome") == "false_refusal"), n).alias("false_refusal_rate"),
            *(F.count_if(F.array_contains("flags", f)).alias(f) for f in FLAGS),
            *levels,
            only(F.try_divide(k("char_edits"), k("ref_chars"))).alias("order_corrected_cer_micro"),
            only(F.try_divide(k("concordant"), k("pairs"))).alias("reading_order_accuracy"),
            F.count_if(scored & F.col("order.reading_order_accuracy").isNull()).alias("pages_without_order_signal"),
            *(c.alias(n) for n, c in (more or {}).items()),
        )
        .orderBy("split")
    )


def _valued(scores: DataFrame) -> DataFrame:
    """Each scored page once for each dimension, with its values there."""
    every = F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(DIMENSION_COLUMNS[d]).alias("vals") if d != "source" else F.array_compact(F.array("source")).alias("vals")) for d in DIMENSIONS))
    counts = [F.col(f"metrics.strict.{n}").alias(n) for n in COUNTS]
    return scores.where("metrics IS NOT NULL").select("split", "page_id", *counts, F.inline(every)).withColumn("vals", F.coalesce("vals", F.array().cast("array<string>")))


def partitions(scores: DataFrame) -> DataFrame:
    """split, dimension, is_partition: every page has exactly one value."""
    return _valued(scores).groupBy("split", "dimension").agg(((F.sum(F.size("vals")) == F.count("*")) & (F.count_if(F.size("vals") > 0) == F.count("*"))).alias("is_partition"))


def breakdowns(scores: DataFrame, least_pages: int = THRESHOLDS["min_pages_per_breakdown_row"]) -> DataFrame:
    """split, dimension, rank, key, pages and rates: the worst key first.

    A page counts for each value it has, as often as it has it. Values with fewer than least_pages pages are one row,
    in which each page counts once.
    """
    each = settle(_valued(scores).select("split", "dimension", "page_id", *COUNTS, F.explode("vals").alias("key")))  # used twice; pages are scored once
    sizes = each.groupBy("split", "dimension", "key").agg((F.count("*") < least_pages).alias("few"))
    folded = each.join(sizes, ["split", "dimension", "key"]).withColumn("key", F.when(F.col("few"), SPARSE).otherwise(F.col("key")))
    # of a page's rows that meet in the folded row, one; others stay as many as they are
    pages = folded.groupBy("split", "dimension", "key", "few", "page_id", *COUNTS).agg(F.count("*").alias("n"))
    pages = pages.select("*", F.explode(F.sequence(F.lit(1), F.when(F.col("few"), F.lit(1)).otherwise(F.col("n").cast("int")))).alias("copy"))
    named = {k: v for k, v in rates("").items() if k != "wer_macro"}
    rows = pages.groupBy("split", "dimension", "key").agg(F.count("*").alias("pages"), *(v.alias(k) for k, v in named.items()))
    worst = Window.partitionBy("split", "dimension").orderBy(F.desc("cer_micro"), "key")
    return rows.withColumn("rank", F.row_number().over(worst))


def worst_pages(scores: DataFrame, top: int, split: str | None = None, cer: Column | None = None) -> DataFrame:
    """The pages with the highest strict character error rate, ties by id."""
    rows = scores.where("metrics IS NOT NULL") if split is None else scores.where((F.col("split") == split) & F.col("metrics").isNotNull())
    return rows.orderBy((F.col("metrics.strict.cer") if cer is None else cer).desc(), "page_id").limit(top)
