"""Two runs over the same pages: what changed, how sure that is, and the decision."""

from __future__ import annotations

import hashlib
import math
import random
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.errors import IncommensurableError, UsageError
from quire.functions.twister import stream_at
from quire.operators.order import numbered
from quire.schema import CONFIDENCE, GOLD_SPLIT, PRIMARY_SPLIT, THRESHOLDS
from quire.store import settle

# Metrics of a split in their order; of which a lower value is better.
METRICS = ("cer", "wer", "exact_match_rate", "hallucination_rate", "false_refusal_rate")
LOWER_IS_BETTER = {"cer": True, "wer": True, "exact_match_rate": False, "hallucination_rate": True, "false_refusal_rate": True}
#: Pages of a split up to which a comparison resamples exactly: every executor holds its deltas, 8 bytes a page (256 MB).
EXACT_PAGES = 32_000_000
#: Deltas in a row of a split's packed deltas, and draws that a task makes, about.
CHUNK, DRAWS = 1 << 20, 1 << 27
#: Pages named on each side when the page sets differ.
NAMED = 20


def page_set_difference(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """page_id, side of the pages that only one run has."""
    b, c = baseline.select("page_id"), candidate.select("page_id")
    return b.join(c, "page_id", "left_anti").withColumn("side", F.lit("baseline")).unionByName(c.join(b, "page_id", "left_anti").withColumn("side", F.lit("candidate")))


def assert_commensurable(baseline: Mapping, candidate: Mapping, before: DataFrame, after: DataFrame) -> None:
    """Raises with all the reasons at once; nothing has been compared yet. baseline, candidate: manifest and splits of the runs."""
    problems = []
    for key, what in (("policy_version", "scoring policy"), ("corpus_manifest_digest", "corpus")):
        if baseline[key] != candidate[key]:
            problems.append(f"{key}: {baseline[key]} and {candidate[key]}; the runs differ in their {what}")
    if (a := set(baseline["splits"])) != (b := set(candidate["splits"])):
        problems.append(f"splits: only the baseline has {sorted(a - b)}, only the candidate {sorted(b - a)}")
    differ = page_set_difference(before, after)
    if counts := {r["side"]: r["count"] for r in differ.groupBy("side").count().collect()}:
        problems.append(f"pages: {counts.get('baseline', 0)} are in the baseline only, {counts.get('candidate', 0)} in the candidate only (a subset was scored on one side)")
        for side in ("baseline", "candidate"):
            problems += [f"only in the {side}: {r['page_id']}" for r in differ.where(F.col("side") == side).orderBy("page_id").limit(NAMED).collect()]
    if problems:
        raise IncommensurableError("these runs cannot be compared", problems)


def page_deltas(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """page_id, split, baseline_cer, candidate_cer, delta_cer, outcome_changed of the pages of both runs.

    A page without a rate on some side appears only if its outcome changed, with zeros.
    """
    side = lambda df, n: df.select("page_id", F.col("split").alias(f"split_{n}"), F.col("outcome").alias(f"outcome_{n}"), F.col("metrics.strict.cer").alias(f"{n}_cer"))
    both = side(baseline, "baseline").join(side(candidate, "candidate"), "page_id")
    changed = F.when(F.col("outcome_baseline") != F.col("outcome_candidate"), F.concat_ws(" -> ", "outcome_baseline", "outcome_candidate"))
    rated = F.col("baseline_cer").isNotNull() & F.col("candidate_cer").isNotNull()
    zero = lambda c: F.when(rated, c).otherwise(F.lit(0.0))
    rows = both.withColumn("outcome_changed", changed).where(rated | F.col("outcome_changed").isNotNull())
    return rows.select("page_id", F.col("split_baseline").alias("split"), zero(F.col("baseline_cer")).alias("baseline_cer"), zero(F.col("candidate_cer")).alias("candidate_cer"), zero(F.col("candidate_cer") - F.col("baseline_cer")).alias("delta_cer"), "outcome_changed")


def regressions(deltas: DataFrame) -> DataFrame:
    return settle(deltas.where("delta_cer > 0")).orderBy(F.desc("delta_cer"), "page_id")  # a sort reads its rows twice


def improvements(deltas: DataFrame) -> DataFrame:
    return settle(deltas.where("delta_cer < 0")).orderBy("delta_cer", "page_id")


def direction(metric: Column, delta: Column) -> Column:
    lower = metric.isin(*(m for m in METRICS if LOWER_IS_BETTER[m]))
    return F.when(delta == 0, "unchanged").when(F.when(lower, delta < 0).otherwise(delta > 0), "better").otherwise("worse")


def metric_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """split, metric, baseline, candidate, delta, direction for what both sides have. before, after: rows of split_totals."""
    columns = {"cer": "strict_cer_micro", "wer": "strict_wer_micro", "exact_match_rate": "strict_exact_match_rate"}
    tall = lambda df, n: df.select("split", F.inline(F.array(*(F.struct(F.lit(i).alias("at"), F.lit(m).alias("metric"), F.col(columns.get(m, m)).alias(n)) for i, m in enumerate(METRICS)))))
    both = tall(before, "baseline").join(tall(after, "candidate").drop("at"), ["split", "metric"]).dropna(subset=["baseline", "candidate"])
    return both.withColumn("delta", F.col("candidate") - F.col("baseline")).withColumn("direction", direction(F.col("metric"), F.col("delta"))).orderBy("split", "at").drop("at")


def paired_bootstrap(deltas: list[float], resamples: int, seed: int) -> tuple[float, float, float]:
    """Mean of the deltas and the bounds between which CONFIDENCE of the resampled means lie."""
    n = len(deltas)
    if not n:
        return 0.0, 0.0, 0.0
    draw = random.Random(seed).choices
    means = sorted(sum(draw(deltas, k=n)) / n for _ in range(resamples))
    tail = (1.0 - CONFIDENCE) / 2.0
    return sum(deltas) / n, means[int(tail * resamples)], means[min(resamples - 1, int((1.0 - tail) * resamples))]


def _means(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Rows (split, first, last, chunk, packed) of stretches of resamples with all chunks of their split's deltas to the resamples' means.

    Each stretch starts at its own place of the stream that random.Random(seed) gives, and draws as its choices() does.
    """
    held: dict[tuple, dict[int, bytes]] = {}
    for b in batches:
        for split, first, last, chunk, packed in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
            held.setdefault((split, first, last), {})[chunk] = packed
    for (split, first, last), chunks in held.items():
        deltas = np.concatenate([np.frombuffer(chunks[c]) for c in sorted(chunks)])
        n = len(deltas)
        stream = stream_at(seed, first * n)
        means = [sum(deltas[(stream.random_sample(n) * n).astype(np.int64)].tolist()) / n for _ in range(first, last)]
        yield pa.RecordBatch.from_arrays([pa.array([split] * len(means)), pa.array(means, pa.float64())], names=["split", "mean"])


def bootstrap(deltas: DataFrame, resamples: int = THRESHOLDS["bootstrap_resamples"], seed: int = THRESHOLDS["bootstrap_seed"], draws: int = DRAWS) -> DataFrame:
    """split, n, delta_cer, ci_low, ci_high, as paired_bootstrap gives them over a split's pages in the order of their ids, bit by bit.

    Every split draws from its own stream. The resamples are dealt out to tasks of about `draws` draws: a task starts at its own place of
    the stream, which it reaches without drawing what lies before. Each needs all deltas of the split: they are packed in the
    order of the ids, in chunks, and broadcast up to EXACT_PAGES a split; more is an error, and bootstrap_scalable does without.
    """
    spark = deltas.sparkSession
    rows = settle(deltas.select("split", "page_id", "delta_cer"))  # counted, sampled and placed
    sizes = {r["split"]: r["n"] for r in rows.groupBy("split").agg(F.count("*").alias("n")).collect()}
    if sizes and sum(sizes.values()) > EXACT_PAGES:
        raise UsageError(f"{sum(sizes.values())} pages are more than the exact bootstrap holds on an executor ({EXACT_PAGES})")
    starts, at = {}, 0
    for s in sorted(sizes, key=lambda s: (s is not None, (s or "").encode())):  # as Spark orders them
        starts[s], at = at, at + sizes[s]
    placed = numbered(rows, "split", "page_id", place="place")
    meant = spark.createDataFrame([(s, n, starts[s]) for s, n in sizes.items()], "of string, n long, start long")
    own = F.col("place") - F.col("start")
    placed = placed.join(F.broadcast(meant), F.col("split").eqNullSafe(F.col("of"))).select("split", (own / CHUNK).cast("int").alias("chunk"), (own % CHUNK).alias("at"), "delta_cer")

    def pack(part: pa.Table) -> pa.Table:
        d = part["delta_cer"].to_numpy()[np.argsort(part["at"].to_numpy())].astype(np.float64)
        return pa.table({"split": part["split"][:1], "chunk": part["chunk"][:1], "packed": pa.array([d.tobytes()], pa.binary())})

    packed = settle(placed.groupBy("split", "chunk").applyInArrow(pack, "split string, chunk int, packed binary"))
    stretches = []
    for s, n in sizes.items():
        step = max(1, min(draws // max(1, n), -(-resamples // max(1, spark.sparkContext.defaultParallelism))))
        stretches += [(s, i, min(i + step, resamples)) for i in range(0, resamples, step)]
    dealt = spark.createDataFrame(stretches, "of string, first long, last long").repartition(max(1, len(stretches)), "of", "first")
    with_deltas = dealt.join(F.broadcast(packed), F.col("of").eqNullSafe(F.col("split"))).select("split", "first", "last", "chunk", "packed")
    means = with_deltas.mapInArrow(lambda it: _means(it, seed), "split string, mean double")
    tail = (1.0 - CONFIDENCE) / 2.0
    low, high = int(tail * resamples), min(resamples - 1, int((1.0 - tail) * resamples))
    bounds = means.groupBy("split").agg(F.array_sort(F.collect_list("mean")).alias("m")).select("split", F.col("m")[low].alias("ci_low"), F.col("m")[high].alias("ci_high"))
    whole = packed.groupBy("split").agg(F.sort_array(F.collect_list(F.struct("chunk", "packed"))).alias("c"))

    @F.pandas_udf("double")
    def mean(chunks: pd.Series) -> pd.Series:
        return pd.Series([sum(x for c in row for x in np.frombuffer(c["packed"]).tolist()) / sum(len(c["packed"]) // 8 for c in row) for row in chunks])

    observed = whole.select(F.col("split").alias("of"), mean("c").alias("delta_cer"))
    return bounds.join(observed, F.col("split").eqNullSafe(F.col("of"))).join(F.broadcast(meant.select(F.col("of").alias("__of"), "n")), F.col("split").eqNullSafe(F.col("__of"))).select("split", "n", "delta_cer", "ci_low", "ci_high")


def _poisson_means(batches: Iterator[pa.RecordBatch], resamples: int, seed: int) -> Iterator[pa.RecordBatch]:
    """split, resample, total, weight: a partition's share of each resample's sums."""
    cuts = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    total: dict[str, np.ndarray] = {}
    for b in batches:
        for split, page, delta in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            draw = np.random.Generator(np.random.Philox(key=int.from_bytes(hashlib.sha256(f"{seed}:{page}".encode()).digest()[:16], "little")))
            times = np.searchsorted(cuts, draw.random(resamples), side="right")
            sums = total.setdefault(split, np.zeros((2, resamples)))
            sums[0] += times * delta
            sums[1] += times
    for split, sums in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([split] * resamples), pa.array(np.arange(resamples)), pa.array(sums[0]), pa.array(sums[1])], names=["split", "resample", "total", "weight"])


def bootstrap_scalable(deltas: DataFrame, resamples: int = THRESHOLDS["bootstrap_resamples"], seed: int = THRESHOLDS["bootstrap_seed"]) -> DataFrame:
    """Like bootstrap, for splits of any size: each page enters each resample a Poisson(1) number of times.

    A page's numbers follow from seed and id alone; partitions give sums, a row a split and resample, and nothing is gathered.
    """
    deltas = settle(deltas.select("split", "page_id", "delta_cer"))  # used twice
    parts = deltas.mapInArrow(lambda it: _poisson_means(it, resamples, seed), "split string, resample long, total double, weight double")
    means = parts.groupBy("split", "resample").agg(F.try_divide(F.sum("total"), F.sum("weight")).alias("mean"))
    tail = (1.0 - CONFIDENCE) / 2.0
    bounds = means.groupBy("split").agg(F.percentile("mean", F.lit(tail)).alias("ci_low"), F.percentile("mean", F.lit(1 - tail)).alias("ci_high"))
    return deltas.groupBy("split").agg(F.count("*").alias("n"), F.avg("delta_cer").alias("delta_cer")).join(bounds, "split")


def resampled(deltas: DataFrame, resamples: int, seed: int, exact_pages: int = EXACT_PAGES) -> list[dict]:
    """A row a split, by name: the exact resampling of splits of up to exact_pages pages, the scalable one of others; method says which."""
    sizes = {r["split"]: r["n"] for r in deltas.groupBy("split").agg(F.count("*").alias("n")).collect()}
    small, large = ([s for s, n in sizes.items() if (n <= exact_pages) is exact] for exact in (True, False))
    exact = [small] if sum(sizes[s] for s in small) <= EXACT_PAGES else [[s] for s in small]
    rows = []
    for splits, draw, method in [(x, bootstrap, "exact") for x in exact] + [(large, bootstrap_scalable, "poisson")]:
        if splits:
            rows += [r.asDict() | {"method": method} for r in draw(deltas.where(F.col("split").isin(splits)), resamples, seed).collect()]
    return sorted(rows, key=lambda r: r["split"])


class Verdict(NamedTuple):
    verdict: str
    reasons: list[str]
    thresholds: dict


def decide(before: Mapping[str, Mapping], after: Mapping[str, Mapping], primary: str = PRIMARY_SPLIT, settings: Mapping = THRESHOLDS) -> Verdict:
    """REJECT, PROMOTE or INCONCLUSIVE with at least one reason. before, after: of each split, cer and the two contract rates."""
    names = ("promote_min_cer_improvement_pp", "reject_on_any_gold_regression", "reject_hallucination_worsening_pp", "reject_false_refusal_worsening_pp")
    limits, reasons, rejected = {n: settings[n] for n in names}, [], False
    cer = lambda run, split: run.get(split, {}).get("cer")
    was, now = cer(before, GOLD_SPLIT), cer(after, GOLD_SPLIT)
    if limits["reject_on_any_gold_regression"]:
        if was is not None and now is not None and now > was:
            rejected = True
            reasons.append(f"REJECT: strict CER of {GOLD_SPLIT} rose by {(now - was) * 100:.2f}pp, from {was:.4f} to {now:.4f}; no rise is allowed there")
        elif was is None and now is None:
            reasons.append(f"note: neither run has scored pages in {GOLD_SPLIT}; the rule on real scans could not be applied")
    for key, limit in (("hallucination_rate", names[2]), ("false_refusal_rate", names[3])):
        rises = [after[s][key] - before[s][key] for s in sorted(set(before) & set(after)) if before[s][key] is not None and after[s][key] is not None]
        if rises and max(rises) * 100 > limits[limit]:
            rejected = True
            reasons.append(f"REJECT: {key.replace('_', ' ')} rose by {max(rises) * 100:.2f}pp; the limit is {limits[limit]:.2f}pp")
    was, now, need = cer(before, primary), cer(after, primary), limits["promote_min_cer_improvement_pp"]
    if was is None or now is None:
        reasons.append(f"the {'baseline' if was is None else 'candidate'} has no strict headline in {primary}, so nothing can be promoted")
        return Verdict("REJECT" if rejected else "INCONCLUSIVE", reasons, limits)
    gain = (was - now) * 100
    reasons.append(f"strict CER of {primary} {'improved' if gain > 0 else 'worsened'} by {abs(gain):.2f}pp, from {was:.4f} to {now:.4f}; PROMOTE needs an improvement of {need:.2f}pp")
    if rejected:
        return Verdict("REJECT", reasons, limits)
    if gain >= need:
        return Verdict("PROMOTE", reasons, limits)
    reasons.append(f"INCONCLUSIVE: nothing rejects, and the improvement is below {need:.2f}pp")
    return Verdict("INCONCLUSIVE", reasons, limits)
