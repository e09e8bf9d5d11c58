"""Mixing sources to target weights: a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import WORD, partitions, settle

#: Weights of the sources in code-point order (null last), repeating.
WEIGHTS = (3, 1, 2)
#: The mix has so many times the words of the corpus, and no source (or document) more than CAP times its own.
SHARE, CAP = 1.5, 2
#: Blocks have at most this many words; a small corpus has smaller ones, so that the schedule has at least LEAST_SLOTS, and a
#: small source so that it has at least LEAST_BLOCKS (if it has so many words): a slot more or less is then little of its target.
BLOCK_WORDS, LEAST_SLOTS, LEAST_BLOCKS = 4096, 1 << 16, 512
#: Sources are a category column. Their sums meet on the driver, so there is a bound, and past it an error.
MAX_SOURCES = 100_000
#: Slots that one task ranks at once.
CHUNK = 1 << 16
#: 2^64 over the golden ratio, as an odd number: multiples of it modulo 2^64 are the points of the schedule.
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def targets(sizes: Sequence[int], weights: Sequence[float], share: float = SHARE, cap: float = CAP) -> list[float]:
    """share x all words by weight; what is above cap x its source's words goes to the others by weight, until none is."""
    out, left, pot = [0.0] * len(sizes), list(range(len(sizes))), share * sum(sizes)
    while left:
        rate = pot / sum(weights[i] for i in left)
        under = []
        for i in left:
            if rate * weights[i] > cap * sizes[i]:
                out[i] = float(cap * sizes[i])
                pot -= out[i]
            else:
                under.append(i)
        if len(under) == len(left):
            for i in left:
                out[i] = rate * weights[i]
            break
        left = under
    return out


def _chunk_sources(chunk: int, slots: int, bounds: np.ndarray) -> np.ndarray:
    at = np.arange(chunk * CHUNK, min(slots, (chunk + 1) * CHUNK), dtype=np.uint64) * GOLDEN
    return np.minimum(np.searchsorted(bounds, at.astype(np.float64) / 2.0**64, side="right"), len(bounds) - 1).astype(np.int32)


def schedule(spark: SparkSession, shares: Sequence[float], slots: int) -> DataFrame:
    """slot, s (index into shares), rank (of the slot among those of its source) for `slots` golden-ratio points.

    A point falls to the source whose interval of cumulative shares holds it, so every stretch of the schedule is close to
    the shares. Chunks count their sources first; running sums of these counts then make each chunk's own ranks global.
    """
    last = max(i for i, x in enumerate(shares) if x > 0)
    bounds = (np.cumsum(shares) / np.sum(shares))[: last + 1]
    n = -(-slots // CHUNK)
    chunks = spark.range(0, n, 1, partitions(spark, n, 64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in b.column(0).to_pylist():
                s, k = np.unique(_chunk_sources(c, slots, bounds), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), c)), pa.array(s), pa.array(k)], names=["chunk", "s", "n"])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in b.column(0).to_pylist():
                s = _chunk_sources(c, slots, bounds)
                order, own = np.argsort(s, kind="stable"), np.empty(len(s), np.int64)
                first = np.flatnonzero(np.r_[True, s[order][1:] != s[order][:-1]])
                own[order] = np.arange(len(s)) - np.repeat(first, np.diff(np.r_[first, len(s)]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), c)), pa.array(c * CHUNK + np.arange(len(s))), pa.array(s), pa.array(own)], names=["chunk", "slot", "s", "own"])

    before = Window.partitionBy("s").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = chunks.mapInArrow(count, "chunk long, s int, n long").withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ranked = chunks.mapInArrow(rank, "chunk long, slot long, s int, own long")
    return ranked.join(base, ["chunk", "s"]).select("slot", "s", (F.col("own") + F.col("base")).alias("rank"))


def _offsets(sizes: DataFrame, n: int) -> DataFrame:
    """sizes with start: the words that come before the row in its source, in the order of its hash.

    Sums by (source, leading bits of the hash) make the running sum two-level, so no task orders a whole source.
    """
    bits = min(16, max(0, (n // 256).bit_length()))
    rows = sizes.withColumn("bucket", F.expr(f"shiftrightunsigned(h, {64 - bits})") if bits else F.lit(0).cast("long"))
    inside = Window.partitionBy("s", "bucket").orderBy("h", "size", "uid").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("s", "bucket").agg(F.sum("size").alias("n")).select("s", "bucket", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("base"))
    placed = rows.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return placed.join(sums, ["s", "bucket"]).withColumn("start", F.col("start") + F.col("base")).drop("bucket", "base")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = 20260916) -> tuple[DataFrame, DataFrame]:
    """(documents, schedule) of a mix of all docs.

    documents: every row's id with source, size, source_size, target and taken (words of it in the mix, repeats counted).
    schedule: slot, source, block, epoch and words in training order; slot i takes the next block of its source, whose
    documents stand end to end in a shuffled order that depends on seed, id and text alone, and starts again at its end. A
    source's blocks are equal (to a word); sources with fewer words have smaller ones, and more slots for each word.

    Words are runs of other characters than space and \\t..\\r; null text has none. A null source is a source, the last;
    repeated rows are rows of their own, and a very long text lies in many blocks. Documents without words have taken 0; without any words all targets are 0 and the
    schedule is empty. At most MAX_SOURCES sources (else ValueError). Other columns are not looked at.
    """
    spark = docs.sparkSession
    source, text = F.col(f"`{source_col}`").cast("string"), F.col(f"`{text_col}`").cast("string")
    counted = settle(
        docs.select(F.col(f"`{id_col}`").alias("id"), source.alias("source"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), text).alias("h")).withColumn("uid", F.monotonically_increasing_id())
    )
    found = counted.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: mix by a column with fewer values")
    found = sorted(found, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in found]
    aims = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], share, cap)
    total, n = sum(aims), sum(r["n"] for r in found)
    block = max(1, min(BLOCK_WORDS, int(total // LEAST_SLOTS)))
    counts = [max(-(-n // block), min(n, LEAST_BLOCKS)) for n in sizes]
    wanted = [aim * k / n if n else 0.0 for aim, k, n in zip(aims, counts, sizes, strict=True)]
    table = spark.createDataFrame(
        # the first `longer` blocks of a source have a word more than `words`
        [(r["source"], i, n, aims[i], k, n // max(k, 1), n % max(k, 1)) for i, (r, n, k) in enumerate(zip(found, sizes, counts, strict=True))],
        "source string, s int, source_size long, target double, blocks long, words long, longer long",
    )
    table = F.broadcast(table)  # at most MAX_SOURCES rows
    rows = counted.withColumnRenamed("source", "own").join(table, F.col("own").eqNullSafe(F.col("source"))).drop("own")
    if total <= 0:
        plan = spark.createDataFrame([], "slot long, source string, block long, epoch long, words long")
        return rows.select("id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken")), plan
    slots = schedule(spark, wanted, round(sum(wanted))).join(table, "s").where(F.col("rank") < cap * F.col("blocks"))
    slots = slots.withColumn("block", F.col("rank") % F.col("blocks")).select("slot", "s", "source", "block", F.expr("rank div blocks").alias("epoch"), (F.col("words") + F.when(F.col("block") < F.col("longer"), 1).otherwise(0)).alias("words"))
    times = slots.groupBy("s", "block").agg(F.count("*").alias("times"))
    placed = _offsets(rows.where("size > 0").select("uid", "s", "size", "h", F.col("words").alias("q"), F.col("longer").alias("r")), n)
    of = lambda w: f"if({w} < r * (q + 1), {w} div (q + 1), r + ({w} - r * (q + 1)) div q)"  # noqa: E731 - the block that a word is in
    ends: Column = F.col("start") + F.col("size")
    parts = placed.select("uid", "s", "start", "q", "r", ends.alias("end"), F.explode(F.expr(f"sequence({of('start')}, {of('(start + size - 1)')})")).alias("block"))
    begin = lambda j: F.expr(f"({j}) * q + least({j}, r)")
    parts = parts.select("uid", "s", "block", (F.least("end", begin("block + 1")) - F.greatest("start", begin("block"))).alias("words"))
    taken = parts.join(times, ["s", "block"]).groupBy("uid").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    out = rows.join(taken, "uid", "left").select("id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "uid")
    return out.drop("uid"), slots.select("slot", "source", "block", "epoch", "words")

