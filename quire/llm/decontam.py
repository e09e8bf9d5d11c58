"""Benchmark decontamination by spaced-seed hashing, with DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import bit_filter
from quire.llm.common import OWN, SPACE, settle, text_of

#: Positions of a window that a seed looks at; the others may hold any word. Of any 13 aligned words up to two of which
#: differ (80 % of 13 are 11 words), some window of eight fits one of these two: the search loses no passage of 13 words.
SEEDS = ("11101011", "11001111")
#: A passage is at least this many aligned words (a shorter benchmark item counts whole), of which MIN_SHARE agree.
MIN_WORDS, MIN_SHARE = 13, 0.8
#: Hashes of the benchmark are broadcast up to this many; beyond, those of the corpus that a filter holds are joined by a shuffle.
BROADCAST_HASHES = 500_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words in lower case (A-Z only); white space is space and \\t..\\r."""
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), SPACE), lambda w: w != "")


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _hashes(words: str, seeds: Sequence[str]) -> Column:
    """(pos, seed, h) for every window of an array column of words' hashes. Each seed's kept words are hashed in order."""
    span = len(seeds[0])
    one = lambda k, s: f"struct(i as pos, {k} as seed, xxhash64({', '.join(f'{words}[i + {j}]' for j in range(span) if s[j] == '1')}) as h)"
    every = ", ".join(one(k, s) for k, s in enumerate(seeds))
    return F.expr(f"flatten(transform(if(size({words}) < {span}, cast(array() as array<int>), sequence(0, size({words}) - {span})), i -> array({every})))")


def _parts(n: int, min_share: float) -> list[tuple[int, int]]:
    """(start, length) of one part more than words may be replaced in an item of n words: one of them is always whole."""
    k = n - math.ceil(min_share * n - 1e-9) + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _run(words: str, at: str, length: int) -> str:
    """(pos, seed, h) of `length` words in a row; such seeds are numbered below zero."""
    return f"struct({at} as pos, {-length} as seed, xxhash64({', '.join(f'{words}[{at} + {j}]' for j in range(length))}) as h)"


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", seeds: Sequence[str] = SEEDS, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE) -> DataFrame:
    """One row for each (id, item) of which docs holds a passage: id, item, doc_start, item_start, words, agree.

    Seeds hash the words at their kept positions in every window of both sides; equal hashes name a document, an item and an
    alignment. Around it, the words of the item and of the document are compared one by one: a passage is the longest stretch
    of windows of min_words aligned words (the item's length if that is less) in which min_share of the words agree, ends
    trimmed to words that agree. Words may be replaced, not inserted. The passage with the most agreeing words is returned.

    The benchmark's hashes are counted before they are broadcast; past BROADCAST_HASHES a filter of bounded size goes to the
    scan instead, and what it holds shuffles by hash. Only (id, item, alignment) triples leave the scan. A filter of their ids
    then lets the documents that have one through to the join with them: no other text is shuffled, whatever its length.

    Items of fewer than min_words words are cut into one part more than words may be replaced; a document meets them by any
    whole part (its windows of a part's length are hashed only if the benchmark has such items). Texts are read whole, however
    long. Null texts have no words; null and
    repeated ids or items are values like others (rows with the same id count as one document if their texts agree at the
    same place). Empty tables give an empty result; other columns are not looked at.
    """
    items = benchmark.select(F.col(f"`{item_col}`").alias("item"), words_of(text_of(item_text_col)).alias("iw"))
    items = settle(items.distinct())
    known = settle(items.select("item", _hashed(F.col("iw")).alias("ih")).select("item", F.explode(_hashes("ih", seeds)).alias("k")).select("item", F.col("k.pos").alias("ip"), F.col("k.seed").alias("seed"), F.col("k.h").alias("h")))
    sizes = sorted(r[0] for r in items.select(F.size("iw").alias("n")).where(f"n BETWEEN 1 AND {min_words - 1}").distinct().collect())
    lengths = sorted({length for n in sizes for _, length in _parts(n, min_share)})
    if sizes:
        hashed = items.select("item", _hashed(F.col("iw")).alias("ih"))
        of = [f"WHEN {n} THEN array({', '.join(_run('ih', str(a), length) for a, length in _parts(n, min_share))})" for n in sizes]
        short = hashed.where(F.size("ih").isin(sizes)).select("item", F.explode(F.expr(f"CASE size(ih) {' '.join(of)} END")).alias("k"))
        known = settle(known.union(short.select("item", F.col("k.pos").alias("ip"), F.col("k.seed").alias("seed"), F.col("k.h").alias("h"))))
    n_known = known.count()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text_of(text_col)).alias("version"), _hashed(words_of(text_of(text_col))).alias("dh"))
    every = _hashes("dh", seeds)
    for length in lengths:
        every = F.concat(every, F.expr(f"transform(if(size(dh) < {length}, cast(array() as array<int>), sequence(0, size(dh) - {length})), i -> {_run('dh', 'i', length)})"))
    seen = rows.select("id", "version", F.explode(every).alias("k")).select("id", "version", F.col("k.pos").alias("dp"), F.col("k.seed").alias("seed"), F.col("k.h").alias("h"))
    if n_known > BROADCAST_HASHES:
        bits = bit_filter.bits_for(n_known)
        seen = bit_filter.probe(seen, bit_filter.build(known, "h", bits), F.col("h"), bits, OWN + "maybe").where(OWN + "maybe").drop(OWN + "maybe")
    hits = seen.join(F.broadcast(known) if n_known <= BROADCAST_HASHES else known, ["seed", "h"]).select("id", "version", "item", (F.col("dp") - F.col("ip")).alias("shift"))
    hits = settle(hits.groupBy("id", "version", "item", "shift").count().drop("count"))
    # only texts with a hit go to the join
    which, bits = F.xxhash64("id", "version"), bit_filter.bits_for(hits.count())
    held = bit_filter.build(hits.select(which.alias("which")), "which", bits)
    texts = docs.select(F.col(f"`{id_col}`").alias("rid"), F.xxhash64(text_of(text_col)).alias("rversion"), text_of(text_col).alias("rtext"))
    texts = bit_filter.probe(texts, held, F.xxhash64("rid", "rversion"), bits, OWN + "maybe").where(OWN + "maybe").select("rid", "rversion", words_of(F.col("rtext")).alias("dw"))
    met = texts.join(hits, F.col("rid").eqNullSafe(F.col("id")) & (F.col("rversion") == F.col("version"))).drop("rid", "rversion", "version")
    met = met.join(items.withColumnRenamed("item", "of"), F.col("item").eqNullSafe(F.col("of")))
    # of the item's words that stand on a word of the document: does it agree?
    met = met.withColumn("first", F.greatest(F.lit(0), -F.col("shift"))).withColumn("n", F.least(F.size("iw"), F.size("dw") - F.col("shift")) - F.col("first"))
    met = met.withColumn("eq", F.expr("zip_with(slice(iw, first + 1, n), slice(dw, first + shift + 1, n), (a, b) -> if(a = b, 1, 0))"))
    met = met.withColumn("w", F.least(F.lit(min_words), F.size("iw"))).where("n >= w").select("id", "item", "shift", "first", "n", "eq", "w")
    agreeing = lambda a, n: f"aggregate(slice(eq, {a} + 1, {n}), 0, (x, y) -> x + y)"  # noqa: E731 - min_words steps for each window
    sums = met.withColumn("agree", F.expr(f"transform(sequence(0, n - w), i -> {agreeing('i', 'w')})"))
    good = sums.withColumn("good", F.expr(f"filter(sequence(0, n - w), i -> agree[i] >= {min_share} * w)")).where("size(good) > 0")
    # neighbouring windows make one passage: where the next good window starts past the end, another one begins
    good = good.withColumn("heads", F.expr("filter(good, (g, i) -> i = 0 or g > good[i - 1] + w)")).withColumn("tails", F.expr("filter(good, (g, i) -> i = size(good) - 1 or good[i + 1] > g + w)"))
    runs = good.select("id", "item", "shift", "first", "eq", "w", F.explode(F.arrays_zip("heads", "tails")).alias("r")).withColumn("a", F.col("r.heads")).withColumn("b", F.col("r.tails") + F.col("w"))
    runs = runs.withColumn("a", F.expr("a + array_position(slice(eq, a + 1, b - a), 1) - 1")).withColumn("b", F.expr("b - array_position(reverse(slice(eq, a + 1, b - a)), 1) + 1")).withColumn("a", F.col("a").cast("int"))
    found = runs.select("id", "item", F.struct(F.expr(agreeing("a", "cast(b as int) - a")).alias("agree"), (-(F.col("first") + F.col("shift") + F.col("a"))).alias("d"), (-(F.col("first") + F.col("a"))).alias("i"), (F.col("b") - F.col("a")).cast("int").alias("words")).alias("p"))
    best = found.groupBy("id", "item").agg(F.max("p").alias("p"))
    return best.select("id", "item", (-F.col("p.d")).cast("int").alias("doc_start"), (-F.col("p.i")).cast("int").alias("item_start"), F.col("p.words").alias("words"), F.col("p.agree").alias("agree"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", **options) -> DataFrame:
    """Rows of docs that hold no passage of the benchmark, with all their columns, whatever their names.

    Null and blank texts hold none and stay; very long ones are searched whole; repeated rows stay or go together, and so do all rows
    without an id if one of them holds a passage. An empty table of documents stays empty, one of items drops nothing.
    """
    return bit_filter.without(docs, id_col, contaminated(docs, benchmark, id_col, text_col, item_col, **options).select("id").distinct(), nulls=True)
