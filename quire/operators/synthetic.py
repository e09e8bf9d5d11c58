"""A synthetic evaluation corpus of any size, for benchmarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINES = (
    "the river rises early in the spring and the fields are wet", "her letter came on a monday with the morning post", "no one had seen the old map since the fire",
    "a narrow road leads from the mill to the upper village", "they counted forty boxes and wrote the number down", "the bell rang twice before the doors were opened",
    "in the third year the harvest was better than before", "some of the pages are torn and two are missing", "he answered slowly and did not look up from his work", "what remains of the wall can be seen from the bridge",
)
FONTS = ("serif", "sans", "slab", "hand")
DISTORTIONS = ((), ("blur",), ("jpeg",), ("rotate",), ("blur", "jpeg"))
SOURCES = 7


def _draw(k: int, seed: int, *what: str | Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *what), F.lit(k)).cast("int")


def synthetic_pages(spark: SparkSession, pages: int, lines: int, error_rate: float = 0.05, seed: int = 7, tasks: int | None = None) -> DataFrame:
    """Manifest columns, reference and prediction of `pages` pages of `lines` lines; a share error_rate of the letters is wrong."""
    ids = spark.range(0, pages, 1, tasks).select(F.format_string("page_%07d", "id").alias("page_id"), "id")
    one = lambda xs, k: F.get(F.array(*map(F.lit, xs)), k)
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(lines)), lambda i: F.concat(one(LINES, F.pmod(F.xxhash64(F.lit(seed), "id", i), F.lit(len(LINES))).cast("int")), F.lit(" "), F.pmod(F.xxhash64("id", i), F.lit(1000)).cast("string"))), "\n")
    rows = ids.withColumn("reference", text)
    chars = F.sequence(F.lit(1), F.length("reference"))
    letter = lambda i: F.substring(F.col("reference"), i, F.lit(1))
    wrong = lambda i: (F.pmod(F.xxhash64(F.lit(seed + 1), "id", i), F.lit(10_000)) < int(error_rate * 10_000)) & (letter(i) != "\n")
    garbled = F.array_join(F.transform(chars, lambda i: F.when(wrong(i), F.translate(letter(i), "aeiounstrl", "eiaoumzdnh")).otherwise(letter(i))), "")
    marks = F.array(*(F.array(*map(F.lit, d)).cast("array<string>") for d in DISTORTIONS))
    return rows.select(
        "page_id", F.lit("synthetic_heldout").alias("split"), F.lit("synthetic").alias("kind"), F.array(one(FONTS, _draw(len(FONTS), seed, F.lit("font"), "id"))).alias("fonts"), F.get(marks, _draw(len(DISTORTIONS), seed, F.lit("marks"), "id")).alias("distortions"),
        F.concat(F.lit("source_"), _draw(SOURCES, seed, F.lit("source"), "id").cast("string")).alias("source"), (_draw(3, seed, F.lit("augmented"), "id") == 0).alias("is_augmented"), "reference", garbled.alias("prediction"),
    )
