"""The driver's `documents` seen as an evaluation corpus with two prediction sets; the same rules in Spark and in SQL.

Every document is a page, with its whole text in its own characters. One without a letter or digit is a page that no one can
read. Predictions have a damaged stretch each, are empty, refuse, loop, or have their first line last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.schema import MARKER

#: Characters of a prediction's damaged stretch, and the letters exchanged in it.
STRETCH = 400
SWAPS = {"baseline": ("aei", "eia"), "candidate": ("a", "e")}
PERIODS = {"baseline": 13, "candidate": 26}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _prediction(kind: str) -> Column:
    """How a prediction set garbles a reference, by the document's id."""
    ref, k = F.col("reference"), F.col("doc_id")
    probe = F.when(k % (20 if kind == "baseline" else 30) == 0, MARKER).when(k % 40 == 30, MARKER + ".").otherwise(F.substring("t", 1, 40))
    newline = F.instr(ref, "\n")
    rotated = F.when(newline > 0, F.concat(F.substr(ref, newline + 1), F.lit("\n"), F.substr(ref, F.lit(1), newline - 1))).otherwise(ref)
    repeated = F.repeat(F.concat(F.substring(ref, 1, 60), F.lit("\n")), F.lit(12))
    start = (k * 37 % F.greatest(F.length(ref), F.lit(1))).cast("int")
    damaged = F.concat(F.substr(ref, F.lit(1), start), F.translate(F.substr(ref, start + 1, F.lit(STRETCH)), *SWAPS[kind]), F.substr(ref, start + 1 + STRETCH))
    at = k % PERIODS[kind]
    return F.when(F.col("kind") == "probe", probe).when(at == 0, "").when(at == 1, MARKER).when(at == 2, repeated).when(at == 3, rotated).otherwise(damaged)


def corpus(spark: SparkSession, sf_dir: str, prediction: str = "baseline") -> DataFrame:
    """page_id, split, kind, fonts, distortions, source, is_augmented, reference, prediction (and doc_id) of every document."""
    k, docs = F.col("doc_id"), table(spark, sf_dir, "documents").withColumn("t", F.coalesce("text", F.lit("")))
    unreadable = (k % 10 == 0) | ~F.col("t").rlike(r"[\p{L}\p{N}]")
    split = F.when(unreadable, "probe").when(k % 10 == 1, "gold_scans").otherwise("synthetic_heldout")
    kind = F.when(unreadable, "probe").when(k % 10 == 1, "scan").otherwise("synthetic")
    none = F.array().cast("array<string>")
    fonts = F.when(k % 10 == 1, none).when(k % 7 == 0, F.array(F.lit("alt"), "lang")).otherwise(F.array("lang"))
    marks = F.when(k % 5 == 0, none).when(k % 5 == 1, F.array(F.lit("blur"))).when(k % 5 == 2, F.array(F.lit("jpeg"))).when(k % 5 == 3, F.array(F.lit("rotate"))).otherwise(F.array(F.lit("blur"), F.lit("jpeg")))
    pages = docs.select("doc_id", F.concat(F.lit("doc_"), F.lpad(k.cast("string"), 12, "0")).alias("page_id"), split.alias("split"), kind.alias("kind"), fonts.alias("fonts"), marks.alias("distortions"), "source", (k % 3 == 0).alias("is_augmented"), F.when(unreadable, MARKER).otherwise(F.col("t")).alias("reference"), "t")
    return pages.withColumn("prediction", _prediction(prediction)).drop("t")


def _garbled(kind: str) -> str:
    at, (a, b) = f"doc_id % {PERIODS[kind]}", SWAPS[kind]
    return f"""CASE WHEN kind = 'probe' THEN CASE WHEN doc_id % {20 if kind == 'baseline' else 30} = 0 THEN '{MARKER}' WHEN doc_id % 40 = 30 THEN '{MARKER}.' ELSE substr(t, 1, 40) END
    WHEN {at} = 0 THEN '' WHEN {at} = 1 THEN '{MARKER}' WHEN {at} = 2 THEN repeated WHEN {at} = 3 THEN rotated
    ELSE substr(reference, 1, start) || translate(substr(reference, start + 1, {STRETCH}), '{a}', '{b}') || substr(reference, start + 1 + {STRETCH}) END AS {kind}"""


#: page (both predictions) for the oracles.
SQL = rf"""
d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, doc_id % 10 = 0 OR NOT regexp_matches(coalesce(text, ''), '[\p{{L}}\p{{N}}]') AS unreadable FROM documents),
r AS (SELECT doc_id, 'doc_' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS page_id, t, source, doc_id % 3 = 0 AS is_augmented,
  CASE WHEN unreadable THEN 'probe' WHEN doc_id % 10 = 1 THEN 'gold_scans' ELSE 'synthetic_heldout' END AS split,
  CASE WHEN unreadable THEN 'probe' WHEN doc_id % 10 = 1 THEN 'scan' ELSE 'synthetic' END AS kind,
  CASE WHEN doc_id % 10 = 1 THEN CAST([] AS VARCHAR[]) WHEN doc_id % 7 = 0 THEN ['alt', lang] ELSE [lang] END AS fonts,
  CASE doc_id % 5 WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN ['blur'] WHEN 2 THEN ['jpeg'] WHEN 3 THEN ['rotate'] ELSE ['blur', 'jpeg'] END AS distortions,
  CASE WHEN unreadable THEN '{MARKER}' ELSE t END AS reference FROM d),
g AS (SELECT *, CASE WHEN strpos(reference, chr(10)) > 0 THEN substr(reference, strpos(reference, chr(10)) + 1) || chr(10) || substr(reference, 1, strpos(reference, chr(10)) - 1) ELSE reference END AS rotated,
  repeat(substr(reference, 1, 60) || chr(10), 12) AS repeated, CAST(doc_id * 37 % greatest(length(reference), 1) AS BIGINT) AS start FROM r),
page AS MATERIALIZED (SELECT doc_id, page_id, split, kind, fonts, distortions, source, is_augmented, reference, {_garbled('baseline')}, {_garbled('candidate')} FROM g),
letters AS (SELECT c, row_number() OVER (ORDER BY c) AS i FROM (SELECT DISTINCT unnest(string_split(text, '')) AS c FROM documents) WHERE NOT regexp_matches(c, '^[\x00-\x7F]$')),
controls AS (SELECT chr(CAST(k AS INTEGER)) AS s, row_number() OVER (ORDER BY k) AS i FROM range(1, 32) t(k) WHERE k NOT BETWEEN 9 AND 13),
spelling AS (SELECT coalesce(string_agg(c, '' ORDER BY i), '') AS f, coalesce(string_agg(s, '' ORDER BY i), '') AS t FROM letters JOIN controls USING (i))
"""

_SHRINK = "list_reduce([1048576, 524288, 262144, 131072, 65536, 32768, 16384, 8192, 4096, 2048, 1024, 512, 256, 128, 64, 32, 16, 8, 4, 2, 1], lambda acc, s: CASE WHEN acc + s <= least(length(a), length(b)) AND {0}(a, acc + s) = {0}(b, acc + s) THEN acc + s ELSE acc END, 0)"


def edits_sql(name: str, source: str, a: str, b: str) -> str:
    """name(page_id, edits): the edit distance of two columns of source (which has page_id).

    DuckDB's levenshtein counts bytes and takes the product of the lengths: letters beyond ASCII are spelled as control characters
    (fewer than 27 occur), and what both texts begin or end with, which changes no distance, is taken off first.
    """
    return f"""{name}_1 AS (SELECT page_id, translate({a}, f, t) AS a, translate({b}, f, t) AS b FROM {source}, spelling),
{name}_2 AS (SELECT page_id, substr(a, n + 1) AS a, substr(b, n + 1) AS b FROM (SELECT *, {_SHRINK.format('left')} AS n FROM {name}_1)),
{name} AS MATERIALIZED (SELECT page_id, levenshtein(left(a, length(a) - n), left(b, length(b) - n)) AS edits FROM (SELECT *, {_SHRINK.format('right')} AS n FROM {name}_2))"""


def scored_sql(prediction: str) -> str:
    """s_<prediction>: each page with outcome, flags and counts at the strict level."""
    p = prediction
    return rf"""
{edits_sql(f'e_{p}', 'page', 'reference', p)},
s_{p} AS (SELECT page_id, doc_id, split, kind, fonts, distortions, source, is_augmented, reference, {p} AS prediction,
  CASE WHEN trim(reference, E' \n\t\r') = '{MARKER}' THEN CASE WHEN trim({p}, E' \n\t\r') = '{MARKER}' THEN 'correct_refusal' ELSE 'hallucination' END
    WHEN trim({p}, E' \n\t\r') = '{MARKER}' THEN 'false_refusal' ELSE 'scored' END AS outcome,
  kind <> 'probe' AS has_metrics, edits AS char_edits, length(reference) AS ref_chars,
  CAST(length({p}) AS DOUBLE) / greatest(length(reference), 1) AS length_ratio,
  trim({p}, E' \n\t\r') = '' AS empty_prediction,
  length({p}) >= 2.0 * length(reference) AND length({p}) - length(reference) >= 100 AS runaway_length
  FROM page JOIN e_{p} USING (page_id))
"""
