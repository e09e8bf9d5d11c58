"""Registered queries of the engine, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import html
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import contrast, order, predicate, prepare, rollups, scoring, validation
from quire.plans.corpus import SQL, corpus, edits_sql, scored_sql, table
from quire.schema import FLAGS, PROBE_OUTCOMES
from quire.sources.files import write_predictions
from quire.sources.manifest import read_manifest
from quire.sources.predictions import digests_by, read_folder, read_lines
from quire.reports import number, percent
from quire.sources.runs import run_id
from quire.sources.shards import shard_aug, shard_group
from quire.sources.writer import dumps_line
from quire.store import checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query over whole tables and texts, and the SQL that gives its rows if there is any."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _scores(spark: SparkSession, sf_dir: str, prediction: str = "baseline") -> DataFrame:
    return scoring.score(corpus(spark, sf_dir, prediction))


def _strict(spark: SparkSession, sf_dir: str, prediction: str = "baseline") -> DataFrame:
    """Scores of queries that look at the strict level alone."""
    return scoring.score(corpus(spark, sf_dir, prediction), levels=_STRICT, with_order=False)


def _chars(spark: SparkSession, sf_dir: str, prediction: str = "baseline") -> DataFrame:
    """Scores of queries that look at no words either."""
    return scoring.score(corpus(spark, sf_dir, prediction), levels=_STRICT, with_order=False, with_words=False)


_STRICT = ("strict",)


BASE = f"WITH {SQL}, {scored_sql('baseline')}"
BOTH = f"WITH {SQL}, {scored_sql('baseline')}, {scored_sql('candidate')}"
#: Skeleton of texts without Arabic letters: no punctuation, symbols or marks, words one space apart.
SKELETON = r"trim(regexp_replace(regexp_replace(nfc_normalize({0}), '[\p{{P}}\p{{S}}\p{{Mn}}]', '', 'g'), '\s+', ' ', 'g'))"


def _skel(c: str) -> str:
    return SKELETON.format(c)


# ---- split totals

_RATES = """
  CASE WHEN count(*) FILTER (has_metrics) > 0 THEN CAST(sum(char_edits) FILTER (has_metrics) AS BIGINT) END AS char_edits,
  CASE WHEN count(*) FILTER (has_metrics) > 0 THEN CAST(sum(ref_chars) FILTER (has_metrics) AS BIGINT) END AS ref_chars,
  CAST(sum(char_edits) FILTER (has_metrics) AS DOUBLE) / CAST(sum(ref_chars) FILTER (has_metrics) AS BIGINT) AS cer_micro,
  round(avg(CAST(char_edits AS DOUBLE) / ref_chars) FILTER (has_metrics), 9) AS cer_macro,
  CAST(count(*) FILTER (has_metrics AND char_edits = 0) AS DOUBLE) / nullif(count(*) FILTER (has_metrics), 0) AS exact_match_rate"""
_CONTRACT = """
  count(*) FILTER (outcome = 'correct_refusal') AS correct_refusal, count(*) FILTER (outcome = 'hallucination') AS hallucination,
  count(*) FILTER (outcome = 'false_refusal') AS false_refusal, count(*) FILTER (outcome IN ('correct_refusal', 'hallucination')) AS probe_pages,
  CAST(count(*) FILTER (outcome = 'hallucination') AS DOUBLE) / nullif(count(*) FILTER (outcome IN ('correct_refusal', 'hallucination')), 0) AS hallucination_rate,
  CAST(count(*) FILTER (outcome = 'false_refusal') AS DOUBLE) / nullif(count(*) FILTER (has_metrics), 0) AS false_refusal_rate"""


@query(f"{BASE} SELECT split, count(*) AS pages, count(*) FILTER (has_metrics) AS scored_pages, {_CONTRACT}, {_RATES} FROM s_baseline GROUP BY split")
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, contract and strict error rates of each split."""
    sums = {n: F.sum(f"metrics.strict.{n}") for n in ("char_edits", "ref_chars")}
    rates = {n: F.col(f"strict_{n}") for n in ("cer_micro", "exact_match_rate")} | {"cer_macro": F.round("strict_cer_macro", 9)}
    totals = rollups.split_totals(_strict(spark, sf_dir), sums, _STRICT)
    return totals.select("split", "pages", "scored_pages", "correct_refusal", "hallucination", "false_refusal", "probe_pages", "hallucination_rate", "false_refusal_rate", *(c.alias(n) for n, c in rates.items()), *sums)


@query()
def split_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything a split's summary has, at all levels (word distances and order have no SQL form)."""
    return rollups.split_totals(_scores(spark, sf_dir))


@query()
def page_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a run directory holds it."""
    return _scores(spark, sf_dir).drop("order_counts", "doc_id")


@query(f"""{BASE} SELECT split, CAST(sum(char_edits) AS BIGINT) AS char_edits, CAST(sum(ref_chars) AS BIGINT) AS ref_chars, CAST(sum(char_edits) AS DOUBLE) / CAST(sum(ref_chars) AS BIGINT) AS micro,
  round(avg(CAST(char_edits AS DOUBLE) / ref_chars), 9) AS macro FROM s_baseline WHERE has_metrics GROUP BY split""")
def split_micro_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("metrics.strict")
    e, n = m["char_edits"], m["ref_chars"]
    return _chars(spark, sf_dir).where("metrics IS NOT NULL").groupBy("split").agg(F.sum(e).alias("char_edits"), F.sum(n).alias("ref_chars"), rollups.micro(e, n).alias("micro"), F.round(rollups.macro(e, n), 9).alias("macro"))


@query(f"{BASE} SELECT split, count(*) FILTER (has_metrics) AS scored_pages, CAST(sum(char_edits) FILTER (has_metrics) AS DOUBLE) / CAST(sum(ref_chars) FILTER (has_metrics) AS BIGINT) AS cer FROM s_baseline GROUP BY split")
def split_headline_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.split_totals(_chars(spark, sf_dir), levels=_STRICT).select("split", "scored_pages", F.col("strict_cer_micro").alias("cer"))


@query(f"{BASE} SELECT split, outcome, count(*) AS pages FROM s_baseline GROUP BY ALL")
def contract_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("split", X.outcome(F.col("reference"), F.col("prediction")).alias("outcome")).groupBy("split", "outcome").agg(F.count("*").alias("pages"))


@query(f"{BASE} SELECT split, {_CONTRACT} FROM s_baseline GROUP BY split")
def contract_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.split_totals(_chars(spark, sf_dir), levels=_STRICT).select("split", "correct_refusal", "hallucination", "false_refusal", "probe_pages", "hallucination_rate", "false_refusal_rate")


# ---- distances and normalisation


@query(f"{BASE} SELECT page_id, char_edits, ref_chars FROM s_baseline")
def page_char_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).repartition("page_id").select("page_id", X.char_edits("reference", "prediction").cast("long").alias("char_edits"), F.length("reference").cast("long").alias("ref_chars"))


@query()
def page_word_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word distances of all pages (SQL cannot compare lists of words)."""
    rows = corpus(spark, sf_dir).repartition("page_id")
    return rows.select("page_id", X.word_edits("reference", "prediction").cast("long").alias("word_edits"), F.size(X.words(F.col("reference"))).cast("long").alias("ref_words"))


@query()
def page_word_edits_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word distances of whole documents against their texts with two letters exchanged."""
    docs = table(spark, sf_dir, "documents").repartition("doc_id")
    return docs.select("doc_id", X.word_edits("text", F.translate("text", "ae", "ea")).alias("word_edits"), F.size(X.words(F.col("text"))).alias("words"))


@query()
def page_edits_throughout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances where errors are all over the text: every fiftieth letter of a document is another one, gone, or doubled by a mark."""
    fiftieth = F.lit(r"(?s)(.{49})(.)")
    one, two, three = (F.regexp_replace("text", fiftieth, F.lit(r)) for r in ("$1#", "$1", "$1$2#"))
    garbled = F.when(F.col("doc_id") % 3 == 0, one).when(F.col("doc_id") % 3 == 1, two).when(F.col("doc_id") % 3 == 2, three)
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartition("doc_id").withColumn("garbled", garbled)
    return docs.select("doc_id", X.char_edits("text", "garbled").alias("char_edits"), X.word_edits("text", "garbled").alias("word_edits"))


_ARABIC = ("abcdefghijklmnopqrstuvwxyz", "ابتثجحخدذرزسشصضطظعغفقكلمنه")
_MARKED = (".,?", "ًِٰ")


@query(f"""WITH {SQL}, m AS (SELECT page_id, translate(translate(lower(reference), '{_ARABIC[0]}', '{_ARABIC[1]}'), '{_MARKED[0]}', '{_MARKED[1]}') AS t FROM page)
  SELECT page_id, CAST(length(t) AS BIGINT) AS strict_chars, regexp_replace(t, '[ً-ٰٟ]', '', 'g') AS bare FROM m""")
def level_diacritics(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.translate(F.translate(F.lower("reference"), *_ARABIC), *_MARKED)
    return corpus(spark, sf_dir).select("page_id", F.length(t).cast("long").alias("strict_chars"), X.diacritic_insensitive(t).alias("bare"))


@query(f"WITH {SQL} SELECT page_id, {_skel('reference')} AS skeleton FROM page")
def level_skeleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("page_id", X.skeleton("reference").alias("skeleton"))


@query(f"{BASE} SELECT split, count(*) FILTER (reference = prediction) AS exact, count(*) AS pages FROM s_baseline WHERE has_metrics GROUP BY split")
def exact_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chars(spark, sf_dir).where("metrics IS NOT NULL").groupBy("split").agg(F.count_if(F.col("metrics.strict.exact_match")).alias("exact"), F.count("*").alias("pages"))


@query(rf"""WITH {SQL} SELECT page_id, CAST(len(list_filter(regexp_split_to_array(reference, '\s+'), lambda x: x <> '')) AS BIGINT) AS words,
  CAST(len(list_filter(string_split(reference, chr(10)), lambda x: trim(x, E' \t\r') <> '')) AS BIGINT) AS lines FROM page""")
def tokens_and_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("page_id", F.size(X.words(F.col("reference"))).cast("long").alias("words"), F.size(X.lines(F.col("reference"))).cast("long").alias("lines"))


# ---- flags


@query(f"{BASE} SELECT page_id, length_ratio, runaway_length FROM s_baseline")
def flags_runaway(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, p = F.col("reference"), F.col("prediction")
    return corpus(spark, sf_dir).select("page_id", X.length_ratio(r, p).alias("length_ratio"), X.is_runaway(r, p, 2.0, 100).alias("runaway_length"))


_REPETITION = f"""l AS (SELECT page_id, length(baseline) AS n, unnest(string_split(baseline, chr(10))) AS line FROM page),
  k AS (SELECT page_id, any_value(n) AS n, {_skel('line')} AS key, count(*) AS c FROM l GROUP BY page_id, key),
  f AS (SELECT page_id, bool_or(length(key) >= 10 AND c >= 5 AND CAST(length(key) * c AS DOUBLE) / greatest(n, 1) >= 0.3) AS repetition FROM k GROUP BY page_id)"""


@query(f"WITH {SQL}, {_REPETITION} SELECT page_id, repetition FROM f")
def flags_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chars(spark, sf_dir).select("page_id", F.array_contains("flags", "repetition").alias("repetition"))


@query(f"""{BASE}, {_REPETITION} SELECT split, count(*) FILTER (empty_prediction) AS empty_prediction, count(*) FILTER (repetition) AS repetition, count(*) FILTER (runaway_length) AS runaway_length
  FROM s_baseline JOIN f USING (page_id) GROUP BY split""")
def flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.split_totals(_chars(spark, sf_dir), levels=_STRICT).select("split", *FLAGS)


# ---- breakdowns and rankings


def _breakdown_sql(values: str) -> str:
    return f"""{BASE}, v AS (SELECT split, page_id, char_edits AS e, ref_chars AS n, unnest({values}) AS key FROM s_baseline WHERE has_metrics),
  z AS (SELECT *, count(*) OVER (PARTITION BY split, key) AS c FROM v),
  o AS (SELECT split, page_id, e, n, key FROM z WHERE c >= 5 UNION ALL SELECT DISTINCT split, page_id, e, n, '__sparse__' FROM z WHERE c < 5),
  q AS (SELECT split, key, count(*) AS pages, CAST(sum(e) AS DOUBLE) / CAST(sum(n) AS BIGINT) AS cer_micro, round(avg(CAST(e AS DOUBLE) / n), 9) AS cer_macro,
    CAST(count(*) FILTER (e = 0) AS DOUBLE) / count(*) AS exact_match_rate FROM o GROUP BY split, key)
  SELECT *, CAST(row_number() OVER (PARTITION BY split ORDER BY cer_micro DESC, key) AS INTEGER) AS rank FROM q"""


def _breakdown(spark: SparkSession, sf_dir: str, dimension: str) -> DataFrame:
    rows = rollups.breakdowns(_strict(spark, sf_dir), 5).where(F.col("dimension") == dimension)
    return rows.select("split", "key", "pages", "cer_micro", F.round("cer_macro", 9).alias("cer_macro"), "exact_match_rate", "rank")


@query(_breakdown_sql("fonts"))
def breakdown_font(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _breakdown(spark, sf_dir, "font")


@query(_breakdown_sql("distortions"))
def breakdown_distortion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _breakdown(spark, sf_dir, "distortion")


@query(_breakdown_sql("[source]"))
def breakdown_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _breakdown(spark, sf_dir, "source")


@query(f"""{BASE}, v AS (SELECT split, 'font' AS dimension, len(fonts) AS k FROM s_baseline WHERE has_metrics UNION ALL SELECT split, 'distortion', len(distortions) FROM s_baseline WHERE has_metrics UNION ALL SELECT split, 'source', CASE WHEN source IS NULL THEN 0 ELSE 1 END FROM s_baseline WHERE has_metrics)
  SELECT split, dimension, sum(k) = count(*) AND count(*) FILTER (k > 0) = count(*) AS is_partition FROM v GROUP BY ALL""")
def is_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.partitions(_strict(spark, sf_dir))


@query(f"{BASE} SELECT page_id, split, char_edits, ref_chars, CAST(char_edits AS DOUBLE) / ref_chars AS cer FROM s_baseline WHERE has_metrics ORDER BY cer DESC, page_id LIMIT 25")
def worst_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("metrics.strict")
    return rollups.worst_pages(_strict(spark, sf_dir), 25).select("page_id", "split", m["char_edits"].cast("long").alias("char_edits"), m["ref_chars"].cast("long").alias("ref_chars"), m["cer"].alias("cer"))


@query(f"{BASE} SELECT page_id, round(CAST(char_edits AS DOUBLE) / ref_chars, 6) AS cer FROM s_baseline WHERE has_metrics AND split = 'gold_scans' ORDER BY cer DESC, page_id LIMIT 10")
def worst_pages_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _strict(spark, sf_dir)
    cer = F.round("metrics.strict.cer", 6)
    return rollups.worst_pages(rows, 10, "gold_scans", cer).select("page_id", cer.alias("cer"))


# ---- line order

_LINES = rf"""x AS (SELECT page_id, list_filter(string_split(reference, chr(10)), lambda x: trim(x, E' \t\r') <> '') AS la, list_filter(string_split(baseline, chr(10)), lambda x: trim(x, E' \t\r') <> '') AS lb FROM page WHERE kind <> 'probe'),
  ra AS (SELECT page_id, generate_subscripts(la, 1) - 1 AS i, unnest(la) AS line FROM x), pb AS (SELECT page_id, generate_subscripts(lb, 1) - 1 AS j, unnest(lb) AS line FROM x),
  ka AS (SELECT page_id, i, translate({_skel('line')}, f, t) AS k FROM ra, spelling), kb AS (SELECT page_id, j, translate({_skel('line')}, f, t) AS k FROM pb, spelling),
  twos AS (SELECT page_id, i, j, ka.k AS p, kb.k AS q, greatest(length(ka.k), length(kb.k)) AS n FROM ka JOIN kb USING (page_id) WHERE abs(length(ka.k) - length(kb.k)) * 2 <= greatest(length(ka.k), length(kb.k))),
  c AS (SELECT page_id, i, j, CASE WHEN p = q THEN 1.0 ELSE 1.0 - CAST(levenshtein(p, q) AS DOUBLE) / n END AS similarity FROM twos)"""
_MATCHED = f"""{_LINES}, ranked AS (SELECT page_id, list({{'i': i, 'j': j}} ORDER BY similarity DESC, i, j) AS cands FROM c WHERE similarity >= 0.5 GROUP BY page_id),
  m AS (SELECT page_id, list_reduce(cands, lambda acc, x: CASE WHEN len(list_filter(acc, lambda y: y.i = x[1].i OR y.j = x[1].j)) > 0 THEN acc ELSE list_concat(acc, x) END, []) AS pairs FROM (SELECT page_id, list_transform(cands, lambda z: [z]) AS cands FROM ranked)),
  placed AS (SELECT page_id, la, lb, list_transform(list_sort(list_transform(coalesce(pairs, []), lambda y: {{'i': y.i, 'j': y.j}})), lambda y: y.j) AS js FROM x LEFT JOIN m USING (page_id)),
  o AS (SELECT page_id, len(la) AS ref_lines, len(lb) AS pred_lines, len(js) AS matched, len(js) * (len(js) - 1) // 2 AS pairs,
    coalesce(list_sum(list_transform(range(0, len(js)), lambda a: len(list_filter(js[a + 2:], lambda z: z > js[a + 1])))), 0) AS concordant,
    CASE WHEN len(la) = 0 OR len(lb) = 0 THEN NULL ELSE array_to_string(list_concat(list_transform(js, lambda j: lb[j + 1]), list_transform(list_filter(range(0, len(lb)), lambda j: NOT list_contains(js, j)), lambda j: lb[j + 1])), chr(10)) END AS rebuilt FROM placed)"""


def _line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, a, b: skeletons of the reference's and the prediction's lines."""
    pages = corpus(spark, sf_dir).where("kind <> 'probe'").repartition("page_id")
    return pages.select("page_id", X.line_skeletons("reference").alias("a"), X.line_skeletons("prediction").alias("b"))


@query(f"WITH {SQL}, {_LINES} SELECT page_id, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, similarity FROM c WHERE similarity >= 0.5")
def line_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that may be partners, with their similarity."""
    return _line_keys(spark, sf_dir).select("page_id", F.inline(X.line_candidates("a", "b")))


@query(f"""WITH {SQL}, {_MATCHED} SELECT page_id, CAST(len(pairs) AS BIGINT) AS matched, array_to_string(list_sort(list_transform(pairs, lambda y: lpad(CAST(y.i AS VARCHAR), 4, '0') || ':' || CAST(y.j AS VARCHAR))), ',') AS pairs FROM m""")
def line_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy partners, best first."""
    rows = _line_keys(spark, sf_dir).select("page_id", X.line_partners("a", "b").alias("p")).where("size(p) > 0")
    said = F.array_join(F.array_sort(F.transform("p", lambda y: F.concat(F.lpad(y["i"].cast("string"), 4, "0"), F.lit(":"), y["j"].cast("string")))), ",")
    return rows.select("page_id", F.size("p").cast("long").alias("matched"), said.alias("pairs"))


@query(f"""WITH {SQL}, {_MATCHED}, y AS (SELECT page_id, reference, coalesce(rebuilt, baseline) AS rebuilt, o.* EXCLUDE (page_id, rebuilt) FROM page JOIN o USING (page_id)), {edits_sql('z', 'y', 'reference', 'rebuilt')}
  SELECT page_id, CAST(edits AS DOUBLE) / length(reference) AS order_corrected_cer, CASE WHEN pairs > 0 THEN CAST(concordant AS DOUBLE) / pairs END AS reading_order_accuracy, CAST(matched AS INTEGER) AS matched_lines,
  CAST(ref_lines AS INTEGER) AS ref_lines, CAST(pred_lines AS INTEGER) AS pred_lines, CAST(concordant AS INTEGER) AS concordant, CAST(pairs AS INTEGER) AS pairs FROM y JOIN z USING (page_id)""")
def order_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order metrics of each page: lines put in the reference's order, and concordant pairs of lines."""
    scores = scoring.score(corpus(spark, sf_dir), levels=_STRICT, with_words=False)
    return scores.where("metrics IS NOT NULL").select("page_id", "order.*", F.col("order_counts.concordant").alias("concordant"), F.col("order_counts.pairs").alias("pairs"))


@query(f"WITH {SQL}, {_MATCHED} SELECT split, CAST(sum(concordant) AS BIGINT) AS concordant, CAST(sum(pairs) AS BIGINT) AS pairs, CAST(sum(concordant) AS DOUBLE) / CAST(nullif(sum(pairs), 0) AS BIGINT) AS reading_order_accuracy, count(*) FILTER (pairs = 0) AS pages_without_order_signal FROM page JOIN o USING (page_id) GROUP BY split")
def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each split's concordance over all its pages, and how many of them say nothing about order."""
    sums = {c: F.sum(f"order_counts.{c}") for c in ("concordant", "pairs")}
    scores = scoring.score(corpus(spark, sf_dir), levels=_STRICT, with_words=False).where("metrics IS NOT NULL")
    return rollups.split_totals(scores, sums, _STRICT).select("split", "reading_order_accuracy", "pages_without_order_signal", *sums)


# ---- filters, subsets and validation


def _filtered(sql: str, expression: str, name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return predicate.select(corpus(spark, sf_dir), predicate.parse(expression)).select("page_id", "split", "source")

    run.__name__ = name
    query(f"WITH {SQL} SELECT page_id, split, source FROM page WHERE {sql}")(run)


_filtered("split = 'gold_scans'", "split=gold_scans", "filter_eq")
_filtered("list_contains(fonts, 'alt') AND is_augmented", "font=alt, is_augmented=true", "filter_list_eq")
_filtered("NOT list_contains(distortions, 'blur') AND source IS DISTINCT FROM 'src1'", "distortion!=blur,source!=src1", "filter_neq")
_filtered("contains(source, 'c1') AND len(list_filter(distortions, lambda x: contains(x, 'pe'))) > 0", "source~c1,distortion~pe", "filter_contains")


@query(f"WITH {SQL} SELECT page_id, split FROM page WHERE doc_id IN (SELECT DISTINCT user_id FROM events) AND kind <> 'probe'")
def pages_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "events").select(F.concat(F.lit("doc_"), F.lpad(F.col("user_id").cast("string"), 12, "0")).alias("page_id"))
    return predicate.select(corpus(spark, sf_dir), predicate.parse("kind!=probe"), ids).select("page_id", "split")


@query(f"WITH {SQL} SELECT page_id FROM page WHERE doc_id % 17 = 0")
def missing_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = corpus(spark, sf_dir)
    return validation.missing_predictions(pages, pages.where("doc_id % 17 <> 0").select("page_id", "prediction")).select("page_id")


@query(f"WITH {SQL} SELECT page_id FROM page WHERE doc_id % 19 = 3")
def orphan_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = corpus(spark, sf_dir)
    return validation.orphan_predictions(pages.select("page_id"), pages.where("doc_id % 19 <> 3")).select("page_id")


# ---- files: what the engine writes it reads again


def _scratch(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    return f"{checkpoint_dir(spark)}/quire-{uuid.uuid4().hex}"


def _lines_file(spark: SparkSession, lines: DataFrame) -> str:
    """Lines, sorted by ranges, as the parts of one file."""
    lines.write.text(folder := f"{_scratch(spark)}.jsonl")
    return folder


def _manifest_file(spark: SparkSession, sf_dir: str) -> str:
    """The corpus as a manifest of JSON lines in the order of ids, with faults: repeated ids, unknown kinds and fields, two references."""
    k, pages = F.col("doc_id"), corpus(spark, sf_dir)
    odd = lambda n, c: F.when(k % 29 == n, c)
    ident = F.when(k % 29 == 5, F.concat(F.lit("doc_"), F.lpad((k - 1).cast("string"), 12, "0"))).otherwise(F.col("page_id"))
    row = F.struct(
        ident.alias("page_id"), "split", F.coalesce(odd(7, F.lit("film")), F.col("kind")).alias("kind"), F.col("reference").alias("reference_text"), odd(11, F.lit("ref.txt")).alias("reference_path"),
        F.concat(F.lit("images/"), "page_id").alias("image_path"), "fonts", F.reverse("distortions").alias("distortions"), "source", "is_augmented", odd(13, F.lit(1)).alias("colour"),
    )
    return _lines_file(spark, pages.select("doc_id", row.alias("row")).repartitionByRange("doc_id").sortWithinPartitions("doc_id").select(F.to_json("row").alias("value")))


_FAULTS = f"""f AS (SELECT *, doc_id % 29 AS odd, row_number() OVER (ORDER BY doc_id) AS line, lag(doc_id) OVER (ORDER BY doc_id) AS before FROM page),
  faults AS (SELECT *, odd = 5 AND before IS NOT DISTINCT FROM doc_id - 1 AS again FROM f)"""


@query(f"""WITH {SQL}, {_FAULTS} SELECT CASE WHEN odd = 5 THEN 'doc_' || lpad(CAST(doc_id - 1 AS VARCHAR), 12, '0') ELSE page_id END AS page_id, split, kind, reference AS reference_text, array_to_string(list_sort(distortions), ',') AS distortions, source, is_augmented, line
  FROM faults WHERE odd NOT IN (7, 11) AND NOT again""")
def manifest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that a manifest's good lines give."""
    pages, _ = read_manifest(spark, _manifest_file(spark, sf_dir))
    return pages.select("page_id", "split", "kind", "reference_text", F.array_join("distortions", ",").alias("distortions"), "source", "is_augmented", "line")


@query(f"""WITH {SQL}, {_FAULTS} SELECT line, CASE WHEN odd = 7 THEN 'unknown kind' WHEN odd = 11 THEN 'two references' WHEN odd = 13 THEN 'unknown field' ELSE 'first seen at line ' || CAST(line - 1 AS VARCHAR) END AS problem
  FROM faults WHERE odd IN (7, 11, 13) OR again""")
def manifest_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything wrong with a manifest, repeated ids with the line where they were first seen."""
    _, problems = read_manifest(spark, _manifest_file(spark, sf_dir))
    m = F.col("message")
    said = F.when(m.contains("unknown kind"), "unknown kind").when(m.contains("exactly one of"), "two references").when(m.contains("unknown field"), "unknown field").otherwise(F.regexp_extract(m, r"first seen at line \d+", 0))
    return problems.select("line", said.alias("problem"))


def _prediction_lines(spark: SparkSession, sf_dir: str) -> str:
    """The baseline's predictions as JSON lines in the order of ids, some of them repeated or without text."""
    k, pages = F.col("doc_id"), corpus(spark, sf_dir)
    both = pages.select("doc_id", F.lit(0).alias("n"), "page_id", F.when(k % 31 != 3, F.col("prediction")).alias("text")).union(pages.where(k % 17 == 2).select("doc_id", F.lit(1), "page_id", F.lit("again")))
    return _lines_file(spark, both.repartitionByRange("doc_id", "n").sortWithinPartitions("doc_id", "n").select(F.to_json(F.struct("page_id", "text")).alias("value")))


@query(f"WITH {SQL} SELECT page_id, CASE WHEN doc_id % 31 = 3 THEN 'again' ELSE baseline END AS text FROM page WHERE doc_id % 31 <> 3 OR doc_id % 17 = 2")
def prediction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions from JSON lines: of lines with one id the first good one counts."""
    return read_lines(spark, _prediction_lines(spark, sf_dir))[0]


@query(f"WITH {SQL} SELECT 'repeats' AS kind, count(*) AS n FROM page WHERE doc_id % 17 = 2 AND doc_id % 31 <> 3 UNION ALL SELECT 'lacks', count(*) FROM page WHERE doc_id % 31 = 3")
def prediction_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that give no prediction, by what is wrong with them."""
    problems = read_lines(spark, _prediction_lines(spark, sf_dir))[1]
    return problems.groupBy(F.when(F.col("message").contains("repeats the page_id"), "repeats").otherwise("lacks").alias("kind")).agg(F.count("*").alias("n"))


_GOOD = f"{_FAULTS}, m AS (SELECT page_id, doc_id FROM faults WHERE odd NOT IN (5, 7, 11)), p AS (SELECT page_id FROM page WHERE doc_id % 31 <> 3 OR doc_id % 17 = 2)"


@query(f"""WITH {SQL}, {_GOOD} SELECT 'manifest' AS part, count(*) AS n FROM faults WHERE odd IN (7, 11, 13) OR again UNION ALL SELECT 'predictions', (SELECT count(*) FROM page WHERE doc_id % 31 = 3) + (SELECT count(*) FROM page WHERE doc_id % 17 = 2 AND doc_id % 31 <> 3)
  UNION ALL SELECT 'ids', count(*) FROM page WHERE doc_id % 29 = 11 UNION ALL SELECT 'pages', count(*) FROM m WHERE doc_id % 29 <> 11 AND page_id NOT IN (FROM p) UNION ALL SELECT 'orphans', count(*) FROM p WHERE page_id NOT IN (SELECT page_id FROM m)""")
def integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many problems validation reports of each part, for a manifest, predictions and a list of all ids."""
    ids = corpus(spark, sf_dir).where("doc_id % 29 <> 5 AND doc_id % 29 <> 7").select("page_id")
    checked = validation.validate(spark, _manifest_file(spark, sf_dir), _prediction_lines(spark, sf_dir), ids=ids)
    names = F.create_map(*(F.lit(x) for k, v in {0: "manifest", 1: "predictions", 2: "ids", 4: "pages", 5: "orphans"}.items() for x in (k, v)))
    return checked.problems.groupBy(names[F.col("part")].alias("part")).agg(F.count("*").alias("n"))


@query(f"""WITH {SQL}, t AS (SELECT page_id, kind, CASE WHEN doc_id % 20 = 0 THEN t ELSE '[UNREADABLE]' END AS probe, doc_id % 23 = 1 AS bare FROM page JOIN d USING (doc_id))
  SELECT page_id, 'probe' AS fault FROM t WHERE kind = 'probe' AND trim(probe, E' \n\t\r') <> '[UNREADABLE]' UNION ALL SELECT page_id, 'blank' FROM t WHERE kind <> 'probe' AND bare""")
def reference_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose reference cannot be scored: legible probes, and blank ones of other kinds."""
    k = F.col("doc_id")
    texts = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    pages = corpus(spark, sf_dir).join(texts, "doc_id").withColumn("reference", F.when((F.col("kind") == "probe") & (k % 20 == 0), F.col("t")).when((F.col("kind") != "probe") & (k % 23 == 1), " \n ").otherwise(F.col("reference")))
    return validation.content_problems(pages).join(pages.select("page_id", "kind"), "page_id").select("page_id", F.when(F.col("kind") == "probe", "probe").otherwise("blank").alias("fault")).distinct()


@query(f"WITH {SQL} SELECT page_id, baseline AS text, CAST(strlen(baseline) AS BIGINT) AS bytes FROM page")
def prediction_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions written as one file a page, empty ones too, and read again; a file's last line end is not part of a text."""
    folder = _scratch(spark)
    ended = F.when(F.col("prediction") == "", "").otherwise(F.concat("prediction", F.lit("\n")))
    written = write_predictions(corpus(spark, sf_dir).select("page_id", ended.alias("text")), folder.removeprefix("file:"))
    written = written.select(F.regexp_replace("path", r"\.txt$", "").alias("page_id"), F.greatest(F.col("bytes") - 1, F.lit(0)).alias("bytes"))
    sizes = _scratch(spark)
    written.write.parquet(sizes)
    return read_folder(spark, folder)[0].join(spark.read.parquet(sizes).hint("merge"), "page_id")  # 10 MB of sizes are almost two million rows: not for the driver


@query(f"""WITH {SQL}, t AS (SELECT page_id, CASE WHEN doc_id % 23 = 0 THEN '!?. ' ELSE reference END AS r FROM page WHERE kind <> 'probe')
  SELECT page_id, 'skeleton' AS level FROM t WHERE {_skel('r')} = ''""")
def empties_at_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = corpus(spark, sf_dir).where("kind <> 'probe'").withColumn("reference", F.when(F.col("doc_id") % 23 == 0, "!?. ").otherwise(F.col("reference")))
    return validation.content_problems(pages).select("page_id", F.regexp_extract("message", r"level (\w+)$", 1).alias("level"))


@query("SELECT doc_id, length(text) AS chars, lower(sha256(text)) AS digest FROM documents")
def content_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and digests of stored contents, as transfers are checked by."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.length("text").cast("long").alias("chars"), F.sha2(F.col("text").cast("binary"), 256).alias("digest"))


@query(f"""WITH {SQL}, v AS (SELECT page_id, list_sort(list_concat(distortions, fonts)) AS a FROM page) SELECT page_id, array_to_string(a, ',') AS sorted FROM v""")
def sorted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays as a manifest keeps them: sorted, repeated values stay."""
    return corpus(spark, sf_dir).select("page_id", F.array_join(F.array_sort(F.concat("distortions", "fonts")), ",").alias("sorted"))


# ---- what documents are written with


@query("SELECT doc_id, regexp_replace(lang || '/' || coalesce(source, ''), '[^A-Za-z0-9_-]', '-', 'g')[1:40] || '-' || substr(sha256(lang || '/' || coalesce(source, '') || chr(0) || CAST(doc_id AS VARCHAR) || chr(0) || coalesce(text, '') || chr(0)), 1, 12) AS run_id FROM documents")
def run_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of runs, from a version and two digests."""
    name = F.udf(lambda *x: run_id(*x), "string", useArrow=True)
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", name(F.concat("lang", F.lit("/"), F.coalesce("source", F.lit(""))), F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))).alias("run_id"))


@query("""SELECT doc_id, '{"doc_id":' || CAST(doc_id AS VARCHAR) || ',"share":' || CAST(round(n_chars / 7.0, 6) AS VARCHAR) || ',"text":' || to_json(text)::VARCHAR || '}' AS line FROM (SELECT doc_id, CAST(n_chars AS DOUBLE) AS n_chars, coalesce(text, '') AS text FROM documents)""")
def canonical_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose bytes depend on their content alone: sorted keys, six places."""
    line = F.udf(lambda d, n, t: dumps_line({"text": t, "share": n / 7.0, "doc_id": d}), "string", useArrow=True)
    return table(spark, sf_dir, "documents").select("doc_id", line("doc_id", "n_chars", F.coalesce("text", F.lit(""))).alias("line"))


@query("""SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN '—' ELSE printf('%.4f', CAST(p_retailprice AS DOUBLE) / 977) END AS rate, CASE WHEN p_size % 5 = 0 THEN '—' ELSE printf('%.2f%%', 100 * (CAST(p_size AS DOUBLE) / 51)) END AS share,
  replace(replace(replace(replace(replace(p_name || '<&>"''', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS escaped FROM part""")
def report_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, shares and texts as reports print them."""
    part, price = table(spark, sf_dir, "part"), F.col("p_retailprice").cast("double")
    return part.select(
        "p_partkey", F.udf(lambda x: number(x), "string", useArrow=True)(F.when(F.col("p_size") % 7 != 0, price / 977)).alias("rate"), F.udf(lambda x: percent(x), "string", useArrow=True)(F.when(F.col("p_size") % 5 != 0, F.col("p_size").cast("double") / 51)).alias("share"),
        F.udf(lambda x: html.escape(x, quote=True), "string", useArrow=True)(F.concat("p_name", F.lit("<&>\"'"))).alias("escaped"),
    )


# ---- comparison


def _two(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rounded = lambda df: df.withColumn("metrics", F.when(F.col("metrics").isNotNull(), F.struct(F.struct(F.round("metrics.strict.cer", 6).alias("cer")).alias("strict"))))
    return rounded(_chars(spark, sf_dir, "baseline")), rounded(_chars(spark, sf_dir, "candidate"))


_DELTAS = f"""{BOTH}, j AS (SELECT b.page_id, b.split, b.outcome AS ob, c.outcome AS oc, b.has_metrics AS rated, round(CAST(b.char_edits AS DOUBLE) / b.ref_chars, 6) AS cb, round(CAST(c.char_edits AS DOUBLE) / c.ref_chars, 6) AS cc FROM s_baseline b JOIN s_candidate c USING (page_id)),
  deltas AS (SELECT page_id, split, CASE WHEN rated THEN cb ELSE 0.0 END AS baseline_cer, CASE WHEN rated THEN cc ELSE 0.0 END AS candidate_cer, CASE WHEN rated THEN cc - cb ELSE 0.0 END AS delta_cer,
    CASE WHEN ob <> oc THEN ob || ' -> ' || oc END AS outcome_changed FROM j WHERE rated OR ob <> oc)"""


@query(f"{_DELTAS} SELECT * FROM deltas")
def page_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contrast.page_deltas(*_two(spark, sf_dir))


@query(f"{_DELTAS} SELECT page_id, delta_cer FROM deltas WHERE delta_cer > 0")
def regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contrast.regressions(contrast.page_deltas(*_two(spark, sf_dir))).select("page_id", "delta_cer")


@query(f"{_DELTAS} SELECT page_id, delta_cer FROM deltas WHERE delta_cer < 0")
def improvements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contrast.improvements(contrast.page_deltas(*_two(spark, sf_dir))).select("page_id", "delta_cer")


@query(f"WITH {SQL}, b AS (SELECT page_id FROM page WHERE doc_id % 11 <> 0), c AS (SELECT page_id FROM page WHERE doc_id % 12 <> 0) SELECT page_id, 'baseline' AS side FROM b WHERE page_id NOT IN (FROM c) UNION ALL SELECT page_id, 'candidate' FROM c WHERE page_id NOT IN (FROM b)")
def page_set_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = corpus(spark, sf_dir)
    return contrast.page_set_difference(pages.where("doc_id % 11 <> 0"), pages.where("doc_id % 12 <> 0"))


def _totals_sql(p: str) -> str:
    return f"""t_{p} AS (SELECT split, CAST(sum(char_edits) FILTER (has_metrics) AS DOUBLE) / CAST(sum(ref_chars) FILTER (has_metrics) AS BIGINT) AS cer, CAST(count(*) FILTER (has_metrics AND char_edits = 0) AS DOUBLE) / nullif(count(*) FILTER (has_metrics), 0) AS exact_match_rate,
  CAST(count(*) FILTER (outcome = 'hallucination') AS DOUBLE) / nullif(count(*) FILTER (NOT has_metrics), 0) AS hallucination_rate, CAST(count(*) FILTER (outcome = 'false_refusal') AS DOUBLE) / nullif(count(*) FILTER (has_metrics), 0) AS false_refusal_rate FROM s_{p} GROUP BY split)"""


_CHANGES = f"""{BOTH}, {_totals_sql('baseline')}, {_totals_sql('candidate')},
  u_b AS (UNPIVOT t_baseline ON cer, exact_match_rate, hallucination_rate, false_refusal_rate INTO NAME metric VALUE baseline), u_c AS (UNPIVOT t_candidate ON cer, exact_match_rate, hallucination_rate, false_refusal_rate INTO NAME metric VALUE candidate),
  changes AS (SELECT split, metric, baseline, candidate, candidate - baseline AS delta FROM u_b JOIN u_c USING (split, metric))"""


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contrast.metric_changes(*(rollups.split_totals(_chars(spark, sf_dir, p), levels=_STRICT) for p in ("baseline", "candidate")))


@query(f"{_CHANGES} SELECT *, CASE WHEN delta = 0 THEN 'unchanged' WHEN (metric = 'exact_match_rate') = (delta > 0) THEN 'better' ELSE 'worse' END AS direction FROM changes")
def metric_directions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir).where("metric <> 'wer'")


@query(f"{_CHANGES} SELECT metric, max(delta) AS worst FROM changes WHERE metric LIKE '%l%rate' AND metric <> 'exact_match_rate' GROUP BY metric")
def worst_rate_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir).where(F.col("metric").isin("hallucination_rate", "false_refusal_rate")).groupBy("metric").agg(F.max("delta").alias("worst"))


@query()
def bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a comparison draws it, from Python's own generator."""
    return contrast.bootstrap(contrast.page_deltas(*_two(spark, sf_dir)))


@query()
def bootstrap_poisson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a comparison of large runs draws it."""
    return contrast.bootstrap_scalable(contrast.page_deltas(*_two(spark, sf_dir)))


@query(f"""{_CHANGES}, f AS (SELECT max(delta) FILTER (metric = 'cer' AND split = 'gold_scans') > 0 AS gold, max(delta) FILTER (metric = 'hallucination_rate') * 100 > 1.0 AS hallucination, max(delta) FILTER (metric = 'false_refusal_rate') * 100 > 1.0 AS refusal,
  (max(baseline) FILTER (metric = 'cer' AND split = 'synthetic_heldout') - max(candidate) FILTER (metric = 'cer' AND split = 'synthetic_heldout')) * 100 AS gain FROM changes)
  SELECT CASE WHEN gold OR hallucination OR refusal THEN 'REJECT' WHEN gain >= 0.5 THEN 'PROMOTE' ELSE 'INCONCLUSIVE' END AS verdict FROM f""")
def verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("strict_cer_micro", "hallucination_rate", "false_refusal_rate")
    sides = []
    for p in ("baseline", "candidate"):  # a row a split
        rows = rollups.split_totals(_strict(spark, sf_dir, p), levels=_STRICT).select("split", *keys).collect()
        sides.append({r["split"]: {"cer": r[keys[0]], keys[1]: r[keys[1]], keys[2]: r[keys[2]]} for r in rows})
    return spark.createDataFrame([(contrast.decide(*sides).verdict,)], "verdict string")


# ---- dataset preparation

_SHARDED = "'shard_' || lpad(CAST(doc_id % 7 AS VARCHAR), 3, '0') || CASE WHEN doc_id % 3 = 0 THEN '' ELSE '_aug' || CAST(doc_id % 3 AS VARCHAR) END"


def _sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    stem = F.concat(F.lit("shard_"), F.lpad((k % 7).cast("string"), 3, "0"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("_aug"), (k % 3).cast("string"))))
    return table(spark, sf_dir, "documents").withColumn("stem", stem)


@query(f"SELECT doc_id, {_SHARDED} AS stem, CAST(doc_id % 7 AS INTEGER) AS \"group\", CAST(doc_id % 3 AS INTEGER) AS aug FROM documents")
def parse_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sharded(spark, sf_dir).select("doc_id", "stem", shard_group(F.col("stem")).alias("group"), shard_aug(F.col("stem")).alias("aug"))


@query("SELECT CAST(doc_id % 7 AS INTEGER) AS \"group\", count(*) AS pages, bool_and(doc_id % 7 IN (2, 5)) AS held_out FROM documents GROUP BY 1")
def group_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hold-out by group: all augmented copies of a page fall on the same side."""
    rows = _sharded(spark, sf_dir).withColumn("group", shard_group(F.col("stem")))
    train, heldout = prepare.hold_out(rows, (2, 5))
    count = lambda df, held: df.groupBy("group").agg(F.count("*").alias("pages"), F.lit(held).alias("held_out"))
    return count(train, False).unionByName(count(heldout, True))


@query("""WITH o AS (SELECT lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM documents)
  SELECT lang, max(n_chars) FILTER (place = least(n - 1, CAST(floor(0.5 * n) AS BIGINT))) AS p50, max(n_chars) FILTER (place = least(n - 1, CAST(floor(0.9 * n) AS BIGINT))) AS p90,
  max(n_chars) FILTER (place = least(n - 1, CAST(floor(0.99 * n) AS BIGINT))) AS p99, max(n_chars) AS max, round(CAST(sum(n_chars) AS DOUBLE) / count(*), 1) AS mean FROM o GROUP BY lang""")
def nearest_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.nearest_rank(table(spark, sf_dir, "documents"), "n_chars", ["lang"])


_PROBLEM = "CASE doc_id % 5 WHEN 0 THEN 'json missing from shard' WHEN 1 THEN 'unexpected member: a' || CAST(doc_id AS VARCHAR) WHEN 2 THEN 'image does not decode: ValueError: x' ELSE 'markdown is empty' END"


@query(f"SELECT split_part({_PROBLEM}, ':', 1) AS reason, count(*) AS n FROM documents GROUP BY 1")
def drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 5
    said = F.when(k == 0, "json missing from shard").when(k == 1, F.concat(F.lit("unexpected member: a"), F.col("doc_id").cast("string"))).when(k == 2, "image does not decode: ValueError: x").otherwise("markdown is empty")
    return prepare.drop_reasons(table(spark, sf_dir, "documents").select(said.alias("problem")))


@query(r"""WITH a AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '[1]' WHEN 1 THEN '{"markdown": 3, "meta": 1}' WHEN 2 THEN '{"markdown": " "}' ELSE '{"markdown": "x", "meta": {}}' END AS j FROM documents)
  SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'annotation is not an object' WHEN 1 THEN 'markdown is missing or not a string|meta is not an object' WHEN 2 THEN 'markdown is empty' ELSE '' END AS problems FROM a""")
def annotation_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 4
    text = F.when(k == 0, "[1]").when(k == 1, '{"markdown": 3, "meta": 1}').when(k == 2, '{"markdown": " "}').otherwise('{"markdown": "x", "meta": {}}')
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(prepare.annotation_problems(text), "|").alias("problems"))


@query("""WITH s AS (SELECT p_partkey, CAST(200 + p_size * 40 AS DOUBLE) AS w, CAST(300 + (p_partkey % 97) * 31 AS DOUBLE) AS h FROM part),
  n AS (SELECT *, greatest(32, round_even(w / 32, 0) * 32) AS nw, greatest(32, round_even(h / 32, 0) * 32) AS nh, sqrt(w * h / (1280 * 1024.0)) AS beta FROM s)
  SELECT p_partkey, CAST(CASE WHEN nw * nh / 1024.0 > 1280 THEN greatest(32.0, floor(w / beta / 32) * 32) * greatest(32.0, floor(h / beta / 32) * 32) / 1024.0 ELSE nw * nh / 1024.0 END AS INTEGER) AS tokens FROM n""")
def image_token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", X.image_tokens(200 + F.col("p_size") * 40, 300 + (F.col("p_partkey") % 97) * 31, 1280).alias("tokens"))


@query(f"WITH {SQL}, o AS (SELECT page_id, row_number() OVER (ORDER BY page_id) - 1 AS place FROM page) SELECT page_id, CAST(place % 4 AS INTEGER) AS shard FROM o")
def stride_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth page in the order of ids."""
    return order.stride(corpus(spark, sf_dir).select("page_id"), 4)


@query("SELECT conv_id, turn, CASE WHEN starts_with(text, 'The ') THEN substr(text, 5) ELSE text END AS text FROM conversations")
def strip_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", X.strip_prefix(F.col("text"), "The ").alias("text"))


@query(f"""SELECT doc_id, to_json({{'messages': [{{'role': 'user', 'content': '{prepare.PROMPT}'}}, {{'role': 'assistant', 'content': lang || source}}], 'images': ['/data/images/' || CAST(doc_id AS VARCHAR) || '.png']}})::VARCHAR AS record FROM documents""")
def training_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("images/"), F.col("doc_id").cast("string"), F.lit(".png")).alias("image_path"), F.concat("lang", "source").alias("target"))
    return rows.select("doc_id", F.to_json(F.struct(*prepare.record_columns("/data"))).alias("record"))


@query("SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 24 PRECEDING AND CURRENT ROW), 6) AS trailing FROM events")
def moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-24, 0)
    return table(spark, sf_dir, "events").select("event_id", F.round(F.avg("value").over(w), 6).alias("trailing"))


@query(f"WITH {SQL} SELECT split, 'sha256:' || sha256(string_agg(page_id || chr(0) || baseline || chr(0), '' ORDER BY page_id)) AS digest FROM page GROUP BY split")
def predictions_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of each split's predictions."""
    return digests_by(corpus(spark, sf_dir).withColumnRenamed("prediction", "text"), "split")


@query()
def negatives_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling with replacement by a hash of seed and name."""
    rows = corpus(spark, sf_dir).select("page_id", F.concat(F.lit("images/"), "page_id").alias("image_path"))
    return prepare.negatives(spark, "unreadable_train", 100, rows, 42).drop("i")


@query()
def codepoint_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code points in which the worst pages differ from their references."""
    from quire.reports import codepoint_differences

    worst = rollups.worst_pages(_strict(spark, sf_dir), 10).select("page_id")
    rows = corpus(spark, sf_dir).join(F.broadcast(worst), "page_id").select("page_id", "reference", "prediction").orderBy("page_id").collect()
    return spark.createDataFrame([(r["page_id"], "\n".join(codepoint_differences(r["reference"], r["prediction"]))) for r in rows], "page_id string, differences string")
