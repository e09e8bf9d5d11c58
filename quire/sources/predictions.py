"""Prediction sets: a folder with a text file for each page, or one JSON object a line (a file, or a folder *.jsonl of parts)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.text import is_blank
from quire.sources.lines import digest_of, exists, numbered, own_or_alone, texts_of
from quire.sources.running import Sha256, goes_on
from quire.sources.stores import list_files
from quire.store import settle


def _problems(spark: SparkSession, *messages: str) -> DataFrame:
    return spark.createDataFrame([(0, i, m) for i, m in enumerate(messages)], "line long, n int, message string")


def read_folder(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    names = list_files(spark, path, "*.txt")
    if names.isEmpty():
        return spark.createDataFrame([], "page_id string, text string"), _problems(spark, f"no .txt file in {path}")
    files = texts_of(names)
    bad = files.where("NOT good").select(F.lit(0).cast("long").alias("line"), F.lit(0).alias("n"), F.concat("path", F.lit(" is not valid UTF-8")).alias("message"))
    return files.where("good").select(F.col("stem").alias("page_id"), "text"), bad


def read_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Texts are taken as they are. Of lines with one id the first good one counts, the others are problems."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    rows = numbered(spark, path).where(~F.col("good") | ~is_blank(F.col("value"))).withColumn("v", F.when(F.col("good"), F.try_parse_json("value"))).withColumn("keys", F.when(F.col("good"), F.json_object_keys("value")))
    kind = F.coalesce(F.schema_of_variant(F.try_variant_get("v", "$.text", "variant")), F.lit("VOID"))
    rows = rows.withColumn("page_id", F.try_variant_get("v", "$.page_id", "string")).withColumn("text", F.try_variant_get("v", "$.text", "string"))
    has = F.coalesce(F.array_contains("keys", "page_id") & F.array_contains("keys", "text"), F.lit(False))
    fatal = F.when(~F.col("good"), "is not valid UTF-8").when(F.col("v").isNull(), "is not valid JSON").when(~has, "must be an object with page_id and text").when(kind != "STRING", "text must be a string")
    rows = rows.withColumn("fatal", fatal)
    rank = F.row_number().over(Window.partitionBy(*own_or_alone()).orderBy("line"))
    rows = rows.withColumn("fatal", F.when(F.col("fatal").isNull() & (rank > 1), F.concat(F.lit("repeats the page_id "), F.col("page_id"))).otherwise(F.col("fatal")))
    problems = rows.where("fatal IS NOT NULL").select("line", F.lit(0).alias("n"), F.concat(F.lit(f"{name}:"), F.col("line"), F.lit(": "), F.col("fatal")).alias("message"))
    if rows.isEmpty():
        problems = _problems(spark, f"{path} has no rows")
    return rows.where("fatal IS NULL").select("page_id", "text"), problems


def read_predictions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, str]:
    """(page_id and text, problems, form): form is 'directory' or 'jsonl', by what the path is; a folder *.jsonl holds the parts of one file."""
    kind = exists(spark, path)
    if kind is None:
        return spark.createDataFrame([], "page_id string, text string"), _problems(spark, f"no predictions at {path}"), ""
    return (*read_folder(spark, path), "directory") if kind == "directory" and not path.rstrip("/").endswith(".jsonl") else (*read_lines(spark, path), "jsonl")


def predictions_digest(predictions: DataFrame) -> str:
    """The same for both forms: over ids and texts in the order of the ids, hashed on executors."""
    found = digests_by(predictions.withColumn("__all", F.lit(0)), "__all").first()
    return found["digest"] if found else digest_of([])


def digests_by(predictions: DataFrame, group: str) -> DataFrame:
    """group, digest: predictions_digest of each group's predictions.

    A hash over all texts in the order of their ids is one chain, but no task reads it whole: rows are dealt out by ranges of group and id and
    stored; a task hashes its range from the state that the range before it left (112 bytes a group), one job a range.
    """
    spark, kind = predictions.sparkSession, predictions.schema[group].dataType.simpleString()
    rows = predictions.select(F.col(group).alias("group"), "page_id", "text")
    ordered = settle(rows.repartitionByRange(F.col("group"), F.col("page_id")).sortWithinPartitions("group", "page_id"))


    def hashed(rows: Iterator, group_: object, state: bytes | None) -> Iterator[tuple]:
        """(group, digest, state) of each group in a range; the first may go on from a state."""
        for g, own in groupby(rows, key=lambda r: r[0]):
            h = Sha256(state if state and g == group_ else None)
            for _, i, t in own:
                h.update(i.encode() + b"\0" + t.encode() + b"\0")
            yield g, "sha256:" + h.hexdigest(), h.state()

    if not goes_on(spark):  # no library: each group in one task
        alone = lambda rows: ((g, digest_of((i, t) for _, i, t in own)) for g, own in groupby(rows, key=lambda r: r[0]))
        found = dict(ordered.repartition("group").sortWithinPartitions("group", "page_id").rdd.mapPartitions(alone).collect())
    else:
        found, last, ranges = {}, (None, None), ordered.rdd
        for k in range(ranges.getNumPartitions()):
            for g, digest, state in spark.sparkContext.runJob(ranges, lambda rows, x=last: hashed(rows, *x), [k]):
                found[g], last = digest, (g, state)
    return spark.createDataFrame(list(found.items()), f"group {kind}, digest string").withColumnRenamed("group", group)
