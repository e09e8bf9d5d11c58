"""Does a corpus fit a prediction set? Everything that is wrong, in one table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators.predicate import Condition, select
from quire.schema import LEVELS, MARKER
from quire.sources.lines import sha256_of_file
from quire.sources.manifest import read_manifest
from quire.sources.predictions import predictions_digest, read_predictions
from quire.sources.stores import binary_files


class Validated(NamedTuple):
    """pages: in scope, with reference and prediction; problems: seq, page_id, message, in the order of report."""

    pages: DataFrame
    problems: DataFrame
    manifest_digest: str
    predictions_digest: str
    form: str


def content_problems(pages: DataFrame) -> DataFrame:
    """page_id, message of references that cannot be scored: a probe's that is not the marker, others that are empty or become so."""
    ref = F.col("reference")
    level = {"strict": X.strict(ref), "diacritic_insensitive": X.diacritic_insensitive(ref), "skeleton": X.skeleton(ref)}
    said = F.when(F.col("kind") == "probe", F.array_compact(F.array(F.when(~X.is_marker(ref), F.lit(f"is a probe, so its reference must be {MARKER}"))))).otherwise(
        F.when(X.is_blank(ref), F.array(F.lit("has an empty reference"))).otherwise(F.array_compact(F.array(*(F.when(X.is_blank(level[n]), F.lit(f"has a reference that is empty at level {n}")) for n in LEVELS))))
    )
    return pages.where("reference IS NOT NULL").select("page_id", F.posexplode(said).alias("n", "what")).select("page_id", "n", F.concat("page_id", F.lit(": "), "what").alias("message"))


def missing_predictions(pages: DataFrame, predictions: DataFrame) -> DataFrame:
    return pages.join(predictions, "page_id", "left_anti")


def orphan_predictions(predictions: DataFrame, pages: DataFrame) -> DataFrame:
    return predictions.join(pages, "page_id", "left_anti")


def resolve(spark: SparkSession, pages: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """pages with reference (the inline text as it is, or the file under root), and problems of files that have none."""
    by_path = pages.where("reference_path IS NOT NULL")
    if by_path.isEmpty():
        return pages.withColumn("reference", F.col("reference_text")), spark.createDataFrame([], "page_id string, n int, message string")
    base = root.rstrip("/") + "/"
    # only the folders that hold references are listed
    folders = [base + r["d"] for r in by_path.select(F.regexp_extract("reference_path", "^(.*/)?", 0).alias("d")).distinct().collect()]
    files = binary_files(spark, folders)
    plain = spark.range(1).select(F.lit(base).alias("b")).first()["b"].split(":", 1)[-1].replace("//", "/") if ":" in base else base
    files = files.select(F.regexp_replace("path", "^[a-z0-9]+:/+", "/").alias("at"), X.file_text(F.col("content").cast("string")).alias("file_text"), F.is_valid_utf8(F.col("content").cast("string")).alias("good"))
    joined = pages.join(files, F.concat(F.lit(plain), F.col("reference_path")) == F.col("at"), "left")
    bad = F.col("reference_path").isNotNull() & ~F.coalesce(F.col("good"), F.lit(False))
    why = F.when(F.col("at").isNull(), "cannot be read").otherwise("is not valid UTF-8")
    problems = joined.where(bad).select("page_id", F.lit(0).alias("n"), F.concat("page_id", F.lit(": reference "), "reference_path", F.lit(" "), why).alias("message"))
    return joined.withColumn("reference", F.coalesce("reference_text", F.when(F.col("good"), F.col("file_text")))).drop("at", "file_text", "good"), problems


def validate(spark: SparkSession, manifest: str, predictions: str, root: str | None = None, ids: Sequence[str] | DataFrame | None = None, conditions: Sequence[Condition] = ()) -> Validated:
    """Reads both sides and reports in this order: manifest, predictions, ids asked for, scope, each page, orphans.

    ids: a sequence, or a table with page_id, whose problems come in the order of the ids.
    Predictions are orphans if no valid manifest line has their id, whatever the scope is.
    """
    every, manifest_problems = read_manifest(spark, manifest)
    texts, prediction_problems, form = read_predictions(spark, predictions)
    wanted = ids.select("page_id", F.lit(0).alias("n")) if isinstance(ids, DataFrame) else None if ids is None else spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "page_id string, n int")
    scope = select(every, conditions, wanted)
    scope, file_problems = resolve(spark, scope, root or manifest.rsplit("/", 1)[0])
    none = spark.createDataFrame([], "part int, line long, page_id string, n int, message string")
    part = lambda df, k, line="0", page="cast(null as string)", n="0": df.selectExpr(f"{k} AS part", f"cast({line} AS long) AS line", f"{page} AS page_id", f"cast({n} AS int) AS n", "message")
    found = [part(manifest_problems, 0, "line", n="n"), part(prediction_problems, 1, "line", n="n")]
    if wanted is not None:
        found.append(part(wanted.join(every, "page_id", "left_anti").withColumn("message", F.concat("page_id", F.lit(" was asked for and is not in the manifest"))), 2, "n", "page_id"))
    if (conditions or ids is not None) and not every.isEmpty() and scope.isEmpty():
        found.append(part(spark.createDataFrame([("the subset has no pages",)], "message string"), 3))
    if every.isEmpty() and manifest_problems.isEmpty():
        found.append(part(spark.createDataFrame([(f"{manifest} has no rows",)], "message string"), 0))
    in_order = lambda df, at: df.join(scope.select("page_id", F.col("line").alias("at")), "page_id").selectExpr("4 AS part", "at AS line", "page_id", f"n + {at} AS n", "message")
    found += [in_order(file_problems, 0), in_order(content_problems(scope), 10)]
    readable = scope.where("reference IS NOT NULL")
    found.append(in_order(missing_predictions(readable, texts).select("page_id", F.lit(0).alias("n"), F.concat("page_id", F.lit(": has no prediction")).alias("message")), 20))
    found.append(part(orphan_predictions(texts, every).withColumn("message", F.concat("page_id", F.lit(": has a prediction and is not in the manifest"))), 5, page="page_id"))
    for df in found:
        none = none.unionByName(df)
    problems = none.orderBy("part", "line", "page_id", "n").select("part", "page_id", "message")
    pages = scope.join(texts.withColumnRenamed("text", "prediction"), "page_id").drop("line", "reference_text", "reference_path")
    return Validated(pages, problems, sha256_of_file(spark, manifest), predictions_digest(texts), form)
