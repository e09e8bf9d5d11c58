"""Corpus manifests: one JSON object a line, checked against a closed set of fields. All problems are found at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.text import is_blank
from quire.schema import KINDS, MANIFEST, STRINGS
from quire.sources.lines import numbered, own_or_alone

FIELDS = tuple(f.name for f in MANIFEST.fields)
REQUIRED = ("page_id", "split", "kind")


def _strings(name: str) -> tuple[Column, Column]:
    """A sorted array of strings (duplicates stay), and whether the field is anything else."""
    v = F.try_variant_get("v", f"$.{name}", "variant")
    kind = F.coalesce(F.schema_of_variant(v), F.lit("VOID"))
    good = kind.isin("ARRAY<STRING>", "ARRAY<VOID>", "VOID")
    found = F.when(kind == "ARRAY<STRING>", F.array_sort(F.try_variant_get("v", f"$.{name}", "array<string>")))
    return F.coalesce(found, F.array().cast(STRINGS)), ~good


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(pages, problems): pages has the manifest's columns and line; problems has line and message.

    A line's structure is checked up to the first fault that leaves it without meaning: not UTF-8, not JSON, not an object,
    required fields missing, unknown kind, not exactly one reference, an id that an earlier good line has. Unknown fields
    and malformed arrays are reported, and the page stays. A reference_text of null is no reference.
    """
    name = path.rstrip("/").rsplit("/", 1)[-1]
    rows = numbered(spark, path).where(~F.col("good") | ~is_blank(F.col("value")))
    rows = rows.withColumn("v", F.when(F.col("good"), F.try_parse_json("value"))).withColumn("keys", F.when(F.col("good"), F.json_object_keys("value")))
    text = lambda f: F.try_variant_get("v", f"$.{f}", "string")
    rows = rows.select("line", "good", "v", "keys", *(text(f).alias(f) for f in FIELDS if f not in ("fonts", "distortions", "is_augmented")))
    falsy = lambda f: F.coalesce(F.col(f).isin("", "0", "false", "[]", "{}"), F.lit(True))
    missing = F.array_join(F.array_compact(F.array(*(F.when(falsy(f), f) for f in REQUIRED))), ", ")
    unknown = F.array_join(F.array_sort(F.array_except("keys", F.array(*map(F.lit, FIELDS)))), ", ")
    has = {f: F.array_contains("keys", f) for f in ("reference_text", "reference_path")}
    fonts, bad_fonts = _strings("fonts")
    distortions, bad_distortions = _strings("distortions")
    fatal = (
        F.when(~F.col("good"), "is not valid UTF-8")
        .when(F.col("v").isNull(), "is not valid JSON")
        .when(F.col("keys").isNull(), "is not a JSON object")
        .when(missing != "", F.concat(F.lit("lacks the required field(s) "), missing))
        .when(~F.col("kind").isin(*KINDS), F.concat(F.lit("has the unknown kind "), F.col("kind")))
        .when(has["reference_text"] == has["reference_path"], F.lit("needs exactly one of reference_text and reference_path"))
        .when(F.coalesce("reference_text", "reference_path").isNull(), "has a null reference")
    )
    rows = rows.withColumns({"unknown": unknown, "fatal": fatal, "fonts": fonts, "distortions": distortions, "bad": F.array_compact(F.array(F.when(bad_fonts, "fonts"), F.when(bad_distortions, "distortions"))), "is_augmented": F.coalesce(F.try_variant_get("v", "$.is_augmented", "boolean"), F.lit(False))})
    same = Window.partitionBy(*own_or_alone()).orderBy("line")
    rows = rows.withColumn("first", F.when(F.col("fatal").isNull(), F.first("line").over(same)))
    rows = rows.withColumn("fatal", F.when(F.col("first") < F.col("line"), F.concat(F.lit("repeats a page_id, first seen at line "), F.col("first"))).otherwise(F.col("fatal")))
    at = F.concat(F.lit(f"{name}:"), F.col("line"), F.coalesce(F.concat(F.lit(" ("), F.col("page_id"), F.lit(")")), F.lit("")), F.lit(": "))
    said = F.array_compact(
        F.array(
            F.when(F.col("unknown") != "", F.concat(at, F.lit("has the unknown field(s) "), F.col("unknown"))),
            F.when(F.col("fatal").isNotNull(), F.concat(at, F.col("fatal"))),
            *(F.when(F.col("fatal").isNull() & F.array_contains("bad", f), F.concat(at, F.lit(f"{f} must be an array of strings"))) for f in ("fonts", "distortions")),
        )
    )
    problems = rows.select("line", F.posexplode(said).alias("n", "message"))
    return rows.where("fatal IS NULL").select("line", *FIELDS), problems
