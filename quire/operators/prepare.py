"""Training, validation and evaluation sets from tar shards, without leakage between them."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.errors import IntegrityError, UsageError
from quire.functions.text import image_tokens
from quire.operators.order import numbered
from quire.operators.unreadable import pixels
from quire.schema import MARKER
from quire.sources import shard_store
from quire.sources.files import write_files
from quire.sources.shards import list_shards, parse_shard, probe_image, read_shards, shard_aug, shard_group

PROMPT = "<image>Transcribe this page."
# Kinds of unreadable page, the source of pages whose annotation names no template, and the report's quantiles.
UNREADABLE = ("blank", "noise", "obliterated")
NO_TEMPLATE = "ocr_data"
#: Stored samples: what checked_samples gives.
SAMPLES = "shard string, seq long, key string, ext string, image binary, problems array<string>, width int, height int, target string, font string, template string, augmentation string"
QUANTILES = (("p50", 0.5), ("p90", 0.9), ("p99", 0.99))


@dataclass(frozen=True)
class Options:
    holdout_groups: tuple[int, ...] = (103,)
    pattern: str = "shard_*"
    val_size: int = 1000
    test_size: int = 4000
    probe_count: int = 200
    unreadable_fraction: float = 0.005
    image_max_tokens: int = 1280
    verify: str = "full"
    max_drop_fraction: float = 0.001
    seed: int = 42
    image_root: str = ""


def annotation_problems(text: Column) -> Column:
    """Everything wrong with an annotation, as an array of strings (empty: nothing)."""
    v = F.try_parse_json(text)
    kind = lambda path: F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")), F.lit("VOID"))
    is_object = lambda path: F.startswith(kind(path), F.lit("OBJECT"))
    target = F.try_variant_get(v, "$.markdown", "string")
    has_meta = F.coalesce(F.array_contains(F.json_object_keys(text), "meta"), F.lit(False)) & (kind("$.meta") != "VOID")
    found = F.array_compact(
        F.array(
            F.when(kind("$.markdown") != "STRING", "markdown is missing or not a string").when(F.trim(target) == "", "markdown is empty").when(F.trim(target) == MARKER, "markdown is the unreadable marker"),
            F.when(has_meta & ~is_object("$.meta"), "meta is not an object"),
        )
    )
    return F.when(v.isNull(), F.array(F.lit("annotation is not valid JSON"))).when(~is_object("$"), F.array(F.lit("annotation is not an object"))).otherwise(found)


def checked_samples(rows: DataFrame, verify: str = "full") -> DataFrame:
    """Rows of the shard source with problems (an array), width and height, and the annotation's fields; and with their state."""
    size = probe_image(verify == "full")(F.col("image"))
    rows = rows.withColumn("size", F.when(F.col("problem").isNull(), size))
    fault = F.when(F.col("size.fault").isNotNull(), F.concat(F.lit("image does not decode: "), F.col("size.fault")))
    problems = F.when(F.col("problem").isNotNull(), F.array("problem")).otherwise(F.array_compact(F.concat(annotation_problems(F.col("annotation")), F.array(fault))))
    v = F.try_parse_json("annotation")
    get = lambda path: F.try_variant_get(v, path, "string")
    return rows.select(
        "shard", "seq", "key", "ext", "image", problems.alias("problems"), F.col("size.width").alias("width"), F.col("size.height").alias("height"),
        get("$.markdown").alias("target"), get("$.meta.page_font").alias("font"), get("$.meta.template").alias("template"), get("$.meta.augmentation.name").alias("augmentation"), "state",
    )


def _image_path() -> Column:
    return F.concat(F.lit("images/"), "shard", F.lit("/"), "key", F.lit("."), "ext")


def usable_samples(checked: DataFrame) -> DataFrame:
    ids = F.concat_ws("__", "shard", "key")
    return checked.where("size(problems) = 0").select(ids.alias("page_id"), _image_path().alias("image_path"), "target", shard_group(F.col("shard")).alias("group"), shard_aug(F.col("shard")).alias("aug"), "width", "height", "font", "template", "augmentation")


def hold_out(rows: DataFrame, groups: Iterable[int]) -> tuple[DataFrame, DataFrame]:
    """(training, held out): a group, with all augmented copies of its pages, is on one side."""
    held = F.col("group").isin(*groups)
    return rows.where(~held), rows.where(held)


def drop_reasons(problems: DataFrame) -> DataFrame:
    """reason, n: what stands before the first colon of each message."""
    return problems.groupBy(F.substring_index("problem", ":", 1).alias("reason")).agg(F.count("*").alias("n")).orderBy("reason")


def shuffled(seed: object, *keys: str) -> Column:
    """An order that depends on the seed and the keys alone."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *keys), 256)


def nearest_rank(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """p50, p90, p99 (the value at place floor(q n), from 0), max and mean (one decimal) of a column."""
    by = by or []
    # counts of distinct values, so that no task orders all rows
    values = df.groupBy(*by, F.col(column).alias("v")).agg(F.count("*").alias("k"))
    upto = F.sum("k").over(Window.partitionBy(*by).orderBy("v"))
    total = F.sum("k").over(Window.partitionBy(*by))
    placed = values.withColumn("upto", upto).withColumn("total", total)
    at = lambda q: F.min(F.when(F.col("upto") > F.least(F.col("total") - 1, F.floor(F.lit(q) * F.col("total"))), F.col("v")))
    return placed.groupBy(*by).agg(*(at(q).alias(n) for n, q in QUANTILES), F.max("v").alias("max"), F.round(F.sum(F.col("v") * F.col("k")) / F.sum("k"), 1).alias("mean"))


def record_columns(root: str = "", prompt: str = PROMPT) -> list[Column]:
    """messages (user, assistant) and images for rows with image_path and target."""
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    path = F.concat(F.lit(root.rstrip("/") + "/" if root else ""), "image_path")
    return [F.array(turn("user", F.lit(prompt)), turn("assistant", F.col("target"))).alias("messages"), F.array(path).alias("images")]


def training_records(rows: DataFrame, root: str = "", prompt: str = PROMPT) -> DataFrame:
    return rows.select(*record_columns(root, prompt))


def manifest_rows(rows: DataFrame) -> DataFrame:
    one = lambda c: F.when(F.coalesce(c, F.lit("")) != "", F.array(c)).otherwise(F.array().cast("array<string>"))
    return rows.select(
        "page_id", F.lit("synthetic_heldout").alias("split"), F.lit("synthetic").alias("kind"), F.col("target").alias("reference_text"), "image_path",
        one(F.col("font")).alias("fonts"), one(F.col("augmentation")).alias("distortions"), F.coalesce(F.nullif("template", F.lit("")), F.lit(NO_TEMPLATE)).alias("source"), (F.col("aug") > 0).alias("is_augmented"),
    )


def negatives(spark: SparkSession, prefix: str, count: int, sources: DataFrame, seed: int) -> DataFrame:
    """count unreadable pages, each with a kind and a source page drawn with replacement: specifications, not pixels."""
    ranked = numbered(sources.select("page_id", "image_path"), "page_id", place="at").drop("page_id")
    n = max(1, sources.count())
    names = spark.range(count).select(F.concat(F.lit(f"{prefix}_"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("page_id"), F.col("id").alias("i"))
    draw = lambda what, k: F.pmod(F.xxhash64(F.lit(seed), F.lit(what), "page_id"), F.lit(k))
    kinds = F.array(*map(F.lit, UNREADABLE))
    picked = names.withColumn("at", draw("source", n)).withColumn("kind", F.get(kinds, draw("kind", len(UNREADABLE)).cast("int")))
    return picked.join(ranked, "at", "left").select("page_id", F.concat(F.lit("unreadable/"), "page_id", F.lit(".png")).alias("image_path"), F.lit(MARKER).alias("target"), "kind", F.col("image_path").alias("source_image"), "i")


def probe_rows(rows: DataFrame) -> DataFrame:
    none = F.array().cast("array<string>")
    name = F.concat(F.lit("probe_"), "kind", F.lit("_"), F.regexp_extract("page_id", "([^_]*)$", 1))
    return rows.select(name.alias("page_id"), F.lit("probe").alias("split"), F.lit("probe").alias("kind"), F.col("target").alias("reference_text"), "image_path", none.alias("fonts"), none.alias("distortions"), F.concat(F.lit("synthetic_"), "kind").alias("source"), F.lit(False).alias("is_augmented"))


def _write_lines(df: DataFrame, path: str, *order: Column | str) -> None:
    """One JSON object a line, in this order."""
    df.orderBy(*order).select(F.to_json(F.struct(*(c for c in df.columns if not c.startswith("__")))).alias("value")).write.mode("overwrite").text(path)


def _write_unreadable(samples: DataFrame, pages: Iterable[DataFrame], out: str, seed: int) -> None:
    """The images of unreadable pages; the samples that obliterated ones are made from are read for them alone."""
    every = reduce(DataFrame.unionByName, pages).select("page_id", "kind", "image_path", F.when(F.col("kind") == "obliterated", F.col("source_image")).alias("source_image"))
    images = samples.where("size(problems) = 0").select(_image_path().alias("source_image"), "image")
    made = every.join(images, "source_image", "left").select("image_path", pixels(seed)("kind", "page_id", "image").alias("png"))
    write_files(made, out, "image_path", "png").write.format("noop").mode("overwrite").save()


def prepare(spark: SparkSession, source: str, out: str, options: Options = Options(), tell: Callable[[str], None] = lambda _: None) -> dict:
    """Writes samples (Parquet, one file a shard), images, unreadable pages, train, val, eval/manifest and a report; returns the report.

    A shard is done when its samples and images are stored and marked, by the task that read it, and is then not read again
    unless its size changes. A shard that cannot be read costs only itself: the others are stored, then an error names all that failed, and the
    next run reads only those. Files that a broken run left are written over or never looked at, so a run that is started
    again ends as one that was never broken. tell gets a line for each shard as it is finished.

    Pages of held-out groups, with all their augmented copies, never meet training. Shuffles are orders by a hash.
    """
    shards = list_shards(spark, source, options.pattern)
    if not shards:
        raise UsageError(f"no shard {options.pattern} in {source}")
    groups, held = {parse_shard(s)[0] for s, _, _ in shards}, set(options.holdout_groups)
    if not held or not held < groups:
        raise UsageError(f"held-out groups {sorted(held)} must be some, and not all, of {len(groups)} groups")
    tell(f"{len(shards)} shards, {sum(n for _, _, n in shards) / 1e9:.1f} GB, {len(groups)} groups; holding out {sorted(held)}")
    ready = shard_store.done(spark, out, shards)
    todo = [s for s in shards if s[0] not in ready]
    rows = checked_samples(read_shards(spark, todo, ends=True), options.verify) if todo else spark.createDataFrame([], f"{SAMPLES}, state string")
    if failed := shard_store.store(rows, out, shards, todo, tell):
        raise IntegrityError(f"{len(failed)} of {len(shards)} shards could not be read; run again to read only these", [f"{s}: {m['failed']}" for s, m in sorted(failed.items())])
    every = shard_store.read_store(spark, out, shard_store.done(spark, out, shards), SAMPLES)
    bad = every.select("shard", "key", F.explode("problems").alias("problem"))
    good = usable_samples(every)
    n_bad, n_good = bad.count(), good.count()
    if n_bad / max(1, n_bad + n_good) > options.max_drop_fraction:
        raise IntegrityError(f"{n_bad} of {n_bad + n_good} samples are unusable, more than {options.max_drop_fraction:.4%}", [f"{r['reason']}: {r['n']}" for r in drop_reasons(bad).collect()])
    train, heldout = hold_out(good, held)
    n_train, n_held = train.count(), heldout.count()
    if n_held < options.val_size + options.test_size:
        raise IntegrityError(f"{n_held} held-out pages are fewer than {options.val_size} + {options.test_size}")
    ranked = numbered(heldout, shuffled(f"{options.seed}:heldout", "page_id"), "page_id", place="__at")
    val, test = ranked.where(F.col("__at") < options.val_size), ranked.where((F.col("__at") >= options.val_size) & (F.col("__at") < options.val_size + options.test_size))
    n_train_neg, n_val_neg = round(n_train * options.unreadable_fraction), round(options.val_size * options.unreadable_fraction)
    root, what = options.image_root or out, ["page_id", "image_path", "target"]
    extras = {n: negatives(spark, f"unreadable_{n}", k, pages, options.seed) for n, k, pages in (("train", n_train_neg, train), ("val", n_val_neg, heldout), ("probe", options.probe_count, heldout))}
    _write_unreadable(every, extras.values(), out, options.seed)
    for name, pages, extra in (("train", train, extras["train"]), ("val", val, extras["val"])):
        both = pages.select(what).unionByName(extra.select(what))
        records = both.select(shuffled(f"{options.seed}:{name}", "page_id").alias("__by"), F.col("page_id").alias("__id"), *record_columns(root))
        _write_lines(records, f"{out}/{name}", "__by", "__id")
    manifest = manifest_rows(test).unionByName(probe_rows(extras["probe"]))
    _write_lines(manifest, f"{out}/eval/manifest", "page_id")
    trained = train.unionByName(val.drop("__at"))
    tokens = image_tokens(F.col("width"), F.col("height"), options.image_max_tokens)
    figures = lambda c: {k: v for k, v in nearest_rank(trained.withColumn("x", c), "x").first().asDict().items()}
    counts = train.agg(F.count_if(F.col("aug") == 0).alias("a"), F.count_if(F.col("aug") > 0).alias("b")).first()
    report = {
        "shards": len(shards), "holdout_groups": sorted(held), "samples_ok": n_good, "samples_dropped": n_bad,
        "dropped_by_reason": {r["reason"]: r["n"] for r in drop_reasons(bad).collect()},
        "train_rows": n_train + n_train_neg, "train_unreadable": n_train_neg, "val_rows": options.val_size + n_val_neg, "val_unreadable": n_val_neg,
        "eval_manifest_rows": options.test_size + options.probe_count, "eval_probe_rows": options.probe_count, "heldout_pages_unused": n_held - options.val_size - options.test_size,
        "originals_in_train": counts["a"], "augmented_in_train": counts["b"], "target_chars": figures(F.length("target")), "image_tokens_estimate": figures(tokens),
        "pages_downscaled_by_image_budget": trained.where(image_tokens(F.col("width"), F.col("height"), 10**9) > options.image_max_tokens).count(),
        "dataset_fingerprint": _fingerprint(shards, options), "settings": asdict(options),
    }
    spark.createDataFrame([(json.dumps(report, ensure_ascii=False, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/report")
    return report


def _fingerprint(shards: list[tuple[str, str, int]], options: Options) -> str:
    h = hashlib.sha256("".join(f"{s}:{n}\n" for s, _, n in shards).encode())
    h.update(json.dumps({k: str(v) for k, v in sorted(asdict(options).items()) if k != "image_root"}).encode())
    return "sha256:" + h.hexdigest()
