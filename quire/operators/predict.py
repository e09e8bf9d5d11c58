"""Runs a model over pages that have no prediction yet. The model itself is the caller's function."""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.errors import IntegrityError, UsageError, first_problems
from quire.operators.order import stride
from quire.sources.files import listed, write_predictions
from quire.sources.manifest import read_manifest
from quire.sources.places import Place

#: What may differ between the settings of predictions that are put together.
FREE = ("image_ref",)


def check_settings(stored: Mapping | None, given: Mapping) -> None:
    """Predictions made under other settings must not be added to; the changed ones are named."""
    if stored is None:
        return
    keys = sorted(k for k in {*stored, *given} if k not in FREE and stored.get(k) != given.get(k))
    if keys:
        raise UsageError("stored predictions were made under other settings", [f"{k}: {stored.get(k)!r}, now {given.get(k)!r}" for k in keys])


def pages_to_predict(manifest: DataFrame, splits: Sequence[str] = (), done: DataFrame | None = None) -> DataFrame:
    """page_id, image_path of the pages of some splits that `done` lacks; every page needs an image."""
    pages = manifest.where(F.col("split").isin(*splits)) if splits else manifest
    lacking = pages.where("image_path IS NULL")
    if n := lacking.count():
        raise IntegrityError(f"{n} pages have no image_path", [r["page_id"] for r in lacking.orderBy("page_id").limit(50).collect()])
    pages = pages.select("page_id", "image_path")
    return pages if done is None else pages.join(done.select("page_id"), "page_id", "left_anti")


def existing_images(pages: DataFrame, images: DataFrame) -> DataFrame:
    """Pages whose image is in a listing (a column image_path)."""
    return pages.join(images.select("image_path").distinct(), "image_path", "left_semi")


def predict(pages: DataFrame, model: Callable[[list[str]], list[str]], batch: int = 16, prefix: str = "") -> DataFrame:
    """page_id, text. model gets image paths, 4 x batch at once, and gives as many texts; a prefix of these is taken off."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for i in range(0, len(rows), 4 * batch):
                part = rows.iloc[i : i + 4 * batch]
                texts = model(part["image_path"].tolist())
                if len(texts) != len(part):
                    raise ValueError(f"the model gave {len(texts)} texts for {len(part)} images")
                yield pd.DataFrame({"page_id": part["page_id"], "text": [t[len(prefix) :] if prefix and t.startswith(prefix) else t for t in texts]})

    return pages.select("page_id", "image_path").mapInPandas(run, "page_id string, text string")


#: The document that says under which settings a folder's predictions were made.
META = "predict_meta.json"


class Predicted(NamedTuple):
    pages: int
    done_before: int
    written: int
    seconds: float


def model_named(name: str) -> Callable[[list[str]], list[str]]:
    """A model by 'module:function'; executors load it when their first batch comes."""

    def run(paths: list[str]) -> list[str]:
        module, _, function = name.partition(":")
        return getattr(importlib.import_module(module), function)(paths)

    return run


def predict_run(
    spark: SparkSession, manifest: str, out: str, model: Callable[[list[str]], list[str]], settings: Mapping, root: str | None = None, splits: Sequence[str] = (),
    shards: int = 1, shard: int = 0, limit: int | None = None, batch: int = 16, prefix: str = "", tell: Callable[[str], None] = lambda _: None,
) -> Predicted:
    """Predictions for the pages of every `shards`-th place, as one file a page, for those that have none yet.

    Pages stand in the order of their ids; limit counts them after striding. Images must all be below root (by default the
    manifest's folder). Settings are stored beside the predictions, and other ones than those are refused.
    """
    if not 0 <= shard < shards:
        raise UsageError(f"shard {shard} is not below {shards}")
    began, place, root = time.time(), Place(spark, out), (root or manifest.rsplit("/", 1)[0]).rstrip("/")
    every, problems = read_manifest(spark, manifest)
    said, total = first_problems(problems)
    if said:
        raise IntegrityError("the manifest has problems; nothing was predicted", said, total)
    pages = pages_to_predict(every, splits)
    if shards > 1:
        pages = stride(pages, shards).where(F.col("shard") == shard).drop("shard")
    if limit is not None:
        pages = pages.orderBy("page_id").limit(limit)
    names = lambda folder, pattern: listed(spark, folder, pattern).select(F.substring_index(F.col("path"), "/", -1).alias("file"), F.regexp_replace("path", "^[a-z0-9]+:/+", "/").alias("at"))
    base = "/" + root.split(":", 1)[-1].lstrip("/") if ":" in root or root.startswith("/") else root
    images = names(root, "*").select(F.expr(f"substr(at, {len(base) + 2})").alias("image_path"))
    n = pages.count()
    if lacking := [r["page_id"] for r in pages.join(images, "image_path", "left_anti").orderBy("page_id").limit(5).collect()]:
        raise IntegrityError(f"images are missing below {root}", lacking)
    check_settings(json.loads(place.read(META)) if place.has(META) else None, settings)
    if shard == 0 and not place.has(META):
        place.write_json(META, dict(settings))
    done = None if place.is_empty() else names(out, "*.txt").select(F.regexp_replace("file", r"\.txt$", "").alias("page_id"))
    todo = pages if done is None else pages.join(done, "page_id", "left_anti")
    left = todo.count()
    tell(f"{n} pages in part {shard} of {shards}; {n - left} of them have a prediction")
    written = 0
    if left:
        located = todo.withColumn("image_path", F.concat(F.lit(root + "/"), "image_path"))
        tasks = max(1, min(left // (4 * batch) + 1, int(spark.conf.get("spark.sql.shuffle.partitions", "200"))))
        written = write_predictions(predict(located.repartition(tasks, "page_id"), model, batch, prefix), out).count()
    seconds = time.time() - began
    tell(f"wrote {written} of {left} in {seconds:.1f} s, {written / max(seconds, 1e-9):.2f} a second")
    return Predicted(n, n - left, written, seconds)
