"""Run directories: what a scored prediction set leaves behind, and how it is read again."""

from __future__ import annotations

import hashlib
import json
import os
import platform
import socket
import sys
import time
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import __version__, reports
from quire.errors import IntegrityError, RunExistsError, UsageError, first_problems
from quire.operators import contrast, rollups, scoring
from quire.operators.predicate import Condition, describe
from quire.operators.validation import Validated, validate
from quire.schema import ARABIC_BLOCKS, CONFIDENCE, DIACRITICS, DIMENSIONS, FLAGS, GOLD_SPLIT, LEVELS, MARKER, PAGE, POLICY_VERSION, PRIMARY_SPLIT, TATWEEL, THRESHOLDS
from quire.sources import writer
from quire.sources.places import Place

NO_GOLD = f"No split {GOLD_SPLIT} was scored: these figures say nothing about real scans."


def policy() -> dict:
    """The rules under which a run was scored, as it records them."""
    spans = lambda x: [f"U+{a:04X}-U+{b:04X}" for a, b in x]
    return {"policy_version": POLICY_VERSION, "unreadable_marker": MARKER, "levels": list(LEVELS), "diacritics": spans(DIACRITICS), "arabic_blocks": spans(ARABIC_BLOCKS), "tatweel": f"U+{TATWEEL:04X}"}


def run_id(model_version: str, manifest_digest: str, predictions_digest: str) -> str:
    """The same for the same content, whenever it is scored."""
    h = hashlib.sha256("".join(x + "\0" for x in (model_version, manifest_digest, predictions_digest)).encode())
    name = "".join(c if c.isalnum() or c in "-_" else "-" for c in model_version)[:40]
    return f"{name}-{h.hexdigest()[:12]}"


def _split(row: Mapping, breakdowns: Sequence[Mapping]) -> dict:
    scored = row["scored_pages"] > 0
    level = lambda n: {"cer": {"micro": row[f"{n}_cer_micro"], "macro": row[f"{n}_cer_macro"]}, "wer": {"micro": row[f"{n}_wer_micro"], "macro": row[f"{n}_wer_macro"]}, "exact_match_rate": row[f"{n}_exact_match_rate"]}
    return {
        "split": row["split"], "pages": row["pages"], "scored_pages": row["scored_pages"],
        "headline": {"level": "strict", "cer": row["strict_cer_micro"], "wer": row["strict_wer_micro"], "exact_match_rate": row["strict_exact_match_rate"]} if scored else None,
        "metrics": {n: level(n) for n in LEVELS} if scored else None,
        "order": {k: row[k] for k in ("order_corrected_cer_micro", "reading_order_accuracy", "pages_without_order_signal")},
        "contract": {k: row[k] for k in ("correct_refusal", "hallucination", "false_refusal", "probe_pages", "hallucination_rate", "false_refusal_rate")} | {"legible_pages": row["scored_pages"]},
        "flags": {f: row[f] for f in FLAGS}, "breakdowns": list(breakdowns) if scored else [],
    }


def summarise(scores: DataFrame, name: str, model_version: str, settings: Mapping) -> dict:
    """The summary document: one aggregation for splits, one for breakdowns; their rows are few."""
    totals = [r.asDict() for r in rollups.split_totals(scores).collect()]
    rows = rollups.breakdowns(scores, settings["min_pages_per_breakdown_row"]).orderBy("split", "dimension", "rank").collect()
    whole = {(r["split"], r["dimension"]): r["is_partition"] for r in rollups.partitions(scores).collect()}
    of = lambda s: [{"dimension": d, "is_partition": whole.get((s, d), True), "rows": [{k: r[k] for k in ("key", "pages", "cer_micro", "cer_macro", "wer_micro", "exact_match_rate")} for r in rows if (r["split"], r["dimension"]) == (s, d)]} for d in DIMENSIONS]
    notes = [] if any(r["split"] == GOLD_SPLIT for r in totals) else [NO_GOLD]
    return {"run_id": name, "model_version": model_version, "tool_version": __version__, "policy": policy(), "splits": [_split(r, of(r["split"])) for r in totals], "notes": notes}


def _page(row: Mapping) -> dict:
    """A page's line: null blocks are left out, other nulls stay."""
    return {k: v for k, v in row.items() if not (v is None and k in ("metrics", "order", "source"))}


def page_line(row: Mapping) -> str:
    return writer.dumps_line(_page(row))


def worst_rows(scores: DataFrame, pages: DataFrame, top: int) -> list[dict]:
    worst = rollups.worst_pages(scores, top).select("page_id", "split", F.col("metrics.strict.cer").alias("cer"), F.col("metrics.strict.wer").alias("wer"), "outcome", "flags")
    rows = F.broadcast(worst).join(pages.select("page_id", "reference", "prediction"), "page_id").collect()  # top rows
    return sorted((r.asDict() for r in rows), key=lambda r: (-r["cer"], r["page_id"]))


class Scored(NamedTuple):
    summary: dict
    scores: DataFrame


def write_run(spark: SparkSession, checked: Validated, out: str, model_version: str, settings: Mapping = THRESHOLDS, worst: int = 20, html: bool = True, scope: dict | None = None, settings_source: str = "built-in", name: str | None = None) -> Scored:
    """Scores what validate() passed and writes the run directory. Pages are also kept as Parquet, which totals are read from."""
    started, root = time.time(), Place(spark, out)
    ident = name or run_id(model_version, checked.manifest_digest, checked.predictions_digest)
    store = root.uri("pages.parquet")
    scoring.score(checked.pages, settings).write.mode("overwrite").parquet(store)
    scores = spark.read.parquet(store)
    summary = summarise(scores, ident, model_version, settings)
    columns = [f.name for f in PAGE.fields]
    root.write_lines("pages.jsonl", scores.select(columns).orderBy("page_id"), page_line)
    manifest = {
        "run_id": ident, "model_version": model_version, "corpus_manifest_digest": checked.manifest_digest, "predictions_digest": checked.predictions_digest, "predictions_form": checked.form,
        "pages_scored": sum(s["pages"] for s in summary["splits"]), "subset_filter": scope, "policy": policy(), "config": dict(settings), "config_source": settings_source, "tool_version": __version__, "distance_engine": "bit-parallel",
    }
    root.write_json("manifest.json", manifest)
    root.write_json("summary.json", summary)
    root.write("summary.md", reports.summary_markdown(writer.canonical(summary)))
    rows = worst_rows(scores, checked.pages, worst)
    root.write("worst_pages.md", reports.worst_markdown(rows))
    if html:
        root.write("worst_pages.html", reports.worst_html(rows))
    root.write_json("run.meta.json", {"completed_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), "elapsed_seconds": round(time.time() - started, 3), "host": socket.gethostname(), "platform": platform.platform(), "python": sys.version.split()[0], "cpu_count": os.cpu_count(), "spark": spark.version})
    return Scored(summary, scores)


def score_run(spark: SparkSession, manifest: str, predictions: str, out: str, model_version: str, root: str | None = None, ids: Sequence[str] | None = None, conditions: Sequence[Condition] = (), settings: Mapping = THRESHOLDS, force: bool = False, **options) -> Scored:
    """Collision, then validation (all problems), then scores: nothing is computed for a run that cannot be written."""
    if not Place(spark, out).is_empty() and not force:
        raise RunExistsError(f"{out} is not empty")
    checked = validate(spark, manifest, predictions, root, ids, conditions)
    problems, total = first_problems(checked.problems)
    if problems:
        raise IntegrityError("the corpus and the predictions do not fit together; nothing was scored", problems, total)
    return write_run(spark, checked, out, model_version, settings, scope=describe(conditions, ids), **options)


class Run(NamedTuple):
    path: str
    manifest: dict
    summary: dict
    pages: DataFrame

    def split(self, name: str) -> dict | None:
        return next((s for s in self.summary["splits"] if s["split"] == name), None)


def load_run(spark: SparkSession, path: str) -> Run:
    root = Place(spark, path)
    for name in ("manifest.json", "summary.json", "pages.jsonl"):
        if not root.has(name):
            raise UsageError(f"{path} has no {name}: it is not a run directory")
    return Run(path, json.loads(root.read("manifest.json")), json.loads(root.read("summary.json")), spark.read.schema(PAGE).json(root.uri("pages.jsonl")))


def _headlines(run: Run) -> dict[str, dict]:
    return {s["split"]: {"cer": s["headline"]["cer"] if s["headline"] else None, "hallucination_rate": s["contract"]["hallucination_rate"], "false_refusal_rate": s["contract"]["false_refusal_rate"]} for s in run.summary["splits"]}


def _changes(before: dict, after: dict) -> list[dict]:
    value = lambda s, m: (s["headline"] or {}).get(m) if m in ("cer", "wer", "exact_match_rate") else s["contract"][m]
    out = []
    for m in contrast.METRICS:
        a, b = value(before, m), value(after, m)
        if a is not None and b is not None:
            d = b - a
            out.append({"metric": m, "baseline": a, "candidate": b, "delta": d, "direction": "unchanged" if d == 0 else "better" if (d < 0) == contrast.LOWER_IS_BETTER[m] else "worse"})
    return out


def compare_runs(spark: SparkSession, baseline_path: str, candidate_path: str, primary: str = PRIMARY_SPLIT, settings: Mapping = THRESHOLDS, top: int = 25) -> dict:
    """The comparison document, with the first `top` pages of each list. Works on the stored, rounded figures."""
    before, after = load_run(spark, baseline_path), load_run(spark, candidate_path)
    facts = lambda r: {"policy_version": r.manifest["policy"]["policy_version"], "corpus_manifest_digest": r.manifest["corpus_manifest_digest"], "splits": [s["split"] for s in r.summary["splits"]]}
    contrast.assert_commensurable(facts(before), facts(after), before.pages, after.pages)
    deltas = contrast.page_deltas(before.pages, after.pages).cache()
    try:
        rows = lambda df: [r.asDict() for r in df.limit(top).collect()]
        shared = sorted(s["split"] for s in before.summary["splits"])
        resamples, seed = settings["bootstrap_resamples"], settings["bootstrap_seed"]
        boot = contrast.resampled(deltas, resamples, seed)
        worse, better = contrast.regressions(deltas), contrast.improvements(deltas)
        decision = contrast.decide(_headlines(before), _headlines(after), primary, settings)
        return {
            "baseline_run_id": before.manifest["run_id"], "candidate_run_id": after.manifest["run_id"], "baseline_model_version": before.manifest["model_version"], "candidate_model_version": after.manifest["model_version"],
            "policy_version": POLICY_VERSION, "tool_version": __version__, "primary_split": primary, "verdict": decision.verdict, "verdict_reasons": decision.reasons, "thresholds": decision.thresholds,
            "splits": [{"split": s, "pages": before.split(s)["pages"], "metrics": _changes(before.split(s), after.split(s))} for s in shared],
            "bootstrap": [{k: b[k] for k in ("split", "delta_cer", "ci_low", "ci_high")} | {"confidence": CONFIDENCE, "resamples": resamples, "seed": seed} | ({"method": b["method"]} if b["method"] != "exact" else {}) for b in boot],
            "regressions": rows(worse), "improvements": rows(better), "regression_count": worse.count(), "improvement_count": better.count(), "only_in_baseline": [], "only_in_candidate": [],
        }
    finally:
        deltas.unpersist()


def recut(spark: SparkSession, path: str, top: int = 20, split: str | None = None) -> list[dict]:
    """The worst pages of a stored run, ranked by its rounded rates; neither the corpus nor the predictions are read."""
    run = load_run(spark, path)
    names = [s["split"] for s in run.summary["splits"]]
    if split is not None and split not in names:
        raise UsageError(f"no split {split}; there are {', '.join(names)}")
    rows = rollups.worst_pages(run.pages, top, split).select("page_id", "split", F.col("metrics.strict.cer").alias("cer"), F.col("metrics.strict.wer").alias("wer"), "outcome", "flags")
    return [r.asDict() for r in rows.collect()]
