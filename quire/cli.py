"""python -m quire.cli validate | score | compare | report | prepare | predict"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession

from quire import __version__, reports
from quire.errors import IntegrityError, QuireError, first_problems
from quire.operators import predicate, predict, prepare
from quire.operators.validation import validate
from quire.schema import PRIMARY_SPLIT
from quire.sources import runs, writer
from quire.sources.settings import load_settings


def session() -> SparkSession:
    """The running session, or one with adaptive execution; masters and sizes are for spark-submit to say."""
    return SparkSession.builder.appName("quire").config("spark.sql.adaptive.enabled", "true").config("spark.ui.showConsoleProgress", "false").getOrCreate()


def _corpus(p: argparse.ArgumentParser) -> None:
    p.add_argument("--manifest", required=True)
    p.add_argument("--predictions", required=True)
    p.add_argument("--corpus-root")
    p.add_argument("--pages", help="file with one page id a line")
    p.add_argument("--filter", help="conditions such as split=a,font!=b,source~c")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quire", description=__doc__)
    p.add_argument("--version", action="version", version=__version__)
    sub = p.add_subparsers(dest="command", required=True)
    v = sub.add_parser("validate", help="report everything in which a corpus and predictions do not fit")
    _corpus(v)
    v.add_argument("--json", action="store_true")
    s = sub.add_parser("score", help="score predictions into a run directory")
    _corpus(s)
    s.add_argument("--out", required=True)
    s.add_argument("--model-version", required=True)
    s.add_argument("--run-id")
    s.add_argument("--config")
    s.add_argument("--worst", type=int, default=20)
    s.add_argument("--no-html", action="store_true")
    s.add_argument("--force", action="store_true")
    c = sub.add_parser("compare", help="decide between two runs")
    c.add_argument("--baseline", required=True)
    c.add_argument("--candidate", required=True)
    c.add_argument("--config")
    c.add_argument("--out")
    c.add_argument("--primary-split", default=PRIMARY_SPLIT)
    c.add_argument("--top", type=int, default=25)
    c.add_argument("--format", choices=("md", "json"), default="md")
    r = sub.add_parser("report", help="cut a stored run anew")
    r.add_argument("--run", required=True)
    r.add_argument("--what", choices=("summary", "worst", "breakdown"), default="summary")
    r.add_argument("--split")
    r.add_argument("--dimension", choices=("font", "distortion", "source"))
    r.add_argument("--top", type=int, default=20)
    r.add_argument("--format", choices=("md", "json", "html"), default="md")
    r.add_argument("--out")
    d = sub.add_parser("prepare", help="training and evaluation sets from tar shards")
    d.add_argument("--source", required=True)
    d.add_argument("--out", required=True)
    for name, kind in (("val-size", int), ("test-size", int), ("probe-count", int), ("unreadable-fraction", float), ("image-max-tokens", int), ("max-drop-fraction", float), ("seed", int)):
        d.add_argument(f"--{name}", type=kind, default=getattr(prepare.Options, name.replace("-", "_")))
    d.add_argument("--holdout-groups", default="103")
    d.add_argument("--shards", default="shard_*")
    d.add_argument("--image-root", default="")
    d.add_argument("--verify", choices=("full", "header"), default="full")
    m = sub.add_parser("predict", help="run a model over the pages that have no prediction yet")
    m.add_argument("--manifest", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--model", required=True, help="module:function, which gets image paths and gives as many texts")
    m.add_argument("--corpus-root")
    m.add_argument("--split", action="append", default=[])
    m.add_argument("--num-shards", type=int, default=1)
    m.add_argument("--shard-index", type=int, default=0)
    m.add_argument("--limit", type=int)
    m.add_argument("--batch-size", type=int, default=16)
    m.add_argument("--max-new-tokens", type=int, default=4096)
    m.add_argument("--image-max-tokens", type=int, default=prepare.Options.image_max_tokens)
    m.add_argument("--dtype", default="bfloat16")
    m.add_argument("--prefix", default="", help="taken off a text that begins with it")
    return p


def _tell(text: str) -> None:
    print(text, file=sys.stderr, flush=True)


def _scope(spark: SparkSession, a: argparse.Namespace) -> dict:
    ids = [r["page_id"] for r in predicate.read_ids(spark, a.pages).collect()] if a.pages else None
    return {"ids": ids, "conditions": predicate.parse(a.filter) if a.filter is not None else ()}


def _validate(spark: SparkSession, a: argparse.Namespace) -> None:
    checked = validate(spark, a.manifest, a.predictions, a.corpus_root, **_scope(spark, a))
    pages = checked.pages.count()
    problems, total = first_problems(checked.problems)
    if a.json:
        problems = [r["message"] for r in checked.problems.toLocalIterator()]  # the document lists them all
        print(writer.dumps({"ok": not problems, "pages_in_scope": pages, "problems": problems, "corpus_manifest_digest": checked.manifest_digest, "predictions_digest": checked.predictions_digest}))
    if problems:
        raise IntegrityError(f"{total} problem(s)", problems, total)
    print(f"{pages} pages, no problem", file=sys.stderr)


def _score(spark: SparkSession, a: argparse.Namespace) -> None:
    done = runs.score_run(spark, a.manifest, a.predictions, a.out, a.model_version, a.corpus_root, **_scope(spark, a), settings=load_settings(a.config), force=a.force, worst=a.worst, html=not a.no_html, settings_source=Path(a.config).name if a.config else "built-in", name=a.run_id)
    for s in done.summary["splits"]:
        h = s["headline"]
        print(f"{s['split']}: " + (f"CER {reports.number(h['cer'])}, WER {reports.number(h['wer'])}, exact {reports.percent(h['exact_match_rate'])}" if h else "nothing to score") + f", {s['pages']} pages", file=sys.stderr)


def _compare(spark: SparkSession, a: argparse.Namespace) -> None:
    c = runs.compare_runs(spark, a.baseline, a.candidate, a.primary_split, load_settings(a.config), a.top)
    text = reports.comparison_markdown(writer.canonical(c))
    if not a.out:
        print(text if a.format == "md" else writer.dumps(c))
    elif Path(a.out).suffix:
        writer.write_text(a.out, text if a.format == "md" else writer.dumps(c))
    else:
        writer.write_json(Path(a.out) / "comparison.json", c)
        writer.write_text(Path(a.out) / "comparison.md", text)
    print(f"{c['verdict']}: {c['regression_count']} worse, {c['improvement_count']} better", file=sys.stderr)


def _report(spark: SparkSession, a: argparse.Namespace) -> None:
    run = runs.load_run(spark, a.run)
    if a.what == "worst":
        data: object = runs.recut(spark, a.run, a.top, a.split)
        text = reports.recut_markdown(data)
    else:
        names = [s["split"] for s in run.summary["splits"]]
        if a.split is not None and a.split not in names:
            raise predicate.UsageError(f"no split {a.split}; there are {', '.join(names)}")
        chosen = [s for s in run.summary["splits"] if a.split in (None, s["split"])]
        if a.dimension:
            chosen = [s | {"breakdowns": [b for b in s["breakdowns"] if b["dimension"] == a.dimension]} for s in chosen]
        data = run.summary | {"splits": chosen}
        text = reports.summary_markdown(data)
        if a.what == "breakdown":
            data = [{"split": s["split"], "breakdowns": s["breakdowns"]} for s in chosen]
            text = "\n".join(line for s in chosen for line in [f"## {s['split']}", "", *(x for b in s["breakdowns"] if b["rows"] for x in reports._breakdown(b))])
    out = writer.dumps(data) if a.format == "json" else reports.as_html("Report", text) if a.format == "html" else text
    writer.write_text(a.out, out) if a.out else print(out)


def _prepare(spark: SparkSession, a: argparse.Namespace) -> None:
    given = {f: getattr(a, f) for f in ("val_size", "test_size", "probe_count", "unreadable_fraction", "image_max_tokens", "max_drop_fraction", "seed", "image_root", "verify")}
    held = tuple(int(g) for g in a.holdout_groups.split(",") if g.strip())
    print(writer.dumps(prepare.prepare(spark, a.source, a.out, prepare.Options(holdout_groups=held, pattern=a.shards, **given), _tell)))


def _predict(spark: SparkSession, a: argparse.Namespace) -> None:
    settings = {  # fixed values: the names in the document beside the predictions
        "model": a.model, "manifest": a.manifest, "prompt": prepare.PROMPT, "image_max_tokens": a.image_max_tokens, "max_new_tokens": a.max_new_tokens,
        "decoding": "greedy", "dtype": a.dtype, "removed_prefix": a.prefix, "image_ref": os.environ.get("IMAGE_REF", "unset"),
    }
    predict.predict_run(spark, a.manifest, a.out, predict.model_named(a.model), settings, a.corpus_root, a.split, a.num_shards, a.shard_index, a.limit, a.batch_size, a.prefix, _tell)


def main(argv: Sequence[str] | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        {"validate": _validate, "score": _score, "compare": _compare, "report": _report, "prepare": _prepare, "predict": _predict}[a.command](session(), a)
    except QuireError as e:
        print(e.render(), file=sys.stderr)
        return e.exit_code
    return 0


if __name__ == "__main__":
    sys.exit(main())
