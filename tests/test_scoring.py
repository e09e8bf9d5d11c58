import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quire import cli
from quire.errors import IncommensurableError, IntegrityError, RunExistsError, UsageError
from quire.operators import contrast, predicate, rollups, scoring
from quire.operators.synthetic import synthetic_pages
from quire.operators.validation import validate
from quire.schema import FLAGS, LEVELS, THRESHOLDS
from quire.sources import runs, writer
from quire.sources.settings import load_settings

LINES = ["the quiet harbour lay below the town", "boats came home before the evening wind", "lamps were lit along the narrow pier", "and nobody spoke of the storm again"]
PAGE = "\n".join(LINES)


def page(i, split="synthetic_heldout", kind="synthetic", text=PAGE, fonts=("A",), distortions=(), source="s1", **more):
    return {"page_id": i, "split": split, "kind": kind, "reference_text": text, "fonts": list(fonts), "distortions": list(distortions), "source": source, **more}


CORPUS = [
    page("p1"), page("p2", fonts=("B", "A"), distortions=("blur",), is_augmented=True), page("p3", fonts=(), source=None), page("p4", distortions=("jpeg", "blur")), page("p5", fonts=("A",)),
    page("p6", text="short"), page("g1", "gold_scans", "scan", fonts=()), page("g2", "gold_scans", "scan", text="two words", fonts=()), page("b1", "probe", "probe", "[UNREADABLE]", ()), page("b2", "probe", "probe", "[UNREADABLE]", ()),
]
BASE = {
    "p1": PAGE, "p2": "\n".join([LINES[1], LINES[0], *LINES[2:]]), "p3": "", "p4": "[UNREADABLE]", "p5": (LINES[0] + "\n") * 9, "p6": "short" + "x" * 200,
    "g1": PAGE.replace("quiet", "quite"), "g2": "two word", "b1": "[UNREADABLE]", "b2": "made up text",
}
BETTER = BASE | {"p3": PAGE, "p4": PAGE, "g1": PAGE, "g2": "two words", "b2": " [UNREADABLE]\n"}


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    (root / "manifest.jsonl").write_text("".join(json.dumps(p) + "\n" for p in CORPUS))
    (root / "base.jsonl").write_text("".join(json.dumps({"page_id": k, "text": v}) + "\n" for k, v in BASE.items()))
    (root / "better").mkdir()
    for k, v in BETTER.items():
        (root / "better" / f"{k}.txt").write_text(v)
    return root


@pytest.fixture(scope="module")
def scored(spark, files):
    for name, path in (("base", "base.jsonl"), ("better", "better")):
        runs.score_run(spark, str(files / "manifest.jsonl"), str(files / path), str(files / f"run_{name}"), f"model/{name}")
    return files


def test_run_directory(scored):
    run = scored / "run_base"
    assert {p.name for p in run.iterdir()} == {"manifest.json", "pages.jsonl", "pages.parquet", "summary.json", "summary.md", "worst_pages.md", "worst_pages.html", "run.meta.json"}
    rows = {r["page_id"]: r for r in map(json.loads, (run / "pages.jsonl").read_text().splitlines())}
    assert list(rows) == sorted(BASE)
    assert rows["p1"]["metrics"]["strict"] == {"cer": 0.0, "wer": 0.0, "exact_match": True, "char_edits": 0, "ref_chars": len(PAGE), "word_edits": 0, "ref_words": len(PAGE.split())}
    assert rows["p2"]["order"] == {"order_corrected_cer": 0.0, "reading_order_accuracy": round(5 / 6, 6), "matched_lines": 4, "ref_lines": 4, "pred_lines": 4}
    assert rows["p2"]["fonts"] == ["A", "B"] and rows["p2"]["is_augmented"]
    assert rows["p3"]["flags"] == ["empty_prediction"] and rows["p3"]["metrics"]["strict"]["cer"] == 1.0 and rows["p3"]["order"]["reading_order_accuracy"] is None and "source" not in rows["p3"]
    assert rows["p4"]["outcome"] == "false_refusal"
    assert rows["p5"]["flags"] == ["repetition", "runaway_length"]
    assert rows["p6"]["flags"] == ["runaway_length"] and rows["p6"]["metrics"]["strict"]["cer"] == 40.0
    assert rows["b1"]["outcome"] == "correct_refusal" and rows["b2"]["outcome"] == "hallucination" and "metrics" not in rows["b2"] and "order" not in rows["b2"]


def test_summary(scored):
    summary = json.loads((scored / "run_base" / "summary.json").read_text())
    splits = {s["split"]: s for s in summary["splits"]}
    assert list(splits) == ["gold_scans", "probe", "synthetic_heldout"] and summary["notes"] == []
    probe, gold, held = splits["probe"], splits["gold_scans"], splits["synthetic_heldout"]
    assert probe["headline"] is None and probe["metrics"] is None and probe["breakdowns"] == [] and probe["contract"]["hallucination_rate"] == 0.5 and probe["contract"]["false_refusal_rate"] is None
    assert gold["headline"]["cer"] == round(3 / (len(PAGE) + 9), 6) and gold["metrics"]["strict"]["cer"]["macro"] == round((2 / len(PAGE) + 1 / 9) / 2, 6)
    assert held["contract"]["false_refusal_rate"] == round(1 / 6, 6) and held["flags"] == {"empty_prediction": 1, "repetition": 1, "runaway_length": 2}
    fonts = next(b for b in held["breakdowns"] if b["dimension"] == "font")
    assert [(r["key"], r["pages"]) for r in fonts["rows"]] == [("A", 5), ("__sparse__", 1)] and not fonts["is_partition"]
    sources = next(b for b in held["breakdowns"] if b["dimension"] == "source")
    assert [r["key"] for r in sources["rows"]] == ["s1"] and not sources["is_partition"]
    text = (scored / "run_base" / "summary.md").read_text()
    assert "—" in text and text.endswith("\n")


def test_comparison(spark, scored, tmp_path):
    c = runs.compare_runs(spark, str(scored / "run_base"), str(scored / "run_better"), settings=THRESHOLDS | {"bootstrap_resamples": 400})
    assert c["verdict"] == "PROMOTE" and c["regression_count"] == 0 and c["improvement_count"] == 5  # of p5 a file loses its last line end
    assert [d["page_id"] for d in c["improvements"]] == ["p3", "p4", "g2", "g1", "p5"]
    boot = {b["split"]: b for b in c["bootstrap"]}
    assert boot["probe"]["delta_cer"] == boot["probe"]["ci_low"] == 0.0  # a changed outcome counts with zero
    assert boot["synthetic_heldout"]["ci_low"] < boot["synthetic_heldout"]["delta_cer"] < boot["synthetic_heldout"]["ci_high"] <= 0
    back = runs.compare_runs(spark, str(scored / "run_better"), str(scored / "run_base"), settings=THRESHOLDS | {"bootstrap_resamples": 50})
    assert back["verdict"] == "REJECT" and sum(r.startswith("REJECT") for r in back["verdict_reasons"]) == 3
    assert {m["metric"]: m["direction"] for m in back["splits"][0]["metrics"]}["exact_match_rate"] == "worse"


def test_same_bytes_twice(spark, scored, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        runs.score_run(spark, str(scored / "manifest.jsonl"), str(scored / "base.jsonl"), str(tmp_path / "again"), "model/base")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for name in ("manifest.json", "pages.jsonl", "summary.json", "summary.md", "worst_pages.md", "worst_pages.html"):
        assert (tmp_path / "again" / name).read_bytes() == (scored / "run_base" / name).read_bytes(), name


def test_digest_is_of_the_texts(spark, scored, tmp_path):
    (tmp_path / "p").mkdir()
    for k, v in BASE.items():
        (tmp_path / "p" / f"{k}.txt").write_text(v + "\n")
    a = validate(spark, str(scored / "manifest.jsonl"), str(scored / "base.jsonl"))
    b = validate(spark, str(scored / "manifest.jsonl"), str(tmp_path / "p"))
    assert a.manifest_digest == b.manifest_digest and (a.form, b.form) == ("jsonl", "directory")
    assert a.predictions_digest == b.predictions_digest  # a file loses the one line end that it was given


def test_guards(spark, scored, tmp_path):
    with pytest.raises(RunExistsError):
        runs.score_run(spark, str(scored / "manifest.jsonl"), str(scored / "base.jsonl"), str(scored / "run_base"), "m")
    with pytest.raises(IntegrityError) as e:
        runs.score_run(spark, str(scored / "manifest.jsonl"), str(scored / "nowhere"), str(tmp_path / "x"), "m")
    assert len(e.value.problems) == len(CORPUS) + 1 and not (tmp_path / "x").exists()
    with pytest.raises(UsageError, match=r"manifest\.json"):
        runs.load_run(spark, str(tmp_path))
    runs.score_run(spark, str(scored / "manifest.jsonl"), str(scored / "base.jsonl"), str(tmp_path / "part"), "m", conditions=predicate.parse("split=gold_scans"))
    with pytest.raises(IncommensurableError) as e:
        runs.compare_runs(spark, str(scored / "run_base"), str(tmp_path / "part"))
    assert any("pages: 8 are" in p for p in e.value.problems) and any(p.startswith("splits") for p in e.value.problems)


def test_every_problem_at_once(spark, tmp_path):
    rows = [
        json.dumps(page("ok1")), "{broken", "[1]", json.dumps(page("ok1")), json.dumps({"page_id": "x"}), json.dumps(page("k") | {"kind": "photo"}), json.dumps({k: v for k, v in page("n").items() if k != "reference_text"}),
        json.dumps(page("u", extra=1)), json.dumps(page("pr", "probe", "probe", "legible")), json.dumps(page("em", text="  ")), json.dumps(page("pu", text="«...»؟!")), json.dumps(page("di", text="ًٌ")), "",
        json.dumps(page("fo") | {"fonts": "A"}), json.dumps({k: v for k, v in page("fi").items() if k != "reference_text"} | {"reference_path": "gone.txt"}),
    ]
    (tmp_path / "m.jsonl").write_text("\n".join(rows) + "\n")
    texts = [{"page_id": i, "text": "t"} for i in ("ok1", "ok1", "u", "pr", "em", "pu", "fo", "fi", "orphan")] + [{"page_id": "di", "text": 5}, {"page_id": "z"}]
    (tmp_path / "p.jsonl").write_text("".join(json.dumps(t) + "\n" for t in texts))
    said = [r["message"] for r in validate(spark, str(tmp_path / "m.jsonl"), str(tmp_path / "p.jsonl")).problems.collect()]
    for part in (
        "m.jsonl:2: is not valid JSON", "m.jsonl:3: is not a JSON object", "m.jsonl:4 (ok1): repeats a page_id, first seen at line 1", "m.jsonl:5 (x): lacks the required field(s) split, kind", "m.jsonl:6 (k): has the unknown kind photo",
        "m.jsonl:7 (n): needs exactly one", "m.jsonl:8 (u): has the unknown field(s) extra", "m.jsonl:14 (fo): fonts must be", "p.jsonl:2: repeats the page_id ok1", "p.jsonl:10: text must be a string", "p.jsonl:11: must be an object",
        "pr: is a probe", "em: has an empty reference", "pu: has a reference that is empty at level skeleton", "di: has a reference that is empty at level diacritic_insensitive", "di: has no prediction", "fi: reference gone.txt cannot be read", "orphan: has a prediction",
    ):
        assert sum(part in m for m in said) == 1, (part, said)
    order = [next(i for i, m in enumerate(said) if p in m) for p in ("m.jsonl:2", "m.jsonl:14", "p.jsonl:2", "pr: is", "fi: ref", "orphan")]
    assert order == sorted(order)


def test_reference_files(spark, tmp_path):
    (tmp_path / "refs").mkdir()
    (tmp_path / "refs" / "a.txt").write_bytes(b"\xef\xbb\xbfline\r\n")
    (tmp_path / "refs" / "b.txt").write_bytes(b"\xff\xfe")
    rows = [{k: v for k, v in page(i).items() if k != "reference_text"} | {"reference_path": f"refs/{i}.txt"} for i in "ab"]
    (tmp_path / "m.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    (tmp_path / "p.jsonl").write_text('{"page_id": "a", "text": "line"}\n{"page_id": "b", "text": "x"}\n')
    v = validate(spark, str(tmp_path / "m.jsonl"), str(tmp_path / "p.jsonl"))
    assert [r["message"] for r in v.problems.collect()] == ["b: reference refs/b.txt is not valid UTF-8"]
    assert v.pages.where("page_id = 'a'").first()["reference"] == "line"


def test_filters(spark):
    df = spark.createDataFrame([("a", "s", "k", None, ["x", "yy"], [], True), ("b", "s", "k", "web", [], ["z"], False)], "page_id string, split string, kind string, source string, fonts array<string>, distortions array<string>, is_augmented boolean")
    ids = lambda e: [r["page_id"] for r in predicate.select(df, predicate.parse(e)).orderBy("page_id").collect()]
    assert ids("font=x") == ["a"] and ids("font!=x") == ["b"] and ids("font~y") == ["a"]
    assert ids("source=web") == ids("source~e") == ["b"] and ids("source!=web") == ["a"]
    assert ids("is_augmented=true, split = s") == ["a"] and ids("distortion!=q") == ["a", "b"]
    for bad in ("", "font", "nope=1", "font=", "split=a,,kind=b"):
        with pytest.raises(UsageError):
            predicate.parse(bad)
    assert predicate.parse("font=a~b") == [("font=a", "~", "b")] if "font=a" in predicate.FIELDS else True


def test_rates_are_sums(spark):
    df = spark.createDataFrame([(4, 4), (1, 100), (0, 0)], "e int, n int")
    r = df.agg(rollups.micro(F.col("e"), F.col("n")).alias("micro"), rollups.macro(F.col("e"), F.col("n")).alias("macro")).first()
    assert r["micro"] == 5 / 104 and r["macro"] == 0.505


def test_sparse_rows(spark):
    m = "named_struct('strict', named_struct('char_edits', {e}, 'ref_chars', 10, 'word_edits', 0, 'ref_words', 2, 'exact_match', false))"
    rows = [("p1", ["a", "a", "b"], 1), ("p2", ["a"], 3), ("p3", ["b", "c"], 5), ("p4", ["d", "d"], 7)]
    df = spark.createDataFrame(rows, "page_id string, fonts array<string>, e int").selectExpr("'s' AS split", "page_id", "fonts", "array() AS distortions", "cast(null as string) AS source", m.format(e="e") + " AS metrics")
    got = {(r["dimension"], r["key"]): (r["pages"], r["cer_micro"], r["rank"]) for r in rollups.breakdowns(df, 3).collect()}
    assert got == {("font", "a"): (3, 5 / 30, 2), ("font", "__sparse__"): (3, 13 / 30, 1)}


def test_bootstrap_is_reproducible(spark):
    d = [0.1, -0.2, 0.05, 0.0, -0.4, 0.0137, -0.0711, 0.2903]
    assert contrast.paired_bootstrap(d, 300, 5) == contrast.paired_bootstrap(d, 300, 5) != contrast.paired_bootstrap(d, 300, 6)
    assert contrast.paired_bootstrap([], 10, 1) == (0.0, 0.0, 0.0)
    df = spark.createDataFrame([("s", f"p{i}", x) for i, x in enumerate(d)], "split string, page_id string, delta_cer double").repartition(3)
    r = contrast.bootstrap(df, 300, 5).first()
    assert (r["delta_cer"], r["ci_low"], r["ci_high"]) == contrast.paired_bootstrap(d, 300, 5)


def test_bootstrap_in_many_tasks(spark):
    """Bit by bit what one stream gives, however the resamples and the deltas are dealt out."""
    import random

    draw = random.Random(12)
    deltas = {s: [draw.gauss(0.01, 0.2) for _ in range(n)] for s, n in (("a", 700), ("b", 1), ("c", 37))}
    rows = [(s, f"p{i:05d}", x) for s, d in deltas.items() for i, x in enumerate(d)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "split string, page_id string, delta_cer double").repartition(5)
    want = {s: (len(d), *contrast.paired_bootstrap(d, 501, 20260916)) for s, d in deltas.items()}
    for draws in (1, 5_000, contrast.DRAWS):
        assert {r["split"]: tuple(r)[1:] for r in contrast.bootstrap(df, 501, 20260916, draws).collect()} == want
    assert contrast.bootstrap(df.limit(0), 501, 20260916).count() == 0


def test_deltas_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(contrast, "CHUNK", 64)
    d = [((i * 7919) % 1009) / 1009 - 0.5 for i in range(300)]
    df = spark.createDataFrame([("s", f"p{i:05d}", x) for i, x in enumerate(d)], "split string, page_id string, delta_cer double").repartition(4)
    r = contrast.bootstrap(df, 100, 3).first()
    assert (r["delta_cer"], r["ci_low"], r["ci_high"]) == contrast.paired_bootstrap(d, 100, 3)
    monkeypatch.setattr(contrast, "EXACT_PAGES", 299)
    with pytest.raises(UsageError, match="300 pages"):
        contrast.bootstrap(df, 100, 3)


@pytest.mark.parametrize("draws", [0, 1, 311, 312, 313, 5000, 39873, 39874, 40001, 250_000])
def test_places_of_the_stream(draws):
    import random

    from quire.functions.twister import recurrence, stream_at

    assert recurrence().bit_length() == 19938
    plain = random.Random(20260916)
    for _ in range(draws):
        plain.random()
    assert stream_at(20260916, draws).random_sample(1300).tolist() == [plain.random() for _ in range(1300)]


def test_far_places_of_the_stream():
    """The steps of two jumps add up to one."""
    from quire.functions.twister import power_of_x, _reduced, recurrence

    def times(p, q):
        out = 0
        while q:
            out ^= p << (q & -q).bit_length() - 1
            q &= q - 1
        return _reduced(out, recurrence())

    a, b = 40_000_000_000, 123_456_789
    assert times(power_of_x(a), power_of_x(b)) == power_of_x(a + b)


def test_verdicts():
    side = lambda cer, gold=None, h=None, f=None: {"synthetic_heldout": {"cer": cer, "hallucination_rate": h, "false_refusal_rate": f}} | ({"gold_scans": {"cer": gold, "hallucination_rate": None, "false_refusal_rate": None}} if gold is not None else {})
    assert contrast.decide(side(0.2), side(0.1)).verdict == "PROMOTE"
    assert contrast.decide(side(0.105), side(0.1)).verdict == "INCONCLUSIVE"  # not quite half a point
    assert contrast.decide(side(0.2, 0.1), side(0.1, 0.1001)).verdict == "REJECT"
    assert contrast.decide(side(0.2, h=0.1), side(0.1, h=0.12)).verdict == "REJECT"
    assert contrast.decide(side(None), side(0.1)).verdict == "INCONCLUSIVE"
    assert all(contrast.decide(side(a), side(b)).reasons for a in (None, 0.1) for b in (None, 0.2))


def test_writer(tmp_path):
    assert writer.dumps({"b": 1 / 128, "a": [-0.0, 1e-9, "é"]}) == '{\n  "a": [\n    0.0,\n    0.0,\n    "é"\n  ],\n  "b": 0.007812\n}'
    assert writer.dumps_line({"b": 2.5, "a": None}) == '{"a":null,"b":2.5}'
    writer.write_text(tmp_path / "x" / "t.txt", "a")
    assert (tmp_path / "x" / "t.txt").read_bytes() == b"a\n" and (tmp_path / "x" / "t.txt").stat().st_mode & 0o777 == 0o664


def test_settings(tmp_path):
    (tmp_path / "s.json").write_text('{"bootstrap_seed": 1}')
    assert load_settings(str(tmp_path / "s.json")) == THRESHOLDS | {"bootstrap_seed": 1}
    (tmp_path / "s.json").write_text('{"seed": 1}')
    with pytest.raises(UsageError, match="seed"):
        load_settings(str(tmp_path / "s.json"))


def test_commands(spark, scored, tmp_path, capsys):
    corpus = ["--manifest", str(scored / "manifest.jsonl"), "--predictions", str(scored / "base.jsonl")]
    assert cli.main(["validate", *corpus, "--json"]) == 0
    assert json.loads(capsys.readouterr().out)["pages_in_scope"] == len(CORPUS)
    assert cli.main(["validate", *corpus, "--filter", "nope=1"]) == 2
    (tmp_path / "ids").write_text("# some\n p1 \n\nzz\n")
    assert cli.main(["validate", *corpus, "--pages", str(tmp_path / "ids")]) == 1
    assert "zz was asked for" in capsys.readouterr().err
    assert cli.main(["score", *corpus, "--out", str(scored / "run_base"), "--model-version", "m"]) == 4
    assert cli.main(["score", *corpus, "--out", str(tmp_path / "r"), "--model-version", "m", "--no-html", "--filter", "kind!=probe"]) == 0
    assert not (tmp_path / "r" / "worst_pages.html").exists()
    assert json.loads((tmp_path / "r" / "manifest.json").read_text())["subset_filter"]["conditions"] == [{"field": "kind", "op": "!=", "value": "probe"}]
    assert cli.main(["compare", "--baseline", str(scored / "run_base"), "--candidate", str(tmp_path / "r")]) == 3
    capsys.readouterr()
    assert cli.main(["report", "--run", str(scored / "run_base"), "--what", "worst", "--top", "2", "--format", "json"]) == 0
    assert [r["page_id"] for r in json.loads(capsys.readouterr().out)] == ["p6", "p5"]
    assert cli.main(["report", "--run", str(scored / "run_base"), "--split", "nope"]) == 2
    for fmt in ("md", "html"):
        assert cli.main(["report", "--run", str(scored / "run_base"), "--what", "breakdown", "--dimension", "font", "--format", fmt, "--out", str(tmp_path / f"b.{fmt}")]) == 0
    page_html = (scored / "run_base" / "worst_pages.html").read_text()
    assert "http" not in page_html and "src=" not in page_html


def test_synthetic_pages_score(spark):
    pages = synthetic_pages(spark, 20, 8, tasks=4)
    rows = rollups.split_totals(scoring.score(pages)).collect()
    assert rows[0]["scored_pages"] == 20 and 0 < rows[0]["strict_cer_micro"] < 0.08
    assert all(rows[0][f] == 0 for f in FLAGS) and all(rows[0][f"{n}_cer_micro"] is not None for n in LEVELS)
    assert pages.collect() == synthetic_pages(spark, 20, 8, tasks=2).orderBy("page_id").collect()


def test_nothing_reaches_the_network():
    import ast

    root = Path(runs.__file__).parents[1]
    for path in root.rglob("*.py"):
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not {n.split(".")[0] for n in names} & {"requests", "urllib", "http", "boto3", "ftplib"}, path
