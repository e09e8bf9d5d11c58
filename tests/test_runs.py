"""Run directories by uri, prediction runs, and the choice of resampling."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quire import cli
from quire.errors import IntegrityError, UsageError
from quire.operators import contrast, predict
from quire.sources import runs
from quire.sources.places import Place

TEXT = "some words\non two lines"


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    (root / "images").mkdir()
    rows = []
    for i in range(20):
        (root / "images" / f"p{i:02d}.png").write_bytes(b"x")
        rows.append({"page_id": f"p{i:02d}", "split": "gold_scans" if i % 4 == 0 else "synthetic_heldout", "kind": "scan" if i % 4 == 0 else "synthetic", "reference_text": TEXT, "image_path": f"images/p{i:02d}.png"})
    (root / "manifest.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    return root


def model(paths):
    return [f"<think>{p.rsplit('/', 1)[-1]}" for p in paths]


def test_prediction_run(spark, corpus, tmp_path):
    out, settings, told = tmp_path / "preds", {"model": "m", "image_ref": "a"}, []
    run = lambda **more: predict.predict_run(spark, str(corpus / "manifest.jsonl"), str(out), model, more.pop("settings", settings), prefix="<think>", batch=2, tell=told.append, **more)
    assert run(shards=3, shard=0, limit=4)[:3] == (4, 0, 4)
    assert sorted(p.stem for p in out.glob("*.txt")) == ["p00", "p03", "p06", "p09"]
    assert (out / "p03.txt").read_text() == "p03.png" and json.loads((out / predict.META).read_text()) == settings
    (out / "p06.txt").unlink()
    assert run(shards=3, shard=0, limit=4)[:3] == (4, 3, 1)  # only what is missing
    assert run(settings=settings | {"image_ref": "b"}, splits=["gold_scans"])[:3] == (5, 1, 4)
    assert told[-2].startswith("5 pages in part 0 of 1; 1 of them") and told[-1].startswith("wrote 4 of 4")
    with pytest.raises(UsageError, match="settings"):
        run(settings=settings | {"model": "n"})
    with pytest.raises(UsageError, match="shard"):
        run(shards=2, shard=2)
    assert run()[:3] == (20, 8, 12) and run()[:3] == (20, 20, 0)


def test_prediction_run_guards(spark, corpus, tmp_path):
    (tmp_path / "m.jsonl").write_text(json.dumps({"page_id": "a", "split": "s", "kind": "scan", "reference_text": "x", "image_path": "images/none.png"}) + "\n")
    with pytest.raises(IntegrityError, match="images are missing") as e:
        predict.predict_run(spark, str(tmp_path / "m.jsonl"), str(tmp_path / "o"), model, {}, root=str(corpus))
    assert e.value.problems == ["a"] and not (tmp_path / "o").exists()
    (tmp_path / "n.jsonl").write_text(json.dumps({"page_id": "a", "split": "s", "kind": "scan", "reference_text": "x"}) + "\n")
    with pytest.raises(IntegrityError, match="image_path"):
        predict.predict_run(spark, str(tmp_path / "n.jsonl"), str(tmp_path / "o"), model, {}, root=str(corpus))


def test_predict_command(spark, corpus, tmp_path, capsys):
    args = ["predict", "--manifest", str(corpus / "manifest.jsonl"), "--out", str(tmp_path / "p"), "--model", "os.path:basename"]
    assert cli.main([*args, "--limit", "0"]) == 0
    assert json.loads((tmp_path / "p" / predict.META).read_text())["decoding"] == "greedy"
    assert cli.main([*args, "--limit", "0", "--dtype", "float16"]) != 0 and "dtype" in capsys.readouterr().err


def test_run_directory_by_uri(spark, corpus, tmp_path):
    (tmp_path / "p.jsonl").write_text("".join(json.dumps({"page_id": f"p{i:02d}", "text": TEXT if i % 3 else "other"}) + "\n" for i in range(20)))
    plain, by_uri = tmp_path / "a", tmp_path / "b"
    for out in (str(plain), by_uri.as_uri()):
        runs.score_run(spark, str(corpus / "manifest.jsonl"), str(tmp_path / "p.jsonl"), out, "m")
    for name in ("manifest.json", "pages.jsonl", "summary.json", "worst_pages.md"):
        assert (plain / name).read_bytes() == (by_uri / name).read_bytes()
    assert runs.load_run(spark, by_uri.as_uri()).pages.count() == 20
    assert not [p for p in by_uri.iterdir() if p.name.startswith((".", "_")) or p.name.endswith(".tmp")]
    assert Place(spark, by_uri.as_uri()).read("summary.json") == (by_uri / "summary.json").read_text()


def test_large_splits_are_resampled_by_weights(spark):
    draw = random.Random(1)
    rows = [(s, f"{s}{i}", draw.gauss(0.01, 0.1)) for s, n in (("a", 400), ("b", 30)) for i in range(n)]
    deltas = spark.createDataFrame(rows, "split string, page_id string, delta_cer double")
    exact = {r["split"]: r for r in contrast.resampled(deltas, 2000, 7)}
    mixed = {r["split"]: r for r in contrast.resampled(deltas.repartition(5), 2000, 7, exact_pages=100)}
    assert [exact[s]["method"] for s in "ab"] == ["exact", "exact"] and [mixed[s]["method"] for s in "ab"] == ["poisson", "exact"]
    assert mixed["b"] == exact["b"] and mixed["a"]["n"] == 400 and mixed["a"]["delta_cer"] == pytest.approx(exact["a"]["delta_cer"])
    spread = exact["a"]["ci_high"] - exact["a"]["ci_low"]
    assert all(abs(mixed["a"][k] - exact["a"][k]) < 0.15 * spread for k in ("ci_low", "ci_high"))
    again = contrast.bootstrap_scalable(deltas.where(F.col("split") == "a").repartition(3), 2000, 7).first()
    assert again["ci_low"] == pytest.approx(mixed["a"]["ci_low"], abs=1e-12)


def test_transfer(spark, tmp_path):
    from quire.sources import files

    for name, data in (("a/x.bin", b"x" * 100), ("a/b/y.bin", b"yy"), ("z.bin", b""), ("q.partial", b"no")):
        (tmp_path / "from" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "from" / name).write_bytes(data)
    known = files.audit(spark, str(tmp_path / "from")).select(F.substring_index("path", "/from/", -1).alias("name"), "sha256")
    bring = lambda **more: {r["name"]: (r["bytes"], r["copied"]) for r in files.transfer(spark, str(tmp_path / "from"), (tmp_path / "to").as_uri(), **more).collect()}
    assert bring(expected=known) == {"a/x.bin": (100, True), "a/b/y.bin": (2, True), "z.bin": (0, True)}
    assert {str(p.relative_to(tmp_path / "to")) for p in (tmp_path / "to").rglob("*") if p.is_file()} == {"a/x.bin", "a/b/y.bin", "z.bin"}
    (tmp_path / "to" / "a" / "x.bin").write_bytes(b"w" * 100)  # the same size, other bytes
    assert bring() == {"a/x.bin": (100, False), "a/b/y.bin": (2, False), "z.bin": (0, False)}
    assert bring(expected=known)["a/x.bin"] == (100, True) and (tmp_path / "to" / "a" / "x.bin").read_bytes() == b"x" * 100
    with pytest.raises(Exception, match="were expected"):
        bring(expected=known.withColumn("sha256", F.lit("0" * 64)))
    assert not list((tmp_path / "to").rglob("*.partial")) and (tmp_path / "to" / "a" / "x.bin").read_bytes() == b"x" * 100
