"""Files in parts: no task and no driver holds a whole one."""

import hashlib

from pyspark.sql import functions as F

from quire.operators.validation import validate
from quire.plans import catalog
from quire.sources import lines, predictions
from quire.sources.lines import digest_of, sha256_of_file


SF = "/root/testdata/sf0.001"


def written(spark, path, texts, parts):
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(str(path)) if parts == 1 else spark.createDataFrame(list(enumerate(texts)), "n int, value string").repartitionByRange(parts, "n").sortWithinPartitions("n").select("value").write.text(str(path))
    return str(path)


def test_lines_of_parts_are_numbered_through(spark, tmp_path):
    texts = [f"line {i}" + "x" * (i % 50) for i in range(400)]
    path = written(spark, tmp_path / "m.jsonl", texts, 7)
    assert [(r["line"], r["value"]) for r in lines.numbered(spark, path).orderBy("line").collect()] == list(enumerate(texts, 1))


def test_digest_of_parts_by_stretches(spark, tmp_path, monkeypatch):
    texts = [f"line {i}" for i in range(300)]
    path = written(spark, tmp_path / "m.jsonl", texts, 4)
    monkeypatch.setattr(lines, "STRETCH", 100)
    want = "sha256:" + hashlib.sha256("".join(f"{t}\n" for t in texts).encode()).hexdigest()
    assert sha256_of_file(spark, path) == want
    (tmp_path / "one").write_text("".join(f"{t}\n" for t in texts))
    assert sha256_of_file(spark, str(tmp_path / "one")) == want


def test_digests_go_on_from_range_to_range(spark):
    rows = [(f"p{i:04}", f"text {i}" * (i % 9), ("a", "b", None)[i % 11 % 3]) for i in range(500)]
    table = spark.createDataFrame(rows, "page_id string, text string, split string").repartition(5)
    want = {s: digest_of((i, t) for i, t, x in rows if x == s) for s in ("a", "b", None)}
    assert {r["split"]: r["digest"] for r in predictions.digests_by(table, "split").collect()} == want
    assert predictions.predictions_digest(table) == digest_of((i, t) for i, t, _ in rows)
    assert predictions.predictions_digest(table.limit(0)) == digest_of([])


def test_manifests_and_predictions_are_written_in_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for made in (catalog._manifest_file(spark, SF), catalog._prediction_lines(spark, SF)):
            assert spark.read.text(made).select(F.input_file_name()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ids_as_a_table(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"page_id":"a","split":"s","kind":"synthetic","reference_text":"x"}\n')
    (tmp_path / "p.jsonl").write_text('{"page_id":"a","text":"x"}\n')
    ids = ["a", "b", "c"]
    of = lambda given: [r["message"] for r in validate(spark, str(tmp_path / "m.jsonl"), str(tmp_path / "p.jsonl"), ids=given).problems.collect()]
    assert of(spark.createDataFrame([(i,) for i in ids], "page_id string")) == of(ids) and len(of(ids)) == 2
