import json

from quire.sources.lines import numbered, whole_files
from quire.sources.manifest import read_manifest
from quire.sources.predictions import predictions_digest, read_predictions


def test_lines_are_numbered_across_splits(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("".join(f"line {i} {'x' * (i % 50)}\n" for i in range(1, 3001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = numbered(spark, str(path))
        assert rows.rdd.getNumPartitions() > 3 or rows.count() == 3000
        assert all(r["value"].split()[1] == str(r["line"]) and r["good"] for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bad_bytes_are_told(spark, tmp_path):
    (tmp_path / "m.jsonl").write_bytes(b'{"page_id": "a", "split": "s", "kind": "scan", "reference_text": "x"}\n\xff\xfe{\n\n')
    pages, problems = read_manifest(spark, str(tmp_path / "m.jsonl"))
    assert [r["page_id"] for r in pages.collect()] == ["a"]
    assert [r["message"] for r in problems.collect()] == ["m.jsonl:2: is not valid UTF-8"]


def test_manifest_columns(spark, tmp_path):
    rows = [{"page_id": "b", "split": "s", "kind": "scan", "reference_text": "x", "fonts": ["z", "a", "a"], "is_augmented": True}, {"page_id": "c", "split": "s", "kind": "probe", "reference_path": "p.txt", "distortions": None, "source": "q", "image_path": "i.png"}]
    (tmp_path / "m.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    pages, problems = read_manifest(spark, str(tmp_path / "m.jsonl"))
    got = {r["page_id"]: r for r in pages.collect()}
    assert problems.isEmpty() and got["b"]["fonts"] == ["a", "a", "z"] and got["b"]["is_augmented"] and got["b"]["source"] is None
    assert got["c"]["distortions"] == [] and got["c"]["reference_path"] == "p.txt" and not got["c"]["is_augmented"] and got["c"]["image_path"] == "i.png"


def test_null_reference_is_a_problem(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"page_id": "b", "split": "s", "kind": "scan", "reference_text": null}\n')
    pages, problems = read_manifest(spark, str(tmp_path / "m.jsonl"))
    assert pages.isEmpty() and "null reference" in problems.first()["message"]


def test_prediction_forms(spark, tmp_path):
    for name, data in (("a.txt", b"\xef\xbb\xbfx\r\n"), ("b.txt", b"\xff"), ("c.md", b"no")):
        (tmp_path / name).write_bytes(data)
    texts, problems, form = read_predictions(spark, str(tmp_path))
    assert form == "directory" and [tuple(r) for r in texts.collect()] == [("a", "x")] and problems.count() == 1
    (tmp_path / "p.jsonl").write_text('{"page_id": "a", "text": "x"}\n')
    lines, problems, form = read_predictions(spark, str(tmp_path / "p.jsonl"))
    assert form == "jsonl" and problems.isEmpty() and predictions_digest(lines) == predictions_digest(texts)
    assert read_predictions(spark, str(tmp_path / "gone"))[1].count() == 1
    (tmp_path / "empty").mkdir()
    assert "no .txt" in read_predictions(spark, str(tmp_path / "empty"))[1].first()["message"]
    assert whole_files(spark, str(tmp_path), "*.md").first()["stem"] == "c"


def test_empty_files_are_texts(spark, tmp_path):
    """An empty prediction is a prediction, whatever Spark's file sources think of empty files."""
    for name, data in (("a.txt", b""), ("b.txt", b"x"), ("_c.txt", b""), ("d.md", b"")):
        (tmp_path / name).write_bytes(data)
    for path in (str(tmp_path), tmp_path.as_uri()):
        texts, problems, _ = read_predictions(spark, path)
        assert sorted(map(tuple, texts.collect())) == [("a", ""), ("b", "x")] and problems.isEmpty()
        paths = [r["path"] for r in whole_files(spark, path, "*.txt").orderBy("path").collect()]
        assert paths == [f"file:{tmp_path}/a.txt", f"file:{tmp_path}/b.txt"]
    (tmp_path / "b.txt").unlink()
    assert [tuple(r) for r in read_predictions(spark, str(tmp_path))[0].collect()] == [("a", "")]
