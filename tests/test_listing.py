"""Folders of any number of files: their names are listed by a task and never lie on the driver."""

import os

import pytest

from quire.plans import catalog
from quire.sources import stores
from quire.sources.lines import whole_files
from quire.sources.predictions import read_folder
from quire.sources.stores import binary_files, list_files

NAMES = ["a.txt", "b c.txt", "d%20e.txt", "é.txt", "f[1].txt", "g.md", "h.txt.gz", "_hidden.txt", "_k=v.txt", ".dot.txt", "x._COPYING_", "sub/i.txt", "sub/_no/j.txt", "sub/deep/l.txt", "_no/m.txt"]


@pytest.fixture
def folder(tmp_path):
    for name in NAMES:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(f"text of {name}".encode())
    os.symlink(tmp_path / "gone", tmp_path / "link.txt")
    return tmp_path


def below(df, folder):
    return sorted(r["path"].removeprefix(f"file:{folder}/") for r in df.collect())


@pytest.mark.parametrize("pattern", ["*", "*.txt", "[a-d]*", "{a,g}.*", "?.txt"])
@pytest.mark.parametrize("recursive", [False, True])
def test_the_files_that_spark_finds(spark, folder, pattern, recursive):
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    want = {tuple(r) for r in reader.load(str(folder)).select("path", "length", "content").collect()}
    assert {tuple(r) for r in binary_files(spark, str(folder), pattern, recursive).collect()} == want
    assert {(r["path"], r["length"]) for r in list_files(spark, folder.as_uri(), pattern, recursive).collect()} == {w[:2] for w in want}


def test_paths_may_be_files_and_patterns(spark, folder):
    (folder / "sub" / "empty.txt").touch()
    assert below(binary_files(spark, [f"{folder}/a.txt", f"{folder}/sub/"]), folder) == ["a.txt", "sub/empty.txt", "sub/i.txt"]
    assert below(binary_files(spark, f"{folder}/s*"), folder) == ["sub/empty.txt", "sub/i.txt"]
    with pytest.raises(Exception, match="nothing at"):
        list_files(spark, f"{folder}/none")


def test_a_listing_stays_as_it_was(spark, folder):
    before = list_files(spark, str(folder), "*.txt")
    (folder / "late.txt").write_text("late")
    assert "late.txt" not in below(before, folder) and "late.txt" in below(list_files(spark, str(folder), "*.txt"), folder)


def test_the_driver_holds_no_list(spark, tmp_path, monkeypatch):
    """Spark's own source keeps each file's status and place in a task on the driver."""
    for i in range(400):
        (tmp_path / f"p{i}.txt").write_text("" if i % 7 == 0 else f"text {i}\n")
    monkeypatch.setattr(stores, "NAMES", 30)
    files = whole_files(spark, str(tmp_path), "*.txt")
    assert files.inputFiles() == [] and files.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts, bad = read_folder(spark, str(tmp_path))
    assert {r["page_id"]: r["text"] for r in texts.collect()} == {f"p{i}": "" if i % 7 == 0 else f"text {i}" for i in range(400)} and bad.isEmpty()


def test_few_contents_are_held_at_once(spark, tmp_path, monkeypatch):
    for i in range(20):
        (tmp_path / f"{i}.bin").write_bytes(bytes([i]) * (300 if i % 5 else 0))
    monkeypatch.setattr(stores, "PIECE", 700)
    files = binary_files(spark, str(tmp_path))
    assert {(r["length"], bytes(r["content"])) for r in files.collect()} == {(n := 300 if i % 5 else 0, bytes([i]) * n) for i in range(20)} and files.count() == 20


def test_written_sizes_do_not_meet_on_the_driver(spark):
    found = catalog.prediction_files(spark, "/root/testdata/sf0.001")
    assert "SortMergeJoin [page_id" in found._jdf.queryExecution().sparkPlan().toString() and found.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
