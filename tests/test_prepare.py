import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from quire.errors import IntegrityError, UsageError
from quire.functions import pixels
from quire.operators import predict, prepare, unreadable
from quire.operators.prepare import Options
from quire.sources import shards
from quire.streaming.shards import ingest_shards, trailing_counts

PNG = pixels.png(40, 30, bytes(range(40)) * 30)


def note(text="some text", **meta):
    return json.dumps({"markdown": text, "meta": {"page_font": "A", "template": "t", "augmentation": None, **meta}}).encode()


def write_tar(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with tarfile.open(path, "w") as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    root = tmp_path_factory.mktemp("shards")
    for g in (1, 2, 3):
        for aug in (0, 1):
            members = [(f"d/{k:03d}.{ext}", data) for k in range(12) for ext, data in (("png", PNG), ("json", note(f"page {g} {k}", augmentation={"name": "blur"} if aug else None)))]
            if (g, aug) == (1, 0):
                members[1] = ("d/000.json", note(""))
                members[4] = ("d/002.png", PNG[:-30])
                del members[11]
            write_tar(root / ("aug" if aug else "data") / f"shard_{g:03d}{'_aug1' if aug else ''}.tar", members)
    return root


OPTIONS = Options(holdout_groups=(3,), val_size=4, test_size=10, probe_count=5, unreadable_fraction=0.1, max_drop_fraction=0.2)


@pytest.fixture(scope="module")
def prepared(spark, source, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    return out, prepare.prepare(spark, str(source), str(out), OPTIONS)


def lines(path):
    return [json.loads(x) for p in sorted(path.glob("part-*")) for x in p.read_text().splitlines()]


def test_prepared_sets(prepared):
    out, report = prepared
    assert (report["samples_ok"], report["samples_dropped"]) == (69, 3)
    assert report["dropped_by_reason"] == {"image does not decode": 1, "json missing from shard": 1, "markdown is empty": 1}
    assert report["train_rows"] == 45 + report["train_unreadable"] and report["train_unreadable"] == round(4.5)
    assert (report["val_rows"], report["eval_manifest_rows"], report["heldout_pages_unused"]) == (4, 15, 10)
    train, val, manifest = lines(out / "train"), lines(out / "val"), lines(out / "eval" / "manifest")
    assert len(train) == report["train_rows"] and len(val) == report["val_rows"] and len(manifest) == report["eval_manifest_rows"]
    texts = lambda rows: {r["messages"][1]["content"] for r in rows} - {"[UNREADABLE]"}
    assert not any(t.startswith("page 3") for t in texts(train)) and all(t.startswith("page 3") for t in texts(val))
    tested = {m["reference_text"] for m in manifest if m["kind"] == "synthetic"}
    assert tested and all(t.startswith("page 3") for t in tested)
    assert [m["page_id"] for m in manifest] == sorted(m["page_id"] for m in manifest)
    assert {m["source"] for m in manifest if m["kind"] == "probe"} <= {f"synthetic_{k}" for k in prepare.UNREADABLE}
    assert report["originals_in_train"] + report["augmented_in_train"] == 45
    assert all(r["messages"][0]["content"] == prepare.PROMPT and len(r["images"]) == 1 for r in train)


def test_prepare_again_reads_no_shard(spark, source, prepared, monkeypatch):
    out, report = prepared
    monkeypatch.setattr(prepare, "read_shards", lambda *a: pytest.fail("read again"))
    assert prepare.prepare(spark, str(source), str(out), OPTIONS) == report


def test_prepare_guards(spark, source, tmp_path):
    from dataclasses import replace

    for bad in (replace(OPTIONS, holdout_groups=()), replace(OPTIONS, holdout_groups=(1, 2, 3)), replace(OPTIONS, holdout_groups=(9,)), replace(OPTIONS, pattern="none*")):
        with pytest.raises(UsageError):
            prepare.prepare(spark, str(source), str(tmp_path / "a"), bad)
    with pytest.raises(IntegrityError, match="unusable"):
        prepare.prepare(spark, str(source), str(tmp_path / "b"), replace(OPTIONS, max_drop_fraction=0.01))
    with pytest.raises(IntegrityError, match="fewer"):
        prepare.prepare(spark, str(source), str(tmp_path / "b"), replace(OPTIONS, val_size=100))
    write_tar(tmp_path / "s" / "stray.tar", [])
    with pytest.raises(UsageError, match="no shards"):
        shards.list_shards(spark, str(tmp_path / "s"))


def test_shard_names(spark):
    assert shards.parse_shard("shard_012_aug3") == (12, 3) and shards.parse_shard("shard_7") == (7, 0)
    for bad in ("shard_", "shard_1_aug", "xshard_1", "shard_1.tar", "shard_1\n"):
        with pytest.raises(ValueError, match="name"):
            shards.parse_shard(bad)


def test_members():
    def read(members):
        b = io.BytesIO()
        with tarfile.open(fileobj=b, mode="w") as t:
            for name, data in members:
                info = tarfile.TarInfo(name)
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))
        b.seek(0)
        return [(r[2], r[3], r[6]) for r in shards.samples(b, "s")]

    assert read([("a/1.PNG", b"x"), ("1.json", b"{}"), ("2.jpg", b"x"), ("3.json", b"{}"), ("3.txt", b""), ("3.jpeg", b"x"), ("4.png", b"x"), ("4.png", b"y")]) == [
        ("1", "png", None), ("2", None, "json missing from shard"), ("3", None, "unexpected member: 3.txt"), ("3", "jpeg", None), ("4", None, "duplicate image member: 4.png"), ("4", None, "json missing from shard"),
    ]


def test_images():
    assert shards.image_size(PNG) == (40, 30)
    segment = lambda kind, body: bytes([0xFF, kind]) + (len(body) + 2).to_bytes(2, "big") + body
    tables = segment(0xDB, bytes(65)) + segment(0xC4, bytes(20))
    jpeg = b"\xff\xd8" + segment(0xE0, b"ab") + tables + segment(0xC0, b"\x08\x00\x14\x00\x1e\x01\x01\x11\x00") + segment(0xDA, b"\x01\x01\x00\x00\x3f\x00") + b"data\xff\x00more\xff\xd0" + b"\xff\xd9"
    assert pixels._jpeg_size(jpeg, True) == shards.image_size(jpeg, full=False) == (30, 20)
    for bad in (jpeg[:-2], jpeg[:-1], jpeg.replace(tables, b""), b"\xff\xd8\xff\xd9", jpeg[:40]):
        with pytest.raises(ValueError):
            pixels._jpeg_size(bad, True)
    import zlib

    body = zlib.compress(b"\0" * 41 * 29)  # a row too few
    chunk = lambda kind, x: len(x).to_bytes(4, "big") + kind + x + zlib.crc32(kind + x).to_bytes(4, "big")
    short = PNG[:33] + chunk(b"IDAT", body) + chunk(b"IEND", b"")
    unknown = PNG[:33] + chunk(b"IDAT", zlib.compress(b"\7" * 41 * 30)) + chunk(b"IEND", b"")
    for bad in (b"", b"GIF89a", PNG[:20], PNG[:-30], PNG[:60] + b"\0" + PNG[61:], short, unknown):
        with pytest.raises((ValueError, zlib.error)):
            shards.image_size(bad)
    assert shards.image_size(PNG[:-30], full=False) == (40, 30)


@pytest.mark.parametrize("colour", [0, 2, 6])
def test_pixels_of_filtered_rows(colour):
    """All five filters, against a filter written byte by byte."""
    import random
    import zlib

    draw, step, width, height = random.Random(colour), {0: 1, 2: 3, 6: 4}[colour], 13, 11
    page = [[draw.randrange(256) for _ in range(width * step)] for _ in range(height)]

    def paeth(a, b, c):
        p = a + b - c
        d = [abs(p - a), abs(p - b), abs(p - c)]
        return (a, b, c)[d.index(min(d))]

    raw = b""
    for y, row in enumerate(page):
        kind = y % 5
        up = page[y - 1] if y else [0] * len(row)
        left = lambda r, i: r[i - step] if i >= step else 0
        coded = [(v - (0, left(row, i), up[i], (left(row, i) + up[i]) // 2, paeth(left(row, i), up[i], left(up, i)))[kind]) % 256 for i, v in enumerate(row)]
        raw += bytes([kind, *coded])
    chunk = lambda k, x: len(x).to_bytes(4, "big") + k + x + zlib.crc32(k + x).to_bytes(4, "big")
    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", width.to_bytes(4, "big") + height.to_bytes(4, "big") + bytes([8, colour, 0, 0, 0])) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    got = pixels.decoded(data)
    want = [[tuple((row[x * step : x * step + 3] * 3)[:3]) if step > 1 else (row[x],) * 3 for x in range(width)] for row in page]
    assert [[tuple(p) for p in row] for row in got.tolist()] == want


def test_unreadable_pages(spark):
    for kind in prepare.UNREADABLE:
        made = {n: unreadable.unreadable_png(kind, 1, n, PNG) for n in "abcdef"}
        assert all(v == unreadable.unreadable_png(kind, 1, n, PNG) for n, v in made.items())
        sizes = {shards.image_size(v) for v in made.values()}
        assert sizes == {(40, 30)} if kind == "obliterated" else len(sizes) > 1
    tall = pixels.decoded(unreadable.unreadable_png("obliterated", 1, "n", PNG)).astype(int)
    assert abs(tall.mean() - pixels.decoded(PNG).mean()) < 3 and abs(tall[:, 1:] - tall[:, :-1]).max() < 12
    blank = pixels.decoded(unreadable.unreadable_png("blank", 1, "n"))
    assert blank.min() > 180 and len({tuple(x) for x in blank.reshape(-1, 3).tolist()}) > 5
    df = spark.createDataFrame([("noise", "x", None), ("obliterated", "y", bytearray(PNG)), ("obliterated", "z", bytearray(b"no image"))], "kind string, page_id string, image binary")
    sizes = [shards.image_size(bytes(r[0])) for r in df.select(unreadable.pixels(1)("kind", "page_id", "image")).collect()]
    assert sizes[1] == (40, 30) and all(320 <= w <= 1000 and 240 <= h <= 1400 for w, h in (sizes[0], sizes[2]))


def test_records_name_files(prepared):
    """Every image that the records name is there and can be read."""
    out, report = prepared
    named = [r["images"][0] for n in ("train", "val") for r in lines(out / n)] + [str(out / m["image_path"]) for m in lines(out / "eval" / "manifest")]
    assert len(named) == report["train_rows"] + report["val_rows"] + report["eval_manifest_rows"]
    for path in named:
        with open(path, "rb") as f:
            shards.image_size(f.read())
    assert len(list((out / "unreadable").glob("*.png"))) == report["train_unreadable"] + report["val_unreadable"] + 5


def test_broken_run_adds_nothing(spark, source, prepared, tmp_path):
    """A run that ends between samples and their marker, started again, is like one that was never broken."""
    import shutil

    out, report = prepared
    again = tmp_path / "again"
    first = prepare.prepare(spark, str(source), str(again), OPTIONS)
    (again / "done" / "shard_002.json").unlink()
    shutil.rmtree(again / "images" / "shard_002")
    assert prepare.prepare(spark, str(source), str(again), OPTIONS) == first == report | {"settings": first["settings"]}
    assert sorted(p.name for p in (again / "images" / "shard_002").iterdir()) == sorted(p.name for p in (out / "images" / "shard_002").iterdir())


def shard_of(group, pages=6):
    return [(f"{k:03d}.{ext}", data) for k in range(pages) for ext, data in (("png", PNG), ("json", note(f"page {group} {k}")))]


def test_a_failed_shard_costs_only_itself(spark, tmp_path, monkeypatch):
    source, out, said = tmp_path / "s", tmp_path / "o", []
    for g in (1, 2, 3):
        write_tar(source / f"shard_{g:03d}.tar", shard_of(g))
    whole = (source / "shard_002.tar").read_bytes()
    (source / "shard_002.tar").write_bytes(whole[:3000])
    options = Options(holdout_groups=(3,), val_size=2, test_size=3, probe_count=1, unreadable_fraction=0.0)
    with pytest.raises(IntegrityError, match="1 of 3 shards could not be read") as e:
        prepare.prepare(spark, str(source), str(out), options, said.append)
    assert e.value.exit_code == 1 and len(e.value.problems) == 1
    assert e.value.problems[0].startswith("shard_002: ReadError: ")
    assert sorted(p.name for p in (out / "done").iterdir()) == ["shard_001.json", "shard_003.json"]
    assert len(list((out / "samples").glob("shard_00[13]-*.parquet"))) == 2 and not list((out / "samples").glob("shard_002*"))
    assert sorted(x.split("] ")[1].split(",")[0] for x in said[1:]) == ["shard_001: 6 ok", "shard_002: FAILED: ReadError: unexpected end of data", "shard_003: 6 ok"]
    assert [x.split("]")[0] for x in said[1:]] == ["[1/3", "[2/3", "[3/3"]
    # run again: only the third tar is read
    (source / "shard_002.tar").write_bytes(whole)
    read, asked, again = prepare.read_shards, [], []
    monkeypatch.setattr(prepare, "read_shards", lambda spark, todo, **how: asked.extend(todo) or read(spark, todo, **how))
    report = prepare.prepare(spark, str(source), str(out), options, again.append)
    assert [s for s, _, _ in asked] == ["shard_002"]
    assert (report["samples_ok"], report["train_rows"], report["samples_dropped"]) == (18, 12, 0)
    assert again[1:3] == ["[1/3] shard_001: already done", "[2/3] shard_003: already done"] and again[3].startswith("[3/3] shard_002: 6 ok, 0 problems, ")
    assert not list((out / "failed").iterdir())


def test_shards_that_fail_in_other_ways(spark, tmp_path):
    """An empty file, one that is no tar, and a tar without members: the last one is done, the others are named."""
    source = tmp_path / "s"
    write_tar(source / "shard_001.tar", shard_of(1))
    write_tar(source / "shard_002.tar", [])
    (source / "shard_003.tar").write_bytes(b"")
    (source / "shard_004.tar").write_bytes(b"no tar" * 500)
    with pytest.raises(IntegrityError) as e:
        prepare.prepare(spark, str(source), str(tmp_path / "o"), Options(holdout_groups=(1,)))
    assert [p.split(":")[0] for p in e.value.problems] == ["shard_003", "shard_004"]
    marks = prepare.shard_store.done(spark, str(tmp_path / "o"), shards.list_shards(spark, str(source)))
    assert {s: (m["ok"], m["problems"]) for s, m in marks.items()} == {"shard_001": (6, 0), "shard_002": (0, 0)}
    rows = prepare.shard_store.read_store(spark, str(tmp_path / "o"), marks, prepare.SAMPLES)
    assert rows.count() == 6
    with pytest.raises(Exception, match="ReadError"):
        shards.read_shards(spark, shards.list_shards(spark, str(source), "shard_004")).count()


def test_filters_reach_the_tars(spark, source):
    """Conditions on shard open only these tars; those on key, and reading annotations alone, leave other bytes unread."""
    listed = shards.list_shards(spark, str(source))
    every = shards.read_shards(spark, [*listed, ("shard_099", "/nowhere/shard_099.tar", 1)])
    some = every.where(F.col("shard").isin("shard_002", "shard_003") & F.col("problem").isNull())
    assert some.count() == 24  # the tar that is not there was not opened
    one = every.where("shard = 'shard_002' AND key = '003'").collect()
    assert [(r["shard"], r["key"], bytes(r["image"])) for r in one] == [("shard_002", "003", PNG)]
    plain = {(r["shard"], r["seq"]): (r["key"], r["ext"], r["annotation"], r["problem"]) for r in shards.read_shards(spark, listed).collect()}
    notes = shards.read_shards(spark, listed, images=False).collect()
    assert {(r["shard"], r["seq"]): (r["key"], r["ext"], r["annotation"], r["problem"]) for r in notes} == plain and all(r["image"] is None for r in notes)


def test_images_are_stepped_over(tmp_path):
    """Of a tar of 4 MB of images, an annotation scan reads little more than its headers and annotations."""
    write_tar(tmp_path / "shard_1.tar", [(f"{k}.{e}", d) for k in range(8) for e, d in (("png", b"x" * 500_000), ("json", note(f"page {k}")))])

    class Counted(io.FileIO):
        n = 0

        def read(self, size=-1):
            data = super().read(size)
            Counted.n += len(data)
            return data

    with Counted(tmp_path / "shard_1.tar") as f:
        assert [json.loads(r[5])["markdown"] for r in shards.samples(f, "shard_1", images=False)] == [f"page {k}" for k in range(8)]
    assert Counted.n < 50_000


def test_a_tar_of_another_size_is_read_again(spark, tmp_path):
    source, out = tmp_path / "s", tmp_path / "o"
    options = Options(holdout_groups=(2,), val_size=2, test_size=3, probe_count=1, unreadable_fraction=0.0)
    for g in (1, 2):
        write_tar(source / f"shard_{g}.tar", shard_of(g))
    assert prepare.prepare(spark, str(source), str(out), options)["samples_ok"] == 12
    write_tar(source / "shard_1.tar", shard_of(1, 30))
    assert prepare.prepare(spark, str(source), str(out), options)["samples_ok"] == 36


def test_annotations(spark):
    rows = [('{"markdown": "x"}', []), ("nope", ["annotation is not valid JSON"]), ("3", ["annotation is not an object"]), ('{"markdown": "[UNREADABLE]", "meta": 2}', ["markdown is the unreadable marker", "meta is not an object"]), ("{}", ["markdown is missing or not a string"]), ('{"markdown": "x", "meta": null}', [])]
    df = spark.createDataFrame([r[:1] for r in rows], "t string")
    assert [r[0] for r in df.select(prepare.annotation_problems(F.col("t"))).collect()] == [r[1] for r in rows]


def test_nearest_rank(spark):
    import random

    draw = random.Random(1)
    for n in (1, 2, 3, 10, 99, 100, 101):
        v = [draw.randint(0, 50) for _ in range(n)]
        o = sorted(v)
        r = prepare.nearest_rank(spark.createDataFrame([(x,) for x in v], "x int"), "x").first()
        assert [r[k] for k in ("p50", "p90", "p99", "max")] == [*(o[min(n - 1, int(q * n))] for q in (0.5, 0.9, 0.99)), o[-1]]


def test_streamed_shards(spark, source, tmp_path):
    for _ in range(2):
        q = ingest_shards(spark, str(source), str(tmp_path / "store"), str(tmp_path / "state"), at_once=4)
        q.awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "store"))
        assert rows.count() == 72 and rows.where("size(problems) = 0").count() == 69
    write_tar(source / "data" / "shard_009.tar", [("1.png", PNG), ("1.json", note())])
    try:
        ingest_shards(spark, str(source), str(tmp_path / "store"), str(tmp_path / "state")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "store")).count() == 73
    finally:
        (source / "data" / "shard_009.tar").unlink()


def test_windows_on_a_stream(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "e")).schema).parquet(str(tmp_path / "e"))
    q = trailing_counts(stream).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("counts").agg(F.sum("n")).first()[0] == 1000


def test_predictions(spark):
    pages = spark.createDataFrame([(f"p{i}", "a" if i % 2 else "b", f"{i}.png") for i in range(50)], "page_id string, split string, image_path string")
    done = spark.createDataFrame([("p1",)], "page_id string")
    todo = predict.pages_to_predict(pages, ["a"], done)
    out = predict.predict(todo, lambda paths: [f"T:{p}" for p in paths], batch=2, prefix="T:").collect()
    assert {r["page_id"]: r["text"] for r in out} == {f"p{i}": f"{i}.png" for i in range(3, 50, 2)}
    assert predict.existing_images(todo, pages.where("page_id = 'p3'")).count() == 1
    with pytest.raises(IntegrityError):
        predict.pages_to_predict(pages.withColumn("image_path", F.lit(None).cast("string")))
    predict.check_settings({"a": 1, "image_ref": 1}, {"a": 1, "image_ref": 2})
    with pytest.raises(UsageError) as e:
        predict.check_settings({"a": 1}, {"a": 2, "b": 3})
    assert len(e.value.problems) == 2


def test_written_files(spark, source, tmp_path):
    from quire.sources import files

    rows = prepare.checked_samples(shards.read_shards(spark, shards.list_shards(spark, str(source), "shard_002")))
    assert files.write_images(rows, str(tmp_path / "a")).count() == 12
    assert (tmp_path / "a" / "images" / "shard_002" / "003.png").read_bytes() == PNG
    texts = spark.createDataFrame([("p1", "één"), ("p2", "")], "page_id string, text string")
    assert {r["path"]: r["bytes"] for r in files.write_predictions(texts, str(tmp_path / "t")).collect()} == {"p1.txt": 5, "p2.txt": 0}
    assert files.write_predictions(texts.withColumn("text", F.when(F.col("page_id") == "p1", "x").otherwise("")), (tmp_path / "u").as_uri()).count() == 2
    a, b = files.audit(spark, str(tmp_path / "t"), "*.txt"), files.audit(spark, str(tmp_path / "u"))
    assert [r["name"] for r in files.differing(a, b, str(tmp_path / "t"), str(tmp_path / "u")).collect()] == ["p1.txt"]
