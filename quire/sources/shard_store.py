"""Where the samples of shards are kept: one Parquet file and one mark for each shard, put there by the task that read it."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import closing, contextmanager
from dataclasses import dataclass, field
from threading import Event, Thread

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from quire.sources.stores import open_place, store_settings

#: State of the last row of a shard that was read to its end.
END = "end"


@dataclass
class Outcomes(WriterCommitMessage):
    shards: list[tuple[str, str | None]] = field(default_factory=list)


def put(fs, path: str, data: bytes) -> None:
    """A file that appears under its name when it is whole."""
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(tmp) as out:
        out.write(data)
    fs.move(tmp, path)


class _Sink:
    """One shard's samples on their way."""

    def __init__(self, fs, root: str, shard: str, size: int) -> None:
        self.fs, self.root, self.shard, self.size, self.began = fs, root, shard, size, time.monotonic()
        self.file, self.ok, self.problems, self.writer = f"samples/{shard}-{uuid.uuid4().hex[:12]}.parquet", 0, 0, None
        self.folder = f"{root}/images/{shard}"
        fs.create_dir(self.folder, recursive=True)

    def add(self, rows: pa.Table) -> None:
        if self.writer is None:
            self.writer = pq.ParquetWriter(f"{self.root}/{self.file}", rows.schema, filesystem=self.fs, compression="zstd")
        self.writer.write_table(rows)
        for key, ext, image, problems in zip(*(rows[c].to_pylist() for c in ("key", "ext", "image", "problems")), strict=True):
            self.problems += len(problems)
            if not problems:
                self.ok += 1
                put(self.fs, f"{self.folder}/{key}.{ext}", image)

    def end(self, schema: pa.Schema, failed: str | None) -> None:
        """The mark. A shard that failed has no file of samples; what it left under a name of its own is deleted."""
        if failed is None and self.writer is None:
            self.add(schema.empty_table())
        if self.writer is not None:
            self.writer.close()
            if failed is not None:
                self.fs.delete_file(f"{self.root}/{self.file}")
        said = {"shard": self.shard, "bytes": self.size, "file": self.file if failed is None else None, "ok": self.ok, "problems": self.problems, "seconds": round(time.monotonic() - self.began, 1), "failed": failed}
        put(self.fs, f"{self.root}/{'failed' if failed is not None else 'done'}/{self.shard}.json", json.dumps(said).encode())


class _Writer(DataSourceArrowWriter):
    def __init__(self, out: str, sizes: dict[str, int], settings: dict[str, str]) -> None:
        self.out, self.sizes, self.settings = out, sizes, settings

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        """Stores shards whose rows lie together. Each is marked on its own, so neither another shard's fault nor the end of the run undoes it."""
        fs, root = open_place(self.out, self.settings)
        now, out = None, Outcomes()
        for batch in iterator:
            rows = pa.Table.from_batches([batch])
            for shard, state in dict.fromkeys(zip(rows["shard"].to_pylist(), rows["state"].to_pylist(), strict=True)):
                if now is None or now.shard != shard:
                    now = _Sink(fs, root, shard, self.sizes[shard])
                own = pc.equal(rows["shard"], shard)
                if state is None:
                    now.add(rows.filter(pc.and_(own, pc.is_null(rows["state"]))).drop_columns("state"))
                else:
                    now.end(rows.schema.remove(rows.schema.get_field_index("state")), None if state == END else state)
                    out.shards.append((shard, None if state == END else state))
        return out

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Nothing is left to do: marks stand already."""

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Shards that were marked stay; the others are read again by the next run."""


class ShardStore(DataSource):
    """df.write.format("shard_store").option("out", folder).option("sizes", JSON of {shard: bytes}): rows of checked_samples with their state."""

    @classmethod
    def name(cls) -> str:
        return "shard_store"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["out"], json.loads(self.options["sizes"]), json.loads(self.options["settings"]))


def _marks(spark: SparkSession, out: str, kind: str) -> dict[str, dict]:
    """The marks of a kind, one small file a shard."""
    from pyarrow.fs import FileSelector

    fs, root = open_place(out, store_settings(spark))
    found = fs.get_file_info(FileSelector(f"{root}/{kind}", allow_not_found=True))
    marks = {}
    for f in found:
        if f.base_name.endswith(".json"):
            with closing(fs.open_input_stream(f.path)) as stream:
                m = json.loads(stream.read())
            marks[m["shard"]] = m
    return marks


def done(spark: SparkSession, out: str, shards: list[tuple[str, str, int]]) -> dict[str, dict]:
    """The marks of shards that are stored, of the size that they have now."""
    sizes, marks = {s: n for s, _, n in shards}, _marks(spark, out, "done")
    return {s: m for s, m in marks.items() if sizes.get(s) == m["bytes"]}


def failed(spark: SparkSession, out: str) -> dict[str, dict]:
    return _marks(spark, out, "failed")


def _line(m: dict) -> str:
    return f"FAILED: {m['failed']}" if m["failed"] is not None else f"{m['ok']} ok, {m['problems']} problems, {m['seconds']:.0f}s"


@contextmanager
def _watched(spark: SparkSession, out: str, todo: list[str], at: int, total: int, tell: Callable[[str], None], every: float) -> Iterator[None]:
    """Tells of each shard when its mark appears, while the block runs."""
    told, ended = set(), Event()

    def look() -> None:
        for s, m in sorted((_marks(spark, out, "done") | failed(spark, out)).items()):
            if s in waiting and s not in told and (m["failed"] is not None or s not in before or m != before[s]):
                told.add(s)
                tell(f"[{at + len(told)}/{total}] {s}: {_line(m)}")

    def watch() -> None:
        while not ended.wait(every):
            look()

    waiting, before = set(todo), _marks(spark, out, "done")
    thread = Thread(target=watch, daemon=True)
    thread.start()
    try:
        yield
    finally:
        ended.set()
        thread.join()
        look()


def store(rows: DataFrame, out: str, shards: list[tuple[str, str, int]], todo: list[tuple[str, str, int]], tell: Callable[[str], None] = lambda _: None, every: float = 2.0) -> dict[str, dict]:
    """Stores the rows of the shards in todo below out; the marks of those that failed.

    rows: of checked_samples, with state, each shard's together. tell gets a line for every shard of shards: those that were done before
    first, the others as soon as they have their mark.
    """
    spark = rows.sparkSession
    spark.dataSource.register(ShardStore)
    names = [s for s, _, _ in todo]
    fs, root = open_place(out, store_settings(spark))
    for folder in ("samples", "done", "failed"):
        fs.create_dir(f"{root}/{folder}", recursive=True)
    for s in failed(spark, out):
        fs.delete_file(f"{root}/failed/{s}.json")
    ready = [s for s, _, _ in shards if s not in names]
    for i, s in enumerate(ready):
        tell(f"[{i + 1}/{len(shards)}] {s}: already done")
    with _watched(spark, out, names, len(ready), len(shards), tell, every):
        options = {"out": out, "sizes": json.dumps({s: n for s, _, n in todo}), "settings": json.dumps(store_settings(spark))}
        rows.write.format("shard_store").options(**options).mode("append").save()
    return {s: m for s, m in failed(spark, out).items() if s in names}


def read_store(spark: SparkSession, out: str, marks: dict[str, dict], schema: str) -> DataFrame:
    """The samples of marked shards; files that a broken attempt left are not among them."""
    files = [f"{out.rstrip('/')}/{m['file']}" for _, m in sorted(marks.items())]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
