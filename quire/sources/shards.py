"""Tar shards of image and annotation pairs, as a batch data source."""

from __future__ import annotations

import fnmatch
import json
import re
import struct
import tarfile
import zlib
from collections import Counter
from collections.abc import Iterator
from contextlib import closing

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from quire.errors import UsageError
from quire.functions.pixels import image_size
from quire.sources.stores import open_place, store_settings

SHARD = re.compile(r"shard_(\d+)(?:_aug(\d+))?\Z")
# What counts as an image by its extension.
IMAGES = ("png", "jpg", "jpeg")

#: state: null for samples; where the ends of shards are asked for, `end` or what kept a shard from being read to its end.
SAMPLE = "shard string, seq long, key string, ext string, image binary, annotation string, problem string, state string"


def parse_shard(stem: str) -> tuple[int, int]:
    """(group, augmentation) of a shard's name; the latter is 0 for originals."""
    m = SHARD.match(stem)
    if not m:
        raise ValueError(f"{stem!r} is not a shard's name")
    return int(m[1]), int(m[2] or 0)


def shard_group(stem: Column) -> Column:
    return F.regexp_extract(stem, r"^shard_(\d+)(?:_aug(\d+))?$", 1).cast("int")


def shard_aug(stem: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(stem, r"^shard_(\d+)(?:_aug(\d+))?$", 2), F.lit("")).cast("int"), F.lit(0))


def list_shards(spark: SparkSession, source: str, pattern: str = "shard_*") -> list[tuple[str, str, int]]:
    """(stem, path, size) of every tar below source that the pattern names, by stem; on any file system Spark knows.

    All tars must have a shard's name, also those that the pattern leaves out, and no two chosen ones the same.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(source)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        raise UsageError(f"no folder {source}")
    found, walk = [], fs.listFiles(root, True)
    while walk.hasNext():
        f = walk.next()
        if (name := f.getPath().getName()).endswith(".tar"):
            found.append((name.removesuffix(".tar"), f.getPath().toString(), f.getLen()))
    if bad := sorted(s for s, _, _ in found if not SHARD.match(s)):
        raise UsageError("tar files that are no shards", bad)
    chosen = sorted(x for x in found if fnmatch.fnmatchcase(x[0], pattern))
    stems = [s for s, _, _ in chosen]
    if twice := sorted(s for s, n in Counter(stems).items() if n > 1):
        raise UsageError("shards that occur more than once", twice)
    return chosen


def samples(stream, shard: str, images: bool = True, keys: frozenset[str] | None = None) -> Iterator[tuple]:
    """Rows of SAMPLE, but for the state, from a tar that is read once, front to back.

    A sample's members lie together and share what stands before the first dot of their base names; a member with another
    name ends it. What has no partner, comes twice or is of no known kind is a row with a problem. Without images, and of samples
    that are not among keys, the bytes are stepped over, which takes a stream that can seek.
    """
    seq, key, have = 0, None, {}

    def row(problem: str | None = None, of: str | None = None) -> tuple:
        nonlocal seq
        seq += 1
        if problem:
            return shard, seq, of if of is not None else key, None, None, None, problem
        return shard, seq, key, have["image"][0], have["image"][1] if images else None, have["json"][1].decode("utf-8", "replace"), None

    def end() -> Iterator[tuple]:
        if have:
            yield row() if len(have) == 2 else row(f"{'json' if 'image' in have else 'image'} missing from shard")
            have.clear()

    with tarfile.open(fileobj=stream, mode="r|" if images and keys is None else "r:") as tar:
        for member in tar:
            if not member.isfile():
                continue
            name = member.name.rsplit("/", 1)[-1]
            own, _, ext = name.partition(".")
            kind = "image" if (ext := ext.lower()) in IMAGES else "json" if ext == "json" else None
            if kind is None:
                yield row(f"unexpected member: {name}", own)
                continue
            if own != key:
                yield from end()
                key = own
            if kind in have:
                yield row(f"duplicate {kind} member: {name}", own)
                continue
            wanted = (images or kind == "json") and (keys is None or own in keys)
            have[kind] = (ext, tar.extractfile(member).read() if wanted else b"")
            if len(have) == 2:
                yield from end()
        yield from end()


class _Shard(InputPartition):
    def __init__(self, stem: str, path: str) -> None:
        self.stem, self.path = stem, path


class _Reader(DataSourceReader):
    def __init__(self, shards: list[tuple[str, str]], settings: dict[str, str], ends: bool = False, images: bool = True) -> None:
        self.shards, self.settings, self.ends, self.images = shards, settings, ends, images
        self.keys: frozenset[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Conditions on shard leave out tars, those on key the bytes of other samples; Spark checks the rows of a key itself."""
        for f in filters:
            name = getattr(f, "attribute", None)
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is None or name not in (("shard",), ("key",)):
                yield f
            elif name == ("shard",):
                self.shards = [s for s in self.shards if s[0] in values]
            else:
                self.keys = frozenset(values) if self.keys is None else self.keys & values
                yield f

    def partitions(self) -> list[InputPartition]:
        return [_Shard(*s) for s in self.shards] or [_Shard("", "")]

    def read(self, partition: _Shard) -> Iterator[tuple]:
        if not partition.path:
            return
        state = "end"
        try:
            fs, at = open_place(partition.path, self.settings)
            with closing(fs.open_input_stream(at) if self.images and self.keys is None else fs.open_input_file(at)) as stream:
                for row in samples(stream, partition.stem, self.images, self.keys):
                    if self.keys is None or row[2] in self.keys:
                        yield *row, None
        except (tarfile.TarError, OSError, EOFError, zlib.error) as e:
            if not self.ends:
                raise
            state = f"{type(e).__name__}: {e}"
        if self.ends:
            yield partition.stem, None, None, None, None, None, None, state


class TarShards(DataSource):
    """spark.read.format("tar_shards").option("shards", JSON of [[stem, path], ...]): one partition a tar. settings: an object store's.

    ends: a tar that cannot be read to its end is no error; each one has a last row, whose state says how it ended.
    images: false leaves the images' bytes where they are; the column is null.
    """

    @classmethod
    def name(cls) -> str:
        return "tar_shards"

    def schema(self) -> str:
        return SAMPLE

    def reader(self, schema) -> DataSourceReader:
        return _Reader([tuple(x) for x in json.loads(self.options.get("shards", "[]"))], json.loads(self.options.get("settings", "{}")), self.options.get("ends") == "true", self.options.get("images") != "false")


def read_shards(spark: SparkSession, shards: list[tuple], ends: bool = False, images: bool = True) -> DataFrame:
    """Samples of tars. ends, images: see TarShards. Filters on shard and key reach the tars in sessions that this function has seen."""
    spark.dataSource.register(TarShards)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    named = spark.read.format("tar_shards").option("shards", json.dumps([list(s[:2]) for s in shards]))
    return named.option("settings", json.dumps(store_settings(spark))).option("ends", str(ends).lower()).option("images", str(images).lower()).load()


def probe_image(full: bool) -> Column:
    """A function of image bytes to (width, height, fault)."""

    @F.pandas_udf("struct<width:int,height:int,fault:string>")
    def probe(images: pd.Series) -> pd.DataFrame:
        rows = []
        for data in images:
            try:
                rows.append((*image_size(data or b"", full), None))
            except (ValueError, OSError, zlib.error, struct.error) as e:
                rows.append((None, None, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(rows, columns=["width", "height", "fault"]).astype({"width": "Int32", "height": "Int32"})

    return probe
