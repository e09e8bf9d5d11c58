"""Files on whatever file system pyarrow reaches, with the settings that Hadoop has for it; and listings that leave none out."""

from __future__ import annotations

import hashlib
import os
import re
import stat
from collections.abc import Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.store import settle

#: Bytes that are read at once.
PIECE = 8 << 20

#: Names that a task which lists a folder hands on at once.
NAMES = 10_000


def open_place(uri: str, settings: dict[str, str]):
    """(file system, path) of a uri for pyarrow. settings: Hadoop's, of which an object store's endpoint, keys, addressing and retries count."""
    from pyarrow.fs import AwsStandardS3RetryStrategy, FileSystem, LocalFileSystem, S3FileSystem

    if re.match(r"s3a?://", uri):
        get = lambda k: settings.get(f"fs.s3a.{k}") or None
        secure = (get("connection.ssl.enabled") or "true").lower() != "false"
        endpoint = get("endpoint")
        given = {
            "access_key": get("access.key"), "secret_key": get("secret.key"), "session_token": get("session.token"), "region": get("endpoint.region"),
            "endpoint_override": re.sub("^https?://", "", endpoint) if endpoint else None, "scheme": "http" if not secure or (endpoint or "").startswith("http://") else None,
        }
        path_style = (get("path.style.access") or "false").lower() == "true"
        tries = int(get("attempts.maximum") or 10)
        return S3FileSystem(force_virtual_addressing=not path_style and endpoint is not None, retry_strategy=AwsStandardS3RetryStrategy(max_attempts=tries), **{k: v for k, v in given.items() if v}), re.sub("^s3a?://", "", uri)
    if "://" not in uri and not uri.startswith("file:"):
        return LocalFileSystem(), uri
    return FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


#: What of Hadoop's settings goes to executors that open an object store.
PASSED = ("access.key", "secret.key", "session.token", "endpoint", "endpoint.region", "path.style.access", "attempts.maximum", "connection.ssl.enabled")


def store_settings(spark: SparkSession) -> dict[str, str]:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return {f"fs.s3a.{k}": v for k in PASSED if (v := conf.get(f"fs.s3a.{k}"))}


def digest(fs, path: str) -> str:
    """SHA-256 of a file, piece by piece."""
    h = hashlib.sha256()
    with fs.open_input_stream(path) as stream:
        while piece := stream.read(PIECE):
            h.update(piece)
    return h.hexdigest()


def parts_of(uri: str, settings: dict[str, str]) -> list[tuple[str, int]]:
    """(uri, size) of a file, or of the files in a folder as Spark reads them: by name, hidden ones left out."""
    from pyarrow.fs import FileSelector, FileType

    fs, at = open_place(uri, settings)
    info = fs.get_file_info(at)
    if info.type != FileType.Directory:
        return [(uri, info.size or 0)]
    files = [f for f in fs.get_file_info(FileSelector(at)) if f.type == FileType.File and not f.base_name.startswith(("_", "."))]
    return [(f"{uri.rstrip('/')}/{f.base_name}", f.size) for f in sorted(files, key=lambda f: f.base_name)]


def hidden(name: str) -> bool:
    """Whether Spark's file sources leave out what has this name."""
    return (name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")) and not name.startswith(("_common_metadata", "_metadata"))


def open_named(name: str, settings: dict[str, str]):
    """open_place for a path as Spark names it, in which nothing is escaped."""
    from pyarrow.fs import LocalFileSystem

    return (LocalFileSystem(), "/" + name[5:].lstrip("/")) if name.startswith("file:") else open_place(name, settings)


def _inside(fs, folder: str) -> Iterator[tuple[str, bool, int]]:
    """(name, is it a folder, size) of what a folder holds. A local one is read as a stream; of others this process holds the names."""
    from pyarrow.fs import FileSelector, FileType, LocalFileSystem

    if not isinstance(fs, LocalFileSystem):
        yield from ((f.base_name, f.type == FileType.Directory, f.size or 0) for f in fs.get_file_info(FileSelector(folder)) if f.type in (FileType.File, FileType.Directory))
        return
    with os.scandir(folder or "/") as found:
        for entry in found:
            try:
                info = entry.stat()
            except FileNotFoundError:  # gone meanwhile, or a link to nothing
                continue
            if stat.S_ISDIR(info.st_mode) or stat.S_ISREG(info.st_mode):
                yield entry.name, stat.S_ISDIR(info.st_mode), info.st_size


def _below(fs, at: str, recursive: bool) -> Iterator[tuple[str, int]]:
    """(name, size) of the files in a folder, and with recursive in those below it."""
    folders = [""]
    while folders:
        inside = folders.pop()
        for name, is_folder, size in _inside(fs, f"{at}/{inside}".rstrip("/")):
            if hidden(name):
                continue
            if not is_folder:
                yield inside + name, size
            elif recursive:
                folders.append(f"{inside}{name}/")


def list_files(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*", recursive: bool = False) -> DataFrame:
    """root, name (below root), path, length of the files that there are now: those that Spark's file sources find, and empty ones, which these leave out.

    Spark's sources keep every file's status and place in a task on the driver. Here a task lists a path and deals the names out as it goes,
    and they are stored in the shared checkpoint folder: the driver holds none of them. Paths may be patterns, as for Spark.
    """
    jvm, settings = spark._jvm, store_settings(spark)
    wanted, roots = jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled().pattern(), []
    for path in [paths] if isinstance(paths, str) else paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
        if not found:
            raise FileNotFoundError(f"there is nothing at {path}")
        roots += [(f.getPath().toString(), f.isDirectory(), f.getLen()) for f in found]

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits = re.compile(wanted, re.DOTALL).fullmatch
        for b in batches:
            for k, root, is_folder, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
                fs, at = open_named(root, settings)
                found = ((n, s) for n, s in (_below(fs, at.rstrip("/"), recursive) if is_folder else [("", size)]) if fits((n or root).rsplit("/", 1)[-1]))
                while some := list(islice(found, NAMES)):
                    yield pa.RecordBatch.from_arrays([pa.array([k] * len(some), pa.int32()), pa.array([n for n, _ in some], pa.string()), pa.array([s for _, s in some], pa.int64())], names=["k", "name", "length"])

    places = spark.createDataFrame([(k, *r) for k, r in enumerate(roots)], "k int, root string, is_folder boolean, size long")
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    stored = settle(places.mapInArrow(names, "k int, name string, length long").repartition(tasks, "k", "name"))
    path = F.when(F.col("name") == "", F.col("root")).otherwise(F.concat(F.regexp_replace("root", "/$", ""), F.lit("/"), "name"))
    return stored.join(F.broadcast(places), "k").select("root", "name", path.alias("path"), "length")


def read_files(files: DataFrame) -> DataFrame:
    """path, length, content of listed files. A task reads one after the other and holds few at once."""
    settings = store_settings(files.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, batch = {}, lambda own: pa.RecordBatch.from_arrays([pa.array([p for p, _ in own], pa.string()), pa.array([len(d) for _, d in own], pa.int64()), pa.array([d for _, d in own], pa.binary())], names=["path", "length", "content"])
        for b in batches:
            own, size = [], 0
            for root, name, path in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if root not in places:
                    places[root] = open_named(root, settings)
                fs, at = places[root]
                with fs.open_input_stream(f"{at.rstrip('/')}/{name}" if name else at, compression=None) as f:
                    data = f.read()
                if own and size + len(data) > PIECE:
                    yield batch(own)
                    own, size = [], 0
                own.append((path, data))
                size += len(data)
            yield batch(own)

    return files.select("root", "name", "path").mapInArrow(read, "path string, length long, content binary")


def binary_files(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*", recursive: bool = False) -> DataFrame:
    """path, length, content of files, also of empty ones."""
    return read_files(list_files(spark, paths, pattern, recursive))
