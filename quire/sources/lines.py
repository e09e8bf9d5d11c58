"""Text files as numbered lines, and as whole texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.text import file_text
from quire.sources.running import Sha256, goes_on
from quire.sources.stores import PIECE, list_files, open_place, parts_of, read_files, store_settings


#: Bytes of a file that one task hashes.
STRETCH = 512 << 20


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """line (from 1), raw (bytes as read), value (text), good (valid UTF-8) of a file of any size, or of a folder's files in the order of their names.

    Rows are numbered inside each split, and splits by their file and place in it, so no task reads the whole.
    """
    split = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    rows = spark.read.text(path).select(F.col("value").cast("binary").alias("raw"), split.alias("split"), F.monotonically_increasing_id().alias("i"))
    splits = rows.groupBy("split").agg(F.min("i").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.join(F.broadcast(splits.withColumn("before", before)), "split")  # a row a split
    return rows.select((F.col("i") - F.col("first") + F.col("before") + 1).alias("line"), "raw", F.col("raw").cast("string").alias("value"), F.is_valid_utf8(F.col("raw").cast("string")).alias("good"))


def whole_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, stem, text, good of the files in a folder, by the rule for text files."""
    return texts_of(list_files(spark, path, pattern))


def texts_of(files: DataFrame) -> DataFrame:
    """whole_files of listed files."""
    text = F.col("content").cast("string")
    return read_files(files).select("path", F.regexp_extract("path", r"([^/]*?)(\.[^./]*)?$", 1).alias("stem"), file_text(text).alias("text"), F.is_valid_utf8(text).alias("good"))


def sha256_of_file(spark: SparkSession, path: str) -> str:
    """Of a file, or of a folder's files end to end, in the order of their names. Tasks read a piece each, one after the other."""
    settings = store_settings(spark)
    if not goes_on(spark):
        h = hashlib.sha256()
        for uri, _ in parts_of(path, settings):
            fs, place = open_place(uri, settings)
            with fs.open_input_stream(place) as f:
                while data := f.read(PIECE):
                    h.update(data)
        return "sha256:" + h.hexdigest()
    pieces = [(uri, at, min(STRETCH, size - at)) for uri, size in parts_of(path, settings) for at in range(0, size, STRETCH)]

    def read(piece: tuple[str, int, int], state: bytes) -> bytes:
        uri, at, n = piece
        fs, place = open_place(uri, settings)
        h = Sha256(state)
        with fs.open_input_file(place) as f:
            f.seek(at)
            while n and (data := f.read(min(PIECE, n))):
                h.update(data)
                n -= len(data)
        return h.state()

    state = Sha256().state()
    for piece in pieces:
        state = spark.sparkContext.parallelize([piece], 1).map(lambda p, s=state: read(p, s)).first()
    return "sha256:" + Sha256(state).hexdigest()


def digest_of(pairs: Iterable[tuple[str, str]]) -> str:
    """SHA-256 over id, NUL, text, NUL of each pair in turn; the caller brings them in the order of their ids."""
    h = hashlib.sha256()
    for i, t in pairs:
        h.update(i.encode() + b"\0" + t.encode() + b"\0")
    return "sha256:" + h.hexdigest()


def exists(spark: SparkSession, path: str) -> str | None:
    """'file', 'directory' or None, on whatever file system the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return None if not fs.exists(p) else "directory" if fs.getFileStatus(p).isDirectory() else "file"


def quoted(c: Column) -> Column:
    return F.concat(F.lit("'"), c, F.lit("'"))


def own_or_alone() -> list[Column]:
    """Keys under which good lines meet by their page_id; a line with a fault (fatal) is alone, so such lines are not all in one task."""
    good = F.col("fatal").isNull()
    return [F.when(good, F.col("page_id")), F.when(~good, F.col("line"))]
