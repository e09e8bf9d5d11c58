"""One file a row: extracted images, predicted texts; and the check of what was written."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.stores import PIECE, binary_files, digest, list_files, open_place, store_settings


def write_files(rows: DataFrame, root: str, name: str, content: str) -> DataFrame:
    """path, bytes of a file under root for every row; executors write when the result is computed.

    content is text or bytes. A file appears under its name when it is whole, so tasks that run again change nothing. root is
    any place that pyarrow's file systems reach (a path, file://, s3://, hdfs://).
    """

    settings = store_settings(rows.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_place(root, settings)
        made = set()
        for b in batches:
            sizes = []
            for n, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                data = c.encode() if isinstance(c, str) else bytes(c or b"")
                path = f"{base.rstrip('/')}/{n}"
                if (folder := path.rsplit("/", 1)[0]) not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                with fs.open_output_stream(f"{path}.tmp") as out:
                    out.write(data)
                fs.move(f"{path}.tmp", path)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], names=["path", "bytes"])

    return rows.select(F.col(name).alias("path"), F.col(content).alias("content")).mapInArrow(write, "path string, bytes long")


def write_predictions(predictions: DataFrame, root: str) -> DataFrame:
    """<page_id>.txt for each row of page_id and text."""
    return write_files(predictions.select(F.concat("page_id", F.lit(".txt")).alias("name"), "text"), root, "name", "text")


def write_images(samples: DataFrame, root: str) -> DataFrame:
    """path, bytes of images/<shard>/<key>.<ext> for each usable sample of the shard source."""
    good = samples.where("size(problems) = 0")
    return write_files(good.select(F.concat(F.lit("images/"), "shard", F.lit("/"), "key", F.lit("."), "ext").alias("name"), "image"), root, "name", "image")


def audit(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, bytes, sha256 of every file below path."""
    files = binary_files(spark, path, pattern, recursive=True)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def differing(left: DataFrame, right: DataFrame, root_left: str, root_right: str) -> DataFrame:
    """Names that only one of two audits has, or with other content."""
    named = lambda df, root: df.select(F.substring_index("path", root.rstrip("/") + "/", -1).alias("name"), "sha256")
    a, b = named(left, root_left), named(right, root_right)
    return a.join(b.withColumnRenamed("sha256", "other"), "name", "full_outer").where("NOT (sha256 <=> other)")


def listed(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path of every file below path, without its content."""
    return list_files(spark, path, pattern, recursive=True).select("path")


def transfer(spark: SparkSession, source: str, target: str, pattern: str = "*", expected: DataFrame | None = None) -> DataFrame:
    """name, bytes, sha256, copied of every file below source, after executors have brought it below target.

    expected: name and sha256 of files whose digests are known. A file that is there already, of the same size and (if it is
    known) digest, is not copied again. Others are hashed as they are copied, under a name that nothing reads; they take their
    own name when size and digest are right, and an error says which one is not. Any file systems that pyarrow reaches.
    """
    settings = store_settings(spark)
    files = list_files(spark, source, pattern, recursive=True).select("path", "length")
    at = lambda c: F.regexp_replace(c, "^[a-z0-9]+:/+", "/")
    base = "/" + source.split(":", 1)[-1].strip("/") if ":" in source or source.startswith("/") else source.rstrip("/")
    rows = files.select("path", F.col("length").alias("bytes"), F.substr(at(F.col("path")), F.lit(len(base) + 2)).alias("name")).where(~F.col("name").endswith(".partial"))
    if expected is not None:
        rows = rows.join(expected.select("name", F.col("sha256").alias("known")), "name", "left")
    else:
        rows = rows.withColumn("known", F.lit(None).cast("string"))

    def bring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for name, path, size, known in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if ".." in name.split("/"):
                    raise ValueError(f"{name} would be written outside {target}")
                there, to = open_place(f"{target.rstrip('/')}/{name}", settings)
                found = there.get_file_info(to)
                if found.size == size and (known is None or digest(there, to) == known):
                    out.append((name, size, known, False))
                    continue
                here, own = open_place(path, settings)
                there.create_dir(to.rsplit("/", 1)[0], recursive=True)
                h, n = hashlib.sha256(), 0
                with here.open_input_stream(own) as stream, there.open_output_stream(f"{to}.partial") as sink:
                    while piece := stream.read(PIECE):
                        h.update(piece)
                        n += len(piece)
                        sink.write(piece)
                if n != size or known not in (None, h.hexdigest()):
                    there.delete_file(f"{to}.partial")
                    raise ValueError(f"{name}: {n} bytes with sha256 {h.hexdigest()}, where {size} bytes with {known or 'any'} were expected")
                there.move(f"{to}.partial", to)
                out.append((name, n, h.hexdigest(), True))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.string(), pa.bool_()))], names=["name", "bytes", "sha256", "copied"])

    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    return rows.select("name", "path", "bytes", "known").repartition(tasks, "name").mapInArrow(bring, "name string, bytes long, sha256 string, copied boolean")
