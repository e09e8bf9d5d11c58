"""Folders of small documents, on whatever file system Spark knows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quire.sources import writer


class Place:
    """A folder by its path or uri. Documents appear under their names when they are whole."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self.jvm = spark, str(folder).rstrip("/"), spark._jvm
        self.root = self.jvm.org.apache.hadoop.fs.Path(str(folder))
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.jvm.org.apache.hadoop.fs.FileSystem.newInstance(self.root.toUri(), self.conf)  # of its own: it keeps no checksum files
        self.fs.setWriteChecksum(False)

    def at(self, name: str) -> Any:
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def uri(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def has(self, name: str) -> bool:
        return self.fs.exists(self.at(name))

    def is_empty(self) -> bool:
        return not self.fs.exists(self.root) or not len(self.fs.listStatus(self.root))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def _put(self, name: str, fill: Callable[[Any], None]) -> None:
        modes, made = self.jvm.org.apache.hadoop.fs.permission.FsPermission, not self.fs.exists(self.root)
        self.fs.mkdirs(self.root)
        if made:
            self.fs.setPermission(self.root, modes("775"))
        stream = self.fs.create(tmp := self.at(f"{name}.tmp"), True)
        try:
            fill(stream)
        finally:
            stream.close()
        self.fs.setPermission(tmp, modes("664"))
        self.fs.delete(self.at(name), True)
        self.fs.rename(tmp, self.at(name))

    def write(self, name: str, text: str) -> None:
        data = bytearray((text if text.endswith("\n") else text + "\n").encode())
        self._put(name, lambda stream: stream.write(data, 0, len(data)))

    def write_json(self, name: str, x: Any) -> None:
        self.write(name, writer.dumps(x))

    def write_lines(self, name: str, rows: DataFrame, line: Callable[[dict], str]) -> None:
        """A file with a line for each row, in the rows' order. Executors make the lines; the file systems copy their files end to end."""

        def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([line(r) for r in b.to_pylist()], pa.string())], names=["value"])

        parts = f"{self.folder}/_{name}.parts"
        rows.mapInArrow(lines, "value string").write.mode("overwrite").text(parts)
        folder = self.jvm.org.apache.hadoop.fs.Path(parts)
        names = sorted(str(f.getPath().getName()) for f in self.fs.listStatus(folder))

        def fill(stream: Any) -> None:
            for part in (n for n in names if n.startswith("part-")):
                source = self.fs.open(self.jvm.org.apache.hadoop.fs.Path(folder, part))
                try:
                    self.jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, stream, self.conf, False)
                finally:
                    source.close()

        self._put(name, fill)
        self.fs.delete(folder, True)
