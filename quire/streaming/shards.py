"""Shards that arrive over time: each is read once, and its samples appear together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.operators.prepare import checked_samples
from quire.sources.shards import parse_shard, read_shards


def ingest_shards(spark: SparkSession, source: str, store: str, checkpoint: str, verify: str = "full", at_once: int = 64) -> StreamingQuery:
    """Starts a query that adds the samples of all shards in source that it has not read, and ends.

    The file source's checkpoint knows which tars were read. A batch writes each shard to its own folder, in place of what
    a broken attempt left there, so a batch that is run again changes nothing.
    """
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.tar").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", at_once).load(source).select("path")

    def write(batch: DataFrame, _: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # at most `at_once`
        shards = [(p.rsplit("/", 1)[-1].removesuffix(".tar"), p) for p in paths]
        for stem, _path in shards:
            parse_shard(stem)
        rows = checked_samples(read_shards(spark, shards), verify).drop("state")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(store)

    return files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def trailing_counts(events: DataFrame, minutes: int = 60, late: str = "10 minutes") -> DataFrame:
    """Events a window and type, for streams with a column ts; late rows count until the watermark has passed."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", f"{minutes} minutes"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
