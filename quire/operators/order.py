"""Places of rows in an order, without one task that orders them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.store import settle

#: Rows of one partition are numbered in so many low bits of Spark's own ids.
_LOW = (1 << 33) - 1


def numbered(df: DataFrame, *keys: str | Column, place: str = "place") -> DataFrame:
    """df with each row's place (from 0) in the order of the keys, which should tell rows apart.

    Keys are names or sort expressions of any type that Spark orders, compared as orderBy compares them (nulls first unless they
    say otherwise). Rows are dealt out by ranges of all keys, sorted in each, and stored; a place is the row's number in
    its partition and what the partitions before it hold. One way for tables of every size; ties stand in any order.
    """
    by = [F.col(k) if isinstance(k, str) else k for k in keys]
    rows = settle(df.repartitionByRange(*by).sortWithinPartitions(*by))
    own = rows.withColumn("__id", F.monotonically_increasing_id())  # of stored rows, so that both uses of it agree
    sizes = own.groupBy(F.shiftright("__id", 33).alias("__part")).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = F.broadcast(sizes.select("__part", before.alias("__before")))  # a row a partition
    placed = own.withColumn("__part", F.shiftright("__id", 33)).join(sizes, "__part").withColumn(place, F.col("__id").bitwiseAND(F.lit(_LOW)) + F.col("__before"))
    return placed.select(*(f"`{c}`" for c in df.columns if c != place), place)


def stride(pages: DataFrame, n: int, key: str = "page_id") -> DataFrame:
    """pages with shard: its place in the order of the key, modulo n."""
    return numbered(pages, key, place="__place").withColumn("shard", (F.col("__place") % n).cast("int")).drop("__place")
