import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from quire.operators import order

draw = random.Random(2)
KEYS = {
    "long": [draw.randint(-(10**12), 10**12) for _ in range(3000)] + [0, -1, 1, 10, 9, 100, None],
    "double": [draw.uniform(-5, 5) * 10 ** draw.randint(-9, 9) for _ in range(3000)] + [None, float("-inf"), float("inf"), 0.5],
    "string": [str(draw.randint(-9999, 9999)) + draw.choice(["", "é", "Z", " "]) for _ in range(3000)] + [None, ""],
    "date": [dt.date(1900, 1, 1) + dt.timedelta(days=draw.randint(0, 80_000)) for _ in range(3000)] + [None],
    "decimal(20,4)": [decimal.Decimal(draw.randint(-(10**9), 10**9)) / 10_000 for _ in range(3000)] + [None],
}


@pytest.mark.parametrize("kind", KEYS)
def test_places_by_typed_keys(spark, kind):
    """Keys of all types, negative and null ones, in both directions."""
    values = list(dict.fromkeys(KEYS[kind]))
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"k {kind}, i int").repartition(7)
    want = {r["i"]: n for n, r in enumerate(df.orderBy("k").collect())}
    got = order.numbered(df, "k")
    assert got.columns == ["k", "i", "place"]
    assert {r["i"]: r["place"] for r in got.collect()} == want
    assert {r["i"]: r["place"] for r in order.numbered(df, F.col("k").desc()).collect()} == {i: len(want) - 1 - n for i, n in want.items()}


def test_places_of_many_rows(spark):
    got = order.numbered(spark.range(300_000).select((F.lit(150_000) - F.col("id")).alias("k")), "k")
    assert got.where(F.col("place") != F.col("k") + 149_999).count() == 0 and got.count() == 300_000


def test_places_with_ties(spark):
    df = spark.range(5000).select(F.lit("same").alias("k"), "id")
    assert sorted(r["place"] for r in order.numbered(df.union(df.limit(3)), "k", "id").collect()) == list(range(5003))
    assert {r["id"]: r["place"] for r in order.numbered(df, "k", "id").collect()} == {i: i for i in range(5000)}
    assert order.numbered(df.limit(0), "k").count() == 0


def test_stride(spark):
    df = spark.createDataFrame([(f"p{i:02d}",) for i in range(10)], "page_id string")
    assert [r["shard"] for r in order.stride(df, 3).orderBy("page_id").collect()] == [i % 3 for i in range(10)]
