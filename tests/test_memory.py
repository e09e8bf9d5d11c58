"""Levels of long texts: a batch is never whole in Python's own memory."""

import tracemalloc

import pyarrow as pa
import pytest

from quire.functions import text as X


@pytest.mark.parametrize("level", [X.skeleton, X.diacritic_insensitive])
def test_levels_take_few_texts_at_once(level):
    texts = pa.array([None] + [f"é {i} " * 2000 for i in range(2000)])
    tracemalloc.start()
    got = level.func(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == 2001 and got[0].as_py() is None and most < 8 << 20  # the texts are 30 MB and more


def test_levels_in_a_query(spark):
    rows = spark.createDataFrame([(1, "A,  b"), (2, None), (3, "")], "i int, t string").select("i", X.skeleton("t").alias("s"), X.diacritic_insensitive("t").alias("d")).orderBy("i").collect()
    assert [tuple(r) for r in rows] == [(1, "A b", "A,  b"), (2, None, None), (3, "", "")]
