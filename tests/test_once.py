"""Scores are dear: what uses them twice computes them once."""

import pytest
from pyspark.sql import functions as F

from quire.operators import contrast, rollups


@pytest.fixture
def counted(spark):
    """A function that gives deltas or scores, and a counter of the rows that were computed."""
    n = spark.sparkContext.accumulator(0)

    def counting(batches):
        for b in batches:
            n.add(b.num_rows)
            yield b

    return n, lambda df: df.mapInArrow(counting, df.schema)


USES = {"regressions": contrast.regressions, "improvements": contrast.improvements, "bootstrap": lambda d: contrast.bootstrap(d, 50), "bootstrap_scalable": lambda d: contrast.bootstrap_scalable(d, 50)}


@pytest.mark.parametrize("use", USES)
def test_deltas_are_computed_once(spark, counted, use):
    n, through = counted
    deltas = through(spark.range(40).selectExpr("concat('p', id) AS page_id", "concat('s', id % 2) AS split", "(id % 7 - 3) / 10.0D AS delta_cer").repartition(4))
    rows = USES[use](deltas).collect()
    assert rows and n.value == 40


def test_breakdowns_score_once(spark, counted):
    n, through = counted
    counts = "named_struct('strict', named_struct('char_edits', int(id), 'ref_chars', 100, 'word_edits', 1, 'ref_words', 9, 'exact_match', false)) AS metrics"
    scores = through(spark.range(30).selectExpr("concat('p', id) AS page_id", "'s' AS split", "array('f') AS fonts", "array(concat('d', id % 9)) AS distortions", "'a' AS source", counts).repartition(3))
    rows = {(r["dimension"], r["key"]): r["pages"] for r in rollups.breakdowns(scores, 4).collect()}
    assert rows[("font", "f")] == 30 and rows[("distortion", "__sparse__")] == 18 and n.value == 30
