"""Filters: what they hold they find, and little else; what they do not hold is not shuffled."""

from pyspark.sql import functions as F

from quire.llm import bit_filter, exact_dedup


def test_filters_hold_their_keys(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"))
    bits = bit_filter.bits_for(20_000)
    filters = bit_filter.build(keys, "k", bits)
    assert all(f.count() <= bits // 8192 for f in filters)
    probed = bit_filter.probe(spark.range(200_000).select("id", F.concat(F.lit("k"), "id").alias("k")), filters, F.col("k"), bits, "maybe")
    held, others = probed.where("id < 20000 AND maybe").count(), probed.where("id >= 20000 AND maybe").count()
    assert held == 20_000 and others < 0.01 * 180_000 and probed.columns == ["id", "k", "maybe"]


def test_filters_of_repeated_keys(spark):
    keys = spark.range(30_000).select(F.when(F.col("id") < 20_000, F.col("id")).otherwise(F.col("id") - 10_000).alias("k"))  # 10,000 to 19,999 twice
    bits = bit_filter.bits_for(30_000)
    probed = bit_filter.probe(keys, bit_filter.build(keys, "k", bits, least=2), F.col("k"), bits, "maybe")
    assert probed.where("k >= 10000 AND maybe").count() == 20_000 and probed.where("k < 10000 AND maybe").count() < 200


def test_without(spark):
    rows = spark.createDataFrame([(i, "x") for i in range(100)] + [(None, "y"), (7, "again")], "id long, maybe string")
    gone = spark.createDataFrame([(7,), (None,), (500,)], "id long")
    assert {r["id"] for r in bit_filter.without(rows, "id", gone).collect()} == {*range(100), None} - {7}
    out = bit_filter.without(rows, "id", gone, nulls=True)
    assert {r["id"] for r in out.collect()} == {*range(100)} - {7} and out.columns == rows.columns
    assert sorted((r["id"] is None, r["id"] or 0) for r in bit_filter.semi(rows, "id", gone).collect()) == [(False, 7), (False, 7), (True, 0)]
    assert bit_filter.without(rows, "id", gone.limit(0)).count() == 102


def test_unique_rows_are_not_shuffled(spark):
    """Of many unique texts and a few copies, hardly more than the copies reach the join with their groups."""
    docs = spark.range(100_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.when(F.col("id") % 1000 == 0, 0).otherwise(F.col("id"))).alias("text"))
    out = exact_dedup.exact_dedup(docs)
    out.write.format("noop").mode("overwrite").save()
    assert out.where("NOT kept").count() == 99
    joined = out._jdf.queryExecution().executedPlan()
    sizes, todo = [], [joined]
    while todo:
        node = todo.pop()
        node = node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.plan() if node.nodeName().endswith("QueryStage") else node
        if node.nodeName() == "Exchange":
            sizes.append(node.metrics().apply("shuffleRecordsWritten").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    out.collect()
    assert all(n < 2000 for n in sizes)
