"""The pipeline's stages against what they may keep."""

import re
from collections import defaultdict

import corpus_pipeline
from quire.llm import decontam, quality
from quire.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.test_similar import slow_kept


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, rows = docs.columns, [r.asDict() for r in docs.collect()]
    labels, bench = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    good = {r["id"] for r in quality.quality_scores(docs, labels).where("predicted = 1").collect()}
    want = [r for r in rows if r["doc_id"] in good]
    groups = defaultdict(list)
    for r in want:
        groups[re.sub("[\x20\x09-\x0d]+", " ", r["text"] or "")].append(r)
    exact = [min(g, key=lambda r: r["doc_id"]) for g in groups.values()]
    held = slow_kept(sorted((r["doc_id"], r["text"]) for r in exact))
    near = [r for r in exact if r["doc_id"] in held]
    leaked = {r["id"] for r in decontam.contaminated(docs, bench).collect()}
    clean = [r for r in near if r["doc_id"] not in leaked]
    now = docs
    for (_, stage), kept in zip(corpus_pipeline.STAGES, (want, exact, near, clean), strict=False):
        out = stage(spark, now, sf)
        assert out.columns == columns
        assert sorted(r["doc_id"] for r in out.collect()) == sorted(r["doc_id"] for r in kept)
        now = spark.createDataFrame(kept, docs.schema)
    mixed = corpus_pipeline.run(spark, sf)
    assert sorted(r["doc_id"] for r in mixed.collect()) == sorted(r["doc_id"] for r in clean)
    assert mixed.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]


def test_stages_on_odd_rows(spark, odd, nothing, sf):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            assert name == "source mixing" or out.columns == docs.columns
            assert out.count() <= docs.count()


def test_what_odd_rows_become(spark, odd, sf):
    """Nulls, blank and long texts, equal ones, repeated rows: exactly these rows stay."""
    ids = lambda df: sorted((r["doc_id"] for r in df.collect()), key=lambda x: (x is None, x))
    every = ids(odd)
    assert ids(corpus_pipeline.drop_exact_copies(spark, odd, sf)) == [1, 3, 5, 6, 8, 9, 9, 10, 11]
    assert ids(corpus_pipeline.drop_near_copies(spark, odd, sf)) == [1, 3, 6, 8, 9, 9, 10, 11, None, None]
    assert ids(corpus_pipeline.drop_benchmark_leaks(spark, odd, sf)) == every
    good = sorted((r["id"] for r in quality.quality_scores(odd, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 1").collect()), key=lambda x: (x is None, x))
    assert ids(corpus_pipeline.keep_quality(spark, odd, sf)) == good
    mixed = corpus_pipeline.mix_sources(spark, odd, sf)
    assert ids(mixed) == every and all(r["taken"] == 0 for r in mixed.where("size = 0").collect())


def test_clean_documents_stay(spark, sf):
    """No document that labels call good, that is no copy and holds no benchmark passage, is lost."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.keep_quality(spark, docs, "/root/testdata/sf0.01").collect()}
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    assert len(good - kept) <= 0.01 * len(good)


def test_registered():
    assert [sum(n.startswith(f"op{k}_") for n in QUERIES) for k in range(1, 14)] == [1] * 13
    assert set(ORACLE_SQL) <= set(QUERIES)
