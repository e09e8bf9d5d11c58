"""Exact dedup by two-pass Bloom filtering, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import bit_filter
from quire.llm.common import OWN, SPACE, settle, text_of, with_columns

VERDICT = ("keep_id", "group_size", "kept", "text_sha256")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_per_row: int = bit_filter.BITS_PER_ROW, max_filter_bits: int = bit_filter.MAX_BITS) -> DataFrame:
    """Every row of docs with keep_id, group_size, kept and text_sha256.

    Texts are equal if identical once each run of white space is one space; of equal texts the smallest id stays. The first
    pass reads hashes alone: two Bloom filters record which bits were hit twice, and only hashes whose bits are set in both
    meet their group in a shuffle. What is truly repeated makes the filters of the second pass, over the rows: only rows
    that these hold meet their group in a shuffle, the rest pass where they are read.

    Filters follow the counts of rows and of groups up to max_filter_bits. Past that more unique hashes (not texts) shuffle in
    the first pass; unique rows shuffle only once the groups themselves outgrow the second pass's filters. Either costs
    time and changes no result. Groups of any size are counted with map-side sums, and the join back is an ordinary
    equi-join whose hot keys Spark splits.

    Null text counts as empty, and texts are hashed whole, however long. Rows with the same id and text (repeated rows) are
    one document: they share keep_id and kept. Null ids give way to any other; in a group of null ids only, all stay. An
    empty table gives an empty result. Columns of docs with the names of the verdict's give way to them.
    """
    own, key, maybe = F.col(f"`{id_col}`"), OWN + "sha", OWN + "maybe"
    sha = F.sha2(F.regexp_replace(text_of(text_col), SPACE, " "), 256)
    digests = settle(docs.select(own.alias(OWN + "id"), sha.alias(key)))
    bits = bit_filter.bits_for(digests.count(), bits_per_row, max_filter_bits)
    twice = bit_filter.build(digests, key, bits, least=2)
    groups = bit_filter.probe(digests, twice, F.col(key), bits, maybe).where(maybe).groupBy(key).agg(F.min(OWN + "id").alias(OWN + "keep"), F.count("*").alias(OWN + "size"))
    groups = settle(groups.where(f"{OWN}size > 1"))  # then both sides of the join are shuffled for it alone, and Spark may split a hot key
    bits = bit_filter.bits_for(groups.count(), bits_per_row, max_filter_bits)
    rows = bit_filter.probe(docs.withColumn(key, sha), bit_filter.build(groups, key, bits), F.col(key), bits, maybe)
    alone = rows.where(f"NOT {maybe}").withColumns({OWN + "keep": own, OWN + "size": F.lit(1).cast("long")})
    together = rows.where(maybe).join(groups, key, "left").withColumns({OWN + "keep": F.coalesce(OWN + "keep", own), OWN + "size": F.coalesce(OWN + "size", F.lit(1).cast("long"))})
    both = alone.unionByName(together)
    out = with_columns(both, dict(zip(VERDICT, (F.col(OWN + "keep"), F.col(OWN + "size"), own.eqNullSafe(F.col(OWN + "keep")), F.col(key)), strict=True)))
    return out.select(*(f"`{c}`" for c in out.columns if not c.startswith(OWN)))


ORACLE = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)
"""
