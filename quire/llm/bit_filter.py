"""Bloom filters as small tables: built by map-side sums, probed by a broadcast join, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import OWN, settle

BITS_PER_ROW = 16
#: A filter's bound, whatever the input's size: 128 MB of bits, of which each executor holds one copy.
MAX_BITS = 1 << 30
#: Longs in a row of a filter.
WIDTH = 128
_ROW_BITS = 64 * WIDTH


def bits_for(rows: int, bits_per_row: int = BITS_PER_ROW, most: int = MAX_BITS) -> int:
    """Bits of a filter for so many rows, a power of two of one row of the table at least."""
    return max(_ROW_BITS, min(most, 1 << max(0, rows * bits_per_row - 1).bit_length()))


def _slot(key: Column, k: int, bits: int) -> Column:
    """The bit of filter k that a key sets."""
    return F.pmod(F.xxhash64(key, F.lit(k)), F.lit(bits))


def build(keys: DataFrame, key: str, bits: int, filters: int = 2, least: int = 1) -> list[DataFrame]:
    """Filters of the keys (a column of the given name) whose bits are hit `least` times or more, in the checkpoint folder.

    Each is a table of (row, longs) with at most bits / 8192 rows of 1 kB.
    """
    out = []
    for k in range(filters):
        hits = keys.groupBy(_slot(F.col(key), k, bits).alias("slot"))
        slots = hits.count().where(F.col("count") >= least) if least > 1 else hits.agg(F.lit(1))
        words = slots.groupBy(F.expr("slot div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("b"))
        longs = F.map_from_entries(F.collect_list(F.struct(F.expr(f"cast(word % {WIDTH} as int)"), F.col("b"))))  # WIDTH entries at most
        rows = words.groupBy(F.expr(f"word div {WIDTH}").alias(f"{OWN}row{k}")).agg(longs.alias("m"))
        out.append(settle(rows.select(f"{OWN}row{k}", F.expr(f"transform(sequence(0, {WIDTH - 1}), i -> coalesce(try_element_at(m, i), 0L))").alias(f"{OWN}longs{k}"))))
    return out


def probe(rows: DataFrame, filters: Sequence[DataFrame], key: Column, bits: int, name: str) -> DataFrame:
    """rows with a column `name`: false only if no key of the filters is this one."""
    held = F.lit(True)
    for k, f in enumerate(filters):
        rows = rows.withColumn(f"{OWN}slot{k}", _slot(key, k, bits)).withColumn(f"{OWN}at{k}", F.expr(f"{OWN}slot{k} div {_ROW_BITS}"))
        rows = rows.join(F.broadcast(f), F.col(f"{OWN}at{k}") == F.col(f"{OWN}row{k}"), "left")  # bits / 8 bytes, MAX_BITS at most
        held = held & F.expr(f"coalesce(shiftrightunsigned({OWN}longs{k}[cast(({OWN}slot{k} div 64) % {WIDTH} as int)], cast({OWN}slot{k} % 64 as int)) & 1L, 0L) = 1L")
    made = [f"{OWN}{c}{k}" for k in range(len(filters)) for c in ("slot", "at", "row", "longs")]
    return rows.withColumn(name, held).drop(*made)


def without(rows: DataFrame, id_col: str, gone: DataFrame, nulls: bool = False) -> DataFrame:
    """Rows whose id is not in gone (a column of ids that differ; a null one counts only with `nulls`).

    Rows that a filter of the ids does not hold pass where they are read; only the others meet the ids in a shuffle.
    """
    gone = settle(gone.select(F.col(gone.columns[0]).alias(OWN + "gone")))
    key, bits, maybe = F.col(f"`{id_col}`").cast("string"), bits_for(gone.count()), OWN + "maybe"
    filters = build(gone.select(F.col(OWN + "gone").cast("string").alias("id")), "id", bits)
    probed = probe(rows, filters, key, bits, maybe)
    own, other = F.col(f"`{id_col}`"), F.col(OWN + "gone")
    left = probed.where(maybe).join(gone, own.eqNullSafe(other) if nulls else own == other, "left_anti")
    return probed.where(f"NOT {maybe}").unionByName(left).drop(maybe)


def semi(rows: DataFrame, id_col: str, wanted: DataFrame) -> DataFrame:
    """Rows whose id is in wanted (a column of ids that differ, null ones too); only those that a filter holds are shuffled."""
    wanted = settle(wanted.select(F.col(wanted.columns[0]).alias(OWN + "wanted")))
    bits, maybe = bits_for(wanted.count()), OWN + "maybe"
    filters = build(wanted.select(F.col(OWN + "wanted").cast("string").alias("id")), "id", bits)
    probed = probe(rows, filters, F.col(f"`{id_col}`").cast("string"), bits, maybe).where(maybe).drop(maybe)
    return probed.join(wanted, F.col(f"`{id_col}`").eqNullSafe(F.col(OWN + "wanted")), "left_semi")
