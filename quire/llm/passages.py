"""Exchange of recurring contexts: what the two substring dedups share.

Both ask, for every window of L units (bytes, or words) of every document, whether a document with a smaller id has it too.
Winnowing makes that an exchange of few keys: in every window the K-unit piece with the least hash is an anchor, so equal
windows hold equal anchors at equal places, and only about 2 in (L - K + 2) positions are anchors. Three passes:

1. Each block of documents sends its anchors' hashes, cut by hash range, and hears which ones other blocks have as well.
2. It sends the contexts (the union of all windows that hold the anchor) of the recurring ones; equal contexts of one block
   go once, with the smallest id. A shard has every context of its anchors and says which part of each is in a smaller id.
3. The block applies the answers to its documents.

Blocks are packed once, compressed, into the checkpoint folder, where they lie by their ids, so that no pass shuffles texts
again; messages are arrays, not rows. A block tells no more than FANOUT destinations apart: with more shards than that, relays
put the messages of RELAYED senders together and deal them out by the next digit of the shard, as often as it takes, and replies
go back the same way. So a message holds some hundred anchors at least, and messages grow with the anchors, not with
blocks times shards. An anchor that occurs too often for one task to hold its contexts is hot: they are cut into single
windows, keyed by their own hashes, so they spread over all shards and meet only what equals them. Nothing is dropped or
capped.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import partitions, settle

#: A block has so many bytes of text, or one document.
BLOCK_BYTES = 4 << 20
#: Anchors that a shard is sized for.
SHARD_ANCHORS = 1 << 20
#: Destinations that a sender tells apart, and senders whose messages a relay puts together.
FANOUT, RELAYED = 256, 512
#: An anchor with so many occurrences is hot.
HOT = 1 << 20
#: Ids that are null count as smaller than all others.
NULL_ID = -(1 << 63)

_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


#: Positions worked on at once, so that they stay in the processor's cache.
SLICE = 1 << 15


def minimizers(h: np.ndarray, ok: np.ndarray, width: int) -> np.ndarray:
    """Positions of the least of h (the first of several) in each run of `width` hashes; ok: runs that count."""
    low, out = np.uint64(2 * SLICE - 1), []
    places = np.arange(SLICE + width, dtype=np.uint64)
    for a in range(0, len(ok), SLICE):
        n = min(SLICE, len(ok) - a)
        key = h[a : a + n + width - 1] & ~low
        key |= places[: len(key)]
        span = 1
        while span * 2 <= width:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        if rest := width - span:
            key = np.minimum(key[:-rest], key[rest:])
        at = (key & low)[ok[a : a + n]].astype(np.int64)
        if len(at):
            out.append(at[np.r_[True, at[1:] != at[:-1]]] + a)
    found = np.concatenate(out) if out else np.zeros(0, np.int64)
    return found[np.r_[True, found[1:] != found[:-1]]] if len(found) else found


@dataclass
class Block:
    """Documents end to end. units: of documents; ends: unit at which each document ends."""

    ids: np.ndarray
    ends: np.ndarray
    data: bytes
    #: first and last byte of units lo and hi - 1, for pieces of data
    cut: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    #: hash of the K units from each position
    hashes: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.r_[0, self.ends[:-1]].astype(np.int64)


@dataclass
class Plan:
    """L and K in units; read makes a Block of (ids, texts); solve answers a shard's contexts."""

    window: int
    anchor: int
    read: Callable[[np.ndarray, list[bytes]], Block]
    #: (keys, smallest ids, units before the anchor, contexts' bytes) -> lo, hi: the units that a smaller id's context has too
    solve: Callable[..., tuple[np.ndarray, np.ndarray]]


def _squeeze(*arrays: np.ndarray | bytes) -> bytes:
    parts = [a if isinstance(a, bytes) else a.tobytes() for a in arrays]
    head = np.array([len(p) for p in parts], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head, *parts]))


def _open(blob: bytes, *kinds: type) -> list:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes, at, out = np.frombuffer(raw[: 8 * len(kinds)], np.int64), 8 * len(kinds), []
    for n, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(raw[at : at + n] if kind is bytes else np.frombuffer(raw[at : at + n], kind))
        at += n
    return out


def _planes(x: np.ndarray, width: int) -> np.ndarray:
    """Sorted numbers as differences, byte by byte: what compresses lies together."""
    d = np.diff(x, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return np.ascontiguousarray(d.T)


def _unplanes(raw: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((raw.size // width, 8), np.uint8)
    out[:, :width] = raw.reshape(width, -1).T
    return np.cumsum(out.view("<u8")[:, 0], dtype=np.uint64)


def pack(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """bytes, blob, uid: blocks of documents as (ids, lengths, texts), in the checkpoint folder."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias("text"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[bytes] = []
        size = 0

        def row() -> pa.RecordBatch:
            blob = _squeeze(np.array([NULL_ID if i is None else i for i in ids], np.int64), np.array([i is None for i in ids]), np.array([len(t) for t in texts], np.int64), b"".join(texts))
            return pa.RecordBatch.from_arrays([pa.array([size], pa.int64()), pa.array([blob], pa.binary())], names=["bytes", "blob"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids.append(i)
                texts.append(t := t.as_py())
                size += len(t)
                if size >= BLOCK_BYTES or len(ids) >= 1 << 16:
                    yield row()
                    ids, texts, size = [], [], 0
        if ids:
            yield row()

    packed = rows.mapInArrow(blocks, "bytes long, blob binary").withColumn("uid", F.monotonically_increasing_id())
    # kept by the id from here on: a stored table's partitioning is known, and its side of a cogroup is not shuffled
    return settle(packed.repartition(max(partitions(docs.sparkSession, 0, 1), rows.rdd.getNumPartitions()), "uid"), partitioned=True)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    ids, null, sizes, raw = _open(blob, np.int64, np.bool_, np.int64, bytes)
    ends = np.cumsum(sizes).tolist()
    return ids, null, [raw[b - n : b] for b, n in zip(ends, sizes.tolist(), strict=True)]


def _anchors(block: Block, plan: Plan) -> np.ndarray:
    n = int(block.ends[-1]) if len(block.ends) else 0
    if n < plan.window:
        return np.zeros(0, np.int64)
    ok = np.ones(n - plan.window + 1, np.bool_)
    cross = np.zeros(n + 1, np.int32)  # windows that reach into the next document
    a = np.maximum(block.ends - plan.window + 1, block.starts)
    np.add.at(cross, a, 1)
    np.add.at(cross, block.ends, -1)
    ok &= np.cumsum(cross, dtype=np.int32)[: len(ok)] == 0
    return minimizers(block.hashes, ok, plan.window - plan.anchor + 1)


def _short(h: np.ndarray) -> np.ndarray:
    return mixed(h) >> np.uint64(16)


def _shard(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key >> np.uint64(16)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


@dataclass
class Route:
    """How messages reach the shards: by one digit of the shard's number after the other, each less than its width.

    labels: what blocks call their destinations, and relays their first digit's.
    """

    widths: list[int]
    labels: list[int]

    @property
    def shards(self) -> int:
        return math.prod(self.widths)

    def towards(self, key: np.ndarray, level: int = 0) -> np.ndarray:
        """The digits of the keys' shards up to a level, as one number."""
        return _shard(key, self.shards) // math.prod(self.widths[level + 1 :])


def route(spark: SparkSession, shards: int, fanout: int) -> Route:
    levels = 1
    while fanout**levels < shards:
        levels += 1
    width = next(w for w in range(max(1, int(shards ** (1 / levels)) - 1), shards + 1) if w**levels >= shards)
    return Route([width] * levels, spread(spark, width) if levels == 1 else list(range(width)))


@dataclass
class Entries:
    """A block's contexts: of each distinct one the shard's key, the smallest id and its bytes; of each occurrence which it is."""

    key: np.ndarray
    least: np.ndarray
    left: np.ndarray
    at: np.ndarray
    to: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    of: np.ndarray
    first: np.ndarray


def _entries(block: Block, plan: Plan, flags: dict[int, np.ndarray], way: Route) -> Entries:
    pos = _anchors(block, plan)
    short = _short(block.hashes[pos])
    doc = np.searchsorted(block.ends, pos, side="right")
    order = np.argsort(short, kind="stable")
    ranked = short[order]
    new = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, np.int64)
    known, each = ranked[new], np.diff(np.r_[new, len(ranked)])
    said = np.zeros(len(known), np.uint8)
    part = way.towards(known)
    for s, f in flags.items():
        said[part == s] = f
    ids = block.ids[doc[order]]
    if len(ids):  # also what several documents of this block hold
        said[(said == 0) & (np.minimum.reduceat(ids, new) < np.maximum.reduceat(ids, new))] = 1
    kind = np.zeros(len(pos), np.uint8)
    kind[order] = np.repeat(said, each)
    pos, doc, short = pos[kind > 0], doc[kind > 0], short[kind > 0]
    hot = kind[kind > 0] == 2
    lo = np.maximum(pos + plan.anchor - plan.window, block.starts[doc])
    hi = np.minimum(pos + plan.window, block.ends[doc])
    left = pos - lo
    if hot.any():  # every window by itself
        n = (hi - lo - plan.window + 1)[hot]
        each = np.repeat(np.flatnonzero(hot), n)
        start = lo[each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
        keep = ~hot
        lo, hi = np.r_[lo[keep], start], np.r_[hi[keep], start + plan.window]
        doc, left = np.r_[doc[keep], doc[each]], np.r_[left[keep], np.zeros(len(each), np.int64)]
        short = np.r_[short[keep], np.zeros(len(each), np.uint64)]
        hot = np.r_[np.zeros(keep.sum(), np.bool_), np.ones(len(each), np.bool_)]
    a, b = block.cut(lo, hi)
    c = (hi - lo).astype(np.uint64) * np.uint64(1 << 16) + left.astype(np.uint64)
    for t in range(0, 2 * plan.window - plan.anchor, plan.anchor):  # pieces that together are the whole context
        c = mixed(c * np.uint64(31) + block.hashes[np.minimum(lo + t, hi - plan.anchor)])
    key = np.where(hot, mixed(c) >> np.uint64(16), short)
    ids = block.ids[doc]
    order = np.lexsort((ids, c, key))
    key, c, ids = key[order], c[order], ids[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (c[1:] != c[:-1])] if len(key) else np.zeros(0, np.bool_)
    pick = order[new]
    return Entries(key[new], ids[new], left[pick], a[pick], b[pick], lo[order], hi[order], np.cumsum(new) - 1, ids == ids[new][np.cumsum(new) - 1] if len(key) else new)


def _parts(part: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal numbers."""
    cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else [0]
    for a, b in zip(cut, cut[1:], strict=False):
        yield int(part[a]), slice(int(a), int(b))


def _batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(3)], names=list(names))


#: A message from a block or relay (uid) to a shard or relay, or a reply to it.
MESSAGE = "uid long, shard long, blob binary"
NAMES = ("uid", "shard", "blob")
#: What messages and replies hold: keys as planes, then numbers of each entry; contexts have their sizes and bytes last.
HASHES, CONTEXTS, FLAGS, RANGES = (np.uint8, np.uint32), (np.uint8, np.int64, np.uint16, np.int32, bytes), (np.uint8,), (np.uint16, np.uint16)


def spread(spark: SparkSession, n: int) -> list[int]:
    """n labels that Spark's hash partitioning deals to n different partitions, in their order: a shard is then a task."""
    found, upto = {}, 8 * n
    while len(found) < n:
        upto *= 2
        rows = spark.range(upto).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id").alias("id")).collect()
        found = {r["p"]: r["id"] for r in rows}
    return [found[p] for p in range(n)]


def _message(key: np.ndarray, *numbers: np.ndarray | bytes) -> bytes:
    return _squeeze(_planes(key, 6), *numbers)


def _put_together(blobs: list[bytes], kinds: tuple) -> tuple[np.ndarray, list[np.ndarray], list[bytes], np.ndarray]:
    """Keys, numbers and (for contexts) bytes of all entries of some messages, and which message each is of."""
    got = [_open(x, *kinds) for x in blobs]
    keys = [_unplanes(g[0], 6) for g in got]
    numbers = [np.concatenate([g[i] for g in got]) for i in range(1, len(kinds)) if kinds[i] is not bytes]
    pieces: list[bytes] = []
    if kinds[-1] is bytes:
        text, ends = b"".join(g[-1] for g in got), np.cumsum(numbers[-1], dtype=np.int64).tolist()
        pieces = [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    return np.concatenate(keys), numbers, pieces, np.repeat(np.arange(len(keys)), [len(k) for k in keys])


def _relay(table: pa.Table, kinds: tuple, way: Route, level: int) -> pa.Table:
    """Messages of several senders to one destination, as messages by the next digit; and a memo of whose entries these are."""
    order = np.argsort(table.column("uid").to_numpy(), kind="stable").tolist()
    senders, blobs = [table.column("uid")[i].as_py() for i in order], [table.column("blob")[i].as_py() for i in order]
    key, numbers, pieces, of = _put_together(blobs, kinds)
    by = np.lexsort((of, key))
    key, numbers, of = key[by], [x[by] for x in numbers], of[by]
    relay, to = table.column("relay")[0].as_py(), table.column("shard")[0].as_py()
    rows = [(relay, to, _squeeze(np.array(senders, np.int64), of.astype(np.uint16)))]
    for child, at in _parts(way.towards(key, level)):
        rows.append((relay, child, _message(key[at], *(x[at] for x in numbers), *([b"".join([pieces[i] for i in by[at].tolist()])] if pieces else []))))
    memo = pa.array([True] + [False] * (len(rows) - 1))
    return pa.Table.from_batches([_batch(rows, NAMES)]).append_column("memo", memo)


def _hand_back(replies: pa.Table, memo: pa.Table, kinds: tuple) -> pa.Table:
    """Replies to a relay's messages, as replies to the messages that it had put together."""
    rows = []
    if replies.num_rows:
        order = np.argsort(replies.column("shard").to_numpy(), kind="stable").tolist()
        got = [_open(replies.column("blob")[i].as_py(), *kinds) for i in order]
        numbers = [np.concatenate([g[i] for g in got]) for i in range(len(kinds))]
        senders, of = _open(memo.column("blob")[0].as_py(), np.int64, np.uint16)
        by = np.argsort(of, kind="stable")
        for i, at in _parts(of[by]):
            rows.append((int(senders[i]), memo.column("shard")[0].as_py(), _squeeze(*(x[by[at]] for x in numbers))))
    return pa.Table.from_batches([_batch(rows, NAMES)])


def _exchange(messages: DataFrame, kinds: tuple, replies: tuple, answer: Callable[[pa.Table], pa.Table], way: Route, blocks: int, relayed: int) -> DataFrame:
    """Replies to the messages of so many blocks. answer: all messages to a shard to its replies."""
    memos, relay = [], lambda level: lambda t: _relay(t, kinds, way, level)
    for level in range(1, len(way.widths)):
        ranges = -(-blocks // relayed)
        dealt = messages.withColumn("relay", F.col("shard") * ranges + F.pmod(F.xxhash64("uid"), F.lit(ranges)))
        rows = settle(dealt.groupBy("relay").applyInArrow(relay(level), MESSAGE + ", memo boolean"))
        memos.append(rows.where("memo").drop("memo"))
        messages, blocks = rows.where("NOT memo").drop("memo"), ranges
    out = messages.repartition(way.shards, "shard").groupBy("shard").applyInArrow(answer, MESSAGE)
    for memo in reversed(memos):
        out = out.groupBy("uid").cogroup(memo.groupBy("uid")).applyInArrow(lambda r, m: _hand_back(r, m, replies), MESSAGE)
    return out


def _send_hashes(batches: Iterator[pa.RecordBatch], plan: Plan, way: Route) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for uid, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            ids, _, texts = unpack(blob.as_py())
            block = plan.read(ids, texts)
            key, often = np.unique(_short(block.hashes[_anchors(block, plan)]), return_counts=True)
            if rows := [(uid, way.labels[s], _message(key[at], often[at].astype(np.uint32))) for s, at in _parts(way.towards(key))]:
                yield _batch(rows, NAMES)


def _answer_hashes(table: pa.Table, hot: int) -> pa.Table:
    uid, shard = table.column("uid").to_pylist(), table.column("shard").to_pylist()
    key, (times,), _, of = _put_together([x.as_py() for x in table.column("blob")], HASHES)
    known, at, blocks = np.unique(key, return_inverse=True, return_counts=True)
    often = np.bincount(at, times, len(known))
    flag = np.where(often >= hot, 2, np.where(blocks > 1, 1, 0)).astype(np.uint8)[at]
    return pa.Table.from_batches([_batch([(uid[i], shard[i], _squeeze(flag[part])) for i, part in _parts(of)], NAMES)])


def _replies(table: pa.Table, kind: int, way: Route) -> dict[int, bytes]:
    """Replies of one pass to a block, by the destination that they come from."""
    number = {label: s for s, label in enumerate(way.labels)}
    return {number[s]: x.as_py() for s, x, k in zip(table.column("shard").to_pylist(), table.column("blob"), table.column("kind").to_pylist(), strict=True) if k == kind}


def _flags(table: pa.Table, way: Route) -> dict[int, np.ndarray]:
    return {s: _open(x, *FLAGS)[0] for s, x in _replies(table, 0, way).items()}


def _send_contexts(blocks: pa.Table, said: pa.Table, plan: Plan, way: Route) -> pa.Table:
    rows = []
    for uid, blob in zip(blocks.column("uid").to_pylist(), blocks.column("blob"), strict=True):
        ids, _, texts = unpack(blob.as_py())
        block = plan.read(ids, texts)
        e = _entries(block, plan, _flags(said, way), way)
        size, data = (e.to - e.at).astype(np.int32), block.data
        for s, at in _parts(way.towards(e.key)):
            text = b"".join(data[x:y] for x, y in zip(e.at[at].tolist(), e.to[at].tolist(), strict=True))
            rows.append((uid, way.labels[s], _message(e.key[at], e.least[at], e.left[at].astype(np.uint16), size[at], text)))
    return pa.Table.from_batches([_batch(rows, NAMES)])


def _answer_contexts(table: pa.Table, plan: Plan) -> pa.Table:
    uid, shard = table.column("uid").to_pylist(), table.column("shard").to_pylist()
    key, (least, left, _), contexts, of = _put_together([x.as_py() for x in table.column("blob")], CONTEXTS)
    lo, hi = (x.astype(np.uint16) for x in plan.solve(key, least, left.astype(np.int64), contexts))
    return pa.Table.from_batches([_batch([(uid[i], shard[i], _squeeze(lo[part], hi[part])) for i, part in _parts(of)], NAMES)])


def _apply(blob: bytes, said: pa.Table, plan: Plan, way: Route) -> tuple[np.ndarray, np.ndarray, Block, np.ndarray]:
    """ids, null ids, the block and for each of its units whether it goes."""
    ids, null, texts = unpack(blob)
    block = plan.read(ids, texts)
    e = _entries(block, plan, _flags(said, way), way)
    lo, hi = np.zeros(len(e.key), np.int64), np.zeros(len(e.key), np.int64)
    replies = _replies(said, 1, way)
    for s, at in _parts(way.towards(e.key)):
        lo[at], hi[at] = _open(replies[s], *RANGES)
    a = np.where(e.first, e.lo + lo[e.of], e.lo)  # other documents of the block have a smaller one's context
    b = np.where(e.first, e.lo + hi[e.of], e.hi)
    n = int(block.ends[-1]) if len(block.ends) else 0
    cover = np.bincount(a, minlength=n + 1) - np.bincount(b, minlength=n + 1)
    return ids, null, block, np.cumsum(cover)[:n] > 0


def remove_recurring(docs: DataFrame, plan: Plan, finish: Callable, schema: str, id_col: str, text_col: str, units_per_byte: float, hot: int = HOT, shard_anchors: int = SHARD_ANCHORS, fanout: int = FANOUT, relayed: int = RELAYED) -> DataFrame:
    """finish(ids, null ids, block, gone) -> a record batch of schema, over all blocks."""
    spark = docs.sparkSession
    blocks = pack(docs, id_col, text_col)
    total = blocks.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n"), F.count("*").alias("k")).first()
    way = route(spark, partitions(spark, int(total["n"] * units_per_byte * 2 / (plan.window - plan.anchor + 2)), shard_anchors), fanout)
    text = blocks.select("uid", "blob")
    hashes = text.mapInArrow(lambda it: _send_hashes(it, plan, way), MESSAGE)
    flags = _exchange(hashes, HASHES, FLAGS, lambda t: _answer_hashes(t, hot), way, total["k"], relayed)
    flags = settle(flags.withColumn("kind", F.lit(0)))
    contexts = text.groupBy("uid").cogroup(flags.groupBy("uid")).applyInArrow(lambda b, s: _send_contexts(b, s, plan, way), MESSAGE)
    replies = _exchange(contexts, CONTEXTS, RANGES, lambda t: _answer_contexts(t, plan), way, total["k"], relayed)
    said = flags.unionByName(settle(replies.withColumn("kind", F.lit(1))))  # settled: the contexts' files go before the last pass

    def apply(b: pa.Table, s: pa.Table) -> pa.Table:
        return pa.Table.from_batches([finish(*_apply(x.as_py(), s, plan, way)) for x in b.column("blob")])

    return text.groupBy("uid").cogroup(said.groupBy("uid")).applyInArrow(apply, schema)
