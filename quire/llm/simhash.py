"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import bit_filter
from quire.llm.common import partitions, settle, stored
from quire.llm.components import connected_components

SEED = 42
#: Words of the shingles whose sets tell how similar two texts are.
SET_SHINGLE = 5
#: A bucket of more fingerprints is cut by further bits if it does not fall into few components.
SPLIT = 2048


def _shingles(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of every run of `shingle` words (of all words, if there are fewer); lower case, joined by a space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and white space of ASCII only
    if not words:
        return np.zeros(0, np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    joined, ends, k = b" ".join(words), np.cumsum(size + 1), min(shingle, len(words))
    of, starts, cuts = xxhash.xxh64_intdigest, (ends - size - 1).tolist(), (ends - 1).tolist()[k - 1 :]
    return np.fromiter((of(joined[a:b], SEED) for a, b in zip(starts, cuts, strict=False)), np.uint64, len(cuts))


def _majority(h: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits; a bit is 1 if over half the shingles' XXH64 have it. No words: 0."""
    return _majority(_shingles(text, shingle))


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1)-1 masks of 64 bits: any two words that differ in `radius` bits or fewer agree under one of them.

    Bit i carries a nonzero vector m(i) of radius+1 bits, and mask v keeps the bits with odd <m(i), v>. `radius` vectors
    cannot span all radius+1 dimensions, so some v is orthogonal to every differing bit: that mask hides them all.
    """
    size = 1 << (radius + 1)
    vectors = [1 + i % (size - 1) for i in range(64)]
    return [sum(1 << i for i, m in enumerate(vectors) if bin(m & v).count("1") % 2) for v in range(1, size)]


def _outward(x: np.ndarray, radius: int, work: int) -> list[tuple[np.ndarray, int]] | None:
    """Components of distinct words, found outward from their first members: (others, first). None: more work than that.

    What has been reached is not looked at again, so a bucket of near copies takes a few passes, and gives no more links than
    it has words.
    """
    out, left = [], np.arange(len(x))
    while len(left):
        root, left, todo = int(left[0]), left[1:], [int(left[0])]
        while todo and len(left):
            work -= len(left)
            if work < 0:
                return None
            hit = np.bitwise_count(x[todo.pop()] ^ x[left]) <= radius
            if hit.any():
                out.append((left[hit], root))
                todo += left[hit].tolist()
                left = left[~hit]
    return out


def bucket_links(x: np.ndarray, radius: int, free: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (others, firsts) that connect all of the distinct words x that links within `radius` bits connect.

    free: the bits in which words may differ. A large bucket without a few large components is cut: of radius + 1 parts of the free
    bits, two near words agree in one, so the words that agree in a part are buckets of their own, with fewer free bits. A
    bucket of b free bits has at most 2^b words, so this ends.
    """
    heads, tails, todo = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [(np.arange(len(x)), free)]
    while todo:
        at, free = todo.pop()
        found = _outward(x[at], radius, len(at) * (len(at) if len(at) <= SPLIT else 64))
        if found is not None:
            for others, first in found:
                heads.append(at[others])
                tails.append(np.full(len(others), at[first]))
            continue
        bits = [i for i in range(64) if free >> i & 1]
        for k in range(radius + 1):
            part = sum(1 << i for i in bits[k :: radius + 1])
            key = x[at] & np.uint64(part)
            order = np.argsort(key, kind="stable")
            cut = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1], True])
            todo += [(at[order[a:b]], free & ~part) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True) if b - a > 1]
    return np.concatenate(heads), np.concatenate(tails)


def _in_buckets(batches: Iterator[pa.RecordBatch], masks: list[int], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (v, fp) of whole buckets to links (a, b) between fingerprints."""
    got = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches]
    if not got:
        return
    v, x = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got]).view(np.uint64)
    key = x & np.array(masks, np.uint64)[v]
    order = np.lexsort((x, key, v))
    v, x, key = v[order], x[order], key[order]
    cut = np.flatnonzero(np.r_[True, (v[1:] != v[:-1]) | (key[1:] != key[:-1]), True])
    size, heads, tails = np.diff(cut), [], []
    for m in np.unique(size[(size > 1) & (size <= 8)]):  # small buckets of one size at once
        block = cut[:-1][size == m][:, None] + np.arange(m)
        for i in range(m):
            for j in range(i + 1, m):
                hit = np.bitwise_count(x[block[:, i]] ^ x[block[:, j]]) <= radius
                heads.append(block[hit, j])
                tails.append(block[hit, i])
    for a, b in zip(cut[:-1][size > 8].tolist(), cut[1:][size > 8].tolist(), strict=True):
        h, t = bucket_links(x[a:b], radius, ~masks[v[a]] & (1 << 64) - 1)
        heads.append(a + h)
        tails.append(a + t)
    if heads:
        h, t = x[np.concatenate(heads)].view(np.int64), x[np.concatenate(tails)].view(np.int64)
        for i in range(0, len(h), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(part[i : i + (1 << 16)]) for part in (h, t)], names=["a", "b"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """id and fp (the fingerprint as a signed long) of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["id", "fp"])

    return rows.mapInArrow(of, f"id {rows.schema[0].dataType.simpleString()}, fp long")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """id, fp and component (smallest id reachable over links) of every row of docs.

    Fingerprints link if they differ in `radius` bits or fewer. Rows with the same fingerprint are one node before anything
    is compared. Nodes go to one bucket for each covering mask; a bucket gives links from its components' first members, so
    a large one gives about as many rows as it has nodes, and a large one without large components is cut by further bits.
    No link is lost: the masks leave out no pair within the radius, and nothing is capped.

    Texts are read whole, however long. Null and blank texts have fingerprint zero and link to each other and to words of
    `radius` bits. Repeated rows give repeated rows. A null id counts only if its component has no other. An empty table
    gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    marked = settle(fingerprints(docs, id_col, text_col, shingle))
    known = settle(marked.groupBy("fp").agg(F.min("id").alias("least")))
    masks = covering_masks(radius)
    tables = known.select(F.explode(F.array(*(F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("key")) for v, m in enumerate(masks)))).alias("t"), "fp")
    dealt = tables.repartition(partitions(spark, known.count() * len(masks), 1 << 20), "t.v", "t.key").select(F.col("t.v").alias("v"), "fp")
    links = dealt.mapInArrow(lambda it: _in_buckets(it, masks, radius), "a long, b long")
    roots = settle(connected_components(links))
    least = known.join(roots, known["fp"] == roots["node"]).groupBy("root").agg(F.min("least").alias("component"))
    linked = roots.join(least, "root").select(F.col("node").alias("fp"), "component")
    labels = known.join(linked, "fp", "left").select("fp", F.coalesce("component", "least").alias("component"))
    labels = settle(labels)  # then both sides of the join are shuffled for it alone, and Spark may split a hot fingerprint
    return marked.join(labels, "fp").select("id", "fp", "component")


#: Candidates that a text names in a bucket in the first round, beside those that are sure. The second round leaves nothing to them.
GUESSES = 4
#: In buckets of so many texts, and fewer, the first round compares every pair. A bucket of more than SHARE is dealt out.
SMALL, SHARE = 8, 512
#: Bands of ROWS minima each: a pair of Jaccard similarity 0.8 agrees in no band with a chance of (1 - 0.8^4)^20, 3 in 100,000.
BANDS, ROWS = 20, 4
_MINIMA = np.random.default_rng(SEED).integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64, endpoint=False) | np.uint64(1)


def minima(h: np.ndarray) -> np.ndarray:
    """The least of a set of hashes under each of BANDS * ROWS multiplications."""
    parts = [(_MINIMA * h[i : i + (1 << 13)]).min(1) for i in range(0, len(h), 1 << 13)]
    return np.minimum.reduce(parts)


def _set_of(text: str | None) -> tuple[np.ndarray, bytes]:
    """A text's different five-word shingles, and a digest that names the set."""
    h = np.unique(_shingles(text, SET_SHINGLE))
    return h, xxhash.xxh3_128_digest(h.tobytes())


def _candidates(marks: np.ndarray, least: int, sure: int, most: int = GUESSES) -> tuple[list[int], list[int]]:
    """Links (others, reached from) of one bucket: texts with `sure` agreeing minima, found outward and not looked at again;
    and of each text outside the largest group of these, up to `most` others of other groups that agree best, in `least` or more.
    """
    left, group, heads, tails = np.arange(len(marks)), np.zeros(len(marks), np.int64), [], []
    while len(left):
        root, left = int(left[0]), left[1:]
        group[root], todo = root, [root]
        while todo and len(left):
            p = todo.pop()
            hit = (marks[left] == marks[p]).sum(1) >= sure
            heads += left[hit].tolist()
            tails += [p] * int(hit.sum())
            group[left[hit]] = root
            todo += left[hit].tolist()
            left = left[~hit]
    largest = np.bincount(group).argmax()
    for p in np.flatnonzero(group != largest).tolist():
        same = np.where(group != group[p], (marks == marks[p]).sum(1), 0)
        best = np.argpartition(-same, min(most, len(same) - 1))[:most]
        best = best[same[best] >= least].tolist()
        heads += best
        tails += [p] * len(best)
    return heads, tails


def _limits(similarity: float) -> tuple[int, int]:
    """Agreeing minima that a pair of this similarity has almost surely, and those that only similar pairs have."""
    n, apart = BANDS * ROWS, math.sqrt(similarity * (1 - similarity) / (BANDS * ROWS))
    return math.floor(n * (similarity - 4 * apart)), math.ceil(n * (similarity + 2 * apart))


def _marks(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)


def _named_pairs(heads: np.ndarray, tails: np.ndarray, node: list[bytes]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(heads), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array([node[k] for k in part[i : i + (1 << 16)]], pa.binary()) for part in (heads, tails)], names=["a", "b"])


def _first_round(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Rows (key, share, node, marks) of whole shares of buckets to links (a, b) between nodes that may be so similar."""
    got = [(b.column(0).to_numpy(), b.column(1).to_numpy(), np.array(b.column(2).to_pylist(), "V16"), _marks(b.column(3))) for b in batches if b.num_rows]
    if not got:
        return
    key, share, node, marks = (np.concatenate([g[i] for g in got]) for i in range(4))
    order = np.lexsort((key ^ node.view(np.int64).reshape(-1, 2)[:, 0], share, key))  # another member comes first in each band
    key, share, node, marks = key[order], share[order], node[order], marks[order]
    cut = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (share[1:] != share[:-1]), True])
    least, sure = _limits(similarity)
    size, heads, tails = np.diff(cut), [], []
    for m in np.unique(size[(size > 1) & (size <= SMALL)]):  # small buckets of one size at once: every pair
        block = cut[:-1][size == m][:, None] + np.arange(m)
        for i in range(m):
            for j in range(i + 1, m):
                hit = (marks[block[:, i]] == marks[block[:, j]]).sum(1) >= least
                heads.append(block[hit, j])
                tails.append(block[hit, i])
    for a, b in zip(cut[:-1][size > SMALL].tolist(), cut[1:][size > SMALL].tolist(), strict=True):
        h, t = _candidates(marks[a:b], least, sure)
        heads.append(a + np.array(h, np.int64))
        tails.append(a + np.array(t, np.int64))
    if heads:
        yield from _named_pairs(np.concatenate(heads), np.concatenate(tails), [n.tobytes() for n in node])


class _Meeting:
    """Visitors and homes of one share of a bucket; which of their pairs are still to be compared."""

    def __init__(self, rows: pa.Table, similarity: float):
        self.key, self.similarity, self.least = rows["key"][0].as_py(), similarity, _limits(similarity)[0]
        self.node, self.marks, self.size = rows["node"].to_pylist(), _marks(rows["marks"]), rows["size"].to_numpy()
        self.keys = rows["keys"].combine_chunks().flatten().to_numpy().reshape(len(self.node), -1)
        role = rows["role"].to_numpy()
        self.visitors, self.homes = np.flatnonzero(role == 1), np.flatnonzero(role != 1)
        self.other = role[self.homes] == 2
        names = {c: i for i, c in enumerate(dict.fromkeys(rows["comp"].to_pylist()))}
        self.comp = np.array([names[c] for c in rows["comp"].to_pylist()])
        self.up = np.array([n.hex() for n in self.node])

    def open(self, p: int) -> np.ndarray:
        """Homes in other components that a visitor may be similar to, and that it meets here for the first time."""
        h = self.homes
        h = h[(self.comp[h] != self.comp[p]) & (~self.other | (self.up[h] > self.up[p])) & (np.minimum(self.size[h], self.size[p]) >= self.similarity * np.maximum(self.size[h], self.size[p]))]
        h = h[(self.marks[h] == self.marks[p]).sum(1) >= self.least] if len(h) else h
        if not len(h):
            return h
        same = self.keys[h] == self.keys[p]
        return h[self.keys[p][same.argmax(1)] == self.key]

    def join(self, a: int, b: int) -> None:
        self.comp[self.comp == self.comp[a]] = self.comp[b]


_SHARE = "key long, home int, visit int, role int, node binary, comp binary, size int, marks binary, keys array<long>"


def _still_open(rows: pa.Table, similarity: float) -> pa.Table:
    """Rows of a share that have a partner to be compared with by their sets."""
    m, wanted = _Meeting(rows, similarity), np.zeros(rows.num_rows, bool)
    for p in m.visitors.tolist():
        h = m.open(p)
        wanted[h] = True
        wanted[p] |= len(h) > 0
    return rows.filter(pa.array(wanted))


def _second_round(rows: pa.Table, similarity: float) -> pa.Table:
    """Rows of a share with their sets to links that join all components which a pair of the share joins."""
    m, heads, tails = _Meeting(rows, similarity), [], []
    held = rows["held"].combine_chunks()
    flat, ends = np.unique(held.flatten().to_numpy(), return_inverse=True)[1].astype(np.int64), np.r_[0, np.cumsum(m.size)]
    has = np.zeros(int(flat.max(initial=0)) + 1, np.int64)
    for p in m.visitors.tolist():
        h = m.open(p)
        if not len(h):
            continue
        own = flat[ends[p] : ends[p + 1]]
        has[own] = 1
        size = m.size[h].astype(np.int64)
        at = np.arange(int(size.sum())) + np.repeat(ends[h] - (np.cumsum(size) - size), size)
        both = np.add.reduceat(has[flat[at]], np.cumsum(size) - size)
        has[own] = 0
        for q in h[both / (size + m.size[p] - both) >= similarity].tolist():
            if m.comp[p] != m.comp[q]:
                heads.append(m.node[p])
                tails.append(m.node[q])
                m.join(p, q)
    return pa.table({"a": pa.array(heads, pa.binary()), "b": pa.array(tails, pa.binary())})


def _linked(links: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Of candidates (a, b), those that their sets confirm."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("held").alias(f"{c}_held"))
    both = F.size(F.array_intersect("a_held", "b_held"))
    return links.join(side("a"), "a").join(side("b"), "b").where(both / (F.size("a_held") + F.size("b_held") - both) >= similarity).select("a", "b")


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, radius: int = 2) -> DataFrame:
    """id and component (smallest id reachable over links) of every row of docs: texts link if the Jaccard similarity of
    their sets of five-word shingles is `similarity` or more.

    Covering tables over the fingerprints of these sets name all candidates within `radius` bits. Texts of a similarity of 0.8
    differ in ten bits on average, for which covering tables would number 2^11; so bands of minima name candidates too. A pair
    of just `similarity` shares no bucket, or too few minima, with a calculated chance of less than 1 in 10,000; every other one is found.

    Two rounds compare what shares a bucket. In the first one, small buckets compare all pairs, and in shares of large ones a text names
    those that agree almost surely and its likeliest other partners. Links that the sets confirm make components. The second
    round takes every bucket that still holds several components, and compares by their sets all pairs of different components
    that the first minima do not rule out: members of all but the largest component visit all shares of their bucket. A share
    gives no more links than it has components, so links grow with the texts; a pair is compared in its first bucket only.

    Texts with the same set are one node; those without words are one, and link to no other. Null and blank texts have no words; very long ones are
    read whole, repeated rows give repeated rows, an empty table gives an empty result, and other columns are not looked at. Null ids as in
    near_classes.
    """
    spark, masks = docs.sparkSession, np.array(covering_masks(radius), np.uint64)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema[0].dataType.simpleString()

    def marks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, keys, marks, sizes = [], [], [], []
            for t in b.column(1).to_pylist():
                h, node = _set_of(t)
                low = minima(h) if len(h) else np.zeros(0, np.uint64)
                nodes.append(node)
                sizes.append(len(h))
                bands = [low[i : i + ROWS].tobytes() for i in range(0, len(low), ROWS)]
                tables = [w.tobytes() for w in masks & np.uint64(_majority(h))] if len(h) else []
                keys.append([xxhash.xxh64_intdigest(x, i) - (1 << 63) for i, x in enumerate(bands + tables)])
                marks.append((low >> np.uint64(8)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array(marks, pa.binary())], names=["id", "node", "size", "keys", "marks"])

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [_set_of(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([n for _, n in got], pa.binary()), pa.array([h.view(np.int64) for h, _ in got], pa.list_(pa.int64()))], names=["node", "held"])

    marked = settle(rows.mapInArrow(marks_of, f"id {kind}, node binary, size int, keys array<long>, marks binary"))
    known = settle(marked.groupBy("node").agg(F.min("id").alias("least"), F.first("size").alias("size"), F.first("keys").alias("keys"), F.first("marks").alias("marks")))
    n = partitions(spark, known.count() * (BANDS + len(masks)), 1 << 20)

    def sets_for(nodes: DataFrame) -> DataFrame:
        # ids may repeat with other texts: the sets' own names tell which are meant
        wanted = settle(nodes.distinct().join(known, "node").select("node", F.col("least").alias("wid")))
        texts = bit_filter.semi(rows, "id", wanted.select("wid").distinct()).select("text")
        return settle(texts.mapInArrow(sets_of, "node binary, held array<long>").join(wanted, "node", "left_semi").groupBy("node").agg(F.first("held").alias("held")))

    # keys and names alone first: marks go only where a key has several texts
    met = known.select(F.explode("keys").alias("key"), "node")
    many = settle(met.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1"))
    met = settle(met.join(many, "key").select("key", "node", "m"))
    share = F.when(F.col("m") > SHARE, F.pmod(F.xxhash64("key", "node"), F.ceil(F.col("m") / SHARE))).otherwise(0).cast("int")
    dealt = met.select("key", share.alias("share"), "node").join(known.select("node", "marks"), "node").select("key", "share", "node", "marks").repartition(n, "key", "share")
    maybe = dealt.mapInArrow(lambda it: _first_round(it, similarity), "a binary, b binary")
    maybe = settle(maybe.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    links = settle(_linked(maybe, sets_for(maybe.select(F.explode(F.array("a", "b")).alias("node"))), similarity))
    roots = settle(connected_components(links))
    more = _left_over(met, known, roots, sets_for, similarity)
    if more is not None:
        links = settle(links.unionByName(more))
        roots = settle(connected_components(links))
    least = known.select("node", "least").join(roots, "node").groupBy("root").agg(F.min("least").alias("component"))
    linked = roots.join(least, "root").select("node", "component")
    labels = settle(known.select("node", "least").join(linked, "node", "left").select("node", F.coalesce("component", "least").alias("component")))
    return marked.select("id", "node").join(labels, "node").select("id", "component")


def _left_over(met: DataFrame, known: DataFrame, roots: DataFrame, sets_for: Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame | None:
    """Links between components that share a large bucket and that no link joins yet; None if there are no such buckets.

    met: key, node and the bucket's size m. A component's members in a bucket are counted by map-side sums. Those of the largest
    component stay in their share (home); all others also visit all shares, in groups (visit) of their own.
    """
    labelled = met.where(F.col("m") > SMALL).join(roots, "node", "left").select("key", "node", "m", F.coalesce("root", "node").alias("comp"))
    parts = settle(labelled.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n")))
    tops = parts.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("top"), F.count(F.lit(1)).alias("comps")).where("comps > 1").select("key", F.col("top.n").alias("most"), F.col("top.comp").alias("main"))
    tops = settle(tops)
    if tops.isEmpty():
        return None
    at = labelled.join(tops, "key").withColumn("homes", F.ceil(F.col("m") / SHARE).cast("int")).withColumn("visits", F.ceil((F.col("m") - F.col("most")) / SHARE).cast("int"))
    own = lambda c, of: F.pmod(F.xxhash64("key", "node", F.lit(c)), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    role = F.when(F.col("comp") == F.col("main"), 0).otherwise(2)
    homes = at.select("key", own("home", "homes").alias("home"), every("visits").alias("visit"), role.alias("role"), "node", "comp")
    visitors = at.where("comp <> main").select("key", every("homes").alias("home"), own("visit", "visits").alias("visit"), F.lit(1).alias("role"), "node", "comp")
    shares = homes.union(visitors).join(known.select("node", "size", "marks", "keys"), "node").select("key", "home", "visit", "role", "node", "comp", "size", "marks", "keys")
    still = stored(shares.groupBy("key", "home", "visit").applyInArrow(lambda t: _still_open(t, similarity), _SHARE))
    if still.isEmpty():
        return None
    full = still.join(sets_for(still.select("node")), "node").select(*still.columns, "held")
    return settle(full.groupBy("key", "home", "visit").applyInArrow(lambda t: _second_round(t, similarity), "a binary, b binary"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, radius: int = 2) -> DataFrame:
    """Rows of docs that stay: of each component of similar_classes, the rows with its smallest id (all, if the ids are null).

    Null and blank texts are one component, so one of their rows stays; repeated rows of a smallest id all stay. Very long texts are compared
    whole, an empty table stays empty, and all columns are kept, whatever their names.
    """
    return bit_filter.without(docs, id_col, similar_classes(docs, id_col, text_col, similarity, radius).where("NOT (id <=> component)").select("id").distinct())
