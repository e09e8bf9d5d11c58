"""Suffix-array dedup: bytes that stand in a 50-byte string of a document with a smaller id go."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.passages import SLICE, Block, Plan, mixed, remove_recurring
from quire.llm.suffix_array import suffix_array

WINDOW, ANCHOR = 50, 26
#: Bytes that one suffix array is built over, few enough for a processor's cache; contexts of a key stay together, so one key
#: may exceed it, up to MOST_IN_KEY different contexts.
SORTED_AT_ONCE, MOST_IN_KEY = 1 << 14, 1 << 15


def read_bytes(ids: np.ndarray, texts: list[bytes], anchor: int) -> Block:
    data = b"".join(texts)
    raw = np.frombuffer(data, np.uint8)
    h = np.zeros(max(0, len(raw) - anchor + 1), np.uint64)
    step = next(n for n in (8, 4, 2, 1) if n <= anchor)
    for a in range(0, len(h), SLICE):
        out = h[a : a + SLICE]
        words = raw[a : a + SLICE + anchor - 1].astype(np.uint64)
        for n in (1, 2, 4)[: step.bit_length() - 1]:  # of each position the next 2, 4, 8 bytes
            words = words[:-n] | words[n:] << np.uint64(8 * n)
        for at in [*range(0, anchor - step + 1, step), *([anchor - step] if anchor % step else [])]:
            out[:] = mixed(out * np.uint64(31) + words[at : at + len(out)])
    return Block(ids, np.cumsum([len(t) for t in texts]) if texts else np.zeros(0, np.int64), data, lambda lo, hi: (lo, hi), h)


def _shared(key: np.ndarray, sides: list[bytes], width: int) -> np.ndarray:
    """Of each side: how many leading bytes it has in common with another one of the same key, at most."""
    wide = np.frombuffer(b"".join(x[:width].ljust(width, b"\0") for x in sides), np.uint8).reshape(-1, width)
    padded = np.zeros((len(sides), -(-width // 8) * 8), np.uint8)
    padded[:, :width] = wide
    order = np.lexsort((*padded.view(">u8").T[::-1], key))
    wide, key = wide[order], key[order]
    same = wide[1:] == wide[:-1]
    common = np.where(same.all(1), width, same.argmin(1))
    common[key[1:] != key[:-1]] = 0
    best = np.zeros(len(sides), np.int64)
    best[order] = np.maximum(np.r_[common, 0], np.r_[0, common])
    return np.minimum(best, [len(x) for x in sides])


def _numbered(key: np.ndarray, left: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(number, first) of the distinct (key, left, string): each row's number, and one row of each, ordered by key."""
    c = np.fromiter((xxhash.xxh64_intdigest(x) for x in strings), np.uint64, len(strings)) + left.astype(np.uint64)
    order = np.lexsort((c, key))
    new = np.r_[True, (key[order][1:] != key[order][:-1]) | (c[order][1:] != c[order][:-1])] if len(order) else np.zeros(0, np.bool_)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


def sorted_windows(strings: list[bytes], least: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """lo, hi of each string: from the first to the last of its windows that a string of a smaller id has (0, 0: none).

    A suffix array over all strings puts equal windows side by side.
    """
    sizes = np.array([len(s) for s in strings])
    raw = np.frombuffer(b"\0".join(strings) + b"\0" * window, np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = raw[: int(starts[-1] + sizes[-1]) + 1].astype(np.int64) + 2
    ends = starts + sizes
    text[ends] = 1
    text = np.r_[text, 0]
    order = np.array(suffix_array(text.tolist()))
    order = order[order < ends[-1]]
    of = np.searchsorted(starts, order, side="right") - 1
    full = order + window <= ends[of]
    order, of = order[full], of[full]
    lo, hi = np.full(len(strings), np.iinfo(np.int64).max), np.zeros(len(strings), np.int64)
    if len(order):
        rows = np.lib.stride_tricks.sliding_window_view(raw, window)
        new = np.ones(len(order), np.bool_)
        for a in range(1, len(order), 1 << 16):
            at = order[a - 1 : a + (1 << 16)]
            new[a : a + (1 << 16)] = (rows[at[1:]] != rows[at[:-1]]).any(1)
        first = np.flatnonzero(new)
        smallest = np.repeat(np.minimum.reduceat(least[of], first), np.diff(np.r_[first, len(order)]))
        hit = smallest < least[of]
        np.minimum.at(lo, of[hit], (order - starts[of])[hit])
        np.maximum.at(hi, of[hit], (order - starts[of])[hit] + window)
    return np.where(hi > 0, lo, 0), hi


def windows_by_place(strings: list[bytes], least: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """What sorted_windows gives, for strings that have the same bytes from `at` on: equal windows that hold these have equal
    places around them, so one place after the other is sorted, in memory of a window for each string."""
    lo, hi = np.full(len(strings), np.iinfo(np.int64).max), np.zeros(len(strings), np.int64)
    sizes = np.array([len(x) for x in strings])
    for o in range(-int(at.max(initial=0)), int((sizes - at).max(initial=0))):  # first byte of a window, from the anchor
        rows = np.flatnonzero((at + o >= 0) & (at + o + window <= sizes))
        if not len(rows):
            continue
        begin = at[rows] + o
        wide = np.frombuffer(b"".join(strings[i][a : a + window] for i, a in zip(rows.tolist(), begin.tolist(), strict=True)), f"V{window}")
        _, of = np.unique(wide, return_inverse=True)
        low = np.full(int(of.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(low, of, least[rows])
        hit = low[of] < least[rows]
        np.minimum.at(lo, rows[hit], begin[hit])
        np.maximum.at(hi, rows[hit], begin[hit] + window)
    return np.where(hi > 0, lo, 0), hi


def solve_bytes(key: np.ndarray, least: np.ndarray, left: np.ndarray, contexts: list[bytes], window: int = WINDOW, anchor: int = ANCHOR, most_in_key: int = MOST_IN_KEY) -> tuple[np.ndarray, np.ndarray]:
    """Of each context: the bytes that lie in windows which a context with the same key and a smaller id has too.

    Equal contexts are one string with the smallest of their ids. Contexts of a key that differ are first cut to what any
    other one of the key has next to the anchor, on both sides, which takes no shared window away; the strings that are left
    are suffix-sorted, many keys at once. Of a key with very many, windows are sorted place by place instead.
    """
    size = np.fromiter(map(len, contexts), np.int64, len(contexts))
    number, one = _numbered(key, left, contexts)
    smallest = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(smallest, number, least)
    lo, hi = np.zeros(len(contexts), np.int64), np.where(least > smallest[number], size, 0)
    key_of = key[one]
    several = np.flatnonzero((np.r_[False, key_of[1:] == key_of[:-1]]) | (np.r_[key_of[1:] == key_of[:-1], False])) if len(one) else np.zeros(0, np.int64)
    if not len(several):
        return lo, hi
    rows = one[several]
    k, at, own = key[rows], left[rows], smallest[several]
    rest = window - anchor
    after = _shared(k, [contexts[i][p + anchor :] for i, p in zip(rows.tolist(), at.tolist(), strict=True)], rest)
    before = _shared(k, [contexts[i][:p][::-1] for i, p in zip(rows.tolist(), at.tolist(), strict=True)], rest)
    kept = np.flatnonzero(before + anchor + after >= window)
    rows, k, at, own, before, after, several = (x[kept] for x in (rows, k, at, own, before, after, several))
    strings = [contexts[i][p - a : p + anchor + b] for i, p, a, b in zip(rows.tolist(), at.tolist(), before.tolist(), after.tolist(), strict=True)]
    cut, pick = _numbered(k, before, strings)
    low = np.full(len(pick), np.iinfo(np.int64).max)
    np.minimum.at(low, cut, own)
    a, b, keys = np.zeros(len(pick), np.int64), np.zeros(len(pick), np.int64), k[pick]
    bounds = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]).tolist() if len(pick) else [0]
    todo, size = [], 0
    for x, y in zip(bounds, bounds[1:], strict=False):
        if y - x > most_in_key:
            a[x:y], b[x:y] = windows_by_place([strings[j] for j in pick[x:y]], low[x:y], before[pick[x:y]], window)
            continue
        todo += range(x, y)
        size += sum(len(strings[j]) for j in pick[x:y])
        if size >= SORTED_AT_ONCE or y == bounds[-1]:
            a[todo], b[todo] = sorted_windows([strings[j] for j in pick[todo]], low[todo], window)
            todo, size = [], 0
    if todo:
        a[todo], b[todo] = sorted_windows([strings[j] for j in pick[todo]], low[todo], window)
    whole = own > low[cut]
    a, b = np.where(whole, 0, a[cut]) + at - before, np.where(whole, before + anchor + after, b[cut])
    found_lo, found_hi = np.zeros(len(one), np.int64), np.zeros(len(one), np.int64)
    found_lo[several], found_hi[several] = np.where(b > 0, a, 0), np.where(b > 0, at - before + b, 0)
    mine = least == smallest[number]
    return np.where(mine, found_lo[number], lo), np.where(mine, found_hi[number], hi)


SCHEMA = "id long, n_bytes long, n_removed long, n_spans long, kept binary"


def finish_bytes(ids: np.ndarray, null: np.ndarray, block: Block, gone: np.ndarray) -> pa.RecordBatch:
    raw = np.frombuffer(block.data, np.uint8)
    left, starts, ends = raw[~gone].tobytes(), block.starts, block.ends.astype(np.int64)
    so_far = np.r_[0, np.cumsum(gone)]
    n_gone = so_far[ends] - so_far[starts]
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    inner = starts[(starts < ends) & (starts > 0)]
    begins[inner] = gone[inner]  # a run ends with its document
    runs = np.r_[0, np.cumsum(begins)]
    kept_to = np.cumsum(ends - starts - n_gone).tolist()
    kept = [left[a:b] for a, b in zip([0, *kept_to[:-1]], kept_to, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(ids, mask=null), pa.array(ends - starts), pa.array(n_gone), pa.array(runs[ends] - runs[starts]), pa.array(kept, pa.binary())], names=["id", "n_bytes", "n_removed", "n_spans", "kept"])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR, **options) -> DataFrame:
    """id, n_bytes, n_removed, n_spans and kept (the bytes that stay) of every row of docs.

    A byte goes if a string of `window` bytes around it also starts in a document with a smaller id, judged on the input.
    Whole texts, as UTF-8; strings do not cross documents. The passages exchange (see quire.llm.passages) brings contexts
    that may share a string together, and suffix arrays over these find the strings.

    A null text has no bytes and loses none, nor does one shorter than the window. Ids must be integers: null counts as
    smaller than all others, and rows with equal ids take nothing from each other. Empty tables give empty results; other
    columns are not looked at.
    """
    plan = Plan(window, anchor, lambda ids, texts: read_bytes(ids, texts, anchor), lambda *x: solve_bytes(*x, window=window, anchor=anchor))
    return remove_recurring(docs, plan, finish_bytes, SCHEMA, id_col, text_col, 1.0, **options)


def substring_digest(docs: DataFrame) -> DataFrame:
    return substring_dedup(docs).select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS k FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM b)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS least FROM win) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM hit),
byte AS (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS p FROM b),
kept AS (SELECT byte.doc_id, count(*) AS n, string_agg(substr(h, 2 * byte.p + 1, 2), '' ORDER BY byte.p) AS t FROM byte ANTI JOIN gone ON byte.doc_id = gone.doc_id AND byte.p = gone.p GROUP BY 1),
span AS (SELECT doc_id, count(*) AS k FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM gone) WHERE before IS NULL OR before < p - 1 GROUP BY 1)
SELECT b.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(length(h) // 2 - coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(k, 0) AS n_spans, sha256(unhex(coalesce(t, ''))) AS kept_sha256
FROM b LEFT JOIN kept USING (doc_id) LEFT JOIN span USING (doc_id)
"""
