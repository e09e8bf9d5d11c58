"""Substring dedup by repeated-phrase automata: words in a 13-word window of a document with a smaller id go."""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.passages import Block, Plan, mixed, remove_recurring

WINDOW, ANCHOR = 13, 5
#: Words of contexts that one automaton is compiled from; contexts of a key stay together, so one key may exceed it, up to
#: MOST_IN_KEY different contexts.
COMPILED_AT_ONCE, MOST_IN_KEY = 1 << 14, 1 << 15

_BLANK = np.zeros(256, np.bool_)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def read_words(ids: np.ndarray, texts: list[bytes], anchor: int) -> Block:
    """data: all words, each with one space behind it; units are words."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    word = ~_BLANK[raw]
    before = np.r_[False, word[:-1]]
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(before & ~word)
    last = np.cumsum(np.array([len(t) for t in texts], np.int64) + 1)
    data = raw[word | (before & ~word)].copy()
    data[np.cumsum(ends - starts + 1) - 1] = 32
    size = ends - starts
    at = np.cumsum(size + 1) - size - 1
    h = np.zeros(len(size), np.uint64)
    for i in range(int(size.max(initial=0))):  # a byte of every word that has so many
        if i >= 24:
            break
        on = np.flatnonzero(size > i)
        h[on] = mixed(h[on] * _BASE + data[at[on] + i].astype(np.uint64) + np.uint64(1))
    for j in np.flatnonzero(size > 24).tolist():
        h[j] = xxhash.xxh64_intdigest(data[at[j] : at[j] + size[j]].tobytes())
    n = max(0, len(h) - anchor + 1)
    k = np.zeros(n, np.uint64)
    for j in range(anchor):
        k = mixed(k * np.uint64(31) + h[j : j + n])
    to = at + size
    return Block(ids, np.searchsorted(starts, last) if len(texts) else np.zeros(0, np.int64), data.tobytes(), lambda lo, hi: (at[lo], to[hi - 1]), k)


def _spelled(n: int, digits: int) -> list[str]:
    """n words in `digits` symbols each. Every place has 64 symbols of its own: nodes have few branches, which the automaton
    searches one by one, and no match starts inside a word."""
    return ["".join(chr(0x100 + 64 * k + (i >> 6 * k & 63)) for k in range(digits)) for i in range(n)]


def locate(contexts: list[bytes], least: np.ndarray, most: np.ndarray, several: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """lo, hi of each context twice: from the first to the last word of what an id smaller than `least` has too, and of what
    `least` or a smaller one has (0, 0: nothing).

    Confirmed phrases make the automaton, over an alphabet that spells words: contexts that two ids have, whole, and of those
    with a neighbour (`several`) also the windows that two ids have. All contexts are then run through it, and each occurrence
    is held against its phrase's smallest id.
    """
    number: dict[bytes, int] = {}
    rows = [[number.setdefault(w, len(number)) for w in c.split(b" ")] for c in contexts]
    digits = max(3, -(-len(number).bit_length() // 6))
    spelled = _spelled(len(number), digits)
    texts = ["".join([spelled[i] for i in row]) for row in rows]
    size, smallest, largest = window * digits, {}, {}
    for t, a, b, many in zip(texts, least.tolist(), most.tolist(), several.tolist(), strict=True):
        pieces = [t[i : i + size] for i in range(0, len(t) - size + 1, digits)] if many else []
        if a < b and len(t) != size:
            pieces.append(t)
        elif a < b and not many:
            pieces = [t]
        for w in pieces:
            if (x := smallest.get(w)) is None:
                smallest[w], largest[w] = a, b
            else:
                if a < x:
                    smallest[w] = a
                if b > largest[w]:
                    largest[w] = b
    automaton = ahocorasick.Automaton()
    for w, x in smallest.items():
        if x < largest[w]:
            automaton.add_word(w, (x, len(w)))
    if not len(automaton):
        return tuple(np.zeros(len(contexts), np.int64) for _ in range(4))
    automaton.make_automaton()
    starts = np.cumsum([0, *(len(row) + 1 for row in rows)])
    found = list(automaton.iter(("\0" * digits).join(texts)))
    end = (np.array([e for e, _ in found], np.int64) + 1) // digits
    first = end - np.array([n for _, (_, n) in found], np.int64) // digits
    of = np.searchsorted(starts, end, side="right") - 1
    who, out = np.array([x for _, (x, _) in found], np.int64), []
    for hit in (who < least[of], who <= least[of]):
        lo, hi = np.full(len(contexts), np.iinfo(np.int64).max), np.zeros(len(contexts), np.int64)
        np.minimum.at(lo, of[hit], (first - starts[of])[hit])
        np.maximum.at(hi, of[hit], (end - starts[of])[hit])
        out += [np.where(hi > 0, lo, 0), hi]
    return tuple(out)


def _windows(context: bytes, window: int) -> list[bytes]:
    words = context.split(b" ")
    return [b" ".join(words[i : i + window]) for i in range(len(words) - window + 1)]


def solve_words(key: np.ndarray, least: np.ndarray, left: np.ndarray, contexts: list[bytes], window: int = WINDOW, at_once: int = COMPILED_AT_ONCE, most_in_key: int = MOST_IN_KEY) -> tuple[np.ndarray, np.ndarray]:
    """Of each context: the words in windows that a context with the same key and a smaller id has too.

    Equal contexts run through the automaton once, with the smallest and the largest of their ids; what it finds at or below
    the smallest goes from all others of their ids. A key of very many different contexts is taken apart by its windows'
    places around the anchor: equal windows have equal places, and an automaton at a time holds those of one place.
    """
    c = np.fromiter((xxhash.xxh64_intdigest(x) for x in contexts), np.uint64, len(contexts)) + left.astype(np.uint64)
    order = np.lexsort((c, key))
    new = np.r_[True, (key[order][1:] != key[order][:-1]) | (c[order][1:] != c[order][:-1])] if len(order) else np.zeros(0, np.bool_)
    number, one = np.empty(len(order), np.int64), order[new]
    number[order] = np.cumsum(new) - 1
    smallest, largest = np.full(len(one), np.iinfo(np.int64).max), np.full(len(one), np.iinfo(np.int64).min)
    np.minimum.at(smallest, number, least)
    np.maximum.at(largest, number, least)
    keys, place = key[one], left[one]
    cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(one) else np.zeros(1, np.int64)
    in_key = np.repeat(np.diff(cut), np.diff(cut))
    ranges = [np.zeros(len(one), np.int64) for _ in range(4)]  # lo, hi for the smallest id; lo, hi for the others

    def compiled(rows: np.ndarray) -> None:
        for x, y in zip(ranges, locate([contexts[i] for i in one[rows].tolist()], smallest[rows], largest[rows], in_key[rows] > 1, window), strict=True):
            x[rows] = y

    def taken_apart(rows: np.ndarray) -> None:
        parts = [_windows(contexts[i], window) for i in one[rows].tolist()]
        lo, hi = np.full((2, len(rows)), np.iinfo(np.int64).max), np.zeros((2, len(rows)), np.int64)
        reach = int(place[rows].max(initial=0))
        for o in range(-reach, max((len(p) for p in parts), default=0)):  # first word of a window, from the anchor
            have = [(k, p[o + at]) for k, (p, at) in enumerate(zip(parts, place[rows].tolist(), strict=True)) if 0 <= o + at < len(p)]
            different = sorted({w for _, w in have})
            index = {w: n for n, w in enumerate(different)}
            of, k = np.array([index[w] for _, w in have], np.int64), np.array([k for k, _ in have], np.int64)
            low, high = np.full(len(different), np.iinfo(np.int64).max), np.full(len(different), np.iinfo(np.int64).min)
            np.minimum.at(low, of, smallest[rows][k])
            np.maximum.at(high, of, largest[rows][k])
            for a in range(0, len(different), at_once):
                part = slice(a, a + at_once)
                low[part] = np.where(locate(different[part], low[part], high[part], np.zeros(len(different[part]), np.bool_), window)[3] > 0, low[part], np.iinfo(np.int64).max)
            begin = o + place[rows][k]
            for n, hit in enumerate((low[of] < smallest[rows][k], low[of] <= smallest[rows][k])):
                np.minimum.at(lo[n], k[hit], begin[hit])
                np.maximum.at(hi[n], k[hit], begin[hit] + window)
        for n in (0, 1):
            ranges[2 * n][rows], ranges[2 * n + 1][rows] = np.where(hi[n] > 0, lo[n], 0), hi[n]

    needed = (in_key > 1) | (smallest < largest)
    words = np.array([contexts[i].count(b" ") + 1 for i in one.tolist()], np.int64)
    todo, size = [], 0
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        rows = np.arange(a, b)[needed[a:b]]
        if len(rows) > most_in_key:
            taken_apart(rows)
            continue
        todo.append(rows)
        size += int(words[rows].sum())
        if size >= at_once:
            compiled(np.concatenate(todo))
            todo, size = [], 0
    if size:
        compiled(np.concatenate(todo))
    mine = least == smallest[number]
    return np.where(mine, ranges[0][number], ranges[2][number]), np.where(mine, ranges[1][number], ranges[3][number])


SCHEMA = "id long, n_words long, n_removed long, kept binary"


def finish_words(ids: np.ndarray, null: np.ndarray, block: Block, gone: np.ndarray) -> pa.RecordBatch:
    starts, ends = block.starts, block.ends.astype(np.int64)
    raw = np.frombuffer(block.data, np.uint8)
    n = len(gone)
    at, to = block.cut(np.arange(n), np.arange(n) + 1)
    size = to - at + 1
    left = raw[np.repeat(~gone, size)].tobytes() if n else b""
    so_far, held = np.r_[0, np.cumsum(gone)], np.r_[0, np.cumsum(np.where(gone, 0, size))]
    kept = [left[a : max(a, b - 1)] for a, b in zip(held[starts].tolist(), held[ends].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(ids, mask=null), pa.array(ends - starts), pa.array(so_far[ends] - so_far[starts]), pa.array(kept, pa.binary())], names=["id", "n_words", "n_removed", "kept"])


def phrase_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR, **options) -> DataFrame:
    """id, n_words, n_removed and kept (the words that stay, joined by one space, as UTF-8) of every row of docs.

    A word goes if a window of `window` consecutive words around it also starts in a document with a smaller id, judged on
    the input. Words are runs of other characters than space and \\t..\\r, unchanged. The passages exchange (see
    quire.llm.passages) shards the contexts that may share a window; each shard compiles its phrases and locates them.

    A null text has no words; texts with fewer words than the window lose none. Ids must be integers: null counts as smaller
    than all others, and rows with equal ids take nothing from each other. Empty tables give empty results; other columns
    are not looked at.
    """
    plan = Plan(window, anchor, lambda ids, texts: read_words(ids, texts, anchor), lambda *x: solve_words(*x, window=window))
    return remove_recurring(docs, plan, finish_words, SCHEMA, id_col, text_col, 0.2, **options)


def phrase_digest(docs: DataFrame) -> DataFrame:
    return phrase_dedup(docs).select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, ws[i:i + 12] AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS least FROM win) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM hit),
word AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word FROM w),
kept AS (SELECT word.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY word.p) AS t FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""
