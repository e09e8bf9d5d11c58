"""Edit distance by fronts (Ukkonen 1985) or with the bits of a column in integers (Myers 1999, Hyyro 2003), and alignment of lines."""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Generator, Hashable, Iterator, Sequence
from heapq import heapify, heappop, heappush
from typing import Any, NamedTuple

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view


#: What the two ways cost, in about microseconds: a column of bits and each of its items; a front and each edit that it is wide.
_COLUMN, _ITEM, _FRONT, _WIDER = 2.5, 0.0005, 80.0, 0.2
#: Places that a front's diagonals are moved on at once.
_STEP = 32
#: Texts that are not worth being measured all at once.
_FEW = 40
#: Pairs of lines up to which bounds of all pairs are cheaper than an index.
_FEW_PAIRS = 10_000


def trimmed(a: Sequence[Hashable], b: Sequence[Hashable]) -> tuple[Sequence[Hashable], Sequence[Hashable]]:
    """a and b without what both begin and end with, which changes no distance; found by comparing stretches that halve."""
    if not a or not b:
        return a, b
    for side in (0, 1):
        start, most = 0, min(len(a), len(b))
        if (a[0] == b[0]) if not side else (a[-1] == b[-1]):
            step = 1 << most.bit_length()
            while step:
                if start + step <= most and (a[start : start + step] == b[start : start + step] if not side else a[len(a) - start - step : len(a) - start] == b[len(b) - start - step : len(b) - start]):
                    start += step
                step >>= 1
        a, b = (a[start:], b[start:]) if not side else (a[: len(a) - start], b[: len(b) - start])
        if not a or not b:
            break
    return a, b


def edit_distance(a: Sequence[Hashable], b: Sequence[Hashable]) -> int:
    """Insertions, deletions and replacements that turn a into b: strings by code point, or lists of tokens.

    Fronts of furthest places, one for each number of edits, go on for as long as they may be cheaper than columns of bits: texts
    with few edits take time by these, others by their lengths. Both ways are exact.
    """
    if a == b:
        return 0
    a, b = trimmed(a, b)
    if len(a) < len(b):
        a, b = b, a  # a, the longer one, lies in the bits; one step for each item of b
    if not b:
        return len(a)
    most = int((math.sqrt(_FRONT**2 + 2 * _WIDER * 0.7 * len(b) * (_COLUMN + _ITEM * len(a))) - _FRONT) / _WIDER)
    if len(a) - len(b) <= most and most > 8:
        x, y = _codes(a, b)
        if (d := _by_fronts(x, y, most)) is not None:
            return d
    return _by_columns(a, b)


def _codes(a: Sequence[Hashable], b: Sequence[Hashable]) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(a, str) and isinstance(b, str):
        return tuple(np.frombuffer(x.encode("utf-32-le", "surrogatepass"), "<u4") for x in (a, b))  # type: ignore[return-value]
    number = {v: k for k, v in enumerate(dict.fromkeys([*a, *b]))}
    return tuple(np.fromiter(map(number.__getitem__, x), np.uint32, len(x)) for x in (a, b))  # type: ignore[return-value]


def _by_fronts(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """The distance if it is `most` or less, else None: on each diagonal the furthest place that e edits reach, for e = 0, 1, ... (Ukkonen 1985).

    Also None when the places reached so far tell that `most` edits are by far too few.
    """
    n, m = len(a), len(b)
    x = sliding_window_view(np.r_[a.astype(np.int64), np.full(_STEP, -1)], _STEP)
    y = sliding_window_view(np.r_[b.astype(np.int64), np.full(_STEP, -2)], _STEP)
    aim = n - m

    def extend(i: np.ndarray, k: np.ndarray) -> np.ndarray:
        """i, moved on along the diagonals k (place in a less place in b) over all that is equal."""
        at = np.flatnonzero((i < n) & (i - k < m) & (i >= 0) & (i >= k))
        while len(at):
            same = x[i[at]] == y[i[at] - k[at]]
            run = np.where(same.all(1), _STEP, same.argmin(1))
            i[at] += run
            at = at[run == _STEP]
        return i

    low, high, far = 0, 0, extend(np.zeros(1, np.int64), np.zeros(1, np.int64))
    none = np.int64(-1 << 40)
    for e in range(most + 1):
        if low <= aim <= high and far[aim - low] >= n:
            return e
        if e & 15 == 15 and e * n > 2 * most * max(1, int(far.max())):
            return None
        k = np.arange(max(low - 1, -m), min(high + 1, n) + 1)
        wide = np.full(len(far) + 4, none)
        wide[2:-2] = far
        at = k - low + 2
        i = np.maximum(np.maximum(wide[at] + 1, wide[at - 1] + 1), wide[at + 1])  # replaced, left out of a, put in from b
        i = np.minimum(np.minimum(i, n), m + k)
        keep = np.abs(k - aim) <= most - e
        k, i = k[keep], i[keep]
        if not len(k):
            return None
        low, high, far = int(k[0]), int(k[-1]), extend(i, k)
    return None


def _by_columns(a: Sequence[Hashable], b: Sequence[Hashable], at: dict[Hashable, int] | None = None) -> int:
    """at: the places of each item of b in a, as bits, if they are known."""
    if at is None:
        at = {}
        for i, x in enumerate(a):
            at[x] = at.get(x, 0) | 1 << i
    every, top, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down = every, 0  # rows where the next cell is one more, or one less
    for y in b:
        same = at.get(y, 0)
        reach = (((same & up) + up) ^ up) | same | down
        more, less = down | (every & ~(reach | up)), up & reach
        if more & top:
            score += 1
        elif less & top:
            score -= 1
        more, less = (more << 1 | 1) & every, (less << 1) & every
        up, down = less | (every & ~((same | down) | more)), more & (same | down)
    return score


def distances(a: str, others: Sequence[str], most: np.ndarray) -> np.ndarray:
    """Edit distances of a to each of the others, all at once in 64-bit words; more than most[j] where it is more than that.

    A text whose distance can no longer be most[j] or less is left out of the columns to come.
    """
    if len(others) < _FEW:
        return np.array([edit_distance(a, x) for x in others], np.int64)
    out, sizes = np.full(len(others), len(a), np.int64), np.array([len(x) for x in others], np.int64)
    if not len(a):
        return sizes
    lane = np.flatnonzero(sizes)
    letters, number = np.unique(np.frombuffer("".join([a, *others]).encode("utf-32-le", "surrogatepass"), "<u4"), return_inverse=True)
    texts = np.full((len(others), int(sizes.max(initial=0))), len(letters), np.int64)
    texts[np.arange(texts.shape[1]) < sizes[:, None]] = number[len(a) :]
    words = -(-len(a) // 64)
    same = np.zeros((words, len(letters) + 1), np.uint64)
    for i, c in enumerate(number[: len(a)].tolist()):
        same[i >> 6, c] |= np.uint64(1 << (i & 63))
    one, top = np.uint64(1), [np.uint64(63)] * (words - 1) + [np.uint64((len(a) - 1) & 63)]
    up, down = np.full((words, len(lane)), ~np.uint64(0)), np.zeros((words, len(lane)), np.uint64)
    score = np.full(len(lane), len(a), np.int64)
    for t in range(texts.shape[1]):
        c = texts[lane, t]
        more_in, less_in = np.ones(len(lane), np.uint64), np.zeros(len(lane), np.uint64)
        for w in range(words):
            eq, p, q = same[w][c], up[w], down[w]
            held = eq | q
            eq = eq | less_in
            reach = (((eq & p) + p) ^ p) | eq
            more, less = q | ~(reach | p), p & reach
            more_out, less_out = more >> top[w] & one, less >> top[w] & one
            more, less = more << one | more_in, less << one | less_in
            up[w], down[w] = less | ~(held | more), more & held
            more_in, less_in = more_out, less_out
        score += more_in.astype(np.int64) - less_in.astype(np.int64)
        ended = sizes[lane] == t + 1
        if ended.any() or t & 15 == 15:
            out[lane[ended]] = score[ended]
            lost = ~ended & (score - (sizes[lane] - t - 1) > most[lane])
            out[lane[lost]] = most[lane[lost]] + 1
            if (gone := ended | lost).any():
                lane, score, up, down = lane[~gone], score[~gone], up[:, ~gone], down[:, ~gone]
    return out


def similarity(a: str, b: str) -> float:
    longest = max(len(a), len(b))
    return 1.0 - edit_distance(a, b) / longest if longest else 1.0


class LineOrder(NamedTuple):
    """char_edits: of the reference and the prediction with its lines in the reference's order."""

    char_edits: int
    concordant: int
    pairs: int
    matched: int
    ref_lines: int
    pred_lines: int


def _grams(lines: Sequence[str], q: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the gram, line) of all runs of q letters; the second time that a line has a run, it is another gram."""
    number: dict[tuple[str, int], int] = {}
    grams, of = [], []
    for k, x in enumerate(lines):
        times: dict[str, int] = {}
        for i in range(len(x) - q + 1):
            g = x[i : i + q]
            times[g] = t = times.get(g, 0) + 1
            grams.append(number.setdefault((g, t), len(number)))
            of.append(k)
    return np.array(grams, np.int64), np.array(of, np.int64)


def _candidates(a: Sequence[str], b: Sequence[str], least: float) -> Iterator[tuple[int, np.ndarray]]:
    """(i, all j) whose similarity may be `least`: a pair of d edits shares all but q d of its runs of q letters, and a run leads
    to the lines that have it. Runs of two letters serve where they tell anything, else single letters do.
    """
    q = 2 if least > 0.55 else 1
    grams, of = _grams([*a, *b], q)
    mine, theirs = of < len(a), of >= len(a)
    order = np.argsort(grams[theirs], kind="stable")
    lines, ends = of[theirs][order] - len(a), np.r_[0, np.cumsum(np.bincount(grams[theirs], minlength=int(grams.max(initial=-1)) + 1))]
    own, start = grams[mine], np.searchsorted(of[mine], np.arange(len(a) + 1))
    sizes = np.array([len(x) for x in b], np.int64)
    for i, x in enumerate(a):
        g = own[start[i] : start[i + 1]]
        many = ends[g + 1] - ends[g]
        at = np.arange(int(many.sum())) + np.repeat(ends[g] - (np.cumsum(many) - many), many)
        shared = np.bincount(lines[at], minlength=len(b))
        longest = np.maximum(sizes, len(x))
        fewest = np.maximum(np.abs(sizes - len(x)), -((shared - np.maximum(longest - q + 1, 0)) // q))
        yield i, np.flatnonzero(np.where(longest == 0, 1.0, 1.0 - fewest / np.maximum(longest, 1)) >= least)


def similar_lines(ref_keys: Sequence[str], pred_keys: Sequence[str], least: float) -> list[tuple[int, int, float]]:
    """(i, j, similarity) of all pairs of that similarity or more, by i and j.

    Only pairs that share enough letters, or pairs of letters, are measured, each line with all its candidates at once.
    """
    if not ref_keys or not pred_keys:
        return []
    if len(ref_keys) * len(pred_keys) <= _FEW_PAIRS:
        may = np.argwhere(_most_similar(ref_keys, pred_keys) >= least)
        return [(int(i), int(j), s) for i, j in may if (s := similarity(ref_keys[i], pred_keys[j])) >= least]
    out = []
    for i, j in _candidates(ref_keys, pred_keys, least):
        if not len(j):
            continue
        others = [pred_keys[k] for k in j.tolist()]
        longest = np.maximum(np.array([len(x) for x in others]), len(ref_keys[i]))
        apart = distances(ref_keys[i], others, np.floor((1 - least) * longest + 1e-9).astype(np.int64))
        alike = np.where(longest == 0, 1.0, 1.0 - apart / np.maximum(longest, 1))
        out += [(i, int(k), float(s)) for k, s in zip(j, alike, strict=True) if s >= least]
    return out


def _most_similar(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """For each pair, a similarity that it cannot exceed: edits are no fewer than letters that one has and the other lacks."""
    m, n = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    codes = np.frombuffer("".join([*a, *b]).encode("utf-32-le", "surrogatepass"), "<u4")
    seen = np.zeros(int(codes.max(initial=0)) + 1, np.int64)
    seen[codes] = 1
    letter = (np.cumsum(seen) - 1)[codes]
    rows, kinds = len(a) + len(b), max(1, int(seen.sum()))
    counts = np.bincount(np.repeat(np.arange(rows), np.r_[m, n]) * kinds + letter, minlength=rows * kinds).reshape(rows, kinds)
    p, q = counts[: len(a)], counts[len(a) :]
    apart = np.array([np.abs(q - row).sum(1) for row in p]).reshape(len(a), len(b))
    fewest, longest = (apart + np.abs(m[:, None] - n)) // 2, np.maximum(m[:, None], n)
    return np.where(longest == 0, 1.0, 1.0 - fewest / np.maximum(longest, 1))


#: Asks for the similarity of two lines, and gives what it found out at last.
Asking = Generator[tuple[str, str], float, Any]


def _answered(asking: Asking) -> Any:
    try:
        both = next(asking)
        while True:
            both = asking.send(similarity(*both))
    except StopIteration as found:
        return found.value


def _lazily(ref_keys: Sequence[str], pred_keys: Sequence[str], least: float) -> Asking:
    """Partners of few lines: pairs wait with their bound, and are measured when none that waits could be better."""
    if not ref_keys or not pred_keys:
        return {}
    bound = _most_similar(ref_keys, pred_keys)
    waiting = [(-float(bound[i, j]), False, int(i), int(j)) for i, j in np.argwhere(bound >= least)]
    heapify(waiting)
    partner: dict[int, tuple[int, float]] = {}
    taken: set[int] = set()
    known: dict[tuple[str, str], float] = {}  # the same two lines are measured once
    while waiting:
        s, measured, i, j = heappop(waiting)
        if i in partner or j in taken:
            continue
        if measured:
            partner[i] = j, -s
            taken.add(j)
            continue
        if (both := (ref_keys[i], pred_keys[j])) not in known:
            known[both] = yield both
        if known[both] >= least:
            heappush(waiting, (-known[both], True, i, j))
    return partner


def partners(ref_keys: Sequence[str], pred_keys: Sequence[str], least: float) -> list[tuple[int, int, float]]:
    """(i, j, similarity) by i: lines and their partners, best similarity first, then in order, no line twice."""
    return _answered(asking_partners(ref_keys, pred_keys, least))


def asking_partners(ref_keys: Sequence[str], pred_keys: Sequence[str], least: float) -> Asking:
    """partners, with similarities that are asked for one by one where few lines are left.

    Equal lines find each other by their text. Where few others are left, pairs are measured best bound first. Else the limit falls in steps: lines that still have no partner are compared for
    all pairs above it, which few are while it is high, and taken best first. At the last step few lines are left.
    """
    where: dict[str, list[int]] = {}
    for j, x in enumerate(pred_keys):
        where.setdefault(x, []).append(j)
    waiting = {x: iter(j) for x, j in where.items()}
    partner: dict[int, tuple[int, float]] = {}
    for i, x in enumerate(ref_keys):
        if x in waiting and (j := next(waiting[x], None)) is not None:
            partner[i] = j, 1.0
    taken = {j for j, _ in partner.values()}
    left, right = [i for i in range(len(ref_keys)) if i not in partner], [j for j in range(len(pred_keys)) if j not in taken]
    if len(left) * len(right) <= _FEW_PAIRS:
        found = yield from _lazily([ref_keys[i] for i in left], [pred_keys[j] for j in right], least)
        partner |= {left[i]: (right[j], s) for i, (j, s) in found.items()}
        return [(i, *partner[i]) for i in sorted(partner)]
    for limit in [*(x for x in (0.9, 0.8, 0.7, 0.6) if x > least), least]:
        taken = {j for j, _ in partner.values()}
        left, right = [i for i in range(len(ref_keys)) if i not in partner], [j for j in range(len(pred_keys)) if j not in taken]
        found = similar_lines([ref_keys[i] for i in left], [pred_keys[j] for j in right], limit)
        for i, j, s in sorted(found, key=lambda r: (-r[2], r[0], r[1])):
            if left[i] not in partner and right[j] not in taken:
                partner[left[i]] = right[j], s
                taken.add(right[j])
    return [(i, *partner[i]) for i in sorted(partner)]


def line_order(reference: str, prediction: str, ref_keys: Sequence[str], pred_keys: Sequence[str], least: float, edits: int | None = None) -> LineOrder:
    """Pairs lines by the similarity of their keys and puts the prediction's lines in the reference's order.

    reference, prediction: whole texts. ref_keys, pred_keys: what is compared of their lines, in turn (of those that are not
    blank). Pairs of similarity `least` or more are taken best first, then by the reference's and the prediction's order, if
    neither line is taken. Lines without a partner come last, as they stood. edits: the texts' distance as they are, if known.
    """
    rebuilt, *counts = lines_in_order(prediction, [j for _, j, _ in partners(ref_keys, pred_keys, least)] if ref_keys and pred_keys else None)
    return LineOrder(edits if edits is not None and rebuilt == prediction else edit_distance(reference, rebuilt), *counts, len(ref_keys), len(pred_keys))


def lines_in_order(prediction: str, places: Sequence[int] | None) -> tuple[str, int, int, int]:
    """The prediction with its lines in the reference's order, concordant and all pairs of lines with partners, and how many these are.

    places: of the partners among the prediction's lines that are not blank, in the reference's order; None: one of both has no lines.
    """
    if places is None:
        return prediction, 0, 0, 0
    lines = [x for x in prediction.split("\n") if x.strip()]
    taken = set(places)
    rebuilt = "\n".join([lines[j] for j in places] + [x for j, x in enumerate(lines) if j not in taken])
    concordant, before = 0, []  # places so far, in order
    for j in places:
        concordant += bisect_left(before, j)
        insort(before, j)
    k = len(places)
    return rebuilt, concordant, k * (k - 1) // 2, k
