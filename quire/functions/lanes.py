"""Edit distances of many pairs at once: the columns of all pairs side by side in 64-bit words (Myers 1999, Hyyro 2003), or fronts side by side (Ukkonen 1985)."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Sequence

import numpy as np

from quire.functions.edit import _COLUMN, _FEW_PAIRS, _ITEM, _by_columns, _candidates, _codes, _most_similar, asking_partners, similarity, trimmed

#: Pairs that are worth being measured at once, and pairs and bytes that one turn takes at most.
_LANES, _MOST_LANES, _TABLE = 24, 4096, 64 << 20
#: Pairs whose fronts are moved on at once; up to this share of the lengths that many edits are looked for by fronts, in texts of more than so many items; items that tell where a text's beginning went.
_FRONT_LANES, _SHARE, _SHORT, _PROBE = 256, 0.15, 24, 16
#: What a place of a front costs, in words of a column.
_FRONT_CELL = 0.6
#: Times that eight windows of eight bytes are compared for all places at once, before those that are still equal are followed one by one.
_WINDOWS = 2
#: Lines of more letters are measured as whole texts are; letters of pairs of lines that wait for each other, at most.
_LONG, _AT_ONCE = 1000, 16 << 20
#: Items from one edit to the next, on average, below which edits do not lie apart.
_APART = 4
#: What a step over a column of all pairs costs, and each word of it, in about microseconds.
_STEP, _CELL = 50.0, 0.013
#: Columns after which pairs that cannot keep their limit are left out.
_LOOK = 32


def _matrix(texts: Sequence[np.ndarray], before: int, after: int, fill: int, dtype: type) -> np.ndarray:
    """Texts as rows, with `before` fills in front and at least `after` behind."""
    sizes = np.array([len(x) for x in texts], np.int64)
    out = np.full((len(texts), before + int(sizes.max()) + after), fill, dtype)
    row = np.repeat(np.arange(len(texts)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + before] = np.concatenate(texts)
    return out


def _renumbered(a: Sequence[np.ndarray], b: Sequence[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """The same texts with small codes, and how many there are."""
    every = np.concatenate([*a, *b])
    seen = np.zeros(int(every.max()) + 1, np.int64)
    seen[every] = 1
    kinds = int(seen.sum())
    to = (np.cumsum(seen) - 1).astype(np.uint8 if kinds < 250 else np.uint16 if kinds < 65500 else np.int64)  # with room for fills
    return [to[x] for x in a], [to[x] for x in b], kinds


def _sum(eq: np.ndarray, up: np.ndarray) -> np.ndarray:
    """(eq & up) + up, carried from word to word."""
    s = eq & up
    s += up
    if len(s) > 1:
        carry = (s < up)[:-1]
        while carry.any():
            s[1:] += carry
            carry = np.concatenate([np.zeros_like(carry[:1]), (carry & (s[1:] == 0))[:-1]])
    return s


def _windows(texts: Sequence[np.ndarray], fill: int, dtype: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all texts end to end; the eight bytes that begin at each place; where each text begins). Fills stand between texts."""
    sizes = np.array([len(x) for x in texts], np.int64)
    starts = np.cumsum(sizes + 8) - sizes - 8
    flat = np.full(int(sizes.sum()) + 8 * len(texts) + 8, fill, dtype)
    flat[np.arange(int(sizes.sum())) + 8 * np.repeat(np.arange(len(texts)), sizes)] = np.concatenate(texts)
    return flat, np.ascontiguousarray(np.ndarray(len(flat) - 8, "<u8", flat.tobytes(), strides=(flat.itemsize,))), starts


def _equal(x: np.ndarray, p: int, y: np.ndarray, q: int) -> int:
    """How many items are equal from p and q on; some are not."""
    start, step = p, 64
    while not (differ := x[p : p + step] != y[q : q + step]).any():
        p, q, step = p + step, q + step, min(4 * step, 1 << 16)
    return p + int(differ.argmax()) - start


_Extend = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def _along(a: Sequence[np.ndarray], b: Sequence[np.ndarray], kinds: int) -> tuple[_Extend, _Extend, np.ndarray, np.ndarray]:
    """(extend, look, and where each text of a and b begins in them); the texts have codes below kinds.

    extend moves places i of a on along the diagonals k (place in a less place in b) over all that is equal; look tells how many items are
    equal in the next window alone. Both take where the texts begin as well.
    """
    dtype = np.uint8 if kinds < 254 else np.uint16 if kinds < 65534 else np.uint32
    per = 8 // np.dtype(dtype).itemsize
    (x_flat, x, xs), (y_flat, y, ys) = _windows(a, kinds, dtype), _windows(b, kinds + 1, dtype)
    end = np.full(1 << 17, kinds + 1, dtype)
    x_flat, y_flat = np.concatenate([x_flat, end - 1]), np.concatenate([y_flat, end])
    item, one, ahead = np.uint64({8: 3, 4: 4, 2: 5}[per]), np.uint64(1), per * np.arange(8)

    def run(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        apart = x.take(p, mode="clip") ^ y.take(q, mode="clip")
        return (np.bitwise_count((apart & (~apart + one)) - one) >> item.astype(np.uint8)).astype(np.int64)

    def look(i: np.ndarray, k: np.ndarray, xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
        p = i + xs
        return run(p, p - (k + (xs - ys)))

    def extend(i: np.ndarray, k: np.ndarray, xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
        p = i + xs
        q = p - (k + (xs - ys))
        equal = run(p, q)
        i += equal
        if len(at := np.flatnonzero(equal == per)):
            flat, p, q = i.reshape(-1), p.reshape(-1)[at] + per, q.reshape(-1)[at] + per
            for _ in range(_WINDOWS):
                apart = x.take(p[:, None] + ahead, mode="clip") ^ y.take(q[:, None] + ahead, mode="clip")
                first = (apart != 0).argmax(1)
                apart = apart[np.arange(len(at)), first]
                equal = per * first + (np.bitwise_count((apart & (~apart + one)) - one) >> item.astype(np.uint8))
                on = apart == 0
                equal[on] = len(ahead) * per
                flat[at] += equal
                at, p, q = at[on], p[on] + len(ahead) * per, q[on] + len(ahead) * per
                if not len(at):
                    break
            for z, v, w in zip(at.tolist(), p.tolist(), q.tolist(), strict=True):  # long stretches
                flat[z] += _equal(x_flat, v, y_flat, w)
        return i

    return extend, look, xs, ys


def _within_one(piece: str, text: str, low: int, high: int) -> bool:
    """Whether text has the piece with one edit or none from low to high: then one half of it is there as it is, and beyond that half one
    edit at the first difference is enough.
    """
    half = len(piece) // 2
    if not half:
        return True
    text = text[low:high]
    for turned in (False, True):
        first, rest = (piece[:half], piece[half:]) if not turned else (piece[half:][::-1], piece[:half][::-1])
        of = text[::-1] if turned else text
        at = of.find(first)
        while at >= 0:
            q, p = at + len(first), 0
            while p < len(rest) and q < len(of) and rest[p] == of[q]:
                p, q = p + 1, q + 1
            if p >= len(rest) - 1 or of.startswith(rest[p + 1 :], q) or of.startswith(rest[p + 1 :], q + 1) or of.startswith(rest[p:], q + 1):
                return True
            at = of.find(first, at + 1)
    return False


def _where_apart(a: Sequence[np.ndarray], b: Sequence[np.ndarray], most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distances of pairs whose edits lie apart, else -1; as many edits as are enough, else most[i] + 1).

    A walk along both texts takes, where they differ, the edit after which they agree for longest: so many edits are enough. They
    are needed if each piece of a from one edit to the next, with what differs there, is nowhere in b within reach, since
    an alignment that leaves a piece as it is finds it whole in b, and pieces share no edit; a piece of two edits must not be
    there with one. An item before and one behind both texts tells their ends.
    """
    a, b, kinds = _renumbered(a, b)
    n, m = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    found, enough = np.full(len(a), -1, np.int64), most + 1
    if kinds > 1 << 20:
        return found, enough
    a, b = ([np.append(x, x.dtype.type(kinds)) for x in side] for side in (a, b))
    extend, look, xs, ys = _along(a, b, kinds + 1)
    lane, i, k, steps = np.arange(len(a)), np.zeros(len(a), np.int64), np.zeros(len(a), np.int64), []
    moves = np.array([[1, 0], [1, 1], [0, -1]], np.int64)  # of place and diagonal: replaced, left out of a, put in from b
    ended: list[np.ndarray] = []
    while len(lane):
        i = extend(i, k, xs, ys)
        over = i > n
        if over.any():
            ended.append(lane[over])
            enough[lane[over]] = len(steps)
        e = len(steps)
        if len(keep := np.flatnonzero(~over & (e < most[lane]) & ((e < _LANES) | (i >= _APART * e)))) < len(lane):
            lane, i, k, n, m, xs, ys = lane[keep], i[keep], k[keep], n[keep], m[keep], xs[keep], ys[keep]
        steps.append((lane, i.copy()))
        at, on = i + moves[:, :1], k + moves[:, 1:]
        gain = look(at, on, xs, ys)
        window = gain.max(initial=0)
        if window >= 2:
            gain = np.where(gain == window, window + look(at + window, on, xs, ys), gain)
        gain[:2, i == n] = -1  # a's last item stays
        gain[::2, i - k == m] = -1
        way = gain.argmax(0)
        i, k = i + moves[way, 0], k + moves[way, 1]
    if not ended:
        return found, enough
    every, place = (np.concatenate([s[x] for s in steps]) for x in (0, 1))
    order = np.argsort(every, kind="stable")
    starts, place = np.searchsorted(every[order], np.arange(len(a) + 1)), place[order]
    text = lambda x: chr(kinds + 1) + x.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    for z in np.concatenate(ended).tolist():
        d = int(enough[z])
        x, y, start, waits = text(a[z]), text(b[z]), 0, 0
        for at in place[starts[z] : starts[z] + d].tolist():
            waits += 1
            piece, low, high = x[start : at + 2], max(0, start - d), at + 2 + d
            if not piece or (y.find(piece, low, high) >= 0 if waits == 1 else waits > 2 or _within_one(piece, y, low, high)):
                continue  # too few edits are sure: on to the next one
            start, waits = at + 2, 0
        if not waits:
            found[z] = d
    return found, enough


def _by_fronts(a: Sequence[np.ndarray], b: Sequence[np.ndarray], most: np.ndarray) -> np.ndarray:
    """Distances of most[i] or less, else -1: the furthest places that e edits reach on the diagonals, of all pairs side by side."""
    a, b, kinds = _renumbered(a, b)
    n, m = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    extend, _, xs, ys = _along(a, b, kinds)
    out, lane, aim = np.full(len(a), -1, np.int64), np.arange(len(a)), n - m
    none, e, half = np.int64(-1 << 40), 0, max(32, int(aim.max()) + 1)
    far = np.full((2 * half + 3, len(a)), none)
    far[half + 1] = extend(np.zeros((1, len(a)), np.int64), np.zeros((1, 1), np.int64), xs, ys)[0]
    while True:
        done = far[half + 1 + aim, np.arange(len(lane))] >= n
        if (gone := done | (e >= most)).any():
            out[lane[done]] = e
            keep = np.flatnonzero(~gone)
            if not len(keep):
                return out
            lane, n, m, aim, most, xs, ys, far = lane[keep], n[keep], m[keep], aim[keep], most[keep], xs[keep], ys[keep], np.ascontiguousarray(far[:, keep])
        e += 1
        if e > half:
            far = np.concatenate([np.full((half, len(lane)), none), far, np.full((half, len(lane)), none)])
            half *= 2
        low, high = max(-e, e - int((most - aim).max())), min(e, int((aim + most).max()) - e)  # diagonals from which the end is in reach
        near = far[half + low : half + high + 3]
        k = np.arange(low, high + 1)[:, None]
        i = np.maximum(near[1:-1], near[:-2])  # replaced, left out of a; put in from b below
        i += 1
        np.maximum(i, near[2:], out=i)
        np.minimum(i, n, out=i)
        np.minimum(i, m + k, out=i)
        far[half + 1 + low : half + 2 + high] = extend(i, k, xs, ys)


def _in_band(a: Sequence[np.ndarray], b: Sequence[np.ndarray], words: int) -> np.ndarray:
    """Distances d with d + n - m <= 2 k, k = 32 * words - 1, which never leave the k diagonals beside the main one; else -1. Texts of a, n long,
    are no shorter than those of b, m long, and no shorter than k; b's are sorted, longest first. A window of 64 * words rows goes
    down the diagonal with the columns.
    """
    k, width = 32 * words - 1, 64 * words
    a, b, kinds = _renumbered(a, b)
    dtype = np.uint8 if kinds < 255 else np.uint16 if kinds < 65535 else np.uint32
    n, m = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    rows, columns = _matrix(a, width - k - 1, k + width, kinds, dtype), np.ascontiguousarray(_matrix(b, 0, 0, kinds + 1, dtype).T)
    out, one, last = np.full(len(a), -1, np.int64), np.uint64(1), np.uint64(63)
    lane, live = np.arange(len(a)), len(a)
    first = np.array([max(0, min(64, 64 * (w + 1) - (width - k - 1))) for w in range(words)], np.int64)  # rows from 1 on, in each word
    up = np.repeat(np.array([((1 << int(f)) - 1) << (64 - int(f)) for f in first], np.uint64)[:, None], len(a), 1)
    down, score = np.zeros_like(up), np.full(len(a), k, np.int64)
    for t in range(columns.shape[0]):
        if t % _LOOK == 0 and t:
            kept = np.flatnonzero(score <= 3 * k - 2 * (n[lane] - m[lane]))
            if len(kept) < 0.8 * len(lane):
                lane, score, up, down = lane[kept], score[kept], np.ascontiguousarray(up[:, kept]), np.ascontiguousarray(down[:, kept])
                rows, columns = rows[kept], np.ascontiguousarray(columns[:, kept])
            if not len(lane):
                break
        hits = rows[:, t : t + width] == columns[t][:, None]
        eq = np.ascontiguousarray(np.packbits(hits, axis=1, bitorder="little").view("<u8").T)
        zero = _sum(eq, up)
        zero ^= up
        zero |= eq
        zero |= down
        more, less = down | ~(zero | up), zero & up
        score += (zero[-1] >> last ^ one).astype(np.int64)
        moved = zero >> one
        moved[:-1] |= zero[1:] << last
        up, down = less | ~(moved | more), moved & more
        live = int(np.searchsorted(-m[lane], -(t + 1), side="left"))  # pairs whose text of b is longer than this column
        if live < len(lane):
            for x in range(live, len(lane)):  # back from the band's last row to the text's
                i = lane[x]
                rest = ((1 << int(k - n[i] + m[i])) - 1) << int(width - 1 - k + n[i] - m[i])
                value = lambda v: sum(int(w) << 64 * j for j, w in enumerate(v[:, x].tolist()))  # noqa: B023, E731
                d = int(score[x]) - (value(up) & rest).bit_count() + (value(down) & rest).bit_count()
                out[i] = d if d + n[i] - m[i] <= 2 * k else -1
            lane, score, up, down, rows, columns = lane[:live], score[:live], np.ascontiguousarray(up[:, :live]), np.ascontiguousarray(down[:, :live]), rows[:live], columns[:, :live]
            if not live:
                break
    return out


def _whole(a: Sequence[np.ndarray], of: np.ndarray, b: Sequence[np.ndarray], most: np.ndarray) -> np.ndarray:
    """Distances of a[of[i]] and b[i], all rows of each column; more than most[i] where it is more. All a have one number of words; b's are
    sorted, longest first.
    """
    words = -(-len(a[0]) // 64)
    a, b, kinds = _renumbered(a, b)
    m, sizes = np.array([len(x) for x in b], np.int64), np.array([len(x) for x in a], np.int64)
    flat, row = np.concatenate(a), np.repeat(np.arange(len(a)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    same = np.zeros((words, len(a) * kinds), np.uint64)
    np.add.at(same, (place >> 6, row * kinds + flat), np.uint64(1) << (place & 63).astype(np.uint64))  # each bit once
    columns = np.ascontiguousarray(_matrix(b, 0, 0, 0, np.int32 if kinds < 1 << 31 else np.int64).T)
    base, top, one, last = of * kinds, ((sizes[of] - 1) & 63).astype(np.uint64), np.uint64(1), np.uint64(63)
    out, lane, score = most + 1, np.arange(len(b)), sizes[of].copy()
    up, down = np.full((words, len(b)), ~np.uint64(0)), np.zeros((words, len(b)), np.uint64)
    for t in range(columns.shape[0]):
        eq = np.take(same, base + columns[t], axis=1)
        zero = _sum(eq, up)
        zero ^= up
        zero |= eq
        zero |= down
        more, less = down | ~(zero | up), zero & up
        score += (more[-1] >> top & one).astype(np.int64) - (less[-1] >> top & one).astype(np.int64)
        moved, fewer = more << one, less << one
        moved[0] |= one
        moved[1:] |= more[:-1] >> last
        fewer[1:] |= less[:-1] >> last
        up, down = fewer | ~(zero | moved), zero & moved
        live = int(np.searchsorted(-m[lane], -(t + 1), side="left"))
        if live < len(lane):
            out[lane[live:]] = score[live:]
            keep = np.arange(live)
        elif t % _LOOK == _LOOK - 1:
            keep = np.flatnonzero(score - (m[lane] - t - 1) <= most[lane])
            if len(keep) > 0.8 * len(lane):
                continue
        else:
            continue
        lane, score, base, top, up, down = lane[keep], score[keep], base[keep], top[keep], np.ascontiguousarray(up[:, keep]), np.ascontiguousarray(down[:, keep])
        columns = columns[:, :live] if len(keep) == live else np.ascontiguousarray(columns[:, keep])
        if not len(lane):
            break
    return out


def _turns(picked: np.ndarray, steps: np.ndarray, fixed: int, lanes: int = _MOST_LANES, size: np.ndarray | None = None, like: int = 2) -> list[np.ndarray]:
    """Pairs, most steps first, in turns of like numbers of steps (a like-th at least); fixed: bytes of a pair apart from those for its size (its steps)."""
    picked = picked[np.argsort(-steps[picked], kind="stable")]
    out, start = [], 0
    while start < len(picked):
        most, size_ = int(steps[picked[start]]), steps if size is None else size
        end = start + int(np.searchsorted(-steps[picked[start:]], -(most // like), side="left"))
        room = np.cumsum(fixed + 16 * (size_[picked[start : max(end, start + 1)]] + most))
        out.append(picked[start : start + max(1, min(lanes, int(np.searchsorted(room, _TABLE))))])
        start += len(out[-1])
    return out


def _bound(a: np.ndarray, b: np.ndarray) -> int:
    """As many edits, or fewer: places that differ, as the texts stand or with the beginning of one moved to where the other has it."""
    n, m = len(a), len(b)
    moves = [(0, 0)]
    if n > _PROBE < m:
        for x, y, move in ((a, b, (1, 0)), (b, a, (0, 1))):
            if (at := x.tobytes().find(y[:_PROBE].tobytes())) > 0 and at % x.itemsize == 0:
                moves.append((move[0] * at // x.itemsize, move[1] * at // x.itemsize))
    sizes = [(i, j, min(n - i, m - j)) for i, j in moves]
    return min(n + m - 2 * both + int(np.count_nonzero(a[i : i + both] != b[j : j + both])) for i, j, both in sizes)


def _alone(a: np.ndarray, b: np.ndarray) -> int:
    """The distance of one pair; a, the longer one, lies in the bits."""
    kinds = np.unique(b).tolist() if len(a) > 2000 else ()
    if not kinds or 16 * len(kinds) > len(a):
        return _by_columns(a.tolist(), b.tolist())
    return _by_columns(a, b.tolist(), {c: int.from_bytes(np.packbits(a == c, bitorder="little").tobytes(), "little") for c in kinds})


def edit_distances(pairs: Sequence[tuple[Sequence[Hashable], Sequence[Hashable]]]) -> list[int]:
    """edit_distance of each pair. Pairs with few edits are measured together by fronts, texts of one length with many in a band that holds
    the places in which they differ, others over whole columns; pairs that have no others of like lengths alone.
    """
    out = np.zeros(len(pairs), np.int64)
    ids, longer, shorter = [], [], []
    for i, (a, b) in enumerate(pairs):
        if a is b or a == b:
            continue
        a, b = trimmed(a, b)
        if not a or not b:
            out[i] = len(a) + len(b)
        else:
            x, y = _codes(a, b) if len(a) >= len(b) else _codes(b, a)
            ids.append(i)
            longer.append(x)
            shorter.append(y)
    if not ids:
        return out.tolist()
    n, m, found = np.array([len(x) for x in longer], np.int64), np.array([len(x) for x in shorter], np.int64), np.full(len(ids), -1, np.int64)
    of = lambda turn: ([longer[x] for x in turn.tolist()], [shorter[x] for x in turn.tolist()])
    most = (_SHARE * np.sqrt(n * m)).astype(np.int64)
    bound = np.array([_bound(*x) for x in zip(longer, shorter, strict=True)], np.int64)
    words = (bound + n - m + 65) // 64  # of a band that is sure to hold the distance
    sure = np.where(bound * 5 < 2 * n, np.inf, 0.0)  # where nothing tells how many edits there are, fronts are tried
    cost = np.array([np.where(bound <= most, _FRONT_CELL / 2 * bound**2, sure), words * m, -(-m // 64) * n])  # of fronts, a band, whole columns
    cost[0, (n - m > most) | (n <= _SHORT)] = cost[1, 32 * words - 1 > n] = np.inf
    way = cost.argmin(0)
    limit = np.where(bound <= np.maximum(most, n // 3), bound, most)
    reach = np.maximum(limit, n // _APART)
    for turn in _turns(np.flatnonzero((way < 2) & (n - m <= reach) & (n > _SHORT) & ((way == 0) | (bound * 6 < n))), n, 64, like=1 << 40):
        if len(turn) >= _LANES:
            found[turn], enough = _where_apart(*of(turn), reach[turn])
            limit[turn] = np.where(enough <= reach[turn], enough, limit[turn])
    for w in np.unique(words[way == 1]).tolist():
        for turn in _turns(np.flatnonzero((way == 1) & (found < 0) & (words == w)), m, 512 * w):
            if len(turn) >= _LANES:
                found[turn] = _in_band(*of(turn), w)
            else:
                way[turn] = 0
    for turn in _turns(np.flatnonzero((way == 0) & (found < 0) & (n - m <= limit)), limit, 64, _FRONT_LANES, n):
        found[turn] = _by_fronts(*of(turn), limit[turn])
    tall = -(-m // 64)
    for w in np.unique(tall[found < 0]).tolist():  # the shorter text lies in the bits
        for turn in _turns(np.flatnonzero((found < 0) & (tall == w)), n, 1024 * w):
            together = int(n[turn[0]]) * (_STEP + _CELL * w * len(turn))
            if together < int((m[turn] * (_COLUMN + _ITEM * n[turn])).sum()) and len(turn) >= (_LANES if m[turn[0]] > 16 else 8 * _LANES):
                a, b = of(turn)
                found[turn] = _whole(b, np.arange(len(turn)), a, n[turn])
            else:
                found[turn] = [_alone(*pair) for pair in zip(*of(turn), strict=True)]
    out[ids] = found
    return out.tolist()


def _within(pairs: Sequence[tuple[str, str]], most: np.ndarray) -> np.ndarray:
    """Distances of different texts; more than most[i] where they are more. A text that many pairs have is prepared once a turn."""
    ordered = [(a, b) if len(a) <= len(b) else (b, a) for a, b in pairs]
    m, n = (np.array([len(x[s]) for x in ordered], np.int64) for s in (0, 1))
    out = np.where(m == 0, n, -1)
    long = np.flatnonzero(m > _LONG)
    out[long] = edit_distances([ordered[x] for x in long.tolist()])
    tall = -(-m // 64)
    for w in np.unique(tall[out < 0]).tolist():
        for turn in _turns(np.flatnonzero((out < 0) & (tall == w)), n, 64 * w):
            if len(turn) < _LANES:
                out[turn] = edit_distances([ordered[x] for x in turn.tolist()])
                continue
            of: dict[str, int] = {}
            place = np.array([of.setdefault(ordered[x][0], len(of)) for x in turn.tolist()], np.int64)
            code = {t: np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for t in {*of, *(ordered[x][1] for x in turn.tolist())}}
            out[turn] = _whole([code[t] for t in of], place, [code[ordered[x][1]] for x in turn.tolist()], most[turn])
    return out


def similar_lines_of(pages: Sequence[tuple[Sequence[str], Sequence[str]]], least: float) -> list[list[tuple[int, int, float]]]:
    """similar_lines of each page. Pairs of lines that bounds leave over are measured for many pages at once, the same two lines once."""
    out: list[list[tuple[int, int, float]]] = [[] for _ in pages]
    waiting: list[tuple[int, int, int, int]] = []  # page, i, j, place in pairs (-1: equal lines)
    known: dict[tuple[str, str], int] = {}

    def measured() -> None:
        longest = np.array([max(len(a), len(b)) for a, b in known], np.int64)
        d = _within(list(known), np.floor((1 - least) * longest + 1e-9).astype(np.int64)) if known else longest
        alike = (1.0 - d / np.maximum(longest, 1)).tolist()
        for k, i, j, x in waiting:
            if (s := alike[x] if x >= 0 else 1.0) >= least:
                out[k].append((i, j, s))
        waiting.clear()
        known.clear()

    size = 0
    for k, (a, b) in enumerate(pages):
        if not len(a) or not len(b):
            continue
        few = len(a) * len(b) <= _FEW_PAIRS
        for i, j in np.argwhere(_most_similar(a, b) >= least).tolist() if few else ((i, j) for i, found in _candidates(a, b, least) for j in found.tolist()):
            p, q = (a[i], b[j]) if a[i] <= b[j] else (b[j], a[i])
            if p != q and (p, q) not in known:
                size += len(p) + len(q)
            waiting.append((k, i, j, -1 if p == q else known.setdefault((p, q), len(known))))
            if size > _AT_ONCE or len(waiting) > _AT_ONCE // 32:
                measured()
                size = 0
    measured()
    return out


def partners_of(pages: Sequence[tuple[Sequence[str], Sequence[str]]], least: float) -> list[list[tuple[int, int, float]]]:
    """partners of each page. Pages go on side by side: the two lines that each asks for next are measured for all of them together."""
    out: list[list[tuple[int, int, float]]] = [[] for _ in pages]
    live = [(k, asking_partners(a, b, least), None) for k, (a, b) in enumerate(pages)]
    while live:
        asked = []
        for k, asking, answer in live:
            try:
                asked.append((k, asking, asking.send(answer)))
            except StopIteration as found:
                out[k] = found.value
        if len(asked) < _LANES:
            live = [(k, asking, similarity(*both)) for k, asking, both in asked]
            continue
        apart = edit_distances([both for _, _, both in asked])
        live = [(k, asking, 1.0 - d / max(len(both[0]), len(both[1])) if d else 1.0) for (k, asking, both), d in zip(asked, apart, strict=True)]
    return out
