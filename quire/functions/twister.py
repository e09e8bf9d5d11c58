"""Places far along the stream of random.Random, reached without drawing what lies before them.

Every bit of the Mersenne twister's words follows one linear recurrence over GF(2) (Matsumoto and Nishimura 1998). The words J
places on are sums of the first ones, chosen by x^J modulo the recurrence's polynomial (Haramoto et al. 2008).
Polynomials are integers; bit i is the coefficient of x^i.
"""

from __future__ import annotations

import functools
import random

import numpy as np

# Fixed values of MT19937: words of the state, the middle word, the matrix, the bits of the word above, tempering.
WORDS, MIDDLE, MATRIX, UPPER, LOWER, DEGREE = 624, 397, 0x9908B0DF, 0x80000000, 0x7FFFFFFF, 19937


def words(state: np.ndarray, n: int) -> np.ndarray:
    """The n words that follow a state of 624, as they are before tempering."""
    out = np.r_[state.astype(np.uint32), np.zeros(n, np.uint32)]
    step = WORDS - MIDDLE  # so many new words depend on none of themselves
    for at in range(0, n, step):
        k = min(step, n - at)
        y = (out[at : at + k] & np.uint32(UPPER)) | (out[at + 1 : at + 1 + k] & np.uint32(LOWER))
        out[at + WORDS : at + WORDS + k] = out[at + MIDDLE : at + MIDDLE + k] ^ (y >> np.uint32(1)) ^ np.where(y & np.uint32(1), np.uint32(MATRIX), np.uint32(0))
    return out[WORDS:]


def seeded(seed: int) -> np.ndarray:
    """The state of random.Random(seed) before its first word."""
    return np.array(random.Random(seed).getstate()[1][:WORDS], np.uint32)


@functools.lru_cache(maxsize=1)
def recurrence() -> int:
    """The polynomial of the recurrence, found from one bit of the words that follow some state (Berlekamp and Massey)."""
    bits = words(seeded(1), 2 * DEGREE + 64) & np.uint32(1)
    now, last, length, since, seen = 1, 1, 0, 1, 0
    for i, bit in enumerate(bits.tolist()):
        seen = seen << 1 | bit  # bit j of seen is the sequence's term i - j
        if (now & seen).bit_count() & 1:
            before, now = now, now ^ last << since
            if 2 * length <= i:
                length, last, since = i + 1 - length, before, 0
        since += 1
    return int(f"{now:0{length + 1}b}"[::-1], 2)


_SPREAD = [int(f"{b:08b}".replace("0", "00").replace("1", "01"), 2).to_bytes(2, "little") for b in range(256)]


def _reduced(p: int, modulus: int) -> int:
    high, own = p.bit_length() - 1, modulus.bit_length() - 1
    while high >= own:
        p ^= modulus << (high - own)
        high = p.bit_length() - 1
    return p


def power_of_x(n: int) -> int:
    """x^n modulo the recurrence."""
    modulus, p = recurrence(), 1
    for bit in bin(n)[2:]:
        raw = p.to_bytes((p.bit_length() + 7) // 8, "little")
        p = int.from_bytes(b"".join([_SPREAD[b] for b in raw]), "little") << (bit == "1")
        p = _reduced(p, modulus)
    return p


def state_at(seed: int, place: int) -> tuple[np.ndarray, int]:
    """(state, words of it that are used up) of random.Random(seed) after `place` 32-bit words."""
    start = seeded(seed)
    if place < 4 * DEGREE:
        all_words = np.r_[start, words(start, place + WORDS)]
        whole = place // WORDS * WORDS
        return all_words[whole : whole + WORDS] if place % WORDS == 0 else all_words[whole + WORDS : whole + 2 * WORDS], place % WORDS or WORDS
    # of the first 624 words some bits are the seed's alone; the recurrence holds from the words after them on
    p = power_of_x(place - WORDS)
    first = words(start, p.bit_length() + WORDS)
    state = np.zeros(WORDS, np.uint32)
    for i in np.flatnonzero(np.unpackbits(np.frombuffer(p.to_bytes((p.bit_length() + 7) // 8, "little"), np.uint8), bitorder="little")).tolist():
        state ^= first[i : i + WORDS]
    return state, WORDS


def stream_at(seed: int, draws: int) -> np.random.RandomState:
    """What random.Random(seed) would draw after `draws` calls of random(), each of two words, as numpy's stream of the same numbers."""
    state, used = state_at(seed, 2 * draws)
    out = np.random.RandomState()
    out.set_state(("MT19937", state, used))
    return out
