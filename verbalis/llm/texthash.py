"""Word hashes of many texts at once, as arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

U = np.uint64
_STEP = 0x9E3779B97F4A7C15
_BASE = U(0xD6E8FEB86659FD93)  # odd, so it has an inverse modulo 2**64
_powers: dict[str, np.ndarray] = {}
#: Powers that a worker keeps; a longer batch makes its own and drops them.
KEPT_POWERS = 1 << 19


def nth(k: int | np.ndarray) -> np.ndarray:
    """Well spread odd-stepped numbers, one for every k."""
    return np.asarray(k).astype(U) * np.full(1, _STEP, U) if np.ndim(k) else np.full(1, k * _STEP % (1 << 64), U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits (the splitmix64 finisher)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTES = mix(nth(np.arange(1, 257)))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    if n > KEPT_POWERS:
        return _first_powers(n)
    if len(_powers.get("up", ())) < n:
        _powers["up"], _powers["down"] = _first_powers(1 << max(16, (n - 1).bit_length()))
    return _powers["up"], _powers["down"]


def _first_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, U(pow(int(_BASE), -1, 1 << 64))):
        steps = np.full(n, base, U)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps, out=steps))
    return out[0], out[1]


class Words(NamedTuple):
    """Words of all texts in order: text number, byte range in ``data`` and hash."""

    data: np.ndarray
    text_starts: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def words_of(texts: list[bytes], lower: bool = True) -> Words:
    """Words (runs without white space) of every text, hashed after lower-casing A-Z."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        data = LOWERED[data]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    text_starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if texts else np.empty(0, np.int64)
    inside = ~_SPACE[data]
    change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        change = np.concatenate([[0], change])
    start, end = change[::2], change[1::2]
    up, down = powers(len(data))
    sums = np.cumsum(_BYTES[data] * up[: len(data)], dtype=U)
    before = np.where(start > 0, sums[start - 1], U(0))
    values = mix((sums[end - 1] - before) * down[start])
    return Words(data, text_starts, np.searchsorted(text_starts, start, "right") - 1, start, end, values)


def shingles_of(words: Words, n_texts: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count) of the multiset of word shingles; shorter texts have one shingle of all their words."""
    per_text = np.bincount(words.text, minlength=n_texts)
    first = np.concatenate([[0], np.cumsum(per_text)])
    odd = [nth(2 * j + 1) | U(1) for j in range(size)]
    count = max(0, len(words.hash) - size + 1)
    value = np.zeros(count, U)
    for j in range(size):
        value += mix(words.hash[j : j + count] * odd[j])
    whole = words.text[:count] == words.text[size - 1 : size - 1 + count]
    texts, values = words.text[:count][whole], mix(value[whole])
    short = np.flatnonzero((per_text > 0) & (per_text < size))
    if len(short):
        sums = np.zeros(len(short), U)
        for j in range(size - 1):
            here = per_text[short] > j
            sums[here] += mix(words.hash[first[short[here]] + j] * odd[j])
        sums += per_text[short].astype(U)
        texts, values = np.concatenate([texts, short]), np.concatenate([values, mix(sums)])
    order = np.lexsort((values, texts))
    texts, values = texts[order], values[order]
    if not len(texts):
        return texts, values, np.empty(0, np.int64)
    new = np.concatenate([[True], (texts[1:] != texts[:-1]) | (values[1:] != values[:-1])])
    at = np.flatnonzero(new)
    return texts[at], values[at], np.diff(np.concatenate([at, [len(texts)]]))
