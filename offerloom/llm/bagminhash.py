"""BagMinHash signatures of bags of word shingles, in numpy, and exact bag overlap.

An element of weight w is a set of Poisson processes over the weight axis, which
is cut into unit cells and these into dyadic intervals [0,1), [1,2), [2,4), [4,8),
...: an interval's process has the rate of all its cells, and each of its points
draws a register and a cell. A bag takes the points in cells below w, so bags that
share the element share the points below the smaller weight, and the point that is
first in a register is common to two bags with the probability of their weighted
Jaccard similarity. Points come in order of time; an element is done when its next
one is later than what every register of its bag holds.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE, _STEP = _U(0x9E3779B97F4A7C15), _U(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    step = base
    while len(out) < n:
        out = np.concatenate([out, out * _U(step)])
        step = step * step % (1 << 64)
    return out[:n]


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, bag) of each word of the texts that lie in ``data`` (UTF-8) one after another and end at ``ends``.

    A word is a run of bytes that aren't ASCII white space.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = (data != 32) & ((data < 9) | (data > 13))
    starts_text = np.zeros(n + 1, bool)
    starts_text[0], starts_text[ends] = True, True
    before = np.append(False, inside[:-1])
    after = np.append(inside[1:], False)
    first = np.flatnonzero(inside & (~before | starts_text[:-1]))
    last = np.flatnonzero(inside & (~after | starts_text[1:])) + 1
    base = int(_STEP)
    upto = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(base, n), out=upto[1:])
    undo = _powers(pow(base, -1, 1 << 64), n)
    return mix((upto[last] - upto[first]) * undo[first]), np.searchsorted(ends, first, "right")


def shingles(words: np.ndarray, bag: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, bag) of each run of ``window`` words; a shorter text is one shingle of all its words."""
    n = len(words)
    if not n:
        return words, bag
    count = np.bincount(bag)
    start = np.cumsum(count) - count
    size = np.minimum(count, window)[bag]
    at = np.flatnonzero(np.arange(n) + size <= (start + count)[bag])
    out = size[at].astype(np.uint64)
    for i in range(window):
        more = size[at] > i
        out[more] = mix(out[more] * _STEP + words[at[more] + i])
    return out, bag[at]


def weighed(hashes: np.ndarray, bag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, bag, weight) of the distinct elements."""
    key = hashes ^ mix(bag.astype(np.uint64) * _BASE)
    order = np.argsort(key)
    first = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1])) if len(key) else np.zeros(0, np.int64)
    return hashes[order[first]], bag[order[first]], np.diff(np.append(first, len(key)))


def signatures(hashes: np.ndarray, bag: np.ndarray, weight: np.ndarray, n_bags: int, registers: int) -> np.ndarray:
    """(n_bags, registers) uint64: the point that is first in each register; 0 throughout for an empty bag."""
    exponent = np.frexp((weight - 1).astype(np.float64))[1]  # dyadic intervals above [0,1) that the weight reaches
    element = np.repeat(np.arange(len(hashes)), exponent + 1)
    interval = np.arange(len(element)) - np.repeat(np.cumsum(exponent + 1) - (exponent + 1), exponent + 1)
    low = np.where(interval == 0, 0, 1 << np.maximum(interval - 1, 0))
    rate = np.maximum(low, 1)
    seed = mix(hashes[element] + interval.astype(np.uint64) * _STEP)
    bag, room = bag[element], weight[element] - low
    time = np.zeros(len(element))
    first = np.full(n_bags * registers, np.inf)
    kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    alive, drawn, at_once = np.arange(len(element)), 0, 1
    while len(alive):
        x = mix(seed[alive][:, None] + np.arange(drawn + 1, drawn + at_once + 1, dtype=np.uint64)[None, :] * _BASE)
        gap = -np.log1p(-(x >> _U(11)).astype(np.float64) * 2.0**-53) / rate[alive][:, None]
        when = time[alive][:, None] + np.cumsum(gap, axis=1)
        y = mix(x ^ _STEP)
        cell = ((y & _U(0xFFFFFFFF)) * rate[alive].astype(np.uint64)[:, None]) >> _U(32)
        slot = bag[alive][:, None] * registers + ((y >> _U(32)) % _U(registers)).astype(np.int64)
        ok = cell < room[alive].astype(np.uint64)[:, None]
        when_ok, slot_ok, x_ok = when[ok], slot[ok], x[ok]
        better = when_ok < first[slot_ok]
        when_ok, slot_ok, x_ok = when_ok[better], slot_ok[better], x_ok[better]
        np.minimum.at(first, slot_ok, when_ok)
        kept.append((when_ok, slot_ok, x_ok))
        time[alive] = when[:, -1]
        latest = first.reshape(n_bags, registers).max(axis=1)
        alive = alive[time[alive] < latest[bag[alive]]]
        drawn += at_once
        at_once = min(2 * at_once, 64) if drawn > 1 else 1
    out = np.zeros(n_bags * registers, np.uint64)
    for when, slot, x in kept:
        won = when == first[slot]
        out[slot[won]] = x[won]
    return out.reshape(n_bags, registers)


def band_values(signature: np.ndarray, rows: int) -> np.ndarray:
    """(n_bags, bands) int64: a hash of each band's registers, another one for each band."""
    n, registers = signature.shape
    parts = signature.reshape(n, registers // rows, rows)
    out = np.broadcast_to(np.arange(1, registers // rows + 1, dtype=np.uint64) * _BASE, parts.shape[:2]).copy()
    for i in range(rows):
        out = mix(out * _STEP + parts[:, :, i])
    return out.view(np.int64)


def bag_of(text: bytes, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, weights) of one text."""
    data = np.frombuffer(text, np.uint8)
    h, _ = shingles(*word_hashes(data, np.array([len(data)])), window)
    return np.unique(h, return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """Weight of the intersection and of the union of two bags."""
    total = int(a[1].sum() + b[1].sum())
    if len(a[0]) > len(b[0]):
        a, b = b, a
    if not len(a[0]):
        return 0, total
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    common = int(np.minimum(a[1], b[1][at])[b[0][at] == a[0]].sum())
    return common, total - common
