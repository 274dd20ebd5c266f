"""Suffix sorting, and common prefixes by breadth-first backward extension on the BWT, in numpy.

Small helpers on bounded arrays: the operators deal the work to tasks and hand
over a few megabytes at a time.
"""

from __future__ import annotations

import numpy as np


def codes(pieces: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """The pieces one after another, symbols as 1, 2, ... in their order, each piece followed by a 0; and how many symbols there are."""
    flat = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
    values, inverse = np.unique(flat, return_inverse=True)
    ends = np.cumsum([len(p) for p in pieces], dtype=np.int64)
    return np.insert(inverse.astype(np.int64) + 1, ends, 0), len(values)


def sort_suffixes(text: np.ndarray, sigma: int, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols at least; every 0 is an end of its own.

    Prefix doubling, beginning with as many symbols as fit in 63 bits; only
    suffixes that aren't alone yet are sorted again.
    """
    n, bits = len(text), max(1, int(sigma).bit_length())
    h, key, ended = 1, text.copy(), text == 0
    while 2 * h * bits <= 63 and h < depth:
        later, later_ended = np.zeros_like(key), np.ones(n, bool)
        later[: max(0, n - h)], later_ended[: max(0, n - h)] = key[h:], ended[h:]
        key = (key << (h * bits)) | np.where(ended, 0, later)
        ended |= later_ended
        h *= 2
    order = np.argsort(key)
    key = key[order]
    first = np.ones(n, bool)
    first[1:] = (key[1:] != key[:-1]) | ended[order[1:]]
    rank = np.empty(n, np.int64)
    starts = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank[order] = starts
    while h < depth:
        alone = first & np.append(first[1:], True)
        at = np.flatnonzero(~alone)
        if not len(at):
            break
        suffix = order[at]
        pair = (rank[suffix] << 32) | rank[np.minimum(suffix + h, n - 1)]
        again = np.argsort(pair)
        pair, suffix = pair[again], suffix[again]
        order[at] = suffix
        first[at] = np.append(True, pair[1:] != pair[:-1])
        starts = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        rank[suffix] = starts[at]
        h *= 2
    return order


def _to_next(known: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Steps from each place of ``new`` to the next known one; the last place is known."""
    size, going, step = np.ones(len(new), np.int64), np.arange(len(new)), 1
    if len(new) * 16 < len(known):
        while len(going) and step <= 64:
            going = going[~known[new[going] + step]]
            size[going] += 1
            step += 1
    if len(going):
        every = np.flatnonzero(known)
        size[going] = every[np.searchsorted(every, new[going], "right")] - new[going]
    return size


def long_prefixes(text: np.ndarray, sigma: int, order: np.ndarray, length: int) -> np.ndarray:
    """True at ranks whose suffix shares ``length`` symbols or more with the rank before.

    Works on the Burrows-Wheeler transform alone. A boundary between two ranks is
    found at the value of their common prefix, values in increasing order: behind
    each boundary found at one value lies an interval of ranks up to the next
    known one, and extending it backward by each of its symbols gives the
    boundaries of the next value, where the rank that the extension leads to is
    still open and the same symbol's rank before lies on the other side. It stops
    at ``length``; what was not reached by then shares at least so much.
    """
    n = len(text)
    bwt = text[order - 1]
    psi = np.argsort(bwt, kind="stable")  # where the suffix without its first symbol ranks
    back = np.empty(n, np.int64)
    back[psi] = np.arange(n)
    head = bwt[psi]
    before = np.append(n, psi[:-1])
    known = np.ones(n + 1, bool)
    known[1:n] = (head[1:] != head[:-1]) | (head[1:] == 0)
    new = np.flatnonzero(known[:n])
    level = 0
    while level + 1 < length and len(new):
        size = _to_next(known, new)
        start = np.repeat(new, size)
        inside = start + np.arange(len(start)) - np.repeat(np.cumsum(size) - size, size)
        rank = back[inside]
        new = np.sort(rank[~known[rank] & (before[rank] < start)])
        known[new] = True
        level += 1
    return ~known[:n]


def repeated_starts(pieces: list[np.ndarray], length: int) -> list[np.ndarray]:
    """For each piece: True where a run of ``length`` symbols starts that also starts elsewhere in the pieces."""
    sizes = [len(p) for p in pieces]
    text, sigma = codes(pieces)
    marked = np.zeros(len(text), bool)
    if len(text):
        order = sort_suffixes(text, sigma, length)
        shared = np.flatnonzero(long_prefixes(text, sigma, order, length))
        marked[order[shared]] = True
        marked[order[shared - 1]] = True
    out, at = [], 0
    for size in sizes:
        out.append(marked[at : at + size])
        at += size + 1
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


def run_hashes(symbols: np.ndarray, longest: int) -> list[np.ndarray]:
    """Hashes of the 1, 2, 4, ... symbols (``longest`` at most) from each position on."""
    out = [_mix(symbols + np.uint64(1))]
    while 2 << (len(out) - 1) <= longest and len(out[-1]) > 1 << (len(out) - 1):
        width = 1 << (len(out) - 1)
        out.append(_mix(out[-1][:-width] * np.uint64(0xA0761D6478BD642F) + out[-1][width:]))
    return out


def hash_at(runs: list[np.ndarray], at: np.ndarray | slice, length: int) -> np.ndarray:
    """64-bit hash of the ``length`` symbols from each place of ``at`` on, by ``run_hashes``."""
    out, done = None, 0
    for i, run in enumerate(runs):
        if length >> i & 1:
            part = run[done + at.start : done + at.stop] if isinstance(at, slice) else run[done + at]
            out = part.copy() if out is None else _mix(out * np.uint64(0xD6E8FEB86659FD93) + part)
            done += 1 << i
    return out


def gram_hashes(symbols: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of the ``gram`` symbols from each position on (``symbols`` as uint64)."""
    n = len(symbols) - gram + 1
    return hash_at(run_hashes(symbols, gram), slice(0, n), gram) if n > 0 else np.zeros(0, np.uint64)


def anchors(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int, gram: int, runs: list[np.ndarray] | None = None) -> tuple[np.ndarray, ...]:
    """(piece, at, first, last, key): which windows of ``length`` symbols have which anchor.

    ``symbols`` holds pieces at ``starts`` of ``sizes``. The anchor of a window is
    its leftmost gram with the smallest hash, so equal windows have equal anchors
    at equal places. Windows that start from ``first`` to ``last`` have the anchor
    ``at``; all count from the piece's start. Positions take the low 24 bits of
    what is compared: at most 16 million symbols at once.
    """
    n = len(symbols) - gram + 1
    hashes = hash_at(runs or run_hashes(symbols, gram), slice(0, n), gram) if n > 0 else np.zeros(0, np.uint64)
    span = length - gram + 1
    if len(hashes) < span:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty
    low = np.uint64((1 << 24) - 1)
    best, width = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), 1
    while 2 * width <= span:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if width < span:
        best = np.minimum(best[: len(hashes) - span + 1], best[span - width :])
    fits = np.flatnonzero(sizes >= length)
    empty = np.zeros(0, np.int64)
    if not len(fits):
        return empty, empty, empty, empty, empty
    begin, end = starts[fits], starts[fits] + sizes[fits] - length  # first and last window of each piece
    at = (best & low).astype(np.int64)
    turn = np.ones(len(at), bool)
    turn[1:] = at[1:] != at[:-1]
    turn[begin] = True
    inside = np.zeros(len(at) + 1, np.int8)
    inside[begin] = 1
    inside[end + 1] -= 1
    first = np.flatnonzero(turn & (np.cumsum(inside[:-1], dtype=np.int8) > 0))
    owner = np.searchsorted(begin, first, "right") - 1
    last = np.minimum(np.append(first[1:], len(at)) - 1, end[owner])
    origin, at = begin[owner], at[first]
    return fits[owner], at - origin, first - origin, last - origin, hashes[at].view(np.int64)


def anchor_classes(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int, gram: int, places: int) -> tuple[np.ndarray, ...]:
    """``anchors`` cut by classes of ``places``: the key is that of all symbols which the windows of a class share.

    A window's place is how far its anchor lies behind its start; class c holds
    the places from c * ``places`` on.
    """
    core = length - places + 1
    runs = run_hashes(symbols, max(core, gram))
    piece, at, first, last, _ = anchors(symbols, starts, sizes, length, gram, runs)
    low = (at - last) // places
    n = (at - first) // places - low + 1
    row = np.repeat(np.arange(len(piece)), n)
    c = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    piece, at, first, last = piece[row], at[row], first[row], last[row]
    if not len(row):
        return piece, at, first, last, np.zeros(0, np.int64)
    key = hash_at(runs, starts[piece] + at - c * places, core)
    key = _mix(key + c.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
    return piece, at, np.maximum(first, at - c * places - places + 1), np.minimum(last, at - c * places), key
