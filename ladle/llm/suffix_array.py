"""Suffix arrays by induced sorting (Nong, Zhang and Chan, 2009) and permuted
longest common prefixes (Karkkainen, Manzini and Puglisi, 2009) for one shard.

The byte level works on whole first-symbol buckets with numpy; the recursion,
whose alphabet is as large as its text, runs position by position.
"""

from __future__ import annotations

import numpy as np


def _s_type(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it; the last symbol is the unique smallest."""
    step = np.sign(text[1:].astype(np.int64) - text[:-1])
    known = np.flatnonzero(step)
    following = known[np.searchsorted(known, np.arange(len(step)))]  # the last step is down to the sentinel
    return np.r_[step[following] > 0, True]


def _deal(buckets: list[list[np.ndarray]], positions: np.ndarray, symbols: np.ndarray) -> None:
    """Append positions to their symbols' buckets, in order."""
    if not len(positions):
        return
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    cuts = np.flatnonzero(ranked[1:] != ranked[:-1]) + 1
    for part in np.split(order, cuts):
        buckets[symbols[part[0]]].append(positions[part])


def _with_runs(parts: list[np.ndarray], run: np.ndarray) -> np.ndarray:
    """Positions of a bucket with those that a run of its own symbol induces:
    first all, then their predecessors in the same run, and so on."""
    if not parts:
        return np.empty(0, np.int64)
    first = np.concatenate(parts)
    back = first - run[first]
    total = int(back.sum())
    if not total:
        return first
    counts = back + 1
    member = np.repeat(np.arange(len(first)), counts)
    step = np.arange(len(member)) - np.repeat(np.cumsum(counts) - counts, counts)
    return (first[member] - step)[np.argsort(step, kind="stable")]


def _induce(text: np.ndarray, run: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in order."""
    larger: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    seeds: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    _deal(seeds, lms, text[lms])
    for c in range(symbols):
        here = _with_runs(larger[c], run)
        larger[c] = here
        seeded = np.concatenate([here, *seeds[c]]) if seeds[c] else here
        before = seeded[seeded > 0] - 1
        up = text[before] > c
        _deal(larger, before[up], text[before[up]])
    smaller: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    smaller[0] = [np.array([len(text) - 1])]
    ordered: list[np.ndarray] = []
    for c in range(symbols - 1, -1, -1):
        here = _with_runs(smaller[c], run)
        scanned = np.concatenate([here, larger[c][::-1]])
        before = scanned[scanned > 0] - 1
        down = text[before] < c
        _deal(smaller, before[down], text[before[down]])
        ordered.append(scanned)
    return np.concatenate(ordered)[::-1]


def _names(text: np.ndarray, ordered: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ranks of ordered leftmost-smaller substrings; equal ones share a rank."""
    a, b = ordered[:-1], ordered[1:]
    same = lengths[a] == lengths[b]
    pairs = np.flatnonzero(same)
    step = 1 << 16
    for i in range(0, len(pairs), step):
        part = pairs[i:i + step]
        size = lengths[a[part]]
        starts = np.cumsum(size) - size
        inside = np.arange(int(size.sum())) - np.repeat(starts, size)
        equal = text[np.repeat(a[part], size) + inside] == text[np.repeat(b[part], size) + inside]
        same[part] = np.logical_and.reduceat(equal, starts)
    return np.r_[0, np.cumsum(~same)]


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array of an integer text whose last symbol 0 occurs nowhere else."""
    n = len(text)
    small = _s_type(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    change = np.r_[True, text[1:] != text[:-1]]
    run = np.flatnonzero(change)[np.cumsum(change) - 1]
    if len(lms) > 1:
        rough = _induce(text, run, lms, symbols)
        is_lms = np.zeros(n, dtype=bool)
        is_lms[lms] = True
        ordered = rough[is_lms[rough]]
        lengths = np.zeros(n, dtype=np.int64)
        lengths[lms] = np.diff(np.r_[lms, n - 1]) + 1
        name = np.empty(n, dtype=np.int64)
        ranks = _names(text, ordered, lengths)
        name[ordered] = ranks
        if ranks[-1] + 1 < len(lms):
            lms = lms[_suffix_array_ints(name[lms].tolist(), int(ranks[-1]) + 1)]
        else:
            lms = ordered
    return _induce(text, run, lms, symbols)


def _suffix_array_ints(text: list[int], symbols: int) -> list[int]:
    """The same by position, for the large alphabets of the recursion; the
    last symbol is the unique smallest."""
    n = len(text)
    small = bytearray(n)
    small[n - 1] = 1
    for i in range(n - 2, -1, -1):
        a, b = text[i], text[i + 1]
        if a < b or (a == b and small[i + 1]):
            small[i] = 1
    counts = np.bincount(text, minlength=symbols)
    ends = np.cumsum(counts)
    tails, heads = ends.tolist(), (ends - counts).tolist()
    lms = [i for i in range(1, n) if small[i] and not small[i - 1]]

    def induce(seeds: list[int]) -> list[int]:
        out = [-1] * n
        end = tails[:]
        for i in reversed(seeds):
            c = text[i]
            end[c] -= 1
            out[end[c]] = i
        head = heads[:]
        for i in out:
            if i > 0 and not small[i - 1]:
                c = text[i - 1]
                out[head[c]] = i - 1
                head[c] += 1
        end = tails[:]
        for k in range(n - 1, -1, -1):
            i = out[k]
            if i > 0 and small[i - 1]:
                c = text[i - 1]
                end[c] -= 1
                out[end[c]] = i - 1
        out[0] = n - 1
        return out

    if len(lms) > 1:
        following = dict(zip(lms, lms[1:] + [n - 1]))
        name, last, rank = {}, None, -1
        for i in induce(lms):
            if i in following:
                piece = text[i:following[i] + 1]
                if piece != last:
                    rank, last = rank + 1, piece
                name[i] = rank
        if rank + 1 < len(lms):
            lms = [lms[k] for k in _suffix_array_ints([name[i] for i in lms], rank + 1)]
        else:
            lms = sorted(lms, key=name.__getitem__)
    return induce(lms)


def permuted_lcp(text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(plcp, phi): by text position, the suffix before it in the order and
    the length of their common prefix.

    Where the symbols before both are equal, the value is one less than at
    the position before; only the other (irreducible) positions are compared."""
    n = len(text)
    phi = np.empty(n, dtype=np.int64)
    phi[order[1:]] = order[:-1]
    phi[order[0]] = -1
    at = np.arange(n)
    compared = (phi < 0) | (at == 0) | (phi == 0)
    inner = ~compared
    compared[inner] = text[at[inner] - 1] != text[phi[inner] - 1]
    irreducible = np.flatnonzero(compared)
    value = np.zeros(n, dtype=np.int64)
    wide = 8
    padded = np.r_[text, np.arange(1 << 12)[::-1] % 2]  # reads past the end meet the unique last symbol first
    active = irreducible[phi[irreducible] >= 0]
    while len(active):
        grown = []
        for i in range(0, len(active), 1 << 15):
            a = active[i:i + (1 << 15)]
            left = a[:, None] + value[a][:, None] + np.arange(wide)
            right = phi[a][:, None] + value[a][:, None] + np.arange(wide)
            differ = padded[np.minimum(left, n - 1)] != padded[np.minimum(right, n - 1)]
            whole = ~differ.any(axis=1)
            value[a] += np.where(whole, wide, differ.argmax(axis=1))
            grown.append(a[whole])
        active = np.concatenate(grown)
        wide = min(256, wide * 4)
    last = irreducible[np.cumsum(compared) - 1]
    return value[last] - (at - last), phi
