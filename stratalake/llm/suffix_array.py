"""Suffix arrays by induced sorting, and permuted common prefixes, for one shard's text.

Suffixes are classed as smaller or larger than their right neighbour. The leftmost smaller ones split the text into
substrings; these are sorted by one round of induction, named, and ordered by sorting the shorter string of names
recursively. A second round of induction orders all suffixes. On byte texts whole buckets are induced at once in
numpy; strings of names have too many small buckets for that and are induced along chains of suffixes.
"""

from __future__ import annotations

import numpy as np

# Positions compared with the text at once.
COMPARED = 1 << 16


def smaller_suffixes(s: np.ndarray) -> np.ndarray:
    """For each suffix whether it is smaller than the one after it; the last, the sentinel, is."""
    n = len(s)
    rises = np.ones(n, dtype=bool)
    rises[:-1] = s[:-1] < s[1:]
    decides = np.ones(n, dtype=bool)
    decides[:-1] = s[:-1] != s[1:]
    at = np.where(decides, np.arange(n), n)
    return rises[np.minimum.accumulate(at[::-1])[::-1]]


def _deal(sa: np.ndarray, fill: np.ndarray, found: np.ndarray, symbols: np.ndarray, sign: int) -> None:
    """Append ``found`` to the buckets of their symbols, in order; ``fill`` moves by ``sign``."""
    order = np.argsort(symbols, kind="stable")
    dealt = symbols[order]
    counts = np.bincount(dealt, minlength=len(fill))
    rank = np.arange(len(dealt)) - (np.cumsum(counts) - counts)[dealt]
    sa[fill[dealt] + sign * rank] = found[order]
    fill += sign * counts


def induce(s: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, sigma: int) -> np.ndarray:
    """All suffixes in order, induced from the leftmost smaller ones ``seeds`` given in order, bucket by bucket."""
    counts = np.bincount(s, minlength=sigma)
    ends = np.cumsum(counts)
    heads = ends - counts
    sa = np.full(len(s), -1, dtype=np.int64)
    seed_counts = np.bincount(s[seeds], minlength=sigma)
    seed_ends = np.cumsum(seed_counts)
    fill = heads.copy()

    def larger_before(entries: np.ndarray) -> np.ndarray:
        before = entries[entries > 0] - 1
        return before[~smaller[before]]

    for c in np.flatnonzero(counts):
        at = heads[c]
        while at < fill[c]:  # suffixes that begin with a run of this symbol come in several waves
            upto = fill[c]
            found = larger_before(sa[at:upto])
            at = upto
            _deal(sa, fill, found, s[found], 1)
        found = larger_before(seeds[seed_ends[c] - seed_counts[c] : seed_ends[c]])
        _deal(sa, fill, found, s[found], 1)
    larger_upto = fill
    fill = ends - 1

    def smaller_before(entries: np.ndarray) -> np.ndarray:
        before = entries[entries > 0] - 1
        return before[smaller[before]]

    fill[s[-1]] -= 1
    sa[ends[s[-1]] - 1] = len(s) - 1  # the sentinel precedes all others
    for c in np.flatnonzero(counts)[::-1]:
        at = ends[c] - 1
        while at > fill[c]:
            downto = fill[c]
            found = smaller_before(sa[downto + 1 : at + 1][::-1])
            at = downto
            _deal(sa, fill, found, s[found], -1)
        found = smaller_before(sa[heads[c] : larger_upto[c]][::-1])
        _deal(sa, fill, found, s[found], -1)
    return sa


def _along_chains(keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ranks of all positions by the keys met on the way from each to its end; keys at ends are all different.

    Ways double in length each round, and only positions that are still tied are compared again.
    """
    n = len(keys)
    ranks = np.zeros(n, dtype=np.int64)
    tied, values, step = np.arange(n), keys, 1
    while len(tied):
        order = np.argsort(values)
        at, values, group = tied[order], values[order], ranks[tied[order]]
        index = np.arange(len(at))
        new = np.append(True, values[1:] != values[:-1])
        first = np.maximum.accumulate(np.where(new, index, 0))
        ranks[at] = group + first - np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1]), index, 0))
        alone = new & np.append(new[1:], True)
        tied = at[~alone & (at < ends[at])]
        values = ranks[tied] * (n + 1) + ranks[np.minimum(tied + step, ends[tied])]
        step *= 2
    return ranks


def induce_chains(s: np.ndarray, smaller: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """``induce`` for strings with many symbols, whose buckets are too small to be taken one by one.

    A larger suffix is followed by larger ones up to the next seed, so its place follows from the symbols on the way
    and the seed's rank; then a smaller suffix's from the symbols up to the next larger one and that one's rank.
    """
    n = len(s)
    here = np.arange(n)
    given = np.zeros(n, dtype=np.int64)
    given[seeds] = np.arange(1, len(seeds) + 1)
    # Of equal symbols larger suffixes come first. Smaller ones that are no seed play no part yet.
    keys = (2 * s + smaller) * (n + 1) + given
    part = ~smaller | (given > 0)
    ends = np.where(given > 0, here, n - 1)
    ends = np.minimum.accumulate(ends[::-1])[::-1]
    ranks = _along_chains(np.where(part, keys, -1), np.where(part, ends, here))
    larger = np.flatnonzero(~smaller)
    given = np.zeros(n, dtype=np.int64)
    given[larger[np.argsort(ranks[larger])]] = np.arange(1, len(larger) + 1)
    keys = (2 * s + smaller) * (n + 1) + given
    keys[-1] = -1
    ends = np.where(smaller, n - 1, here)
    ends = np.minimum.accumulate(ends[::-1])[::-1]
    return np.argsort(_along_chains(keys, ends))


def _names(s: np.ndarray, ordered: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Names of the sorted substrings: equal substrings, all neighbours, share one."""
    differs = np.ones(len(ordered), dtype=bool)
    size = sizes[1:]
    same = np.flatnonzero(size == sizes[:-1])
    a, b = ordered[:-1][same], ordered[1:][same]
    left = size[same]
    step = 0
    while len(same):
        equal = s[a + step] == s[b + step]
        ended = equal & (left == step + 1)
        differs[1:][same[ended]] = False
        going = equal & ~ended
        same, a, b, left = same[going], a[going], b[going], left[going]
        step += 1
    return np.cumsum(differs) - 1


def suffix_array(s: np.ndarray, sigma: int, few_symbols: bool = True) -> np.ndarray:
    """The suffixes of ``s`` in order. ``s`` holds integers under ``sigma`` and ends with a 0 found nowhere else."""
    n = len(s)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    smaller = smaller_suffixes(s)
    leftmost = np.zeros(n, dtype=bool)
    leftmost[1:] = smaller[1:] & ~smaller[:-1]
    places = np.flatnonzero(leftmost)

    def induced(seeds: np.ndarray) -> np.ndarray:
        if few_symbols:
            return induce(s, smaller, seeds, sigma)
        return induce_chains(s, smaller, seeds)

    rough = places[np.argsort(s[places], kind="stable")]
    around = induced(rough)
    ordered = around[leftmost[around]]
    sizes = np.zeros(n, dtype=np.int64)
    sizes[places[:-1]] = np.diff(places) + 1
    sizes[places[-1]] = 1
    names = _names(s, ordered, sizes[ordered])
    if names[-1] + 1 < len(places):
        named = np.zeros(n, dtype=np.int64)
        named[ordered] = names
        shorter = suffix_array(named[places], int(names[-1]) + 1, few_symbols=False)
        ordered = places[shorter]
    return induced(ordered)


def permuted_common_prefixes(s: np.ndarray, sa: np.ndarray, block: int = 16) -> np.ndarray:
    """For each position of ``s`` how many symbols its suffix shares with the one before it in order.

    Where the symbols before both suffixes agree, the value is the left neighbour's less one; only the others are
    compared with the text, a block of symbols at a time.
    """
    n = len(s)
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    compared = np.ones(n, dtype=bool)
    at = np.arange(1, n)
    has = before[1:] > 0
    compared[1:][has] = s[at[has] - 1] != s[before[1:][has] - 1]
    padded = np.concatenate([s, np.arange(-1, -block - 1, -1)]).astype(np.int16 if s.max() < 1 << 15 else np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(padded, block)
    shared = np.zeros(n, dtype=np.int64)
    waiting = np.flatnonzero(compared & (before >= 0))
    for part in range(0, len(waiting), COMPARED):
        open_at = waiting[part : part + COMPARED]
        while len(open_at):
            left, right = open_at + shared[open_at], before[open_at] + shared[open_at]
            equal = windows[np.minimum(left, n)] == windows[np.minimum(right, n)]
            whole = equal.all(axis=1)
            shared[open_at] += np.where(whole, block, equal.argmin(axis=1))
            open_at = open_at[whole]
    source = np.maximum.accumulate(np.where(compared, np.arange(n), 0))
    return np.where(before >= 0, np.maximum(shared[source] - (np.arange(n) - source), 0), 0)
