"""Suffix sorting by Larsson-Sadakane refinement and Kasai common prefixes, in numpy."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The order of all suffixes of a text of non-negative integers.

    Suffixes are first sorted by as many symbols as fit into 63 bits. After that
    each round doubles the compared length, and only the places in groups that
    are still tied are sorted again, by the rank of the suffix that begins
    `length` further on. A suffix's group is its first place in the order.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    bits = max(1, int(int(text.max()) + 1).bit_length())
    length = max(1, 63 // bits)
    key = np.zeros(n, np.int64)
    wide = text.astype(np.int64) + 1  # 0 stands beyond the end
    for i in range(length):
        key <<= bits
        key[: n - i] |= wide[i:] if i < n else 0
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    fresh = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    group = np.empty(n, np.int64)
    group[order] = first
    tied = _tied(fresh)
    while len(tied):
        places = order[tied]
        ahead = places + length
        after = np.where(ahead < n, group[np.minimum(ahead, n - 1)] + 1, 0)
        own = group[places]
        again = np.lexsort((after, own))
        order[tied] = places = places[again]
        own, after = own[again], after[again]
        fresh = np.concatenate(([True], (own[1:] != own[:-1]) | (after[1:] != after[:-1])))
        first = np.maximum.accumulate(np.where(fresh, tied, 0))
        group[places] = first
        still = _tied(fresh)
        tied = tied[still]
        length *= 2
    return order


def _tied(fresh: np.ndarray) -> np.ndarray:
    """Places whose group has more than one member."""
    alone = fresh & np.concatenate((fresh[1:], [True]))
    return np.flatnonzero(~alone)


def common_prefixes(text: np.ndarray, order: np.ndarray, cap: int, stride: int = 64) -> np.ndarray:
    """Common prefix, at most `cap` long, of each suffix with the one before it in the order.

    Kasai's rule: the suffix one place further shares at least one symbol less
    with its own neighbour. The text is cut into lanes of `stride` places, and
    all lanes step through their places at once, each from its own bound.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.full(n + cap + 1, -1, np.int64)
    padded[:n] = text
    shared = np.zeros(n, np.int64)
    base = np.arange(0, n, stride)
    bound = np.zeros(len(base), np.int64)
    for step in range(min(stride, n)):
        here = base + step
        if here[-1] >= n:
            base, here, bound = base[:-1], here[:-1], bound[:-1]
        other = before[here]
        bound = np.where(other < 0, 0, np.maximum(bound - 1, 0))
        active = np.flatnonzero((other >= 0) & (bound < cap))
        while len(active):
            same = padded[here[active] + bound[active]] == padded[other[active] + bound[active]]
            active = active[same]
            bound[active] += 1
            active = active[bound[active] < cap]
        shared[here] = bound
    return shared[order]
