"""Suffix sorting by difference covers (positions 1 and 2 modulo 3), in numpy."""

from __future__ import annotations

import numpy as np

#: Triples of symbols below this are named by counting, others by sorting.
_COUNTED = 1 << 24


def _names(symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense order-keeping names, from 1, of the triples that start at ``at``."""
    size = int(symbols.max()) + 1
    if size**3 >= 2**63:
        order = np.lexsort((symbols[at + 2], symbols[at + 1], symbols[at]))
        ordered = np.stack([symbols[at + k][order] for k in range(3)])
        fresh = np.concatenate([[True], (ordered[:, 1:] != ordered[:, :-1]).any(axis=0)])
    else:
        keys = (symbols[at] * size + symbols[at + 1]) * size + symbols[at + 2]
        if size**3 <= _COUNTED:
            seen = np.zeros(size**3, bool)
            seen[keys] = True
            names = np.cumsum(seen)
            return names[keys], int(names[-1])
        order = np.argsort(keys)
        ordered = keys[order]
        fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    names = np.empty(len(at), np.int64)
    names[order] = np.cumsum(fresh)
    return names, int(fresh.sum())


def ranks(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Rank of every suffix of ``symbols`` (integers above 0), right for the first ``depth`` symbols.

    Suffixes that differ there are ranked by it; others get neighbouring or equal ranks. The sampled
    positions are those not divisible by 3. Their triples are sorted and named; unless the names differ
    or cover ``depth``, the string of names is ranked in the same way, a third as deep. The remaining
    suffixes are ranked by their first symbol and the rank behind it, and merged with the sampled ones
    by counting, for each suffix, the smaller ones of the other kinds.
    """
    n = len(symbols)
    s = np.concatenate([symbols, np.zeros(4, np.int64)])
    one = np.arange(1, n + 1, 3)  # reaches the padding, so no triple runs from one half into the other
    two = np.arange(2, n + 1, 3)
    zero = np.arange(0, n, 3)
    sampled = np.concatenate([one, two])
    names, n_names = _names(s, sampled)
    if n_names < len(sampled) and depth > 3:
        names = ranks(names, -(-depth // 3)) + 1
    rank = np.zeros(n + 4, np.int64)
    rank[sampled] = names
    width = int(names.max()) + 1
    first_width = int(s.max()) + 1
    # keys against position classes 0 and 1, and (one symbol longer) against class 2
    keys = {}
    for kind, at in ((0, zero), (1, one)):
        keys[kind, 1] = s[at] * width + rank[at + 1]
    if first_width**2 * width < 2**63:
        for kind, at in ((0, zero), (2, two)):
            keys[kind, 2] = (s[at] * first_width + s[at + 1]) * width + rank[at + 2]
    else:
        pairs = np.concatenate([s[at] * first_width + s[at + 1] for at in (zero, two)])
        dense = np.unique(pairs, return_inverse=True)[1]
        keys[0, 2] = dense[: len(zero)] * width + rank[zero + 2]
        keys[2, 2] = dense[len(zero) :] * width + rank[two + 2]
    order = {k: np.argsort(v) for k, v in keys.items()}
    in_order = {k: v[order[k]] for k, v in keys.items()}

    def below(kind: tuple[int, int], other: tuple[int, int]) -> np.ndarray:
        """For each key of one kind the number of smaller keys of another, searched in order."""
        found = np.empty(len(order[kind]), np.int64)
        found[order[kind]] = np.searchsorted(in_order[other], in_order[kind])
        return found

    if width <= 8 * len(names) + 1024:
        smaller = (np.cumsum(np.bincount(names, minlength=width)) - np.bincount(names, minlength=width))[names]
    else:
        smaller = np.searchsorted(np.sort(names), names)
    out = np.empty(n + 1, np.int64)
    out[zero] = below((0, 1), (0, 1)) + below((0, 1), (1, 1)) + below((0, 2), (2, 2))
    out[one] = smaller[: len(one)] + below((1, 1), (0, 1))
    out[two] = smaller[len(one) :] + below((2, 2), (0, 2))
    return out[:n]


def equal_prefix_classes(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Class numbers of ``starts``: equal where the next ``length`` bytes of ``data`` are.

    ``data`` holds pieces with separators (values no byte has) between them; every start has ``length``
    bytes before the next separator. Suffixes are sorted, then neighbours' prefixes compared.
    """
    rank = ranks(data, length)
    order = starts[np.argsort(rank[starts], kind="stable")]
    a, b = order[:-1], order[1:]
    width = min(length, 7)
    words = data.copy()  # several symbols of nine bits in one number
    for k in range(1, width):
        words[:-k] |= data[k:] << (9 * k)
    same = np.arange(len(a))
    for at in [*range(0, length - width, width), length - width]:
        same = same[words[a[same] + at] == words[b[same] + at]]
        if not len(same):
            break
    fresh = np.ones(len(order), bool)
    fresh[1:][same] = False
    classes = np.empty(len(data), np.int64)
    classes[order] = np.cumsum(fresh)
    return classes[starts]
