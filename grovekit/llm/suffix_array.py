"""Suffix arrays of packed strings down to a bounded depth, inside the tasks that hold them.

The suffixes that begin the windows of a string are named by their first 8 bytes, in byte order; then triples of names by rank,
each standing for three times as many bytes, until a name stands for ``k`` bytes.  Names are dense ranks, so no fingerprint
is asked: neighbours in the array have one name exactly if their first ``k`` bytes are equal.
"""

from __future__ import annotations

import numpy as np

FIRST = 8  # bytes that are read as one number


def names_of(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """The dense rank of each key, and how many there are."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.concatenate(([False], ranked[1:] != ranked[:-1]))
    ranks = np.cumsum(new).astype(np.uint64)
    names = np.empty(len(keys), np.uint64)
    names[order] = ranks
    return names, int(ranks[-1]) + 1 if len(keys) else 0


def suffix_names(data: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """The rank of ``data[s:s+k]`` for each of ``starts``; equal strings share one.  ``k`` is ``FIRST`` at least.

    Places where ``k`` bytes do not fit may not be asked.
    """
    whole = len(data) - FIRST + 1
    x = np.zeros(whole, np.uint64)
    for i in range(FIRST):
        x = (x << np.uint64(8)) | data[i : i + whole]
    depth = FIRST
    if depth == k:
        return names_of(x[starts])[0]
    x, distinct = names_of(x)
    while True:
        second, third, deeper = min(depth, k - depth), min(2 * depth, k - depth), min(3 * depth, k)
        # Places further back are asked no more; at full depth only the strings that were asked for.
        at = starts if deeper == k else np.arange(max(len(x) - third, 0))
        bits = np.uint64(max(distinct - 1, 1).bit_length())
        if 3 * int(bits) <= 64:
            x, distinct = names_of((x[at] << (bits + bits)) | (x[at + second] << bits) | x[at + third])
        else:  # over two million names: two at a time
            pair, n = names_of((x[at] << bits) | x[at + second])
            x, distinct = names_of((pair << bits) | x[at + third])
        depth = deeper
        if depth == k:
            return x
