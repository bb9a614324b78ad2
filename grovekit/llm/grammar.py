"""A run-length grammar of many sequences at once, by recompression, and common extensions answered on it.

Rounds alternate.  Block compression replaces a maximal run of one symbol by a symbol for (symbol, length).  Pair
compression deals all symbols to a left and a right side and replaces every left symbol with a right one behind it by a
symbol for the pair.  Equal stretches are compressed alike but for their ends, so that two places are compared by few
large symbols: a walk climbs while both places begin equal symbols, steps over equal ones, and descends where they
differ.  A walk takes steps in the logarithm of what it compares; within a block it steps over all copies at once.

Names are given by sorting, so that equal symbols mean equal words: answers are exact.
"""

from __future__ import annotations

import numpy as np

#: A level is not compressed further when no sequence has more symbols than this.
SHORT = 4
MAX_LEVELS = 200


class Grammar:
    """The nodes of all levels, numbered through; those of level 0 are the words.

    ``ids`` are the words of all sequences, ``sizes`` their lengths.  Before, between and behind sequences stands a
    barrier, a symbol that is found nowhere else and never merged; ``places`` gives the node of each word.
    """

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        own = np.repeat(np.arange(len(sizes)), sizes)
        self.places = np.arange(len(ids)) + own + 1
        self.walls = len(sizes) + 1
        fresh = int(ids.max(initial=-1)) + 1 + self.walls
        symbols = np.arange(fresh - self.walls, fresh).repeat(np.append(sizes, 0) + 1)
        symbols[self.places] = ids
        levels, children, blocks = [symbols], [], []
        wall_ids = (fresh - self.walls, fresh)
        while len(levels) < MAX_LEVELS and self.longest(levels[-1], wall_ids) > SHORT:
            for kind in ("block", "pair"):
                made = self.blocks_of(levels[-1], fresh) if kind == "block" else self.pairs_of(levels[-1], fresh, wall_ids, len(levels))
                if made is not None:
                    symbols, first, fresh = made
                    levels.append(symbols)
                    children.append(first)
                    blocks.append(kind == "block")
        self.link(levels, children, blocks)

    @staticmethod
    def longest(symbols: np.ndarray, walls: tuple[int, int]) -> int:
        at = np.flatnonzero((symbols >= walls[0]) & (symbols < walls[1]))
        return int(np.diff(at).max(initial=1)) - 1

    @staticmethod
    def blocks_of(symbols: np.ndarray, fresh: int):
        """Next level, first child of each of its nodes, next free name; None where no symbol stands twice in a row."""
        begins = np.concatenate(([True], symbols[1:] != symbols[:-1]))
        if begins.all():
            return None
        first = np.flatnonzero(begins)
        count = np.diff(np.append(first, len(symbols)))
        many = count > 1
        above = symbols[first]
        names, code = np.unique(np.stack((above[many], count[many]), 1), axis=0, return_inverse=True)
        above[many] = fresh + code.ravel()
        return above, first, fresh + len(names)

    @staticmethod
    def pairs_of(symbols: np.ndarray, fresh: int, walls: tuple[int, int], level: int):
        """As ``blocks_of``, for neighbours of which one is dealt to the left and the next one to the right side."""
        mixed = (symbols.astype(np.uint64) + np.uint64(level * 2**32)) * np.uint64(0x9E3779B97F4A7C15)
        side = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(63) == 1
        inner = (symbols < walls[0]) | (symbols >= walls[1])
        right = side & inner
        left = ~side & inner
        forward, backward = left[:-1] & right[1:], right[:-1] & left[1:]
        pair = np.flatnonzero(forward if forward.sum() >= backward.sum() else backward)
        if not len(pair):
            # All alike on one side: the next level deals anew.
            return symbols, np.arange(len(symbols)), fresh
        names, code = np.unique(symbols[pair] << np.int64(32) | symbols[pair + 1], return_inverse=True)
        keep = np.ones(len(symbols), bool)
        keep[pair + 1] = False
        above = symbols.copy()
        above[pair] = fresh + code.ravel()
        first = np.flatnonzero(keep)
        return above[first], first, fresh + len(names)

    def link(self, levels: list, children: list, blocks: list) -> None:
        sizes = np.array([len(x) for x in levels])
        offset = np.cumsum(sizes) - sizes
        self.symbol = np.concatenate(levels)
        total = len(self.symbol)
        self.parent = np.full(total, -1)
        self.first = np.full(total, -1)
        self.last = np.full(total, -1)
        #: Words of a node; equal symbols from a node to the end, or the beginning, of its block.
        self.words = np.ones(total, np.int64)
        self.ahead = np.ones(total, np.int64)
        self.behind = np.ones(total, np.int64)
        for k, (first, is_block) in enumerate(zip(children, blocks)):
            below, above = offset[k], offset[k + 1]
            n, m = sizes[k], sizes[k + 1]
            count = np.diff(np.append(first, n))
            self.parent[below : below + n] = above + np.repeat(np.arange(m), count)
            self.first[above : above + m] = below + first
            self.last[above : above + m] = below + first + count - 1
            self.words[above : above + m] = np.add.reduceat(self.words[below : below + n], first)
            if is_block:
                place = np.arange(n) - np.repeat(first, count)
                self.behind[below : below + n] = place + 1
                self.ahead[below : below + n] = np.repeat(count, count) - place

    def common(self, i: np.ndarray, j: np.ndarray, forward: bool = True) -> np.ndarray:
        """How many words agree from the nodes ``i`` and ``j`` of level 0 on, to the right or to the left; i differs from j."""
        edge, rest, step = (self.first, self.ahead, 1) if forward else (self.last, self.behind, -1)
        length = np.zeros(len(i), np.int64)
        live, a, b = np.arange(len(i)), np.array(i), np.array(j)
        while len(live):
            pa, pb = self.parent[a], self.parent[b]
            up = (pa >= 0) & (edge[pa] == a) & (edge[pb] == b) & (self.symbol[pa] == self.symbol[pb])
            same = ~up & (self.symbol[a] == self.symbol[b])
            over = np.where(same, np.minimum(rest[a], rest[b]), 0)
            length[live] += over * self.words[a]
            down = ~(up | same)
            ca, cb = edge[a], edge[b]
            going = ~down | (ca >= 0)
            a = np.where(up, pa, np.where(down, ca, a + step * over))[going]
            b = np.where(up, pb, np.where(down, cb, b + step * over))[going]
            live = live[going]
        return length
