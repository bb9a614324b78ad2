"""Token ids of whole texts, by a tokenizer file of the tokenizers library.

Most of a corpus is made of pieces that come again, so a piece is encoded once and its ids are looked up after that.
Pieces are cut where the tokenizer's own splitting of a text can never join them again: the ids of the pieces, one after
another, are the ids of the text.  The file is read on each executor; its path is a parameter.  What a worker has
learned serves its later tasks too.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from itertools import chain

import numpy as np

from grovekit.llm.common import WHITE, distinct_strings, joined

#: Marks that no special token has and that never follow a letter in one token.
MARKS = np.isin(np.arange(256), list(b".,;:!?$#*"))
UPPER = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
LETTERS = UPPER | np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyz"))


def after_letters(b: np.ndarray) -> np.ndarray:
    """Flags of marks right behind a letter: an ASCII one, or a Latin one of two bytes that stays one when lowered."""
    out = np.zeros(len(b), bool)
    at = np.flatnonzero(MARKS[b[1:]]) + 1
    before, lead = b[at - 1], b[np.maximum(at - 2, 0)]
    latin = (before >= 0x80) & (lead >= 0xC3) & (lead <= 0xC9)
    latin &= ~((lead == 0xC3) & ((before == 0x97) | (before == 0xB7)) | (lead == 0xC4) & (before == 0xB0))
    out[at] = LETTERS[before] | latin
    return out


def at_white_space(b: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For tokenizers that drop white space and lower-case.

    Capitals are lowered here, so that fewer pieces differ; not in pieces that may hold a special token (they have a ``|``)
    or characters that combine with others (from 0xCC on).
    """
    solid = ~WHITE[b]
    first = after_letters(b)
    first[1:] |= ~solid[:-1]
    first[bounds[bounds < len(b)]] = True
    starts = np.flatnonzero(first & solid)
    place = np.concatenate((np.zeros(1, np.int64), np.cumsum(solid)))
    kept, offsets = b[solid], np.append(place[starts], place[-1])
    lowered = UPPER[kept]
    special = np.unique(np.searchsorted(offsets, np.flatnonzero((kept == ord("|")) | (kept >= 0xCC)), "right") - 1)
    as_is = np.zeros(len(starts), bool)
    as_is[special] = True
    lowered &= ~np.repeat(as_is, np.diff(offsets))
    return kept | (lowered * np.uint8(32)), offsets, np.diff(np.searchsorted(starts, bounds))


def before_spaces(b: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For byte-level tokenizers, which keep one space with the visible characters that follow it.

    Cuts are before a space, and on both sides of a line break, that has a visible character on either side: ASCII, or
    Latin letters of two bytes; and before a mark behind a letter.
    """
    inner = (b == 32) | (b == 10)
    inner[bounds[bounds < len(b)]] = False
    inner[bounds[bounds > 0] - 1] = False
    at = np.flatnonzero(inner)
    after, before, lead = b[at + 1], b[at - 1], b[np.maximum(at - 2, 0)]
    visible = ((after > 32) & (after < 127)) | ((after >= 0xC3) & (after <= 0xC9))
    visible &= ((before > 32) & (before < 127)) | ((before >= 0x80) & (lead >= 0xC3) & (lead <= 0xC9))
    at = at[visible]
    first = after_letters(b)
    first[at] = True
    first[at[b[at] == 10] + 1] = True
    first[bounds[bounds < len(b)]] = True
    starts = np.flatnonzero(first)
    return b, np.append(starts, len(b)), np.diff(np.searchsorted(starts, bounds))


#: Letters that stay one letter each when lower-cased, and never combine with a neighbour.
LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
#: Of either way to cut: pieces that are one unit to the tokenizer, and what goes between them in one text.
UNITS = {at_white_space: (re.compile(f"[{LATIN}]+"), " "), before_spaces: (re.compile(f" [{LATIN}]+"), "")}


class Numbers(dict):
    """Pieces by number; one that is met for the first time gets the next number and waits to be encoded."""

    def __init__(self):
        self.waiting: list[bytes] = []

    def __missing__(self, piece: bytes) -> int:
        number = self[piece] = len(self)
        self.waiting.append(piece)
        return number


class Encoder:
    """Ids of texts.  The first ``limit`` pieces are remembered, rarer ones only for the texts of one call.

    ``cut`` gets the bytes of several texts and where each begins (and the last one ends); it returns the bytes of all
    pieces, where each of them begins (and the last one ends), and the number of pieces of each text.
    ``flag`` tells pieces behind which a place is wanted.
    """

    def __init__(self, path: str, cut: Callable, flag: Callable[[bytes], bool] | None = None, limit: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cut, self.flag, self.limit = cut, flag, limit
        self.numbers = Numbers()
        self.pool = np.empty(1 << 16, np.int32)
        self.used = 0
        self.starts, self.sizes = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int32)
        self.flags = np.zeros(1 << 14, bool)

    def encoded(self, pieces: list[str], run: int = 100) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after another, and how many each has.

        Pieces that are one unit each go in runs, as one text: the tokenizer tells which unit an id is of.
        """
        unit, between = UNITS[self.cut]
        single = np.fromiter((unit.fullmatch(p) is not None for p in pieces), bool, len(pieces))
        alone, units = np.flatnonzero(~single), np.flatnonzero(single)
        runs = [units[k : k + run] for k in range(0, len(units), run)]
        texts = [between.join([pieces[i] for i in r.tolist()]) for r in runs]
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        sizes, parts, kept, alone = np.zeros(len(pieces), np.int32), [], [], [alone]
        for r, e in zip(runs, found):
            own = np.bincount(np.array(e.word_ids, np.int64), minlength=len(r))
            if len(own) == len(r) and own.all():
                sizes[r] = own
                parts.append(e.ids)
                kept.append(r)
            else:  # a tokenizer that sees other units
                alone.append(r)
        alone = np.concatenate(alone)
        rest = [e.ids for e in self.tokenizer.encode_batch_fast([pieces[i] for i in alone.tolist()], add_special_tokens=False)]
        sizes[alone] = np.fromiter(map(len, rest), np.int32, len(rest))
        flat = np.fromiter(chain.from_iterable([*parts, *rest]), np.int32, int(sizes.sum()))
        order = np.concatenate((*kept, alone))
        ends = np.cumsum(sizes[order], dtype=np.int64)
        starts = np.empty(len(pieces), np.int64)
        starts[order] = ends - sizes[order]
        behind = np.cumsum(sizes, dtype=np.int64)
        return flat[np.arange(len(flat)) + np.repeat(starts - behind + sizes, sizes)], sizes

    def learn(self, pieces: list[bytes], first: int) -> None:
        """Encode pieces that are not known, numbered from ``first``."""
        ids, sizes = self.encoded([p.decode() for p in pieces])
        total, last = len(ids), first + len(pieces)
        while self.used + total > len(self.pool):
            self.pool = np.concatenate((self.pool, np.empty_like(self.pool)))
        while last > len(self.starts):
            self.starts, self.sizes, self.flags = (
                np.concatenate((x, np.zeros_like(x))) for x in (self.starts, self.sizes, self.flags)
            )
        self.pool[self.used : self.used + total] = ids
        self.sizes[first:last] = sizes
        self.starts[first:last] = self.used + np.cumsum(sizes, dtype=np.int64) - sizes
        if self.flag:
            self.flags[first:last] = list(map(self.flag, pieces))
        self.used += total

    def __call__(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids, and the places in them behind flagged pieces."""
        data, offsets, counts = self.cut(*joined(texts))
        distinct, at = distinct_strings(data, offsets)
        known = np.fromiter(map(self.numbers.__getitem__, distinct), np.int64, len(distinct))
        at = known[at]
        new, self.numbers.waiting = self.numbers.waiting, []
        first = len(self.numbers) - len(new)
        keep = max(0, min(len(new), self.limit - first))
        if keep:
            self.learn(new[:keep], first)
        used = self.used
        if keep < len(new):
            self.learn(new[keep:], first + keep)
        sizes = self.sizes[at].astype(np.int64)
        after = np.cumsum(sizes)
        total = int(after[-1]) if len(after) else 0
        ids = self.pool[np.arange(total) + np.repeat(self.starts[at] - after + sizes, sizes)]
        for p in new[keep:]:
            del self.numbers[p]
        self.used = used
        flagged = np.flatnonzero(self.flags[at])
        out, behind, last = [], np.concatenate((np.zeros(1, np.int64), after)), 0
        for n in counts.tolist():
            first, last = last, last + n
            start = behind[first]
            mine = flagged[np.searchsorted(flagged, first) : np.searchsorted(flagged, last)]
            out.append((ids[start : behind[last]], after[mine] - start))
        return out


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, cut: Callable, flag: Callable | None = None) -> Encoder:
    """The worker's encoder of a file."""
    if (path, cut, flag) not in _encoders:
        _encoders[path, cut, flag] = Encoder(path, cut, flag)
    return _encoders[path, cut, flag]
