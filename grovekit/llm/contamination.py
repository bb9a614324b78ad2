"""Benchmark decontamination (4): passages of benchmark items, up to ``share`` of their words edited.

The embedding of Chakraborty, Goldenberg and Koucky walks over a word sequence and, at each of ``3 n`` steps, puts out the
word it stands on and moves on or not, by a random bit of (step, word).  Sequences at a small edit distance end up at a
small Hamming distance.  Bit sampling hashes a few of the steps; independent walks are tried, as many tables as edited
copies of all items of a block need, in each class of size, to be found at the target recall; a target that is not
reached is an error.  Walks of long windows rarely meet, so items of over 128 words are looked for by even pieces: of an
item with at most a share of edits, one piece at least has no greater share.  What collides is verified by its exact edit
distance, over words, within the window and the room that edits can shift it.

A window as long as the item is laid wherever a run of ``q`` words of the item is met in the right place: an item with at
most ``d`` edits keeps one of its ``d + 1`` equal parts whole, and ``q`` is no longer than such a part, so that no window
that could pass is left out.  Items come in blocks of bounded size, each of which meets all documents.

Words are lower-cased and lose punctuation at their ends.  Defined cases: null or empty texts, and items without words,
match nothing.  Repeated rows match each for itself; null ids are kept.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.llm.common import Ids, keyed, mix, rows_by_key, windows

MATCHES = "doc_id long, f long, item_id long, start int, n_words int, distance int"
PIECE_WORDS = 128
#: Words and windows that a task holds at once, on top of one text.
SLICE_WORDS, SLICE_WINDOWS = 1 << 18, 1 << 16
EDGES = b"\"'()[]{}<>.,;:!?-*_`"


class Words(Ids):
    """Fingerprints of normalised words; words of punctuation alone count as one like word."""

    @staticmethod
    def fingerprint(word: bytes) -> int:
        return Ids.fingerprint(word.decode().lower().encode().strip(EDGES))

    def __call__(self, text: str) -> np.ndarray:
        return super().__call__(text.encode().split())


@dataclass(frozen=True)
class LshParams:
    share: float = 0.2
    recall: float = 0.99
    sampled: int = 3
    trials: int = 200
    most_tables: int = 4096
    seed: int = 4


def allowed(n: int, share: float) -> int:
    return int(share * n + 1e-9)


def gram_size(n: int, share: float) -> int:
    return max(1, min(3, n // (allowed(n, share) + 1)))


def size_class(sizes: np.ndarray) -> np.ndarray:
    return np.frexp(sizes.astype(float))[1]


class Walks:
    """Sampled embeddings of windows: one key for each window and table.  Nothing is held that grows with the items."""

    def __init__(self, params: LshParams):
        self.params = params

    def spots(self, table: int) -> np.ndarray:
        """Sampled steps as shares of all.  One lies in the first half, where walks are still inside their window."""
        spots = np.random.default_rng([self.params.seed, table]).random(self.params.sampled)
        spots[0] /= 2
        return spots

    def multipliers(self, table: int, steps: int) -> np.ndarray:
        """Odd numbers whose product with a word has the random bit of (step, word) on top."""
        return mix(np.arange(steps, dtype=np.uint64) + np.uint64((table << 40) + (self.params.seed << 32))) | np.uint64(1)

    def keys(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray, table: int) -> np.ndarray:
        """``ends`` are past-the-end places, before ``starts + sizes`` where a text is over; walks stay there."""
        if not len(starts):
            return np.empty(0, np.uint64)
        steps = (self.spots(table)[:, None] * 3 * sizes).astype(np.int64)
        # Windows whose last sampled step is far away come first, so that those still walking are the first ones.
        last = steps.max(axis=0)
        order = np.argsort(-last, kind="stable")
        steps, last, at, end = steps[:, order].ravel(), last[order], starts[order], ends[order]
        key = sizes[order].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        n = int(last[0]) + 1
        by_step = np.argsort(steps, kind="stable")
        bounds = np.searchsorted(steps[by_step], np.arange(n + 1))
        by_step %= len(order)
        walking = np.searchsorted(-last, -np.arange(n), side="right")
        odd = self.multipliers(table, n)
        for j in range(n):
            place, inside = at[: walking[j]], at[: walking[j]] < end[: walking[j]]
            word = np.where(inside, words[np.minimum(place, len(words) - 1)], np.uint64(0))
            take = by_step[bounds[j] : bounds[j + 1]]
            if len(take):
                old = key[take]
                key[take] = (old ^ word[take] ^ (old >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            place += ((word * odd[j]) >> np.uint64(63)).astype(np.int64) & inside
        out = np.empty_like(key)
        out[order] = key
        return out


def pieces_of(item: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """``offset, words``: an item in even pieces of at most ``PIECE_WORDS`` words."""
    n = max(1, -(-len(item) // PIECE_WORDS))
    edges = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


class ItemIndex:
    """A block of items: where windows are laid, the keys of their pieces in each table, and the items themselves."""

    def __init__(self, ids: list[int], items: list[np.ndarray], params: LshParams):
        self.ids, self.items, self.params = ids, items, params
        cut = [(i, *piece) for i, x in enumerate(items) for piece in pieces_of(x)]
        self.item = np.array([i for i, _, _ in cut], np.int64)
        self.offset = np.array([o for _, o, _ in cut], np.int64)
        self.pieces = [x for _, _, x in cut]
        self.sizes = np.array([len(x) for x in self.pieces], np.int64)
        self.grams: dict[int, tuple[np.ndarray, ...]] = {}
        for q in (1, 2, 3):
            own = [(i, windows(x, q)) for i, x in enumerate(self.pieces) if gram_size(len(x), params.share) == q]
            if own:
                grams = np.concatenate([g for _, g in own])
                piece = np.concatenate([np.full(len(g), i) for i, g in own])
                offset = np.concatenate([np.arange(len(g)) for _, g in own])
                order = np.argsort(grams, kind="stable")
                table = np.zeros(1 << 20, bool)  # most words of a text are ruled out by a look at this
                table[grams >> np.uint64(44)] = True
                self.grams[q] = grams[order], piece[order], offset[order], table
        self.walks = Walks(params)
        # Pieces of 2^k to 2^(k+1) words make a class with tables of its own number.
        self.needed = np.zeros(PIECE_WORDS + 1, np.int64)
        for k in np.unique(size_class(self.sizes)).tolist():
            same = size_class(np.arange(PIECE_WORDS + 1)) == k
            self.needed[same] = self.tables_needed([x for x in self.pieces if same[len(x)]])
        self.tables = int(self.needed.max())
        flat = np.concatenate(self.pieces)
        starts = np.cumsum(self.sizes) - self.sizes
        self.keys = []
        for t in range(self.tables):
            own = np.flatnonzero(self.needed[self.sizes] > t)
            keys = self.walks.keys(flat, starts[own], (starts + self.sizes)[own], self.sizes[own], t)
            order = np.argsort(keys, kind="stable")
            self.keys.append((keys[order], own[order]))

    def tables_needed(self, pieces: list[np.ndarray]) -> int:
        """Tables after which edited copies of ``pieces``, at least ``trials`` of them, have met them with the target recall.

        Every piece is tried, twice or more.  Raises RuntimeError where ``most_tables`` do not reach the target.
        """
        rng = np.random.default_rng(self.params.seed + 1)
        before, after = [], []
        for x in pieces * max(2, -(-self.params.trials // len(pieces))):
            y = x.tolist()
            for _ in range(allowed(len(x), self.params.share)):
                at, kind = int(rng.integers(0, len(y))), int(rng.integers(0, 3))
                new = int(rng.integers(0, 2**63))
                y[at : at + (kind != 0)] = [] if kind == 1 else [new]
            y += rng.integers(0, 2**63, len(x)).tolist()  # the text goes on behind the passage
            before.append(x)
            after.append(np.array(y[: len(x)], np.uint64))
        n = np.array([len(x) for x in before], np.int64)
        starts = np.cumsum(n) - n
        a, b = np.concatenate(before), np.concatenate(after)
        missed = np.arange(len(n))
        for t in range(self.params.most_tables):
            at = starts[missed], (starts + n)[missed], n[missed]
            missed = missed[self.walks.keys(a, *at, t) != self.walks.keys(b, *at, t)]
            if len(missed) <= (1 - self.params.recall) * len(n):
                return t + 1
        found = 1 - len(missed) / len(n)
        raise RuntimeError(f"{self.params.most_tables} tables reach a recall of {found:.4f}, not {self.params.recall}")

    def windows_to_try(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (start, size) of windows that hold a run of words of a piece in its place."""
        starts, sizes = [], []
        for q, (grams, piece, offset, table) in self.grams.items():
            own = windows(words, q)
            maybe = np.flatnonzero(table[own >> np.uint64(44)])
            low = np.searchsorted(grams, own[maybe], "left")
            found = grams[np.minimum(low, len(grams) - 1)] == own[maybe]
            hit, low = maybe[found], low[found]
            if len(hit):
                times = np.searchsorted(grams, own[hit], "right") - low
                place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
                starts.append(np.repeat(hit, times) - offset[place])
                sizes.append(self.sizes[piece[place]])
        if not starts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        both = np.unique(np.stack((np.maximum(np.concatenate(starts), 0), np.concatenate(sizes)), 1), axis=0)
        return both[:, 0], both[:, 1]

    def candidates(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Distinct (window, piece) that agree in a table; windows are taken in slices of bounded number."""
        found = [np.empty((0, 2), np.int64)]
        for a in range(0, len(starts), SLICE_WINDOWS):
            part, own = slice(a, a + SLICE_WINDOWS), []
            for t, (keys, piece) in enumerate(self.keys):
                asked = np.flatnonzero(self.needed[sizes[part]] > t) + a
                made = self.walks.keys(words, starts[asked], ends[asked], sizes[asked], t)
                low, high = np.searchsorted(keys, made, "left"), np.searchsorted(keys, made, "right")
                times = high - low
                place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
                own.append(np.stack((np.repeat(asked, times), piece[place]), 1))
            found.append(np.unique(np.concatenate(own), axis=0))
        return np.concatenate(found)


def nearest_end(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of the pattern to a part of the text, and where the first such part ends (bit-parallel)."""
    at: dict[int, int] = {}
    for i, w in enumerate(pattern):
        at[w] = at.get(w, 0) | 1 << i
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text):
        eq = at.get(w, 0)
        across = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | (~(across | plus) & full), plus & across
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1) & full, (down << 1) & full
        both = eq | minus
        plus, minus = (down | (~(both | up) & full)) & full, up & both
        if score < best:
            best, end = score, j + 1
    return best, end


def passages(words: np.ndarray, starts: np.ndarray, pairs: np.ndarray, index: ItemIndex) -> list[tuple]:
    """``item, start, n, distance`` of verified passages; of those of one item that overlap, the nearest."""
    places = set()
    for w, piece in pairs.tolist():
        i = int(index.item[piece])
        first = int(starts[w]) - int(index.offset[piece])
        last = first
        if len(index.items[i]) > PIECE_WORDS:  # many pieces tell of one passage: places close by are looked at once
            step = allowed(len(index.items[i]), index.params.share) + 1
            first -= first % step
            last = first + step
        places.add((i, first, last))
    best: dict[int, list[tuple]] = {}
    for i, first, last in sorted(places):
        item = index.items[i].tolist()
        most = allowed(len(item), index.params.share)
        first = max(0, first - most)
        text = words[first : max(0, last + len(item) + most)].tolist()
        distance, end = nearest_end(item, text)
        if distance <= most and end:
            back = nearest_end(item[::-1], text[:end][::-1])[1]
            best.setdefault(i, []).append((distance, first + end - back, back))
    out = []
    for i, found in best.items():
        taken: list[tuple] = []
        for distance, start, n in sorted(set(found)):
            if all(start + n <= s or s + m <= start for s, m in taken):
                taken.append((start, n))
                out.append((i, start, n, distance))
    return out


def matches(held: list[tuple], index: ItemIndex) -> list[tuple]:
    """``row, item_id, start, n, distance`` of the passages in some texts, given with the windows to try."""
    if not held:
        return []
    rows, texts, starts, sizes = zip(*held)
    ends = np.cumsum([len(x) for x in texts])
    owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
    first = np.concatenate(([0], ends[:-1]))[owner]
    starts, sizes = np.concatenate(starts), np.concatenate(sizes)
    pairs = index.candidates(
        np.concatenate(texts), first + starts, np.minimum(first + starts + sizes, ends[owner]), sizes
    )
    out = []
    for k in np.unique(owner[pairs[:, 0]]).tolist():
        mine = pairs[owner[pairs[:, 0]] == k]
        out += [(rows[k], index.ids[i], *rest) for i, *rest in passages(texts[k], starts, mine, index)]
    return out


def item_blocks(items: DataFrame, block_words: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Items with words, in blocks of about ``block_words`` words."""
    words, ids, held, size = Words(), [], [], 0
    rows = items.select(F.col("item_id").cast("long"), "text").filter("text is not null")
    for item_id, text in rows.toLocalIterator():
        found = words(text)
        if len(found):
            ids.append(item_id)
            held.append(found)
            size += len(found)
            if size >= block_words:
                yield ids, held
                ids, held, size = [], [], 0
    if held:
        yield ids, held


def find_passages(
    docs: DataFrame, items: DataFrame, params: LshParams = LshParams(), block_words: int = 500_000
) -> DataFrame:
    """``doc_id, f, item_id, start, n_words, distance``: each passage of an item in a document, by word places.

    Reads ``items (item_id, text)`` while the plan is built.
    """
    spark = docs.sparkSession
    found = spark.createDataFrame([], MATCHES)
    for ids, held in item_blocks(items, block_words):
        index = ItemIndex(ids, held, params)

        def scan(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            words = Words()
            for batch in batches:
                rows: list[tuple] = []
                held, size = [], 0
                for i, text in enumerate(batch.column(2)):
                    own = words(text.as_py())
                    starts, sizes = index.windows_to_try(own)
                    if len(starts):
                        held.append((i, own, starts, sizes))
                        size += len(own) + len(starts)
                        if size >= SLICE_WORDS:
                            rows += matches(held, index)
                            held, size = [], 0
                rows += matches(held, index)
                if rows:
                    row, item, start, n, distance = zip(*rows)
                    row = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(row),
                            batch.column(1).take(row),
                            pa.array(item, pa.int64()),
                            *[pa.array(x, pa.int32()) for x in (start, n, distance)],
                        ],
                        ["doc_id", "f", "item_id", "start", "n_words", "distance"],
                    )

        found = found.union(keyed(docs).mapInArrow(scan, MATCHES))
    return found


def decontaminate(docs: DataFrame, items: DataFrame, params: LshParams = LshParams()) -> DataFrame:
    """The rows of ``docs`` without a passage of an item, with all their columns."""
    return rows_by_key(docs, find_passages(docs, items, params), "left_anti")
