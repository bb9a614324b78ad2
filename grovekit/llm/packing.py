"""Packing (6): documents in order, cut into windows of at most ``size`` tokens by dynamic programming.

The ids of the documents of a partition form one stream, in the order of the rows.  A window may end after a document,
after a sentence, or elsewhere; a cut within a document costs a penalty, a larger one within a sentence.  A window of
``length`` ids is filled up to ``size``, unless ``length`` is a power of two.  ``best[j]``, the least padding and penalty
of all windows up to place j, is ``cut(j) + size - j + min(best[i] + i)`` over the places i in reach: the minimum slides
along in a monotone queue; lengths of powers of two are looked up.  Places are the ends of documents and sentences, and
places ``size`` ids after others where no such end is in reach.  The stream is decided in stretches of ``stretch`` places,
so that memory stays bounded; a stretch begins where the last one's first windows are settled.

Documents that do not fill a partition's last window leave one window shorter than the others; nothing is shuffled.
Defined cases: a null or empty text is its end id alone.  Ids, repeated rows and other columns play no part.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.llm.common import rows_of, slices
from grovekit.llm.tokens import before_spaces, encoder

#: What ends a sentence, or a line.
STOPS = (b".", b"!", b"?", b'."', b'!"', b'?"', b".)", b"!)", b"?)", b"\n")
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"
)


def choose_cuts(places: np.ndarray, cost: np.ndarray, size: int) -> list[int]:
    """Indices of the places where windows end, from ``places[0]`` to the last one, at the least total cost.

    ``places`` rise by ``size`` at most; ``cost`` is the penalty of a cut at each of them.
    """
    p, c, n = places.tolist(), cost.tolist(), len(places)
    # Windows of a power of two need no padding: the few pairs of places so far apart, by their end.
    starts, ends = [], []
    for w in (1 << k for k in range(size.bit_length()) if 1 << k <= size):
        at = np.searchsorted(places, places - w)
        hit = np.flatnonzero(places[at] == places - w)
        starts.append(at[hit])
        ends.append(hit)
    starts, ends = np.concatenate(starts), np.concatenate(ends)
    order = np.argsort(ends, kind="stable")
    exact, upto = starts[order].tolist(), np.searchsorted(ends[order], np.arange(n), "right").tolist()
    best, back, seen = [0.0] * n, [0] * n, upto[0]
    queue = deque([0])
    for j in range(1, n):
        at = p[j]
        while p[queue[0]] < at - size:
            queue.popleft()
        i = queue[0]
        least, source = best[i] + p[i] + size - at, i
        for i in exact[seen : upto[j]]:
            if best[i] < least:
                least, source = best[i], i
        seen = upto[j]
        best[j], back[j] = least + c[j], source
        mark = best[j] + at
        while queue and best[queue[-1]] + p[queue[-1]] >= mark:
            queue.pop()
        queue.append(j)
    cuts, j = [], n - 1
    while j:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def with_bridges(places: np.ndarray, cost: np.ndarray, size: int, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Places and costs, with places every ``size`` ids where the next one would be out of reach."""
    gaps = np.flatnonzero(np.diff(places) > size)
    extra = [np.arange(places[g] + size, places[g + 1], size) for g in gaps]
    if not extra:
        return places, cost
    extra = np.concatenate(extra)
    places, cost = np.concatenate((places, extra)), np.concatenate((cost, np.full(len(extra), penalty)))
    order = np.argsort(places, kind="stable")
    return places[order], cost[order]


def ends_sentence(piece: bytes) -> bool:
    return piece.endswith(STOPS)


class Packer:
    """Packs the documents of one partition; ``add`` and ``close`` return finished pieces."""

    def __init__(self, first: int, size: int, sentence_cost: float, inner_cost: float, stretch: int):
        self.next, self.size = first, size
        self.sentence_cost, self.inner_cost, self.stretch = sentence_cost, inner_cost, stretch
        self.docs: list[tuple] = []  # doc_id, ids, place of the first id that is not packed
        self.places, self.cost, self.at = [np.zeros(1, np.int64)], [np.zeros(1)], 0
        self.held = 0

    def add(self, doc_id, ids: np.ndarray, ends: np.ndarray) -> list[tuple]:
        inner = np.unique(ends[(ends > 0) & (ends < len(ids))])
        self.places += [self.at + inner, np.array([self.at + len(ids)])]
        self.cost += [np.full(len(inner), self.sentence_cost), np.zeros(1)]
        self.docs.append((doc_id, ids, 0))
        self.at += len(ids)
        self.held += len(inner) + 1
        return self.settle(False) if self.held >= self.stretch else []

    def settle(self, last: bool) -> list[tuple]:
        places, cost = with_bridges(np.concatenate(self.places), np.concatenate(self.cost), self.size, self.inner_cost)
        cuts = choose_cuts(places, cost, self.size)
        if not last:
            # What comes later can still move the last windows: the final quarter is decided again.
            cuts = cuts[: max(1, len(cuts) * 3 // 4)]
        out: list[tuple] = []
        done = 0
        for j in cuts:
            self.window(int(places[j]) - done, out)
            done = int(places[j])
        rest = places > done
        self.places = [np.zeros(1, np.int64), places[rest] - done]
        self.cost = [np.zeros(1), cost[rest]]
        self.at -= done
        self.held = int(rest.sum()) if not last else 0
        return out

    def window(self, length: int, out: list[tuple]) -> None:
        offset, used = 0, 0
        while offset < length:
            doc_id, ids, start = self.docs[used]
            take = min(length - offset, len(ids) - start)
            out.append((doc_id, start, ids[start : start + take], len(ids), self.next, offset))
            offset += take
            if start + take == len(ids):
                used += 1
            else:
                self.docs[used] = (doc_id, ids, start + take)
        del self.docs[:used]
        self.next += 1

    def close(self) -> list[tuple]:
        return self.settle(True) if self.at else []


def pack_documents(
    docs: DataFrame,
    path: str,
    size: int = 1024,
    end_id: int = 0,
    sentence_cost: float = 4.0,
    inner_cost: float = 16.0,
    stretch: int = 20_000,
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``.

    Sequence ids are unique, and rise with the stream within a partition.  ``ids`` is null unless ``keep_ids``.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, before_spaces, ends_sentence)
        first = TaskContext.get().partitionId() << 40
        packer = Packer(first, size, sentence_cost, inner_cost, stretch)

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            doc, start, ids, total, sequence, offset = zip(*pieces)
            lengths = [len(x) for x in ids]
            if keep_ids:
                ends = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
                held = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids)))
            else:
                held = pa.nulls(len(ids), pa.list_(pa.int32()))
            crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
            columns = [pa.array(x, pa.int64()) for x in (doc, start, lengths, crc, total, sequence, offset)]
            return pa.RecordBatch.from_arrays([*columns, held], [c.split()[0] for c in PIECES.split(", ")])

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k in slices(texts):
                out = []
                for doc_id, (tokens, ends) in zip(ids[k], encode(texts[k])):
                    out += packer.add(doc_id, np.append(tokens, np.int32(end_id)), ends)
                if out:
                    yield rows(out)
        if out := packer.close():
            yield rows(out)

    return rows_of(docs).mapInArrow(pack, PIECES)
