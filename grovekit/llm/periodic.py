"""Periodic run detection (11): maximal stretches of words that repeat with one period, on a recompressed grammar.

A run is a stretch of consecutive words with smallest period q and at least ``max(shortest, repeats * q)`` words, which
no neighbouring word extends with that period.  Candidates stand on a harmonic grid: every run of period q holds a
multiple x of (repeats - 2) q, and x + q and x + 2q with it, so that n log n places of all periods together are enough;
those at which the three words are equal are extended to both sides by the grammar's common extensions, which gives the
run exactly.  The same stretch under several periods is counted once, with the smallest.

Documents are worked on by the slice, each of bounded words and candidates, where they lie: nothing is shuffled.
A document is never split; a longer one is a slice of its own.

Defined cases: words are runs of other than ASCII white space.  A null or empty text has no words and no runs.  Repeated
rows and null ids are rows as any other.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from grovekit.llm.common import rows_of
from grovekit.llm.grammar import Grammar

#: Words of a slice of documents, and candidates looked at together: they bound memory, not results.
SLICE_WORDS = 250_000
CHUNK = 500_000
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = "array<struct<start:long,length:long,period:long>>"


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and how many each text has."""
    lists = pc.ascii_split_whitespace(texts)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    filled = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not filled.all():
        own = np.repeat(np.arange(len(sizes)), sizes)
        sizes = np.bincount(own[filled], minlength=len(sizes))
        flat = flat.filter(pa.array(filled))
    return flat, sizes.astype(np.int64)


def grid(ids: np.ndarray, sizes: np.ndarray, repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sequence, place in ``ids`` and period of the grid points that may lie in a run."""
    base = np.cumsum(sizes) - sizes
    periods = sizes // repeats
    owner = np.repeat(np.arange(len(sizes)), periods)
    q = np.arange(len(owner)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = q * (repeats - 2)
    points = np.maximum((sizes[owner] - 1 - 2 * q) // step + 1, 0)
    ends = np.cumsum(points)
    done = 0
    while done < len(owner):
        before = ends[done] - points[done]
        stop = max(int(np.searchsorted(ends, before + CHUNK, "right")), done + 1)
        n = points[done:stop]
        which = np.repeat(np.arange(done, stop), n)
        x = base[owner[which]] + step[which] * (np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n))
        gap = q[which]
        hit = np.flatnonzero(ids[x] == ids[x + gap])
        hit = hit[ids[x[hit]] == ids[x[hit] + 2 * gap[hit]]]
        yield owner[which[hit]], x[hit], gap[hit]
        done = stop


def runs_of(ids: np.ndarray, sizes: np.ndarray, repeats: int = 4, shortest: int = 6) -> tuple[np.ndarray, ...]:
    """``owner, start, length, period`` of every run of the sequences, by owner, start and period."""
    found = list(grid(ids, sizes, repeats))
    owner, x, q = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 3
    if not len(x):
        return owner, x, x, q
    # Only sequences with a candidate need a grammar.
    chosen = np.unique(owner)
    part = np.isin(np.repeat(np.arange(len(sizes)), sizes), chosen)
    shift = np.cumsum(part) - 1
    grammar = Grammar(ids[part], sizes[chosen])
    i, j = grammar.places[shift[x]], grammar.places[shift[x + q]]
    left, right = grammar.common(i - 1, j - 1, forward=False), grammar.common(i, j)
    length = left + right + q
    start = x - (np.cumsum(sizes) - sizes)[owner] - left
    good = length >= np.maximum(shortest, repeats * q)
    owner, start, length, q = owner[good], start[good], length[good], q[good]
    order = np.lexsort((q, length, start, owner))
    owner, start, length, q = (c[order] for c in (owner, start, length, q))
    new = np.ones(len(q), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    owner, start, length, q = (c[new] for c in (owner, start, length, q))
    order = np.lexsort((q, start, owner))
    return owner[order], start[order], length[order], q[order]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut where they hold more than ``SLICE_WORDS`` words, counted by bytes at four a word."""
    for batch in batches:
        bytes_up_to = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
        done = 0
        while done < batch.num_rows:
            before = bytes_up_to[done - 1] if done else 0
            stop = max(int(np.searchsorted(bytes_up_to, before + 4 * SLICE_WORDS, "right")), done + 1)
            yield batch.slice(done, stop - done)
            done = stop


def find_runs(docs: DataFrame, repeats: int = 4, shortest: int = 6) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row: its runs by start and period, and its words without the repeats.

    Of each run, the first period stays in ``collapsed`` unless another run drops it; words are joined by one space.
    ``repeats`` is the least number of periods in a run, three or more.
    """
    if repeats < 3:
        raise ValueError("the grid needs runs of three periods at least")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, sizes = split_words(batch.column(1))
            ids = words.dictionary_encode().indices.to_numpy().astype(np.int64)
            owner, start, length, period = runs_of(ids, sizes, repeats, shortest)
            base = np.cumsum(sizes) - sizes
            edges = np.zeros(len(ids) + 1, np.int32)
            np.add.at(edges, base[owner] + start + period, 1)
            np.add.at(edges, base[owner] + start + length, -1)
            kept = np.cumsum(edges[:-1]) == 0
            left = np.add.reduceat(np.append(kept, False).astype(np.int64), base) if len(base) else base
            left[sizes == 0] = 0
            ends = lambda n: pa.array(np.append(0, np.cumsum(n)), pa.int32())
            lists = pa.ListArray.from_arrays(ends(left), words.filter(pa.array(kept)))
            runs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start, length, period)], fields=list(RUN))
            per_row = pa.ListArray.from_arrays(ends(np.bincount(owner, minlength=len(sizes))), runs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), per_row, pc.binary_join(lists, " ")],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return rows_of(docs).mapInArrow(find, f"doc_id long, n_words long, runs {RUNS}, collapsed string")
