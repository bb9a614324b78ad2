"""Suffix-array dedup (1): bytes covered by a string of ``k`` bytes that starts anywhere else too.

The suffix array is sparse and partitioned.  Each string of ``k`` bytes hands its suffix order to one sample inside it: the
suffix at the first lowest fingerprint of its runs of ``m`` bytes.  Equal strings have the same sample at the same place, so
they can only be neighbours in the part of the array whose suffixes begin with the ``m`` bytes of that sample.  Parts with
one sample have no neighbours; samples whose strings are all equal, in order, stand for each other.  Where different ones
meet, the text of their strings travels, and the part is sorted: a suffix array to depth ``k`` (``suffix_array``), in which
neighbours that agree over ``k`` bytes repeat.  A part with more than ``hot`` different samples is counted string by string,
by 128-bit fingerprints with map-side sums, so that no task holds it.

Defined cases: matches never cross documents; overlapping ones count; a null or empty text, or a shorter one than ``k``,
loses nothing.  Repeated rows are copies of each other, also with one id; null ids are kept.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.llm.common import covered, joined, keyed, mix, on_key, parts, runs, signed, slices, written
from grovekit.llm.substrings import buckets_of
from grovekit.llm.suffix_array import suffix_names
from grovekit.llm.superkmers import BYTE_IDS, SEGMENTS, found_again, sliding_min

#: Shorter strings would have samples of so few bytes that most are found by chance.
LEAST = 136
PER_TASK = 20_000
#: Bytes whose suffixes are sorted, or whose samples are drawn, at once.
AT_ONCE = 1 << 19
HIGH = np.uint64(0xFFFFFFFF00000000)


class Powers:
    """Fingerprints of all runs of ``m`` bytes from sums of prefixes."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self):
        self.up, self.down = np.ones(0, np.uint64), np.ones(0, np.uint64)

    def __call__(self, data: np.ndarray, m: int) -> np.ndarray:
        if len(self.up) < len(data):
            for name, base in (("up", self.BASE), ("down", pow(self.BASE, -1, 2**64))):
                steps = np.full(2 * len(data), base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        sums = np.cumsum(BYTE_IDS[data] * self.up[: len(data)], dtype=np.uint64)
        runs_of_m = sums[m - 1 :].copy()
        runs_of_m[1:] -= sums[:-m]
        return mix(runs_of_m * self.down[: len(runs_of_m)])


def draw_samples(data: np.ndarray, bounds: np.ndarray, k: int, m: int, powers: Powers) -> tuple[np.ndarray, ...]:
    """``h, start, n`` of the samples of joined texts, which lie between ``bounds``, in order.

    The strings that begin at ``start``, ``start + 1``, ... (``n`` of them) have this sample; ``h`` identifies its ``m`` bytes.
    """
    grams = powers(data, m)
    # The place in the lower half lets the first of equal ones win, and tells where it is.
    low = sliding_min((grams & HIGH) | np.arange(len(grams), dtype=np.uint64), k - m + 1) & ~HIGH
    steps = np.zeros(len(low) + 1, np.int32)
    ends = bounds[1:]
    np.add.at(steps, np.minimum(np.maximum(ends - k + 1, bounds[:-1]), len(low)), 1)
    np.add.at(steps, np.minimum(ends, len(low)), -1)
    inside = np.cumsum(steps[:-1]) == 0
    starts = np.flatnonzero(np.concatenate(([True], (low[1:] != low[:-1]) | (inside[1:] != inside[:-1]))))
    sizes = np.diff(np.concatenate((starts, [len(low)])))
    own = inside[starts]
    starts, sizes = starts[own], sizes[own]
    return grams[low[starts].astype(np.int64)], starts, sizes


def samples(docs: DataFrame, k: int, m: int) -> DataFrame:
    """The samples of every row, without their text, as ``SEGMENTS``: ``p`` identifies the strings of a sample in order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, names = Powers(), [c.split()[0] for c in SEGMENTS.split(", ")]
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for part in slices(texts, AT_ONCE):
                data, bounds = joined(texts[part])
                if len(data) < k:
                    continue
                h, starts, sizes = draw_samples(data, bounds, k, m, powers)
                raw = memoryview(data)
                ends = (starts + sizes + k - 1).tolist()
                p = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(starts.tolist(), ends)]
                row = np.searchsorted(bounds, starts, "right") - 1
                at = pa.array(row + part.start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(h)),
                        pa.array(signed(np.array(p, np.uint64))),
                        batch.column(0).take(at),
                        batch.column(1).take(at),
                        pa.array((starts - bounds[row]).astype(np.int32)),
                        pa.array(sizes.astype(np.int32)),
                        pa.array(np.zeros(len(row), bool)),
                    ],
                    names,
                )

    return keyed(docs).mapInArrow(cut, SEGMENTS)


def sort_parts(packed: DataFrame, k: int) -> DataFrame:
    """``h, p, at``: strings of samples found once that have an equal neighbour in the suffix array of their part."""

    def again(held: list[tuple]) -> pa.RecordBatch:
        h, p, times, payloads = zip(*held)
        data, bounds = joined_bytes(payloads)
        own = np.diff(bounds) - k + 1
        at = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        names = suffix_names(data, np.repeat(bounds[:-1], own) + at, k)
        owner = np.repeat(np.arange(len(held)), own)
        times = np.array(times)[owner]
        array = np.argsort(names, kind="stable")
        equal = names[array[1:]] == names[array[:-1]]
        twice = times > 1
        twice[array[1:][equal]] = True
        twice[array[:-1][equal]] = True
        twice &= times == 1
        owner = owner[twice]
        ids = (pa.array(np.array(x, np.int64)[owner]) for x in (h, p))
        return pa.RecordBatch.from_arrays([*ids, pa.array(at[twice].astype(np.int32))], ["h", "p", "at"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if size >= AT_ONCE and row[0] != last:  # parts are never torn
                    yield again(held)
                    held, size = [], 0
                last = row[0]
                held.append(row)
                size += len(row[3])
        if held:
            yield again(held)

    tasks = parts(packed, packed.count(), PER_TASK)
    return packed.repartition(tasks, "h").sortWithinPartitions("h").mapInArrow(sort, "h long, p long, at int")


def joined_bytes(raw: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray]:
    """All strings one after another, and where each begins (and the last one ends)."""
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))


def repeated_strings(docs: DataFrame, k: int, hot: int) -> DataFrame:
    """``doc_id, f, first, last``: ranges of starts of strings of ``k`` bytes that start elsewhere too."""
    shared = found_again(samples(docs, k, k // 3))
    return buckets_of(docs, shared, k, hot, False, lambda packed: sort_parts(packed, k))


def dedup_suffixes(docs: DataFrame, k: int = 200, hot: int = 20_000) -> DataFrame:
    """``doc_id, kept, n_bytes, n_removed, spans``: remaining bytes of every row and the removed runs, by place."""
    if k < LEAST:
        raise ValueError(f"strings of fewer than {LEAST} bytes are not told apart by samples")
    ranges = repeated_strings(docs, k, hot)
    lists = ranges.groupBy("doc_id", "f").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    rows = on_key(keyed(docs), lists, "left").select("doc_id", "text", "ranges")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            kept, counts, removed, spans = [], [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = np.frombuffer(text.encode(), np.uint8)
                gone = np.zeros(len(raw), bool)
                if found:
                    gone = covered(np.concatenate([np.arange(r["first"], r["last"]) for r in found]), k, len(raw))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(*runs(gone))])
                counts.append(len(raw))
                removed.append(int(gone.sum()))
                kept.append(raw[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span)],
                ["doc_id", "kept", "n_bytes", "n_removed", "spans"],
            )

    return rows.mapInArrow(
        keep, "doc_id long, kept binary, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>"
    )
