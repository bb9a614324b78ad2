"""Super-k-mers: runs of consecutive windows that share their minimiser.

The minimiser of a window of ``k`` tokens is the lowest fingerprint of its runs of ``m`` tokens.  Equal windows have
equal minimisers, so a window whose minimiser occurs in one place only is unique, and the rest can be compared within
the bucket of their minimiser.  Tokens are words or bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.llm.common import Ids, keyed, mix, signed, windows, written
from grovekit.session import discard

SEGMENTS = "h long, p long, doc_id long, f long, start int, n int, inner boolean"
BYTE_IDS = mix(np.arange(1, 257, dtype=np.uint64))


def words_of(ids: Ids) -> Callable[[str], np.ndarray]:
    return lambda text: ids(text.encode().split())


def bytes_of(text: str) -> np.ndarray:
    return BYTE_IDS[np.frombuffer(text.encode(), np.uint8)]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Lowest of each ``width`` consecutive values."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def segments(ids: np.ndarray, k: int, m: int) -> tuple[np.ndarray, ...]:
    """``h, p, start, n, inner`` of the super-k-mers of one text.

    ``p`` identifies their windows in order; ``inner`` tells that one of them occurs again in the same text.  Runs of
    more than ``4 k`` windows, which only periodic texts have, are cut.
    """
    lows = sliding_min(windows(ids, m, 1), k - m + 1)
    starts = np.flatnonzero(np.concatenate(([True], lows[1:] != lows[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(lows)])))
    if sizes.max() > 4 * k:
        starts = np.concatenate([np.arange(s, s + n, 4 * k) for s, n in zip(starts, sizes)])
        sizes = np.diff(np.concatenate((starts, [len(lows)])))
    whole = windows(ids, k)
    place = np.arange(len(whole), dtype=np.uint64) - np.repeat(starts, sizes).astype(np.uint64)
    p = np.add.reduceat(mix(whole + mix(place + np.uint64(1))), starts)
    order = np.argsort(whole, kind="stable")
    same = whole[order[1:]] == whole[order[:-1]]
    again = np.zeros(len(whole), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    return signed(lows[starts]), signed(p), starts, sizes, np.logical_or.reduceat(again, starts)


def all_segments(docs: DataFrame, by_words: bool, k: int, m: int) -> DataFrame:
    """The super-k-mers of every row, without their text."""

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = words_of(Ids()) if by_words else bytes_of
        names = ["h", "p", "doc_id", "f", "start", "n", "inner"]
        for part in parts:
            found = []
            for i, text in enumerate(part.column(2).to_pylist()):
                ids = tokens(text)
                if len(ids) >= k:
                    found.append((i, segments(ids, k, m)))
            if not found:
                continue
            row = pa.array(np.repeat([i for i, _ in found], [len(s[0]) for _, s in found]))
            h, p, start, n, inner = (np.concatenate([s[c] for _, s in found]) for c in range(5))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h),
                    pa.array(p),
                    part.column(0).take(row),
                    part.column(1).take(row),
                    pa.array(start.astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                    pa.array(inner),
                ],
                names,
            )

    return keyed(docs).mapInArrow(cut, SEGMENTS)


def shared_segments(docs: DataFrame, by_words: bool, k: int, m: int) -> DataFrame:
    """The super-k-mers whose minimiser is found in more than one of them, or that repeat a window of their own text."""
    return found_again(all_segments(docs, by_words, k, m))


def found_again(segments: DataFrame) -> DataFrame:
    """Those of ``segments`` whose ``h`` is found in more than one of them, or that are ``inner``."""
    every = written(segments)
    times = every.groupBy("h").agg(F.sum(F.when(F.col("inner"), 2).otherwise(1)).alias("times"))
    # Written, so that both sides of the join are plain exchanges: Spark can then split an ``h`` that very many rows have.
    shared = written(times.filter("times > 1").select("h"))
    found = written(every.join(shared, "h"))
    discard(every, shared)
    return found
