"""Substring dedup (5): exact repeats of ``k`` words by super-k-mer partitioning.

Consecutive windows with one minimiser travel as one packed string to the bucket of that minimiser, where sorting counts
them.  Three steps keep what travels small: super-k-mers whose minimiser is found once stay at home; equal ones are
counted before they are sent, and one of them stands for all; only minimisers under which different super-k-mers meet
need a bucket at all.  A minimiser with more than ``hot`` different super-k-mers is split: its windows are counted one
by one, by their own fingerprints, with map-side sums.

Windows are compared by 128-bit fingerprints.  Defined cases: a null or empty text, or one of fewer than ``k`` words, has
no windows.  Repeated rows are copies of each other, also with one id; null ids are kept.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.llm.common import Ids, covered, keyed, on_key, parts, runs, signed, windows, written
from grovekit.llm.superkmers import BYTE_IDS, shared_segments

PACKED = "h long, p long, times int, payload binary, at int, w1 long, w2 long"
PER_TASK = 20_000


def packed_strings(docs: DataFrame, wanted: DataFrame, k: int, by_words: bool) -> DataFrame:
    """The text of the ``wanted`` runs of windows: packed for a bucket, or window by window where ``hot``."""
    at = F.struct("start", "n", "h", "p", "times", "hot")
    lists = wanted.groupBy("doc_id", "f").agg(F.collect_list(at).alias("wanted"))
    rows = on_key(keyed(docs), lists, "inner").select("text", "wanted", "doc_id", "f")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, last = packed_ids(by_words), None
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for text, asked, *key in zip(*(c.to_pylist() for c in batch.columns)):
                if key == last:  # a repeated row: its runs are counted as such, one of them is enough
                    continue
                last = key
                whole = text.encode().split() if by_words else text.encode()
                for a in asked:
                    piece = whole[a["start"] : a["start"] + a["n"] + k - 1]
                    piece = b" ".join(piece) if by_words else piece
                    if not a["hot"]:
                        rows = [(piece, 0, 0, 0)]
                    else:
                        ids = ids_of(piece)
                        w1, w2 = signed(windows(ids, k, 2)), signed(windows(ids, k, 3))
                        rows = [(None, i, x, y) for i, (x, y) in enumerate(zip(w1.tolist(), w2.tolist()))]
                    for r in rows:
                        for c, v in zip(out, (a["h"], a["p"], a["times"], *r)):
                            c.append(v)
            types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.int64())
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, types)], ["h", "p", "times", "payload", "at", "w1", "w2"]
                )

    return rows.mapInArrow(cut, PACKED)


def packed_ids(by_words: bool) -> Callable[[bytes], np.ndarray]:
    """Fingerprints of the words, or bytes, of a packed string."""
    words = Ids()
    return (lambda raw: words(raw.split())) if by_words else (lambda raw: BYTE_IDS[np.frombuffer(raw, np.uint8)])


def count_in_buckets(packed: DataFrame, k: int, buckets: int, by_words: bool) -> DataFrame:
    """``h, p, at``: windows of single packed strings that sorting finds again in their bucket."""

    def counts(payloads: list[bytes]) -> np.ndarray:
        size = (lambda x: x.count(b" ") + 1) if by_words else len
        return np.fromiter(map(size, payloads), np.int64, len(payloads))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, w1, w2, owner, place, h, p, times, seen = packed_ids(by_words), [], [], [], [], [], [], [], 0
        for batch in batches:
            # The strings of a batch are fingerprinted as one; windows that reach into the next string are left out.
            payloads = batch.column(3).to_pylist()
            if not payloads:
                continue
            ids, sizes = ids_of(b"".join(payloads) if not by_words else b" ".join(payloads)), counts(payloads)
            own = np.maximum(sizes - k + 1, 0)
            at = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            whole = np.repeat(np.cumsum(sizes) - sizes, own) + at
            w1.append(windows(ids, k, 2)[whole])
            w2.append(windows(ids, k, 3)[whole])
            place.append(at.astype(np.int32))
            owner.append(np.repeat(np.arange(len(payloads), dtype=np.int32) + seen, own))
            seen += len(payloads)
            for held, c in ((h, 0), (p, 1), (times, 2)):
                held.append(batch.column(c).to_numpy())
        if not w1:
            return
        a, b, owner, place = (np.concatenate(x) for x in (w1, w2, owner, place))
        h, p, times = (np.concatenate(x) for x in (h, p, times))
        order = np.lexsort((b, a))
        a, b, owner, place = a[order], b[order], owner[order], place[order]
        first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        total = np.add.reduceat(times[owner], first)
        again = np.repeat(total, np.diff(np.concatenate((first, [len(a)])))) > 1
        again &= times[owner] == 1
        owner, place = owner[again], place[again]
        yield pa.RecordBatch.from_arrays([pa.array(h[owner]), pa.array(p[owner]), pa.array(place)], ["h", "p", "at"])

    return packed.repartition(buckets, "h").mapInArrow(count, "h long, p long, at int")


def buckets_of(
    docs: DataFrame, shared: DataFrame, k: int, hot: int, by_words: bool, compare: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``doc_id, f, first, last``: ranges of window starts whose windows begin elsewhere too.

    ``shared`` has runs of windows ``h, p, doc_id, f, start, n, inner``: equal windows have the same bucket ``h``, equal runs
    the same ``p``; ``inner`` tells that a run repeats one of its own windows.  ``compare`` gets packed strings and returns
    ``h, p, at``: windows of single ones that are found again in their bucket.
    """
    kinds = written(
        shared.groupBy("h", "p").agg(
            F.count("*").alias("times"),
            F.max("inner").alias("inner"),
            F.min(F.struct("doc_id", "f", "start", "n")).alias("one"),
        )
    )
    # In a bucket whose runs all come twice or more, nothing is left to ask.
    asked = (
        kinds.groupBy("h")
        .agg(F.count("*").alias("kinds"), F.min("times").alias("least"), F.max("inner").alias("inner"))
        .filter("least = 1 and (kinds > 1 or inner)")
        .select("h", (F.col("kinds") > hot).alias("hot"))
    )
    wanted = kinds.join(asked, "h").select(
        "h", "p", F.least("times", F.lit(2)).cast("int").alias("times"), "hot", "one.*"
    )
    packed = written(packed_strings(docs, wanted, k, by_words))
    cold, split = packed.filter("payload is not null"), packed.filter("payload is null")
    found = compare(cold)
    often = split.groupBy("w1", "w2").agg(F.sum("times").alias("total")).filter("total > 1").select("w1", "w2")
    found = found.union(split.filter("times = 1").join(often, ["w1", "w2"]).select("h", "p", "at"))
    # A run that is found once stands for itself; of the others all windows are repeated.
    single = found.groupBy("h", "p").agg(F.sort_array(F.collect_set("at")).alias("at"))
    single = single.join(kinds.filter("times = 1"), ["h", "p"]).select("one.*", F.explode("at").alias("at"))
    single = single.select("doc_id", "f", (F.col("start") + F.col("at")).alias("first"))
    several = shared.join(kinds.filter("times > 1").select("h", "p"), ["h", "p"])
    return single.select("doc_id", "f", "first", (F.col("first") + 1).alias("last")).union(
        several.select("doc_id", "f", F.col("start").alias("first"), (F.col("start") + F.col("n")).alias("last"))
    )


def dedup_substrings(docs: DataFrame, k: int = 35, m: int = 12, hot: int = 20_000) -> DataFrame:
    """``doc_id, text, n_words, n_removed, spans``: kept words of every row, joined by one space, and removed word runs."""
    count = lambda packed: count_in_buckets(packed, k, parts(docs, packed.count(), PER_TASK), True)
    ranges = buckets_of(docs, shared_segments(docs, True, k, m), k, hot, True, count)
    # Repeated rows have found the same ranges, each of them: a set, so that lists do not grow with the rows.
    lists = ranges.groupBy("doc_id", "f").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    rows = on_key(keyed(docs), lists, "left").select("doc_id", "text", "ranges")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, removed, spans = [], [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = text.encode().split()
                gone = np.zeros(len(words), bool)
                if found:
                    starts = np.concatenate([np.arange(r["first"], r["last"]) for r in found])
                    gone = covered(starts, k, len(words))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(*runs(gone))])
                counts.append(len(words))
                removed.append(int(gone.sum()))
                texts.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if found else words).decode())
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span)],
                ["doc_id", "text", "n_words", "n_removed", "spans"],
            )

    return rows.mapInArrow(
        keep, "doc_id long, text string, n_words long, n_removed long, spans array<struct<start:int,end:int>>"
    )

