"""N-gram Jaccard join (2): documents whose sets of word shingles overlap by ``percent`` per cent or more.

Equal sets are one class.  The shingles of a set are put in one global order, rare ones first; two sets that link share
one of the first ``n - ceil(t n) + 1`` of them.  Rarity is counted over all documents in a sketch of fixed size: any
order gives the same links, a good one fewer candidates.  Candidates come in two rounds, since only components are
asked for.  First every set is compared with one hub of each prefix shingle it shares, the set with the fewest rarer
shingles: among near copies, the one that has most in common with all.  So a group of near copies costs about as many
pairs as it has members.  Then, for shingles whose sets are still in several components, pairs across components follow.
Pairs pass the length and positional filters before, the suffix filter and the exact count once, however many shingles
they share.

Defined cases: a document without words or text has an empty set and links with nothing, not even with its like.  With
fewer words than ``size`` the whole sequence is the only shingle.  A null id takes part; it is the component's id only
if no member has another.  Repeated rows are equal sets.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.llm.common import Ids, keyed, mix, on_key, rows_by_key, signed, windows, written
from grovekit.llm.components import components

BUCKETS, SLICE = 1 << 20, 1 << 12


def shingle_set(ids: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles of a word sequence."""
    if not len(ids):
        return np.empty(0, np.uint64)
    if len(ids) < size:
        return mix(windows(ids, len(ids)) + np.uint64(len(ids)))
    return np.unique(windows(ids, size))


def words(ids: Ids, text: str) -> np.ndarray:
    return ids(text.encode().lower().split())


def bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(44)).astype(np.int64)


def set_ids(docs: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """``doc_id, f, n, c, c2`` of every row (set size and 128-bit set id), and counts of all shingles by bucket."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        fingerprint, counts = Ids(), np.zeros(BUCKETS, np.int64)
        names = ["doc_id", "f", "n", "c", "c2", "slice", "counts"]
        for batch in batches:
            n, c, waiting, held = [], [], [], 0
            for text in batch.column(2).to_pylist():
                found = shingle_set(words(fingerprint, text), size)
                n.append(len(found))
                c.append(xxhash.xxh3_128_digest(found.tobytes()))
                waiting.append(found)
                held += len(found)
                if held >= BUCKETS:
                    counts += np.bincount(bucket(np.concatenate(waiting)), minlength=BUCKETS)
                    waiting, held = [], 0
            if waiting:
                counts += np.bincount(bucket(np.concatenate(waiting)), minlength=BUCKETS)
            both = np.frombuffer(b"".join(c), np.int64).reshape(-1, 2)
            none = pa.nulls(len(n))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int32()), pa.array(both[:, 0]), pa.array(both[:, 1])]
                + [none.cast(pa.int32()), none.cast(pa.binary())],
                names,
            )
        slices = counts.reshape(-1, SLICE)
        used = np.flatnonzero(slices.any(1))
        none = pa.nulls(len(used))
        yield pa.RecordBatch.from_arrays(
            [none.cast(t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())]
            + [pa.array(used.astype(np.int32)), pa.array([slices[i].tobytes() for i in used], pa.binary())],
            names,
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[i] = total.get(i, 0) + np.frombuffer(x, np.int64)
        kept = [np.minimum(x, 2**31 - 1).astype(np.int32).tobytes() for x in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(kept, pa.binary())], ["slice", "counts"])

    both = written(
        keyed(docs).mapInArrow(measure, "doc_id long, f long, n int, c long, c2 long, slice int, counts binary")
    )
    sums = both.filter("slice is not null").select("slice", "counts").repartition("slice")
    sketch = np.zeros((BUCKETS // SLICE, SLICE), np.int32)
    for r in sums.mapInArrow(add, "slice int, counts binary").collect():  # 4 MB, whatever the input
        sketch[r["slice"]] = np.frombuffer(r["counts"], np.int32)
    return both.filter("slice is null").select("doc_id", "f", "n", "c", "c2"), sketch.reshape(-1)


def shared_prefixes(docs: DataFrame, sketch: np.ndarray, size: int, percent: int) -> DataFrame:
    """``t, c, at, n, hub, hub_at, hub_n``: prefix shingles that several sets have, with the hub of each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        fingerprint = Ids()
        for batch in batches:
            seen, t, c, at, n = set(), [], [], [], []
            for text in batch.column(0).to_pylist():
                found = shingle_set(words(fingerprint, text), size)
                own = xxhash.xxh3_128_digest(found.tobytes())
                if not len(found) or own in seen:  # copies in one batch speak once
                    continue
                seen.add(own)
                prefix = len(found) + (-percent * len(found)) // 100 + 1
                first = found[np.lexsort((found, sketch[bucket(found)]))[:prefix]]
                t.append(first)
                c.append(np.full(len(first), np.frombuffer(own, np.int64)[0]))
                at.append(np.arange(len(first), dtype=np.int32))
                n.append(np.full(len(first), len(found), np.int32))
            if t:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(np.concatenate(t))), *[pa.array(np.concatenate(x)) for x in (c, at, n)]],
                    ["t", "c", "at", "n"],
                )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (t, at, n, c): the first of a shingle is its hub."""
        hub, waiting, last = (None, 0, 0, 0), True, None
        names = ["t", "c", "at", "n", "hub", "hub_at", "hub_n"]
        for batch in batches:
            t, c, at, n = (batch.column(i).to_numpy() for i in range(4))
            if not len(t):
                continue
            # Leave out repeated (t, c); rows of one shingle may go on from the batch before.
            fresh = np.concatenate(([(t[0], c[0]) != last], (t[1:] != t[:-1]) | (c[1:] != c[:-1])))
            last = (t[-1], c[-1])
            t, c, at, n = t[fresh], c[fresh], at[fresh], n[fresh]
            if not len(t):
                continue
            first = np.concatenate(([t[0] != hub[0]], t[1:] != t[:-1]))
            owner = np.maximum.accumulate(np.where(first, np.arange(len(t)), -1))
            old = owner < 0
            hub_c = np.where(old, hub[1], c[owner])
            hub_at = np.where(old, hub[2], at[owner]).astype(np.int32)
            hub_n = np.where(old, hub[3], n[owner]).astype(np.int32)
            rows = ~first
            starts = rows & np.concatenate(([True], first[:-1]))  # second set of a shingle: its hub belongs to the result
            starts[0] = rows[0] and waiting
            lead = np.flatnonzero(starts)
            out = [
                np.concatenate((a[rows], b[lead]))
                for a, b in ((t, t), (c, hub_c), (at, hub_at), (n, hub_n), (hub_c, hub_c), (hub_at, hub_at), (hub_n, hub_n))
            ]
            if len(out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names)
            waiting = bool(first[-1])
            hub = (t[-1], hub_c[-1], hub_at[-1], hub_n[-1])

    rows = keyed(docs).select("text").mapInArrow(cut, "t long, c long, at int, n int")
    return written(
        rows.repartition("t")
        .sortWithinPartitions("t", "at", "n", "c")
        .mapInArrow(meet, "t long, c long, at int, n int, hub long, hub_at int, hub_n int")
    )


def needed(percent: int) -> str:
    """Shingles that linked sets of sizes n and m have in common, at least."""
    return f"ceil({percent} * (n + m) / {100 + percent})"


def passing(pairs: DataFrame, percent: int) -> DataFrame:
    """``x, y`` of rows ``x, at, n, y, to, m`` that pass the length and positional filters; each pair once.

    Behind the first shingle that two linked sets share, both have as many as they need in common; a row of which this
    does not hold is not the first one.
    """
    in_reach = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    ahead = f"least(n - at, m - to) >= {needed(percent)}"
    return pairs.filter(in_reach).filter(ahead).select("x", "y").distinct()


def linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """``u, v``: the pairs whose sets link, by an exact count."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fingerprint = Ids()
        for batch in batches:
            found = [shingle_set(words(fingerprint, t), size).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["c", "tokens"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                good.append(similar(x, y, percent))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["u", "v"])

    asked = pairs.select(F.col("x").alias("c")).union(pairs.select(F.col("y").alias("c"))).distinct()
    one = classes.join(asked, "c").select("c", "one.*")
    tokens = written(on_key(keyed(docs), one, "inner").select("c", "text").mapInArrow(sets, "c long, tokens binary"))
    x = tokens.select(F.col("c").alias("x"), F.col("tokens").alias("a"))
    y = tokens.select(F.col("c").alias("y"), F.col("tokens").alias("b"))
    both = pairs.join(x, "x").join(y, "y").select("x", "y", "a", "b")
    return written(both.mapInArrow(verify, "u long, v long"))


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Suffix filter, then the exact test on sorted sets: 100 * common >= percent * together."""
    if len(x) >= 8:
        # Cut both sets at the same four shingles; what sizes differ by, piece for piece, cannot be in common.
        cuts = x[len(x) * np.arange(1, 4) // 4]
        a = np.diff(np.concatenate(([0], np.searchsorted(x, cuts), [len(x)])))
        b = np.diff(np.concatenate(([0], np.searchsorted(y, cuts), [len(y)])))
        common = int(np.minimum(a, b).sum())
        if 100 * common < percent * (len(x) + len(y) - common):
            return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def join_documents(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, f, n_shingles, component_id, root`` of every row.

    The component's id is its lowest ``doc_id``; ``root`` tells components apart, also where ids are null, and is null
    for an empty set.
    """
    ids, sketch = set_ids(docs, size)
    classes = written(
        ids.filter("n > 0")
        .groupBy("c", "c2")
        .agg(F.min("doc_id").alias("low"), F.min(F.struct("doc_id", "f")).alias("one"))
    )
    shared = shared_prefixes(docs, sketch, size, percent)
    swap = F.col("c") < F.col("hub")
    pick = lambda a, b: F.when(swap, F.col(b)).otherwise(F.col(a))
    hubs = shared.filter("c <> hub").select(
        pick("c", "hub").alias("x"),
        pick("at", "hub_at").alias("at"),
        pick("n", "hub_n").alias("n"),
        pick("hub", "c").alias("y"),
        pick("hub_at", "at").alias("to"),
        pick("hub_n", "n").alias("m"),
    )
    done = written(passing(hubs, percent))
    edges = linked(docs, classes, done, size, percent)
    roots = written(components(edges))
    placed = shared.join(roots.withColumnRenamed("node", "c"), "c", "left").select(
        "t", "c", "at", "n", F.coalesce("root", "c").alias("root")
    )
    apart = placed.groupBy("t").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("t")
    placed = written(placed.join(apart, "t"))
    left = placed.select("t", F.col("c").alias("x"), "at", "n", F.col("root").alias("r"))
    right = placed.select("t", F.col("c").alias("y"), F.col("at").alias("to"), F.col("n").alias("m"), F.col("root").alias("s"))
    across = left.join(right, "t").filter("r <> s and x > y")
    pairs = passing(across, percent).join(done, ["x", "y"], "left_anti")
    more = linked(docs, classes, written(pairs), size, percent)
    roots = written(components(edges.union(more)))
    whole = classes.join(roots.withColumnRenamed("node", "c"), "c", "left").select(
        "c", "c2", "low", F.coalesce("root", "c").alias("root")
    )
    least = whole.groupBy("root").agg(F.min("low").alias("component_id"))
    named = whole.join(least, "root").select("c", "c2", "component_id", "root")
    return ids.join(named, ["c", "c2"], "left").select(
        "doc_id",
        "f",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "root",
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, repeats: bool = True) -> DataFrame:
    """The rows of ``docs``, with all their columns, that come first (by id) in their component; all without words stay.

    Rows that repeat id (or null) and text of the first one stay with it, as one document listed more than once; without
    ``repeats`` one row of each component stays, of such rows the lowest by its other columns (maps are not looked at).
    """
    placed = written(join_documents(docs, size, percent))
    worded = placed.filter("root is not null")
    first = worded.groupBy("root").agg(F.min(F.struct("doc_id", "f")).alias("first")).select("first.*")
    alone = placed.filter("root is null").select("doc_id", "f")
    if repeats:
        return rows_by_key(docs, first.union(alone), "left_semi")
    often = worded.groupBy("doc_id", "f").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id", "f")
    often = written(on_key(often, first, "left_semi"))
    if often.isEmpty():
        return rows_by_key(docs, first.union(alone), "left_semi")
    # Only rows whose key comes again are aggregated, and map-side before they are dealt out.
    keys = on_key(first.union(alone).distinct(), often.withColumn("again", F.lit(True)), "left")
    key = [docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("f")]
    rows = docs.select(*key, F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    found = written(on_key(rows, keys, "inner").select("doc_id", "f", "again", "row"))
    order = F.struct(*[F.col("row")[c] for c, kind in docs.dtypes if "map<" not in kind and c not in ("doc_id", "text")], F.lit(0))
    one = found.filter("again").groupBy("doc_id", "f").agg(F.min_by("row", order).alias("row"))
    return found.filter("again is null").select("row.*").union(one.select("row.*"))
