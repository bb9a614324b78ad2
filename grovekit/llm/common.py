"""What the corpus operators share: keys of rows, written steps, words, fingerprints."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovekit.session import materialize

#: Shuffle files of a step that has been written are dropped when the step ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read again: cuts lineage and frees its shuffle files."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return materialize(df)
    finally:
        conf.set(CLEANUP, before)


def rows_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` of every row, null text as empty; no other column can clash later on."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    )


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, f, text``: rows are told apart by id and text, so that an id may be null or come again."""
    return rows_of(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("f"), "text")


def on_key(left: DataFrame, right: DataFrame, how: str, *names: str) -> DataFrame:
    """Equi-join on ``names`` (``doc_id, f`` by default) in which a null id equals a null id."""
    names = names or ("doc_id", "f")
    spare = {n: f"__{n}" for n in names}
    right = right.withColumnsRenamed(spare)
    match = reduce(Column.__and__, [left[n].eqNullSafe(right[s]) for n, s in spare.items()])
    return left.join(right, match, how).drop(*spare.values())


def rows_by_key(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose ``doc_id, f`` is (``left_semi``) or is not (``left_anti``) in ``keys``."""
    key = [docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("f")]
    rows = docs.select(*key, F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return on_key(rows, keys.select("doc_id", "f").distinct(), how).select("row.*")


def parts(df: DataFrame, rows: int, per_part: int) -> int:
    """How many partitions hold ``rows`` at ``per_part`` each, and keep every core busy."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_part))


# words and fingerprints inside tasks ------------------------------------------------


#: ASCII white space.
WHITE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def slices(texts: list[str], most: int = 1 << 22) -> Iterator[slice]:
    """Stretches of texts of about ``most`` characters: whole texts, at least one."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t) + 1
        if held >= most:
            yield slice(first, i + 1)
            first, held = i + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (and the last one ends)."""
    raw = [t.encode() for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))


def distinct_strings(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct ones of the strings that begin at ``offsets`` (whose last one is the end), and which of them each is."""
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    found = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).dictionary_encode()
    if not len(found.dictionary):
        return [], np.empty(0, np.int64)
    _, places, values = found.dictionary.buffers()
    values, places = values.to_pybytes(), np.frombuffer(places, np.int64)[: len(found.dictionary) + 1].tolist()
    return [values[i:j] for i, j in zip(places, places[1:])], found.indices.to_numpy()


def distinct_words(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of the texts, which of them each word is, and the number of words of each text."""
    b, bounds = joined(texts)
    solid = ~WHITE[b]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begins = bounds[bounds < len(b)]
    first[begins] = solid[begins]
    starts = np.flatnonzero(first)
    place = np.concatenate((np.zeros(1, np.int64), np.cumsum(solid)))
    words, at = distinct_strings(b[solid], np.append(place[starts], place[-1]))
    return words, at, np.diff(np.searchsorted(starts, bounds))


class Memo(dict):
    """Values of byte strings, made when they are first asked for."""

    def __init__(self, make: Callable[[bytes], int]):
        self.make = make

    def __missing__(self, word: bytes) -> int:
        value = self[word] = self.make(word)
        return value


class Ids:
    """Words as 64-bit fingerprints; the memo is dropped when it has grown large."""

    def __init__(self, limit: int = 250_000):
        self.memo = Memo(self.fingerprint)
        self.limit = limit

    @staticmethod
    def fingerprint(word: bytes) -> int:
        import xxhash

        return xxhash.xxh3_64_intdigest(word)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.memo) > self.limit:
            self.memo.clear()
        return np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly (finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def windows(ids: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """64-bit fingerprints of all ``k`` consecutive ids; empty if there are fewer than ``k``."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # Fingerprints of 1, 2, 4, ... ids, put together to k: log2(k) passes over the text.
    base = mix(ids + np.uint64(0x9E3779B97F4A7C15 * (2 * seed + 1) % 2**64))
    whole, done, power, size = None, 0, base, 1
    while True:
        if k & size:
            if whole is None:
                whole, done = power, size
            else:
                m = min(len(whole), len(power) - done)
                whole, done = mix(whole[:m] * np.uint64(0x9FB21C651E98DF25) + power[done : done + m]), done + size
        if 2 * size > k:
            return whole[:n]
        power = mix(power[:-size] * np.uint64(0xC2B2AE3D27D4EB4F) + power[size:])
        size *= 2


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit fingerprints as Spark's long."""
    return x.view(np.int64)


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Mask of ``n`` places covered by windows of ``k`` places that begin at ``starts``."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + k, n), -1)
    return np.cumsum(steps[:n]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end places of the runs of true values."""
    edges = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
