"""Token files (3): ids under one canonical, length-limited Huffman code, written in blocks and read back.

Ids are counted over all documents; the code is the best one with at most ``max_bits`` bits an id (package-merge), and
canonical, so that the lengths alone describe it.  A file is a table of blocks in ascending order of documents: each
block has whole documents, its bits, and the bit offset of every ``every``-th id.  Blocks and the stretches between
offsets are independent; a reader decodes all stretches of a block side by side, one table look-up an id.

Layout of a written set of files: ``blocks`` (part, block, n_ids, doc_ids, sizes, offsets, bits) and ``code`` (symbol,
length), both Parquet, so that any file system that Spark reaches will do and failed tasks leave nothing behind.

Defined cases: a null or empty text is its end id alone.  Documents with one id keep no particular order among each
other; a null id comes first.  Without documents the files hold no block.  Other columns are not written.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovekit.llm.common import rows_of, slices, written
from grovekit.llm.tokens import at_white_space, encoder
from grovekit.session import local_table, shared_folder

RAW = "part int, block int, n_ids long, doc_ids array<long>, sizes array<int>, ids binary"
CODED = "part int, block int, n_ids long, doc_ids array<long>, sizes array<int>, offsets array<long>, bits binary"


def token_blocks(docs: DataFrame, path: str, end_id: int, block_ids: int) -> DataFrame:
    """Raw blocks of whole documents in ascending order of ids; parts are ranges of ids."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded = encoder(path, at_white_space)
        names = [c.split()[0] for c in RAW.split(", ")]
        held: list[tuple] = []
        part, block, size = 0, 0, 0

        def finished() -> pa.RecordBatch:
            sizes = [len(x) for _, x in held]
            columns = (
                pa.array([part], pa.int32()),
                pa.array([block], pa.int32()),
                pa.array([size], pa.int64()),
                pa.array([[d for d, _ in held]], pa.list_(pa.int64())),
                pa.array([sizes], pa.list_(pa.int32())),
                pa.array([np.concatenate([x for _, x in held]).astype("<u2" if small else "<u4").tobytes()], pa.binary()),
            )
            return pa.RecordBatch.from_arrays(list(columns), names)

        small = encoded.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 and end_id < 1 << 16
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(2)[0].as_py()
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k in slices(texts):
                for doc_id, (tokens, _) in zip(ids[k], encoded(texts[k])):
                    held.append((doc_id, np.append(tokens, np.int32(end_id))))
                    size += len(tokens) + 1
                    if size >= block_ids:
                        yield finished()
                        held, block, size = [], block + 1, 0
        if held:
            yield finished()

    ordered = rows_of(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return ordered.withColumn("part", F.spark_partition_id()).mapInArrow(encode, RAW)


def raw_ids(n: int, raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")


def symbol_counts(blocks: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and their counts over all blocks; bounded by the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.bincount(raw_ids(n, raw), minlength=len(total))
                found[: len(total)] += total
                total = found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["symbol", "n"])

    counts = blocks.select("n_ids", "ids").mapInArrow(count, "symbol long, n long")
    found = counts.groupBy("symbol").agg(F.sum("n").alias("n")).toPandas().sort_values("symbol")
    return found["symbol"].to_numpy(), found["n"].to_numpy()


def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Lengths of the best prefix code with at most ``max_bits`` bits, by package-merge."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols do not fit {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.int64)
    # Each level: the symbols merged with the pairs of the level below; flags tell which is which.
    level, flags = weights, []
    for _ in range(max_bits - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate((weights, pairs))
        at = np.argsort(both, kind="stable")
        flags.append(at < n)
        level = both[at]
    # Go down again: of the first 2n - 2 items, symbols get one more bit, pairs are opened.
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for own in reversed(flags):
        symbols = int(own[:take].sum())
        lengths[:symbols] += 1
        take = 2 * (take - symbols)
    lengths[:take] += 1
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical code: shorter codes first, then lower symbols."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((symbols, lengths))
        self.symbols, self.lengths = symbols[order], lengths[order]
        self.bits = int(self.lengths.max()) if len(symbols) else 1
        steps = 1 << (self.bits - self.lengths)
        firsts = np.cumsum(steps) - steps
        top = int(self.symbols.max()) + 1 if len(symbols) else 1
        self.code_of, self.length_of = np.zeros(top, np.uint64), np.zeros(top, np.int64)
        self.code_of[self.symbols] = (firsts >> (self.bits - self.lengths)).astype(np.uint64)
        self.length_of[self.symbols] = self.lengths
        self.table = np.repeat(self.symbols, steps).astype(np.int32), np.repeat(self.lengths, steps)

    def encode(self, ids: np.ndarray, every: int) -> tuple[np.ndarray, bytes]:
        """Bit offsets of each ``every``-th id, and the bits in words of 64, highest bit first."""
        sizes = self.length_of[ids]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        words = np.zeros(int(ends[-1]) // 64 + 2, np.uint64)
        word, room = starts >> 6, 64 - (starts & 63)
        codes = self.code_of[ids]
        # Bits that fit the word are shifted up; those that do not go to the top of the next one.
        over = sizes - room
        up = np.maximum(-over, 0).astype(np.uint64)
        down = np.maximum(over, 0).astype(np.uint64)
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        words[word[first]] = np.bitwise_or.reduceat((codes >> down) << up, first)
        rest = np.flatnonzero(over > 0)
        words[word[rest] + 1] |= codes[rest] << (64 - over[rest]).astype(np.uint64)
        return starts[::every], words.astype(">u8").tobytes()

    def decode(self, n: int, offsets: np.ndarray, every: int, bits: bytes) -> np.ndarray:
        """All stretches at once: one id of each per step."""
        words = np.concatenate((np.frombuffer(bits, ">u8").astype(np.uint64), np.zeros(1, np.uint64)))
        out = np.empty((len(offsets), every), np.int32)
        at, (symbols, lengths) = offsets.astype(np.int64), self.table
        last = 64 * (len(words) - 2)
        for i in range(every):
            at = np.minimum(at, last)  # the last stretch may be shorter
            word, skip = at >> 6, (at & 63).astype(np.uint64)
            # Two shifts, since a shift by 64 has no defined result.
            window = (words[word] << skip) | ((words[word + 1] >> np.uint64(1)) >> (np.uint64(63) - skip))
            code = window >> np.uint64(64 - self.bits)
            out[:, i] = symbols[code]
            at = at + lengths[code]
        return out.reshape(-1)[:n]


def write_tokens(docs: DataFrame, path: str, out: str, end_id: int, max_bits: int = 18, every: int = 128, block_ids: int = 200_000) -> None:
    """Write the files to the folder ``out``."""
    spark = docs.sparkSession
    blocks = written(token_blocks(docs, path, end_id, block_ids))
    symbols, counts = symbol_counts(blocks)
    lengths = code_lengths(counts, max_bits)
    code = Code(symbols, lengths)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                offsets, bits = code.encode(raw_ids(row.column(2)[0].as_py(), row.column(5)[0].as_py()), every)
                yield pa.RecordBatch.from_arrays(
                    [*row.columns[:5], pa.array([offsets.tolist()], pa.list_(pa.int64())), pa.array([bits], pa.binary())],
                    [c.split()[0] for c in CODED.split(", ")],
                )

    blocks.mapInArrow(pack, CODED).write.parquet(f"{out}/blocks")
    table = list(zip(symbols.tolist(), lengths.tolist()))
    local_table(spark, table, "symbol long, length long").coalesce(1).write.parquet(f"{out}/code")


def read_tokens(spark: SparkSession, path: str, every: int = 128, keep_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids`` of every document in the files; ``ids`` is null unless ``keep_ids``."""
    table = spark.read.schema("symbol long, length long").parquet(f"{path}/code").toPandas()
    code = Code(table["symbol"].to_numpy(), table["length"].to_numpy())
    blocks = spark.read.schema(CODED).parquet(f"{path}/blocks")
    # One number per part passes the driver; blocks of a part add up on their own.
    sums = sorted(blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect(), key=lambda r: r["part"])
    before = np.concatenate(([0], np.cumsum([r["n"] for r in sums])))[:-1].tolist() if sums else []
    parts = local_table(spark, list(zip([r["part"] for r in sums], before)), "part int, before long")
    within = blocks.select("part", "block", F.expr("sum(n_ids) over (partition by part order by block) - n_ids").alias("within"))
    starts = within.join(parts, "part").select("part", "block", (F.col("before") + F.col("within")).alias("first"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>"

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, docs, sizes, offsets, bits, first = (batch.column(c)[i] for c in range(6))
                ids = code.decode(n.as_py(), offsets.values.to_numpy(), every, bits.as_py())
                ends = np.concatenate(([0], np.cumsum(sizes.values.to_numpy(), dtype=np.int64)))
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends.tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        docs.values,
                        pa.array(ends[:-1] + first.as_py()),
                        pa.array(np.diff(ends)),
                        pa.array(crc, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)) if keep_ids else pa.nulls(len(crc), pa.list_(pa.int32())),
                    ],
                    [c.split()[0] for c in schema.split(", ")],
                )

    found = blocks.join(starts, ["part", "block"])
    return found.select("n_ids", "doc_ids", "sizes", "offsets", "bits", "first").mapInArrow(unpack, schema)


def round_trip(docs: DataFrame, path: str, end_id: int, keep_ids: bool = True) -> DataFrame:
    """Write ``docs`` to a new folder in the shared one, and what the files then hold."""
    spark = docs.sparkSession
    out = f"{shared_folder(spark)}/grovekit/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, out, end_id)
    return read_tokens(spark, out, keep_ids=keep_ids)
