"""Rows at the nodes of many growing trees, found inside the tasks.

Trees of any number of models grow together.  A row is stored once, with the bags that drew it; several trees may use
one bag.  Tasks get the trees grown so far and walk each row down to its open node, so that rows are neither copied
for trees nor shuffled, and there is no state between passes that could be lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Container, Iterator, Sequence
from copy import copy
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from grovekit.functions.impurity import GAIN_METHODS
from grovekit.operators.moments import dense
from grovekit.session import materialize

#: Rows that a task looks at together, and bytes of them that are packed in one row of a table.
BLOCK_ROWS, PACKED_BYTES = 65_536, 512 * 1024
SPLIT_TYPES = ("orthogonal", "PCA", "SVM")


@dataclass(frozen=True)
class TreePlan:
    """What one tree is grown with: its bag, its raw columns, and how its nodes are split.

    ``view`` is a position in the list of feature maps that the tree's features go through first, or None.
    """

    bag: int
    columns: tuple[int, ...]
    n_features: int
    max_depth: int = 4
    split: str = "orthogonal"
    gain: str = "gini"
    candidates: str = "midpoint"
    c: int = 5
    penalty: float = 1.0
    svm_steps: int = 100
    lda: int | None = None
    view: int | None = None

    def __post_init__(self):
        if self.split not in SPLIT_TYPES:
            raise ValueError(f"unknown split {self.split!r}")
        if self.gain not in GAIN_METHODS:
            raise ValueError(f"unknown gain method {self.gain!r}")
        if self.split == "PCA" and self.c <= 0:
            raise ValueError("c must be positive")


def dots(columns: Sequence[np.ndarray], w: Sequence[float]) -> np.ndarray:
    """Rows, given as columns, on the direction ``w``, summed in feature order as predictions are."""
    z = np.zeros(len(columns[0]))
    for x, v in zip(columns, w):
        z = z + x * v
    return z


class WalkedTree:
    """A tree grown so far, as arrays; ``slot`` numbers its open nodes over all trees."""

    def __init__(self, bag: int, view: int | None, nodes: Sequence[tuple], open_nodes: dict[int, int]):
        self.bag, self.view = bag, view
        ids = [n[1] for n in nodes] + [n for n in open_nodes]
        at = {n: i for i, n in enumerate(ids)}
        inner = {n[1]: n for n in nodes if n[2] != "leaf"}
        width = max((len(n[4]) for n in nodes if n[4]), default=0)
        get = lambda n, i, other: inner[n][i] if n in inner and inner[n][i] is not None else other
        self.root = at[1]
        self.feature = np.array([get(n, 3, -1) for n in ids])
        self.w = np.array([get(n, 4, [0.0] * width) for n in ids])
        self.th = np.array([get(n, 5, np.inf) for n in ids])
        self.left = [at.get(2 * n, i) if n in inner else i for i, n in enumerate(ids)]
        self.right = [at.get(2 * n + 1, i) if n in inner else i for i, n in enumerate(ids)]
        self.slot = [open_nodes.get(n, -1) for n in ids]
        self.upwards = [at[n] for n in sorted(inner, reverse=True)]
        self._find_wanted()

    def _find_wanted(self) -> None:
        """Marks the nodes that have a slot or lie above one that has."""
        self.wanted = [s >= 0 for s in self.slot]
        for i in self.upwards:
            self.wanted[i] = self.wanted[self.left[i]] or self.wanted[self.right[i]]

    def only(self, slots: Container[int]) -> WalkedTree | None:
        """The tree with some of its open nodes alone, None without any."""
        tree = copy(self)
        tree.slot = [s if s in slots else -1 for s in self.slot]
        tree._find_wanted()
        return tree if tree.wanted[tree.root] else None

    def parts(self, columns: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Slot, features (a row each), class positions and weights of the rows, given as columns, at each open node."""
        waiting = [(self.root, columns, labels, weights)]
        while waiting:
            i, columns, labels, weights = waiting.pop()
            if not self.wanted[i] or not len(labels):
                continue
            if self.slot[i] >= 0:
                yield self.slot[i], columns.T, labels, weights
                continue
            z = columns[self.feature[i]] if self.feature[i] >= 0 else dots(columns, self.w[i])
            down = z <= self.th[i]
            for child, side in ((self.right[i], ~down), (self.left[i], down)):
                if self.wanted[child]:
                    at = np.flatnonzero(side)
                    waiting.append((child, columns.take(at, axis=1), labels.take(at), weights.take(at)))


def owner_type(n: int) -> type:
    """What the numbers of ``n`` rows are packed as."""
    return np.uint16 if n <= 1 << 16 else np.int32


class Block:
    """Some rows: features, class positions, and the bags that drew each row.

    ``bags`` has the row numbers and the weights of each bag; rows that several packed blocks hold are put together.
    Rows without a column ``bag`` all lie once in bag 0.
    """

    def __init__(self, batches: Sequence[pa.RecordBatch], classes: np.ndarray, views: Sequence):
        self.views, self.mapped = views, {}
        if "owners" in batches[0].schema.names:
            self._unpack([r for batch in batches for r in batch.to_pylist()])
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        one = lambda c: table.column(c).combine_chunks()
        self.raw = dense(one("features"))
        self.labels = np.searchsorted(classes, one("label").to_numpy())
        if "bag" not in table.column_names:
            self.bags = {0: (np.arange(len(self.raw)), np.ones(len(self.raw)))}
            return
        bag = one("bag")
        drawn = bag.flatten()
        owner = np.repeat(np.arange(len(self.raw)), np.diff(bag.offsets.to_numpy()))
        ids, weights = drawn.field("tree_id").to_numpy(), drawn.field("weight").to_numpy().astype(float)
        order = np.argsort(ids, kind="stable")
        bags, first = np.unique(ids[order], return_index=True)
        parts = zip(np.split(owner[order], first[1:]), np.split(weights[order], first[1:]))
        self.bags = {int(b): p for b, p in zip(bags, parts)}

    def _unpack(self, records: Sequence[dict]) -> None:
        raw, labels, parts, n = [], [], {}, 0
        for r in records:
            labels.append(np.frombuffer(r["labels"], np.int32))
            raw.append(np.frombuffer(r["features"]).reshape(len(labels[-1]), -1))
            owners = np.frombuffer(r["owners"], owner_type(len(labels[-1]))).astype(np.int64)
            weights = np.frombuffer(r["weights"], np.int64 if len(r["weights"]) == 8 * len(owners) else np.uint8).astype(float)
            ends = r["ends"]
            for bag, start, end in zip(r["bags"], [0, *ends], ends):
                parts.setdefault(bag, []).append((owners[start:end] + n, weights[start:end]))
            n += len(labels[-1])
        self.raw, self.labels = np.concatenate(raw), np.concatenate(labels)
        self.bags = {b: tuple(map(np.concatenate, zip(*p))) for b, p in parts.items()}

    def part(self, at: np.ndarray) -> pa.RecordBatch:
        """The rows of ascending numbers ``at`` as one packed row."""
        kept = {}
        for bag, (rows, weights) in sorted(self.bags.items()):
            span = slice(*np.searchsorted(rows, (at[0], at[-1] + 1)))  # a bag's rows ascend
            place = np.searchsorted(at, rows[span])
            drawn = at[place] == rows[span]
            kept[bag] = place[drawn], weights[span][drawn]
        owners, weights = (np.concatenate([v[i] for v in kept.values()] or [np.empty(0)]) for i in range(2))
        numbers = [list(kept), np.cumsum([len(v[0]) for v in kept.values()], dtype=np.int64).tolist()]
        weights = weights.astype(np.uint8 if weights.max(initial=0) < 256 else np.int64)
        binary = [self.raw[at], self.labels[at].astype(np.int32), owners.astype(owner_type(len(at))), weights]
        arrays = [pa.array([v.tobytes()], pa.binary()) for v in binary]
        arrays += [pa.array([numbers[0]], pa.list_(pa.int32())), pa.array([numbers[1]], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, PACKED_NAMES)

    def bytes_per_row(self) -> int:
        return 8 * self.raw.shape[1] + 4 + 3 * sum(len(rows) for rows, _ in self.bags.values()) // max(1, len(self.raw))

    def columns(self, view: int | None) -> np.ndarray:
        """The features of a view, a row for each feature."""
        if view not in self.mapped:
            self.mapped[view] = np.ascontiguousarray((self.raw if view is None else self.views[view](self.raw)).T)
        return self.mapped[view]

    def at_nodes(self, tree: WalkedTree) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Slot, features, class positions and weights of the rows at each open node of ``tree``."""
        if tree.bag not in self.bags:
            return
        rows, weights = self.bags[tree.bag]
        yield from tree.parts(self.columns(tree.view).take(rows, axis=1), self.labels.take(rows), weights)


def blocks(batches: Iterator[pa.RecordBatch], classes: np.ndarray, views: Sequence) -> Iterator[Block]:
    """Blocks of about ``BLOCK_ROWS`` rows, from rows or from packed rows."""
    held, n = [], 0
    for whole in batches:
        packed_rows = "owners" in whole.schema.names
        for batch in (whole.slice(i, 1) for i in range(whole.num_rows)) if packed_rows else (whole,):
            if batch.num_rows:
                held.append(batch)
                n += len(batch.column("labels")[0].as_buffer()) // 4 if packed_rows else batch.num_rows
            if n >= BLOCK_ROWS:
                yield Block(held, classes, views)
                held, n = [], 0
    if held:
        yield Block(held, classes, views)


PACKED_NAMES = ["features", "labels", "owners", "weights", "bags", "ends"]
PACKED = "features binary, labels binary, owners binary, weights binary, bags array<int>, ends array<long>"
PACKED_ARROW = pa.schema(
    [*[(name, pa.binary()) for name in PACKED_NAMES[:4]], ("bags", pa.list_(pa.int32())), ("ends", pa.list_(pa.int64()))]
)


def scanned(rows: DataFrame) -> DataFrame:
    """What ``blocks`` reads of ``rows``."""
    plain = [c for c in ("features", "label", "bag") if c in rows.columns]
    return rows.select(*(PACKED_NAMES if "owners" in rows.columns else plain))


def packed(rows: DataFrame, classes: Sequence[int]) -> DataFrame:
    """``rows`` (features, label, bag) written once for many passes, some hundred KB of them as arrays in a row.

    A pass then reads arrays, and neither takes lists apart nor sorts them by bag again.
    """
    if "owners" in rows.columns:
        return materialize(rows)  # packed where the bags were drawn
    return materialize(scanned(rows).mapInArrow(_packer(classes), PACKED))


def _packer(classes: Sequence[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    shared = np.array(sorted(int(c) for c in classes))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, shared, ()):
            step = max(64, PACKED_BYTES // block.bytes_per_row())
            for start in range(0, len(block.raw), step):
                yield block.part(np.arange(start, min(start + step, len(block.raw))))

    return pack


def packing(classes: Sequence[int]) -> tuple[Callable[[pa.Table], pa.Table], str]:
    """Packs a table of features, label and bag at once, and the schema this gives."""
    pack = _packer(classes)
    return lambda table: pa.Table.from_batches(pack(iter(table.to_batches())), PACKED_ARROW), PACKED


def sampled(rows: DataFrame, n_rows: int, wanted: int, classes: np.ndarray, views: Sequence, seed: int = 7) -> Block | None:
    """A block of about ``wanted`` rows at the driver."""
    share = min(1.0, 1.2 * wanted / max(n_rows, 1))
    if "owners" not in rows.columns:
        table = scanned(rows).sample(share, seed).toArrow()
        return Block(table.to_batches(), classes, views) if table.num_rows else None

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, classes, ()):
            rng = np.random.default_rng([seed, zlib.crc32(block.raw.tobytes())])
            at = np.flatnonzero(rng.random(len(block.raw)) < share)
            if len(at):
                yield block.part(at)

    table = scanned(rows).mapInArrow(choose, PACKED).toArrow()
    return Block(table.to_batches(), classes, views) if table.num_rows else None
