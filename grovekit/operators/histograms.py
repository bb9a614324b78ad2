"""Best thresholds of many nodes by bounded histograms: one way for tables of any size.

One pass counts, inside the tasks, the classes of each node over value ranges of each of its axes; only these counts
are summed by Spark.  The gain of a split is convex in the counts of its left side.  So the counts at both ends of a
range bound the gain of every threshold inside it, and ranges whose bound is below the best gain at a range's end are
done with.  A second pass looks at single values of the ranges that may still win.  A range that holds more rows than a
task should sort is cut further first.

Where the ranges are cut does not matter for the result: cuts come from a sample of the rows, and finer ones divide
the range evenly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.operators.moments import complete
from grovekit.operators.scan import Block, WalkedTree, blocks, dots, packed, sampled, scanned
from grovekit.session import discard

GAIN_PLACES = 12
#: Ranges of an axis, at least so many sampled rows in each, and sampled rows altogether.
RANGES, SAMPLED_PER_RANGE, SAMPLE_ROWS = 256, 4, 16_384
#: Where gains are noise, a range is done with when it holds about the square root of the node's rows: so many ranges at
#: most are counted at once, each sampled one divided evenly, while a pass has this many for all axes together.
MOST_RANGES, PASS_RANGES = 4096, 400_000
#: Rows in the open ranges of an axis that one task sorts; parts into which larger ranges are cut, down to how many rows.
EXACT_ROWS, FINER, SMALL_RANGE = 2_000_000, 32, 64
#: Cutting again for all axes together goes on while open rows fall below this share of those before, and are more than
#: this share of all rows of all axes.
GOOD_PART, OPEN_PART = 0.7, 0.1
#: Counters that a task holds, and that nodes searched in one pass have together.
PASS_COUNTERS = 8_000_000
#: With more classes, the bound takes each class's end on its own instead of all corners.
CORNER_CLASSES = 8


@dataclass
class Problem:
    """A node to split: the class counts of its rows and its axes, raw columns or directions."""

    tree: int
    node: int
    counts: np.ndarray
    gain: str
    candidates: str
    columns: Sequence[int] | None = None
    directions: np.ndarray | None = None
    cuts: list[np.ndarray] = field(default_factory=list)

    @property
    def axes(self) -> int:
        return len(self.columns) if self.columns is not None else len(self.directions)

    def values(self, x: np.ndarray) -> list[np.ndarray]:
        """The values of the rows on each axis."""
        return [x[:, c] for c in self.columns] if self.columns is not None else [dots(x.T, w) for w in self.directions]

    def sizes(self) -> np.ndarray:
        return np.array([len(c) + 1 for c in self.cuts])


@dataclass
class Split:
    axis: int
    th: float
    gain: float
    left: list[int]


def scaled_impurity(counts: np.ndarray, method: str) -> np.ndarray:
    """Rows times impurity of class counts along the last axis; nothing for no rows."""
    n = counts.sum(-1)
    if method == "gini":
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(n > 0, n - (counts * counts).sum(-1) / n, 0.0)
    return xlogx(n) - xlogx(counts).sum(-1)


def xlogx(c: np.ndarray) -> np.ndarray:
    return np.where(c > 0, c * np.log2(np.where(c > 0, c, 1)), 0.0)


def gains(left: np.ndarray, whole: np.ndarray, method: str) -> np.ndarray:
    """Gain of the splits that send ``left`` (…, classes) of ``whole`` to the left."""
    left, whole = left.astype(float), whole.astype(float)
    parts = scaled_impurity(left, method) + scaled_impurity(whole - left, method)
    return (scaled_impurity(whole, method) - parts) / whole.sum()


def units(gain: np.ndarray) -> np.ndarray:
    """Gains in whole units of the last place that is compared."""
    return np.floor(gain * 10.0**GAIN_PLACES + 0.5)


def bounds(before: np.ndarray, inside: np.ndarray, whole: np.ndarray, method: str) -> np.ndarray:
    """No split that sends ``before`` and some of ``inside`` to the left gains more than this."""
    k = len(whole)
    if k <= CORNER_CLASSES:
        top = np.full(len(before), -np.inf)
        for corner in range(1 << k):
            bits = np.array([corner >> i & 1 for i in range(k)])
            top = np.maximum(top, gains(before + inside * bits, whole, method))
        return top
    # The purest left side takes all it may of a class and is as small as it may be, each on its own; so the right.
    n, lo, hi = whole.sum(), before.sum(-1).astype(float), (before + inside).sum(-1).astype(float)
    most, rest = (before + inside).astype(float), (whole - before).astype(float)
    if method == "gini":
        pure = (most * most).sum(-1) / np.maximum(lo, 1) + (rest * rest).sum(-1) / np.maximum(n - hi, 1)
        parts = n - pure
    else:
        parts = xlogx(lo) + xlogx(n - hi) - xlogx(most).sum(-1) - xlogx(rest).sum(-1)
    return (scaled_impurity(whole.astype(float), method) - np.maximum(parts, 0)) / n


def sample_cuts(problems: Sequence[Problem], trees: Sequence[WalkedTree], sample: Block | None) -> None:
    """Cut points of every axis from the sampled rows that reach the node; none where there are too few.

    Axes of large nodes whose sampled values differ get more, evenly between these.
    """
    for p in problems:
        p.cuts = [np.empty(0)] * p.axes
    each = PASS_RANGES // max(1, sum(p.axes for p in problems))
    for tree in trees if sample is not None else ():
        for slot, x, _, _ in sample.at_nodes(tree):
            p, n = problems[slot], min(RANGES, len(x) // SAMPLED_PER_RANGE)
            if n > 1:
                at = np.arange(1, n) * len(x) // n
                parts = int(min(each, MOST_RANGES, np.sqrt(p.counts.sum()))) // n
                for a, values in enumerate(p.values(x)):
                    cuts = np.unique(np.sort(values)[at])
                    if parts > 1 and len(cuts) == n - 1:
                        between = np.linspace(cuts[:-1], cuts[1:], parts, endpoint=False).ravel()
                        cuts = np.unique(np.append(between, cuts))
                    p.cuts[a] = cuts


class Finder:
    """``np.searchsorted(cuts, values)`` by a table over even cells, for many values.

    The cell of a value never falls as the value rises, so that only cuts of its own cell are compared with it.
    """

    CELLS_PER_CUT, FEWEST = 4, 8

    def __init__(self, cuts: np.ndarray):
        self.cuts, self.scale = cuts, 0.0
        if len(cuts) >= self.FEWEST:
            edge = len(cuts) // 64  # outer cuts may lie far away
            self.low, high = cuts[edge], cuts[-1 - edge]
            self.last = self.CELLS_PER_CUT * len(cuts) - 1
            with np.errstate(all="ignore"):
                scale = self.last / (high - self.low)
            if np.isfinite(scale) and scale > 0:
                self.scale = scale
                inside = np.bincount(self.cells(cuts), minlength=self.last + 1)
                self.before = np.cumsum(inside) - inside
                self.next = np.append(cuts, np.inf)[self.before]
                self.next[inside == 0] = np.inf
                self.crowded = inside > 1

    def cells(self, values: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.clip((values - self.low) * self.scale, 0, self.last).astype(np.int64)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        if not self.scale or np.isnan(values).any():
            return np.searchsorted(self.cuts, values, "left")
        cells = self.cells(values)
        found = self.before[cells] + (self.next[cells] < values)
        at = np.flatnonzero(self.crowded[cells])
        if len(at):
            found[at] = np.searchsorted(self.cuts, values[at], "left")
        return found


COUNTS = "slot int, axis int, rng int"


def count_ranges(rows: DataFrame, shared, k: int) -> DataFrame:
    """``slot, axis, rng, c0…, top``: weighted class counts of each range, summed over the table.

    ``top`` counts the rows that stand at the range's upper cut: where these are all, the range is a single value.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        problems, trees, classes, views = shared.value
        sizes = [p.sizes() for p in problems]
        offset = np.concatenate(([0], np.cumsum([s.sum() for s in sizes])))
        finders = [[Finder(cuts) for cuts in p.cuts] for p in problems]
        held = np.zeros((offset[-1], k + 1))
        for block in blocks(batches, classes, views):
            for tree in trees:
                for slot, x, labels, weights in block.at_nodes(tree):
                    p = problems[slot]
                    if not any(map(len, p.cuts)):
                        continue
                    values, first = p.values(x), np.cumsum(sizes[slot]) - sizes[slot]
                    for a, cuts in enumerate(p.cuts):
                        n, v = sizes[slot][a], values[a]
                        rng = finders[slot][a](v)
                        at_cut = np.append(cuts, np.nan)[rng] == v
                        part = held[offset[slot] + first[a] :][:n]
                        part[:, :k] += np.bincount(rng * k + labels, weights, n * k).reshape(n, k)
                        if at_cut.any():
                            part[:, k] += np.bincount(rng[at_cut], weights[at_cut], n)
        counts = held.astype(np.int64)
        full = np.flatnonzero(counts.any(axis=1))
        slot = np.repeat(np.arange(len(problems)), np.diff(offset))
        axis = np.concatenate([np.repeat(np.arange(len(s)), s) for s in sizes])
        rng = np.concatenate([np.arange(n) for s in sizes for n in s])
        columns = [slot[full], axis[full], rng[full]]
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int32()) for c in columns], *[pa.array(counts[full, i]) for i in range(k + 1)]],
            ["slot", "axis", "rng", *names],
        )

    names = [*[f"c{i}" for i in range(k)], "top"]
    partial = scanned(rows).mapInArrow(count, f"{COUNTS}, {', '.join(f'{n} long' for n in names)}")
    return partial.groupBy("slot", "axis", "rng").agg(*[F.sum(n).alias(n) for n in names])


OPEN = "slot int, axis array<int>, rng array<int>, base array<long>, held array<long>"


def open_ranges(counts: DataFrame, shared, k: int) -> DataFrame:
    """``slot, axis, rng, base, held``: ranges that may hold the best threshold, and the class counts before each.

    ``held`` are the rows of a range, 0 where it is a single value.
    """

    def judge(table: pa.Table) -> pa.Table:
        problems = shared.value[0]
        slot = table.column("slot")[0].as_py()
        p = problems[slot]
        axis, rng = table.column("axis").to_numpy(), table.column("rng").to_numpy()
        inside = np.stack([table.column(f"c{i}").to_numpy() for i in range(k)], axis=1)
        order = np.lexsort((rng, axis))
        axis, rng, inside, top = axis[order], rng[order], inside[order], table.column("top").to_numpy()[order]
        upto = np.cumsum(inside, axis=0)
        first = np.flatnonzero(np.concatenate(([True], axis[1:] != axis[:-1])))
        size = np.diff(np.append(first, len(axis)))
        upto -= np.repeat(upto[first] - inside[first], size, axis=0)
        before = upto - inside
        ends = np.ones(len(axis), bool)
        ends[first + size - 1] = False  # behind an axis's last range there is nothing to split off
        best = units(gains(upto[ends], p.counts, p.gain)).max(initial=-np.inf)
        keep = units(bounds(before, inside, p.counts, p.gain)) + 1 >= best
        return pa.table(
            [
                pa.array([slot], pa.int32()),
                pa.array([axis[keep]], pa.list_(pa.int32())),
                pa.array([rng[keep]], pa.list_(pa.int32())),
                pa.array([before[keep].ravel()], pa.list_(pa.int64())),
                pa.array([np.where(top < inside.sum(axis=1), inside.sum(axis=1), 0)[keep]], pa.list_(pa.int64())),
            ],
            ["slot", "axis", "rng", "base", "held"],
        )

    return counts.groupBy("slot").applyInArrow(judge, OPEN)


def number(x: float) -> int:
    """The place of a double in the order of doubles."""
    bits = int(np.float64(x + 0.0).view(np.int64))
    return bits if bits >= 0 else -(bits & 0x7FFFFFFFFFFFFFFF)


def double(n: int) -> float:
    return float(np.int64(n).view(np.float64)) if n >= 0 else -float(np.int64(-n).view(np.float64))


def finer(cuts: np.ndarray, ranges: Sequence[int], parts: int) -> np.ndarray:
    """More cuts inside the given ranges, evenly by value; unchanged where a range is one double."""
    more: list[float] = []
    for r in ranges:
        low = cuts[r - 1] if r > 0 else -np.inf
        high = cuts[r] if r < len(cuts) else np.inf
        a, b = number(low), number(high)
        if np.isfinite(high - low):
            # The middle in the order of doubles comes along, so that lopsided values are parted as well.
            more += [*np.linspace(low, high, parts + 1).tolist(), double(a + (b - a) // 2)]
        else:
            more += [double(a + (b - a) * i // parts) for i in range(1, parts)]
    return np.unique(np.concatenate((cuts, more)))


Opened = dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]


def narrowed(rows: DataFrame, problems: Sequence[Problem], trees: Sequence[WalkedTree], classes: np.ndarray, views, most: int) -> Opened:
    """Open ranges of each (slot, axis) with the class counts before them, at most about ``most`` rows in those of an axis.

    Runs a job, more where ranges are too large.
    """
    k, context, before = len(classes), rows.sparkSession.sparkContext, np.inf
    everything = sum(int(p.counts.sum()) * p.axes for p in problems)
    while True:
        uncut = [s for s, p in enumerate(problems) if not any(map(len, p.cuts))]
        found: Opened = {(s, a): (np.zeros(1, int), np.zeros((1, k), int)) for s in uncut for a in range(problems[s].axes)}
        held = {(s, a): np.array([problems[s].counts.sum()]) for s, a in found}
        if len(uncut) < len(problems):
            shared = context.broadcast((problems, trees, classes, views))
            for r in open_ranges(count_ranges(rows, shared, k), shared, k).collect():  # one row per node
                axis, rng, rows_in = np.array(r["axis"]), np.array(r["rng"]), np.array(r["held"])
                base = np.array(r["base"], int).reshape(-1, k)
                for a in np.unique(axis).tolist():
                    at = axis == a
                    found[r["slot"], a], held[r["slot"], a] = (rng[at], base[at]), rows_in[at]
            shared.unpersist()
        # Where much is open in all axes together, they are cut as long as that closes a good part of it: a pass over
        # everything is dearer than to sort a small part.
        total = sum(int(h.sum()) for h in held.values())
        again = total > max(most, OPEN_PART * everything) and total < GOOD_PART * before
        cut = {}
        for at, h in held.items():
            if h.sum() > most or again:
                least = most // len(h) if h.sum() > most else SMALL_RANGE
                cut[at] = found[at][0][h > max(1, least)].tolist()
        before = total
        parts = int(np.clip(PASS_COUNTERS // (4 * (k + 1) * max(1, sum(map(len, cut.values())))), 2, FINER))
        grown = False
        for (s, a), ranges in cut.items():
            cuts = finer(problems[s].cuts[a], ranges, parts)
            grown |= len(cuts) > len(problems[s].cuts[a])
            problems[s].cuts[a] = cuts
        if not grown:
            return found


def exact_splits(rows: DataFrame, problems: Sequence[Problem], trees: Sequence[WalkedTree], classes: np.ndarray, views, opened: Opened) -> dict[int, Split]:
    """The best threshold of each node, from the single values of its open ranges.  Runs a job."""
    k, context = len(classes), rows.sparkSession.sparkContext
    shared = context.broadcast((problems, trees, classes, views, opened))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        problems, trees, classes, views, opened = shared.value
        finders, wins = {}, {}
        for slot, a in opened:
            cuts = problems[slot].cuts[a]
            finders[slot, a], wins[slot, a] = Finder(cuts), np.zeros(len(cuts) + 1, bool)
            wins[slot, a][opened[slot, a][0]] = True
        for block in blocks(batches, classes, views):
            for tree in trees:
                out: list[list[np.ndarray]] = [[] for _ in range(4 + k)]
                for slot, x, labels, weights in block.at_nodes(tree):
                    p = problems[slot]
                    wanted = [a for a in range(p.axes) if (slot, a) in opened]
                    values = p.values(x) if wanted else None
                    for a in wanted:
                        v = values[a] + 0.0
                        at = np.flatnonzero(wins[slot, a][finders[slot, a](v)]) if len(p.cuts[a]) else slice(None)
                        distinct, code = np.unique(v[at], return_inverse=True)
                        counts = np.bincount(code * k + labels[at], weights[at], len(distinct) * k).reshape(-1, k)
                        n = len(distinct)
                        ranges = np.searchsorted(p.cuts[a], distinct, "left")
                        for held, c in zip(out, (np.full(n, slot), np.full(n, a), ranges, distinct, *counts.T)):
                            held.append(c)
                if out[0]:
                    kinds = [pa.int32()] * 3 + [pa.float64()] + [pa.int64()] * k
                    arrays = [pa.array(np.concatenate(c).astype(t.to_pandas_dtype())) for c, t in zip(out, kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, ["slot", "axis", "rng", "value", *[f"c{i}" for i in range(k)]])

    def choose(table: pa.Table) -> pa.Table:
        problems, opened = shared.value[0], shared.value[4]
        slot, axis = table.column("slot")[0].as_py(), table.column("axis")[0].as_py()
        p, (ranges, base) = problems[slot], opened[slot, axis]
        value, code = np.unique(table.column("value").to_numpy(), return_inverse=True)
        counts = np.stack(
            [np.bincount(code, table.column(f"c{i}").to_numpy(), len(value)) for i in range(k)], axis=1
        ).astype(np.int64)
        rng = np.searchsorted(p.cuts[axis], value, "left")
        run = np.cumsum(counts, axis=0)
        first = np.flatnonzero(np.concatenate(([True], rng[1:] != rng[:-1])))
        size = np.diff(np.append(first, len(rng)))
        start = base[np.searchsorted(ranges, rng[first])]
        left = run + np.repeat(start - run[first] + counts[first], size, axis=0)
        # The next value follows at once inside a range, and behind it where no other range lies between.
        follows = (left[:-1] == left[1:] - counts[1:]).all(axis=1)
        at = np.flatnonzero(follows)
        gain = gains(left[at], p.counts, p.gain)
        empty = not len(at)
        b = 0 if empty else int(np.argmax(units(gain)))
        i = 0 if empty else int(at[b])
        th = 0.0 if empty else float(value[i] if p.candidates == "value" else (value[i] + value[i + 1]) / 2.0)
        row = [] if empty else [(slot, axis, float(units(gain[b])), th, float(gain[b]), left[i].tolist())]
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.int64()))
        columns = list(zip(*row)) if row else [()] * 6
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, kinds)], ["slot", "axis", "units", "th", "gain", "left"])

    fields = ", ".join(f"c{i} long" for i in range(k))
    values = scanned(rows).mapInArrow(emit, f"{COUNTS}, value double, {fields}")
    best = values.groupBy("slot", "axis").applyInArrow(
        choose, "slot int, axis int, units double, th double, gain double, left array<long>"
    )
    order = F.struct(-F.col("units"), "axis", "th")
    first = best.groupBy("slot").agg(F.min_by(F.struct("axis", "th", "gain", "left"), order).alias("b")).collect()
    shared.unpersist()
    return {r["slot"]: Split(r["b"]["axis"], r["b"]["th"], r["b"]["gain"], list(r["b"]["left"])) for r in first}


def best_splits(rows: DataFrame, problems: Sequence[Problem], walked, classes: np.ndarray, views, sample: Block | None, exact_rows: int | None = None) -> list[Split | None]:
    """The best split of every problem, None where no threshold separates its rows.

    ``rows`` has features, label, bag.  ``walked(numbers)`` gives the trees that lead to the problems of these numbers.
    Greatest gain first, then lowest axis, then lowest threshold.  Runs two jobs for each pass of ``PASS_COUNTERS``.
    """
    out: list[Split | None] = []
    # A node has no more ranges than its share of the sample allows.
    rows_in = np.array([p.counts.sum() for p in problems], dtype=float)
    ranges = np.minimum(RANGES, 1 + 2 * SAMPLE_ROWS / SAMPLED_PER_RANGE * rows_in / max(rows_in.max(initial=1), 1))
    upto = np.cumsum(ranges * [p.axes * (len(classes) + 1) for p in problems])
    while len(out) < len(problems):
        begin = len(out)
        done = upto[begin - 1] if begin else 0
        part = problems[begin : max(begin + 1, int(np.searchsorted(upto, done + PASS_COUNTERS, "right")))]
        trees = walked(range(begin, begin + len(part)))
        sample_cuts(part, trees, sample)
        opened = narrowed(rows, part, trees, classes, views, exact_rows or EXACT_ROWS)
        found = exact_splits(rows, part, trees, classes, views, opened)
        out += [found.get(s) for s in range(len(part))]
    return out


def root_splits(rows: DataFrame, classes: Sequence[int], gain: str, candidates: str, exact_rows: int | None = None) -> tuple[list[Split | None], int]:
    """Best threshold of every feature of ``rows`` (features, label), and their number.

    Each feature is the only axis of a problem of its own.  Rows without a complete vector are left out.
    """
    classes = np.array(sorted(classes))
    rows = rows.filter(complete()).select("features", "label")
    drawn = packed(rows, classes)
    counted = rows.groupBy("label").agg(F.count("*").alias("n"), F.max(F.size("features")).alias("width")).collect()
    width = max((r["width"] for r in counted), default=0)
    per_class = {r["label"]: r["n"] for r in counted}  # one row per class
    counts = np.array([per_class.get(c, 0) for c in classes.tolist()], dtype=np.int64)
    sample = sampled(drawn, int(counts.sum()), SAMPLE_ROWS, classes, ())
    problems = [Problem(f, 1, counts, gain, candidates, [f]) for f in range(width)]
    walked = lambda numbers: [WalkedTree(0, None, [], {1: i}) for i, _ in enumerate(numbers)]
    found = best_splits(drawn, problems, walked, classes, (), sample, exact_rows)
    discard(drawn)
    return found, int(counts.sum())
