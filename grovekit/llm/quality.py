"""Quality rules (9): counts per document, and an isolation forest over them.

An isolation tree splits a small sample at random features and values; rows that end in short paths are unusual.  The
forest is fitted on a bounded sample of the rows labelled good (``max_fit_rows``); every document is scored.  The
threshold on the scores is taken from the scores of all labelled rows: it maximises the share of bad rows above it less
``good_weight`` times the share of good rows above it.

Defined cases: a null or empty text has zero words and fails the base rule.  Rows are judged one by one, so that null
or repeated ids, repeated rows and other columns change nothing.  Without labelled rows of
either kind no document is judged by the forest; only the base rule speaks.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovekit.llm.common import keyed, rows_by_key, written

SYMBOLS = re.compile(r"[#*$%&|<>]")
FEATURES = ("word_length", "root_symbol_share", "dup_line_share", "repeat_share")
STATS = "doc_id long, f long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
SCHEMA = STATS + ", features array<double>"


@dataclass(frozen=True)
class ForestParams:
    """``max_fit_rows`` bounds the labelled rows the trees are drawn from; ``sample`` is the rows of one tree."""

    trees: int = 100
    sample: int = 256
    max_fit_rows: int = 20_000
    good_weight: float = 5.0
    bins: int = 10_000
    seed: int = 9


def repeated_words(ids: np.ndarray, k: int = 3) -> int:
    """Words in windows of ``k`` words that are found twice or more in the text."""
    n = len(ids) - k + 1
    if n < 2:
        return 0
    base = int(ids.max()) + 1
    key = ids[:n].astype(object if base**k >= 2**63 else np.int64)
    for i in range(1, k):
        key = key * base + ids[i : n + i]
    _, place, times = np.unique(key, return_inverse=True, return_counts=True)
    twice = times[place] > 1
    mask = np.zeros(len(ids), bool)
    for i in range(k):
        mask[i : n + i] |= twice
    return int(mask.sum())


def measure(text: str) -> tuple[list[int], list[float]]:
    """The five counts of one text, and the shares that the forest sees."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    lines = [x for x in text.split("\n") if x.encode().split()]
    dup = len(lines) - len(set(lines))
    chars = len(text) - sum(text.count(c) for c in " \t\n\r\x0b\x0c")
    symbols = len(SYMBOLS.findall(text))
    repeat = repeated_words(ids)
    shares = [
        min(chars / max(n, 1), 40.0),
        math.sqrt(symbols / max(chars, 1)),
        dup / max(len(lines), 1),
        repeat / max(n, 1),
    ]
    return [n, chars, symbols, dup, repeat], shares


def rule_stats(docs: DataFrame) -> DataFrame:
    """``doc_id, f, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, features`` of every row."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = [measure(t) for t in part.column(2).to_pylist()]
            counts = np.array([x[0] for x in found], np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    *[pa.array(counts[:, i]) for i in range(5)],
                    pa.array([x[1] for x in found], pa.list_(pa.float64())),
                ],
                ["doc_id", "f", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "features"],
            )

    return keyed(docs).mapInArrow(count, SCHEMA)


def base_rule() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


# isolation forest -------------------------------------------------------------------


def usual_path(n: int) -> float:
    """Mean path length of a search that fails in a binary search tree of ``n`` rows."""
    if n < 2:
        return 0.0
    return 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else 1.0


def grow(rows: np.ndarray, box: np.ndarray, rng: np.random.Generator, deepest: int) -> list[tuple]:
    """One tree as nodes (feature, threshold, left, right, path length at a leaf).

    Cuts are drawn in the node's box, which starts as the range of all labelled rows.  A box reaches beyond the good
    rows in it, so that a share that no good row has can be cut off although it does not vary among them.
    """
    nodes: list = []

    def build(part: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> int:
        at = len(nodes)
        varied = np.flatnonzero(high - low > 0)
        if depth >= deepest or len(part) < 2 or not len(varied):
            nodes.append((-1, 0.0, at, at, depth + usual_path(len(part))))
            return at
        nodes.append(None)
        axis = int(rng.choice(varied))
        cut = float(rng.uniform(low[axis], high[axis]))
        left, below, above = part[:, axis] < cut, high.copy(), low.copy()
        below[axis] = above[axis] = cut
        nodes[at] = (axis, cut, build(part[left], low, below, depth + 1), build(part[~left], above, high, depth + 1), 0.0)
        return at

    build(rows, box[0], box[1], 0)
    return nodes


def fit_forest(sample: np.ndarray, box: np.ndarray, params: ForestParams) -> list[tuple[np.ndarray, ...]]:
    """Trees over random draws of ``sample``; bounded by ``trees`` times ``sample`` rows."""
    rng = np.random.default_rng(params.seed)
    size = min(params.sample, len(sample))
    forest = []
    for _ in range(params.trees if size > 1 else 0):
        drawn = sample[rng.choice(len(sample), size, replace=False)]
        nodes = grow(drawn, box, rng, 2 * max(1, math.ceil(math.log2(size))))
        forest.append(tuple(map(np.array, zip(*nodes))))
    return forest


def anomaly(features: np.ndarray, forest: list, size: int) -> np.ndarray:
    """Scores in (0, 1]: 2 to the power of -(mean path / usual path)."""
    if not forest or not len(features):
        return np.zeros(len(features))
    total, every = np.zeros(len(features)), np.arange(len(features))
    for axis, cut, left, right, length in forest:
        at = np.zeros(len(features), np.int64)
        while True:
            a = axis[at]
            if (a < 0).all():
                break
            at = np.where(a < 0, at, np.where(features[every, a] < cut[at], left[at], right[at]))
        total += length[at]
    return np.exp2(-total / len(forest) / max(usual_path(size), 1e-9))


def score_stats(stats: DataFrame, forest: list, size: int) -> DataFrame:
    """``stats`` with ``anomaly``."""
    names, at = [*stats.columns, "anomaly"], stats.columns.index("features")
    schema = T.StructType([*stats.schema.fields, T.StructField("anomaly", T.DoubleType())])

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = part.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(anomaly(rows, forest, size))], names)

    return stats.mapInArrow(score, schema)


def threshold(scored: DataFrame, params: ForestParams) -> float:
    """The best threshold for ``anomaly, quality`` of all labelled rows; 2 (nothing goes) without rows of either kind.

    Rows are counted in ``bins`` steps of the score: at most twice ``bins`` counts reach the driver.
    """
    step = F.ceil(F.col("anomaly") * params.bins).cast("int")
    counts = np.zeros((params.bins + 1, 2))
    for r in scored.groupBy(step.alias("step"), "quality").count().collect():
        counts[r["step"], int(r["quality"] == 1)] = r["count"]
    bad, good = counts.sum(0)
    if not bad or not good:
        return 2.0
    above = counts[::-1].cumsum(0)[::-1] - counts
    gain = above[:, 0] / bad - params.good_weight * above[:, 1] / good
    best = int(len(gain) - 1 - np.argmax(gain[::-1]))
    return best / params.bins if gain[best] > 0 else 2.0


def judge(docs: DataFrame, labels: DataFrame, params: ForestParams = ForestParams()) -> DataFrame:
    """Every row's counts with ``base_failed``, ``anomaly`` and ``kept``.

    ``labels`` has ``doc_id, quality`` (1 good, 0 not; the higher one where both are given).  Runs jobs: the counts
    are written once; sample, range and threshold are read from them.
    """
    stats = written(rule_stats(docs))
    known = (
        labels.select(F.col("doc_id").cast("long").alias("known_id"), F.col("quality").cast("int").alias("quality"))
        .filter("known_id is not null and quality is not null")
        .groupBy("known_id")
        .agg(F.max("quality").alias("quality"))
    )
    usual = stats.filter(~base_rule()).join(known, F.col("doc_id") == F.col("known_id")).drop("known_id")
    ends = [f(F.get("features", F.lit(i))) for f in (F.min, F.max) for i in range(len(FEATURES))]
    box = np.array(usual.agg(*ends).first(), float).reshape(2, -1)
    drawn = (
        usual.filter("quality = 1")
        .select("features", F.xxhash64("doc_id", F.lit(params.seed)).alias("at"))
        .orderBy("at")
        .limit(params.max_fit_rows)
        .toPandas()
    )
    sample = np.array(drawn["features"].tolist(), float).reshape(-1, len(FEATURES))
    forest, size = fit_forest(sample, box, params), min(params.sample, len(sample))
    limit = threshold(score_stats(usual, forest, size), params)
    failed = base_rule()
    return (
        score_stats(stats, forest, size)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("anomaly") <= limit))
    )


def keep_good(docs: DataFrame, labels: DataFrame, params: ForestParams = ForestParams()) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    return rows_by_key(docs, judge(docs, labels, params).filter("kept"), "left_semi")
