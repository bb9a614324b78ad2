"""Toxicity (8): a linear-chain conditional random field tags toxic words; marginals add up to document scores.

Only whole documents are labelled, so the words to learn from are labelled first: a word is toxic if it, or one of its
beginnings, is found in labelled toxic documents far more often than chance allows (likelihood ratio) and hardly in others.
A field with two states is then fitted on sentences: a word's features are itself, its beginnings and ending, and both
neighbours, all hashed; transitions are learned too.  Forward-backward gives each word's marginal; a logistic curve of the
strongest marginal and of their sum, fitted on the labelled documents, gives the document's score.

Everything is fitted on at most ``max_fit_docs`` labelled documents (lowest hashes of their ids), of which at most
``max_fit_words`` words go into the field.  All documents are scored, over their whole texts.

Defined cases: a null or empty text has no words and gets the curve's lowest score.  Rows are scored one by one, so that
null or repeated ids, repeated rows and other columns change nothing.  Without labelled documents of both kinds every
score is 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.llm.common import distinct_words, rows_of, slices, written

EDGES = b"\"'()[]{}<>.,;:!?-*_`|"
ENDS = (b".", b"!", b"?")
BITS = 18


@dataclass(frozen=True)
class CrfParams:
    """``calm_share``: of sentences without a toxic word, one in so many enters the fit of the field."""

    max_fit_docs: int = 12_000
    max_fit_words: int = 300_000
    calm_share: int = 8
    least_precision: float = 0.9
    epochs: int = 6
    rate: float = 0.5
    decay: float = 1e-5
    seed: int = 8


@dataclass
class Model:
    """Hashed weights, the transition weights [from, to], and the curve (intercept, strongest, sum)."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: np.ndarray | None = None


def plain(word: bytes) -> bytes:
    return (word.lower() if word.isascii() else word.decode().lower().encode()).strip(EDGES)


def parts_of(word: bytes) -> list[bytes]:
    """The word and its beginnings, as what evidence is counted for."""
    text = word.decode()
    return [b"w" + word, *(b"p" + text[:n].encode() for n in (4, 5) if len(text) >= n)]


def names(word: bytes) -> list[bytes]:
    """Features of a word: 5 of its own, one as a left neighbour, one as a right one."""
    if word.isascii():  # the bytes are the characters
        begins, end = (word[:3], word[:4], word[:5]), word[-3:]
    else:
        text = word.decode()
        begins, end = [text[:n].encode() for n in (3, 4, 5)], text[-3:].encode()
    return [b"w" + word, b"p" + begins[0], b"p" + begins[1], b"p" + begins[2], b"s" + end, b"<" + word, b">" + word]


def slots(words: list[bytes]) -> np.ndarray:
    """Feature slots of words, seven for each."""
    import xxhash

    hashed = map(xxhash.xxh3_64_intdigest, chain.from_iterable(map(names, words)))
    found = np.fromiter(hashed, np.uint64, 7 * len(words))
    return (found & np.uint64((1 << BITS) - 1)).astype(np.int64).reshape(-1, 7)


# inference --------------------------------------------------------------------------


def marginals(score: np.ndarray, sizes: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the toxic state for sentences one after another, and the expected transitions.

    ``score`` is how much each word speaks for the toxic state; all sentences advance side by side.
    """
    n = len(score)
    if not n:
        return np.empty(0), np.zeros((2, 2))
    t = np.exp(transitions)
    e = np.exp(np.clip(score, -30, 30))
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    steps = int(sizes[0])
    active = np.searchsorted(-sizes, -np.arange(1, steps + 1), side="right")
    a = np.empty((n, 2))  # filtered probabilities
    b = np.ones((n, 2))  # scaled evidence behind
    prior = np.full((len(starts), 2), 0.5)
    for k in range(steps):
        m = active[k]
        at = starts[:m] + k
        p0, p1 = (prior[:m, 0], prior[:m, 1]) if k == 0 else (a[at - 1, 0] * t[0, 0] + a[at - 1, 1] * t[1, 0], a[at - 1, 0] * t[0, 1] + a[at - 1, 1] * t[1, 1])
        p1 = p1 * e[at]
        total = p0 + p1
        a[at, 0], a[at, 1] = p0 / total, p1 / total
    for k in range(steps - 2, -1, -1):
        at = starts[: active[k + 1]] + k
        x0, x1 = b[at + 1, 0], b[at + 1, 1] * e[at + 1]
        y0, y1 = t[0, 0] * x0 + t[0, 1] * x1, t[1, 0] * x0 + t[1, 1] * x1
        total = y0 + y1
        b[at, 0], b[at, 1] = y0 / total, y1 / total
    both = a * b
    toxic = both[:, 1] / both.sum(1)
    inner = np.ones(n, bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    pairs = a[at - 1][:, :, None] * t[None] * (b[at] * np.stack((np.ones(len(at)), e[at]), 1))[:, None, :]
    return toxic, (pairs / pairs.sum((1, 2), keepdims=True)).sum(0) if len(at) else np.zeros((2, 2))


def sentence_sizes(last: np.ndarray) -> np.ndarray:
    """Sizes of sentences from flags of their last words; the end closes one too."""
    ends = np.flatnonzero(last)
    if len(last) and (not len(ends) or ends[-1] != len(last) - 1):
        ends = np.append(ends, len(last) - 1)
    return np.diff(np.concatenate(([-1], ends)))


def neighbours(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of words that have a left, and a right, neighbour in their sentence."""
    n = int(sizes.sum())
    left, right = np.ones(n, bool), np.ones(n, bool)
    ends = np.cumsum(sizes)
    left[ends - sizes] = False
    right[ends - 1] = False
    return left, right


# fitting ----------------------------------------------------------------------------


def fit_field(table: np.ndarray, words: np.ndarray, toxic: np.ndarray, sizes: np.ndarray, params: CrfParams) -> Model:
    """Fits weights on sentences; ``table`` has the slots of each distinct word, ``words`` its numbers in order."""
    model = Model()
    weights = np.zeros(1 << BITS)
    squares, t_squares = np.full(1 << BITS, 1e-6), np.full((2, 2), 1e-6)
    rng = np.random.default_rng(params.seed)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    batch = max(1, min(512, len(sizes) // 20))
    for _ in range(params.epochs):
        order = rng.permutation(len(sizes))
        for k in range(0, len(order), batch):
            chosen = order[k : k + batch]
            own = sizes[chosen]
            at = np.repeat(starts[chosen] - np.cumsum(own) + own, own) + np.arange(own.sum())
            w, y = words[at], toxic[at]
            left, right = neighbours(own)
            feats = np.concatenate(
                (table[w][:, :5], np.where(left, np.roll(table[w][:, 5], 1), -1)[:, None], np.where(right, np.roll(table[w][:, 6], -1), -1)[:, None]), 1
            )
            used = feats >= 0
            score = np.where(used, weights[feats], 0).sum(1)
            p, expected = marginals(score, own, model.transitions)
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[np.flatnonzero(left) - 1], y[left]), 1)
            gradient = np.bincount(feats[used], np.repeat((p - y) / len(chosen), used.sum(1)), 1 << BITS)
            hit = np.flatnonzero(gradient)
            step = gradient[hit] + params.decay * weights[hit]
            squares[hit] += step**2
            weights[hit] -= params.rate * step / np.sqrt(squares[hit])
            t_step = (expected - seen) / len(chosen) + params.decay * model.transitions
            t_squares += t_step**2
            model.transitions -= params.rate * t_step / np.sqrt(t_squares)
    model.weights = weights.astype(np.float32)
    return model


def fit_curve(strongest: np.ndarray, total: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic curve by damped Newton steps."""
    x = np.stack((np.ones(len(labels)), strongest, np.log1p(total)), 1)
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.02 * np.eye(3) * max(1, len(labels)) / 100
        step = np.linalg.solve(hessian, x.T @ (labels - p) - 0.02 * w * max(1, len(labels)) / 100)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def evidence(sample: DataFrame, params: CrfParams) -> set[bytes]:
    """Words and beginnings that speak for toxic documents; counted over the whole sample by Spark."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, list[bytes]] = {}
        for batch in batches:
            counts: dict[bytes, list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for w in {plain(w) for w in set(text.encode().split())}:
                    for p in memo.get(w) or memo.setdefault(w, parts_of(w)):
                        counts.setdefault(p, [0, 0, 0, -1])
                        c = counts[p]
                        if c[3] != id(text):
                            c[toxic] += 1
                            c[3] = id(text)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(counts), pa.binary()),
                    pa.array([c[1] for c in counts.values()], pa.int64()),
                    pa.array([c[0] for c in counts.values()], pa.int64()),
                ],
                ["part", "t", "n"],
            )

    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return set()
    base = sizes[1] / (sizes[0] + sizes[1])
    counts = sample.select("text", "toxic").mapInArrow(tell, "part binary, t long, n long")
    counts = counts.groupBy("part").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    t, n = F.col("t"), F.col("n")
    ratio = 2 * (t * F.log(t / ((t + n) * base)) + F.when(n > 0, n * F.log(n / ((t + n) * (1 - base)))).otherwise(0))
    counts = written(counts.filter(t >= 2))
    # So many parts are tested that a lucky one must be expected; the ratio has to be beyond what luck gives.
    least = 2 * math.log(max(2, counts.count()))
    strong = (t > params.least_precision * (t + n)) & (ratio >= least)
    # At most as many rows as the bounded sample has words.
    likely = {bytes(r["part"]) for r in counts.filter(strong).select("part").collect()}

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            found = set()
            for text in batch.column(0).to_pylist():
                words = [plain(w) for w in text.encode().split()]
                for i, w in enumerate(words):
                    for p in likely.intersection(parts_of(w)):
                        around = b" ".join((*words[max(0, i - 1) : i], b"*", *words[i + 1 : i + 2]))
                        found.add((p, xxhash.xxh3_64_intdigest(around) - 2**63))
            names = ["part", "around"]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(names, x)) for x in found], schema=pa.schema([("part", pa.binary()), ("around", pa.int64())])
            )

    # Copies of one toxic document repeat its rare words, but always between the same neighbours.
    around = sample.filter("toxic = 1").select("text").mapInArrow(contexts, "part binary, around long").distinct()
    around = around.groupBy("part").agg(F.count("*").alias("varied"))
    varied = counts.filter(strong).join(around, "part").withColumn("t", F.least("t", "varied"))
    return {bytes(r["part"]) for r in varied.filter(strong).select("part").collect()}


def fit_sample(train: DataFrame, max_docs: int, seed: int) -> DataFrame | None:
    """``doc_id, text, toxic`` of ``max_docs`` labelled rows at most, by hashed id, then text; None if there are none."""
    drawn = train.filter("text is not null and toxic is not null").select(
        "doc_id", "text", F.col("toxic").cast("int").alias("toxic"), F.xxhash64("doc_id", F.lit(seed)).alias("at")
    )
    drawn = drawn.withColumn("tie", F.xxhash64("text", "toxic"))
    lowest = drawn.select("at", "tie").orderBy("at", "tie").limit(max_docs + 1).groupBy("at", "tie").agg(F.count("*").alias("n"))
    top, total = lowest.agg(F.max(F.struct("at", "tie", "n")), F.sum("n")).first()
    if total is None:
        return None
    sample = drawn
    if total > max_docs:
        at, tie = F.lit(top["at"]), F.lit(top["tie"])
        sample = drawn.filter((F.col("at") < at) | ((F.col("at") == at) & (F.col("tie") < tie)))
        if top["n"] > 1:  # rows that are equal in all columns: as many of them as there is room for
            sample = sample.union(drawn.filter((F.col("at") == at) & (F.col("tie") == tie)).limit(top["n"] - 1))
    return written(sample.drop("at", "tie"))


def fit(train: DataFrame, params: CrfParams = CrfParams()) -> Model:
    """Model for ``train (doc_id, text, toxic)``; only a bounded sample is read in full."""
    sample = fit_sample(train, params.max_fit_docs, params.seed)
    if sample is None:
        return Model()
    known = evidence(sample, params)
    if not known:
        return Model()

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sentences with a toxic word, and one in ``calm_share`` of the others."""
        memo: dict[bytes, tuple[bytes, bool]] = {}
        for batch in batches:
            out: list[dict] = []
            for text in batch.column(0).to_pylist():
                sentence: list[tuple[bytes, bool]] = []
                words = text.encode().split()
                for i, raw in enumerate(words):
                    if raw not in memo:
                        w = plain(raw)
                        memo[raw] = w, any(p in known for p in parts_of(w))
                    sentence.append(memo[raw])
                    if raw.endswith(ENDS) or i == len(words) - 1:
                        if any(t for _, t in sentence) or hash_of(sentence) % params.calm_share == 0:
                            out.append({"words": [w for w, _ in sentence], "toxic": [int(t) for _, t in sentence]})
                        sentence = []
            schema = pa.schema([("words", pa.list_(pa.binary())), ("toxic", pa.list_(pa.int32()))])
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    sentences = sample.select("text").mapInArrow(pick, "words array<binary>, toxic array<int>")
    numbers: dict[bytes, int] = {}
    words: list[int] = []
    toxic: list[int] = []
    sizes: list[int] = []
    bounded = sentences.select("words", "toxic", F.size("words").alias("n"), F.xxhash64("words").alias("at"))
    bounded = bounded.orderBy("at").limit(params.max_fit_words // 4).select("words", "toxic")
    for own, y in bounded.toLocalIterator():
        if len(words) + len(own) > params.max_fit_words:
            break
        words += [numbers.setdefault(bytes(w), len(numbers)) for w in own]
        toxic += y
        sizes.append(len(own))
    if not sizes:
        return Model()
    table = slots(list(numbers))
    model = fit_field(table, np.array(words), np.array(toxic), np.array(sizes), params)
    model.curve = np.array([0.0, 1.0, 0.0])
    summed = tag(sample, model, ("toxic int",)).select("toxic", "strongest", "total").toPandas()
    model.curve = fit_curve(summed["strongest"].to_numpy(), summed["total"].to_numpy(), summed["toxic"].to_numpy(float))
    return model


def hash_of(sentence: list[tuple[bytes, bool]]) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(b" ".join(w for w, _ in sentence))


# scoring ----------------------------------------------------------------------------


class Tagger:
    """Scores of distinct words, remembered; raw words share those of their plain form."""

    def __init__(self, model: Model, limit: int = 400_000):
        self.model, self.limit = model, limit
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}  # of raw words; twice the row of the plain form, one more behind a sentence
        self.row: dict[bytes, int] = {}  # of plain forms
        self.rows = np.empty((1 << 12, 3))

    def learn(self, raw: list[bytes]) -> None:
        forms = list(map(plain, raw))
        first = len(self.row)
        new = list(set(forms).difference(self.row))
        self.row.update(zip(new, range(first, first + len(new))))
        while len(self.row) > len(self.rows):
            self.rows = np.concatenate((self.rows, np.empty_like(self.rows)))
        found = self.model.weights[slots(new)]
        self.rows[first : first + len(new), 0] = found[:, :5].sum(1)
        self.rows[first : first + len(new), 1:] = found[:, 5:]
        self.number.update((r, 2 * self.row[f] + r.endswith(ENDS)) for r, f in zip(raw, forms))

    def __call__(self, texts: list[str]) -> list[tuple[float, float, list[tuple[int, int]]]]:
        """Strongest marginal, sum of marginals and toxic spans (first word, past the last) of each text."""
        if len(self.number) > self.limit:
            self.forget()
        words, at, lengths = distinct_words(texts)
        self.learn([w for w in words if w not in self.number])
        known = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))[at]
        table = self.rows[known >> 1]
        ends = np.cumsum(lengths)
        last = (known & 1).astype(bool)
        last[ends[lengths > 0] - 1] = True
        sizes = sentence_sizes(last)
        left, right = neighbours(sizes) if len(sizes) else (last, last)
        score = table[:, 0] + np.where(left, np.roll(table[:, 1], 1), 0) + np.where(right, np.roll(table[:, 2], -1), 0)
        p, _ = marginals(score, sizes, self.model.transitions)
        out = []
        hot = np.flatnonzero(p >= 0.5)
        for a, b in zip((ends - lengths).tolist(), ends.tolist()):
            if a == b:
                out.append((0.0, 0.0, []))
                continue
            own = p[a:b]
            spans: list[tuple[int, int]] = []
            for i in (hot[np.searchsorted(hot, a) : np.searchsorted(hot, b)] - a).tolist():
                if spans and spans[-1][1] == i:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((i, i + 1))
            out.append((float(own.max()), float(own[own > 0.01].sum()), spans))
        return out


def tag(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, score, strongest, total, spans`` of every row, and the columns named in ``keep``."""
    kept = [k.split()[0] for k in keep]
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for batch in batches:
            whole = [t or "" for t in batch.column(1).to_pylist()]
            for k in slices(whole):
                texts, part = whole[k], batch.slice(k.start, k.stop - k.start)
                found = tagger(texts) if model.curve is not None else [(0.0, 0.0, [])] * len(texts)
                strongest, total = np.array([x[0] for x in found]), np.array([x[1] for x in found])
                if model.curve is None:
                    scores = np.zeros(len(found))
                else:
                    line = model.curve[0] + model.curve[1] * strongest + model.curve[2] * np.log1p(total)
                    scores = 1 / (1 + np.exp(-np.clip(line, -30, 30)))
                spans = [[{"start": a, "end": b} for a, b in x[2]] for x in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores), pa.array(strongest), pa.array(total), pa.array(spans, span), *part.columns[2:]],
                    ["doc_id", "score", "strongest", "total", "spans", *kept],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *kept)
    schema = "doc_id long, score double, strongest double, total double, spans array<struct<start:int,end:int>>"
    return rows.mapInArrow(score, ", ".join((schema, *keep)))


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def labelled(docs: DataFrame, known: DataFrame, params: CrfParams) -> DataFrame:
    """``doc_id, text, toxic`` of the labelled documents that the fit may draw; ``known`` has known_id, toxic.

    They are drawn by ids alone.  Only ids up to the last one that a sample of ``max_fit_docs`` can hold are kept, so that
    what is sent to the texts is bounded by it and no text is shuffled.
    """
    at = F.xxhash64("doc_id", F.lit(params.seed))
    ids = rows_of(docs).select("doc_id").join(known, F.col("doc_id") == F.col("known_id")).select("doc_id", "toxic", at.alias("at"))
    last = ids.select("at").orderBy("at").limit(params.max_fit_docs + 1).agg(F.max("at")).first()[0]
    drawn = ids.filter(F.col("at") <= F.lit(last)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = written(drawn.withColumnRenamed("doc_id", "known_id"))
    rows = rows_of(docs).filter(at <= F.lit(last))
    return rows.join(F.broadcast(drawn), F.col("doc_id") == F.col("known_id")).drop("known_id")


def score_documents(docs: DataFrame, labels: DataFrame, params: CrfParams = CrfParams()) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans``; learns from the labels of rows that are not held out.

    ``labels`` has ``doc_id, toxic``; a document with several labels counts as toxic if one says so.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("known_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("known_id is not null and toxic is not null").filter(~held_out("known_id"))
    known = known.groupBy("known_id").agg(F.max("toxic").alias("toxic"))
    scored = tag(rows_of(docs), fit(labelled(docs, known, params), params))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "spans",
    )
