"""Source divergence audit (13): how far the word use of every source is from the others of its language.

The work is a cube of (sources, sources, terms), cut in blocks along all three axes.  A task owns one cell: it gets the
slice of a block of sources over a block of terms and the slice of another block of sources over the same terms, and
adds up, for each pair of its sources, the divergences of those terms.  Slices are replicated to the cells that read
them, cells never hold more than two blocks, and partial sums are added along the term axis by a group sum.

Counts are sparse.  A term that neither source of a pair has gives the same divergence for all such terms; a cell
therefore adds only what its terms differ from that, and the base cells (no terms) add it once for all kept terms.

All arithmetic is exact: shares are quotients of decimals, divergences and sums are longs, terms are known by ids
that are given to the kept terms once.

Defined cases: null text, language or source is an empty one.  Repeated rows are documents of their own.  A source
without terms is listed, with shares from no counts; in a language without kept terms all divergences are 0 and there
are no term rows.  Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grovekit.llm.common import written

SCALE = 1_000_000_000
#: Sources and terms along the edges of a cell; they bound the memory of a task, not results.
SOURCES, TERMS = 32, 4096
#: Counted pairs of source and term that a task holds before it hands them on.
HELD = 200_000
#: ASCII other than letters parts terms; of letters, only A to Z are lower-cased.
LETTERS = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i > 127 else 32 for i in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: how often each term stands in a source, and in how many of its documents."""
    rows = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed() -> Iterator[pa.RecordBatch]:
            for (lang, source), seen in often.items():
                terms, within = list(seen), within_docs[lang, source]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(terms), pa.string()),
                        pa.array([source] * len(terms), pa.string()),
                        pa.array(terms, pa.binary()).cast(pa.string()),
                        pa.array(list(seen.values()), pa.int64()),
                        pa.array([within[t] for t in terms], pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )

        often, within_docs, held = defaultdict(Counter), defaultdict(Counter), 0
        for batch in batches:
            for lang, source, text in zip(*[c.to_pylist() for c in batch.columns]):
                terms = text.encode().translate(LETTERS).split()
                seen = often[lang, source]
                held -= len(seen)
                seen.update(terms)
                held += len(seen)
                within_docs[lang, source].update(set(terms))
                if held > HELD:
                    yield from handed()
                    often, within_docs, held = defaultdict(Counter), defaultdict(Counter), 0
        yield from handed()

    counted = rows.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, of: str, kept: str) -> Column:
    """``1 + floor(SCALE * (n + 2) / (of + 2 * kept))``, exact; null without kept terms."""
    above = f"cast({SCALE} as decimal(10,0)) * cast({n} + 2 as decimal(20,0))"
    return F.expr(f"1 + ({above}) div nullif(cast({of} + 2 * {kept} as decimal(20,0)), 0)")


def divergence(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


class Shares:
    """Shares of kept terms: tables ``kept``, ``groups`` and ``cells`` that both parts of the audit read."""

    def __init__(self, docs: DataFrame, least_docs: int):
        counts = written(term_counts(docs))
        kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("in_lang"))
        kept = kept.filter(F.col("docs") >= least_docs)
        #: ``lang, term, in_lang, tid``
        self.kept = written(kept.select("lang", "term", "in_lang", F.monotonically_increasing_id().alias("tid")))
        found = counts.select("lang", "source", "term", "n").join(self.kept, ["lang", "term"])
        langs = self.kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("in_lang").alias("lang_size"))
        names = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
        sizes = found.groupBy("lang", "source").agg(F.sum("n").alias("size"))
        groups = names.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)
        several = names.groupBy("lang").agg(F.ceil(F.count("*") / SOURCES).cast("int").alias("blocks"))
        groups = groups.join(several, "lang").withColumns(
            {
                "absent": share("0", "size", "kept"),
                "block": F.pmod(F.xxhash64("source"), "blocks").cast("int"),
                "slabs": F.ceil(F.col("kept") / TERMS).cast("int"),
            }
        )
        #: ``lang, source, size, kept, lang_size, blocks, absent, block, slabs``: all sources, also those without terms.
        self.groups = written(groups)
        #: ``lang, source, term, tid, n, p, q`` and what places the row in a cell; ``q`` is the share in the language.
        self.shares = found.join(self.groups, ["lang", "source"]).withColumns(
            {"p": share("n", "size", "kept"), "q": share("in_lang", "lang_size", "kept")}
        )


def top_terms(shares: DataFrame, top: int) -> DataFrame:
    """Terms with a larger share in the source than in its language, the ``top`` of them by divergence."""
    above = shares.filter("p > q").selectExpr("lang", "source", "term AS item", f"{divergence('p', 'q')} AS value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return above.withColumn("rank", rank).filter(F.col("rank") <= top)


def cell_slices(tables: Shares) -> DataFrame:
    """``lang, a, b, slab, block, source, absent, kept, tids, ps``: slices, replicated to the cells that read them."""
    place = ["lang", "source", "absent", "kept", "block", "blocks"]
    slab = F.pmod(F.xxhash64("term"), "slabs").cast("int").alias("slab")
    rows = tables.shares.select(*place, slab, F.struct("tid", "p").alias("at"))
    rows = rows.groupBy(*place, "slab").agg(F.collect_list("at").alias("at"))
    rows = rows.select(*place, "slab", F.col("at.tid").alias("tids"), F.col("at.p").alias("ps"))
    none = F.array().cast("array<long>")
    base = tables.groups.select(*place, F.lit(-1).alias("slab"), none.alias("tids"), none.alias("ps"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return rows.union(base).select("*", other).select(
        "lang",
        F.least("block", "other").alias("a"),
        F.greatest("block", "other").alias("b"),
        *["slab", "block", "source", "absent", "kept", "tids", "ps"],
    )


CELL = pa.schema([("lang", pa.string()), ("one", pa.string()), ("two", pa.string()), ("value", pa.int64())])


def cell_sums(cell: pa.Table) -> pa.Table:
    """``lang, one, two, value`` for each pair of sources in one cell: the divergences of its terms, or the base."""
    lang, a, b, slab = (cell.column(c)[0].as_py() for c in ("lang", "a", "b", "slab"))
    column = lambda c: cell.column(c).combine_chunks()
    sources, blocks = np.array(column("source").to_pylist(), object), column("block").to_numpy()
    absent = column("absent").fill_null(1).to_numpy()
    kept = cell.column("kept")[0].as_py()
    sizes = np.diff(column("tids").offsets.to_numpy())
    tids, at = np.unique(column("tids").flatten().to_numpy(), return_inverse=True)
    shares = np.repeat(absent[:, None], len(tids), axis=1)
    shares[np.repeat(np.arange(len(sizes)), sizes), at] = column("ps").flatten().to_numpy()
    left, right = np.flatnonzero(blocks == a), np.flatnonzero(blocks == b)
    one, two, value = [], [], []
    for i in left:
        others = right[right > i] if a == b else right
        far = absent[others] - absent[i]
        plain = far * far // (absent[others] + absent[i])
        if slab < 0:
            sums = plain * kept
        else:
            gap = shares[others] - shares[i]
            sums = (gap * gap // (shares[others] + shares[i])).sum(axis=1) - plain * len(tids)
        one.append(np.full(len(others), i))
        two.append(others)
        value.append(sums)
    one, two, value = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (one, two, value))
    return pa.table([pa.array([lang] * len(one)), sources[one].tolist(), sources[two].tolist(), value], schema=CELL)


def pair_sums(tables: Shares) -> DataFrame:
    """Divergence of each source from every other one of its language, ranked."""
    cells = cell_slices(tables).groupBy("lang", "a", "b", "slab")
    partial = cells.applyInArrow(cell_sums, "lang string, one string, two string, value long")
    both = F.array(
        F.struct(F.col("one").alias("source"), F.col("two").alias("item")),
        F.struct(F.col("two").alias("source"), F.col("one").alias("item")),
    )
    ends = F.least("one", "two").alias("one"), F.greatest("one", "two").alias("two")
    sums = partial.groupBy("lang", *ends).agg(F.sum("value").alias("value"))
    pairs = sums.select("lang", F.explode(both).alias("way"), "value").select("lang", "way.*", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank)


def audit_sources(docs: DataFrame, least_docs: int = 10, top: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` has the other sources, part ``term`` the top terms.

    A language keeps the terms of at least ``least_docs`` of its documents.  A share is ``1 + floor(10^9 (n + 2) /
    (N + 2 V))`` with N occurrences of V kept terms; the divergence of shares p and q is ``floor((p - q)^2 / (p + q))``.
    """
    tables = Shares(docs, least_docs)
    parts = {"pair": pair_sums(tables), "term": top_terms(tables.shares, top)}
    pair, term = (df.select("lang", "source", F.lit(k).alias("part"), "item", "value", "rank") for k, df in parts.items())
    return pair.union(term)
