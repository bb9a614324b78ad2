"""Line dedup (7): repeated runs of lines by a suffix array over line ids, built by prefix doubling.

Every line with a word gets an id.  A suffix is a line and all that follow it in its document.  Suffixes are ranked by
their first line, then by their first 2, 4, ... lines: the rank by 2h lines is the rank of the pair (rank at i, rank at
i + h).  Suffixes whose rank nobody shares are settled and leave, so that each round holds only what repeats.  After
the last round, equal ranks are the intervals of the suffix array whose common prefix has ``min_lines`` lines or more.
In each interval the first suffix (lowest id, then place) stays; the lines of later ones are deleted.  Runs longer than
``min_lines`` are the unions of such windows.

With ``long_words``, a long line counts alone, next to the runs: one of that many words (runs of other than ASCII white
space), or of 8 bytes for each of them, since some scripts have no spaces.  All but the first of equal long lines are
deleted, whatever stands around them, also where a document is that one line.  The first copy of a line never lies in a
later copy of a run, so that one copy of everything stays.

Only DataFrame functions: ranks are row ids of range-sorted tables, hot lines are counted before they are shuffled, and
a join on them can be split, since the other side has one row for each rank.

Defined cases: runs are judged on the input.  Lines without a word are neither counted nor deleted and do not
interrupt a run.  A null text is an empty one.  Rows that repeat both id and text are one document, listed more than
once: each listing gets the same result, and they are no copies of each other.  A null id comes before all others.
Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovekit.llm.common import keyed, on_key, written

WORD = r"[^\x20\x09-\x0D]"
LONG_WORDS, WORD_BYTES = 50, 8
SUFFIX = ("doc_id", "f", "j")


def word_lines(docs: DataFrame, long_words: int | None = None) -> DataFrame:
    """``doc_id, f, j, i, a, b``: j-th line with a word, its place i among all lines, its id (a, b).

    With ``long_words`` also ``alone``: whether the line is long.
    """
    alone = []
    if long_words is not None:
        # Words are counted only where the bytes are enough for so many and what parts them.
        size = F.octet_length("at.line")
        many = (size >= 2 * long_words - 1) & (F.regexp_count("at.line", F.lit(WORD + "+")) >= long_words)
        alone = [((size >= WORD_BYTES * long_words) | many).alias("alone")]
    split = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("line")))
    lines = keyed(docs).select("doc_id", "f", F.posexplode(F.filter(split, lambda x: x["line"].rlike(WORD))).alias("j", "at"))
    return lines.select(
        "doc_id",
        "f",
        "j",
        F.col("at.i").alias("i"),
        F.xxhash64("at.line").alias("a"),
        F.xxhash64(F.lit("line"), F.col("at.line")).alias("b"),
        *alone,
    ).dropDuplicates([*SUFFIX])


def shared_ranks(suffixes: DataFrame) -> DataFrame:
    """``doc_id, f, j, rank`` of the suffixes whose (a, b) others share; ranks keep the order of (a, b)."""
    shared = suffixes.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1").select("a", "b")
    ranks = written(
        shared.repartitionByRange("a", "b")
        .sortWithinPartitions("a", "b")
        .select("a", "b", F.monotonically_increasing_id().alias("rank"))
    )
    return written(suffixes.join(ranks, ["a", "b"]).select(*SUFFIX, "rank"))


def repeated_suffixes(lines: DataFrame, min_lines: int) -> DataFrame:
    """``doc_id, f, j, rank``: suffixes whose first ``min_lines`` lines begin elsewhere too, equal ranks for equal lines."""
    ranked, have = shared_ranks(lines.select(*SUFFIX, "a", "b")), 1
    while have < min_lines:
        step = min(have, min_lines - have)
        ahead = ranked.select("doc_id", "f", (F.col("j") - step).alias("j"), F.col("rank").alias("b"))
        pairs = on_key(ranked.withColumnRenamed("rank", "a"), ahead, "inner", *SUFFIX)
        ranked, have = shared_ranks(pairs), have + step
    return ranked


def later_places(ranked: DataFrame, n_lines: int) -> DataFrame:
    """``doc_id, f, j``: places of the first ``n_lines`` lines of all but the first suffix of each rank."""
    first = ranked.groupBy("rank").agg(F.min(F.struct(*SUFFIX)).alias("first"))
    later = ranked.join(first, "rank").filter(~F.struct(*SUFFIX).eqNullSafe(F.col("first")))
    return later.select("doc_id", "f", F.explode(F.sequence(F.col("j"), F.col("j") + (n_lines - 1))).alias("j"))


def later_lines(docs: DataFrame, min_lines: int = 2, long_words: int | None = None) -> DataFrame:
    """``doc_id, f, start, length``: runs of lines to delete, by place among all lines of the document."""
    lines = written(word_lines(docs, long_words))
    places = later_places(repeated_suffixes(lines, min_lines), min_lines)
    if long_words is not None:
        places = places.union(later_places(repeated_suffixes(lines.filter("alone"), 1), 1))
    gone = on_key(lines.select(*SUFFIX, "i"), places.distinct(), "left_semi", *SUFFIX)
    # Neighbouring places fall into one run; a partition of the window is one document.
    gone = gone.withColumn("run", F.expr("i - row_number() over (partition by doc_id, f order by i)"))
    return gone.groupBy("doc_id", "f", "run").agg(F.min("i").alias("start"), F.count("*").alias("length")).drop("run")


def dedup_lines(docs: DataFrame, min_lines: int = 2, long_words: int | None = None) -> DataFrame:
    """``row, doc_id, f, text, n_lines, n_removed, runs``: what is left of every row, and the deleted runs in order.

    ``row`` holds the columns of ``docs``.
    """
    run = F.struct(F.col("start").cast("int").alias("start"), F.col("length").cast("int").alias("length"))
    runs = later_lines(docs, min_lines, long_words).groupBy("doc_id", "f").agg(F.sort_array(F.collect_list(run)).alias("runs"))
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(text).alias("f"),
        text.alias("text"),
    )
    rows = on_key(rows, runs, "left")
    # One flag for each line up to the last deleted one, so that looking a line up costs the same in any text.
    before = lambda k: F.when(k > 0, F.get("runs", k - 1)["start"] + F.get("runs", k - 1)["length"]).otherwise(0)
    flags = F.transform(
        "runs",
        lambda r, k: F.concat(F.array_repeat(F.lit(False), r["start"] - before(k)), F.array_repeat(F.lit(True), r["length"])),
    )
    rows = rows.withColumns({"lines": F.split("text", "\n"), "gone": F.flatten(flags)})
    kept = F.filter("lines", lambda x, i: ~F.coalesce(F.get("gone", i), F.lit(False)))
    return rows.select(
        "row",
        "doc_id",
        "f",
        F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.size(F.filter("lines", lambda x: x.rlike(WORD))).cast("long").alias("n_lines"),
        F.coalesce(F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["length"]), F.lit(0)).alias("n_removed"),
        "runs",
    )


def delete_later_lines(docs: DataFrame, min_lines: int = 2, long_words: int | None = None) -> DataFrame:
    """``docs`` with all their columns, ``text`` without later copies (``n_chars`` follows, where there is one).

    Rows of which no line with a word is left go; rows that had none stay as they are.
    """
    left = dedup_lines(docs, min_lines, long_words).filter("n_removed = 0 or n_removed < n_lines")
    text = F.when(F.col("n_removed") == 0, F.col("row.text")).otherwise(F.col("text"))
    new = {"text": text, "n_chars": F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.length("text"))} if "n_chars" in docs.columns else {"text": text}
    types = dict(docs.dtypes)
    return left.select(*[new[c].cast(types[c]).alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns])
