"""Scoring of question/answer predictions, baselines, votes and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovekit.functions.answers import COUNT, OUTPUT, question_kind, with_clean_answer
from grovekit.functions.labels import submission_name
from grovekit.operators.ranking import last_per_key

KINDS = (COUNT, OUTPUT)
ORDER = ("batch_id", "seq")
# Distinct answers of all kinds that may be broadcast: short strings, a few MB.
BROADCAST_ROWS = 100_000


def latest(
    predictions: DataFrame, keys: Sequence[str] = ("index",), columns: Sequence[str] | None = None
) -> DataFrame:
    """The last record per key, by the explicit ``batch_id, seq`` of the run table.

    Name the ``columns`` you need: whatever a record holds is sorted and shuffled with it.  Those that
    ``predictions`` lacks are left out.
    """
    order = [c for c in ORDER if c in predictions.columns]
    if columns is not None:
        wanted = list(dict.fromkeys([*keys, *columns]))
        held = [c for c in dict.fromkeys([*wanted, *order]) if c in predictions.columns]
        narrow = predictions.select(*held)
        last = last_per_key(narrow, list(keys), order) if order else narrow
        return last.select(*[c for c in wanted if c in held])
    return last_per_key(predictions, list(keys), order) if order else predictions


def with_kind(items: DataFrame, strict: bool = True) -> DataFrame:
    return items.withColumn("kind", question_kind(F.col("question"), strict))


def majority_by_kind(train: DataFrame, position: str = "index") -> DataFrame:
    """``kind, majority``: most frequent answer, ties to the one seen first.

    ``train`` has kind and answer; ``position`` is its order.
    """
    counts = train.groupBy("kind", "answer").agg(
        F.count(F.lit(1)).alias("n"), F.min(position).alias("first")
    )
    return counts.groupBy("kind").agg(
        F.min_by("answer", F.struct(-F.col("n"), F.col("first"))).alias("majority")
    )


def answer_support(train: DataFrame) -> DataFrame:
    """Distinct answers per kind."""
    return train.select("kind", "answer").distinct()


def with_majority(df: DataFrame, majority: DataFrame) -> DataFrame:
    """Adds ``majority`` by kind (a table of one row per question kind)."""
    return df.join(F.broadcast(majority), "kind", "left")


def clamp(predictions: DataFrame, support: DataFrame, majority: DataFrame) -> DataFrame:
    """Answers never seen for their kind, and missing ones, become the majority.

    Adds ``original``.  ``predictions`` has kind and answer.  Runs a job: a support of up to ``BROADCAST_ROWS``
    different answers is sent to the predictions, which then need no shuffle by their few hot answers; a larger one is
    joined, and no longer concentrated on a few keys.
    """
    seen = support.select("kind", "answer", F.lit(True).alias("_seen")).distinct()
    small = seen.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    seen = F.broadcast(seen) if small else seen
    joined = with_majority(predictions.join(seen, ["kind", "answer"], "left"), majority)
    return (
        joined.withColumn("original", F.col("answer"))
        .withColumn("answer", F.when(F.col("_seen"), F.col("answer")).otherwise(F.col("majority")))
        .drop("_seen", "majority")
    )


def changed_count(df: DataFrame, before: str, after: str) -> Column:
    return F.sum((~F.col(before).eqNullSafe(F.col(after))).cast("bigint"))


def _percent(hits: Column, n: Column) -> Column:
    return F.when(n > 0, 100.0 * hits / F.nullif(n, F.lit(0))).otherwise(F.lit(0.0))


def score(predictions: DataFrame, references: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact-match score per kind and in total (``kind`` NULL), per run of ``by``.

    ``references`` has index, kind, answer.  Missing predictions are counted
    but do not enter the denominator; the average time covers timed rows only.
    The join is reduced to one row per (run, kind) before anything else.
    """
    by = list(by)
    preds = latest(predictions, [*by, "index"], ["answer", "elapsed_s"])
    has_time = "elapsed_s" in preds.columns
    preds = preds.select(
        *by,
        "index",
        F.coalesce(F.col("answer").cast("string"), F.lit("None")).alias("_got"),
        (F.col("elapsed_s") if has_time else F.lit(None)).cast("double").alias("_s"),
    )
    refs = references.select(
        "index", "kind", F.coalesce(F.col("answer").cast("string"), F.lit("None")).alias("_want")
    )
    matched = (
        preds.join(refs, "index")
        .groupBy(*by, "kind")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum((F.col("_got") == F.col("_want")).cast("bigint")).alias("correct"),
            F.sum("_s").alias("_s"),
            F.count("_s").alias("_timed"),
        )
    )
    expected = refs.groupBy("kind").agg(F.count(F.lit(1)).alias("_expected"))
    if by:
        runs = preds.select(*by).distinct().withColumn(
            "kind", F.explode(F.array(*[F.lit(k) for k in KINDS]))
        )
        expected = runs.join(expected, "kind")
    table = expected.join(matched, [*by, "kind"], "left").select(
        *by,
        "kind",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "correct", "_timed")],
        "_s",
        (F.col("_expected") - F.coalesce("n", F.lit(0))).alias("missing"),
    )
    sums = [F.sum(c).alias(c) for c in ("n", "correct", "_s", "_timed", "missing")]
    rolled = table.rollup(*by, "kind").agg(F.grouping_id().alias("_level"), *sums)
    return rolled.filter(F.col("_level") <= 1).select(
        *by,
        "kind",
        "n",
        "correct",
        _percent(F.col("correct"), F.col("n")).alias("accuracy"),
        F.try_divide("_s", "_timed").alias("avg_s"),
        "missing",
    )


def half_width(scores: DataFrame) -> DataFrame:
    """Adds the 95 % half-width of the accuracy, in points."""
    p = F.col("accuracy") / 100.0
    return scores.withColumn(
        "half_width", 100.0 * 1.96 * F.sqrt(F.try_divide(p * (1 - p), F.col("n")))
    )


def score_lines(scores: DataFrame) -> DataFrame:
    """Adds ``line``: the printed form of each score row."""
    name = F.coalesce(F.col("kind"), F.lit("TOTAL"))
    timed = F.when(F.col("avg_s") != 0, F.format_string("  %.2fs/item", F.bround("avg_s", 2))).otherwise(F.lit(""))
    head = F.format_string(
        "  %-7s %6.2f%%  (%d/%d)", name, F.bround("accuracy", 2), F.col("correct"), F.col("n")
    )
    return scores.withColumn("line", F.concat(head, F.coalesce(timed, F.lit(""))))


def reparse(predictions: DataFrame, references: DataFrame, majority: DataFrame) -> DataFrame:
    """Parse the stored generations again; records without one stay as they are.

    The question comes from the references, else from the record itself.
    """
    questions = references.select("index", F.col("question").alias("_asked"))
    joined = predictions.join(questions, "index", "left").withColumn(
        "_q", F.coalesce("_asked", "question")
    )
    kinds = joined.withColumn("kind", question_kind(F.col("_q"), strict=False))
    parsed = with_clean_answer(
        with_majority(kinds, majority), "raw", F.col("kind"), F.col("_q"), F.col("majority"), "_new"
    )
    return parsed.withColumn(
        "answer", F.when(F.col("raw").isNull(), F.col("answer")).otherwise(F.col("_new"))
    ).select(*predictions.columns)


def before_after(
    before: DataFrame, after: DataFrame, references: DataFrame
) -> DataFrame:
    """``accuracy_before, accuracy_after, changed`` of a correction step."""
    joined = (
        references.select("index", F.col("answer").alias("_want"))
        .join(before.select("index", F.col("answer").alias("_b")), "index")
        .join(after.select("index", F.col("answer").alias("_a")), "index")
    )
    want = F.coalesce("_want", F.lit("None"))

    def accuracy(c: str) -> Column:
        hits = F.sum((F.coalesce(c, F.lit("None")) == want).cast("bigint"))
        return _percent(hits, F.count(F.lit(1)))

    return joined.agg(
        accuracy("_b").alias("accuracy_before"),
        accuracy("_a").alias("accuracy_after"),
        F.coalesce(changed_count(joined, "_b", "_a"), F.lit(0)).alias("changed"),
    )


def sample_vote(votes: DataFrame, keys: Sequence[str], vote: str = "vote", sample: str = "sample") -> DataFrame:
    """``keys…, answer, agreement``: most common vote, ties to the first produced.

    NULL votes (unparsed) do not count; keys without any vote are absent.
    """
    counts = (
        votes.filter(F.col(vote).isNotNull())
        .groupBy(*keys, vote)
        .agg(F.count(F.lit(1)).alias("n"), F.min(sample).alias("first"))
    )
    return counts.groupBy(*keys).agg(
        F.min_by(vote, F.struct(-F.col("n"), F.col("first"))).alias("answer"),
        F.max("n").cast("int").alias("agreement"),
    )


def token_totals(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``items, tokens, tokens_per_item``; a missing count is 0."""
    tokens = F.sum(F.coalesce(F.col("new_tokens"), F.lit(0)).cast("bigint"))
    return (
        predictions.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("items"), F.coalesce(tokens, F.lit(0)).alias("tokens"))
        .withColumn("tokens_per_item", F.try_divide(F.col("tokens").cast("double"), F.col("items")))
    )


def split_profile(items: DataFrame) -> DataFrame:
    """``split, n, count, output``: rows per split and kind."""
    per_kind = [
        F.sum((F.col("kind") == k).cast("bigint")).alias(k) for k in KINDS
    ]
    return items.groupBy("split").agg(F.count(F.lit(1)).alias("n"), *per_kind)


class MixedBackendError(RuntimeError):
    """A checkpoint holds records of another backend than the current one."""


def other_backends(done: DataFrame, current: str) -> DataFrame:
    """Backends of finished records that differ from the current; absent ones do not."""
    return done.filter(F.col("backend").isNotNull() & (F.col("backend") != current)).select("backend").distinct()


def check_backend(done: DataFrame, current: str | None, allow_mixed: bool = False) -> None:
    if current is None or allow_mixed:
        return
    others = [r["backend"] for r in other_backends(done, current).limit(20).collect()]
    if others:
        raise MixedBackendError(f"checkpoint has records of {sorted(others)}, current is {current!r}")


def completeness(expected: DataFrame, got: DataFrame, key: str = "index") -> DataFrame:
    """``key, status``: ``missing`` from ``got``, or ``extra`` in it."""
    missing = expected.select(key).join(got.select(key), key, "left_anti")
    extra = got.select(key).distinct().join(expected.select(key), key, "left_anti")
    return missing.select(key, F.lit("missing").alias("status")).unionByName(
        extra.select(key, F.lit("extra").alias("status"))
    )


def compare_experiments(predictions: DataFrame, references: DataFrame, by=("experiment", "split")) -> DataFrame:
    """One row per experiment: n, accuracies, seconds and tokens per item."""
    by = list(by)
    scores = score(predictions, references, by)

    def pick(c: str, kind: str | None) -> Column:
        wanted = F.col("kind").isNull() if kind is None else F.col("kind") == kind
        return F.max(F.when(wanted, F.col(c)))

    wide = scores.groupBy(*by).agg(
        pick("n", None).alias("n"),
        pick("accuracy", None).alias("accuracy"),
        *[pick("accuracy", k).alias(f"accuracy_{k}") for k in KINDS],
        pick("avg_s", None).alias("s_per_item"),
    )
    tokens = token_totals(latest(predictions, [*by, "index"], ["new_tokens"]), by)
    return wide.join(tokens.select(*by, "tokens_per_item"), by, "left")


def submission_report(
    predictions: DataFrame,
    expected: DataFrame,
    support: DataFrame,
    majority: DataFrame,
    do_clamp: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Status per experiment, and the rows of all submissions.

    ``expected`` has index and kind.  A run that misses items is
    ``incomplete``, one with blank answers ``blank``, else ``written``.  All
    runs are checked by the same job; answers outside the test are ignored.
    """
    runs = latest(predictions, ["experiment", "index"], ["answer", "backend"])
    joined = runs.join(
        expected.select("index", "kind", F.lit(True).alias("_in")), "index", "left"
    )
    if do_clamp:
        fixed = clamp(joined, support, majority)
    else:
        fixed = joined.withColumn("original", F.col("answer"))
    inside = F.col("_in").isNotNull()
    blank = F.col("answer").isNull() | (F.col("answer") == "")
    total = expected.agg(F.count(F.lit(1)).alias("n")).scalar()
    report = (
        fixed.groupBy("experiment")
        .agg(
            F.sum(inside.cast("bigint")).alias("got"),
            F.sum((~inside).cast("bigint")).alias("extra"),
            F.sum((inside & ~F.col("original").eqNullSafe(F.col("answer"))).cast("bigint")).alias("clamped"),
            F.sum((inside & blank).cast("bigint")).alias("blank"),
            F.size(F.collect_set(F.coalesce("backend", F.lit("None")))).alias("backends"),
        )
        .withColumn("_expected", total)
        .select(
            "experiment",
            submission_name(F.col("experiment")).alias("file"),
            "got",
            (F.col("_expected") - F.col("got")).alias("missing"),
            "extra",
            "clamped",
            "blank",
            "backends",
            F.when(F.col("got") < F.col("_expected"), "incomplete")
            .when(F.col("blank") > 0, "blank")
            .otherwise("written")
            .alias("status"),
        )
    )
    good = report.filter(F.col("status") == "written").select("experiment", "file")
    rows = fixed.filter(inside).join(F.broadcast(good), "experiment").select("file", "index", "answer")
    return report, rows


