"""Batch inference over question items: strategies, resume, full runs."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovekit.functions import prompts
from grovekit.functions.answers import COUNT, OUTPUT, with_clean_answer
from grovekit.operators.ranking import last_per_key
from grovekit.operators.sampling import stratified_sample
from grovekit.plans import evaluation
from grovekit.sources.records import read_or_empty
from grovekit.sources.results import write_submission
from grovekit.sources.schemas import PREDICTION, RUN

# The constant answers that the majority baseline is compared with.
DUMMY = {OUTPUT: "True", COUNT: "1"}


class StandIn:
    """Deterministic backend made of column expressions; needs no model."""

    tag = "dry"

    def generate(
        self, df: DataFrame, user: str, raw: str, tokens: str, system: str, limit: int, sample: str | None = None
    ) -> DataFrame:
        draw = F.col(sample) if sample else None
        return df.withColumn(raw, prompts.stand_in_generation(F.col(user), draw)).withColumn(
            tokens, prompts.stand_in_tokens(F.col(raw), limit)
        )


class ModelBackend:
    """A user's model behind ``make()``, built once per task.

    ``make()`` returns an object whose ``ask(image, system, user,
    max_new_tokens, temperature, top_p)`` gives (text, tokens).
    """

    def __init__(self, make: Callable[[], object], tag: str, temperature: float = 0.7, top_p: float = 0.9):
        self.make, self.tag = make, tag
        self.temperature, self.top_p = temperature, top_p

    def generate(
        self, df: DataFrame, user: str, raw: str, tokens: str, system: str, limit: int, sample: str | None = None
    ) -> DataFrame:
        schema = T.StructType(
            [*df.schema.fields, T.StructField(raw, T.StringType()), T.StructField(tokens, T.IntegerType())]
        )
        make = self.make
        hot = {"temperature": self.temperature, "top_p": self.top_p} if sample else {}

        def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            backend = None
            for batch in batches:
                if backend is None:
                    backend = make()
                answers = [
                    backend.ask(i, system=system, user=u, max_new_tokens=limit, **hot)
                    for i, u in zip(batch["image"], batch[user])
                ]
                yield batch.assign(**{raw: [a[0] for a in answers], tokens: [a[1] for a in answers]})

        return df.mapInPandas(task, schema)


def predict_rows(items: DataFrame, make_predict: Callable[[], Callable[[dict], dict]]) -> DataFrame:
    """A user's ``predict(item) -> dict`` over Arrow batches, timed per item.

    ``make_predict()`` runs once per task, so a model loads once per task.
    The result's fields override nothing but the prediction columns.
    """
    names = [f.name for f in PREDICTION if f.name not in ("index", "question", "elapsed_s")]
    inputs = items.columns

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = None
        for batch in batches:
            if predict is None:
                predict = make_predict()
            rows = []
            for item in batch.to_dict("records"):
                started = time.perf_counter()
                got = predict({k: item[k] for k in inputs})
                elapsed = round(time.perf_counter() - started, 4)
                rows.append((item["index"], item["question"], elapsed, *[got.get(n) for n in names]))
            out = pd.DataFrame(rows, columns=["index", "question", "elapsed_s", *names])
            yield out[[f.name for f in PREDICTION]]

    return items.mapInPandas(task, PREDICTION)


# Strategies ---------------------------------------------------------------
# Each takes items with index, question, kind, image and gives answer columns.


def constant(items: DataFrame, majority: DataFrame) -> DataFrame:
    """The majority answer of the item's kind."""
    return evaluation.with_majority(items, majority).withColumnRenamed("majority", "answer")


def dummy(items: DataFrame) -> DataFrame:
    value = F.lit(None).cast("string")
    for kind, answer in DUMMY.items():
        value = F.when(F.col("kind") == kind, F.lit(answer)).otherwise(value)
    return items.withColumn("answer", value)


def single_pass(
    items: DataFrame, majority: DataFrame, backend, system: str, stepwise: bool, limit: int
) -> DataFrame:
    """One generation per item; an answer that does not parse is the majority."""
    q = F.col("question")
    asked = items.withColumn("_user", prompts.stepwise_prompt(q) if stepwise else q)
    made = backend.generate(asked, "_user", "raw", "new_tokens", system, limit).drop("_user")
    return with_clean_answer(
        evaluation.with_majority(made, majority), "raw", F.col("kind"), q, F.col("majority")
    ).drop("majority")


def self_consistency(
    items: DataFrame, majority: DataFrame, backend, samples: int = prompts.VOTE_SAMPLES
) -> DataFrame:
    """Several generations per item and the vote of those that parse.

    The samples of an item are columns of its row, so voting shuffles nothing.
    """
    q, numbers = F.col("question"), range(1, samples + 1)
    made = items.withColumn("_user", prompts.stepwise_prompt(q))
    for k in numbers:
        made = backend.generate(
            made.withColumn("_sample", F.lit(k)), "_user", f"_raw{k}", f"_tokens{k}",
            prompts.DOMAIN_SYSTEM, prompts.LONG_TOKENS, "_sample",
        )
        made = with_clean_answer(made, f"_raw{k}", F.col("kind"), q, None, f"_vote{k}")
    raws = F.array(*[f"_raw{k}" for k in numbers])
    votes = F.filter(F.array(*[f"_vote{k}" for k in numbers]), lambda v: v.isNotNull())
    times = F.transform(
        F.array_distinct("votes"),
        lambda v: F.struct(
            (-F.size(F.filter("votes", lambda o: o == v))).alias("n"),
            F.array_position("votes", v).alias("first"),
            v.alias("answer"),
        ),
    )
    voted = made.withColumn("votes", votes).withColumn("_best", F.array_min(times))
    return evaluation.with_majority(voted, majority).select(
        *[c for c in items.columns if c not in ("answer", "raw")],
        F.col("_raw1").alias("raw"),
        raws.alias("raws"),
        "votes",
        F.coalesce(-F.col("_best.n"), F.lit(0)).alias("agreement"),
        F.coalesce("_best.answer", "majority").alias("answer"),
        sum((F.col(f"_tokens{k}") for k in numbers), F.lit(0)).alias("new_tokens"),
    )


def two_stage(items: DataFrame, majority: DataFrame, backend) -> DataFrame:
    """A stepwise answer, then a review of it; the review wins if it parses."""
    q, limit = F.col("question"), prompts.LONG_TOKENS
    first = backend.generate(
        items.withColumn("_user", prompts.stepwise_prompt(q)),
        "_user", "raw_stage1", "_t1", prompts.DOMAIN_SYSTEM, limit,
    )
    first = with_clean_answer(first, "raw_stage1", F.col("kind"), q, None, "initial_answer")
    review = prompts.review_prompt(q, F.col("raw_stage1"), F.col("initial_answer"))
    second = backend.generate(
        first.withColumn("_user", review), "_user", "raw", "_t2", prompts.DOMAIN_SYSTEM, limit
    )
    final = with_clean_answer(
        evaluation.with_majority(second, majority),
        "raw", F.col("kind"), q, F.coalesce("initial_answer", "majority"),
    )
    return (
        final.withColumn("changed", ~F.col("initial_answer").eqNullSafe(F.col("answer")))
        .withColumn("new_tokens", F.col("_t1") + F.col("_t2"))
        .drop("_t1", "_t2", "_user", "majority")
    )


def strategies(majority: DataFrame, backend=None) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """The experiments by name."""
    backend = backend or StandIn()

    def one(system: str, stepwise: bool, limit: int):
        return lambda items: single_pass(items, majority, backend, system, stepwise, limit)

    return {
        "exp0_constant": lambda items: constant(items, majority),
        "exp1_baseline": one(prompts.BASELINE_SYSTEM, False, prompts.SHORT_TOKENS),
        "exp2_prompt": one(prompts.DOMAIN_SYSTEM, False, prompts.SHORT_TOKENS),
        "exp3_cot": one(prompts.DOMAIN_SYSTEM, True, prompts.LONG_TOKENS),
        "exp4_self_consistency": lambda items: self_consistency(items, majority, backend),
        "exp5_reflexion": lambda items: two_stage(items, majority, backend),
    }


# Resumable runs -----------------------------------------------------------


def open_run(spark: SparkSession, path: str) -> DataFrame:
    """All records of a run table; empty when nothing was written yet."""
    return read_or_empty(spark, path, RUN)


def pending(items: DataFrame, done: DataFrame) -> DataFrame:
    """Items whose index has no record yet."""
    return items.join(done.select("index"), "index", "left_anti")


def _aligned(df: DataFrame, backend: str | None) -> DataFrame:
    have = set(df.columns)
    fields = []
    for f in RUN:
        if f.name in have:
            value = F.col(f.name)
            if f.name == "backend" and backend is not None:
                value = F.coalesce(value, F.lit(backend))
        else:
            value = F.lit(backend) if f.name == "backend" else F.lit(None)
        fields.append(value.cast(f.dataType).alias(f.name))
    return df.select(*fields)


def run_predictions(
    items: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    path: str,
    backend: str | None = None,
    allow_mixed: bool = False,
    buckets: int = 1,
    mirror: str | None = None,
) -> DataFrame:
    """Predict the items that ``path`` lacks, append them, return all of them.

    Pending items are worked off in hashed buckets; each appended bucket is
    durable, so a lost driver costs one bucket and a second call resumes.  A
    mirror gets every bucket too, and at the end whatever else it lacks.
    """
    spark = items.sparkSession
    if mirror:
        restored = pending(latest_run(open_run(spark, mirror)), open_run(spark, path))
        restored.write.mode("append").parquet(path)
    done = open_run(spark, path)
    evaluation.check_backend(evaluation.latest(done), backend, allow_mixed)
    todo = pending(items, done)
    first = (done.agg(F.max("batch_id")).first()[0] or 0) + 1
    for bucket in range(buckets):
        mine = todo.filter(F.pmod(F.xxhash64("index"), F.lit(buckets)) == bucket) if buckets > 1 else todo
        made = _aligned(predict(mine), backend).withColumns(
            {"batch_id": F.lit(first + bucket).cast("bigint"), "seq": F.monotonically_increasing_id()}
        )
        made.write.mode("append").parquet(path)
        if mirror:
            written = open_run(spark, path).filter(F.col("batch_id") == first + bucket)
            written.write.mode("append").parquet(mirror)
    if mirror:
        lacking = pending(latest_run(open_run(spark, path)), open_run(spark, mirror))
        lacking.write.mode("append").parquet(mirror)
    return latest_run(open_run(spark, path)).join(items.select("index"), "index", "left_semi")


def latest_run(run: DataFrame) -> DataFrame:
    return last_per_key(run, ["index"], evaluation.ORDER)


@dataclass(frozen=True)
class RunOptions:
    sample: int | None = None
    limit: int | None = None
    seed: int = 42
    buckets: int = 1
    allow_mixed: bool = False
    mirror: str | None = None


def pick_items(items: DataFrame, options: RunOptions) -> DataFrame:
    """The items to evaluate: all, a stratified sample, or the first few."""
    if options.sample:
        items = stratified_sample(items, "index", options.sample, "kind", options.seed)
    if options.limit:
        items = items.orderBy("index").limit(options.limit)
    return items


def validation_limit(limit: int) -> int:
    """Validation rows kept when training is limited to ``limit`` rows."""
    return max(2, limit // 10)


def run_experiment(
    items: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    folder: str,
    name: str,
    tag: str,
    backend: str,
    options: RunOptions = RunOptions(),
    test: DataFrame | None = None,
    submission: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Evaluate on labelled items; then, if asked, predict and submit the test items.

    Returns the score rows and the token totals.
    """
    chosen = pick_items(items, options)
    preds = run_predictions(
        chosen, predict, f"{folder}/{name}_{tag}", backend, options.allow_mixed, options.buckets,
        f"{options.mirror}/{name}_{tag}" if options.mirror else None,
    )
    scores = evaluation.score(preds, chosen)
    if test is not None:
        answered = run_predictions(
            test, predict, f"{folder}/{name}_test", backend, options.allow_mixed, options.buckets,
            f"{options.mirror}/{name}_test" if options.mirror else None,
        )
        if submission:
            write_submission(answered, submission)
    return scores, evaluation.token_totals(preds)

