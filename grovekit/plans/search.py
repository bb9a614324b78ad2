"""Hyperparameter search: space, resume, folds, pruning, leaderboard, refit."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from statistics import fmean, pstdev

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grovekit.functions.labels import config_key, lda_from_text, split_from_label, split_label
from grovekit.operators.forest import Fit, ForestParams, fit_forest, fit_forests, predict_forest, right_answers
from grovekit.operators.ranking import running_totals
from grovekit.operators.sampling import (
    random_subset,
    stratified_folds,
    stratified_holdout,
)
from grovekit.session import local_table, materialize
from grovekit.sources.results import append_results, done_keys, read_results
from grovekit.sources.schemas import RESULT

SPLIT = "struct<type: string, c: int, penalty: double, kernel: string>"

# The stock axes of the search space.
STOCK_SPLITS = (
    ("orthogonal", None, None, None),
    ("PCA", 5, None, None),
    ("PCA", 10, None, None),
    ("SVM", None, 1.0, "linear"),
    ("SVM", None, 1.0, "rbf"),
    ("SVM", None, 1.0, "poly"),
)
STOCK_AXES = {
    "gain": (("gini", "entropy"), "string"),
    "max_depth": ((4, 8, 12), "int"),
    "lda": ((None, 2), "int"),
    "tree_count": ((100,), "int"),
    "features_per_tree": ((15, 20, 25), "int"),
    "samples_fraction": ((0.8,), "double"),
    "repeated_sampling": ((True,), "boolean"),
}
STOCK_FEATURES = 34
LEADERBOARD = (
    "split", "gain", "max_depth", "lda", "features_per_tree",
    "acc_mean", "acc_std", "fit_s_mean", "pred_s_mean",
)


def search_space(
    base: DataFrame,
    n_features: Column,
    splits: Sequence[tuple] = STOCK_SPLITS,
    axes: dict[str, tuple] | None = None,
) -> DataFrame:
    """Every valid combination of the axes, once per row of ``base``.

    Combinations that ask for more features than there are, or for more
    components than features, are dropped.  Axes are expanded one by one, with
    the filters placed as soon as their columns exist.
    """
    axes = STOCK_AXES if axes is None else axes
    options = F.array(
        *[
            F.struct(
                F.lit(t).alias("type"),
                F.lit(c).cast("int").alias("c"),
                F.lit(p).cast("double").alias("penalty"),
                F.lit(k).cast("string").alias("kernel"),
            )
            for t, c, p, k in splits
        ]
    )
    values, dtype = axes["features_per_tree"]
    space = (
        base.withColumn("_m", n_features)
        .withColumn("features_per_tree", F.explode(F.array(*[F.lit(v).cast(dtype) for v in values])))
        .filter(F.col("features_per_tree") <= F.col("_m"))
        .withColumn("split", F.explode(options))
        .filter((F.col("split.type") != "PCA") | (F.col("split.c") <= F.col("features_per_tree")))
        .drop("_m")
    )
    for name, (values, dtype) in axes.items():
        if name != "features_per_tree":
            space = space.withColumn(name, F.explode(F.array(*[F.lit(v).cast(dtype) for v in values])))
    return space.withColumn("config_key", config_key())


def stock_space(spark: SparkSession) -> DataFrame:
    return search_space(spark.range(1).drop("id"), F.lit(STOCK_FEATURES))


def pending_configs(space: DataFrame, results: DataFrame) -> DataFrame:
    """Configurations without a successful result."""
    return space.join(done_keys(results), "config_key", "left_anti")


def select_configs(space: DataFrame, mode: str, max_trials: int, seed=42) -> DataFrame:
    """``grid`` keeps all; ``random`` the first max_trials of a seeded shuffle."""
    if mode == "grid":
        return space
    if mode != "random":
        raise ValueError(f"unknown search mode {mode!r}")
    return random_subset(space, "config_key", max_trials, seed)


def config_folds(configs: DataFrame, k: int) -> DataFrame:
    """Every configuration on every fold: ``…, fold``."""
    return configs.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))


# Summaries of fold results -------------------------------------------------


def fold_summary(folds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``acc_mean, acc_std, acc_folds, fit_s_mean, pred_s_mean`` per key.

    The deviation is the population one; folds per key are few.
    """
    ordered = F.array_sort(F.collect_list(F.struct("fold", "acc"))).getField("acc")
    return folds.groupBy(*keys).agg(
        F.avg("acc").alias("acc_mean"),
        F.stddev_pop("acc").alias("acc_std"),
        ordered.alias("acc_folds"),
        F.avg("fit_s").alias("fit_s_mean"),
        F.avg("pred_s").alias("pred_s_mean"),
    )


def folds_text(folds: Column) -> Column:
    """``0.7500|0.7613|…``."""
    return F.array_join(F.transform(folds, lambda a: F.format_string("%.4f", a)), "|")


def running_mean(steps: DataFrame, trial: str = "number", step: str = "step", acc: str = "acc") -> DataFrame:
    """Adds ``running_mean``: the mean of a trial's accuracies so far."""
    w = Window.partitionBy(trial).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    return steps.withColumn("running_mean", F.avg(acc).over(w))


def exact_median(df: DataFrame, group: str, value: str, spread: bool = False) -> DataFrame:
    """``group, n, median`` from counts per distinct value, so equal values meet early.

    ``spread`` sorts groups of any size across tasks instead of one task each.
    """
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("c"))
    run = running_totals(counts, [group], value, {"upto": F.col("c")}, grand="all_", spread=spread)
    n, last = F.col("all_upto"), F.col("upto")

    def holds(position: Column) -> Column:
        return (position > last - F.col("c")) & (position <= last)

    low, high = holds(F.floor((n + 1) / 2)), holds(F.floor((n + 2) / 2))
    return run.groupBy(group).agg(
        F.max(n).alias("n"),
        ((F.max(F.when(low, F.col(value))) + F.max(F.when(high, F.col(value)))) / 2).alias("median"),
    )


def median_pruned(
    steps: DataFrame, startup: int = 10, warmup: int = 0, trial: str = "number", step: str = "step", spread: bool = True
) -> DataFrame:
    """Adds ``best_so_far, median, pruned`` to steps with number, step, running_mean, state.

    A trial is cut at a step when its best running mean up to there lies below
    the median of the completed trials at that step.  The first ``startup``
    completed trials and steps up to ``warmup`` never prune.  Steps are few and trials may be many: the median of a step is
    found across tasks (runs a job) unless ``spread`` is off.
    """
    w = Window.partitionBy(trial).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    best = steps.withColumn("best_so_far", F.max("running_mean").over(w))
    complete = steps.filter(F.col("state") == "COMPLETE")
    medians = exact_median(complete, step, "running_mean", spread).withColumnRenamed("n", "_n")
    cut = (
        (F.col("_n") >= startup)
        & (F.col(step) > warmup)
        & (F.col("best_so_far") < F.col("median"))
    )
    # One row per step, and there are as many steps as folds.
    return (
        best.join(F.broadcast(medians), step, "left")
        .withColumn("pruned", F.coalesce(cut, F.lit(False)))
        .drop("_n")
    )


def best_per_key(results: DataFrame) -> DataFrame:
    """Successful results, the best mean accuracy per configuration."""
    ok = results.filter(F.col("status") == "ok")
    rest = [c for c in ok.columns if c != "config_key"]
    order = F.struct("acc_mean", -F.unix_micros("timestamp"))
    best = ok.groupBy("config_key").agg(F.max_by(F.struct(*rest), order).alias("_b"))
    return best.select("config_key", "_b.*").select(*results.columns)


def leaderboard(results: DataFrame, top: int = 15, columns: Sequence[str] = LEADERBOARD) -> DataFrame:
    """The ``top`` configurations by mean accuracy, ties by key."""
    ranked = best_per_key(results).orderBy(F.desc("acc_mean"), "config_key").limit(top)
    return ranked.select(*columns)


def best_config(results: DataFrame) -> DataFrame:
    return best_per_key(results).orderBy(F.desc("acc_mean"), "config_key").limit(1)


def best_trial(trials: DataFrame) -> DataFrame:
    """The best completed trial; the earliest of equals."""
    done = trials.filter(F.col("state") == "COMPLETE")
    return done.orderBy(F.desc("value"), "number").limit(1)


def grid_matrix(cells: DataFrame, rows: str, columns: str, column_values: Sequence, value: str) -> DataFrame:
    """One row per value of ``rows``, one column ``c_<value>`` per column value."""
    pivoted = cells.groupBy(rows).pivot(columns, list(column_values)).agg(F.max(value))
    return pivoted.select(rows, *[F.col(f"`{v}`").alias(f"c_{v}") for v in column_values])


def grid_best(cells: DataFrame, rows: str, columns: str, value: str) -> DataFrame:
    """The first maximum of a grid in row-major order."""
    order = F.struct(-F.col(value), F.col(rows), F.col(columns))
    kept = F.struct(rows, columns, value)
    return cells.agg(F.min_by(kept, order).alias("_b")).select("_b.*")


# Running trials ------------------------------------------------------------


def forest_params(config, n_train: int, seed=42) -> ForestParams:
    """Parameters of a configuration row; the sample share becomes a row count."""
    split = config["split"]
    samples = min(n_train, max(1, int(n_train * config["samples_fraction"])))
    return ForestParams(
        trees=config["tree_count"],
        max_depth=config["max_depth"],
        split=split["type"],
        c=split["c"] or 5,
        penalty=split["penalty"] if split["penalty"] is not None else 1.0,
        kernel=split["kernel"] or "linear",
        gain=config["gain"],
        lda=config["lda"],
        features_per_tree=config["features_per_tree"],
        samples_per_tree=samples,
        replace=config["repeated_sampling"],
        seed=seed,
    )


def folds_of(rows: DataFrame, key: str, k: int, seed=42, holdout_fraction: float = 0.25) -> DataFrame:
    """Rows with ``fold``; a single fold is a stratified holdout (fold 0 against -1)."""
    if k >= 2:
        return stratified_folds(rows, key, k, seed=seed)
    divided = stratified_holdout(rows, key, holdout_fraction, seed=seed)
    return divided.withColumn("fold", F.when(F.col("split") == "test", 0).otherwise(-1)).drop("split")


def evaluate_folds(
    configs: Sequence, folded: DataFrame, folds: Sequence[int], key: str, n_features: int, seed=42
) -> list[list[dict]]:
    """For each configuration, one result row per fold: fitted on the other folds, measured on this one.

    All models of all configurations and folds grow in shared jobs, and one job measures them.  Seconds are those of
    the shared jobs, divided by the number of models.
    """
    sizes = {r["fold"]: r["n"] for r in folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_all = sum(sizes.values())
    started = time.perf_counter()
    fits = [Fit(forest_params(c, n_all - sizes.get(f, 0), seed), f) for c in configs for f in folds]
    models = fit_forests(folded, key, n_features, fits)
    fitted = time.perf_counter()
    parts = [f.without for f in fits]
    measured = right_answers(models, parts, folded)
    fit_s, pred_s = ((b - a) / len(fits) for a, b in ((started, fitted), (fitted, time.perf_counter())))
    rows = [
        {"fold": part, "acc": right / asked if asked else None, "fit_s": fit_s, "pred_s": pred_s}
        for part, (right, asked) in zip(parts, measured)
    ]
    return [rows[i : i + len(folds)] for i in range(0, len(rows), len(folds))]


def evaluate_configs(configs: Sequence, rows: DataFrame, key: str, n_features: int, k: int = 3, seed=42) -> list[list[dict]]:
    """Cross-validation of many configurations at once; one list of fold results for each."""
    folded = materialize(folds_of(rows.select(key, "features", "label"), key, k, seed))
    return evaluate_folds(configs, folded, range(max(1, k)), key, n_features, seed)


def evaluate_config(config, rows: DataFrame, key: str, n_features: int, k: int = 3, seed=42) -> list[dict]:
    return evaluate_configs([config], rows, key, n_features, k, seed)[0]


def result_row(config, folds: list[dict], k: int, total_s: float, status: str) -> dict:
    """One appended row; an error keeps the configuration and its status."""
    row = {n: config[n] for n in (
        "config_key", "gain", "max_depth", "lda", "tree_count", "features_per_tree",
        "samples_fraction", "repeated_sampling",
    )}
    row |= {"cv_folds": k, "total_s": round(total_s, 1), "status": status}
    if folds:
        accuracies = [f["acc"] for f in sorted(folds, key=lambda f: f["fold"])]
        row |= {
            "acc_mean": round(fmean(accuracies), 4),
            "acc_std": round(pstdev(accuracies), 4),
            "acc_folds": [round(a, 4) for a in accuracies],
            "fit_s_mean": round(fmean(f["fit_s"] for f in folds), 1),
            "pred_s_mean": round(fmean(f["pred_s"] for f in folds), 1),
        }
    return row


def run_search(
    rows: DataFrame,
    key: str,
    n_features: int,
    space: DataFrame,
    path: str,
    mode: str = "random",
    max_trials: int = 25,
    k: int = 3,
    budget_s: float | None = None,
    seed=42,
    objective: Callable[..., list[dict]] | None = None,
    callback: Callable[[dict], None] | None = None,
    together: int = 16,
) -> DataFrame:
    """Evaluate the configurations that ``path`` lacks; append a row for each.

    The driver only holds the list of configurations.  ``together`` of them
    are fitted in shared jobs, or one at a time by an ``objective`` of the
    caller's.  Where shared jobs fail, their configurations are tried one by
    one; a failing one leaves a row whose status tells why.  No new ones start
    after the budget.
    """
    spark = rows.sparkSession
    chosen = select_configs(space, mode, max_trials, seed)
    todo = pending_configs(chosen, read_results(spark, path))
    labelled = todo.withColumn("_label", split_label(F.col("split"))).orderBy("config_key")
    started = time.perf_counter()
    waiting = labelled.collect()  # parameters only
    size = together if objective is None else 1
    for at in range(0, len(waiting), size):
        if budget_s is not None and time.perf_counter() - started > budget_s:
            break
        group = waiting[at : at + size]
        begun = time.perf_counter()
        results = _tried(group, objective, rows, key, n_features, k, seed)
        took = (time.perf_counter() - begun) / len(group)
        flat = []
        for config, (folds, status) in zip(group, results):
            row = result_row(config, folds, k, took, status)
            row["split"] = config["_label"]
            flat.append(tuple(row.get(f.name) for f in RESULT))
            if callback:
                callback(row)
        append_results(local_table(spark, flat, RESULT).withColumn("timestamp", F.current_timestamp()), path)
    return read_results(spark, path)


def _tried(group: Sequence, objective, rows: DataFrame, key: str, n_features: int, k: int, seed) -> list[tuple[list[dict], str]]:
    """Fold results and status of each configuration."""
    if objective is None and len(group) > 1:
        try:
            return [(folds, "ok") for folds in evaluate_configs(group, rows, key, n_features, k, seed)]
        except Exception:  # noqa: BLE001 - which of them fails is found below
            pass
    out = []
    for config in group:
        try:
            out.append(((objective or evaluate_config)(config, rows, key, n_features, k, seed), "ok"))
        except Exception as error:  # noqa: BLE001 - a failed trial must not end the search
            out.append(([], f"erro: {error}"))
    return out


def run_pruned(
    rows: DataFrame,
    key: str,
    n_features: int,
    configs: DataFrame,
    k: int = 3,
    startup: int = 10,
    warmup: int = 0,
    seed=42,
) -> DataFrame:
    """Fold by fold over all live trials together, cutting those below the median.

    ``configs`` has number and the configuration columns.  Returns the steps
    ``number, step, acc, running_mean, state``.
    """
    spark = rows.sparkSession
    folded = materialize(folds_of(rows.select(key, "features", "label"), key, k, seed))
    live = {c["number"]: c for c in configs.orderBy("number").collect()}  # parameters only
    steps: list[tuple] = []
    schema = "number bigint, step int, acc double"
    cut: set[int] = set()
    for fold in range(k):
        measured = evaluate_folds(list(live.values()), folded, [fold], key, n_features, seed)
        steps += [(number, fold, rows[0]["acc"]) for number, rows in zip(live, measured)]
        table = running_mean(local_table(spark, steps, schema)).withColumn(
            "state", F.when(F.col("number").isin(list(live)), "COMPLETE").otherwise("PRUNED")
        )
        judged = median_pruned(table, startup, warmup, spread=False).filter((F.col("step") == fold) & F.col("pruned"))
        gone = {r["number"] for r in judged.select("number").collect()}
        if fold < k - 1:
            cut |= gone
            live = {n: c for n, c in live.items() if n not in gone}
    state = F.when(F.col("number").isin(list(cut)), "PRUNED").otherwise("COMPLETE")
    return running_mean(local_table(spark, steps, schema)).withColumn("state", state)


def config_from_result(results: DataFrame) -> DataFrame:
    """Typed configuration columns of imported text results."""
    lda = lda_from_text(F.col("lda").cast("string"))
    return results.withColumn("split", split_from_label(F.col("split"))).withColumn("lda", lda)


def refit_best(results: DataFrame, train: DataFrame, test: DataFrame, key: str, n_features: int, seed=42) -> DataFrame:
    """Fit the best configuration on all training rows; ``key, predicted`` of the test rows."""
    best = config_from_result(best_config(results)).first()
    if best is None:
        raise ValueError("no configuration was evaluated with success")
    forest = fit_forest(train, key, n_features, forest_params(best, train.count(), seed))
    return predict_forest(forest, test, key)


def sweep(base: dict, axis: str, values: Sequence) -> list[dict]:
    """Configurations that differ from ``base`` in one axis only."""
    return [{**base, axis: v} for v in values]


def run_sweep(
    rows: DataFrame, key: str, n_features: int, base: dict, axis: str, values: Sequence, seed=42
) -> DataFrame:
    """``value, acc, fit_s, pred_s`` of a stratified holdout along one axis, all values in shared jobs."""
    folded = materialize(folds_of(rows.select(key, "features", "label"), key, 1, seed))
    found = evaluate_folds(sweep(base, axis, values), folded, [0], key, n_features, seed)
    out = [(str(v), r["acc"], r["fit_s"], r["pred_s"]) for v, (r,) in zip(values, found)]
    return local_table(
        rows.sparkSession, out, "value string, acc double, fit_s double, pred_s double"
    )
