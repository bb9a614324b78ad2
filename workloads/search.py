"""Search space, results, pruning and leaderboards on tables derived from the given ones."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from grovekit.functions import labels
from grovekit.operators import sampling
from grovekit.plans import search
from grovekit.session import materialize, shared_folder
from grovekit.sources import results as files
from grovekit.sources.schemas import RESULT, TRIAL
from workloads.features import SUB, _rank
from workloads.inputs import EMB, FOLDS, LI, RESULTS, embedding_rows, lineitem_rows, results, trial_folds
from workloads.registry import query
from workloads.sqltext import forest_ctes, walk


def _results(spark, sf):
    """Typed results with their configuration key."""
    r = results(spark, sf)
    return r.withColumn("config_key", labels.config_key(F.col("split")))


@query("config_keys", f"WITH {RESULTS} SELECT number, config_key FROM results")
def config_keys(spark, sf):
    """Labels parsed to typed configurations and written out again as keys."""
    typed = search.config_from_result(results(spark, sf))
    return typed.select("number", labels.config_key().alias("config_key"))


@query(
    "parsed_labels",
    f"""WITH {RESULTS} SELECT DISTINCT split AS label, split_part(split, '-', 1) AS type,
      CASE WHEN split LIKE 'PCA%' THEN substr(split, 6)::INT END AS c,
      CASE WHEN split LIKE 'SVM%' THEN substr(split_part(split, '-', 3), 2)::DOUBLE END AS penalty,
      CASE WHEN split LIKE 'SVM%' THEN split_part(split, '-', 2) END AS kernel, lda FROM results""",
)
def parsed_labels(spark, sf):
    r = results(spark, sf)
    text = F.coalesce(F.col("lda").cast("double").cast("string"), F.lit("nan"))
    return r.select(
        F.col("split").alias("label"),
        labels.split_from_label(F.col("split")).alias("s"),
        labels.lda_from_text(text).alias("lda"),
    ).select("label", "s.*", "lda").distinct()


SPACE = """space AS (
  SELECT split || '|gain=' || gain || '|depth=' || depth || '|lda=' || coalesce(lda::VARCHAR, 'None')
    || '|trees=100|feats=' || feats || '|frac=0.8|boot=True' AS config_key, feats, split
  FROM (SELECT unnest(['orthogonal','PCA-c5','PCA-c10','SVM-linear-C1.0','SVM-rbf-C1.0','SVM-poly-C1.0']) AS split),
    (SELECT unnest(['gini','entropy']) AS gain), (SELECT unnest([4, 8, 12]) AS depth),
    (SELECT unnest([NULL, 2]) AS lda), (SELECT unnest([15, 20, 25]) AS feats))"""


def _space(spark, sf):
    """The stock space, bounded by the feature count of the embeddings."""
    width = embedding_rows(spark, sf).agg(F.max(F.size("features")).alias("m"))
    return search.search_space(width, F.col("m")).drop("m")


@query(
    "search_space",
    f"""WITH {EMB}, {SPACE} SELECT config_key, features_per_tree, type FROM (
      SELECT config_key, feats AS features_per_tree, split_part(split, '-', 1) AS type FROM space)
    WHERE features_per_tree <= (SELECT max(len(features)) FROM emb)""",
)
def search_space(spark, sf):
    return _space(spark, sf).select("config_key", "features_per_tree", F.col("split.type").alias("type"))


DONE = "done AS (SELECT DISTINCT config_key FROM results WHERE status = 'ok' AND acc_bp > 7900)"


def _few_results(spark, sf):
    """Results of good runs, so that some configurations are still pending."""
    return _results(spark, sf).filter("acc_bp > 7900")


@query(
    "pending_configs",
    f"""WITH {RESULTS}, {SPACE}, {DONE} SELECT config_key FROM space WHERE config_key NOT IN (SELECT config_key FROM done)""",
)
def pending_configs(spark, sf):
    return search.pending_configs(_space(spark, sf), _few_results(spark, sf)).select("config_key")


@query(
    "random_pending_configs",
    f"""WITH {RESULTS}, {SPACE}, {DONE}, pick AS (SELECT config_key FROM space ORDER BY md5('42|' || config_key) LIMIT 25)
    SELECT config_key FROM pick WHERE config_key NOT IN (SELECT config_key FROM done)""",
)
def random_pending_configs(spark, sf):
    chosen = search.select_configs(_space(spark, sf), "random", 25)
    return search.pending_configs(chosen, _few_results(spark, sf)).select("config_key")


@query(
    "config_folds",
    f"""WITH {LI}, {SPACE}, f AS (SELECT label, fold, count(*) AS n FROM (
      SELECT label, (({_rank(42, 'row_key', 'label')} - 1) % 3)::INT AS fold FROM li) GROUP BY ALL)
    SELECT config_key, fold, sum(n)::BIGINT AS n_valid FROM space, f GROUP BY ALL""",
)
def config_folds(spark, sf):
    sizes = sampling.stratified_folds(lineitem_rows(spark, sf), "row_key").groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_valid")
    )
    return search.config_folds(_space(spark, sf), 3).join(sizes, "fold").select("config_key", "fold", "n_valid")


@query(
    "fold_summary",
    f"""WITH {FOLDS} SELECT number, round(avg(acc), 6) AS acc_mean, round(stddev_pop(acc), 6) AS acc_std,
      string_agg(printf('%.4f', acc), '|' ORDER BY fold) AS acc_folds, round(avg(fit_s), 6) AS fit_s_mean,
      round(avg(pred_s), 6) AS pred_s_mean FROM folds GROUP BY number""",
)
def fold_summary(spark, sf):
    s = search.fold_summary(trial_folds(spark, sf), ["number"])
    return s.select(
        "number",
        search.folds_text(F.col("acc_folds")).alias("acc_folds"),
        *[F.round(c, 6).alias(c) for c in ("acc_mean", "acc_std", "fit_s_mean", "pred_s_mean")],
    )


RUNNING = "run AS (SELECT *, avg(acc) OVER (PARTITION BY number ORDER BY fold) AS running_mean FROM folds)"


def _steps(spark, sf):
    return search.running_mean(trial_folds(spark, sf).withColumnRenamed("fold", "step"))


@query("running_fold_mean", f"WITH {FOLDS}, {RUNNING} SELECT number, fold AS step, round(running_mean, 6) AS running_mean FROM run")
def running_fold_mean(spark, sf):
    return _steps(spark, sf).select("number", "step", F.round("running_mean", 6).alias("running_mean"))


@query(
    "pruned_trials",
    f"""WITH {FOLDS}, {RUNNING},
    r AS (SELECT number, state, fold, round(running_mean, 9) AS running_mean FROM run),
    b AS (SELECT *, max(running_mean) OVER (PARTITION BY number ORDER BY fold) AS best FROM r),
    m AS (SELECT fold, median(running_mean) AS med, count(*) AS n FROM r WHERE state = 'COMPLETE' GROUP BY fold)
    SELECT number, fold AS step, round(best, 6) AS best_so_far, round(med, 6) AS median,
      n >= 10 AND fold > 0 AND best < med AS pruned FROM b JOIN m USING (fold)""",
)
def pruned_trials(spark, sf):
    steps = _steps(spark, sf).withColumn("running_mean", F.round("running_mean", 9))
    j = search.median_pruned(steps)
    return j.select(
        "number", "step", F.round("best_so_far", 6).alias("best_so_far"), F.round("median", 6).alias("median"), "pruned"
    )


BEST = """best AS (SELECT * FROM results WHERE status = 'ok' QUALIFY row_number() OVER (
  PARTITION BY config_key ORDER BY acc_mean DESC, "timestamp") = 1)"""


@query("best_per_config", f"WITH {RESULTS}, {BEST} SELECT config_key, acc_mean FROM best")
def best_per_config(spark, sf):
    return search.best_per_key(_results(spark, sf)).select("config_key", "acc_mean")


@query(
    "leaderboard",
    f"""WITH {RESULTS}, {BEST} SELECT config_key, split, gain, max_depth, lda, features_per_tree, acc_mean
    FROM best ORDER BY acc_mean DESC, config_key LIMIT 15""",
)
def leaderboard(spark, sf):
    cols = ("config_key", "split", "gain", "max_depth", "lda", "features_per_tree", "acc_mean")
    return search.leaderboard(_results(spark, sf), 15, cols)


@query(
    "best_trial",
    f"WITH {RESULTS} SELECT number, acc_mean AS value FROM results WHERE state = 'COMPLETE' ORDER BY acc_mean DESC, number LIMIT 1",
)
def best_trial(spark, sf):
    trials = results(spark, sf).withColumn("value", F.col("acc_mean"))
    return search.best_trial(trials).select("number", "value")


GRID = "cells AS (SELECT features_per_tree AS f, max_depth AS d, max(acc_mean) AS acc FROM results GROUP BY ALL)"


def _cells(spark, sf):
    r = results(spark, sf)
    return r.groupBy(F.col("features_per_tree").alias("f"), F.col("max_depth").alias("d")).agg(F.max("acc_mean").alias("acc"))


@query(
    "grid_matrix",
    f"""WITH {RESULTS}, {GRID} SELECT f, max(CASE WHEN d = 4 THEN acc END) AS c_4, max(CASE WHEN d = 8 THEN acc END) AS c_8,
    max(CASE WHEN d = 12 THEN acc END) AS c_12 FROM cells GROUP BY f""",
)
def grid_matrix(spark, sf):
    return search.grid_matrix(_cells(spark, sf), "f", "d", (4, 8, 12), "acc")


@query("grid_best", f"WITH {RESULTS}, {GRID} SELECT f, d, acc FROM cells ORDER BY acc DESC, f, d LIMIT 1")
def grid_best(spark, sf):
    return search.grid_best(_cells(spark, sf), "f", "d", "acc")


@query(
    "results_scan",
    f"""WITH {RESULTS} SELECT DISTINCT config_key FROM results WHERE status = 'ok'""",
)
def results_scan(spark, sf):
    """Results appended as parquet, exported as text with a broken tail, and scanned for done keys."""
    folder = f"{shared_folder(spark)}/results-{uuid.uuid4().hex}"
    files.append_results(_results(spark, sf), f"{folder}/table")
    back = spark.read.schema(RESULT).parquet(f"{folder}/table")
    files.write_results_csv(back, f"{folder}/text")
    torn = spark.read.text(f"{folder}/text").filter("value NOT LIKE 'timestamp,%'")
    torn = torn.withColumn("value", F.concat(F.lit("2024-01-0x,"), F.substring("value", 1, 12)))
    header = ",".join(f.name for f in RESULT)
    torn.select(F.concat(F.lit(header + "\n"), "value").alias("value")).write.mode("append").text(f"{folder}/text")
    return files.done_keys(files.read_results_csv(spark, f"{folder}/text"))


@query(
    "exported_trials",
    f"""WITH {RESULTS} SELECT state, count(*) AS n, round(sum(acc_mean), 4) AS total FROM results GROUP BY state""",
)
def exported_trials(spark, sf):
    path = f"{shared_folder(spark)}/trials-{uuid.uuid4().hex}"
    r = results(spark, sf)
    have = {
        "number": F.col("number"), "value": F.col("acc_mean"), "state": F.col("state"),
        "maxDepth": F.col("max_depth"), "gainMethod": F.col("gain"), "splitType": F.col("split"),
    }
    trials = r.select(*[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in TRIAL])
    files.export_trials(trials, path)
    back = spark.read.schema(TRIAL).option("header", True).csv(path)
    return back.groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


# Searches that really fit ------------------------------------------------------

SEARCH_AXES = {
    "gain": (("gini", "entropy"), "string"),
    "max_depth": ((2, 4), "int"),
    "lda": ((None, 2), "int"),
    "tree_count": ((5,), "int"),
    "features_per_tree": ((3,), "int"),
    "samples_fraction": ((0.5,), "double"),
    "repeated_sampling": ((True,), "boolean"),
}
#: Orthogonal forests without discriminants and without repeated draws can be grown in SQL as well.
PLAIN_AXES = SEARCH_AXES | {
    "max_depth": ((1, 2), "int"), "lda": ((None,), "int"), "tree_count": ((3,), "int"), "features_per_tree": ((2,), "int"),
    "samples_fraction": ((1.0,), "double"), "repeated_sampling": ((False,), "boolean"),
}


KINDS = {"orthogonal": ("orthogonal", None, None, None), "PCA": ("PCA", 2, None, None), "SVM": ("SVM", None, 1.0, "linear")}


def _fitted_space(spark, sf, kinds, axes):
    """Configurations of some kinds, bounded by the feature count of the rows that are fitted."""
    width = lineitem_rows(spark, sf).agg(F.max(F.size("features")).alias("m"))
    return search.search_space(width, F.col("m"), [KINDS[k] for k in kinds], axes).drop("m")


def _searched(spark, sf, space, k):
    path = f"{shared_folder(spark)}/search-{uuid.uuid4().hex}"
    rows = materialize(lineitem_rows(spark, sf, busy=True).select("row_key", "features", "label"))
    return rows, search.run_search(rows, "row_key", 4, space, path, k=k, mode="grid")


@query("model_search")
def model_search(spark, sf):
    """Orthogonal and PCA forests of five trees with and without discriminants, by two folds; the best one refitted."""
    rows, done = _searched(spark, sf, _fitted_space(spark, sf, ("orthogonal", "PCA"), SEARCH_AXES), 2)
    board = search.leaderboard(done, 20, ("config_key", "split", "acc_mean", "acc_std"))
    predicted = search.refit_best(done, rows, rows, "row_key", 4)
    n = predicted.agg(F.count("predicted").alias("refit_rows"))
    return board.join(F.broadcast(n), F.lit(True))


def _folded_accuracy(gain: str, depth: int, fold: int, folds: int) -> str:
    """Right answers on one fold of a forest of three trees grown on the others, as one row."""
    return f"""SELECT '{gain}' AS gain, {depth} AS max_depth, {fold} AS fold, (WITH {LI},
      part AS (SELECT row_key, ({_rank(42, 'row_key', 'label')} - 1) % {folds} AS fold FROM li),
      bag AS (SELECT t::INT AS tree_id, row_key, 1::BIGINT AS weight FROM part, range(3) r(t) WHERE fold <> {fold}),
      {SUB.format(trees=3, m=4, k=2, seed='42|space')}, {forest_ctes(depth, gain)},
      src AS (SELECT t::INT AS tree_id, li.* FROM li JOIN part USING (row_key), range(3) r(t) WHERE fold = {fold}),
      {walk('src', depth)}, voted AS (SELECT row_key, arg_min(predicted, (-n, predicted)) AS predicted
        FROM (SELECT row_key, predicted, count(*) AS n FROM leafs GROUP BY ALL) GROUP BY row_key)
      SELECT avg((predicted = label)::INT) FROM voted JOIN li USING (row_key)) AS acc"""


def _folded(folds: int) -> str:
    return " UNION ALL ".join(
        _folded_accuracy(g, d, f, folds) for g in SEARCH_AXES["gain"][0] for d in PLAIN_AXES["max_depth"][0] for f in range(folds)
    )


@query(
    "orthogonal_search",
    f"""SELECT gain, max_depth, round(avg(acc), 4) AS acc_mean, list(round(acc, 4) ORDER BY fold) AS acc_folds
    FROM ({_folded(2)}) GROUP BY gain, max_depth""",
)
def orthogonal_search(spark, sf):
    """Four configurations by two folds, grown together, as the results table has them."""
    _, done = _searched(spark, sf, _fitted_space(spark, sf, ("orthogonal",), PLAIN_AXES), 2)
    return done.select("gain", "max_depth", "acc_mean", "acc_folds")


@query("pruned_search")
def pruned_search(spark, sf):
    """Twelve trials of three kinds by three folds, cut at the median of the running means."""
    rows = materialize(lineitem_rows(spark, sf, busy=True).select("row_key", "features", "label"))
    axes = SEARCH_AXES | {"lda": ((None,), "int"), "tree_count": ((2,), "int"), "max_depth": ((2, 3), "int")}
    configs = _fitted_space(spark, sf, KINDS, axes)
    configs = configs.withColumn("number", F.rank().over(Window.orderBy("config_key")).cast("bigint"))
    return search.run_pruned(rows, "row_key", 4, configs, k=3, startup=3)


def _holdout_accuracy(depth: int) -> str:
    """Accuracy of a tree grown on the training part, on the test part."""
    return f"""SELECT '{depth}' AS value, (WITH {LI}, part AS (SELECT row_key, CASE WHEN {_rank(42, 'row_key', 'label')}
        <= round_even(count(*) OVER (PARTITION BY label) * 0.25, 0) THEN 'test' ELSE 'train' END AS split FROM li),
      bag AS (SELECT 0 AS tree_id, row_key, 1::BIGINT AS weight FROM part WHERE split = 'train'),
      sub AS (SELECT 0 AS tree_id, unnest([0, 1, 2, 3])::INT AS feature),
      {forest_ctes(depth, 'gini')}, src AS (SELECT 0 AS tree_id, li.* FROM li JOIN part USING (row_key) WHERE split = 'test'),
      {walk('src', depth)} SELECT round(avg((predicted = label)::INT), 6) FROM leafs JOIN li USING (row_key)) AS acc"""


@query("depth_sweep", " UNION ALL ".join(_holdout_accuracy(d) for d in (1, 2)))
def depth_sweep(spark, sf):
    rows = lineitem_rows(spark, sf)
    base = {
        "split": {"type": "orthogonal", "c": None, "penalty": None, "kernel": None}, "gain": "gini", "max_depth": 1,
        "lda": None, "tree_count": 1, "features_per_tree": 4, "samples_fraction": 1.0, "repeated_sampling": False,
    }
    swept = search.run_sweep(rows, "row_key", 4, base, "max_depth", (1, 2))
    return swept.select("value", F.round("acc", 6).alias("acc"))
