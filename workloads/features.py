"""Statistics, scalings, metrics, sampling and distances on the given tables."""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
from pyspark.sql import functions as F

from grovekit.functions import hashing, vectors
from grovekit.operators import linear, metrics, moments, neighbors, oblique, ranking, sampling, scan, sets, stats
from grovekit.sources import matrix, results
from grovekit.session import local_table, shared_folder
from workloads.inputs import (
    EMB,
    EMB_LONG,
    LI,
    LI_COMPLETE,
    LI_LONG,
    embedding_rows,
    lineitem_rows,
    table,
    with_holes,
)
from workloads.registry import query

STATS = """stats AS (SELECT feature, count(value) AS n, avg(value) AS mean, stddev_pop(value) AS std,
  min(value) AS min, max(value) AS max FROM long GROUP BY feature)"""
WITH_LI = f"WITH {LI}, {LI_LONG}"
# One row of statistics next to every lineitem row.
LI_STATS = f"""{WITH_LI}, {STATS},
one AS (SELECT """ + ", ".join(
    f"max(CASE WHEN feature = {i} THEN {c} END) AS {c}{i}"
    for i in range(4)
    for c in ("mean", "std", "min", "max")
) + " FROM stats)"


def _flat(df, *keep, places=6, n=4, prefix="z"):
    return df.select(*keep, *[F.round(F.get("features", F.lit(i)), places).alias(f"{prefix}{i}") for i in range(n)])


@query(
    "feature_stats",
    f"""{WITH_LI}, {STATS} SELECT feature, n, round(mean, 6) AS mean, round(std, 6) AS std,
    min, max FROM stats""",
)
def feature_stats(spark, sf):
    s = stats.feature_stats(lineitem_rows(spark, sf))
    return s.select("feature", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max")


@query(
    "zscore_rows",
    LI_STATS + " SELECT row_key, " + ", ".join(
        f"round((f{i} - mean{i}) / nullif(std{i}, 0), 6) AS z{i}" for i in range(4)) + " FROM li, one",
)
def zscore_rows(spark, sf):
    rows = lineitem_rows(spark, sf)
    return _flat(stats.zscore(rows, stats.feature_stats(rows)), "row_key")


@query(
    "minmax_rows",
    LI_STATS + " SELECT row_key, " + ", ".join(
        f"round((f{i} - min{i}) / nullif(max{i} - min{i}, 0), 6) AS z{i}" for i in range(4)) + " FROM li, one",
)
def minmax_rows(spark, sf):
    rows = lineitem_rows(spark, sf)
    return _flat(stats.minmax(rows, stats.feature_stats(rows)), "row_key")


@query(
    "centered_rows",
    LI_STATS + " SELECT row_key, " + ", ".join(f"round(f{i} - mean{i}, 6) AS z{i}" for i in range(4)) + " FROM li, one",
)
def centered_rows(spark, sf):
    rows = lineitem_rows(spark, sf)
    return _flat(stats.center(rows, stats.feature_stats(rows)), "row_key")


@query(
    "truncated_values",
    LI_STATS + """ SELECT row_key, CAST(trunc(round((f0 - mean0) / std0 * 10, 6)) AS BIGINT) AS t0,
    CAST(trunc(f3) AS BIGINT) AS t3 FROM li, one""",
)
def truncated_values(spark, sf):
    rows = lineitem_rows(spark, sf)
    scaled = stats.zscore(rows.withColumn("raw", F.get("features", F.lit(3))), stats.feature_stats(rows))
    return scaled.select(
        "row_key",
        vectors.truncate_to_int(F.round(F.get("features", F.lit(0)) * 10, 6)).alias("t0"),
        vectors.truncate_to_int(F.col("raw")).alias("t3"),
    )


PLANE_W, PLANE_B = (0.1, 10.0, -5.0, 0.0), -3.0
PLANE_SQL = "(f0 * 0.1 + f1 * 10.0 + f2 * -5.0 + f3 * 0.0 + -3.0)"


@query(
    "hyperplane_classes",
    f"WITH {LI} SELECT row_key, CASE WHEN round({PLANE_SQL}, 9) >= 0 THEN 1 ELSE 0 END AS class FROM li",
)
def hyperplane_classes(spark, sf):
    rows = lineitem_rows(spark, sf)
    z = F.round(vectors.hyperplane_score(F.col("features"), PLANE_W, PLANE_B), 9)
    return rows.select("row_key", vectors.hyperplane_class(F.array(z), (1.0,), 0.0).alias("class"))


@query(
    "support_vectors",
    f"WITH {LI} SELECT row_key, label FROM li WHERE abs(abs({PLANE_SQL}) - 1) <= 0.00101",
)
def support_vectors(spark, sf):
    rows = lineitem_rows(spark, sf)
    return rows.filter(vectors.on_margin(F.col("features"), PLANE_W, PLANE_B)).select("row_key", "label")


@query(
    "support_vector_count",
    f"WITH {LI} SELECT count(*) AS n FROM li WHERE abs(abs({PLANE_SQL}) - 1) <= 0.00101",
)
def support_vector_count(spark, sf):
    return support_vectors(spark, sf).agg(F.count(F.lit(1)).alias("n"))


@query(
    "projection_partition",
    f"""WITH {LI} SELECT label, f0 * 0.5 + f1 * 20.0 <= 13.15 AS go_left, count(*) AS n
    FROM li GROUP BY ALL""",
)
def projection_partition(spark, sf):
    rows = lineitem_rows(spark, sf)
    left = vectors.goes_left(F.col("features"), (0.5, 20.0), 13.15)
    return rows.groupBy("label", left.alias("go_left")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "binary_relabel",
    f"""WITH {LI}, parts AS (SELECT * FROM (VALUES (1, '0'), (2, '1'), (3, '0,1')) t(mask, members))
    SELECT mask::BIGINT AS mask, members,
      CASE WHEN list_contains(string_split(members, ','), label::VARCHAR) THEN 0 ELSE 1 END AS side,
      count(*) AS n FROM li, parts GROUP BY ALL""",
)
def binary_relabel(spark, sf):
    rows = lineitem_rows(spark, sf)
    parts = oblique.bipartition_table(rows).select("mask", "members")
    counts = metrics.class_counts(rows)  # one row per class, met with one row per bipartition
    side = F.when(F.array_contains("members", F.col("label")), F.lit(0)).otherwise(F.lit(1))
    return (
        counts.join(F.broadcast(parts), F.lit(True))
        .groupBy("mask", F.array_join(F.transform("members", lambda m: m.cast("string")), ",").alias("members"), side.alias("side"))
        .agg(F.sum("n").alias("n"))
    )


@query(
    "class_bipartitions",
    f"""WITH {EMB}, ks AS (SELECT list(DISTINCT label ORDER BY label) AS cs FROM emb)
    SELECT m AS mask, array_to_string([cs[i] FOR i IN range(1, len(cs) + 1) IF (m >> (i - 1)) & 1 = 1], ',') AS members
    FROM (SELECT cs, unnest(range(1, 1 << (len(cs) - 1))) AS m FROM ks)""",
)
def class_bipartitions(spark, sf):
    parts = oblique.bipartition_table(embedding_rows(spark, sf))
    return parts.select("mask", F.array_join(F.transform("members", lambda m: m.cast("string")), ",").alias("members"))


@query(
    "distance_to_centroid",
    f"""WITH {EMB}, {EMB_LONG}, c AS (SELECT feature, avg(value) AS mean FROM elong GROUP BY feature)
    SELECT vec_id, round(sqrt(sum((value - mean) * (value - mean))), 6) AS distance
    FROM elong JOIN c USING (feature) GROUP BY vec_id""",
)
def distance_to_centroid(spark, sf):
    rows = embedding_rows(spark, sf)
    means = stats.feature_stats(rows).orderBy("feature").select("mean").collect()
    d = vectors.euclidean(F.col("features"), F.lit([r["mean"] for r in means]))
    return rows.select("vec_id", F.round(d, 6).alias("distance"))


@query(
    "task_losses",
    """WITH p AS (SELECT CAST(round(l_discount * 100) AS INT) AS y_hat, CAST(round(l_tax * 100) AS INT) AS y
      FROM lineitem)
    SELECT 'regression' AS task, CAST(trunc(avg(((y_hat - y) * (y_hat - y))::DOUBLE)) AS BIGINT) AS loss FROM p
    UNION ALL SELECT 'classification', count(*) FILTER (y_hat = y) FROM p""",
)
def task_losses(spark, sf):
    p = table(spark, sf, "lineitem").select(
        F.round(F.col("l_discount") * 100).cast("int").alias("y_hat"),
        F.round(F.col("l_tax") * 100).cast("int").alias("y_true"),
    )
    parts = [metrics.task_loss(p, t).select(F.lit(t).alias("task"), "loss") for t in ("regression", "classification")]
    return parts[0].unionByName(parts[1])


PAIRS = "pairs AS (SELECT quality AS actual, toxic AS predicted FROM labels)"


def _pairs(spark, sf):
    return table(spark, sf, "labels").select(F.col("quality").alias("actual"), F.col("toxic").alias("predicted"))


@query(
    "accuracy_error",
    f"""WITH {PAIRS} SELECT count(*) AS n, count(*) FILTER (actual = predicted) AS hits,
    round(avg((actual = predicted)::INT), 6) AS accuracy, round(1 - avg((actual = predicted)::INT), 6) AS error FROM pairs""",
)
def accuracy_error(spark, sf):
    a = metrics.accuracy(_pairs(spark, sf))
    return a.select("n", "hits", F.round("accuracy", 6).alias("accuracy"), F.round("error", 6).alias("error"))


@query("confusion_matrix", f"WITH {PAIRS} SELECT actual, predicted, count(*) AS n FROM pairs GROUP BY ALL")
def confusion_matrix(spark, sf):
    return metrics.confusion(_pairs(spark, sf))


@query(
    "confusion_stats",
    f"""WITH {PAIRS} SELECT count(*) AS total, count(*) FILTER (actual = predicted) AS correct,
    count(*) FILTER (actual <> predicted) AS incorrect FROM pairs""",
)
def confusion_stats(spark, sf):
    return metrics.confusion_stats(metrics.confusion(_pairs(spark, sf)))


@query("class_counts", f"WITH {LI} SELECT status, label, count(*) AS n FROM li GROUP BY ALL")
def class_counts(spark, sf):
    return metrics.class_counts(lineitem_rows(spark, sf), by=["status"])


@query(
    "class_impurities",
    f"""WITH {LI}, c AS (SELECT status, label, count(*) AS n FROM li GROUP BY ALL),
    p AS (SELECT *, n / sum(n) OVER (PARTITION BY status) AS share FROM c)
    SELECT status, sum(n)::BIGINT AS n, round(-sum(share * log2(share)), 6) AS entropy,
      round(1 - sum(share * share), 6) AS gini, arg_min(label, (-n, label)) AS majority
    FROM p GROUP BY status""",
)
def class_impurities(spark, sf):
    counts = metrics.class_counts(lineitem_rows(spark, sf), by=["status"])
    i = metrics.impurities(counts, by=["status"])
    return i.select("status", "n", F.round("entropy", 6).alias("entropy"), F.round("gini", 6).alias("gini"), "majority")


@query(
    "covariance_matrix",
    f"""WITH {EMB}, {EMB_LONG} SELECT a.feature AS i, b.feature AS j,
      round(covar_pop(a.value, b.value) * count(*), 5) AS gram, round(covar_pop(a.value, b.value), 6) AS cov
    FROM elong a JOIN elong b ON a.vec_id = b.vec_id AND a.feature <= b.feature GROUP BY ALL""",
)
def covariance_matrix(spark, sf):
    c = moments.covariance(embedding_rows(spark, sf))
    return c.select("i", "j", F.round("gram", 5).alias("gram"), F.round("cov", 6).alias("cov"))


@query(
    "incomplete_vectors_covariance",
    f"""WITH {LI_COMPLETE}, {LI_LONG} SELECT a.feature AS i, b.feature AS j,
      round(covar_pop(a.value, b.value), 5) AS cov FROM long a JOIN long b
      ON a.row_key = b.row_key AND a.feature <= b.feature GROUP BY ALL""",
)
def incomplete_vectors_covariance(spark, sf):
    """Rows with a NULL vector or element are left out."""
    c = moments.covariance(with_holes(lineitem_rows(spark, sf)))
    return c.select("i", "j", F.round("cov", 5).alias("cov"))


# Leakage --------------------------------------------------------------------

OVERLAP = f"""WITH {LI}, seen AS (SELECT DISTINCT f0, f1, f2 FROM li WHERE status = 'F')
SELECT row_key, label FROM li JOIN seen USING (f0, f1, f2) WHERE status = 'O'"""


def _by_status(spark, sf):
    rows = lineitem_rows(spark, sf).withColumn("features", F.slice("features", 1, 3))
    return rows.filter("status = 'F'"), rows.filter("status = 'O'")


@query("leaked_rows", OVERLAP)
def leaked_rows(spark, sf):
    return metrics.vector_overlap(*_by_status(spark, sf)).select("row_key", "label")


@query("leakage_flag", f"SELECT count(*) > 0 AS overlap FROM ({OVERLAP})")
def leakage_flag(spark, sf):
    return metrics.has_overlap(*_by_status(spark, sf))


# Sampling -------------------------------------------------------------------


def _rank(seed, key, partition=""):
    part = f"PARTITION BY {partition} " if partition else ""
    return f"row_number() OVER ({part}ORDER BY md5('{seed}|' || {key}), {key})"


@query(
    "stratified_holdout",
    f"""WITH {LI} SELECT row_key, label, CASE WHEN {_rank(42, 'row_key', 'label')}
      <= round_even(count(*) OVER (PARTITION BY label) * 0.25, 0) THEN 'test' ELSE 'train' END AS split FROM li""",
)
def stratified_holdout(spark, sf):
    return sampling.stratified_holdout(lineitem_rows(spark, sf, busy=True), "row_key").select("row_key", "label", "split")


@query(
    "stratified_folds",
    f"WITH {LI} SELECT row_key, label, (({_rank(42, 'row_key', 'label')} - 1) % 3)::INT AS fold FROM li",
)
def stratified_folds(spark, sf):
    return sampling.stratified_folds(lineitem_rows(spark, sf, busy=True), "row_key").select("row_key", "label", "fold")


@query(
    "plain_folds",
    f"WITH {LI} SELECT row_key, (ntile(5) OVER (ORDER BY md5('42|' || row_key), row_key) - 1)::INT AS fold FROM li",
)
def plain_folds(spark, sf):
    return sampling.plain_folds(lineitem_rows(spark, sf, busy=True), "row_key").select("row_key", "fold")


@query(
    "shuffled_holdout",
    f"""SELECT o_orderkey, CASE WHEN {_rank(42, 'o_orderkey')} <= floor(count(*) OVER () * 0.1)
      THEN 'val' ELSE 'train' END AS split FROM orders""",
)
def shuffled_holdout(spark, sf):
    return sampling.holdout(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.1)


@query(
    "tail_holdout",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) >
      count(*) OVER () - ceil(count(*) OVER () * 0.25) THEN 'test' ELSE 'train' END AS split FROM orders""",
)
def tail_holdout(spark, sf):
    placed = ranking.positions(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])
    return sampling.tail_holdout(placed, "position").drop("position")


@query(
    "bag_draws",
    f"""WITH {LI}, n AS (SELECT count(*) AS n FROM li),
    d AS (SELECT unnest(range(3)) AS tree_id)
    SELECT tree_id::INT AS tree_id, draw, ('0x' || substr(md5('bag|' || tree_id || '|' || draw), 1, 12))::BIGINT % n + 1 AS position
    FROM (SELECT tree_id, unnest(range(n // 2)) AS draw, n FROM d, n)""",
)
def bag_draws(spark, sf):
    n = table(spark, sf, "lineitem").count()
    return sampling.bag_draws(spark, 3, n // 2, n, "bag")


BAG = f"""n AS (SELECT count(*) AS n FROM li),
pos AS (SELECT row_key, {_rank('bag', 'row_key')} AS position FROM li),
draws AS (SELECT tree_id, ('0x' || substr(md5('bag|' || tree_id || '|' || draw), 1, 12))::BIGINT % n + 1 AS position
  FROM (SELECT tree_id, unnest(range(n // 2)) AS draw, n FROM (SELECT unnest(range(3))::INT AS tree_id), n)),
bag AS (SELECT tree_id, row_key, count(*) AS weight FROM draws JOIN pos USING (position) GROUP BY ALL)"""


@query("bag_rows", f"WITH {LI}, {BAG} SELECT row_key, tree_id, weight FROM bag")
def bag_rows(spark, sf):
    rows = lineitem_rows(spark, sf, busy=True)
    n = rows.count()
    bagged = sampling.bags(rows, "row_key", 3, n // 2, n, True, "bag")
    return bagged.select("row_key", F.explode("bag").alias("b")).select("row_key", "b.*")


@query(
    "bag_rows_once",
    f"""WITH {LI}, n AS (SELECT count(*) AS n FROM li),
    t AS (SELECT row_key, unnest(range(3))::INT AS tree_id FROM li)
    SELECT row_key, tree_id, 1::BIGINT AS weight FROM t, n QUALIFY row_number() OVER (
      PARTITION BY tree_id ORDER BY md5('bag|' || tree_id || '|' || row_key), row_key) <= n // 2""",
)
def bag_rows_once(spark, sf):
    rows = lineitem_rows(spark, sf, busy=True)
    n = rows.count()
    bagged = sampling.bags(rows, "row_key", 3, n // 2, n, False, "bag")
    return bagged.select("row_key", F.explode("bag").alias("b")).select("row_key", "b.*")


SUB = """sub AS (SELECT tree_id, (row_number() OVER (PARTITION BY tree_id ORDER BY feature) - 1)::INT AS pos, feature
  FROM (SELECT t::INT AS tree_id, f::INT AS feature FROM range({trees}) a(t), range({m}) b(f)
    QUALIFY row_number() OVER (PARTITION BY t ORDER BY md5('{seed}|' || t || '|' || f)) <= {k}))"""


@query(
    "feature_subspaces",
    f"""WITH {EMB}, {SUB.format(trees=20, m=64, k=8, seed='space')}
    SELECT tree_id, pos, feature, count(*) AS n, round(avg(emb.features[feature + 1]), 6) AS mean
    FROM sub, emb GROUP BY ALL""",
)
def feature_subspaces(spark, sf):
    rows = embedding_rows(spark, sf)
    m = rows.agg(F.max(F.size("features"))).first()[0]
    space = sampling.subspaces(spark, 20, m, 8, "space")
    per_feature = stats.feature_stats(rows).select("feature", "n", F.round("mean", 6).alias("mean"))
    return space.join(per_feature, "feature").select("tree_id", "pos", "feature", "n", "mean")


@query(
    "stratified_sample",
    f"""WITH {LI}, r AS (SELECT row_key, label, {_rank(7, 'row_key', 'label')} AS rk,
      count(*) OVER (PARTITION BY label) AS nl, count(*) OVER () AS n FROM li)
    SELECT row_key, label FROM r WHERE rk <= least(round_even(1000.0 * nl / n, 0), nl)""",
)
def stratified_sample(spark, sf):
    rows = lineitem_rows(spark, sf)
    return sampling.stratified_sample(rows, "row_key", 1000, "label", 7).select("row_key", "label")


@query(
    "random_subset",
    "SELECT o_orderkey FROM orders ORDER BY md5('42|' || o_orderkey), o_orderkey LIMIT 25",
)
def random_subset(spark, sf):
    return sampling.random_subset(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 25)


@query(
    "first_items",
    "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 100",
)
def first_items(spark, sf):
    return table(spark, sf, "events").orderBy("event_id").limit(100).select("event_id", "event_type")


@query(
    "positional_submission",
    f"""WITH {LI} SELECT row_number() OVER (ORDER BY row_key) AS "ID", label AS "Prediction" FROM li""",
)
def positional_submission(spark, sf):
    rows = lineitem_rows(spark, sf).withColumnRenamed("label", "predicted")
    return results.positional_rows(rows, "row_key")


@query(
    "gaussian_source",
    """SELECT event_id, round(sqrt(-2.0 * ln((('0x' || substr(md5('ga|' || event_id), 1, 12))::BIGINT + 1) / pow(16, 12)))
      * cos(2 * pi() * (('0x' || substr(md5('gb|' || event_id), 1, 12))::BIGINT / pow(16, 12))), 6) AS g FROM events""",
)
def gaussian_source(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.round(hashing.gaussian("g", F.col("event_id")), 6).alias("g"))


def _u(axis):
    return f"(('0x' || substr(md5('42|{axis}|' || o_orderkey), 1, 12))::BIGINT / pow(16, 12))"


@query(
    "sampled_params",
    f"""SELECT o_orderkey, (2 + floor({_u('maxDepth')} * 9))::INT AS "maxDepth",
      ['gini','entropy'][floor({_u('gainMethod')} * 2)::INT + 1] AS "gainMethod", st AS "splitType",
      [NULL, 1, 2][floor({_u('lda_components')} * 3)::INT + 1] AS lda_components,
      (1 + floor({_u('featuresPerTree')} * 34))::INT AS "featuresPerTree",
      round(0.3 + {_u('samplesFraction')} * 0.7, 6) AS "samplesFraction",
      (10 + floor({_u('treeCount')} * 191))::INT AS "treeCount",
      CASE WHEN st = 'PCA' THEN [5, 10, 15, 20][floor({_u('pca_c')} * 4)::INT + 1] END AS pca_c,
      CASE WHEN st LIKE 'SVM-%' THEN round(0.01 * pow(10000.0, {_u('svm_C')}), 6) END AS "svm_C"
    FROM (SELECT *, ['orthogonal','PCA','SVM-linear','SVM-rbf','SVM-poly','SVM-sigmoid'][floor({_u('splitType')} * 6)::INT + 1] AS st FROM orders)""",
)
def sampled_params(spark, sf):
    t = sampling.sample_params(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 34)
    return t.withColumns({c: F.round(c, 6) for c in ("samplesFraction", "svm_C")})


# Sets -----------------------------------------------------------------------


@query(
    "index_difference",
    "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def index_difference(spark, sf):
    return sets.difference(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@query(
    "union_first_wins",
    """SELECT doc_id, 'labels' AS src FROM labels UNION ALL
    SELECT doc_id, 'documents' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def union_first_wins(spark, sf):
    a = table(spark, sf, "labels").select("doc_id", F.lit("labels").alias("src"))
    b = table(spark, sf, "documents").select("doc_id", F.lit("documents").alias("src"))
    return sets.union_first_wins(a, b, "doc_id")


@query(
    "stacked_classes",
    """SELECT 0 AS label, c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL
    SELECT 1, s_suppkey, s_acctbal FROM supplier""",
)
def stacked_classes(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return sets.stack_classes([c, s]).select("label", "id", "balance")


@query(
    "distinct_in_order",
    "SELECT o_custkey, min(o_orderkey) AS first FROM orders GROUP BY o_custkey",
)
def distinct_in_order(spark, sf):
    return sets.distinct_in_order(table(spark, sf, "orders"), "o_custkey", "o_orderkey")


@query(
    "set_membership",
    """SELECT c_custkey AS custkey, c_custkey IN (SELECT o_custkey FROM orders) AS member FROM customer""",
)
def set_membership(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"))
    return sets.with_membership(c, table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey")), "custkey")


# Neighbours -----------------------------------------------------------------

ESPLIT = f"""{EMB}, {EMB_LONG},
es AS (SELECT vec_id, label, CASE WHEN {_rank(42, 'vec_id', 'label')}
  <= round_even(count(*) OVER (PARTITION BY label) * 0.25, 0) THEN 'test' ELSE 'train' END AS split FROM emb),
st AS (SELECT feature, avg(value) AS mean, stddev_pop(value) AS std FROM elong JOIN es USING (vec_id)
  WHERE split = 'train' GROUP BY feature),
z AS (SELECT vec_id, es.label, split, list((value - mean) / std ORDER BY feature) AS x
  FROM elong JOIN st USING (feature) JOIN es USING (vec_id) GROUP BY ALL),
near AS (SELECT q.vec_id AS query, t.vec_id AS neighbor, t.label, list_distance(q.x, t.x) AS distance,
  row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_distance(q.x, t.x), 9), t.vec_id::VARCHAR) AS rank
  FROM z q JOIN z t ON q.split = 'test' AND t.split = 'train' QUALIFY rank <= 5)"""


def _embedding_split(spark, sf):
    rows = sampling.stratified_holdout(embedding_rows(spark, sf), "vec_id")
    return rows.filter("split = 'train'"), rows.filter("split = 'test'")


@query(
    "nearest_neighbors",
    f"WITH {ESPLIT} SELECT query::VARCHAR AS query, neighbor::VARCHAR AS neighbor, rank::INT AS rank, round(distance, 6) AS distance FROM near",
)
def nearest_neighbors(spark, sf):
    train, test = _embedding_split(spark, sf)
    s = stats.feature_stats(train)
    near = neighbors.nearest(stats.zscore(train, s), stats.zscore(test, s), 5, "vec_id")
    return near.select("query", "neighbor", "rank", F.round("distance", 6).alias("distance"))


@query(
    "knn_classes",
    f"""WITH {ESPLIT} SELECT query::VARCHAR AS query, arg_min(label, (-n, label)) AS predicted
    FROM (SELECT query, label, count(*) AS n FROM near GROUP BY ALL) GROUP BY query""",
)
def knn_classes(spark, sf):
    train, test = _embedding_split(spark, sf)
    return neighbors.knn_classify(train, test, 5, "vec_id")


# Linear models ----------------------------------------------------------------

OLS = f"""WITH {LI}, c AS (SELECT corr(f0, f1) AS r01, corr(f0, f3) AS r0y, corr(f1, f3) AS r1y,
  avg(f0) AS m0, avg(f1) AS m1, avg(f3) AS my, stddev_pop(f0) AS s0, stddev_pop(f1) AS s1, stddev_pop(f3) AS sy FROM li),
w AS (SELECT *, (r0y - r01 * r1y) / (1 - r01 * r01) AS w0, (r1y - r01 * r0y) / (1 - r01 * r01) AS w1 FROM c)"""


def _least_squares(spark, sf):
    rows = lineitem_rows(spark, sf)
    rows = rows.withColumn("y", F.get("features", F.lit(3))).withColumn("features", F.slice("features", 1, 2))
    return rows, linear.fit_least_squares(rows, "y")


@query(
    "least_squares_weights",
    OLS + """ SELECT 0 AS feature, round(w0, 6) AS weight FROM w UNION ALL SELECT 1, round(w1, 6) FROM w""",
)
def least_squares_weights(spark, sf):
    _, model = _least_squares(spark, sf)
    return local_table(
        spark, [(i, round(float(w), 6)) for i, w in enumerate(model.weights)], "feature int, weight double"
    )


@query(
    "incomplete_vectors_least_squares",
    OLS.replace(LI, LI_COMPLETE)
    + """ SELECT 0 AS feature, round(w0, 6) AS weight FROM w UNION ALL SELECT 1, round(w1, 6) FROM w""",
)
def incomplete_vectors_least_squares(spark, sf):
    """Rows with a NULL vector or element are left out."""
    rows = lineitem_rows(spark, sf).withColumn("y", F.get("features", F.lit(3)))
    rows = with_holes(rows).withColumn("features", F.slice("features", 1, 2))
    model = linear.fit_least_squares(rows, "y")
    weights = [(i, round(float(w), 6)) for i, w in enumerate(model.weights)]
    return local_table(spark, weights, "feature int, weight double")


@query(
    "least_squares_predictions",
    OLS + """ SELECT row_key, round(my + sy * (w0 * (f0 - m0) / s0 + w1 * (f1 - m1) / s1), 6) AS y_hat,
      CAST(trunc(my + sy * (w0 * (f0 - m0) / s0 + w1 * (f1 - m1) / s1)) AS BIGINT) AS y_int FROM li, w""",
)
def least_squares_predictions(spark, sf):
    rows, model = _least_squares(spark, sf)
    y = model.predict(F.col("features"))
    return rows.select("row_key", F.round(y, 6).alias("y_hat"), vectors.truncate_to_int(y).alias("y_int"))


@query(
    "variance_components",
    f"""WITH {LI}, c AS (SELECT var_pop(f0) AS a, var_pop(f3) AS d, covar_pop(f0, f3) AS b FROM li),
    e AS (SELECT (a + d) / 2 AS h, sqrt((a - d) * (a - d) / 4 + b * b) AS r FROM c),
    s AS (SELECT 1 AS k, (h + r) / (2 * h) AS share FROM e UNION ALL SELECT 2, (h - r) / (2 * h) FROM e),
    run AS (SELECT k, share, sum(share) OVER (ORDER BY k) AS running FROM s),
    v AS (SELECT unnest([0.0, 0.5, 0.9, 0.99, 1.0])::DOUBLE AS v)
    SELECT v AS variance, coalesce(min(CASE WHEN round(running, 9) >= v THEN k END), -1)::INT AS components,
      round(max(CASE WHEN k = 1 THEN share END), 6) AS first_share
    FROM run, v GROUP BY v""",
)
def variance_components(spark, sf):
    rows = lineitem_rows(spark, sf)
    pca = linear.fit_pca(rows.select(F.array(F.get("features", F.lit(0)), F.get("features", F.lit(3))).alias("features")))
    shares = linear.variance_shares(spark, pca).withColumn("running", F.round("running", 9))
    first = shares.agg(F.round(F.max(F.when(F.col("k") == 1, F.col("share"))), 6).alias("first_share"))
    found = [
        linear.components_for(shares, v).select(F.lit(v).alias("variance"), "components")
        for v in (0.0, 0.5, 0.9, 0.99, 1.0)
    ]
    return reduce(lambda a, b: a.unionByName(b), found).join(F.broadcast(first), F.lit(True))


@query("variance_shares")
def variance_shares(spark, sf):
    shares = linear.variance_shares(spark, linear.fit_pca(embedding_rows(spark, sf)))
    return shares.select("k", F.round("share", 6).alias("share"), F.round("running", 6).alias("running"))


@query("pca_scores")
def pca_scores(spark, sf):
    rows = embedding_rows(spark, sf)
    scores = linear.fit_pca(rows).project(F.col("features"), 3)
    return rows.select("vec_id", scores.alias("s")).select(
        "vec_id", *[F.round(F.get("s", F.lit(i)), 6).alias(f"s{i}") for i in range(3)]
    )


PLANE = f"""WITH {LI}, c AS (SELECT avg(f0) AS m0, avg(f3) AS m3, var_pop(f0) AS a, var_pop(f3) AS d,
  covar_pop(f0, f3) AS b FROM li),
e AS (SELECT *, (a + d) / 2 + sqrt((a - d) * (a - d) / 4 + b * b) AS top FROM c),
v AS (SELECT *, b / sqrt(b * b + (top - a) * (top - a)) AS u, (top - a) / sqrt(b * b + (top - a) * (top - a)) AS w FROM e),
s AS (SELECT *, CASE WHEN (CASE WHEN abs(u) >= abs(w) THEN u ELSE w END) < 0 THEN -1 ELSE 1 END AS s1,
  CASE WHEN (CASE WHEN abs(w) >= abs(u) THEN -w ELSE u END) < 0 THEN -1 ELSE 1 END AS s2 FROM v)"""


def _plane(spark, sf):
    rows = lineitem_rows(spark, sf)
    return rows.withColumn("features", F.array(F.get("features", F.lit(0)), F.get("features", F.lit(3))))


@query(
    "pca_scores_plane",
    PLANE + """ SELECT row_key, round(s1 * (u * (f0 - m0) + w * (f3 - m3)), 5) AS s0,
      round(s2 * (u * (f3 - m3) - w * (f0 - m0)), 5) AS s1 FROM li, s""",
)
def pca_scores_plane(spark, sf):
    """Scores on both axes of two features, against the closed form."""
    rows = _plane(spark, sf)
    scores = linear.fit_pca(rows).project(F.col("features"), 2)
    return rows.select("row_key", scores.alias("s")).select(
        "row_key", *[F.round(F.get("s", F.lit(i)), 5).alias(f"s{i}") for i in range(2)]
    )


@query(
    "pca_score_moments",
    f"""WITH {LI}, {LI_LONG}, v AS (SELECT sum(var) AS total FROM (
      SELECT feature, var_pop(value) AS var FROM long GROUP BY feature))
    SELECT round(total, 4) AS variance, 0.0::DOUBLE AS covariance, 0.0::DOUBLE AS mean FROM v""",
)
def pca_score_moments(spark, sf):
    """Scores on all axes keep the total variance, do not vary together and have mean zero."""
    rows = lineitem_rows(spark, sf)
    pca = linear.fit_pca(rows)
    scores = rows.select(pca.project(F.col("features"), len(pca.axes)).alias("features"))
    c = moments.covariance(scores)
    means = stats.feature_stats(scores).agg(F.max(F.abs("mean")).alias("mean"))
    return c.agg(
        F.round(F.sum(F.when(F.col("i") == F.col("j"), F.col("cov"))), 4).alias("variance"),
        F.round(F.max(F.when(F.col("i") != F.col("j"), F.abs("cov"))), 6).alias("covariance"),
    ).crossJoin(F.broadcast(means.select(F.round("mean", 6).alias("mean"))))  # one row each


@query(
    "lda_direction",
    f"""WITH {LI}, t AS (SELECT f0, f3, status = 'O' AS o FROM li),
    g AS (SELECT o, count(*) AS n, avg(f0) AS m0, avg(f3) AS m3, var_pop(f0) AS a, var_pop(f3) AS d,
      covar_pop(f0, f3) AS b FROM t GROUP BY o),
    w AS (SELECT sum(n * a) / sum(n) AS a, sum(n * d) / sum(n) AS d, sum(n * b) / sum(n) AS b,
      sum(CASE WHEN o THEN m0 ELSE -m0 END) AS x, sum(CASE WHEN o THEN m3 ELSE -m3 END) AS y FROM g),
    r AS (SELECT (d * x - b * y) AS p, (a * y - b * x) AS q FROM w)
    SELECT round(abs(p) / sqrt(p * p + q * q), 6) AS first, round(abs(q) / sqrt(p * p + q * q), 6) AS second,
      p * q > 0 AS same_sign FROM r""",
)
def lda_direction(spark, sf):
    """The discriminant of two classes and two features, up to scale and sign, against the closed form."""
    whole = F.array(F.struct(F.lit(0).alias("tree_id"), F.lit(1).cast("bigint").alias("weight")))
    rows = _plane(spark, sf).select("features", (F.col("status") == "O").cast("int").alias("label"), whole.alias("bag"))
    parts = oblique.class_matrices(rows, [scan.WalkedTree(0, None, [], {1: 0})], np.array([0, 1]), ())[0]
    w = oblique.discriminants(parts, 1)[0]
    w = w / (w @ w) ** 0.5
    row = (round(abs(float(w[0])), 6), round(abs(float(w[1])), 6), bool(w[0] * w[1] > 0))
    return local_table(spark, [row], "first double, second double, same_sign boolean")


ORDER_VIOLATIONS = f"""WITH {EMB}, p AS (SELECT a.vec_id AS i, b.vec_id AS j, list_distance(a.features, b.features) AS d,
      list_distance(a.features[1:8], b.features[1:8]) AS dh FROM emb a JOIN emb b ON a.vec_id <> b.vec_id)
    SELECT count(*) AS violations FROM p x JOIN p y ON x.i = y.i AND x.j <> y.j
    WHERE (x.d < y.d) <> (x.dh < y.dh)"""


@query("order_violations", ORDER_VIOLATIONS)
def order_violations(spark, sf):
    rows = embedding_rows(spark, sf).withColumn("projected", F.slice("features", 1, 8))
    return linear.order_violations(rows, "vec_id", "projected")


@query("order_violations_tiled", ORDER_VIOLATIONS)
def order_violations_tiled(spark, sf):
    """The same in tiles of 128 KB, several at every size, so that the sums over pairs of groups of them are checked as well."""
    rows = embedding_rows(spark, sf).withColumn("projected", F.slice("features", 1, 8))
    return linear.order_violations(rows, "vec_id", "projected", tile_bytes=128 * 1024)


@query("pca_order_violations")
def pca_order_violations(spark, sf):
    rows = embedding_rows(spark, sf)
    pca = linear.fit_pca(rows)
    return linear.order_violations(
        rows.withColumn("projected", pca.project(F.col("features"), 8)), "vec_id", "projected"
    )


# Text matrices ------------------------------------------------------------------


@query(
    "numeric_text_scan",
    f"WITH {LI} SELECT f0, f1, f2, label, count(*) AS n FROM li GROUP BY ALL",
)
def numeric_text_scan(spark, sf):
    path = f"{shared_folder(spark)}/matrix-{uuid.uuid4().hex}"
    rows = lineitem_rows(spark, sf).withColumn("features", F.slice("features", 1, 3))
    matrix.write_matrix(rows, path, label="label")
    back = matrix.read_matrix(spark, path, 4, labelled=True)
    cols = [F.get("features", F.lit(i)).alias(f"f{i}") for i in range(3)]
    return back.groupBy(*cols, "label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "headed_text_scan",
    f"WITH {LI} SELECT f0, f1, f2, label, count(*) AS n FROM li GROUP BY ALL",
)
def headed_text_scan(spark, sf):
    """Each file begins with a line that looks like a row of the matrix."""
    path = f"{shared_folder(spark)}/matrix-{uuid.uuid4().hex}"
    rows = lineitem_rows(spark, sf)
    numbers = F.concat_ws(" ", *[F.get("features", F.lit(i)).cast("string") for i in range(3)], F.col("label").cast("string"))
    plain = {"header": True, "quote": "", "sep": "|"}
    rows.select(numbers.alias("7 3 1 2")).write.options(**plain).csv(path)
    back = matrix.read_matrix(spark, path, 4, labelled=True, header_lines=1)
    cols = [F.get("features", F.lit(i)).alias(f"f{i}") for i in range(3)]
    return back.groupBy(*cols, "label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "feature_bundle",
    f"""WITH {LI} SELECT 'train' AS part, count(*) AS n, round(avg(f0), 6) AS mean FROM li WHERE status = 'F'
    UNION ALL SELECT 'test', count(*), round(avg(f0), 6) FROM li WHERE status = 'O'""",
)
def feature_bundle(spark, sf):
    path = f"{shared_folder(spark)}/bundle-{uuid.uuid4().hex}"
    split = F.when(F.col("status") == "F", "train").otherwise("test")
    matrix.write_bundle(lineitem_rows(spark, sf).select("row_key", "features", "label", split.alias("split")), path)
    parts = zip(("train", "test"), matrix.read_bundle(spark, path))
    out = [
        p.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.get("features", F.lit(0))), 6).alias("mean"))
        .select(F.lit(name).alias("part"), "n", "mean")
        for name, p in parts
    ]
    return out[0].unionByName(out[1])
